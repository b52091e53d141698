"""The licence list: people without an id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake.functions.dates import elapsed_to_timestamp
from rosterlake.operators.joins import join_group_stats
from rosterlake.operators.quality import AuditError, exactly_one_date_rule
from rosterlake.operators.rows import surrogate_id
from rosterlake.sources.files import read_text_table

ID_COLUMNS = ["NameFull", "DateLastCertified", "PractitionerType"]


def identified(people: DataFrame, columns: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Add ``samhsa_id``, one per distinct upper-cased tuple, in tuple order."""
    up = people.withColumns({c: F.upper(c) for c in columns})
    ids = surrogate_id(up.select(*columns).distinct(), columns, "samhsa_id")
    return join_group_stats(up, ids, columns, how="inner")


def dated(people: DataFrame, fmt: str = "td") -> DataFrame:
    """Decode the elapsed date and say whether the date rule holds."""
    out = people.withColumn("Date", elapsed_to_timestamp("Date", fmt).cast("date"))
    granted, certified = F.col("DateGranted").cast("date"), F.col("DateLastCertified").cast("date")
    out = out.withColumns({"__g": granted, "__c": certified})
    return (out.withColumn("date_rule", exactly_one_date_rule("Date", "__g", "__c"))
            .drop("__g", "__c"))


def read_licences(spark: SparkSession, path: str) -> DataFrame:
    """The list with ids and dates; a row breaking the date rule is an error."""
    people = dated(identified(read_text_table(spark, path)))
    if not people.where(~F.coalesce("date_rule", F.lit(False))).isEmpty():
        raise AuditError("a listed date is neither the grant nor the certification date")
    return people.drop("date_rule")
