"""Dataflows over the clinician directory (snapshots of listed clinicians)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.functions.text import drop_chars
from rosterlake.operators.impute import blank_orgs, repair_phones, repair_zips
from rosterlake.operators.joins import anti_join, join_group_stats
from rosterlake.operators.rows import last_non_null, modes
from rosterlake.plans.names import expand_names


def name_variants(directory: DataFrame) -> DataFrame:
    """Spelled-out names of listed clinicians, blanks as empty strings."""
    parts = ["last_name", "first_name", "middle_name", "suffix"]
    tidy = {p: F.trim(F.coalesce(p, F.lit(""))) for p in parts}
    tidy["suffix"] = drop_chars(tidy["suffix"], ".")
    rows = directory.select("npi", *[c.alias(p) for p, c in tidy.items()]).distinct()
    return expand_names(rows, "npi", "first_name", "middle_name", "last_name", "suffix",
                        suffix_in_last=True)


def directory_types(directory: DataFrame, min_count: int = 150) -> DataFrame:
    """Credential and primary specialty per clinician; a missing credential is
    taken from its specialty's usual one (MD and DO counted as one).

    Specialties without a usual credential come out with none.
    """
    rows = directory.select(
        "npi", "primary_specialty",
        F.nullif("credential", F.lit(" ")).alias("credential")).distinct()
    counted = rows.select(
        "primary_specialty", F.when(F.col("credential").isin("MD", "DO"), "MD/DO")
        .otherwise(F.col("credential")).alias("__top")).na.drop()
    usual = modes(counted, ["primary_specialty"], "__top", min_count).drop("n")
    joined = join_group_stats(rows, usual, ["primary_specialty"])
    credential = F.when(F.col("__top").isNotNull(), F.coalesce("credential", "__top"))
    return joined.select("npi", "primary_specialty",
                         credential.alias("credential")).distinct()


def repaired(directory: DataFrame) -> DataFrame:
    """ZIP codes, phones and organisation names put in order."""
    return blank_orgs(repair_phones(repair_zips(directory))).distinct()


def years_active(df: DataFrame, key: str, year: str, prefix: str) -> DataFrame:
    return (df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("npi"))
            .agg(F.min(year).alias(f"{prefix}_Min_Year"), F.max(year).alias(f"{prefix}_Max_Year")))


def program_engagement(part_d: DataFrame, part_b: DataFrame, directory: DataFrame,
                       directory_last: int = 2020, claims_last: int = 2017) -> DataFrame:
    """First and last year in three sources, and whether a provider may still
    be active. The three sources meet in one aggregate, not in two joins."""
    sources = {"PC": directory, "PartD": part_d, "PartB": part_b}
    rows = None
    for name, df in sources.items():
        part = df.select("npi", F.col("Year").cast("int").alias("Year"), F.lit(name).alias("__s"))
        rows = part if rows is None else rows.unionByName(part)
    aggs = []
    for name in sources:
        y = F.when(F.col("__s") == name, F.col("Year"))
        aggs += [F.min(y).alias(f"{name}_Min_Year"), F.max(y).alias(f"{name}_Max_Year")]
    out = rows.where(F.col("npi").isNotNull()).groupBy("npi").agg(*aggs)

    def yes(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    pc, pd_, pb = (F.col(f"{n}_Max_Year") for n in ("PC", "PartD", "PartB"))
    seen = yes(pc == directory_last) | yes(pd_ == claims_last) | yes(pb == claims_last)
    left = pd_.isNotNull() & pb.isNotNull() & yes(pc < directory_last)
    return out.withColumns({"maybe_active": seen & ~left,
                            f"active_{directory_last}": yes(pc == directory_last)})


def medical_school(directory: DataFrame, extra: DataFrame | None = None,
                   other: str = "OTHER") -> DataFrame:
    """One school and graduation year per person.

    A person with one row keeps it as it is. Otherwise: a complete row that is
    not OTHER, else a complete OTHER row, else another school, then OTHER, then
    none. Choices among equals fall to the smallest school and year.
    """
    school, year = F.col("medical_school"), F.col("graduation_year")
    rows = directory.select("npi", "medical_school", "graduation_year").distinct()
    complete = school.isNotNull() & year.isNotNull()
    is_other = F.coalesce(school == other, F.lit(False))
    rank = (F.when(complete & ~is_other, 0).when(complete, 1)
            .when(school.isNull(), 4).when(is_other, 3).otherwise(2))
    best = rows.groupBy("npi").agg(F.min(F.struct(
        rank.alias("r"), school.isNull().alias("s0"), "medical_school",
        year.isNull().alias("y0"), "graduation_year")).alias("__b"))
    out = best.select("npi", "__b.medical_school", "__b.graduation_year")
    if extra is not None:
        more = extra.select(
            "npi", F.col("medical_school_upper").alias("medical_school"),
            F.col("grad_year").cast("long").alias("graduation_year")).na.drop()
        out = out.withColumn("graduation_year", F.col("graduation_year").cast("long"))
        out = out.unionByName(anti_join(more, out.select("npi"), on=["npi"], null_equal=False))
    return out


def last_place_practiced(directory: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Last known value of each column per clinician, by snapshot date."""
    return last_non_null(directory, ["npi"], ["date"], columns)


