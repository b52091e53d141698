"""Reconciling claims detail, summaries and opioid files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from rosterlake.operators.joins import natural_join, provenance_join, semi_join
from rosterlake.operators.quality import duplicate_keys, id_differences, profile_counts


def detail_totals(detail: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Detail rows added up to the summary's grain."""
    return detail.groupBy(*keys).agg(*[F.sum(m).alias(f"{m}_detail") for m in measures])


def summary_with_detail(summary: DataFrame, detail: DataFrame, keys: Sequence[str],
                        measures: Sequence[str]) -> DataFrame:
    """Summary beside added-up detail, with the side each row came from."""
    return provenance_join(summary, detail_totals(detail, keys, measures), on=keys)


def provenance_counts(joined: DataFrame) -> DataFrame:
    return joined.groupBy("_merge").agg(F.count(F.lit(1)).alias("n"))


def presence_in_detail(summary: DataFrame, detail: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many of the given person-years have any detail row."""
    return provenance_counts(provenance_join(
        summary.select(*keys).distinct(), detail.select(*keys).distinct(), on=keys, how="left"))


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows two files share on all columns, copies multiplied as in a join."""
    return natural_join(left, right)


def part_d_info(summary: DataFrame, detail: DataFrame, opioid: DataFrame) -> Mapping[str, DataFrame]:
    """Grain, censoring and agreement of the Part D files.

    Summary: npi, Year, total_claim_count, opioid_claim_count,
    la_opioid_claim_count. Detail adds drug_name and generic_name. The opioid
    file has the summary's columns.
    """
    key = ["npi", "Year"]
    zero = opioid.where(F.col("opioid_claim_count") == 0)
    hidden = opioid.where(F.col("opioid_claim_count").isNull())
    return {
        "summary_duplicates": duplicate_keys(summary, key),
        "summary_profile": profile_counts(summary, "total_claim_count"),
        "detail_duplicates": duplicate_keys(detail, [*key, "drug_name", "generic_name"]),
        "detail_profile": profile_counts(detail, "total_claim_count"),
        "joined": summary_with_detail(summary.select(*key, "total_claim_count"), detail, key,
                                      ["total_claim_count"]),
        "id_differences": id_differences(summary, opioid, key),
        "opioid_profile": profile_counts(opioid, "opioid_claim_count"),
        "zero_in_detail": presence_in_detail(zero, detail, key),
        "null_in_detail": presence_in_detail(hidden, detail, key),
        "same_rows": common_rows(opioid, summary),
    }


def part_b_info(summary: DataFrame, detail: DataFrame) -> Mapping[str, DataFrame]:
    """Grain, censoring and agreement of the Part B files."""
    key = ["npi", "Year"]
    full = [*key, "hcpcs_code", "place_of_service"]
    known = detail.where(F.col("beneficiaries").isNotNull())
    return {
        "summary_duplicates": duplicate_keys(summary, key),
        "summary_profile": profile_counts(summary, "beneficiaries"),
        "detail_duplicates": duplicate_keys(detail, full),
        "detail_profile": profile_counts(detail, "beneficiaries"),
        "null_rows": detail.where(F.col("beneficiaries").isNull()),
        "joined": summary_with_detail(summary, known, key, ["beneficiaries"]),
    }
