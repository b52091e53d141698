"""Distinct members by sketches that can be stored and merged.

The exact count stays the default (``plans.practices.members_per``). A sketch
per group and month is a few kilobytes however many members it saw; sketches of
months merge into quarters or the whole span without reading members again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LG_K = 12                 # 4,096 registers: a standard error of about 1.6 %
ERROR = 0.05              # three standard errors


def member_sketches(df: DataFrame, by: Sequence[str], person: str = "npi", lg_k: int = LG_K) -> DataFrame:
    """(by, ``members``): a sketch of the distinct persons of each key; rows
    with a null key or person do not count."""
    known = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*by, person]))
    return known.groupBy(*by).agg(F.hll_sketch_agg(person, F.lit(lg_k)).alias("members"))


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of a coarser key; merging loses nothing more."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("members").alias("members"))


def estimates(sketches: DataFrame, out: str = "members_estimate") -> DataFrame:
    return sketches.withColumn(out, F.hll_sketch_estimate("members")).drop("members")
