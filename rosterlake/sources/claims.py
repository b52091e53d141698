"""Yearly claims files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake import schemas as S
from rosterlake.sources.files import (harmonize, list_files, paths_of, read_groups, union_vintages,
                                      whole_files)

PART_B_SUMMARY = ("Medicare_Physician_and_Other_Supplier_National_Provider"
                  "_Identifier__NPI__Aggregate_Report__Calendar_Year_")
PART_B_DETAIL = "Medicare_Provider_Utilization_and_Payment_Data__Physician_and_Other_Supplier_"
OPIOID = "Medicare_Part_D_Opioid_Prescriber_Summary_File_"


def year_of(path: str) -> int | None:
    """Year in a file name: four digits, or two in the older names."""
    import re
    name = path.rsplit("/", 1)[-1]
    four = set(re.findall(r"(?<!\d)(20\d\d)(?!\d)", name))
    if len(four) == 1:
        return int(four.pop())
    two = set(re.findall(r"(?<!\d)(\d\d)(?!\d)", name))
    return 2000 + int(two.pop()) if len(two) == 1 else None


def year_from(path: Column) -> Column:
    """``year_of`` as a column: the one four-digit year in a file's name, else
    the one number of two digits."""
    name = F.element_at(F.split(path, "/"), -1)

    def only(pattern: str) -> Column:
        found = F.array_distinct(F.regexp_extract_all(name, F.lit(pattern), F.lit(1)))
        return F.when(F.size(found) == 1, F.get(found, F.lit(0)).cast("int"))

    return F.coalesce(only(r"(?<!\d)(20\d\d)(?!\d)"), only(r"(?<!\d)(\d\d)(?!\d)") + 2000)


def _of_years(paths: Sequence[str], years: Sequence[int]) -> list[str]:
    return [p for p in paths if year_of(p) in set(years)]


def _yearly(spark: SparkSession, paths: Sequence[str], years: Sequence[int], sep: str,
            columns: Sequence[str] | None) -> DataFrame:
    """Files of the years, one scan per header, with ``Year``."""
    frames = [df.select(*(columns or [c for c in df.columns if c != "__path"]),
                        year_from(F.col("__path")).alias("Year"))
              for df in read_groups(spark, _of_years(paths, years), sep)]
    return union_vintages(frames)


def part_d_paths(spark: SparkSession, root: str, summary: bool) -> list[str]:
    paths = paths_of(whole_files(list_files(spark, root)))
    if any("_DRUG_" in p for p in paths):
        return [p for p in paths if p.endswith(".txt") and ("_DRUG_" not in p) == summary]
    return [p for p in paths if ("Summary" in p) == summary]


def part_d(spark: SparkSession, root: str, summary: bool = False,
           columns: Sequence[str] | None = None,
           years: Sequence[int] = range(2013, 2018)) -> DataFrame:
    """Part D prescriber files: detail by drug, or one summary row."""
    return _yearly(spark, part_d_paths(spark, root, summary), years, "\t", columns)


def part_d_opioid(spark: SparkSession, root: str, columns: Sequence[str] | None = None,
                  years: Sequence[int] = range(2013, 2018)) -> DataFrame:
    paths = [p for p in paths_of(whole_files(list_files(spark, root))) if OPIOID in p]
    return _yearly(spark, paths, years, ",", columns)


def part_b_names() -> Mapping[str, str]:
    """Header found -> canonical column."""
    return {h: canonical for canonical, headers in S.PART_B_HEADERS.items() for h in headers}


def part_b(spark: SparkSession, root: str, summary: bool = False,
           columns: Sequence[str] | None = None,
           years: Sequence[int] = range(2012, 2018)) -> DataFrame:
    """Part B files with their header variants made one. ``columns`` are
    canonical names."""
    stub = PART_B_SUMMARY if summary else PART_B_DETAIL
    paths = [p for p in paths_of(whole_files(list_files(spark, root))) if stub in p]
    frames = []
    for df in read_groups(spark, _of_years(paths, years)):
        year = year_from(F.col("__path"))
        names = {**{c: c.strip() for c in df.columns if c != "__path"}, **part_b_names()}
        made = harmonize(df.withColumn("Year", year), {**names, "Year": "Year"},
                         None if columns is None else [*columns, "Year"])
        frames.append(made)
    return union_vintages(frames)
