"""Clinician-directory snapshots, whose layout changed over the years."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake import schemas as S
from rosterlake.functions.dates import detect_date
from rosterlake.operators.quality import observed, value_or_error
from rosterlake.sources.files import (BAD_LINE, first_lines, harmonize, list_files, read_groups,
                                      read_text_table, union_vintages, whole_files, with_path)

# Vintages read without header (one repeats it as a data row).
HEADERLESS = {"2014-03-01", "2014-06-01"}
BAD_LINES = {"2014-03-01", "2014-06-01", "2014-12-01"}
EMPTY_COLUMNS = {"2016-07-01"}

LONG_NAMES = {**S.DIRECTORY_COLUMNS, **S.DIRECTORY_SHORT}


def _peek(spark: SparkSession, path: str, n: int) -> list[list[str]]:
    """The fields of the first lines: layout, not data."""
    return list(csv.reader(r[0] for r in first_lines(spark, path, n).collect()))


def _people_only(df: DataFrame, npi: str = "NPI") -> DataFrame:
    """Rows whose first field is an id: no header lines, no fragments."""
    return df.where(F.col(npi).try_cast("long").isNotNull())


def _headerless(spark: SparkSession, path: str, keep: bool) -> DataFrame:
    """A file without usable header: the columns in order, with or without
    phones."""
    names = list(S.DIRECTORY_COLUMNS)
    if len(_peek(spark, path, 1)[0]) == len(names) - 1:
        names = [n for n in names if n != "Phone Number"]
    rows = read_text_table(spark, path, header=False, names=names, drop_bad_lines=not keep,
                           keep_bad_lines=keep)
    return rows if keep else _people_only(rows)


def _without_empty_columns(spark: SparkSession, path: str, keep: bool) -> DataFrame:
    """Data columns that hold nothing are dropped before the header is laid
    over the rest, in order. One aggregate finds them."""
    head, first = _peek(spark, path, 2)
    names = [f"c{i}" for i in range(max(len(head), len(first)))]
    rows = read_text_table(spark, path, header=False, names=names)
    body = _people_only(rows, "c0")
    counts = body.agg(*[F.count(c).alias(c) for c in names]).first()
    full = [c for c in names if counts[c] > 0]
    return (rows if keep else body).select(*[F.col(c).alias(n) for c, n in zip(full, head)])


def read_vintage(spark: SparkSession, path: str, date: str | None, keep: bool = False) -> DataFrame:
    """One snapshot by the layout of its date. With ``keep``, lines that are no
    rows of it stay: broken ones in ``BAD_LINE``, headers and fragments as
    rows whose id is no number."""
    if date in HEADERLESS:
        return _headerless(spark, path, keep)
    if date in EMPTY_COLUMNS:
        return _without_empty_columns(spark, path, keep)
    bad = date in BAD_LINES
    if keep and bad:
        return read_groups(spark, [path], keep_bad_lines=True)[0].drop("__path")
    return read_text_table(spark, path, drop_bad_lines=bad)


def typed_directory(df: DataFrame) -> DataFrame:
    """Canonical types. Blank text in the integer columns is null, any other
    that is no integer an error."""
    longs = [c for c in S.DIRECTORY_LONGS if c in df.columns]
    return df.withColumns({c: value_or_error(
        F.col(c), F.regexp_replace(F.trim(c), r"\.0$", "").try_cast("long"), f"{c} as long")
        for c in longs})


def _vintages(spark: SparkSession, root: str, wanted: Sequence[str], with_date: bool,
              keep: bool) -> list[tuple[DataFrame, bool]]:
    """Canonical columns as text, one frame per layout and header, and whether
    its vintage may hold header lines and fragments."""
    files = (whole_files(list_files(spark, root, "*.csv"))
             .withColumn("date", detect_date(F.element_at(F.split("path", "/"), -1))))
    dated = {r["path"]: str(r["date"]) for r in files.collect()}
    own_layout = HEADERLESS | EMPTY_COLUMNS
    tables = [(with_path(read_vintage(spark, p, d, keep)), True)
              for p, d in sorted(dated.items()) if d in own_layout]
    for bad in (False, True):
        plain = [p for p, d in sorted(dated.items()) if d not in own_layout and (d in BAD_LINES) == bad]
        tables += [(df, False) for df in read_groups(spark, plain, drop_bad_lines=bad and not keep,
                                                     keep_bad_lines=bad and keep)]
    names = {**LONG_NAMES, "date": "date", BAD_LINE: BAD_LINE}
    kept = [*wanted, *(["date"] if with_date else []), *([BAD_LINE] if keep else [])]
    date = detect_date(F.element_at(F.split("__path", "/"), -1))
    return [(harmonize(df.withColumn("date", date), names, kept), own) for df, own in tables]


def read_directory(spark: SparkSession, root: str, columns: Sequence[str],
                   drop_duplicates: bool = True, with_date: bool = False) -> DataFrame:
    """The wanted canonical columns of all snapshots, typed."""
    wanted = ["npi", *[c for c in columns if c != "npi"]]
    out = union_vintages([typed_directory(df) for df, _ in
                          _vintages(spark, root, wanted, with_date, keep=False)])
    return out.distinct() if drop_duplicates else out


def store_directory(spark: SparkSession, root: str, columns: Sequence[str], path: str) -> DataFrame:
    """Write the wanted columns of all snapshots, with their date, as one
    Parquet table; the lines that were left out are counted in the same pass.

    Returns per date: lines read, malformed (too few or too many fields) and
    without_id (repeated headers and fragments, where the layout allows them).
    The table holds what ``read_directory(..., drop_duplicates=False,
    with_date=True)`` gives. No files at all is an error.
    """
    wanted = ["npi", *[c for c in columns if c != "npi"]]
    frames = []
    for df, own in _vintages(spark, root, wanted, True, keep=True):
        bad = F.col(BAD_LINE).isNotNull() if BAD_LINE in df.columns else F.lit(False)
        no_id = F.col("npi").try_cast("long").isNull() if own else F.lit(False)
        left_out = F.when(bad, "malformed").when(no_id, "without_id")
        frames.append(df.withColumn("__out", left_out).drop(BAD_LINE))
    rows = union_vintages(frames)
    files = whole_files(list_files(spark, root, "*.csv"))
    dates = [r["date"] for r in files.select(
        detect_date(F.element_at(F.split("path", "/"), -1)).alias("date")).distinct().collect()]
    counts = {}
    for i, d in enumerate(dates):
        here = F.col("date").eqNullSafe(F.lit(d).cast("date"))
        counts[f"lines_{i}"] = F.count_if(here)
        for kind in ("malformed", "without_id"):
            counts[f"{kind}_{i}"] = F.count_if(here & F.col("__out").eqNullSafe(F.lit(kind)))
    rows, seen = observed(rows, counts)
    typed_directory(rows.where("__out IS NULL").drop("__out")).write.mode("overwrite").parquet(path)
    found = seen.get
    return spark.createDataFrame(
        [(d, *[found[f"{k}_{i}"] for k in ("lines", "malformed", "without_id")])
         for i, d in enumerate(dates)], "date date, lines long, malformed long, without_id long")
