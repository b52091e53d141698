"""Landed files: listing, dates in paths, and drifting headers."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rosterlake.functions.dates import month_number

BAD_LINE = "__bad_line"
LOT = 100                 # files whose first lines one job reads
SNAPSHOT = r"NPPES_Data_Dissemination_"


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Paths under ``root``; only metadata is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(root).select("path"))


def whole_files(df: DataFrame) -> DataFrame:
    """Files, with a folder of parts named like a file counted as that file."""
    name = F.regexp_extract("path", r"^(.*?\.(?:csv|txt|dta))(?:/|$)", 1)
    return df.select(F.coalesce(F.nullif(name, F.lit("")), F.col("path")).alias("path")).distinct()


def paths_of(df: DataFrame, column: str = "path") -> list[str]:
    """File names on the driver: a catalogue listing, not data."""
    return sorted(r[0] for r in df.select(column).collect())


def _part(path: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def snapshot_month(path: Column | str) -> Column:
    """Month named by a monthly snapshot folder (``..._August_2014``)."""
    p = F.col(path) if isinstance(path, str) else path
    month = month_number(_part(p, SNAPSHOT + r"([A-Za-z]+)_(\d{4})", 1))
    year = _part(p, SNAPSHOT + r"([A-Za-z]+)_(\d{4})", 2).cast("int")
    return F.when(month.isNotNull(), F.make_date(year, month, F.lit(1)))


def snapshot_files(files: DataFrame, marker: str = "npidata_") -> DataFrame:
    """(path, month) of the monthly main files; ``marker`` ``pl_pfile_`` finds
    the secondary-location files."""
    p = F.col("path")
    return (files.where(p.contains(SNAPSHOT) & p.contains(marker) & ~p.contains("Weekly")
                        & ~p.contains("eader"))
            .withColumn("month", snapshot_month("path")))


def _week_day(path: Column, group: int) -> Column:
    text = _part(path, SNAPSHOT + r"(\d{6,8})_(\d{6,8})", group)
    return F.coalesce(F.try_to_date(text, "MMddyy"), F.try_to_date(text, "yyyyMMdd"))


def week_start(path: str) -> Column:
    """First day of the week a weekly file's path names."""
    return _week_day(F.col(path), 1)


def weekly_files(files: DataFrame) -> DataFrame:
    """(path, week start, week end) of the weekly files."""
    p = F.col("path")
    return (files.where(p.contains(SNAPSHOT) & p.contains("npidata_") & p.contains("Weekly")
                        & ~p.contains("eader"))
            .withColumn("week", week_start("path")).withColumn("week_end", _week_day(p, 2)))


def weekly_updates(files: DataFrame) -> DataFrame:
    """Weekly files that end after the day the last monthly file covers."""
    last = snapshot_files(files).select(
        F.try_to_date(_part(F.col("path"), r"npidata_[a-z_]*\d{8}-(\d{8})", 1), "yyyyMMdd")
        .alias("d")).agg(F.max("d"))
    return weekly_files(files).where(F.col("week_end") > last.scalar())


def single_variable_files(files: DataFrame, variable: str) -> DataFrame:
    """(path, month) of one-variable files named ``<variable><year><month>``."""
    pat = rf"/{variable}(\d{{4}})(\d{{1,2}})\.[A-Za-z]+$"
    y, m = _part(F.col("path"), pat, 1).cast("int"), _part(F.col("path"), pat, 2).cast("int")
    return (files.withColumn("month", F.when(m.isNotNull(), F.make_date(y, m, F.lit(1))))
            .where(F.col("month").isNotNull()))


def locate(single: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One file per month: the single-variable file where there is one."""
    both = (single.select("path", "month").withColumn("rank", F.lit(0))
            .unionByName(snapshot.select("path", "month").withColumn("rank", F.lit(1))))
    return (both.groupBy("month").agg(F.min(F.struct("rank", "path")).alias("__b"))
            .select("month", "__b.path", "__b.rank"))


def read_text_table(spark: SparkSession, paths: Sequence[str] | str, sep: str = ",",
                    header: bool = True, names: Sequence[str] | None = None,
                    drop_bad_lines: bool = False, keep_bad_lines: bool = False) -> DataFrame:
    """Delimited text, every column a string (leading zeros survive, and the
    words NA and NULL stay words; only an empty field is null).

    With ``keep_bad_lines`` (which needs ``names``) a line with too few or too
    many fields stays, whole, in ``BAD_LINE``, which is null for all others.
    """
    reader = (spark.read.option("sep", sep).option("quote", '"').option("escape", '"')
              .option("header", str(header).lower()))
    if drop_bad_lines:
        # a line is judged by all its fields, not by the ones a query needs
        reader = reader.option("mode", "DROPMALFORMED").option("columnPruning", "false")
    if keep_bad_lines:
        reader = (reader.option("mode", "PERMISSIVE").option("columnPruning", "false")
                  .option("columnNameOfCorruptRecord", BAD_LINE))
        names = [*names, BAD_LINE]
    if names is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    # with a header and names, the header line of every file is passed over
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def rename_map(columns: Sequence[str], names: Mapping[str, str]) -> dict[str, str]:
    """Map the columns found to canonical names; case and outer spaces do not
    matter. A canonical name is given once, to the first column that earns it."""
    known = {k.strip().lower(): v for k, v in names.items()}
    taken: set[str] = set()
    out = {}
    for c in columns:
        target = known.get(c.strip().lower())
        if target and target not in taken:
            out[c] = target
            taken.add(target)
    return out


def harmonize(df: DataFrame, names: Mapping[str, str],
              wanted: Sequence[str] | None = None) -> DataFrame:
    """Canonical columns only, and of those the wanted ones that exist."""
    mapping = rename_map(df.columns, names)
    picked = [(c, n) for c, n in mapping.items() if wanted is None or n in wanted]
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in picked])


def union_vintages(frames: Sequence[DataFrame]) -> DataFrame:
    """One frame from files whose columns differ; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _column_names(header: str, sep: str) -> tuple[str, ...]:
    """A header line's columns; a name that repeats gets its place, a blank
    one a name of its own."""
    fields = next(csv.reader([header.lstrip("\ufeff")], delimiter=sep), [])
    lower = [f.lower() for f in fields]
    return tuple(f"_c{i}" if not f else f"{f}{i}" if lower.count(f.lower()) > 1 else f
                 for i, f in enumerate(fields))


def first_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` lines of a landed file, as ``value``. A text scan would
    split a long file, and which of its pieces comes first is then open, so
    the file is streamed whole, and only as far as the lines go."""
    whole = (spark.read.schema("value string").option("multiLine", "true")
             .option("sep", "\u0001").option("quote", ""))
    return whole.csv(path).limit(n)


def header_catalogue(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[str, tuple]:
    """The columns each file's header names. Only first lines are read, all in
    one job for every ``LOT`` files; the layout of files, not data."""
    out = {}
    for at in range(0, len(paths), LOT):
        lot = paths[at:at + LOT]
        lines = [first_lines(spark, p, 1).select(F.lit(i).alias("i"), "value") for i, p in enumerate(lot)]
        for r in reduce(lambda a, b: a.unionByName(b), lines).collect():
            out[lot[r["i"]]] = _column_names(r["value"], sep)
    return out


def read_groups(spark: SparkSession, paths: Sequence[str], sep: str = ",",
                drop_bad_lines: bool = False, keep_bad_lines: bool = False) -> list[DataFrame]:
    """One multi-path scan per header among the files, each with ``__path``,
    the file a row came from."""
    groups: dict[tuple, list[str]] = {}
    for path, names in header_catalogue(spark, paths, sep).items():
        groups.setdefault(names, []).append(path)
    return [with_path(read_text_table(spark, files, sep, names=names, drop_bad_lines=drop_bad_lines,
                                      keep_bad_lines=keep_bad_lines))
            for names, files in sorted(groups.items())]


def with_path(df: DataFrame) -> DataFrame:
    """``__path``: the landed file (a folder of parts named like a file is that
    file), as it is listed."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    named = F.nullif(F.regexp_extract(path, r"^(.*?\.(?:csv|txt|dta))(?:/|$)", 1), F.lit(""))
    return df.withColumn("__path", F.coalesce(named, path))


def read_stata(spark: SparkSession, paths: Sequence[str] | str, columns: Sequence[str],
               schema: T.StructType, chunk: int = 500_000) -> DataFrame:
    """Stata files, one task per file, handed on in chunks."""
    files = (spark.read.format("binaryFile").load(
        list(paths) if not isinstance(paths, str) else paths).select("path", "content"))
    cols = list(columns)
    names = schema.fieldNames()

    def decode(batches):
        import io

        import pandas as pd
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with pd.read_stata(io.BytesIO(content), columns=cols, chunksize=chunk,
                                   convert_categoricals=False) as reader:
                    for part in reader:
                        part = part.assign(path=path) if "path" in names else part
                        yield part[names]

    return files.mapInPandas(decode, schema)
