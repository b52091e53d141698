"""Registry panels: one month-partitioned dataset per variable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rosterlake import schemas as S
from rosterlake.operators.joins import semi_join
from rosterlake.operators.quality import value_or_error
from rosterlake.operators.reshape import slots_to_long
from rosterlake.operators.rows import sequence_in_group
from rosterlake.sources.files import (harmonize, list_files, locate, paths_of, read_groups,
                                      read_stata, read_text_table, single_variable_files,
                                      snapshot_files, snapshot_month, union_vintages, week_start,
                                      weekly_updates, whole_files)


def read_panel(spark: SparkSession, root: str, variable: str,
               npis: DataFrame | None = None) -> DataFrame:
    """A panel, for listed ids only when ``npis`` is given."""
    panel = spark.read.schema(S.panel_schema(variable)).parquet(f"{root}/{variable}")
    if npis is None:
        return panel
    return semi_join(panel, npis.select("npi").distinct(), on=["npi"], null_equal=False)


def write_panel(panel: DataFrame, root: str, variable: str, replace: bool = False) -> None:
    """Write months; months not in the frame stay unless the whole dataset is
    replaced. Rows are spread so that a big month becomes several files."""
    (panel.hint("rebalance", "month").write.mode("overwrite")
     .option("partitionOverwriteMode", "static" if replace else "dynamic").partitionBy("month")
     .parquet(f"{root}/{variable}"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def months_with_code(panel: DataFrame, code: str = S.STUDENT_CODE) -> DataFrame:
    """(npi, month) of everyone holding the code; the filter reaches the scan."""
    return panel.where(F.col("ptaxcode") == code).select("npi", "month")


def typed(c: Column, variable: str) -> Column:
    """Text to the variable's type. Snapshots write dates month first.

    Blank text is null; any other text that is no value of the type ends the
    job, so no value is lost without a word.
    """
    kind = S.variable_type(variable).simpleString()
    if kind == "string":
        return c
    value = (F.coalesce(F.try_to_date(c, "MM/dd/yyyy"), F.try_to_date(c, "yyyy-MM-dd"))
             if kind == "date" else c.try_cast(kind))
    return value_or_error(c, value, f"{variable} as {kind}")


def snapshot_to_panel(wide: DataFrame, variable: str,
                      period: Mapping[str, Column] | None = None) -> DataFrame:
    """One variable of a wide snapshot as panel rows. Repeated slots become
    rows with ``seq``; their empty slots make no row. Secondary-location files
    number a provider's rows."""
    when = period or {}
    base = wide.select("*", *[c.alias(n) for n, c in when.items()])
    keep = ["npi", *when]
    base = base.withColumn("npi", F.col("NPI").cast("long"))
    if variable in S.SLOT_STEMS:
        slots = [h for h in S.headers_of(variable) if h in base.columns]
        out = slots_to_long(base, keep, slots, variable)
    elif variable in S.SECONDARY_HEADERS:
        # numbered by the whole row, so that all six variables share a number
        heads = {v: h for v, h in S.SECONDARY_HEADERS.items() if h in base.columns}
        rows = base.select(*keep, *[F.col(f"`{h}`").alias(v) for v, h in heads.items()])
        out = sequence_in_group(rows, keep, list(heads), "seq").select(*keep, "seq", variable)
    else:
        header = S.headers_of(variable)[0]
        out = base.select(*keep, F.col(f"`{header}`").alias(variable))
    return out.withColumn(variable, typed(F.col(variable), variable))


def read_snapshots(spark: SparkSession, paths: Sequence[str], variable: str,
                   period: Mapping[str, Column]) -> DataFrame:
    """Wide files, one scan per header among them, pruned to the variable's columns; a
    secondary location needs its whole row for its number."""
    heads = (list(S.SECONDARY_HEADERS.values()) if variable in S.SECONDARY_HEADERS
             else S.headers_of(variable))
    names = {h: h for h in ["NPI", *heads]} | {"__path": "__path"}
    wide = union_vintages([harmonize(df, names) for df in read_groups(spark, list(paths))])
    return snapshot_to_panel(wide, variable, period).drop("__path")


def _one_variable_file(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """A file that holds one variable, already long, as text or Stata."""
    if path.endswith(".dta"):
        numbered = ", seq int" if S.is_multi(variable) else ""
        low = variable.lower() if variable.isupper() else variable
        schema = T.StructType.fromDDL(f"npi long{numbered}, {low} string")
        table = read_stata(spark, path, schema.fieldNames(), schema)
    else:
        table = read_text_table(spark, path)
    low = {c.lower(): c for c in table.columns}
    cols = [F.col(low["npi"]).cast("long").alias("npi")]
    if "seq" in low:
        cols.append(F.col(low["seq"]).cast("int").alias("seq"))
    return table.select(*cols, typed(F.col(low[variable.lower()]), variable).alias(variable))


def read_months(spark: SparkSession, folder: str, variable: str,
                since: str | None = None) -> DataFrame:
    """All landed months of a variable (optionally from a month on)."""
    files = whole_files(list_files(spark, folder))
    marker = "pl_pfile_" if variable in S.SECONDARY_HEADERS else "npidata_"
    chosen = locate(single_variable_files(files, variable), snapshot_files(files, marker))
    chosen = chosen.where(F.col("month") != F.lit(S.BAD_MONTH).cast("date"))
    if since:
        chosen = chosen.where(F.col("month") >= F.lit(since).cast("date"))
    wide_paths = paths_of(chosen.where("rank = 1"))
    frames = []
    if wide_paths:
        frames.append(read_snapshots(spark, wide_paths, variable,
                                     {"month": snapshot_month("__path")}))
    for r in chosen.where("rank = 0").collect():
        frames.append(_one_variable_file(spark, r["path"], variable)
                      .withColumn("month", F.lit(r["month"]).cast("date")))
    if not frames:
        raise FileNotFoundError(f"no landed files hold {variable} under {folder}")
    return union_vintages(frames)


def read_weeks(spark: SparkSession, folder: str, variable: str) -> DataFrame | None:
    """Rows of the weekly files that go beyond the last month, with ``week``."""
    updates = paths_of(weekly_updates(whole_files(list_files(spark, folder))))
    if not updates:
        return None
    return read_snapshots(spark, updates, variable, {"week": week_start("__path")})
