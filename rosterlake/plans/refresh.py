"""Building and refreshing month-partitioned panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake import schemas as S
from rosterlake.functions.dates import month_start
from rosterlake.operators.joins import anti_join, with_group_stats
from rosterlake.operators.quality import require_id, require_update
from rosterlake.operators.rows import replace_tail
from rosterlake.session import cut
from rosterlake.sources.panels import read_months, read_panel, read_weeks, write_panel


def panel_keys(columns: Sequence[str]) -> list[str]:
    return [c for c in ("npi", "month", "seq") if c in columns]


def fold_weeks(weekly: DataFrame, value: str) -> DataFrame:
    """Per provider and month the values of the latest week that has any; its
    slots replace those of all earlier weeks."""
    rows = weekly.where(F.col(value).isNotNull() & F.col("npi").isNotNull()).withColumn(
        "month", month_start("week"))
    keys = panel_keys(rows.columns)
    latest = with_group_stats(rows, ["npi", "month"], __week=F.max("week"))
    return (latest.where(F.col("week") == F.col("__week")).groupBy(*keys)
            .agg(F.max(value).alias(value)))


def with_weeks(monthly: DataFrame, weekly: DataFrame, value: str) -> DataFrame:
    """Monthly rows, those of a provider and month seen in a weekly file
    replaced by its folded rows."""
    new = cut(fold_weeks(weekly, value))
    kept = anti_join(monthly, new.select("npi", "month").distinct(), on=["npi", "month"])
    return kept.unionByName(new.select(*monthly.columns))


def refreshed(old: DataFrame, remade: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """The stored panel with its tail replaced by the rebuilt months, after an
    audit of what the rebuild would lose."""
    keys = panel_keys(old.columns)
    first = remade.agg(F.min("month")).scalar()
    require_update(old.where(F.col("month") >= first), remade, keys, tolerance)
    out = require_id(replace_tail(old, remade), keys)
    return out.where(F.col("month") != F.lit(S.BAD_MONTH).cast("date"))


def rebuilt_months(spark: SparkSession, folder: str, variable: str,
                   since: str | None = None) -> DataFrame:
    """Landed months of a variable, with the weekly files on top."""
    monthly = read_months(spark, folder, variable, since)
    weekly = read_weeks(spark, folder, variable)
    return monthly if weekly is None else with_weeks(monthly, weekly, variable)


def refresh_variable(spark: SparkSession, folder: str, root: str, variable: str,
                     update: bool = True, window_months: int = 6) -> None:
    """Make a panel anew, or rebuild its last months and write only those.

    The rebuild is written out before the audit, so nothing is read while the
    months are replaced.
    """
    if not update:
        write_panel(require_id(cut(rebuilt_months(spark, folder, variable)),
                               panel_keys(S.panel_schema(variable).fieldNames())),
                    root, variable, replace=True)
        return
    old = read_panel(spark, root, variable)
    since = old.agg(F.add_months(F.max("month"), -window_months)).first()[0]
    remade = cut(rebuilt_months(spark, folder, variable, str(since)))
    keys = panel_keys(remade.columns)
    first = remade.agg(F.min("month")).scalar()
    require_update(old.where(F.col("month") >= first), remade, keys)
    require_id(remade, keys)
    write_panel(remade.select(*S.panel_schema(variable).fieldNames()), root, variable)


def refresh(spark: SparkSession, folder: str, root: str, include: Sequence[str] = (),
            exclude: Sequence[str] = (), update: bool = True) -> list[str]:
    """Refresh all variables, or the included, or all but the excluded."""
    if include and exclude:
        raise ValueError("give either include or exclude")
    chosen = list(include) or [v for v in S.PANEL_VARIABLES
                               if v not in set(exclude) and v not in S.SECONDARY_HEADERS]
    for variable in chosen:
        refresh_variable(spark, folder, root, variable, update)
    return chosen
