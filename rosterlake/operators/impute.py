"""Filling gaps from values that are consistent within a key, and repairs.

Blank text is null throughout. Every fill is one aggregate per key (combined
on the map side) joined back, never a whole key in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterlake.functions.text import directory_phone, pad_zip
from rosterlake.operators.joins import join_group_stats, natural_join, with_group_stats
from rosterlake.operators.rows import modes
from rosterlake.session import cut


def _filled(ids: Sequence[str], may_be_null: Iterable[str] = ()) -> Column:
    return reduce(lambda a, b: a & b,
                  [F.col(i).isNotNull() for i in ids if i not in set(may_be_null)],
                  F.lit(True))


def consistent_value(df: DataFrame, ids: Sequence[str], target: str,
                     blank_ids: Sequence[str] = ()) -> DataFrame:
    """Ids with exactly one known value of ``target``, and that value.

    Rows with a null id do not count, except for ``blank_ids``: columns where
    a blank is an ordinary value.
    """
    known = df.where(_filled(ids, blank_ids) & F.col(target).isNotNull())
    return (known.groupBy(*ids)
            .agg(F.min(target).alias("__lo"), F.max(target).alias(target))
            .where(F.col("__lo") == F.col(target)).drop("__lo"))


def consistent_tuple(df: DataFrame, ids: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Ids (nulls allowed) with exactly one distinct tuple among the tuples
    that hold anything at all."""
    known = reduce(lambda a, b: a | b, [F.col(t).isNotNull() for t in targets])
    packed = F.struct(*targets)
    one = (df.where(known).groupBy(*ids)
           .agg(F.min(packed).alias("__lo"), F.max(packed).alias("__hi"))
           .where(F.col("__lo").eqNullSafe(F.col("__hi"))))
    return one.select(*ids, *[F.col(f"__hi.{t}").alias(t) for t in targets])


def _blank(targets: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(t).isNull() for t in targets])


def fill_from(df: DataFrame, lookup: DataFrame, ids: Sequence[str],
              split: bool = False) -> DataFrame:
    """Replace blanks by the lookup's value for the same ids (nulls match).
    For ``split`` see ``batch_fill``."""
    targets = [c for c in lookup.columns if c not in ids]
    renamed = lookup.withColumnsRenamed({t: f"__fill_{t}" for t in targets})
    joined = join_group_stats(df.where(_blank(targets)) if split else df, renamed, ids)
    out = joined.select(*[F.coalesce(F.col(c), F.col(f"__fill_{c}")).alias(c)
                          if c in targets else F.col(c) for c in df.columns])
    return out.unionByName(df.where(~_blank(targets))) if split else out


def batch_fill(df: DataFrame, ids: Sequence[str], targets: Sequence[str],
               blank_ids: Sequence[str] = (), distinct: bool = True,
               split: bool = False) -> DataFrame:
    """Fill several columns from consistent values within ``ids``.

    All targets share one aggregate; that equals filling them one after the
    other because no target is an id. With ``split`` only rows with a blank to
    fill, and keys that have one, meet in the join; all others pass by. ``df``
    is then read three times, so it should be a written table.
    """
    if set(ids) & set(targets):
        raise ValueError("a filled column cannot be an id")
    usable = _filled(ids, blank_ids)
    todo = usable & _blank(targets)
    bounds = {}
    for i, t in enumerate(targets):
        bounds[f"__lo{i}"], bounds[f"__hi{i}"] = F.min(t), F.max(t)
    if split:
        stats = (df.where(usable).groupBy(*ids)
                 .agg(F.max(todo).alias("__todo"), *[c.alias(n) for n, c in bounds.items()])
                 .where("__todo").drop("__todo"))
        joined = join_group_stats(df.where(todo), stats, ids)
    else:
        joined = with_group_stats(df, ids, **bounds)
    new = {}
    for i, t in enumerate(targets):
        one = usable & (F.col(f"__lo{i}") == F.col(f"__hi{i}"))
        new[t] = F.coalesce(F.col(t), F.when(one, F.col(f"__hi{i}")))
    out = joined.withColumns(new).select(*df.columns)
    if split:
        out = out.unionByName(df.where(~todo))
    return out.distinct() if distinct else out


def fill_beside(df: DataFrame, ids: Sequence[str], targets: Sequence[str],
                blank_ids: Sequence[str] = ()) -> DataFrame:
    """``batch_fill`` as a window, copies kept: for rows laid by some of ``ids``
    already, of which no key is large. Costs a sort, and none if they lie so."""
    usable, key = _filled(ids, blank_ids), Window.partitionBy(*ids)
    new = {}
    for t in targets:
        hi = F.max(t).over(key)
        new[t] = F.coalesce(F.col(t), F.when(usable & (F.min(t).over(key) == hi), hi))
    return df.withColumns(new)


def fill_tuple_beside(df: DataFrame, ids: Sequence[str], targets: Sequence[str],
                      where: Column | None = None) -> DataFrame:
    """``fill_from`` the ``consistent_tuple`` as a window, as in ``fill_beside``;
    rows outside ``where`` stay as they are."""
    known = reduce(lambda a, b: a | b, [F.col(t).isNotNull() for t in targets])
    packed, key = F.when(known, F.struct(*targets)), Window.partitionBy(*ids)
    lo, hi = F.min(packed).over(key), F.max(packed).over(key)
    found = F.when(lo.eqNullSafe(hi) & (F.lit(True) if where is None else where), hi)
    met = df.withColumn("__tuple", found)
    return met.withColumns({t: F.coalesce(F.col(t), F.col(f"__tuple.{t}")) for t in targets}).drop("__tuple")


def purge_nulls(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Drop a null row only where its key has a value elsewhere."""
    seen = with_group_stats(df, keys, __known=F.max(F.col(column).isNotNull()))
    return seen.where(F.col(column).isNotNull() | ~F.col("__known")).drop("__known")


def purge_symbols(df: DataFrame, columns: Sequence[str], symbols: Sequence[str],
                  keys: Sequence[str]) -> DataFrame:
    """Drop rows with an odd symbol where the key has a row without it.

    The rule runs symbol by symbol, column by column, and each pass sees what
    the pass before left. A row enters only through the set of tests it fails,
    so a key is judged on its distinct failure masks: at most two to the
    number of tests, however many rows it has.
    """
    tests = [(c, s) for s in symbols for c in columns]
    mask = reduce(lambda a, b: a + b, [
        F.when(F.col(c).contains(s), 1 << i).otherwise(0)
        for i, (c, s) in enumerate(tests)])

    def narrow(alive: Column, bit: Column) -> Column:
        clean = F.filter(alive, lambda m: m.bitwiseAND(bit) == 0)
        return F.when(F.size(clean) > 0, clean).otherwise(alive)

    alive = F.aggregate(F.array(*[F.lit(1 << i) for i in range(len(tests))]),
                        F.collect_set("__mask"), narrow)
    masked = df.withColumn("__mask", mask)
    return (with_group_stats(masked, keys, __alive=alive)
            .where(F.array_contains("__alive", F.col("__mask")))
            .select(*df.columns))


def repair_zips(df: DataFrame, zip_col: str = "zip", state: str = "state",
                group: str = "group_id") -> DataFrame:
    """Put back lost leading zeros: one by state, two where the same group
    also lists the padded ZIP."""
    padded = cut(df.withColumn(zip_col, pad_zip(zip_col, state)))
    listed = padded.select(group, zip_col).where(F.col(group).isNotNull()).distinct()
    short = (listed.where(F.length(zip_col).isin(3, 7))
             .withColumn("__padded", F.concat(F.lit("00"), F.col(zip_col))))
    confirmed = natural_join(short, listed.withColumnRenamed(zip_col, "__padded"),
                             on=[group, "__padded"], null_equal=False)
    # only short ZIPs meet in the join, all others pass by
    short_row = F.coalesce(F.length(zip_col).isin(3, 7), F.lit(False))
    fixed = (natural_join(padded.where(short_row), confirmed, "left", on=[group, zip_col],
                          null_equal=False)
             .withColumn(zip_col, F.coalesce("__padded", F.col(zip_col)))
             .select(*df.columns))
    return fixed.unionByName(padded.where(~short_row))


def repair_phones(df: DataFrame, npi: str = "npi", date: str = "date",
                  group: str = "group_id", state: str = "state", zip_col: str = "zip",
                  phone: str = "phone") -> DataFrame:
    """Clean phones, then fill blanks that have exactly one known number: by
    person and place first, then by date and place. Null ids match."""
    out = df.withColumn(phone, directory_phone(phone))
    for lead in (npi, date):
        ids = [lead, group, state, zip_col]
        out = batch_fill(cut(out), ids, [phone], blank_ids=ids, distinct=False, split=True)
    return out


def blank_orgs(df: DataFrame, org: str = "org_name") -> DataFrame:
    return df.withColumn(org, F.nullif(F.col(org), F.lit(" ")))


def fill_by_mode(df: DataFrame, key: str, target: str, min_count: int = 150) -> DataFrame:
    """Fill a blank target from its key's most frequent value.

    Only values seen more than ``min_count`` times count, ties are all kept
    (so a filled row can double), keys without such a value keep their rows
    with the target emptied where the row does not survive the lookup.
    """
    known = df.where(F.col(target).isNotNull() & F.col(key).isNotNull())
    top = (modes(known, [key], target, min_count)
           .select(key, F.col(target).alias("__top")))
    joined = join_group_stats(df, top, [key])
    return (joined.withColumn(target, F.when(F.col("__top").isNotNull(), F.coalesce(
        F.col(target), F.col("__top")))).drop("__top").distinct())


def backfill_periods(df: DataFrame, pairs: Sequence[tuple[str, str]],
                     period: str = "quarter") -> DataFrame:
    """Copy the rows of listed source periods to missing target periods.

    Each pair is ``(source, target)``; one pass makes all the copies.
    """
    copies = F.array(F.col(period), *[
        F.when(F.col(period) == F.lit(s).cast("date"), F.lit(t).cast("date"))
        for s, t in pairs])
    return df.withColumn(period, F.explode(F.array_compact(copies)))
