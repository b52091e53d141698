"""Row selection, ordering and numbering without whole-key windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterlake.operators.joins import join_group_stats, natural_join, with_group_stats
from rosterlake.session import cut


def only_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once; every copy of a repeated key goes.

    A key seen once is its own minimum, so one aggregation does it all.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.first(c).alias(c) for c in rest]
    return df.groupBy(*keys).agg(*aggs).where("__n = 1").select(*df.columns)


def only_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return (with_group_stats(df, list(keys), __n=F.count(F.lit(1)))
            .where("__n > 1").drop("__n"))


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              last: bool = False) -> DataFrame:
    """One whole row per key, first (or last) by ``order``.

    ``order`` is completed with the remaining columns so that the choice does
    not depend on arrival.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*order, *rest)
    pick = (F.max if last else F.min)(packed).alias("__row")
    out = df.groupBy(*keys).agg(pick)
    return out.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c)
                        for c in df.columns])


def last_non_null(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  columns: Sequence[str], first: bool = False) -> DataFrame:
    """Per key and column the last (or first) value that is not null.

    Columns are decided one by one, so the result may combine rows. ``order``
    must decide ties; equal order values fall back to the value itself.
    """
    keys = list(keys)
    # an extreme of tuples, as rows that come twice change nothing to it: a
    # distinct or an outer join below that only repeats rows is then left out
    pick = F.min if first else F.max
    aggs = [pick(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("__value"))))
            .getField("__value").alias(c) for c in columns]
    return df.where(_not_null(keys)).groupBy(*keys).agg(*aggs)


def _not_null(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def rows_at_extreme(df: DataFrame, keys: Sequence[str], measure: str,
                    largest: bool = True) -> DataFrame:
    """Rows holding their key's largest (or smallest) value; ties kept."""
    best = (F.max if largest else F.min)(measure)
    return (with_group_stats(df, list(keys), __best=best)
            .where(F.col(measure) == F.col("__best")).drop("__best"))


def modes(df: DataFrame, keys: Sequence[str], value: str, min_count: int = 0) -> DataFrame:
    """Most frequent value(s) per key, ties kept, above a support threshold."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return rows_at_extreme(counts, keys, "n").where(F.col("n") > min_count)


def frequent_values(df: DataFrame, value: str, more_than: int) -> DataFrame:
    """Rows whose value occurs more than ``more_than`` times."""
    return (with_group_stats(df, [value], __n=F.count(F.lit(1)))
            .where(F.col("__n") > more_than).drop("__n"))


def _sorted_slices(df: DataFrame, order: Sequence[Column | str], distinct: bool = False
                   ) -> DataFrame:
    """Range-partitioned, sorted, numbered and written; ``__slice`` and
    ``__pos`` say where each row lies. A hot key is spread over several slices
    as long as the order columns tell its rows apart. The numbers are written
    with the rows, so a rerun of a later step sees the same ones. With
    ``distinct`` rows that come twice meet in their slice and count once."""
    laid = df.repartitionByRange(*order)
    laid = ((laid.distinct() if distinct else laid).sortWithinPartitions(*order)
            .withColumn("__mark", F.monotonically_increasing_id()))
    return (cut(laid).withColumn("__slice", F.shiftright("__mark", 33))
            .withColumn("__pos", F.col("__mark").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__mark"))


def surrogate_id(df: DataFrame, order: Sequence[str], out: str, offset: int = 0,
                 distinct: bool = False) -> DataFrame:
    """Dense ids 0, 1, 2 ... (+ ``offset``) in ``order``, with no global window.

    Only one count per slice is ordered in a single task. ``distinct`` numbers
    the distinct rows in one move, where few rows come twice and ``order`` has
    all columns.
    """
    slices = _sorted_slices(df, order, distinct)
    sizes = slices.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__slice", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__start"))
    # one row per slice, so the table stays at the partition count
    joined = slices.join(F.broadcast(starts), "__slice")
    return joined.select(*df.columns,
                         (F.col("__start") + F.col("__pos") + F.lit(offset)).alias(out))


def sequence_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                      out: str = "seq") -> DataFrame:
    """1, 2, 3 ... within each key by ``order``.

    A key that crosses slices is numbered slice by slice; only those keys, at
    most one per slice boundary, need offsets.
    """
    keys = list(keys)
    slices = _sorted_slices(df, [*keys, *order])
    parts = slices.groupBy("__slice", *keys).agg(F.count(F.lit(1)).alias("__n"),
                                                F.min("__pos").alias("__base"))
    crossing = parts.groupBy(*keys).agg(
        F.when(F.count(F.lit(1)) > 1, F.sort_array(F.collect_list(
            F.struct("__slice", "__n")))).alias("__runs"))
    before = F.aggregate(
        F.filter("__runs", lambda r: r["__slice"] < F.col("__slice")),
        F.lit(0).cast("long"), lambda acc, r: acc + r["__n"])
    starts = natural_join(parts, crossing, on=keys).select(
        "__slice", *keys, (F.coalesce(before, F.lit(0)) - F.col("__base")).alias("__shift"))
    joined = join_group_stats(slices, starts, ["__slice", *keys])
    return joined.select(*df.columns,
                         (F.col("__pos") + F.col("__shift") + 1).cast("int").alias(out))


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Exact quantile edges by linear interpolation, from sorted value counts.

    Only the counted values next to an edge leave the cluster: at most two per
    edge.
    """
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(F.col(column).cast("double").alias("v"))
              .agg(F.count(F.lit(1)).alias("n")))
    slices = _sorted_slices(counts, ["v"])
    sizes = slices.groupBy("__slice").agg(F.sum("n").alias("__n"))
    up_to = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__slice", F.coalesce(F.sum("__n").over(up_to), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__slice").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run = (slices.join(F.broadcast(starts), "__slice")
           .withColumn("hi", F.sum("n").over(inside) + F.col("__start") - 1)
           .withColumn("lo", F.col("hi") - F.col("n") + 1))
    run = cut(run.select("v", "lo", "hi"))
    top = run.agg(F.max("hi")).first()[0]
    if top is None:
        return []
    wanted = [(top * i) / bins for i in range(bins + 1)]
    ranks = sorted({int(w) for w in wanted} | {min(int(w) + 1, top) for w in wanted})
    hit = F.lit(False)
    for r in ranks:
        hit = hit | ((F.col("lo") <= r) & (F.col("hi") >= r))
    found = [(r.v, r.lo, r.hi) for r in run.where(hit).collect()]
    at = {r: next(v for v, lo, hi in found if lo <= r <= hi) for r in ranks}
    edges = []
    for w in wanted:
        low = int(w)
        a, b = at[low], at[min(low + 1, top)]
        edges.append(a + (b - a) * (w - low))
    return edges


def quantile_bins(df: DataFrame, column: str, bins: int, out: str) -> DataFrame:
    """Exact quantile bins ``(a, b]``, the lowest value included: bin number
    and its bounds. Repeated edges are an error."""
    edges = quantile_edges(df, column, bins)
    if len(set(edges)) != len(edges):
        raise ValueError(f"bin edges of {column} are not unique")
    c = F.col(column).cast("double")
    number, lo, hi = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for i in range(len(edges) - 1, 0, -1):
        inside = c <= edges[i]
        number = F.when(inside, F.lit(i)).otherwise(number)
        lo = F.when(inside, F.lit(edges[i - 1])).otherwise(lo)
        hi = F.when(inside, F.lit(edges[i])).otherwise(hi)
    return df.withColumn(out, number).withColumn(f"{out}_lo", lo).withColumn(f"{out}_hi", hi)


def replace_tail(old: DataFrame, new: DataFrame, time: str = "month") -> DataFrame:
    """Old rows from before the new frame's first period, then the new rows."""
    first = new.agg(F.min(time).alias("__first"))
    kept = old.where(F.col(time) < first.scalar())
    return kept.unionByName(new)
