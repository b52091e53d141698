"""Joins whose rules differ from Spark's: null keys match, keys are implied.

Every helper plans as an ordinary equi-join, so Spark chooses the strategy and
its own size check decides whether a side is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.functions.dates import month_start
from rosterlake.session import cut

_R = "__right_"
_SET = ["__set0", "__set1", "__set2"]
_SPREAD = "__spread"


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in set(right.columns)]


def _null_safe(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(_R + k)) for k in keys])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner",
                 on: Sequence[str] | None = None, null_equal: bool = True) -> DataFrame:
    """Join on all shared columns (or ``on``); null keys equal each other.

    Pass ``null_equal=False`` where the keys hold no nulls: that lets Spark
    drop null rows early and match bucketed layouts.
    """
    keys = list(on) if on is not None else common_columns(left, right)
    if not keys:
        raise ValueError("no shared columns to join on")
    if how in ("left_semi", "left_anti") and not null_equal:
        return left.join(right.select(*keys), keys, how)
    if not null_equal:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({k: _R + k for k in keys})
    joined = left.join(renamed, _null_safe(keys), how)
    if how in ("left_semi", "left_anti"):
        return joined
    side = {"right": lambda k: F.col(_R + k),
            "right_outer": lambda k: F.col(_R + k)}.get(how)
    if side is None:
        outer = how in ("outer", "full", "full_outer", "fullouter")
        side = ((lambda k: F.coalesce(F.col(k), F.col(_R + k))) if outer
                else (lambda k: F.col(k)))
    rest = [c for c in right.columns if c not in keys]
    clash = set(rest) & set(left.columns)
    if clash:
        raise ValueError(f"ambiguous columns {sorted(clash)}; rename or add to the keys")
    return joined.select(*[side(c).alias(c) if c in keys else F.col(c)
                           for c in left.columns], *rest)


def natural_join_all(frames: Sequence[DataFrame], how: str = "inner") -> DataFrame:
    """Chain of natural joins, left to right."""
    return reduce(lambda a, b: natural_join(a, b, how), frames)


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None,
              null_equal: bool = True, spread: bool = True) -> DataFrame:
    """Rows of ``left`` without a partner. See ``join_group_stats`` for
    ``spread``; turn it off to use bucketed layouts."""
    return _filter_join(left, right, "left_anti", on, null_equal, spread)


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None,
              null_equal: bool = True, spread: bool = True) -> DataFrame:
    """Rows of ``left`` with a partner; options as in ``anti_join``."""
    return _filter_join(left, right, "left_semi", on, null_equal, spread)


def _filter_join(left: DataFrame, right: DataFrame, how: str, on: Sequence[str] | None,
                 null_equal: bool, spread: bool) -> DataFrame:
    keys = list(on) if on is not None else common_columns(left, right)
    if not spread:
        return natural_join(left, right, how, keys, null_equal)
    return join_group_stats(left, right.select(*keys), keys, how, null_equal)


def renamed_key_join(left: DataFrame, right: DataFrame, pairs: Mapping[str, str],
                     how: str = "inner") -> DataFrame:
    """Equi-join on differently named keys; the right names are dropped."""
    return natural_join(left, right.withColumnsRenamed({r: le for le, r in pairs.items()}),
                        how, on=list(pairs))


def provenance_join(left: DataFrame, right: DataFrame,
                    on: Sequence[str] | None = None, how: str = "outer") -> DataFrame:
    """Outer join that says which side each row came from, in ``_merge``."""
    keys = list(on) if on is not None else common_columns(left, right)
    out = natural_join(left.withColumn("__l", F.lit(1)),
                       right.withColumn("__r", F.lit(1)), how, on=keys)
    mark = (F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), "both")
            .when(F.col("__l").isNotNull(), "left_only").otherwise("right_only"))
    return out.withColumn("_merge", mark).drop("__l", "__r")


def join_group_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str],
                     how: str = "left", null_equal: bool = True) -> DataFrame:
    """Join per-key results back to their rows.

    The aggregate is already partitioned by its keys, and reusing that layout
    would keep Spark's skew-join rule from splitting a hot key. One more key,
    always zero, puts a fresh exchange on both sides, so a key that holds a
    large share of the rows is read by many tasks.
    """
    zero = F.pmod(F.xxhash64(keys[0]), F.lit(1))
    return natural_join(df.withColumn(_SPREAD, zero), stats.withColumn(_SPREAD, zero),
                        how, on=[*keys, _SPREAD], null_equal=null_equal).drop(_SPREAD)


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Per-key aggregates on every row, as a window would give, without
    pulling a whole key into one task: combine on the map side, join back."""
    agg = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return join_group_stats(df, agg, keys)


def valid_until(panel: DataFrame, ends: DataFrame, key: str = "npi",
                time: str = "month", end: str = "npideactdate") -> DataFrame:
    """Panel rows up to the id's end date, or all where it has none."""
    joined = join_group_stats(panel, ends.select(key, end), [key], null_equal=False)
    return joined.where(F.col(end).isNull() | (F.col(time) <= F.col(end))).drop(end)


def at_or_after(left: DataFrame, right: DataFrame, key: str, later: str,
                earlier: str) -> DataFrame:
    """Pairs of one id where ``later`` is on or after ``earlier``."""
    return natural_join(left, right, on=[key], null_equal=False).where(
        F.col(later) >= F.col(earlier))


def nearest_month(targets: DataFrame, panel: DataFrame, key: str, date: str,
                  month: str) -> DataFrame:
    """Panel rows of the month closest to each target date's month; ties kept.

    The months of an id are a set bounded by the calendar, so they travel as
    one sorted array; no target-by-month pairs are made.
    """
    calendar = panel.groupBy(key).agg(F.collect_set(month).alias("__months"))
    t = targets.select(key, date).distinct().withColumn("__target", month_start(date))
    t = join_group_stats(t, calendar, [key], how="inner")
    gap = F.array_min(F.transform("__months",
                                  lambda m: F.abs(F.datediff(m, F.col("__target")))))
    t = t.withColumn("__gap", gap).withColumn(
        "__near", F.filter("__months", lambda m: F.abs(
            F.datediff(m, F.col("__target"))) == F.col("__gap")))
    t = t.select(key, date, F.col("__gap").alias("gap_days"),
                 F.explode("__near").alias(month))
    return natural_join(t, panel, on=[key, month], null_equal=False)


def _place_sets(rows: DataFrame, person: str, period: Sequence[str], place: Sequence[str]
                ) -> tuple[DataFrame, DataFrame]:
    """(person, period, set) and the places of every distinct set.

    A set is named by its size and two 64-bit sums of hashes, combined on the
    map side, so no person's places are gathered, however many. Hashes skip
    nulls, so each column's null mark is hashed too.
    """
    marks = [F.col(c).isNull() for c in place]
    people = rows.groupBy(person, *period).agg(
        F.count(F.lit(1)).alias(_SET[0]),
        F.bit_xor(F.xxhash64(*place, *marks)).alias(_SET[1]),
        F.bit_xor(F.xxhash64(F.lit("set"), *place, *marks)).alias(_SET[2]))
    places = (join_group_stats(rows, people, [person, *period], how="inner")
              .select(*period, *_SET, *place).distinct())
    return people, places


def _numbered(rows: DataFrame, person: str, period: Sequence[str], place: Sequence[str]
              ) -> DataFrame:
    """Rows with a dense number per person, in the order of one of their
    places, so those seen together have numbers close by."""
    from rosterlake.operators.rows import surrogate_id
    near = rows.groupBy(person).agg(F.min(F.xxhash64(*period, *place)).alias("__near"))
    numbered = surrogate_id(near, ["__near", person], "__no", 1).select(person, "__no")
    return join_group_stats(rows, numbered, [person], how="inner")


def _bitmaps(numbered: DataFrame, period: Sequence[str], place: Sequence[str]) -> DataFrame:
    return numbered.groupBy(*period, *place, F.bitmap_bucket_number("__no").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__no")).alias("__map"))


def place_bitmaps(rows: DataFrame, person: str, period: Sequence[str], place: Sequence[str]
                  ) -> DataFrame:
    """(period, place, ``__bucket``, ``__map``): who is seen at a place, one bit
    a person, 32,768 persons to a bucket.

    Persons get dense numbers in the order of one of their places, so those
    seen together share a bucket and a place has few, mostly one.
    """
    return _bitmaps(_numbered(rows, person, period, place), period, place)


# Others at a place up to which they travel one by one; a bitmap is 4 KB.
FEW_OTHERS = 64


def count_copresent(members: DataFrame, person: str, place: Sequence[str],
                    period: Sequence[str], focal: Column, other: Column,
                    out: str = "n_others", few: int = FEW_OTHERS) -> DataFrame:
    """Distinct other-role persons sharing any place with each focal person.

    Focal persons with the same set of places in a period are one set. A set
    of one place has that place's count. Else its crowded places (more than
    ``few`` others) are a set of their own, which many sets share: its others
    are one merged bitmap. Those at its other places come one by one, at most
    ``few`` a place, and count where that bitmap lacks them. So the rows
    between grow with the places of sets, never with pairs of persons or of
    sets, and bitmaps are made of crowded places only.
    """
    period, place = list(period), list(place)
    spot, key = [*period, *place], [*period, *_SET]
    mine, my_places = _place_sets(
        members.where(focal).select(person, *spot).distinct(), person, period, place)
    seen = cut(_numbered(members.where(other).select(person, *spot).distinct(),
                         person, period, place).select(*spot, "__no"))
    sizes = seen.groupBy(*spot).agg(F.count(F.lit(1)).alias("__n"))
    met = cut(join_group_stats(my_places, sizes, spot, how="inner"))
    several = met.where(F.col(_SET[0]) > 1)

    crowded = several.where(F.col("__n") > few).select(
        F.struct(*_SET).alias("__whole"), *spot)
    parts, part_places = _place_sets(crowded, "__whole", period, place)
    maps = _bitmaps(semi_join(seen, sizes.where(F.col("__n") > few), on=spot), period, place)
    merged = cut(join_group_stats(part_places, maps, spot, how="inner")
                 .groupBy(*key, "__bucket").agg(F.bitmap_or_agg("__map").alias("__map")))
    in_part = merged.groupBy(*key).agg(F.sum(F.bitmap_count("__map")).alias("__n"))
    names = {c: f"__part_{c}" for c in _SET}
    parts = cut(parts)
    in_crowd = join_group_stats(parts, in_part, key, how="inner").select(
        *period, "__whole.*", "__n")

    ones = join_group_stats(several.where(F.col("__n") <= few).drop("__n"), seen, spot, how="inner")
    ones = ones.select(*key, "__no").distinct().select(
        "*", F.struct(*_SET).alias("__whole"), F.bitmap_bucket_number("__no").alias("__bucket"))
    ones = join_group_stats(ones, parts.withColumnsRenamed(names), [*period, "__whole"])
    ones = join_group_stats(ones, merged.withColumnsRenamed(names),
                            [*period, *names.values(), "__bucket"])
    at = F.bitmap_bit_position("__no")
    byte = F.substring("__map", (F.floor(at / 8) + 1).cast("int"), F.lit(1))
    had = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
    in_few = ones.where(~F.coalesce(had, F.lit(False))).groupBy(*key).agg(
        F.count(F.lit(1)).alias("__n"))

    per_set = (met.where(F.col(_SET[0]) == 1).select(*key, "__n")
               .unionByName(in_crowd).unionByName(in_few)
               .groupBy(*key).agg(F.sum("__n").alias(out)))
    found = join_group_stats(mine, per_set, key)
    return found.select(person, *period, F.coalesce(out, F.lit(0)).cast("long").alias(out))


def prefix_fallback(df: DataFrame, dim: DataFrame, code: str, dim_code: str,
                    value: str, lengths: Sequence[int] = (5, 4)) -> DataFrame:
    """Values by the first of the prefix lengths that finds any; no match, no
    row. One join on the shortest prefix brings its codes, and the choice among
    them is made inside the row."""
    def prefix(c, n: int) -> Column:
        return F.substring(c, 1, n)

    entry = F.struct(prefix(dim_code, max(lengths)).alias("code"), F.col(value).alias("value"))
    under = dim.groupBy(prefix(dim_code, min(lengths)).alias("__p")).agg(
        F.collect_set(entry).alias("__dim"))
    met = join_group_stats(df.withColumn("__p", prefix(code, min(lengths))), under, ["__p"],
                           "inner", null_equal=False)

    def found(n: int) -> Column:
        hits = F.filter("__dim", lambda x: prefix(x["code"], n) == prefix(code, n))
        return F.when(F.size(hits) > 0, F.array_distinct(F.transform(hits, lambda x: x["value"])))

    return met.select(*df.columns, F.explode(F.coalesce(*[found(n) for n in lengths])).alias(value))


def agreeing_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Union of two sources where equal rows collapse; ``n_versions`` counts
    what an id is left with (1 means the sources agree or only one speaks)."""
    both = left.unionByName(right, allowMissingColumns=True).distinct()
    return with_group_stats(both, [key], n_versions=F.count(F.lit(1)))
