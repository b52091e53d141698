"""Checks: lazy audit frames, and assertions that read one small result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from rosterlake.operators.joins import natural_join, provenance_join


class AuditError(AssertionError):
    """A data rule does not hold."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def is_id(df: DataFrame, keys: Sequence[str]) -> bool:
    return duplicate_keys(df, keys).isEmpty()


def require_id(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not is_id(df, keys):
        raise AuditError(f"{list(keys)} do not uniquely identify the rows")
    return df


def require_one_to_one(df: DataFrame, left: str, right: str) -> DataFrame:
    require_id(df, [left])
    return require_id(df, [right])


def value_or_error(text: Column, value: Column, what: str) -> Column:
    """``value``, null for blank text; text that gave none is an error."""
    lost = F.raise_error(F.concat(F.lit(f"not readable: {what}: "), text))
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", None).otherwise(
        F.coalesce(value, lost))


def cast_audit(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per cast column: nulls before and after, and values an integer
    target would have rounded. One pass over the data."""
    aggs = []
    for c, t in types.items():
        cast = F.col(c).try_cast(t)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"b_{c}"),
                 F.count_if(cast.isNull()).alias(f"a_{c}")]
        whole = t in ("int", "integer", "long", "bigint")
        moved = (F.col(c).try_cast("double") != cast.cast("double")) if whole else F.lit(False)
        aggs.append(F.count_if(moved).alias(f"r_{c}"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"b_{c}").alias("nulls_before"),
                              F.col(f"a_{c}").alias("nulls_after"),
                              F.col(f"r_{c}").alias("rounded")) for c in types])
    return one.select(F.inline(rows))


def require_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast, or raise when a cast loses values or rounds."""
    bad = cast_audit(df, types).where("nulls_before <> nulls_after or rounded > 0")
    lost = [r["column"] for r in bad.collect()]
    if lost:
        raise AuditError(f"casting loses values in {lost}")
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def observed(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The frame, and an observation that holds the counts (aggregates) once an
    action has run over it: an audit in the pass that does the work. Filters
    put on top stay above it, so what they drop is counted too. A row counts once per attempt of its
    stage: put it where no shuffle lies between it and the write, as a lost
    executor's shuffle output is made again."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen


def cast_losses(types: Mapping[str, str]) -> dict[str, Column]:
    """Per column the values its cast would lose or round, as counts for
    ``observed``."""
    def lost(c: str, t: str) -> Column:
        cast = F.col(c).try_cast(t)
        gone = F.col(c).isNotNull() & cast.isNull()
        if t in ("int", "integer", "long", "bigint"):
            gone = gone | F.coalesce(F.col(c).try_cast("double") != cast.cast("double"), F.lit(False))
        return F.count_if(gone)

    return {f"lost_{c}": lost(c, t) for c, t in types.items()}


def integer_or_null(c: str, blank: str | None = None) -> Column:
    """Integer where it is one. With ``blank``, only that token may fail."""
    col = F.col(c)
    if blank is None:
        return col.try_cast("long")
    return F.nullif(col, F.lit(blank)).cast("long")


def profile_counts(df: DataFrame, column: str, levels: Sequence[int] = (0, 10, 11, 12),
                   by: Sequence[str] = ()) -> DataFrame:
    """Nulls and exact small values of a count column, in one pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(column).isNull()).alias("n_null")]
    aggs += [F.count_if(F.col(column) == F.lit(v)).alias(f"n_{v}") for v in levels]
    return (df.groupBy(*by) if by else df.groupBy()).agg(*aggs)


def outside_entity(df: DataFrame, entity: DataFrame, key: str = "npi",
                   allowed: int = 1) -> DataFrame:
    """Ids that carry the attribute though their entity type may not."""
    return (natural_join(df.select(key), entity, on=[key], null_equal=False)
            .where(F.col("entity") != allowed).select(key).distinct())


def require_entity(df: DataFrame, entity: DataFrame, key: str = "npi",
                   allowed: int = 1) -> DataFrame:
    if not outside_entity(df, entity, key, allowed).isEmpty():
        raise AuditError(f"attribute found outside entity type {allowed}")
    return df


def update_audit(old_tail: DataFrame, remade: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How a rebuilt tail compares with the stored one.

    ``missing_keys``: stored keys the rebuild lacks. ``left_only`` / ``both``:
    stored values (time dropped) it lacks / has.
    """
    keys = list(keys)
    gone = natural_join(old_tail.select(*keys), remade.select(*keys).distinct(),
                        "left_anti", on=keys)
    rest = [c for c in old_tail.columns if c != "month"]
    a = old_tail.select(*rest).na.drop().distinct()
    b = remade.select(*rest).na.drop().distinct()
    m = provenance_join(a, b)
    sides = m.groupBy().agg(F.count_if(F.col("_merge") == "left_only").alias("left_only"),
                            F.count_if(F.col("_merge") == "both").alias("both"))
    return sides.withColumn("missing_keys", gone.agg(F.count(F.lit(1))).scalar())


def require_update(old_tail: DataFrame, remade: DataFrame, keys: Sequence[str],
                   tolerance: float = 0.001) -> None:
    r = update_audit(old_tail, remade, keys).first()
    if r.missing_keys and not (r.both and r.left_only / r.both < tolerance):
        raise AuditError(f"rebuilt months drop stored values: {r.asDict()}")


def id_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found in one source only; empty when the id sets agree."""
    return (provenance_join(left.select(*keys).distinct(), right.select(*keys).distinct())
            .where(F.col("_merge") != "both"))


def misfiled(known: DataFrame, missing: DataFrame, column: str) -> DataFrame:
    """Nulls among the known and values among the missing (both should be 0)."""
    a = known.select(F.col(column).isNull().cast("long").alias("null_in_known"),
                     F.lit(0).cast("long").alias("value_in_missing"))
    b = missing.select(F.lit(0).cast("long").alias("null_in_known"),
                       F.col(column).isNotNull().cast("long").alias("value_in_missing"))
    return a.unionByName(b).agg(F.sum("null_in_known").alias("null_in_known"),
                                F.sum("value_in_missing").alias("value_in_missing"))


def exactly_one_date_rule(date: str, granted: str, certified: str) -> Column:
    """The date equals the grant date, or there is no grant date and it equals
    the certification date: one of the two, never both."""
    by_grant = F.coalesce(F.col(date) == F.col(granted), F.lit(False))
    by_cert = F.coalesce((F.col(date) == F.col(certified)) & F.col(granted).isNull(),
                         F.lit(False))
    return by_grant != by_cert


def null_count(columns: Sequence[str]) -> Column:
    """Number of nulls in a row over the columns."""
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])


def all_blank(columns: Sequence[str]) -> Column:
    return null_count(columns) == len(columns)
