"""Wide to long and back."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str,
            value: str) -> DataFrame:
    """Columns to rows; empty cells make no row."""
    return (df.unpivot(list(ids), list(columns), name, value)
            .where(F.col(value).isNotNull()))


def slots_to_long(df: DataFrame, ids: Sequence[str], slots: Sequence[str],
                  value: str, seq: str = "seq") -> DataFrame:
    """Numbered slot columns (``code_1`` .. ``code_15``) to rows with ``seq``."""
    number = {s: int(re.search(r"(\d+)$", s).group(1)) for s in slots}
    items = F.array(*[F.struct(F.lit(number[s]).alias(seq), F.col(s).alias(value))
                      for s in slots])
    filled = F.filter(items, lambda x: x[value].isNotNull())
    return (df.select(*ids, F.explode(filled).alias("__slot"))
            .select(*ids, f"__slot.{seq}", f"__slot.{value}"))


def split_to_rows(df: DataFrame, column: str, sep: str, pattern: str | None = None) -> DataFrame:
    """One trimmed row per part of a delimited text."""
    parts = F.split(F.col(column), pattern or re.escape(sep))
    return df.withColumn(column, F.explode(parts)).withColumn(column, F.trim(column))


def numbered_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
                     width: int, order: Sequence[str] | None = None) -> DataFrame:
    """The n-th distinct row of an id as columns ``name1`` .. ``nameN``.

    An id with more than ``width`` rows is an error rather than a silent cut.
    Rows are numbered first, across tasks where an id is hot, and a number
    beyond the width fails where it is made; then each number's columns are
    maxima, combined on the map side. No id is gathered.
    """
    from rosterlake.operators.rows import sequence_in_group
    columns = list(columns)
    lead = [c for c in (order or columns) if c in columns]
    distinct = df.select(*ids, *columns).distinct()
    numbered = sequence_in_group(distinct, ids, [*lead, *[c for c in columns if c not in lead]], "__n")
    number = F.when(F.col("__n") <= width, F.col("__n")).otherwise(
        F.raise_error(F.lit(f"more than {width} values for one id")).cast("int"))
    slots = numbered.withColumn("__n", number)
    return slots.groupBy(*ids).agg(*[
        F.max(F.when(F.col("__n") == i + 1, F.col(c))).alias(f"{c}{i + 1}")
        for i in range(width) for c in columns])


def widest(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> int:
    """How many distinct rows the fullest id has (the width a pivot needs)."""
    n = (df.select(*ids, *columns).distinct().groupBy(*ids)
         .agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0])
    return int(n or 0)


def indicators(df: DataFrame, ids: Sequence[str], column: str,
               values: Mapping[str, str], count: bool = False) -> DataFrame:
    """One 0/1 column (or count) per listed value: ``values`` maps value to name."""
    aggs = []
    for value, name in values.items():
        hit = F.when(F.col(column) == F.lit(value), 1).otherwise(0)
        aggs.append((F.sum(hit) if count else F.max(hit)).cast("int").alias(name))
    if not aggs:
        return df.select(*ids).distinct()
    return df.groupBy(*ids).agg(*aggs)


def value_columns(df: DataFrame, column: str, most: int = 1000) -> dict[str, str]:
    """Every value of a column as the name of its own column, in order.

    A plan must name its columns, so the distinct values come to the driver;
    more than ``most`` of them is an error, never a cut.
    """
    found = (df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v"))
             .distinct().limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; they do not fit as columns")
    return {v: v for v in sorted(r.v for r in found)}


def indicators_to_long(df: DataFrame, ids: Sequence[str], types: Sequence[str],
                       name: str) -> DataFrame:
    """Set indicator columns back to rows, for the listed types only."""
    return (to_long(df, ids, types, name, "__flag")
            .where("__flag = 1").drop("__flag"))


def coverage(df: DataFrame, period: Sequence[str], variable: str,
             variables: Sequence[str], complete_at: int = 5) -> DataFrame:
    """Which variables exist per period: 0/1 columns, their total, and whether
    fewer than ``complete_at`` are there."""
    wide = indicators(df, period, variable, {v: v for v in variables})
    total = sum((F.col(v) for v in variables[1:]), F.col(variables[0]))
    return (wide.withColumn("total", total)
            .withColumn("incomplete", (F.col("total") < complete_at).cast("int")))


def first_date_by_type(df: DataFrame, ids: Sequence[str], kind: str, date: str,
                       kinds: Mapping[object, str]) -> DataFrame:
    """Earliest date per id and kind, as one named column per kind."""
    aggs = [F.min(F.when(F.col(kind) == F.lit(k), F.col(date))).alias(name)
            for k, name in kinds.items()]
    return df.groupBy(*ids).agg(*aggs)


def reorder(columns: Sequence[str], lead: Sequence[str], where: str = "first") -> list[str]:
    """Column order with ``lead`` first or last."""
    if where not in ("first", "last"):
        raise ValueError("where must be 'first' or 'last'")
    rest = [c for c in columns if c not in lead]
    return list(lead) + rest if where == "first" else rest + list(lead)
