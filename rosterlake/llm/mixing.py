"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size is the number of copies each of its documents
is due. Whole copies are taken as they are; the fractions are inclusion
probabilities. They walk through the null space of the balancing constraints,
token and document totals, three at a time, until each block of a source has
at most two fractions left. What is left of the blocks is dealt into blocks
again; the last walk of a source ends in a landing on its token total.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import WORD, ready, row_key, spread_join, whole_text
from rosterlake.operators.rows import surrogate_id
from rosterlake.session import cut

WEIGHTS = (5, 2, 1)
MOST = 3                  # times a source's size
BLOCK = 20_000
POOL = 8                  # decided documents of a block that may help to land
POOL_BLOCKS = 8           # blocks of a source that keep such documents
_ROW = "doc_id long, row long, size long, source string, p double, pool int"


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"),
                       F.col("source").cast("string").alias("source"),
                       F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"))


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, n_rows, target): shares of all words by repeating
    weights in code point order, null last, none above ``most`` times its size.

    Each round shares what is not capped by weight; sources stay in a table.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                         F.count(F.lit(1)).alias("n_rows"))
    sources = sources.withColumn("__null", F.col("source").isNull())
    ranked = surrogate_id(sources, ["__null", "source"], "__rank").drop("__null")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("__rank") % len(weights) + 1).cast("int"))
    ranked = cut(ranked.withColumn("__weight", weight))
    total, all_weight = ranked.agg(F.sum("source_size"), F.sum("__weight")).first()
    level, full = (total or 0) / (all_weight or 1), -1
    cap = F.col("source_size") * float(most)
    while True:
        # a source once above its cap stays there: the level only rises
        held = F.col("__weight") * F.lit(float(level)) > cap
        capped, free, n = ranked.agg(F.sum(F.when(held, cap)), F.sum(F.when(~held, F.col("__weight"))),
                                     F.count(F.when(held, 1))).first()
        if n == full or not free:
            break
        level, full = (total - (capped or 0.0)) / free, n
    held = F.col("__weight") * F.lit(float(level)) > cap
    return ranked.select("source", "source_size", "n_rows",
                         F.when(held, cap).otherwise(F.col("__weight") * F.lit(float(level)))
                         .alias("target"))


class Chance:
    """Uniform numbers that depend only on a seed and their position."""

    def __init__(self, seed: int):
        self.rng = np.random.Generator(np.random.PCG64(seed & (2**63 - 1)))
        self.held: list[float] = []

    def __call__(self) -> float:
        if not self.held:
            self.held = self.rng.random(1024).tolist()
        return self.held.pop()


def flight(p: list[float], size: list[int], chance: Chance) -> None:
    """Move ``p`` in place until at most two are fractions; their sum and their
    sum weighed by ``size`` stay what they are."""
    tiny = 1e-9
    todo = [i for i, x in enumerate(p) if tiny < x < 1 - tiny]
    for i, x in enumerate(p):
        if not tiny < x < 1 - tiny:
            p[i] = float(round(x))
    todo.reverse()
    active: list[int] = []
    while True:
        while len(active) < 3 and todo:
            active.append(todo.pop())
        if len(active) == 3:
            a, b, c = (size[i] for i in active)
            v = (c - b, a - c, b - a)
            if not any(v):
                v = (1, -1, 0)
        elif len(active) == 2 and size[active[0]] == size[active[1]]:
            v = (1, -1)
        else:
            return
        up = down = float("inf")
        for i, d in zip(active, v):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, p[i] / -d), min(down, (1 - p[i]) / -d)
        step = up if chance() * (up + down) < down else -down
        for i, d in zip(active, v):
            x = p[i] + step * d
            p[i] = 0.0 if x < tiny else 1.0 if x > 1 - tiny else x
        active = [i for i in active if 0.0 < p[i] < 1.0]


def land(p: list[float], size: list[int], pool: list[bool]) -> None:
    """Decide the last fractions near their token total, then flip documents
    of the pool as long as that brings the total nearer."""
    open_ = [i for i, x in enumerate(p) if 0.0 < x < 1.0]
    due = sum(p[i] * size[i] for i in open_)
    for i in sorted(open_, key=lambda i: -size[i]):
        take = abs(due - size[i]) < abs(due)
        p[i] = 1.0 if take else 0.0
        due -= size[i] * take
    free = [i for i in range(len(p)) if (pool[i] or i in open_) and size[i]]
    for _ in range(len(free)):
        best = min(free, key=lambda i: abs(due - (size[i] if p[i] == 0 else -size[i])), default=None)
        if best is None:
            return
        change = size[best] if p[best] == 0 else -size[best]
        if abs(due - change) >= abs(due):
            return
        p[best], due = 1.0 - p[best], due - change


def _walk(last: bool):
    """One block: its rows by hash, so that neither the order they arrive in
    nor a rerun matters."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, row = (table.column(c).to_pylist() for c in ("doc_id", "row"))
        size, p = (table.column(c).to_pylist() for c in ("size", "p"))
        pool = table.column("pool").to_pylist()
        order = sorted(range(len(p)), key=lambda i: (row[i], ids[i] is None, ids[i] or 0))
        size, p, flag = ([x[i] for i in order] for x in (size, p, pool))
        fixed = [x in (0.0, 1.0) for x in p]
        seed = (row[order[0]] * 31 + len(p)) if order else 0
        flight(p, size, Chance(seed))
        if last:
            # documents decided just now help too, where there were no blocks
            near = [i for i in range(len(p)) if not fixed[i] and p[i] in (0.0, 1.0)]
            for i in near[:POOL * POOL_BLOCKS]:
                flag[i] = 1
            land(p, size, [bool(f) for f in flag])
            flag = [0] * len(p)
        else:
            block = key[1].as_py()
            some = [i for i in range(len(p)) if p[i] in (0.0, 1.0) and not fixed[i] and size[i]]
            for i in sorted(some, key=lambda i: size[i])[:POOL] if block < POOL_BLOCKS else []:
                flag[i] = 1
        back = [0] * len(p)
        for at, i in enumerate(order):
            back[i] = at
        return (table.drop_columns(["p", "pool", "block"])
                .append_column("p", pa.array([p[i] for i in back], pa.float64()))
                .append_column("pool", pa.array([flag[i] for i in back], pa.int32())))
    return run


def decide(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows``: doc_id, row, size, source, p. The same rows with p 0 or 1."""
    rows = rows.select("doc_id", "row", "size", "source", "p", F.lit(0).alias("pool"))
    open_ = "(p > 0 AND p < 1) OR pool = 1"
    done = [rows.where(f"NOT ({open_})")]
    rows = rows.where(open_)
    while True:
        n = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        n = cut(n.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")))
        many = n.where("blocks > 1")
        if many.isEmpty():
            break
        dealt = spread_join(rows, n.select("source", "blocks"), ["source"])
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row", "size"), F.col("blocks"))
                                 .cast("int")).drop("blocks")
        walked = cut(dealt.groupBy("source", "block").applyInArrow(_walk(False), _ROW))
        done.append(walked.where(f"NOT ({open_})"))
        rows = walked.where(open_)
    landed = rows.withColumn("block", F.lit(0)).groupBy("source", "block").applyInArrow(
        _walk(True), _ROW)
    out = landed
    for part in done:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, row, source, size, source_size, target and copies per document.

    A null text has size 0; documents of size 0 are taken as often as others of
    their source but add no words; a null source is a source, the last; rows
    repeated in full are documents of their own; a null id is an id like any
    other; an empty table gives an empty mix.
    """
    ready(docs.sparkSession)
    rows = cut(sizes(docs))
    wanted = targets(rows, weights, most)
    due = spread_join(rows, cut(wanted.withColumn(
        "due", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(F.lit(0.0))).drop("n_rows")), ["source"])
    due = due.withColumn("whole", F.floor(F.col("due") + 1e-12))
    due = due.withColumn("p", F.greatest(F.lit(0.0), F.col("due") - F.col("whole")))
    due = due.withColumn("p", F.when(F.col("p") < 1e-9, 0.0).otherwise(F.col("p")))
    chosen = decide(due.select("doc_id", "row", "size", "source", "p"))
    whole = cut(due.select("source", "source_size", "target", "whole").distinct())
    return spread_join(chosen, whole, ["source"]).select(
        "doc_id", "row", "source", "size", "source_size", "target",
        (F.col("whole") + F.col("p")).cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST
                    ) -> DataFrame:
    """Every document as often as the mix takes it, columns unchanged."""
    times = mix(docs, weights, most).where("copies > 0")
    # rows equal in id, text and source are told apart by number alone
    keys = ["doc_id", "row", "source"]
    times = times.groupBy(*keys).agg(F.sum("copies").cast("int").alias("copies"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"),
                        F.col("source").cast("string").alias("source"),
                        F.struct(*docs.columns).alias("doc"))
    same = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    if not same.isEmpty():
        keyed = keyed.dropDuplicates(keys)
    joined = spread_join(keyed, times, keys)
    return joined.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
                         ).select("doc.*")
