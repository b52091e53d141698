"""Quality rules: fixed rules, then isolation forests on rule statistics.

Statistics are taken from whole texts. Random trees part a bounded sample of
documents by random cuts; a document that few cuts set apart has short paths
and is an anomaly. Each kind of statistic has a forest, so that what stands
out in one is not lost among the others. The scores from which a document is
rejected are chosen on the labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import BLANKS, mix, ready, row_key, slices, spread_join, whole_text
from rosterlake.session import cut

TREES = 100
SINGLE_TREES = 40         # in a forest on one statistic
TREE_ROWS = 256
SAMPLE_ROWS = 4096        # documents the trees are grown on, those of smallest row hash
GOOD_LOST = 0.005         # share of well labelled rows a threshold may reject
BINS = 1000
SYMBOLS = b"#*$%&|<>"     # fixed value
WINDOW = 8
FEATURES = ["symbols", "symbol_share", "symbol_words", "exclaimed", "copied_lines", "repeated",
            "word_length", "capitals", "marks", "digits", "long_words", "line_words"]
# columns of FEATURES a forest is grown on: symbols together, each other one by itself
KINDS = [[0, 1, 2, 3], *([i] for i in range(4, len(FEATURES)))]
SCORES = [f"score_{FEATURES[k[0]]}" for k in KINDS]
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = mix(np.array([names.setdefault(w, len(names)) for w in words], np.uint64))
    code = np.zeros(n, np.uint64)
    for i in range(window):
        code = code * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n]
    _, where, count = np.unique(code, return_inverse=True, return_counts=True)
    again = count[where] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(again), 1)
    np.add.at(cover, np.flatnonzero(again) + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """Base counts and the forest's features of one text."""
    words = text.split()
    n = len(words)
    chars = len(text.decode("utf-8", "replace")) - sum(text.count(b) for b in BLANKS)
    symbols = sum(text.count(b) for b in SYMBOLS)
    seen, copied, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            copied += line in seen
            seen.add(line)
    again = repeated_words(words)
    per = max(n, 1)
    flat = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = max(len(text) - int(flat[list(BLANKS)].sum()), 1)
    features = [symbols / per, symbols / solid,
                sum(not w.strip(SYMBOLS) for w in words) / per, flat[33] / per,
                copied / max(lines, 1), again / per, chars / per, flat[65:91].sum() / solid,
                flat[list(b"?.,;:")].sum() / per, flat[48:58].sum() / solid,
                sum(len(w) > 20 for w in words) / per, np.log1p(n / max(lines, 1))]
    return [n, chars, symbols, copied, again], [float(x) for x in features]


def base_failed(n: int, again: int) -> bool:
    return n < 20 or 100 * again > 30 * n


def _statistics(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in slices(batch.column(batch.schema.get_field_index("text")))]
            base = np.array([r[0] for r in rows], np.int64).reshape(-1, len(_BASE))
            feats = np.array([r[1] for r in rows], np.float32).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in keep],
                 *[pa.array(base[:, i]) for i in range(len(_BASE))],
                 pa.array((base[:, 0] < 20) | (100 * base[:, 4] > 30 * base[:, 0])),
                 *[pa.array(feats[:, i]) for i in range(len(FEATURES))]],
                [*keep, *_BASE, "base_failed", *FEATURES])
    return run


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, row, base counts, base_failed and features per document."""
    ready(docs.sparkSession)
    schema = ("doc_id long, row long, " + ", ".join(f"{c} long" for c in _BASE) + ", base_failed boolean, "
              + ", ".join(f"{c} float" for c in FEATURES))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"),
                       whole_text().alias("text")).mapInArrow(_statistics(["doc_id", "row"]), schema)


def path_left(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n < 2:
        return 0.0
    return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else 1.0


class Forest:
    """Random splits of random rows; a tree is arrays of feature, cut, child,
    path length, depth and range, so that a batch walks down it at once. A
    value outside a node's range is taken as cut off there with the chance a
    random cut of the range that holds it too would have, so that values far
    beyond the sample stand out more than those at its edge."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, size: int = TREE_ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.size = min(size, len(rows))
        self.depth = max(int(np.ceil(np.log2(max(self.size, 2)))), 1)
        self.trees = [self._grow(rows[rng.permutation(len(rows))[:self.size]], rng)
                      for _ in range(trees)] if len(rows) else []

    def _grow(self, rows: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []

        def split(part: np.ndarray, depth: int) -> int:
            me = len(nodes)
            nodes.append([0, 0.0, me, me, depth + path_left(len(part)), depth, -np.inf, np.inf])
            if depth >= self.depth or len(part) < 2:
                return me
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            f = int(rng.choice(open_ if len(open_) else part.shape[1]))
            nodes[me][0], nodes[me][6:] = f, [low[f], high[f]]
            if not len(open_):
                return me
            at = nodes[me][1] = float(rng.uniform(low[f], high[f]))
            goes = part[:, f] <= at
            nodes[me][2] = split(part[goes], depth + 1)
            nodes[me][3] = split(part[~goes], depth + 1)
            return me

        split(rows, 0)
        table = np.array(nodes)
        return (table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64),
                table[:, 3].astype(np.int64), *table[:, 4:].T)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; near 1 for rows that few splits set apart."""
        if not self.trees or not len(rows):
            return np.zeros(len(rows))
        rows, back = np.unique(rows, axis=0, return_inverse=True)
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, at, low, high, length, depth, least, most in self.trees:
            node, left = np.zeros(len(rows), np.int64), np.ones(len(rows))
            for _ in range(self.depth):
                x = rows[every, feature[node]]
                out = np.flatnonzero((x < least[node]) | (x > most[node]))
                to = node[out]
                beyond = np.maximum(least[to] - x[out], x[out] - most[to])
                gone = left[out] * beyond / (beyond + most[to] - least[to])
                total[out] += gone * (depth[to] + 1)
                left[out] -= gone
                node = np.where(x <= at[node], low[node], high[node])
            total += left * length[node]
        return (2.0 ** (-total / len(self.trees) / max(path_left(self.size), 1.0)))[back.ravel()]


def sample_rows(stats: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Features of at most ``rows`` documents that pass the fixed rules, those
    of smallest hash, so reruns agree. The hash is of the row and its number
    among rows repeated in full: every document has the same chance."""
    copies = (stats.where("NOT base_failed").groupBy("row", *FEATURES)
              .agg(F.count(F.lit(1)).alias("__n")))
    one = copies.select("row", *FEATURES, F.explode(F.sequence(F.lit(1).cast("long"), "__n")).alias("__k"))
    return (one.withColumn("__h", F.xxhash64("row", "__k")).orderBy("__h", "row", "__k").limit(rows)
            .select(*FEATURES))


class Forests(list):
    """A forest for each of ``KINDS``."""

    def scores(self, rows: np.ndarray) -> list[np.ndarray]:
        return [forest.score(rows[:, kind]) for forest, kind in zip(self, KINDS)]


def grow_forests(stats: DataFrame, rows: int = SAMPLE_ROWS) -> Forests:
    """Trees on a bounded sample."""
    found = np.array([[r[c] for c in FEATURES] for r in sample_rows(stats, rows).collect()],
                     np.float64).reshape(-1, len(FEATURES))
    return Forests(Forest(found[:, k], SINGLE_TREES if len(k) == 1 else TREES) for k in KINDS)


def _score(forests: Forests, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy()
                             for c in FEATURES], axis=1).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in keep],
                 *[pa.array(s) for s in forests.scores(rows)]], [*keep, *SCORES])
    return run


def scored(stats: DataFrame, forests: Forests) -> DataFrame:
    keep = ["doc_id", *_BASE, "base_failed"]
    schema = ("doc_id long, " + ", ".join(f"{c} long" for c in _BASE) + ", base_failed boolean, "
              + ", ".join(f"{c} double" for c in SCORES))
    return stats.mapInArrow(_score(forests, keep), schema)


def thresholds(scores: DataFrame, labels: DataFrame, good_lost: float = GOOD_LOST) -> list[float]:
    """For each kind the lowest score from which at most its part of
    ``good_lost`` of the well labelled rows would be rejected, and the poorly
    labelled are most of those rejected.

    All labelled rows count, as histograms of ``BINS`` bins. Without labels
    nothing is rejected.
    """
    marked = labels.where("quality IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"))
    found = (scores.where("NOT base_failed").join(marked, "doc_id")
             .select("q", F.posexplode(F.array(*SCORES)).alias("kind", "score"))
             .groupBy("kind", F.floor(F.col("score") * BINS).cast("int").alias("bin"))
             .agg(F.sum(F.when(F.col("q") == 1, 1).otherwise(0)).alias("good"),
                  F.sum(F.when(F.col("q") == 1, 0).otherwise(1)).alias("bad")).collect())
    good, bad = np.zeros((len(KINDS), BINS + 2)), np.zeros((len(KINDS), BINS + 2))
    for r in found:
        good[r["kind"], r["bin"]], bad[r["kind"], r["bin"]] = r["good"], r["bad"]
    lost, caught = (x[:, ::-1].cumsum(axis=1)[:, ::-1] for x in (good, bad))
    fits = (lost <= good_lost / len(KINDS) * lost[:, :1]) & (caught >= lost)
    return [int(np.flatnonzero(f)[0]) / BINS if g else (BINS + 1) / BINS
            for f, g in zip(fits, lost[:, 0])]


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, base_failed and kept per document.

    A null or blank text has no words and fails; lines and words repeated in a
    text count as stated; rows with one id are judged one by one; other columns
    are ignored; with no labels only the fixed rules reject. ``anomaly`` is the
    highest score as a share of its threshold.
    """
    stats = cut(rule_statistics(docs))
    forests = grow_forests(stats)
    scores = cut(scored(stats, forests))
    limits = thresholds(scores, labels)
    fine = [F.floor(F.col(c) * BINS) < round(limit * BINS) for c, limit in zip(SCORES, limits)]
    return scores.select("doc_id", *_BASE, "base_failed",
                         reduce(and_, fine, ~F.col("base_failed")).alias("kept"),
                         F.greatest(*[F.col(c) / limit for c, limit in zip(SCORES, limits)])
                         .alias("anomaly"))


def _passing(forests: Forests, limits: list[float], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in slices(batch.column(batch.schema.get_field_index("text")))]
            feats = np.array([r[1] for r in rows], np.float32).reshape(-1, len(FEATURES))
            fails = np.array([base_failed(r[0][0], r[0][4]) for r in rows], bool)
            for score, limit in zip(forests.scores(feats.astype(np.float64)), limits):
                fails |= np.floor(score * BINS) >= round(limit * BINS)
            yield batch.filter(pa.array(~fails)).select(names)
    return run


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass rules and forests, columns unchanged."""
    stats = cut(rule_statistics(docs))
    forests = grow_forests(stats)
    limits = thresholds(scored(stats, forests), labels)
    return docs.mapInArrow(_passing(forests, limits, docs.columns), docs.schema)
