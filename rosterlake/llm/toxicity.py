"""Toxicity by a linear model on character n-grams scaled by naive Bayes.

A text is the set of its character n-grams (folded to lower case, hashed to
``BUCKETS`` numbers). Over all training rows each number's log-count ratio
between toxic and other texts is counted. The ``features`` numbers that tell most,
of those in at least ``least`` texts, are the features (both are parameters, see
the README for what they cost), each scaled by its ratio, and a logistic
regression on a bounded, documented sample of training rows weighs them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import ready, spread_join, whole_text
from rosterlake.session import cut

ORDERS = (3, 4, 5)
BUCKETS = 1 << 20
FEATURES = 4096           # numbers the regression weighs
LEAST = 3                 # training texts a number must be in; rarer ones say little
SAMPLE_ROWS = 4000        # training rows of each label the regression is fitted on
FOLDS = 5
CHUNK_CHARS = 1 << 18


def ngram_numbers(chars: np.ndarray, order: int, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of the n-gram at every place of an array of code points."""
    n = len(chars) - order + 1
    code = np.full(max(n, 0), order, np.uint64)
    for i in range(order):
        code = code * np.uint64(0x100000001B3) + chars[i:i + max(n, 0)]
    code *= np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)


def _stretches(texts: list[str]):
    """(rows, code points, ends) of about ``CHUNK_CHARS`` characters; each text
    is edged with a blank on both sides."""
    rows, parts, size = [], [], 0
    for i, t in enumerate(texts):
        t = f" {t.lower()} "
        rows.append(i)
        parts.append(t)
        size += len(t)
        if size >= CHUNK_CHARS or i == len(texts) - 1:
            data = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
            yield np.array(rows), data.astype(np.uint64), np.cumsum([len(p) for p in parts])
            rows, parts, size = [], [], 0


def present(texts: list[str], wanted: np.ndarray | None = None):
    """(row, number), each once: the n-grams of each text, if ``wanted`` only
    those for which it is true."""
    for rows, data, ends in _stretches(texts):
        owner = np.repeat(np.arange(len(rows)), np.diff(ends, prepend=0))
        codes = []
        for order in ORDERS:
            number = ngram_numbers(data, order)
            if not len(number):
                continue
            own = owner[:len(number)]
            pick = own == owner[order - 1:order - 1 + len(number)]
            if wanted is not None:
                pick &= wanted[number]
            codes.append(own[pick] * BUCKETS + number[pick])
        code = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
        yield rows[code // BUCKETS], code % BUCKETS


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that hold each number, summed over the task."""
    totals = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        toxic = batch.column(batch.schema.get_field_index("toxic")).to_numpy(zero_copy_only=False)
        for row, number in present(_texts(batch)):
            for label in (0, 1):
                totals[label] += np.bincount(number[toxic[row] == label], minlength=BUCKETS)
    any_ = np.flatnonzero(totals.sum(axis=0))
    for a in range(0, len(any_), 1 << 16):
        at = any_[a:a + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(totals[0, at]), pa.array(totals[1, at])], ["number", "clean", "toxic"])


def _features(names: np.ndarray):
    position = np.full(BUCKETS, -1, np.int32)
    position[names] = np.arange(len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for row, number in present(_texts(batch), position >= 0):
                for r in np.unique(row):
                    held[r].append(position[number[row == r]])
            sets = [np.concatenate(h) if h else np.zeros(0, np.int32) for h in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("toxic")),
                 batch.column(batch.schema.get_field_index("h")),
                 pa.array([s.astype(np.int32).tobytes() for s in sets], pa.binary())],
                ["toxic", "h", "features"])
    return run


class Model:
    """Weights per bucket (ratio and regression together) and an intercept."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, intercept: float):
        self.weights = np.zeros(BUCKETS, np.float32)
        self.weights[names] = weights
        self.intercept = intercept

    def score(self, texts: list[str]) -> np.ndarray:
        total = np.full(len(texts), self.intercept)
        for row, number in present(texts, self.weights != 0):
            total += np.bincount(row, self.weights[number], len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -50, 50)))


def fit_regression(sets: list[np.ndarray], labels: np.ndarray, scale: np.ndarray,
                   share: float, rounds: int = 300, decay: float = 1e-3):
    """Logistic regression on sets of feature numbers, by accelerated descent.

    Rows are weighed so that the toxic ones count by their true share.
    """
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cols = np.concatenate(sets) if len(rows) else np.zeros(0, np.int64)
    part = labels.mean()
    weight = np.where(labels == 1, share / max(part, 1e-9), (1 - share) / max(1 - part, 1e-9))
    weight /= weight.sum()
    w, b = np.zeros(len(scale)), float(np.log(share / (1 - share)))
    value = scale[cols]
    grad_w, grad_b = np.zeros_like(w), 1e-8
    sum_w, mom_w, mom_b = np.full_like(w, 1e-8), np.zeros_like(w), 0.0
    for _ in range(rounds):
        z = np.bincount(rows, value * w[cols], len(sets)) + b
        miss = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels)
        grad_w = np.bincount(cols, value * miss[rows], len(w)) + decay * w
        sum_w = 0.99 * sum_w + 0.01 * grad_w ** 2
        grad_b = 0.99 * grad_b + 0.01 * miss.sum() ** 2
        mom_w = 0.9 * mom_w + 0.1 * grad_w
        mom_b = 0.9 * mom_b + 0.1 * miss.sum()
        w -= 0.05 * mom_w / np.sqrt(sum_w + 1e-12)
        b -= 0.05 * mom_b / np.sqrt(grad_b + 1e-12)
    return w, b


def _smallest(rows: DataFrame, n: int, limit: int) -> DataFrame:
    """Of ``n`` rows a set that holds the ``limit`` ones of smallest ``h``.

    The hash is uniform, so a bound on it leaves about ``limit`` rows; a task
    sends none of the others. Should the bound leave too few, it is dropped.
    """
    share = (limit + 8 * limit ** 0.5 + 64) / max(n, 1)
    if share >= 1:
        return rows
    near = rows.where(F.col("h") <= F.lit(int(-(1 << 63) + share * (1 << 64))))
    return near if near.count() >= limit else rows


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES,
          least: int = LEAST) -> Model:
    """``rows``: doc_id, text, toxic (0 or 1). Ratios use every row; the
    regression at most ``sample_rows`` of each label, those with the smallest
    hash of id and text."""
    rows = cut(rows.select("text", F.col("toxic").cast("int").alias("toxic"),
                           F.xxhash64("doc_id", "text").alias("h")))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    share = (toxic + 1) / (clean + toxic + 2)
    none = np.zeros(0, np.int64)
    if not clean or not toxic:
        return Model(none, none, float(np.log(share / (1 - share))))
    counts = rows.select("text", "toxic").mapInArrow(_counts, "number long, clean long, toxic long")
    counts = counts.groupBy("number").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    ratio = F.log((F.col("t") + 1) / (toxic + 2)) - F.log((F.col("c") + 1) / (clean + 2))
    tells = F.abs(ratio) * F.sqrt(F.col("t") + F.col("c"))
    # at most BUCKETS rows
    best = (counts.where(F.col("t") + F.col("c") >= least)
            .select("number", ratio.alias("ratio"), tells.alias("tells"))
            .orderBy(F.desc("tells"), "number").limit(features).collect())
    names = np.array([r["number"] for r in best], np.int64)
    scale = np.array([r["ratio"] for r in best], np.float64)
    parts = [_smallest(rows.where(F.col("toxic") == label), n[label], sample_rows)
             .mapInArrow(_features(names), "toxic int, h long, features binary")
             .orderBy("h", "features").limit(sample_rows) for label in (0, 1)]
    got = parts[0].unionByName(parts[1]).collect()
    labels = np.array([r["toxic"] for r in got], np.float64)
    sets = [np.frombuffer(r["features"], np.int32).astype(np.int64) for r in got]
    w, b = fit_regression(sets, labels, scale, share)
    return Model(names, w * scale, b)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_texts(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score),
                 pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    return run


def fold(doc_id: str = "doc_id", folds: int = FOLDS):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def toxic_scores(docs: DataFrame, labels: DataFrame, features: int = FEATURES,
                 least: int = LEAST) -> DataFrame:
    """Score and prediction of every document.

    Rows whose crc32 of the id is divisible by ``FOLDS`` are held out of
    training, as are rows without an id or label. Empty and null texts score by
    the intercept; equal texts score alike; texts of any length are read whole,
    in stretches; other columns are ignored; without labels of both kinds every
    score is the share of toxic labels. Rows that share a labelled id all train,
    and an id labelled twice trains under each of its labels. In the sample,
    ties of the hash (rows repeated in full) are taken as they come.

    The labelled texts move once, to meet their labels, by one plan at every
    size (labels are never broadcast); after that only counts and features do.
    """
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    marked = labels.where("toxic IN (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(fold() != 0)
    rows = spread_join(docs.where(fold() != 0), marked.hint("merge"), ["doc_id"], "inner")
    model = train(rows, features=features, least=least)
    held = F.coalesce(fold() == 0, F.lit(True)).alias("held_out")
    return docs.select("doc_id", held, "text").mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double, predicted int")
