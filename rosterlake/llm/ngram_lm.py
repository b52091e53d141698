"""Language-model scores by stupid backoff over counts of the whole corpus.

Documents are dealt into blocks by hash. A block explodes its texts into
n-grams, counts them and sends its distinct n-grams, packed, to the partitions
of the count tables, which are ranges of the n-gram hash; these sum and answer
each block's n-grams with their corpus counts. Hashes travel sorted, as the
differences to the one before, byte by byte of equal weight: that keeps all 64
bits in under six bytes. The block joins the answers to its
exploded n-grams and sums per document. An n-gram travels once per block,
however often it occurs, so a hot one is not hot on the way.

Words and pairs are counted first. A triple can only be known from another
document if both its pairs are, so only such triples are counted then; the
count of all others is 0 without asking.

A document is scored by the counts of all other documents: its own are taken
off. Backoff therefore happens wherever nobody else wrote the n-gram.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import WORD, mix, ready, row_key, slices, whole_text

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 8 << 20
PART_BYTES = 8 << 20
_OUT = ("doc_id long, n_words long, n_trigram long, n_bigram long, n_unigram long, n_unseen long, "
        "mean_log10 double")


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes of equal weight."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


class Grams:
    """Distinct n-grams of a block of texts, by order, and where they occur."""

    def __init__(self, texts: pa.Array):
        names: dict[bytes, int] = {}
        ids, sizes = [], []
        for text in slices(texts):
            words = text.lower().split()
            sizes.append(len(words))
            ids.extend([names.setdefault(w, len(names)) for w in words])
        word = np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64)
        h = word[np.array(ids, np.int64)] if ids else np.zeros(0, np.uint64)
        self.sizes = np.array(sizes, np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(h)) - first[self.doc]
        self.keys, self.at, self.where, self.count = [], [], [], []
        self.h, self.code = h, np.zeros(len(h), np.uint64)
        self.add()
        self.add()

    def add(self, alive: np.ndarray | None = None) -> None:
        """The next order; of its n-grams those that end at a place ``alive``."""
        n = len(self.keys) + 1
        # code of the n words that end at each place
        if n > 1:
            self.code = shifted(self.code)
        self.code = mix(self.code * np.uint64(0x9E3779B97F4A7C15) + self.h + np.uint64(n))
        at = np.flatnonzero(self.place >= n - 1 if alive is None else (self.place >= n - 1) & alive)
        keys, where, count = np.unique(self.code[at], return_inverse=True, return_counts=True)
        self.keys.append(keys)
        self.at.append(at)
        self.where.append(where)
        self.count.append(count)

    def packed(self, parts: int, first: int = 0):
        """(part, places, keys, counts): orders from ``first`` on, keys in order; a part is a
        range of them."""
        keys, count = np.concatenate(self.keys[first:]), np.concatenate(self.count[first:])
        by = np.argsort(keys, kind="stable")  # merges sorted runs
        keys, count = keys[by], count[by]
        part = (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        return [(int(part[a]), by[a:b], keys[a:b], count[a:b])
                for a, b in zip(starts, [*starts[1:], len(keys)])]

    def others(self, parts: int, first: int, answers: list[tuple]) -> list[np.ndarray]:
        """Per order from ``first`` on and place: how often other documents have the n-gram."""
        came = {p: (wide, data) for p, wide, data in answers}
        totals, out = np.zeros(sum(map(len, self.keys[first:])), np.int64), []
        for p, at, _, _ in self.packed(parts, first):
            wide, data = came[p]
            totals[at] = unsqueeze(data, len(at), np.int64 if wide else np.uint32)
        for n in range(first, len(self.keys)):
            keys, at, where = self.keys[n], self.at[n], self.where[n]
            # what the document itself adds to each of its n-grams
            pair = self.doc[at] * max(len(keys), 1) + where
            _, back, own = np.unique(pair, return_inverse=True, return_counts=True)
            rest = np.zeros(len(self.doc), np.int64)
            rest[at] = totals[:len(keys)][where] - (own[back] if len(own) else 0)
            totals = totals[len(keys):]
            out.append(rest)
        return out


def shifted(values: np.ndarray) -> np.ndarray:
    """Each place gets the value of the place before; the first gets 0."""
    return np.concatenate([np.zeros(min(1, len(values)), values.dtype), values[:-1]])


def _rows(key: tuple[pa.Scalar, ...], rows: list[tuple]) -> pa.Table:
    return pa.table({
        "part": pa.array([r[0] for r in rows], pa.int32()),
        "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
        "n": pa.array([len(r[2]) for r in rows], pa.int32()),
        "keys": pa.array([squeeze(np.diff(r[2], prepend=np.uint64(0))) for r in rows], pa.binary()),
        "counts": pa.array([squeeze(r[3].astype(np.uint32)) for r in rows], pa.binary())})


def _count(parts: int):
    """Words and pairs of a block."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _rows(key, Grams(table.column("text").combine_chunks()).packed(parts))
    return run


def _with_triples(docs: pa.Table, answers: pa.Table, parts: int):
    """Grams of a block with the triples others may know, and others' words and pairs."""
    grams = Grams(docs.column("text").combine_chunks())
    low = answers.filter(pc.invert(answers.column("triples")))
    known = grams.others(parts, 0, _answers(low))
    pair = known[1] > 0
    grams.add(pair & shifted(pair))
    return grams, known


def _answers(table: pa.Table) -> list[tuple]:
    return list(zip(*(table.column(c).to_pylist() for c in ("part", "wide", "totals"))))


def _count_triples(parts: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        return _rows(key, _with_triples(docs, answers, parts)[0].packed(parts, 2))
    return run


def _sum(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Corpus counts of a part's n-grams, answered to each block in its order."""
    sizes = table.column("n").to_pylist()
    keys = [np.cumsum(unsqueeze(k, n, np.uint64), dtype=np.uint64)
            for k, n in zip(table.column("keys").to_pylist(), sizes)]
    counts = [unsqueeze(c, n, np.uint32) for c, n in zip(table.column("counts").to_pylist(), sizes)]
    every, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, np.concatenate(counts), len(every)).astype(np.int64)[where]
    wide = total.max() >= 2**32
    total = total.astype(np.int64 if wide else np.uint32)
    answers = [squeeze(a) for a in np.split(total, np.cumsum(sizes)[:-1])]
    return pa.table({"block": table.column("block"), "part": table.column("part"),
                     "wide": pa.array([bool(wide)] * len(keys)),
                     "totals": pa.array(answers, pa.binary())})


def _score(parts: int, words: int, backoff: float):
    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams, known = _with_triples(docs, answers, parts)
        others = known + grams.others(parts, 2, _answers(answers.filter(answers.column("triples"))))
        return pa.table(_sums(grams, others, words, backoff) | {"doc_id": docs.column("doc_id")}
                        ).select([c.split()[0] for c in _OUT.split(", ")])
    return run


def _sums(grams: Grams, others: list[np.ndarray], words: int, backoff: float) -> dict:
    n = len(grams.doc)
    c1, c2, c3 = others
    own = grams.sizes[grams.doc]
    score = np.maximum(c1, 1) / np.maximum(words - own, 1)
    level = np.where(c1 > 0, 1, 0)
    depth = np.minimum(grams.place, ORDER - 1)
    two = c2 > 0
    bigram = np.where(two, c2 / np.maximum(shifted(c1), 1), backoff * score)
    three = c3 > 0
    trigram = np.where(three, c3 / np.maximum(shifted(c2), 1), backoff * bigram)
    value = np.where(depth == 0, score, np.where(depth == 1, bigram, trigram))
    level = np.where(three, 3, np.where(two, 2, level))
    docs = len(grams.sizes)
    total = np.bincount(grams.doc, np.log10(value), docs)
    held = [np.bincount(grams.doc, level == k, docs).astype(np.int64) for k in (3, 2, 1, 0)]
    empty = grams.sizes == 0
    return {"n_words": pa.array(grams.sizes), "n_trigram": pa.array(held[0]),
            "n_bigram": pa.array(held[1]), "n_unigram": pa.array(held[2]),
            "n_unseen": pa.array(held[3]),
            "mean_log10": pa.array(total / np.maximum(grams.sizes, 1), mask=empty)}


def backoff_scores(docs: DataFrame, backoff: float = BACKOFF, block_bytes: int = BLOCK_BYTES
                   ) -> DataFrame:
    """Per document the words, by which order each was scored, and the mean
    logarithm of the scores.

    Words are folded to lower case (A to Z). A word nobody else uses counts as
    seen once. A null or blank text has no words and a null score; rows
    repeated in full are other documents to each other; a null id is an id
    like any other; other columns are ignored; an empty table gives no rows.
    """
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"),
                       whole_text().alias("text"))
    words, size = docs.agg(F.sum(F.regexp_count("text", F.lit(WORD))),
                           F.sum(F.octet_length("text"))).first()
    words, size = words or 0, size or 0
    blocks, parts = -(-size // block_bytes) or 1, -(-size // PART_BYTES) or 1
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("row", "doc_id"), F.lit(blocks))
                        .cast("int").alias("block"))
    sent = "part int, block int, n int, keys binary, counts binary"
    summed = "block int, part int, wide boolean, totals binary"
    counts = dealt.groupBy("block").applyInArrow(_count(parts), sent)
    low = counts.groupBy("part").applyInArrow(_sum, summed).withColumn("triples", F.lit(False))
    counts = dealt.groupBy("block").cogroup(low.groupBy("block")).applyInArrow(
        _count_triples(parts), sent)
    high = counts.groupBy("part").applyInArrow(_sum, summed).withColumn("triples", F.lit(True))
    answers = low.unionByName(high)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(parts, words, backoff), _OUT)
