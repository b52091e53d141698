"""Near copies by SimHash and ball hashing that meets in the middle.

Two fingerprints at most ``radius`` bits apart have a common value within half
the radius of both. Every distinct fingerprint therefore emits all values
within half the radius, values are shuffled, and whoever meets on one is
linked. Only a value's leading bits are its shuffle key: a fingerprint is sent
once for each variant of its leading bits, with the number of bits it may still
flip, and the remaining flips are made where it arrives, so that the balls of
2,081 values never reach the disk.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from rosterlake.llm.common import ready, slices, spread_join, whole_text
from rosterlake.llm.components import connected
from rosterlake.session import cut

SHINGLE = 4
RADIUS = 4
GROUP = 64                # fingerprints per value of the leading bits, on average
EXPANDED = 2_000_000      # values a task expands at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the hashes of all word shingles; no word: zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(
        starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.unpackbits(hashes[at:at + (1 << 14)].view(np.uint8), bitorder="little")
        counts += part.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return sum(1 << int(b) for b in bits)


def _fingerprints(names: list[str], shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found = np.array([fingerprint(t, shingle) for t in slices(texts)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(n)) for n in names],
                 pa.array(found.view(np.int64))], [*names, "fingerprint"])
    return run


def with_fingerprint(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns and the fingerprint as a signed long."""
    ready(docs.sparkSession)
    schema = T.StructType([docs.schema[c] for c in keep]).add("fingerprint", T.LongType())
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    return source.mapInArrow(_fingerprints(keep, shingle), schema)


_masks: dict[tuple[int, int], np.ndarray] = {}


def flips(bits: int, most: int) -> np.ndarray:
    """All masks of at most ``most`` of the lowest ``bits`` bits."""
    if (bits, most) not in _masks:
        _masks[bits, most] = np.array([sum(1 << b for b in c) for r in range(most + 1)
                                       for c in combinations(range(bits), r)], np.uint64)
    return _masks[bits, most]


def ball_size(bits: int, most: int) -> int:
    return sum(comb(bits, r) for r in range(most + 1))


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            return root
    return root


def meetings(prints: np.ndarray, left: np.ndarray, fixed: int, radius: int):
    """Pairs of positions that meet on a value; at most one per meeting of two
    neighbours in a run, since all of a run are linked through it.

    All have the same ``fixed`` leading bits in the values they emit and may
    flip ``left`` of the others. Too many at once are parted by the next bits.
    """
    bits = 64 - fixed
    sizes = np.array([ball_size(bits, k) for k in range(int(left.max()) + 1)])
    if int(sizes[left].sum()) > EXPANDED and len(prints) > 1 and bits >= 8:
        byte = (prints >> np.uint64(bits - 8)) & np.uint64(255)
        for value in range(256):
            used = np.bitwise_count(byte ^ np.uint64(value)).astype(np.int64)
            mine = np.flatnonzero(used <= left)
            if len(mine) > 1:
                # the flips made so far are part of the value, not of the print
                for a, b in meetings(prints[mine], (left - used)[mine], fixed + 8, radius):
                    yield mine[a], mine[b]
        return
    values, owners = [], []
    for k in range(int(left.max()) + 1):
        mine = np.flatnonzero(left == k)
        masks = flips(bits, k)
        low = prints[mine] & np.uint64((1 << bits) - 1 if bits < 64 else 2**64 - 1)
        values.append((low[:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(mine, len(masks)))
    values, owners = np.concatenate(values), np.concatenate(owners)
    by = np.argsort(values)
    values, owners = values[by], owners[by]
    same = np.flatnonzero(values[1:] == values[:-1])
    a, b = owners[same], owners[same + 1]
    code = np.unique(np.minimum(a, b) * len(prints) + np.maximum(a, b))
    a, b = code // len(prints), code % len(prints)
    true = np.bitwise_count(prints[a] ^ prints[b]) <= radius
    yield a[true], b[true]


def _links(fixed: int, radius: int):
    """Per value of the leading bits a forest of the links found there."""
    def solve(t: pa.Table):
        keys = t.column("lead").to_numpy()
        prints = t.column("fingerprint").to_numpy().view(np.uint64)
        left = t.column("left").to_numpy().astype(np.int64)
        begins = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        for a, b in zip(begins, np.append(begins[1:], len(keys))):
            if b - a < 2:
                continue
            mine = prints[a:b]
            pairs = list(meetings(mine, left[a:b], fixed, radius))
            if not pairs:
                continue
            x, y = (np.concatenate(c) for c in zip(*pairs))
            root = roots_of(len(mine), x, y)
            moved = np.flatnonzero(root != np.arange(len(mine)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(mine[moved].view(np.int64)), pa.array(mine[root[moved]].view(np.int64))],
                ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.concat_tables([*held, pa.Table.from_batches([batch])])
            keys = t.column("lead").to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield from solve(t.slice(0, last))
            held = [t.slice(last)]
        if held:
            yield from solve(held[0])
    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between distinct fingerprints that join exactly those
    reachable over pairs at most ``radius`` bits apart."""
    if radius % 2:
        raise ValueError("the radius must be even: two values within half of it always link")
    half = radius // 2
    n = max(prints.count(), 1)
    fixed = min(max(int(n // GROUP).bit_length(), 6), 24)
    masks = [(sum(1 << b for b in c), half - r) for r in range(half + 1)
             for c in combinations(range(fixed), r)]
    variants = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"),
                                  F.lit(k).cast("int").alias("left")) for m, k in masks])
    sent = prints.select("fingerprint", F.explode(variants).alias("v")).select(
        F.shiftrightunsigned("fingerprint", 64 - fixed).bitwiseXOR(F.col("v.mask")).alias("lead"),
        "fingerprint", F.col("v.left").alias("left"))
    return sent.repartition("lead").sortWithinPartitions("lead").mapInArrow(
        _links(fixed, radius), "a long, b long")


def group_table(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component_id): of each distinct fingerprint the smallest
    id among all documents reachable from it; null if those have none."""
    prints = cut(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")))
    found = connected(links(prints, radius))
    rooted = prints.join(found, prints["fingerprint"] == found["node"], "left").select(
        "fingerprint", "doc_id", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return cut(spread_join(rooted, least, ["root"], "left").select("fingerprint", "component_id"))


def near_copies(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: fingerprint in hex and component.

    A null or blank text has fingerprint zero and links like any other; a null
    id is never the name of a component that has another; repeated rows come
    out repeated; other columns are ignored.
    """
    marked = cut(with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                              whole_text().alias("text")), ["doc_id"], shingle))
    grouped = spread_join(marked, group_table(marked, radius), ["fingerprint"])
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
                          .alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The document with the smallest id of each component, columns unchanged.

    Documents without an id stay only where no other stands for their group,
    one of each group.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.struct(*docs.columns).alias("doc"))
    marked = cut(with_fingerprint(docs, ["doc_id"], shingle))
    groups = group_table(marked, radius)
    first = spread_join(marked, groups, ["fingerprint"]).where(
        F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "fingerprint").agg(
        F.count(F.lit(1)).alias("rows"))
    # an id carried by rows of several groups names the rows by print as well
    first = cut(first)
    repeated = not first.where("rows > 1 OR doc_id IS NULL").isEmpty()
    kept = spread_join(with_fingerprint(docs, ["doc_id", "doc"], shingle),
                       first.select("doc_id", "fingerprint"), ["doc_id", "fingerprint"],
                       "left_semi")
    if repeated:
        kept = kept.dropDuplicates(["doc_id", "fingerprint"])
    return kept.select("doc.*")
