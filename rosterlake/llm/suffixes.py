"""Repeated passages by column-wise construction over many short documents.

A byte goes if some string of ``length`` bytes covers it that also starts
anywhere else in the collection. The windows of ``length`` bytes of a text are
dealt by their minimizer, the smallest hash of a ``GRAM``-byte gram in the
window (leftmost if tied), so equal windows always meet, at the same distance
from it. Consecutive windows with one minimizer make one piece of text of at
most ``2 * length`` bytes. The pieces of a minimizer are the short documents of
the construction: one symbol of each is inserted per round, from the last
column to the first; each round updates the order of the suffixes, the column
of their preceding symbols (the column's part of the transform) and the common
prefixes of neighbours. A window repeats where a common prefix reaches
``length``.

Equal windows stand in the same column, so a round needs only that column's
part of the transform and works in time proportional to the number of pieces.
What an external construction keeps in sequential files is here the sorted,
shuffled stream of pieces, read once; a block of it is bounded by
``BLOCK_PIECES``, so nothing is written outside Spark. A minimizer with more
distinct pieces than that is cut into single windows, whose equal ones are
counted with map-side combine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rosterlake.llm.common import M64, mix, ready, row_key, slices, spread_join, utf8, whole_text
from rosterlake.session import cut

LENGTH = 400
GRAM = 64
CHUNK = 1 << 20
BLOCK_PIECES = 8192
END = 256
_BASE = 0x9E3779B97F4A7C15

_PIECES = "doc_id long, key long, start long, n_windows int, ahead int, anchor long, piece long"
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(n - 1, 1).bit_length()
    if not _powers or max(_powers) < size:
        _powers.clear()
        up, down = (np.full(size, b, np.uint64) for b in (_BASE, pow(_BASE, -1, M64 + 1)))
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[max(_powers)]


class Rolling:
    """Hashes of any substring of one byte array, from prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        raw = (self.sums[start + length] - self.sums[start]) * self.down[start]
        return mix(raw ^ (np.asarray(length).astype(np.uint64) << np.uint64(32)))

    def every(self, length: int) -> np.ndarray:
        raw = (self.sums[length:] - self.sums[:-length]) * self.down[:len(self.sums) - length]
        return mix(raw ^ np.uint64(length << 32))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, in three passes."""
    n = len(x) - width + 1
    pad = np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)
    blocks = np.concatenate([x, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def pieces_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(start, windows, bytes before the minimizer, minimizer, piece hash) of
    every run of windows that share a minimizer; ``ends`` close the texts."""
    if len(data) < length:
        return None
    rolling = Rolling(data)
    grams = rolling.every(gram)
    low = np.uint64(CHUNK * 2 - 1)
    marked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_minimum(marked, length - gram + 1) & low).astype(np.int64)
    n = len(anchor)
    text_end = np.repeat(ends, np.diff(ends, prepend=0))[:n]
    inside = np.arange(n) + length <= text_end
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new)
    if not len(starts):
        return None
    stop = np.append(starts[1:], n)
    # windows that cross into the next text are not counted
    count = np.minimum(stop, text_end[starts] - length + 1) - starts
    held = anchor[starts]
    return starts, count, held - starts, grams[held], rolling.of(starts, count + length - 1)


def _chunks(at: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, rows, ends within) of stretches of about ``CHUNK`` bytes; a
    longer text is covered by stretches that share ``length - 1`` bytes."""
    i, n = 0, len(at) - 1
    while i < n:
        j = i + 1
        while j < n and at[j + 1] - at[i] <= CHUNK:
            j += 1
        if j == i + 1 and at[j] - at[i] > CHUNK:
            for a in range(int(at[i]), int(at[j]), CHUNK - length + 1):
                b = min(a + CHUNK, int(at[j]))
                yield a, b, np.array([i]), np.array([b - a])
                if b == at[j]:
                    break
        else:
            yield int(at[i]), int(at[j]), np.arange(i, j), at[i + 1:j + 1] - at[i]
        i = j


def _cut_pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = utf8(batch.column(2))
            for a, b, rows, ends in _chunks(at, length):
                got = pieces_of(flat[a:b], ends, length, _gram(length))
                if got is None:
                    continue
                start, count, ahead, anchor, piece = got
                row = rows[np.searchsorted(ends, start, side="right")]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take),
                     pa.array(start + a - at[row]), pa.array(count.astype(np.int32)),
                     pa.array(ahead.astype(np.int32)), pa.array(anchor.view(np.int64)),
                     pa.array(piece.view(np.int64))],
                    ["doc_id", "key", "start", "n_windows", "ahead", "anchor", "piece"])
    return run


def _gram(length: int) -> int:
    """Bytes of the grams that windows of ``length`` are dealt by. Short windows
    get short grams: they hold more of them, so there are fewer pieces."""
    return GRAM if length >= LENGTH else max(1, min(GRAM, length // 10))


def columns_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ahead: np.ndarray,
               length: int) -> np.ndarray:
    """Pieces side by side, minimizers aligned: a row per column of text."""
    left = int(ahead.max())
    width = left + int((sizes - ahead).max())
    table = np.full((len(starts), width), END, np.uint16)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(np.arange(len(starts)), sizes)
    table[row, within + np.repeat(left - ahead, sizes)] = data[within + np.repeat(starts, sizes)]
    return np.ascontiguousarray(table.T)


def repeated_columns(table: np.ndarray, length: int) -> np.ndarray:
    """For each column and piece: does the string of ``length`` symbols from
    there also stand in the same column of another piece?

    One symbol per piece and round, last column first. ``order`` holds the
    pieces by the suffix that starts in the column, ``common`` the common
    prefix of each with the one before. A piece that has no symbol there has an
    empty suffix with an end mark of its own: it goes last and shares nothing.
    """
    width, m = table.shape
    order, common = np.arange(m), np.zeros(m + 1, np.int16)
    found = np.zeros((width, m), bool)
    for j in range(width - 1, -1, -1):
        symbols = table[j][order]
        to = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[to]
        same = (sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] != END)
        fresh = np.zeros(m + 1, np.int16)
        near = common[to[1:]]
        apart = np.flatnonzero(same & (to[1:] != to[:-1] + 1))
        if len(apart):
            span = np.empty(2 * len(apart), np.int64)
            span[::2], span[1::2] = to[apart] + 1, to[apart + 1] + 1
            near[apart] = np.minimum.reduceat(common, span)[::2]
        fresh[1:m] = np.where(same, np.minimum(near + 1, length), 0)
        order, common = order[to], fresh
        full = fresh >= length
        if full.any():
            found[j, order[full[:-1] | full[1:]]] = True
    return found


def _runs(found: np.ndarray, left: int, ahead: np.ndarray):
    """(piece, first window, windows) of each run of repeated windows."""
    flags = np.zeros((found.shape[1], found.shape[0] + 1), np.int8)
    flags[:, :-1] = found.T
    step = np.diff(flags.ravel(), prepend=0)
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    piece = begin // flags.shape[1]
    return piece, begin % flags.shape[1] - (left - ahead[piece]), end - begin


_NEEDED = ["anchor", "piece", "n", "doc_id", "key", "start", "n_windows", "ahead"]


def _fetch(length: int):
    """The text of the wanted pieces of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(slices(batch.column(batch.schema.get_field_index("text")))):
                wanted = batch.column(batch.schema.get_field_index("wanted"))[i].values
                start = wanted.field("start").to_numpy(zero_copy_only=False)
                size = wanted.field("n_windows").to_numpy(zero_copy_only=False) + length - 1
                one = pa.array([i] * len(start))
                yield pa.RecordBatch.from_arrays(
                    [wanted.field("anchor"), wanted.field("piece"), wanted.field("n"),
                     batch.column(0).take(one), batch.column(1).take(one), wanted.field("start"),
                     wanted.field("n_windows"), wanted.field("ahead"),
                     pa.array([text[a:a + s] for a, s in zip(start.tolist(), size.tolist())],
                              pa.binary())], [*_NEEDED, "bytes"])
    return run


def _construct(length: int):
    """Whole classes of a sorted stream, block by block."""
    def solve(t: pa.Table) -> pa.RecordBatch:
        data, at = utf8(t.column("bytes").combine_chunks())
        ahead = t.column("ahead").to_numpy().astype(np.int64)
        sizes = np.diff(at)
        found = repeated_columns(columns_of(data, at[:-1], sizes, ahead, length), length)
        piece, first, count = _runs(found, int(ahead.max()), ahead)
        once = t.column("n").to_numpy()[piece] == 1
        piece, first, count = piece[once], first[once], count[once]
        at = t.column("start").to_numpy()[piece] + first
        take = pa.array(piece)
        return pa.RecordBatch.from_arrays(
            [t.column("doc_id").combine_chunks().take(take),
             t.column("key").combine_chunks().take(take), pa.array(at),
             pa.array(at + count + length - 1)], ["doc_id", "key", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows < BLOCK_PIECES:
                continue
            t = pa.concat_tables(held)
            anchors = t.column("anchor").to_numpy()
            begins = np.flatnonzero(np.diff(anchors, prepend=anchors[0] ^ 1))
            a = 0
            while True:
                # as many whole classes as a block holds, the open last one not
                fits = begins[(begins > a) & (begins <= max(a + BLOCK_PIECES,
                                                          *begins[begins > a][:1], 0))]
                if not len(fits) or t.num_rows - a < BLOCK_PIECES:
                    break
                yield solve(t.slice(a, int(fits[-1]) - a))
                a = int(fits[-1])
            held, rows = [t.slice(a)], t.num_rows - a
        if rows:
            yield solve(pa.concat_tables(held))
    return run


def _windows(length: int):
    """Every single window of the given pieces: its place and hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(batch.schema.get_field_index("bytes")))
            names = {n: batch.column(batch.schema.get_field_index(n)) for n in _NEEDED}
            start, ahead = (names[c].to_numpy() for c in ("start", "ahead"))
            for i in range(batch.num_rows):
                hashes = Rolling(data[at[i]:at[i + 1]]).every(length)
                k = np.arange(len(hashes))
                one = pa.array(np.full(len(k), i))
                yield pa.RecordBatch.from_arrays(
                    [names["anchor"].take(one), pa.array((k - ahead[i]).astype(np.int32)),
                     pa.array(hashes.view(np.int64)), names["n"].take(one),
                     names["doc_id"].take(one), names["key"].take(one), pa.array(k + start[i])],
                    ["anchor", "place", "hash", "n", "doc_id", "key", "start"])
    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH,
                   class_pieces: int = BLOCK_PIECES) -> DataFrame:
    """(doc_id, key, start, stop): stretches of bytes that go, overlapping.

    ``docs`` has doc_id, key and text (never null) first.
    """
    found = cut(docs.select("doc_id", "key", "text").mapInArrow(_cut_pieces(length), _PIECES))
    place = ["doc_id", "key", "start", "n_windows", "ahead"]
    pieces = cut(found.groupBy("anchor", "piece").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in place]))
    # every window of a piece that occurs twice repeats
    twice = spread_join(found, pieces.where("n > 1").select("anchor", "piece"),
                        ["anchor", "piece"], "left_semi")
    spans = twice.select("doc_id", "key", "start",
                         (F.col("start") + F.col("n_windows") + length - 1).alias("stop"))
    classes = cut(pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_pieces"))
                  .where("n_pieces > 1"))
    mixed = spread_join(pieces, classes, ["anchor"])
    wanted = mixed.groupBy("doc_id", "key").agg(F.collect_list(F.struct(
        "anchor", "piece", "n", "start", "n_windows", "ahead", "n_pieces")).alias("wanted"))

    def text_of(part) -> DataFrame:
        w = wanted.select("doc_id", "key", F.filter("wanted", part).alias("wanted")).where(
            F.size("wanted") > 0)
        # with all columns, so that the exchange of the texts is the one that the
        # spans are later joined to
        texts = docs.dropDuplicates(["doc_id", "key"]) if docs_repeat else docs
        joined = texts.alias("d").join(
            w.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
            & (F.col("d.key") == F.col("w.key")))
        return joined.select("d.*", "w.wanted").mapInArrow(
            _fetch(length), "anchor long, piece long, n long, doc_id long, key long, start long, "
                            "n_windows int, ahead int, bytes binary")

    # equal rows of one id would give their pieces twice; ids alone tell
    docs_repeat = not (docs.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
                       .where("n > 1").isEmpty())
    built = (text_of(lambda x: x["n_pieces"] <= class_pieces)
             .repartition("anchor").sortWithinPartitions("anchor")
             .mapInArrow(_construct(length), "doc_id long, key long, start long, stop long"))
    spans = spans.unionByName(built)
    if not classes.where(F.col("n_pieces") > class_pieces).isEmpty():
        single = cut(text_of(lambda x: x["n_pieces"] > class_pieces).mapInArrow(
            _windows(length), "anchor long, place int, hash long, n long, doc_id long, key long, "
                              "start long"))
        keys = ["anchor", "place", "hash"]
        again = single.groupBy(*keys).agg(F.sum("n").alias("all")).where("all > 1")
        rest = spread_join(single.where("n = 1"), again.select(*keys), keys, "left_semi")
        spans = spans.unionByName(rest.select("doc_id", "key", "start",
                                              (F.col("start") + length).alias("stop")))
    return spans


def merged(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Sorted disjoint stretches; ones that touch are one."""
    if not len(start):
        return []
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(stop[by])
    new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return list(zip(start[new].tolist(), reach[np.append(new[1:], len(start)) - 1].tolist()))


def with_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (with key and text) plus ``spans``, null where nothing goes."""
    spans = repeated_spans(docs, length).groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")).alias("s")
    d = docs.alias("d")
    joined = d.join(spans, F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
                    & (F.col("d.key") == F.col("s.key")), "left")
    return joined.select("d.*", "s.spans")


def _kept_parts(text: bytes, spans) -> tuple[list[bytes], int, int]:
    gone = [] if spans is None else merged(spans.field("start").to_numpy(zero_copy_only=False),
                                           spans.field("stop").to_numpy(zero_copy_only=False))
    parts, at = [], 0
    for a, b in gone:
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    return parts, sum(b - a for a, b in gone), len(gone)


def _spans_of(batch: pa.RecordBatch):
    column = batch.column(batch.schema.get_field_index("spans"))
    for x in column:
        yield x.values if x.is_valid else None


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(slices(batch.column(batch.schema.get_field_index("text"))),
                               _spans_of(batch)):
            parts, removed, n = _kept_parts(text, spans)
            rows.append((len(text), removed, n, hashlib.sha256(b"".join(parts)).hexdigest()))
        n_bytes, removed, n, kept = zip(*rows) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(n, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"),
                       whole_text().alias("text"), *more)


def removal_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document what is removed and the hash of what is left.

    A null text is empty; a null id is an id like any other; rows repeated in
    full are documents of their own that repeat each other; texts shorter than
    ``length`` bytes never change; other columns are ignored.
    """
    return with_spans(_keyed(docs), length).mapInArrow(
        _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _rewrite(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: E731,B023
            texts = []
            for text, spans in zip(slices(column("text")), _spans_of(batch)):
                # a character cut at its edge goes as a whole
                texts.append("".join(p.decode("utf-8", "ignore")
                                     for p in _kept_parts(text, spans)[0]))
            new = {"doc_id": column("doc_id"), "text": pa.array(texts, pa.string()),
                   "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [new[n] if n in new else column("rest").field(n) for n in names], names)
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Documents without their repeated passages, same columns; ``n_chars``
    follows the text. A text of which nothing is left stays, empty."""
    own = {"doc_id": T.LongType(), "text": T.StringType(), "n_chars": T.LongType()}
    rest = F.struct(F.lit(0).alias("__"), *[F.col(c) for c in docs.columns if c not in own])
    schema = T.StructType([T.StructField(f.name, own[f.name]
                                         if f.name in own else f.dataType)
                           for f in docs.schema.fields])
    return with_spans(_keyed(docs, rest.alias("rest")), length).mapInArrow(
        _rewrite(docs.columns), schema)
