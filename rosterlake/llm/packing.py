"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A solution is a list of sequences, and the sequences are its genes. Crossover
injects the well-filled sequences of one parent whole into the other, takes out
the sequences that hold documents a second time, lets displaced documents take
the place of others where that fills a sequence better, and best-fits the rest. Documents are dealt into blocks of bounded size; each block is
evolved on several islands in separate tasks, and between epochs an island's
elite moves to the next island of the block. Documents of sequences that stay
badly filled are dealt into blocks again and packed together.
"""

from __future__ import annotations

import os
import random
import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import ready, row_key, tidy, whole_text
from rosterlake.operators.rows import surrogate_id
from rosterlake.session import cut

CAPACITY = 4096
END_ID = 1
BLOCK = 8192              # pieces of a block, about
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
CHILDREN = 6              # per island and epoch
DEALS = 7                 # rounds of dealing into blocks, at most
FULL = 0.98               # filled to this share a sequence is final
CACHE = 500_000           # plain runs a worker remembers
TRIES = 200               # sequences an exchange looks at
RUN_CACHE = 300_000       # runs as they stand a worker remembers
STRETCH = 1000            # texts whose runs are encoded together
_PIECE = "doc_id long, row long, piece int, start long, length int, ids_crc32 long"


# white space to Python, but not to the tokenizer
SOLID = "\x1c\x1d\x1e\x1f"
RUN = re.compile(r"[\S\x1c-\x1f]+")


def non_blanks(text: str) -> list[str]:
    """The runs between what the tokenizer's ``\\s`` matches."""
    # four scans for one character are far cheaper than one for a set
    a, b, c, d = SOLID
    return RUN.findall(text) if a in text or b in text or c in text or d in text else text.split()


class Words(dict):
    """Token ids of a run of non-blanks, as little-endian bytes.

    The tokenizer drops white space and never joins across it, so a text is
    the chain of its runs. Runs are remembered as they stand, and plain ones
    beside them for longer. Letters closed by punctuation are two runs to it,
    and case is folded, so most runs are found under a plainer one. The runs
    that are left are encoded together, once for a stretch of texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # tasks are the parallel unit
        from tokenizers import Tokenizer
        super().__init__()
        self.plain: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)

    @staticmethod
    def parts(run: str) -> tuple[str, ...]:
        """Plainer runs that give the same ids; the run itself if none do."""
        if run.isascii():
            folded = run if run.islower() else run.lower()
            stem = folded.rstrip(".,;:!?|#$%&*")
            if stem.isalpha():
                return (stem, folded[len(stem):]) if len(stem) < len(folded) else (folded,)
        elif run[-1] in ".,;:!?" and run[:-1].isalpha():
            return run[:-1], run[-1]
        return (run,)

    def learn(self, texts: list[list[str]]) -> None:
        """Get to know all runs of the texts; a run known already costs one look."""
        if len(self) > RUN_CACHE:
            self.clear()
        if len(self.plain) > CACHE:
            self.plain.clear()
        plain = self.plain
        new = set().union(*texts).difference(self)
        split = {run: self.parts(run) for run in new}
        fresh = {p for parts in split.values() for p in parts}.difference(plain)
        # letters are one word to the tokenizer, so many can be told apart in one text;
        # one capital of this range folds to more than letters
        letters = sorted(w for w in fresh if w.isalpha() and ord(max(w)) < 0x250
                         and "\u0130" not in w)
        lists = [letters[at:at + 64] for at in range(0, len(letters), 64)]
        for words, made in zip(lists, self.tokenizer.encode_batch(
                [" ".join(w) for w in lists], add_special_tokens=False)):
            ids: list[array] = [array("I") for _ in words]
            for i, k in zip(made.ids, made.word_ids):
                ids[k].append(i)
            plain.update(zip(words, [i.tobytes() for i in ids]))
        rest = sorted(fresh.difference(letters))
        for run, made in zip(rest, self.tokenizer.encode_batch_fast(
                rest, add_special_tokens=False)):
            plain[run] = array("I", made.ids).tobytes()
        for run, parts in split.items():
            self[run] = plain[parts[0]] if len(parts) == 1 else b"".join([plain[p] for p in parts])


_words: dict[str, Words] = {}


def _tokenize(path: str, capacity: int):
    step = 4 * capacity
    if array("I").itemsize != 4 or sys.byteorder != "little":
        raise RuntimeError("ids are taken as little-endian unsigned 32-bit numbers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _words:
            tidy()
            _words[path] = Words(path)
        words = _words[path]
        close = array("I", [END_ID]).tobytes()
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            column = batch.column(2)
            for first in range(0, batch.num_rows, STRETCH):
                texts = [non_blanks(t or "") for t in column.slice(first, STRETCH).to_pylist()]
                words.learn(texts)
                for i, runs in enumerate(texts, first):
                    ids = b"".join(map(words.__getitem__, runs)) + close
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        row.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64())],
                ["doc_id", "row", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids, closed by ``END_ID`` and cut where longer than a
    sequence. A null text is empty and gives the closing id alone."""
    ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"),
                       whole_text().alias("text")).mapInArrow(_tokenize(tokenizer, capacity), _PIECE)


Solution = list[list[int]]


def best_fit(bins: Solution, items: list[int], size: list[int], capacity: int,
             order: dict[int, float] | None = None) -> None:
    """Put each item, the largest first or by ``order``, where it leaves least room."""
    rooms = sorted((capacity - sum(size[i] for i in b), k) for k, b in enumerate(bins))
    for i in sorted(items, key=lambda i: (-(order[i] if order else size[i]), i)):
        at = bisect_left(rooms, (size[i], -1))
        if at < len(rooms):
            room, k = rooms.pop(at)
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        if room > size[i]:
            insort(rooms, (room - size[i], k))


def exchange(bins: Solution, displaced: list[int], size: list[int], capacity: int,
             rng: random.Random, tries: int = TRIES) -> list[int]:
    """Displaced items that fill a sequence better take the place of one of its
    own: one for one, or two for one. Returns what is displaced afterwards."""
    free = sorted((size[i], i) for i in displaced)
    for k in rng.sample(range(len(bins)), min(tries, len(bins))):
        room = capacity - sum(size[i] for i in bins[k])
        for i in sorted(bins[k], key=lambda i: size[i]):
            if not room or not free:
                break
            own, most = size[i], size[i] + room
            at = bisect_left(free, (most + 1, -1)) - 1
            pick = [at] if at >= 0 and free[at][0] > own else []
            filled = free[at][0] if pick else own
            for x in range(min(len(free), 16)):
                small = x * len(free) // min(len(free), 16)
                y = bisect_left(free, (most - free[small][0] + 1, -1)) - 1
                if y > small and free[small][0] + free[y][0] > filled:
                    pick, filled = [small, y], free[small][0] + free[y][0]
            if pick:
                came = [free.pop(p)[1] for p in sorted(pick, reverse=True)]
                bins[k] = [j for j in bins[k] if j != i] + came
                insort(free, (own, i))
                room = most - filled
    return [i for _, i in free]


def fitness(bins: Solution, size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then fuller ones; smaller is better."""
    return len(bins), -sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(keep: Solution, give: Solution, size: list[int], capacity: int,
              rng: random.Random) -> Solution:
    """Whole well-filled sequences of ``give`` in place of whatever of ``keep``
    holds their documents; the displaced go where they fit best."""
    by_fill = sorted(range(len(give)), key=lambda k: -sum(size[i] for i in give[k]))
    top = by_fill[:max(1, len(by_fill) // 2)]
    gift = [list(give[k]) for k in rng.sample(top, max(1, len(top) // 3))]
    held = {i for b in gift for i in b}
    child, displaced = [], []
    for b in keep:
        if held.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in held]
    child += gift
    displaced = exchange(child, displaced, size, capacity, rng)
    best_fit(child, displaced, size, capacity)
    return child


def shaken(bins: Solution, size: list[int], capacity: int, rng: random.Random) -> Solution:
    """The worst-filled and a few other sequences opened and packed anew."""
    order = sorted(range(len(bins)), key=lambda k: sum(size[i] for i in bins[k]))
    n = max(2, len(bins) // 20)
    gone = set(order[:n]) | set(rng.sample(range(len(bins)), min(n, len(bins))))
    child = [list(b) for k, b in enumerate(bins) if k not in gone]
    free = exchange(child, [i for k in gone for i in bins[k]], size, capacity, rng)
    best_fit(child, free, size, capacity)
    return child


def loose(size: list[int], capacity: int, rng: random.Random) -> Solution:
    """Best fit in a roughly descending order, another one each time."""
    out: Solution = []
    order = {i: n * rng.uniform(0.8, 1.25) for i, n in enumerate(size)}
    best_fit(out, list(range(len(size))), size, capacity, order)
    return out


def evolve(size: list[int], capacity: int, elites: list[Solution], seed: int,
           population: int = POPULATION, children: int = CHILDREN) -> Solution:
    """The best of some generations that start from elites and random orders.

    One generation of crossover always runs, so that fill still improves where
    the start has as few sequences as the sizes allow; more run until it does.
    """
    rng = random.Random(seed)
    pool = [[list(b) for b in e] for e in elites]
    first: Solution = []
    best_fit(first, list(range(len(size))), size, capacity)
    floor_ = -(-sum(size) // capacity)
    pool.append(first)
    while len(pool) < population:
        pool.append(shaken(pool[0], size, capacity, rng) if len(pool) % 2 else loose(size, capacity, rng))
    rank = lambda b: fitness(b, size, capacity)
    pool.sort(key=rank)
    for generation in range(children):
        if generation and len(pool[0]) <= floor_:
            break
        a, b = rng.sample(range(len(pool)), 2)
        child = crossover(pool[min(a, b)], pool[max(a, b)], size, capacity, rng)
        if rng.random() < 0.5:
            child = shaken(child, size, capacity, rng)
        pool[-1] = child
        pool.sort(key=rank)
    return pool[0]


def _order(table: pa.Table) -> pa.Table:
    return table.sort_by([("row", "ascending"), ("doc_id", "ascending"), ("piece", "ascending"),
                          ("length", "ascending")])


def _as_bins(data: bytes) -> Solution:
    where = np.frombuffer(data, np.int32)
    out: Solution = [[] for _ in range(int(where.max()) + 1 if len(where) else 0)]
    for i, k in enumerate(where.tolist()):
        out[k].append(i)
    return out


def _as_bytes(bins: Solution, n: int) -> bytes:
    where = np.zeros(n, np.int32)
    for k, b in enumerate(bins):
        where[b] = k
    return where.tobytes()


def _island(capacity: int, epoch: int):
    """One epoch of one island: its own elite and the neighbour's come in."""
    def run(key, items: pa.Table, elites: pa.Table) -> pa.Table:
        block, island = (k.as_py() for k in key)
        size = _order(items).column("length").to_pylist()
        came = [_as_bins(e) for e in sorted(elites.column("elite").to_pylist())]
        best = evolve(size, capacity, came, (block * 1009 + island) * 101 + epoch)
        n, worth = fitness(best, size, capacity)
        return pa.table({"block": pa.array([block], pa.int32()), "island": pa.array([island], pa.int32()),
                         "n": pa.array([n], pa.int32()), "worth": pa.array([worth]),
                         "elite": pa.array([_as_bytes(best, len(size))], pa.binary())})
    return run


def _place(capacity: int, last: bool, full: float):
    """The winning elite of a block as places; badly filled ones go on."""
    def run(key, items: pa.Table, elites: pa.Table) -> pa.Table:
        items = _order(items)
        size = items.column("length").to_pylist()
        best = min(zip(elites.column("n").to_pylist(), elites.column("worth").to_pylist(),
                       elites.column("elite").to_pylist()))[2]
        sequence, offset = np.full(len(size), -1, np.int64), np.zeros(len(size), np.int64)
        for k, b in enumerate(_as_bins(best)):
            if not last and sum(size[i] for i in b) < full * capacity:
                continue
            at = 0
            for i in b:
                sequence[i], offset[i] = k, at
                at += size[i]
        return (items.drop_columns(["block"])
                .append_column("sequence", pa.array(sequence)).append_column("offset", pa.array(offset))
                .append_column("block", pa.array([key[0].as_py()] * len(size), pa.int32())))
    return run


def _round(items: DataFrame, blocks: int, capacity: int, last: bool, islands: int, epochs: int,
           full: float) -> DataFrame:
    """One deal of pieces into blocks, evolved on islands; sequence -1: goes on."""
    # rows repeated in full are dealt apart by the running number of the written table
    dealt = cut(items.withColumn("block", F.pmod(F.xxhash64(
        "row", "doc_id", "piece", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")))
    spread = dealt.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                          "row", "doc_id", "piece", "length")
    kind = "block int, island int, n int, worth double, elite binary"
    elites = dealt.sparkSession.createDataFrame([], kind)
    for epoch in range(epochs):
        to = elites.select("block", F.explode(F.array_distinct(F.array(
            F.col("island"), (F.col("island") + 1) % islands))).alias("island"), "elite")
        elites = cut(spread.groupBy("block", "island").cogroup(to.groupBy("block", "island"))
                     .applyInArrow(_island(capacity, epoch), kind))
    kept = _PIECE + ", sequence long, offset long, block int"
    return cut(dealt.groupBy("block").cogroup(elites.groupBy("block"))
               .applyInArrow(_place(capacity, last, full), kept))


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS,
         epochs: int = EPOCHS, full: float = FULL) -> DataFrame:
    """``items`` (as from ``pieces``) plus sequence_id and offset.

    A piece as long as a sequence fills one alone. Blocks are packed in rounds:
    what lies in sequences filled below ``full`` is dealt anew into fewer
    blocks until one block holds it or ``DEALS`` rounds are done; what the last
    round packs stays where it is, so no document is left out.
    """
    items = cut(items)
    out, number = [], 0
    whole = items.where(F.col("length") == capacity)
    base = lambda n: F.lit(n).cast("long") * F.lit(1 << 56)
    # a number each: rows repeated in full and copies of the mix have nothing else apart
    out.append(surrogate_id(whole, ["row", "doc_id", "piece"], "sequence_id").select(
        "doc_id", "row", "piece", "start", "length", "ids_crc32",
        F.col("sequence_id").cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    rest = items.where(F.col("length") < capacity)
    while True:
        number += 1
        n = rest.count()
        blocks = max(1, -(-n // block))
        last = blocks == 1 or number == DEALS
        placed = _round(rest, blocks, capacity, last, islands, epochs, full)
        out.append(placed.where("sequence >= 0").select(
            "doc_id", "row", "piece", "start", "length", "ids_crc32",
            (base(number) + F.col("block").cast("long") * F.lit(1 << 24) + F.col("sequence"))
            .alias("sequence_id"), "offset"))
        if last:
            break
        rest = placed.where("sequence < 0").select("doc_id", "row", "piece", "start", "length",
                                                   "ids_crc32")
    all_ = out[0]
    for part in out[1:]:
        all_ = all_.unionByName(part)
    return all_


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its place.

    A null text is empty and one id long; rows repeated in full are packed each
    on their own; a null id is an id like any other; other columns are ignored;
    an empty table gives no rows.
    """
    return pack(pieces(docs, tokenizer, capacity), capacity).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        "sequence_id", "offset")
