"""Repair of conversation structure by rank-convergence parallel Viterbi.

A repaired conversation reads ``(s?(ua)+)?`` in role initials: an optional
system turn, then user and assistant in turn. Keeping, rerolling, deleting and
inserting turns are the steps of a Viterbi search with four states. Its vector
of costs still to come runs backwards over the turns, and long conversations
are cut into chunks that run side by side, each from a guessed vector. A few
turns later the guess no longer shows but for a constant (the product of cost
matrices has fallen to rank one), so fix-up passes hand each chunk the vector
its successor really starts with and rerun it, until all handed vectors differ
from the used ones by constants only. The constants are summed up, and the
least audit is traced forwards along the stitched costs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.common import ready, spread_join
from rosterlake.operators.joins import with_group_stats
from rosterlake.session import cut

CHUNK = 128               # turns that one step of a pass runs over
# fixed values of the rules
DELETE, REROLE, INSERT, UNFINISHED = 3, 2, 2, 1
SYSTEM, USER, ASSISTANT = 1, 2, 3          # a turn's role initial, 0: another
BLANK, SEEN, CUT_OFF = 4, 8, 16            # a turn's fault, beside the initial
# states: nothing yet, after a system turn, after a user, after an assistant
EXPECTED = (2, 2, 3, 2)                    # what a rerolled or inserted turn leads to
KEPT = {(0, SYSTEM): 1, (0, USER): 2, (1, USER): 2, (3, USER): 2, (2, ASSISTANT): 3}
ENDED = (0, 4, 2, 0)                       # costs still to come after the last turn
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

Vector = tuple[int, ...]


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def damage(turns: DataFrame) -> DataFrame:
    """Drop, empty, blunt, repeat or rename turns by the crc32 of
    ``conv_id:turn`` (a null there is one space), as a test bed for the repair;
    a null role or text is one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = (F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    return (turns.select(F.col("conv_id").cast("long").alias("conv_id"),
                         F.col("turn").cast("long").alias("turn"), space("role").alias("role"),
                         space("text").alias("text"), lot.alias("lot"))
            .where("lot <> 0")
            .select("conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"),
                    F.explode(F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1)))
                              .otherwise(F.array(F.lit(0)))).alias("again")).drop("again"))


# ---- the search inside a chunk ---------------------------------------------

def closed(b0: int, b1: int, b2: int, b3: int) -> Vector:
    """Costs still to come once turns may be inserted first."""
    user = min(b2, b3 + INSERT)
    return min(b0, user + INSERT), min(b1, user + INSERT), user, min(b3, b2 + INSERT)


def before(code: int, after: Vector) -> Vector:
    """Costs still to come before a turn, from those after it."""
    out = [a + DELETE for a in after]
    if not code & (BLANK | SEEN):
        more, role = UNFINISHED if code & CUT_OFF else 0, code & 3
        for s in range(4):
            out[s] = min(out[s], after[EXPECTED[s]] + REROLE + more)
            to = KEPT.get((s, role))
            if to is not None:
                out[s] = min(out[s], after[to] + more)
    return closed(*out)


def leveled(v: Vector) -> tuple[Vector, int]:
    """The vector with its least cost taken off, and that cost."""
    least = min(v)
    return tuple(x - least for x in v), least


def backward(codes: bytes, end: Vector) -> list[Vector]:
    """The vectors before every turn and after the last."""
    out = [end]
    for code in reversed(codes):
        out.append(before(code, out[-1]))
    return out[::-1]


def start_of(codes: bytes, end: Vector) -> Vector:
    for code in reversed(codes):
        end = before(code, end)
    return end


def fixed_up(codes: bytes, used: Vector, came: Vector, start: Vector) -> Vector:
    """The chunk's first vector from ``came`` instead of ``used``. Both runs go
    on together until they differ by a constant; the rest is known then."""
    for code in reversed(codes):
        (a, low), (b, high) = leveled(used), leveled(came)
        if a == b:
            return tuple(x + high - low for x in start)
        used, came = before(code, used), before(code, came)
    return came


def trace(codes: bytes, vectors: list[Vector], state: int, last: bool) -> tuple[str, list, int]:
    """The least audit from ``state`` on, as letters, as (turn or None, role or
    None for the own one) of all turns that come out, and the state at the end."""
    letters, lines, i = [], [], 0
    while True:
        todo = vectors[i][state]
        to = EXPECTED[state]
        role = "user" if to == 2 else "assistant"
        code = codes[i] if i < len(codes) else None
        if code is not None and vectors[i + 1][state] + DELETE == todo:
            letters.append("D")
            i += 1
            continue
        if (code is not None or last) and vectors[i][to] + INSERT == todo:
            letters.append("I")
            lines.append((None, role))
            state = to
            continue
        if code is None:
            return "".join(letters), lines, state
        more = UNFINISHED if code & CUT_OFF else 0
        own = KEPT.get((state, code & 3))
        if own is not None and vectors[i + 1][own] + more == todo:
            letters.append("K")
            lines.append((i, None))
            state = own
        else:
            letters.append("R")
            lines.append((i, role))
            state = to
        i += 1


# ---- rows to chunks ---------------------------------------------------------

def _faults(turns: DataFrame) -> DataFrame:
    """Turns without their texts, in order, each with its code.

    Equal turns of a conversation (same place, role and text) are counted on
    the map side first, so a turn repeated very often is one row until the end.
    """
    bare = _trimmed(F.col("text"))
    same = turns.select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut_off")).groupBy(
        "conv_id", "turn", "role", "digest", "blank", "cut_off").agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    same = with_group_stats(same, ["conv_id", "role", "digest"], first=F.min(place))
    initial = F.substring("role", 1, 1)
    code = (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
            .otherwise(0))
    seen = (F.col("copy") > 1) | (place > F.col("first"))
    fault = (F.when(F.col("blank"), BLANK).when(seen, SEEN).when(F.col("cut_off"), CUT_OFF).otherwise(0))
    order = ["conv_id", "turn", "role", "digest", "copy"]
    return (same.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select(*order, (code + fault).cast("int").alias("code"))
            .repartitionByRange(*order).sortWithinPartitions(*order).drop("copy"))


_CHUNKS = ("slice int, place long, conv_id long, codes binary, turns array<long>, roles array<string>, "
           "digests array<string>, lo long, hi long, spread long, blank long, seen long, cut_off long, "
           "illegal long, opens long, ends long")


def _chunk_row(conv, rows: list[tuple]) -> dict:
    codes = bytes(r[3] for r in rows)
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [c & 3 for c in codes]
    return {"conv_id": conv, "codes": codes, "turns": [r[0] for r in rows], "roles": [r[1] for r in rows],
            "digests": [r[2] for r in rows], "lo": turns[0] if turns else None,
            "hi": turns[-1] if turns else None, "spread": len(set(turns)),
            "blank": sum(1 for c in codes if c & BLANK), "seen": sum(1 for c in codes if c & SEEN),
            "cut_off": sum(1 for c in codes if c & CUT_OFF),
            "illegal": sum(p not in LEGAL for p in zip(initials, initials[1:])),
            "opens": initials[0], "ends": initials[-1]}


def _chunks(chunk: int):
    """Sorted turns to rows of at most ``chunk`` turns of one conversation."""
    schema = pa.schema([
        ("slice", pa.int32()), ("place", pa.int64()), ("conv_id", pa.int64()), ("codes", pa.binary()),
        ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
        ("digests", pa.list_(pa.string())), *((n, pa.int64()) for n in (
            "lo", "hi", "spread", "blank", "seen", "cut_off", "illegal", "opens", "ends"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_, place, conv, held = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            out = []
            for c, turn, role, digest, code in zip(*(col.to_pylist() for col in batch.columns)):
                if held and (c != conv or len(held) == chunk):
                    out.append(_chunk_row(conv, held))
                    held = []
                conv = c
                held.append((turn, role, digest, code))
            yield _numbered(out, slice_, place, schema)
            place += len(out)
        yield _numbered([_chunk_row(conv, held)] if held else [], slice_, place, schema)
    return run


def _numbered(rows: list[dict], slice_: int, place: int, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [r | {"slice": slice_, "place": place + i} for i, r in enumerate(rows)], schema=schema)


def _dense(chunks: DataFrame) -> DataFrame:
    """Chunk numbers without gaps, in the order of the slices."""
    # one row per slice
    sizes = sorted((r["slice"], r["count"]) for r in chunks.groupBy("slice").count().collect())
    starts, at = [], 0
    for slice_, n in sizes:
        starts.append((slice_, at))
        at += n
    starts = chunks.sparkSession.createDataFrame(starts, "slice int, start long")
    return chunks.join(F.broadcast(starts), "slice").withColumn(
        "number", F.col("start") + F.col("place")).drop("slice", "place", "start")


# ---- passes over chunks -----------------------------------------------------

def _mapped(fn, types: list[tuple[str, pa.DataType]]):
    schema = pa.schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([fn(r) for r in batch.to_pylist()], schema=schema)
    return run


_LONGS, _KEY = pa.list_(pa.int64()), [("number", pa.int64()), ("conv_id", pa.int64())]
_STATE = _KEY + [("codes", pa.binary()), ("used", _LONGS), ("start", _LONGS), ("changed", pa.bool_())]
_STATE_DDL = "number long, conv_id long, codes binary, used array<long>, start array<long>, changed boolean"


def _guess(row: dict) -> dict:
    used = leveled(ENDED)[0]
    return row | {"used": used, "start": leveled(start_of(row["codes"], used))[0], "changed": True}


def _pass(row: dict) -> dict:
    came, used = row.pop("came"), tuple(row["used"])
    if came is None or tuple(came) == used:
        return row | {"changed": False}
    start = fixed_up(row["codes"], used, tuple(came), tuple(row["start"]))
    return row | {"used": came, "start": leveled(start)[0], "changed": True}


def _exits(row: dict) -> dict:
    vectors = backward(row["codes"], tuple(row["used"]))
    return {"number": row["number"] + 1, "conv_id": row["conv_id"],
            "to": [trace(row["codes"], vectors, s, False)[2] for s in range(4)]}


def solve_chunks(parts: DataFrame) -> tuple[DataFrame, int]:
    """(number, conv_id, used, entry) of the chunks of cut conversations, and
    the number of fix-up passes.

    Chunks meet their neighbours by number, so no conversation is gathered;
    entry states come from the exits of all chunks before by doubling.
    """
    state = cut(parts.select("number", "conv_id", "codes").mapInArrow(_mapped(_guess, _STATE), _STATE_DDL))
    passes = 0
    while not state.where("changed").isEmpty():
        came = state.select((F.col("number") - 1).alias("number"), "conv_id", F.col("start").alias("came"))
        state = cut(spread_join(state, came, ["number", "conv_id"], "left").select(
            *[n for n, _ in _STATE], "came").mapInArrow(_mapped(_pass, _STATE), _STATE_DDL))
        passes += 1
    exits = state.mapInArrow(_mapped(_exits, _KEY + [("to", pa.list_(pa.int32()))]),
                             "number long, conv_id long, to array<int>")
    none = F.array(*[F.lit(0)] * 4)
    links = cut(spread_join(state.select("number", "conv_id", "used"), exits, ["number", "conv_id"], "left")
                .withColumn("to", F.coalesce("to", none)))
    open_, hop = F.size(F.array_distinct("to")) > 1, 1
    while not links.where(open_).isEmpty():
        earlier = links.select((F.col("number") + hop).alias("number"), "conv_id", F.col("to").alias("from"))
        step = F.transform("from", lambda s: F.element_at("to", s + 1))
        links = cut(spread_join(links, earlier, ["number", "conv_id"], "left")
                    .withColumn("to", F.when(open_, step).otherwise(F.col("to"))).drop("from"))
        hop *= 2
    return links.select("number", "conv_id", "used", F.element_at("to", 1).alias("entry")), passes


def _decide(row: dict) -> dict:
    codes, first, last = row["codes"], row["first"], row["last"]
    used = tuple(row["used"] or leveled(ENDED)[0])
    vectors = backward(codes, used)
    audit, made, _ = trace(codes, vectors, row["entry"] or 0, last)
    lines, lead = [], ""
    for i, role in made:
        if i is None:
            lead += f"{role}:\n"
            continue
        lines.append({"last": False, "turn": row["turns"][i], "role": row["roles"][i],
                      "digest": row["digests"][i], "lead": lead, "new_role": role or row["roles"][i]})
        lead = ""
    if lead:
        # only at the very end: before a deleted turn an insertion is never the least audit
        lines.append({"last": True, "turn": None, "role": "", "digest": "", "lead": lead, "new_role": None})
    start, low = leveled(vectors[0])
    return {"number": row["number"], "conv_id": row["conv_id"], "audit": audit, "lines": lines,
            "cost": low + (start[0] if first else 0)}


_LINE = [("last", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string()),
         ("lead", pa.string()), ("new_role", pa.string())]
_LINES_DDL = ("array<struct<last: boolean, turn: long, role: string, digest: string, lead: string, "
              "new_role: string>>")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per conversation from lines and texts in order; only the line
    that waits for its text is held."""
    conv, running, wait, any_ = None, None, None, False

    def digest():
        return {"conv_id": conv, "repaired_sha256": running.hexdigest()}

    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if running is None or r["conv_id"] != conv:
                if running is not None:
                    done.append(digest())
                conv, running, wait, any_ = r["conv_id"], hashlib.sha256(), None, False
            key = (r["turn"], r["role"], r["digest"])
            if r["lead"] is not None:
                lead = r["lead"]
                if r["new_role"] is None:
                    # only inserted turns: without the break that would follow
                    running.update((("\n" if any_ else "") + lead[:-1]).encode())
                    any_ = True
                else:
                    wait = (key, lead, r["new_role"])
            elif wait and wait[0] == key:
                running.update((("\n" if any_ else "") + f"{wait[1]}{wait[2]}:{r['text']}").encode())
                wait, any_ = None, True
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    yield pa.RecordBatch.from_pylist([digest()] if running is not None else [], schema=schema)


def repair(turns: DataFrame, originals: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: its faults, the least cost of a repair, the
    ASCII-least audit of that cost and the hash of the repaired turns.

    ``turns``: conv_id, turn, role, text (none of the last two null);
    ``originals``: a table whose conv_id values all get a row.

    Turns are sorted by range and cut into chunks, so a conversation may be of
    any length; its hash is one sequential stream by nature, read in order with
    a turn at a time in memory, and its audit is one value. Order: turn with
    nulls first, then role, then hash of the text; repeated rows are duplicates
    of the first. A null conv_id is a conversation. Blank turns never count as
    duplicates. Other columns are ignored; an empty table gives no rows.
    """
    ready(turns.sparkSession)
    chunks = cut(_dense(cut(_faults(turns).mapInArrow(_chunks(chunk), _CHUNKS))))
    earlier = chunks.select((F.col("number") + 1).alias("number"), "conv_id", F.lit(False).alias("first"),
                            F.col("hi").alias("hi_before"), F.col("ends").alias("role_before"))
    later = chunks.select((F.col("number") - 1).alias("number"), "conv_id", F.lit(False).alias("last"))
    key = ["number", "conv_id"]
    # the neighbours of a chunk in its conversation; arrays stay in the written table
    placed = spread_join(spread_join(chunks.select(*key, "opens", "lo"), earlier, key, "left"), later, key, "left")
    legal = (F.col("role_before") * 4 + F.col("opens")).isin(*[4 * a + b for a, b in sorted(LEGAL)])
    true = F.lit(True)
    placed = cut(placed.select(
        *key, F.coalesce("first", true).alias("first"), F.coalesce("last", true).alias("last"),
        (F.col("first").isNotNull() & ~legal).cast("long").alias("illegal_edge"),
        F.coalesce(F.col("lo") == F.col("hi_before"), F.lit(False)).cast("long").alias("same_turn")))
    multi = placed.where("NOT (first AND last)").select(*key)
    solved = placed.sparkSession.createDataFrame([], "number long, conv_id long, used array<long>, entry int")
    if not multi.isEmpty():
        solved, _ = solve_chunks(spread_join(chunks.select(*key, "codes"), multi, key))
    types = _KEY + [("audit", pa.string()), ("lines", pa.list_(pa.struct(_LINE))), ("cost", pa.int64())]
    ready_ = spread_join(spread_join(chunks.select(*key, "codes", "turns", "roles", "digests"),
                                     placed.select(*key, "first", "last"), key), solved, key, "left")
    decided = cut(ready_.mapInArrow(_mapped(_decide, types),
                                    f"number long, conv_id long, audit string, lines {_LINES_DDL}, cost long"))
    counts = spread_join(chunks.drop("codes", "turns", "roles", "digests"),
                         placed.drop("first", "last"), key)
    counts = counts.groupBy("conv_id").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum(F.col("spread") - F.col("same_turn")).alias("spread"), F.sum("blank").alias("blank"),
        F.sum("seen").alias("duplicate"), F.sum("cut_off").alias("truncated"),
        F.sum(F.col("illegal") + F.col("illegal_edge")).alias("illegal"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    gaps = F.coalesce(F.expr("try_cast(g AS long)"), F.lit(0))
    counts = counts.withColumn("g", wide("hi") - wide("lo") + 1 - wide("spread")).withColumn("gaps", gaps)
    audits = decided.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "audit"))),
                                 lambda x: x["audit"]), "").alias("audit"))
    lines = decided.select("conv_id", F.explode("lines").alias("l")).select(
        "conv_id", "l.*", F.lit(None).cast("string").alias("text"))
    texts = turns.where(_trimmed(F.col("text")) != "").select(
        "conv_id", F.lit(False).alias("last"), "turn", "role", F.sha2("text", 256).alias("digest"),
        F.lit(None).cast("string").alias("lead"), F.lit(None).cast("string").alias("new_role"), "text")
    order = ["conv_id", "last", "turn", "role", "digest", F.col("lead").isNull()]
    hashes = (lines.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)
              .mapInArrow(_hashes, "conv_id long, repaired_sha256 string"))
    all_ = turns if originals is None else originals
    all_ = all_.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = all_
    for part in (counts, audits, hashes):
        out = spread_join(out, part, ["conv_id"], "left")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    return out.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repaired_conversations(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The report of ``repair`` on the damaged form of all given turns."""
    return repair(damage(turns), turns, chunk)
