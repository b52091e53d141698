"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from rosterlake.llm import turns

KIND = "conv_id long, turn long, role string, text string, codes string, number int, first string, lead int"
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else "".join(c for c in text if c not in ".!?") if lot == 2 else text
        out += [(conv, turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def repaired(rows):
    """Least cost and least audit of one conversation's rows in order."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                      "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    state = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, s, inserted):
        options = []
        if i == len(rows):
            if s in ("", "a"):
                options.append((0, "", ()))
        else:
            c, a, t = best(i + 1, s, 0)
            options.append((c + 3, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                role, text = rows[i][2:]
                for letter, to in state[s].items():
                    if role[:1] == letter:
                        c, a, t = best(i + 1, to, 0)
                        options.append((c + more, "K" + a, (f"{role}:{text}", *t)))
                    if letter in full:
                        c, a, t = best(i + 1, to, 0)
                        options.append((c + 2 + more, "R" + a, (f"{full[letter]}:{text}", *t)))
        if inserted < 3:
            for letter, to in state[s].items():
                if letter in full:
                    c, a, t = best(i, to, inserted + 1)
                    options.append((c + 2, "I" + a, (f"{full[letter]}:", *t)))
        return min(options, default=(10 ** 9, "", ()))

    cost, audit, lines = best(0, "", 0)
    numbers = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows, harm=True):
    given = damaged(rows) if harm else [r[:4] for r in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in given if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        out[conv] = repaired(mine)
    return out


def got(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 5 + ["system", "tool", "", None, "agent"])
            text = rng.choice(["a.", "b!", "no end", "é?  \n", "", " \t", None, f"text {turn}.", f"cut {turn}"])
            rows.append((conv, None if rng.random() < 0.03 else turn, role, text, "x", 1, "y", 2))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk,longest,n", [(3, 30, 40), (128, 12, 60), (1, 9, 15)])
def test_repair_equals_search(spark, chunk, longest, n):
    rows = random_rows(chunk, n, longest)
    made = got(turns.repaired_conversations(spark.createDataFrame(rows, KIND), chunk))
    assert made == expected(rows)


def test_long_conversation_in_chunks(spark):
    rows = random_rows(11, 1, 600) + [(7, t, "user" if t % 2 else "assistant", f"t{t}.", "", 1, "", 1)
                                      for t in range(500)]
    made = got(turns.repaired_conversations(spark.createDataFrame(rows, KIND), 16))
    assert made == expected(rows)


def test_many_equal_turns_and_empty_table(spark):
    rows = [(1, 5, "user", "same.", "", 1, "", 1)] * 300 + [(2, None, None, None, "", 1, "", 1)]
    harmless = [r[:2] + (r[2] or " ", r[3] or " ") + r[4:] for r in rows]
    made = got(turns.repair(spark.createDataFrame(harmless, KIND), chunk=16))
    assert made == expected(harmless, harm=False)
    assert made[1][6] == "K" + "D" * 299 + "I"
    assert got(turns.repaired_conversations(spark.createDataFrame([], KIND))) == {}


def test_passes_end_when_vectors_differ_by_constants(spark):
    """Chunks of a long conversation settle in few passes, far fewer than chunks."""
    rng = random.Random(3)
    codes = [bytes(rng.choice([turns.USER, turns.ASSISTANT, turns.USER | turns.SEEN]) for _ in range(32))
             for _ in range(40)]
    parts = spark.createDataFrame([(i, 1, c) for i, c in enumerate(codes)], "number long, conv_id long, codes binary")
    solved, passes = turns.solve_chunks(parts)
    assert passes <= 4
    whole = turns.backward(b"".join(codes), turns.ENDED)
    for r in solved.collect():
        assert tuple(r["used"]) == turns.leveled(whole[32 * (r["number"] + 1)])[0]


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(turns.repaired_conversations(df)) == expected(rows)
