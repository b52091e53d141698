"""Winnowing against a plain loop over windows."""

import hashlib
import re

import xxhash

from rosterlake.llm import winnow
from tests.llm.helpers import DOCS, edge_docs, edge_rows, no_docs, plain


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v & (2**64 - 1)).to_bytes(8, "little"), seed)
    return signed(seed)


def kept(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]{1,16}", text)
    h = [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in tokens]
    for by in (1, 2, 1):
        h = ([chain([a, b]) for a, b in zip(h, h[by:])] if len(h) > by else
             [chain(h)] if h else [])
    high = [x >> 30 for x in h]
    out = []
    for i in range(max(len(h) - winnow.WINDOW + 1, 1 if h else 0)):
        part = high[i:i + winnow.WINDOW]
        at = max(j for j, x in enumerate(part) if x == min(part)) + i
        if (at, high[at]) not in out:
            out.append((at, high[at]))
    return out


def shown(k):
    return " ".join(f"{p:x}:{h & (2**34 - 1):x}" for p, h in k)


def alike(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0),
                                        signed(xxhash.xxh64_intdigest(plain(r[1]).encode(), 42))))
    out = []
    for i, r in enumerate(order):
        text, nxt = plain(r[1]), plain(order[(i + 1) % len(order)][1])
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        a, b, c = kept(text), kept(edited), kept(nxt)
        out.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(a), shown(b),
                    round(alike(a, b), 9), round(alike(a, c), 9)))
    return sorted(out, key=str)


def got(df):
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=str)


def test_edge_cases(spark):
    assert got(winnow.edited_likeness(edge_docs(spark))) == expected(edge_rows())


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(winnow.edited_likeness(docs)) == expected(rows)


def test_single_null_and_empty(spark):
    assert winnow.edited_likeness(no_docs(spark)).collect() == []
    for rows in ([edge_rows()[0]], [(None, *edge_rows()[0][1:])],
                 [(None, *edge_rows()[0][1:]), (None, *edge_rows()[8][1:])]):
        df = spark.createDataFrame(rows, DOCS)
        assert got(winnow.edited_likeness(df)) == expected(rows)


def test_shared_run_is_found(spark):
    run = " ".join(f"w{i}" for i in range(winnow.GRAM + winnow.WINDOW - 1))
    df = spark.createDataFrame([(f"a b c {run} d", f"{run} x y z w v u")], "p string, q string")
    df = winnow.fingerprints(winnow.fingerprints(df, "p", "pk"), "q", "qk")
    r = df.first()
    assert {x >> 30 for x in r.pk} & {x >> 30 for x in r.qk}


def test_native_plan(spark, sf_dir):
    df = winnow.edited_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
