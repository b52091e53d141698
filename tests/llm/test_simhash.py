"""SimHash groups against all pairs."""

import numpy as np
import pytest
import xxhash

from rosterlake.llm import simhash
from rosterlake.llm.components import connected
from tests.llm.helpers import edge_docs, edge_rows, no_docs, words


def print_of(text):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(len(w) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, prints):
    p = np.array(prints, np.uint64)
    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= 4
    root = list(range(len(p)))
    for _ in p:
        fresh = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(p))]
        if fresh == root:
            break
        root = fresh
    out = {}
    for i, r in enumerate(root):
        out.setdefault(r, []).append(ids[i])
    least = {r: min((x for x in v if x is not None), default=None) for r, v in out.items()}
    return [least[r] for r in root]


def expected(rows):
    ids, prints = [r[0] for r in rows], [print_of(r[1]) for r in rows]
    return sorted(zip(ids, (f"{p:016x}" for p in prints), groups(ids, prints)), key=str)


def test_edge_cases(spark):
    assert sorted(map(tuple, simhash.near_copies(edge_docs(spark)).collect()), key=str) == expected(edge_rows())


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, simhash.near_copies(docs).collect()), key=str) == expected(rows)


def test_empty(spark):
    assert simhash.near_copies(no_docs(spark)).collect() == []
    assert simhash.keep_one(no_docs(spark)).collect() == []


def test_one_of_each_group_stays(spark):
    docs = edge_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {(r[0]) for r in expected(edge_rows()) if r[0] is not None and r[0] == r[2]}
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(want)


@pytest.mark.parametrize("limit", [simhash.EXPANDED, 3000])
def test_ball_meetings_find_every_link(spark, monkeypatch, limit):
    """Also where a group is too large at once and is parted by its next bits."""
    monkeypatch.setattr(simhash, "EXPANDED", limit)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.permutation(64)[:n]) for b in base for n in (1, 3, 4, 5)]
    prints = np.unique(np.array([*map(int, base), *near], np.uint64))
    pairs = list(simhash.meetings(prints, np.full(len(prints), 2), 0, 4))
    a, b = (np.concatenate(c) for c in zip(*pairs))
    root = simhash.roots_of(len(prints), a, b)
    assert [int(prints[r]) for r in root] == [
        int(x) for x in np.array(groups([int(p) for p in prints], prints), np.uint64)]


def test_long_chain_of_links(spark):
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    got = connected(chain.repartition(4)).collect()
    assert {r.root for r in got} == {0} and len(got) == 200
