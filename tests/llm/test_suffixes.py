"""Removed bytes against a count of every window."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from rosterlake.llm import suffixes
from tests.llm.helpers import DOCS, doc, edge_docs, edge_rows, no_docs, plain, prose


def removed(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        out.append(np.cumsum(gone[:-1]) > 0)
    return out


def expected(rows, length=400):
    texts = [plain(r[1]).encode() for r in rows]
    out = []
    for r, t, gone in zip(rows, texts, removed(texts, length)):
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((r[0], len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_edge_cases(spark):
    assert got(suffixes.removal_report(edge_docs(spark))) == expected(edge_rows())


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    report = got(suffixes.removal_report(docs))
    assert report == expected(rows)
    assert any(r[2] for r in report)


@pytest.mark.parametrize("pieces", [suffixes.BLOCK_PIECES, 2])
def test_large_classes_by_single_windows(spark, pieces):
    """The same bytes go whether a minimizer's pieces fit a block or not."""
    import random
    rng = random.Random(2)
    passage = prose(rng, 40)
    rows = [doc(i, prose(rng, rng.randint(0, 30)) + passage + prose(rng, rng.randint(0, 30)))
            for i in range(60)]
    docs = suffixes._keyed(spark.createDataFrame(rows, DOCS))
    spans = suffixes.repeated_spans(docs, 100, pieces)
    found = {}
    for r in spans.collect():
        found.setdefault(r.doc_id, []).append((r.start, r.stop))
    texts = [r[1].encode() for r in rows]
    for r, gone in zip(rows, removed(texts, 100)):
        mine = np.zeros(len(gone), bool)
        for a, b in found.get(r[0], []):
            mine[a:b] = True
        assert (mine == gone).all()


def test_blocks_and_long_texts(spark, monkeypatch):
    """Small chunks and blocks give what large ones give."""
    rows = edge_rows()
    texts = [plain(r[1]).encode() for r in rows]
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.cumsum([0, *map(len, texts)])
    monkeypatch.setattr(suffixes, "CHUNK", 1500)
    seen = set()
    for a, b, _, ends in suffixes._chunks(at, 400):
        made = suffixes.pieces_of(data[a:b], ends)
        if made:
            for s, n in zip(made[0].tolist(), made[1].tolist()):
                seen.update(range(a + s, a + s + n))
    want = {int(at[i]) + k for i, t in enumerate(texts) for k in range(len(t) - 399)}
    assert seen == want


def test_column_wise_order():
    """Common prefixes of neighbours reach the length exactly where a window
    stands again in its column."""
    rng = np.random.default_rng(3)
    table = rng.integers(97, 99, (60, 50)).astype(np.uint16)
    table[40:, :9] = suffixes.END
    table[:7, 20:] = suffixes.END
    found = suffixes.repeated_columns(table, 6)
    for j in range(60):
        column = [tuple(table[j:j + 6, i]) for i in range(50)]
        n = Counter(column)
        for i, w in enumerate(column):
            whole = len(w) == 6 and suffixes.END not in w
            assert found[j, i] == (whole and n[w] > 1)


def test_empty_and_rewrite(spark):
    assert suffixes.removal_report(no_docs(spark)).collect() == []
    docs = edge_docs(spark)
    clean = suffixes.remove_repeats(docs)
    assert clean.columns == docs.columns
    by = {r.doc_id: r for r in clean.collect()}
    assert by[1].text == "" and by[7].text == "one" and by[7].n_chars == 3
    assert len(clean.collect()) == docs.count()
