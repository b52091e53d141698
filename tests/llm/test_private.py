"""Personal data: fixed forms against plain patterns, contexts against a plain loop."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import defaultdict

from rosterlake.llm import private
from tests.llm.helpers import DOCS, doc, edge_docs, edge_rows, no_docs

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if ((kind == "ip" and any(int(p) > 255 for p in m.group().split(".")))
                    or (kind == "card" and not (14 <= len(digits) <= 19 and plain_luhn(digits)))
                    or (kind == "phone" and not 10 <= len(digits) <= 15)):
                continue
            out.append((m.start(), order, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{PLAIN[k][0]}:{a}:{b}" for a, k, b in sorted(spans))


def plain_method(texts, rounds=3, support=3, trust=0.5, accept=0.9):
    """All spans of each text by the same rule, in one process."""
    seen = [private.mentions(t)[1] for t in texts]
    edges = {(p, m["value"], m["kind"]) for ms in seen for m in ms for p in m["patterns"]}
    members = defaultdict(set)
    for p, v, _ in edges:
        members[p].add(v)
    edges = {e for e in edges if len(members[e[0]]) >= support}
    score = {}
    good = {}
    for _ in range(rounds):
        sums, held = defaultdict(float), defaultdict(int)
        for p, v, k in edges:
            if k < 0 and v not in score:
                continue
            k, s = (k, 1.0) if k >= 0 else score[v]
            sums[p, k] += s
            held[p, k] += s >= accept
        good = {pk: s / (len(members[pk[0]]) + 1) for pk, s in sums.items()
                if s / (len(members[pk[0]]) + 1) >= trust and held[pk] >= support}
        doubt = defaultdict(float)
        for p, v, k in edges:
            for (q, kind), t in good.items():
                if k < 0 and p == q:
                    doubt[v, kind] += math.log1p(-t)
        score = {}
        for (v, kind), d in doubt.items():
            new = (kind, 1 - math.exp(d))
            if v not in score or (new[1], -new[0]) > (score[v][1], -score[v][0]):
                score[v] = new
    out = []
    for t, ms in zip(texts, seen):
        spans = {(m["start"], score[m["value"]][0], m["end"]) for m in ms if m["kind"] < 0
                 and m["value"] in score and score[m["value"]][1] >= accept
                 and any((p, score[m["value"]][0]) in good for p in m["patterns"])}
        out.append(joined(list(plain_spans(t)) + sorted(spans)))
    return out


def test_base_forms_equal_plain_patterns():
    rng = random.Random(2)
    bits = ["a.b", "@", "@x-1.org", ".", "+1 (017) 555-7713", "4485 1681 1440 7329", "4845168114407329", "-",
            " ", "255.1.22.3", "256.1.1.1", "1.2.3.4.5.6.7.8", "é", "+", "x", "12", "٣", "0001.2.3.4", "%",
            "12 34-56", "(", ")"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert private.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("a" * 300000, "1" * 300000, "1.1" * 100000, "+1" * 150000, "1 " * 150000,
                 "a@" * 150000, "@" * 300000, "+1" + " " * 300000, "1." * 150000, "1-(" * 100000):
        private.mentions(text)
    assert time.time() - start < 30


def learned(seed=1):
    """Documents in which a phrase comes before phones, known and unknown ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = [f"{word()} please call me on +1 (555) 555-{i:04d} after {word()} {word()}" for i in range(20)]
    texts += [f"{word()} please call me on 555-99{i:02d} after {word()} {word()}" for i in range(4)]
    texts += [f"{word()} the of {rng.randint(10**15, 10**16)} in {word()}" for _ in range(30)]
    texts += [f"{word()} the of +1 (555) 555-{i:04d} in {word()}" for i in range(5)]
    return texts + [f"{word()} {word()} 998-1234 {word()} {word()}"]


def test_contexts_find_unseen_identifiers(spark):
    texts = learned() + [r[1] for r in edge_rows() if r[1]]
    df = spark.createDataFrame([doc(i, t) for i, t in enumerate(texts)], DOCS)
    made = [r["spans"] for r in private.personal_data(df).orderBy("doc_id").collect()]
    assert made == plain_method(texts)
    new = [i for i, t in enumerate(texts) if made[i] != joined(plain_spans(t))]
    assert new == [20, 21, 22, 23]          # the unknown phones and nothing else
    assert all(made[i].startswith("phone:") for i in new)


def test_edge_table(spark):
    rows = edge_rows() + [doc(200, "x@y.org " * 3000), doc(200, "+49 30 1234567 and 1.2.3.4"),
                          doc(201, "4845168114407329\n" * 2)]
    df = spark.createDataFrame(rows, DOCS)
    made = sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])
                   for r in private.personal_data(df).collect()), key=str)
    want = []
    for r in rows:
        spans = plain_spans(r[1] or "")
        n = [sum(k == i for _, k, _ in spans) for i in range(4)]
        want.append((r[0], *n, hashlib.sha256(joined(spans).encode()).hexdigest()))
    assert made == sorted(want, key=str)
    assert private.personal_data(no_docs(spark)).count() == 0


def test_base_always_stays(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    rows = private.personal_data(df).collect()
    assert len(rows) == df.count()
    for r in rows:
        base = joined(plain_spans(texts[r["doc_id"]]))
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()


def test_edge_docs_have_a_row_each(spark):
    assert private.personal_data(edge_docs(spark)).count() == len(edge_rows())
