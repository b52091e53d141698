"""Personal data by fixed forms and by bootstrapped contexts.

E-mail addresses, IP addresses, card and phone numbers of fixed form are found
first. They are the seeds: the words around them are lexical patterns. In a
graph of patterns and instances (values that look like identifiers) Spark
scores both in turn. A pattern is as trusted as the share of one kind among the
distinct instances it holds; an instance is as trusted as the patterns it
stands in. Instances that reach ``ACCEPT`` are new identifiers, and as their
own scores count for their patterns in the next round, patterns that held too
few seeds can follow. Every mention of an accepted instance in one of the
trusted contexts is added to the spans; the fixed forms always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import ready, row_key, spread_join, whole_text
from rosterlake.session import cut

ROUNDS = 3
SUPPORT = 3               # distinct trusted instances that a pattern needs
TRUST = 0.5               # a pattern less trusted than this says nothing
ACCEPT = 0.9              # an instance trusted this much is an identifier
MIN_DIGITS = 5            # of a value without @ that may be an identifier
# fixed values: the kinds in their order, and their forms
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only start where a run of digits starts, which keeps long runs linear
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# what an unseen identifier may look like: an address, a number with marks, a code
NUMBER = re.compile(r"(?<![A-Za-z0-9])[+(]{0,2}[0-9]+(?:[().:/\x20-]{1,3}[0-9]+)*(?![A-Za-z0-9])")
TOKEN = re.compile(r"[^\s]+")
DIGIT = re.compile(r"[0-9]")
EDGES = "\"'`.,;:!?()[]{}<>|#*$%&="


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += int(d) * 2 - 9 * (d > "4")
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the run before it and the domain after it; the same as a
    search from the left, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, by start and kind."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def likely(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of values that may be identifiers, from the left, none in another:
    words with an @ inside, numbers with marks and codes of enough digits."""
    found = []
    for m in NUMBER.finditer(text):
        if len(DIGIT.findall(m.group())) >= MIN_DIGITS:
            found.append((m.start(), -m.end()))
    for a, b in words:
        word = text[a:b]
        bare = word.lstrip(EDGES)
        a, b = a + len(word) - len(bare), a + len(word) - len(bare) + len(bare.rstrip(EDGES))
        word = text[a:b]
        if "@" in word[1:-1] or (not word.isdigit() and word.isalnum()
                                 and len(DIGIT.findall(word)) >= MIN_DIGITS):
            found.append((a, -b))
    out, end = [], 0
    for a, b in sorted(found):
        if a >= end:
            out.append((a, -b))
            end = -b
    return out


def _hash(*parts: str) -> int:
    h = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def mentions(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    """The fixed spans of a text, and all values in their contexts: the two
    words before, the words on both sides, the two words after. A value with
    no word on a side has none of the patterns that need it."""
    base = base_spans(text)
    if not base and not DIGIT.search(text) and "@" not in text:
        return base, []
    words = [m.span() for m in TOKEN.finditer(text)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    taken = sorted((a, b) for a, _, b in base)
    firsts, reach = [a for a, _ in taken], []
    for _, b in taken:
        reach.append(max(b, reach[-1] if reach else 0))
    values = [(a, b, k) for a, k, b in base]
    for a, b in likely(text, words):
        before = bisect_left(firsts, b)
        if not before or reach[before - 1] <= a:
            values.append((a, b, -1))
    out = []
    for a, b, kind in values:
        left = bisect_right(ends, a)              # words that end before the value
        right = bisect_left(starts, b)            # words that start after it
        near = lambda i: text[slice(*words[i])].lower()
        patterns = []
        if left >= 2:
            patterns.append(_hash("L", near(left - 2), near(left - 1)))
        if left >= 1 and right < len(words):
            patterns.append(_hash("M", near(left - 1), near(right)))
        if right + 1 < len(words):
            patterns.append(_hash("R", near(right), near(right + 1)))
        out.append({"start": a, "end": b, "kind": kind, "value": _hash(text[a:b].lower()),
                    "patterns": patterns})
    return base, out


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_MENTION = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()),
                      ("value", pa.int64()), ("patterns", pa.list_(pa.int64()))])
_FOUND = ("doc_id long, row long, base array<struct<start: long, kind: int, end: long>>, mentions "
          "array<struct<start: long, end: long, kind: int, value: long, patterns: array<long>>>")


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, seen = [], []
        for text in batch.column(2):
            b, m = mentions(text.as_py())
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in b])
            seen.append(m)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(base, pa.list_(_SPAN)),
             pa.array(seen, pa.list_(_MENTION))], ["doc_id", "row", "base", "mentions"])


def score_graph(edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, trust: float = TRUST,
                accept: float = ACCEPT) -> tuple[DataFrame, DataFrame]:
    """Accepted instances (value, kind) and trusted patterns (pattern, kind).

    ``edges``: distinct (pattern, value, kind), kind -1 where unknown. A value
    that is a seed of two kinds counts for both. Per round: a pattern's trust
    in a kind is the sum of its instances' scores over the number of its
    distinct instances plus one; it needs ``support`` distinct instances that
    are seeds or accepted. An unknown instance's score is one minus the product
    of its patterns' doubts, for the best kind (ties: the first).
    """
    edges = cut(edges)
    # patterns with too few instances can never be trusted
    sizes = edges.groupBy("pattern").agg(F.count_distinct("value").alias("n")).where(F.col("n") >= support)
    edges = cut(spread_join(edges, sizes, ["pattern"], "inner"))
    unknown = edges.where("kind < 0").select("pattern", "value", "n")
    seeds = edges.where("kind >= 0").select("pattern", "value", "kind", F.lit(1.0).alias("score"), "n")
    scores = edges.sparkSession.createDataFrame([], "value long, kind int, score double")
    for _ in range(rounds):
        own = spread_join(unknown, scores, ["value"], "inner").select("pattern", "value", "kind", "score", "n")
        trusted = seeds.unionByName(own).groupBy("pattern", "kind").agg(
            (F.sum("score") / (F.max("n") + 1)).alias("trust"),
            F.count_if(F.col("score") >= accept).alias("held"))
        trusted = cut(trusted.where((F.col("trust") >= trust) & (F.col("held") >= support))
                      .select("pattern", "kind", "trust"))
        made = spread_join(unknown.select("pattern", "value"), trusted, ["pattern"], "inner").groupBy(
            "value", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("score"))
        best = made.groupBy("value").agg(F.max(F.struct("score", -F.col("kind"))).alias("b"))
        scores = cut(best.select("value", (-F.col("b")["col2"]).cast("int").alias("kind"),
                                 F.col("b")["score"].alias("score")))
    return scores.where(F.col("score") >= accept).select("value", "kind"), trusted.select("pattern", "kind")


def _text(spans: str):
    """``kind:start:end`` of each span, by start, then kind as listed."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, trust: float = TRUST,
                  accept: float = ACCEPT) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (fixed
    forms), base_sha256 and all spans as text.

    Texts are read once and never shuffled; what travels are hashes of contexts
    and values (64 bits) and places. Support counts distinct values, so copies
    of a document prove nothing. A null text is empty and has no spans; rows
    that share an id are documents of their own, equal rows have equal results;
    a null id is an id; very long texts are read whole in linear time; other
    columns are ignored; an empty table gives no rows.
    """
    ready(docs.sparkSession)
    found = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"),
                            whole_text().alias("text")).mapInArrow(_found, _FOUND))
    seen = found.select("doc_id", "row", F.explode("mentions").alias("m")).select("doc_id", "row", "m.*")
    edges = seen.select("value", "kind", F.explode("patterns").alias("pattern")).distinct()
    values, patterns = score_graph(edges, rounds, support, trust, accept)
    places = seen.where("kind < 0").select("doc_id", "row", "start", "end", "value",
                                           F.explode("patterns").alias("pattern"))
    hits = spread_join(spread_join(places, values, ["value"], "inner"), patterns, ["pattern", "kind"], "inner")
    hits = hits.select("doc_id", "row", "start", "kind", "end").distinct()
    added = hits.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    out = spread_join(found.drop("mentions"), added, ["doc_id", "row"], "left")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    spans = F.concat("base", F.coalesce("added", F.array().cast(
        "array<struct<start: long, kind: int, end: long>>")))
    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                      F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(spans).alias("spans"))
