"""Small tables with every awkward case."""

from __future__ import annotations

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, key string, row int, "
        "fingerprint string, spans int, size string, block string, doc string, rest int, tie int")
SYLLABLES = ["an", "ble", "er", "ing", "ou", "re", "sh", "ti", "wh", "é", "ß", "on"]


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) + rng.choice(
        ["", "", "", ",", ".", ".\n"]) for _ in range(words))


def doc(doc_id, text, source="a"):
    return (doc_id, text, None, source, None if text is None else len(text), "k", 1, "f", 2, "s",
            "b", "d", 3, 4)


def edge_rows(seed: int = 5) -> list[tuple]:
    """Nulls, empty, blank, long, equal, nearly equal and repeated rows."""
    rng = random.Random(seed)
    a, b = prose(rng, 200), prose(rng, 300)
    rows = [doc(1, a), doc(2, a, "b"), doc(3, a.replace(",", ";", 1), None), doc(4, None),
            doc(5, ""), doc(6, " \t\n\x0b\x0c\r "), doc(7, "one"), doc(8, "one two three"),
            doc(9, b + " " + prose(rng, 50)), doc(10, prose(rng, 70) + " " + b, "b"),
            doc(None, prose(rng, 40)), doc(None, prose(rng, 40), None), doc(11, b, "c"),
            doc(11, b, "c"), doc(12, "x" * 3000), doc(13, "é" * 700 + "ß" * 700),
            doc(14, prose(rng, 12000), "c"), doc(15, "!! $$ ## || <<>> " * 30),
            doc(16, "\n".join(["the same line"] * 40)), doc(17, "a  b c d e " * 30),
            doc(18, "don't we'll x's <|endoftext|> ΑΣ İ 12 3.5 naïve-é " * 9)]
    rows += [doc(100 + i, prose(rng, rng.randint(1, 120)), rng.choice(["a", "b", "c", None]))
             for i in range(40)]
    return rows


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def plain(v: str | None) -> str:
    return v or ""


def words(text: str | None) -> list[bytes]:
    return plain(text).encode().split()
