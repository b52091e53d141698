"""Document fingerprints by winnowing, in DataFrame functions only.

Tokens are runs of at most ``RUN`` non-blank characters. Hashes of ``GRAM``
tokens roll over the text; of every ``WINDOW`` hashes in a row the smallest is
kept, the rightmost if several are, with its position. Two texts that share
``GRAM + WINDOW - 1`` tokens in a row therefore share a kept hash, and nothing
shorter than ``GRAM`` tokens matches.

A hash and its position are one long: 34 bits of hash above 30 bits that fall
with the position, so the smallest long is the rightmost smallest hash. A text
has at most 2 ** 30 tokens, because a string is at most 2 ** 31 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterlake.llm.common import whole_text

GRAM = 5
WINDOW = 8
RUN = 16
# fixed value: a run of anything but space and the characters 9 to 13
TOKEN = r"[^\x20\x09-\x0D]{1,%d}"
_PLACE = (1 << 30) - 1


def _shifted(a: Column, by: int) -> tuple[Column, Column]:
    """The array without its last and without its first ``by`` elements."""
    n = F.greatest(F.size(a) - by, F.lit(0))
    return F.slice(a, F.lit(1), n), F.slice(a, F.lit(by + 1), n)


def _rolled(df: DataFrame, source: str, out: str, gram: int, window: int) -> DataFrame:
    """Adds ``out``, the kept longs in order, from the text column ``source``.

    Hashes of 2, 4, ... tokens come from two of half the length; so do minima.
    Each step is a column of its own, computed once.
    """
    c = f"__{out}"
    df = df.withColumn(c, F.regexp_extract_all(source, F.lit(TOKEN % RUN), F.lit(0)))
    df = df.withColumn(c, F.transform(c, lambda t: F.xxhash64(t)))

    def join(df: DataFrame, reach: int, by: int, name: str) -> DataFrame:
        """Grams of ``reach`` tokens become grams of ``reach + by``."""
        a, b = _shifted(F.col(name), by)
        step = F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
        return df.withColumn(name, F.when(F.size(name) > by, step).otherwise(
            F.when(F.size(name) > 0, F.array(F.xxhash64(name)))
            .otherwise(F.array().cast("array<bigint>"))))

    reach = 1
    while reach < gram:
        by = min(reach, gram - reach)
        df = join(df, reach, by, c)
        reach += by
    marked = F.transform(c, lambda h, i: (h.bitwiseAND(F.lit(~_PLACE))).bitwiseOR(
        F.lit(_PLACE).cast("long") - i))
    df = df.withColumn(c, marked)
    reach = 1
    while reach < window:
        by = min(reach, window - reach)
        a, b = _shifted(F.col(c), by)
        least = F.zip_with(a, b, lambda x, y: F.least(x, y))
        df = df.withColumn(c, F.when(F.size(c) > by, least).otherwise(
            F.when(F.size(c) > 0, F.array(F.array_min(c))).otherwise(F.col(c))))
        reach += by
    return df.withColumn(out, F.array_distinct(c)).drop(c)


def _hashes(kept: str) -> Column:
    return F.array_distinct(F.transform(kept, lambda x: F.shiftright(x, 30)))


def likeness(a: str, b: str) -> Column:
    """Share of common hashes in all hashes of two sets; both empty: 1."""
    both, any_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(any_ == 0, F.lit(1.0)).otherwise(both / any_)


def as_text(kept: str) -> Column:
    """position:hash, ... in hexadecimal; no token: empty."""
    return F.concat_ws(" ", F.transform(kept, lambda x: F.concat(
        F.lower(F.hex(F.lit(_PLACE).cast("long") - x.bitwiseAND(F.lit(_PLACE)))), F.lit(":"),
        F.lower(F.hex(F.shiftrightunsigned(x, 30))))))


def fingerprints(df: DataFrame, text: str, out: str, gram: int = GRAM, window: int = WINDOW
                 ) -> DataFrame:
    """Adds ``out``: kept hashes with their positions as longs."""
    return _rolled(df, text, out, gram, window)


def with_next(docs: DataFrame, columns: list[str], parts: int | None = None) -> DataFrame:
    """``docs`` (doc_id, tie, columns) plus next_<column> of the following row
    by falling doc_id, nulls last, ties by ``tie``; after the last the first.

    Ids are dealt into ranges whose upper bounds are ids of the table. The rows
    of a bound, the first of their range, are also sent to the range above,
    and those of the largest id to the lowest, so each range knows what follows
    it and rows move once. At most ``parts`` bounds are fetched.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = docs.agg(F.percentile_approx(
        "doc_id", [i / parts for i in range(1, parts + 1)], 10 * parts)).first()[0] or []
    bounds = sorted(set(bounds))
    top = bounds[-1] if bounds else None
    edges = F.array(*[F.lit(b) for b in bounds[:-1]]).cast("array<bigint>")
    # the number of bounds below an id, by the place it would have among them
    own = F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.size(F.filter(edges, lambda e: e < F.col("doc_id"))))
    ranged = docs.withColumn("__range", own)
    after = F.when(F.col("doc_id") == F.lit(top), F.lit(-1)).when(
        F.array_contains(edges, F.col("doc_id")), F.col("__range") + 1) if bounds else F.lit(None)
    sent = F.filter(F.array(F.struct(F.col("__range").alias("to"), F.lit(0).alias("halo")),
                            F.struct(F.when(after == -1, 0).otherwise(after).cast("int").alias("to"),
                                     F.when(after == -1, 2).otherwise(1).alias("halo"))),
                    lambda s: s["to"].isNotNull())
    laid = ranged.withColumn("__s", F.explode(sent)).withColumns(
        {"__range": F.col("__s.to"), "__halo": F.col("__s.halo")}).drop("__s")
    # the rows of the largest id close the lowest range, behind null ids
    w = Window.partitionBy("__range").orderBy(
        (F.col("__halo") == 2), F.col("doc_id").desc_nulls_last(), "tie", "__halo")
    nexts = {f"next_{c}": F.lead(c).over(w) for c in columns}
    if not bounds:
        first = Window.partitionBy("__range").orderBy("tie").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        nexts = {f"next_{c}": F.coalesce(F.lead(c).over(w), F.first(c).over(first)) for c in columns}
    return laid.withColumns(nexts).where("__halo = 0").drop("__range", "__halo", "tie")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness.

    The last half of a text gives way to the first as many characters of the
    next document's, by falling id. A null text is empty and has an empty
    fingerprint, like every text without a word; two empty fingerprints are
    alike to 1. A null id comes after all others; rows that share an id follow
    each other by text hash; a single row follows itself; other columns are
    ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    docs = fingerprints(docs, "text", "kept")
    docs = docs.withColumns({"hashes": _hashes("kept"), "tie": F.xxhash64("text")})
    df = with_next(docs, ["text", "hashes"])
    df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    df = df.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring("next_text", F.lit(1), half)))
    df = df.drop("next_text", "text")
    df = fingerprints(df, "edited", "edited_kept")
    df = df.withColumn("edited_hashes", _hashes("edited_kept"))
    return df.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                     as_text("kept").alias("fingerprint"),
                     as_text("edited_kept").alias("edited_fingerprint"),
                     likeness("hashes", "edited_hashes").alias("near_edited"),
                     likeness("hashes", "next_hashes").alias("near_next"))
