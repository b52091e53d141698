"""Names: legal and alternate, cleaned, taken apart and spelled out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterlake import schemas as S
from rosterlake.functions.text import (collapse_spaces, drop_chars, drop_inner_initial_period,
                                       drop_lone_initial_period, full_name)
from rosterlake.operators.impute import purge_symbols
from rosterlake.operators.joins import join_group_stats, natural_join
from rosterlake.session import cut

PARTS = ["pfname", "pmname", "plname", "pnamesuffix"]
NAME = ["pfname", "pmname", "plname"]


def _each_with(rows: Column, values: Column, names: Sequence[str], new: str) -> Column:
    """Every struct of ``rows`` (its ``names``) with every value, as ``new``."""
    def extended(row: Column) -> Column:
        return F.transform(values, lambda v: F.struct(*[row[n].alias(n) for n in names], v["v"].alias(new)))

    return F.flatten(F.transform(rows, extended))


def full_names(legal: Mapping[str, DataFrame], other: Mapping[str, DataFrame]) -> DataFrame:
    """Legal names, and alternates that are not already legal (``othflag`` 1).

    Parts attach independently per person. A missing alternate first or last
    name is the legal one; the other parts are once completed from the legal
    name and once left out. (A suffix is completed where the suffix itself is
    missing.)
    """
    # one aggregate gathers a person's values of all eight parts, each as a set;
    # combining them is work inside the row, with no join
    kinds = [(0, legal[p].withColumnsRenamed({p: "v"}), p) for p in PARTS] + [
        (1, other[p].withColumnsRenamed({f"{p}oth": "v"}), p) for p in PARTS]
    stacked = reduce(lambda x, y: x.unionByName(y), [
        df.select("npi", F.lit(side).alias("side"), F.lit(part).alias("part"), "v")
        for side, df, part in kinds])
    value = F.struct("v")

    def values(side: int, part: str) -> Column:
        return F.collect_set(F.when((F.col("side") == side) & (F.col("part") == part), value))

    sets = stacked.groupBy("npi").agg(*[values(side, part).alias(f"{side}{part}")
                                        for side in (0, 1) for part in PARTS])
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("v")))

    def combined(side: int) -> Column:
        """Every combination of a side's parts; none if the side has no part."""
        out = F.array(F.struct(F.lit(0).alias("none")))
        for i, part in enumerate(PARTS):
            here = F.when(F.size(f"{side}{part}") > 0, F.col(f"{side}{part}")).otherwise(nothing)
            out = _each_with(out, here, PARTS[:i], part)
        some = reduce(lambda x, y: x + y, [F.size(f"{side}{part}") for part in PARTS])
        return F.when(some > 0, out).otherwise(F.filter(out, lambda _: F.lit(False)))

    def forms(alt: Column, own: Column) -> Column:
        """An alternate completed from a legal name, and with its gaps left."""
        first, last = (F.coalesce(alt[c], own[c]).alias(c) for c in ("pfname", "plname"))
        middle, suffix = (F.coalesce(alt[c], own[c]).alias(c) for c in ("pmname", "pnamesuffix"))
        return F.array(F.struct(first, middle, last, suffix),
                       F.struct(first, alt["pmname"].alias("pmname"), last,
                                alt["pnamesuffix"].alias("pnamesuffix")))

    both = sets.select("npi", combined(0).alias("own"), combined(1).alias("alt"))
    blank = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in PARTS]))
    base = F.when(F.size("own") > 0, F.col("own")).otherwise(blank)
    alts = F.flatten(F.transform("alt", lambda a: F.flatten(F.transform(base, lambda o: forms(a, o)))))
    flagged = lambda names, flag: F.transform(names, lambda n: F.struct(
        *[n[c].alias(c) for c in PARTS], F.lit(flag).alias("othflag")))
    rows = F.concat(flagged(F.col("own"), 0), flagged(F.array_except(alts, "own"), 1))
    return both.select("npi", F.explode(rows).alias("n")).select(
        "npi", *[F.col(f"n.{p}").alias(p) for p in PARTS], F.col("n.othflag").alias("othflag"))


def _fold(df: DataFrame) -> DataFrame:
    """One row per person and name, blank for missing; least suffix and flag."""
    return (df.na.fill("").groupBy("npi", *NAME)
            .agg(F.min("pnamesuffix").alias("pnamesuffix"), F.min("othflag").alias("othflag")))


def clean_full_names(df: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    # judged and filtered: read twice, made once
    df = purge_symbols(cut(df), NAME, ["?", "+", "[", "]", ";"], ["npi"])
    df = df.withColumn("pmname", drop_lone_initial_period("pmname"))
    df = df.withColumns({c: drop_chars(F.trim(c), "+[];") for c in NAME})
    return _fold(resolve_parentheses(_fold(df), overrides))


def _drop_words(c: Column, words: Sequence[str]) -> Column:
    return reduce(lambda acc, w: F.replace(acc, F.lit(w), F.lit("")), words, c)


def _alternatives(df: DataFrame, column: str, inside: Sequence[str], after: Sequence[str],
                  joiner: Sequence[str] = (), separator: str | None = None) -> DataFrame:
    """``A (B) C``: rows for A, B and C in place of the original."""
    def part(c: Column, sep: str, i: int) -> Column:
        return F.trim(F.get(F.split(c, sep), F.lit(i)))

    c = F.col(column)
    tail = part(c, r"\(", 1)
    middle = _drop_words(part(tail, r"\)", 0), inside)
    if joiner:
        middle = F.when(middle.isin(*joiner), "").otherwise(middle)
    rest = _drop_words(part(tail, r"\)", 1), after)
    alts = F.transform(F.array(part(c, r"\(", 0), middle, rest), lambda a: F.trim(a))
    alts = F.filter(alts, lambda a: a.isNotNull() & (a != ""))
    if separator:
        alts = F.transform(alts, lambda a: F.replace(a, F.lit(separator), F.lit("")))
    plain = F.array(c)
    return df.withColumn(column, F.explode(
        F.when(F.coalesce(c.contains("("), F.lit(False)), alts).otherwise(plain)))


def resolve_parentheses(df: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Bracketed parts of names become alternative names.

    ``overrides`` (``column``, ``found``, ``use``) holds hand-made corrections.
    """
    if overrides is not None:
        for c in NAME:
            fix = overrides.where(F.col("column") == c).select(
                F.col("found").alias(c), F.col("use").alias("__use"))
            df = (natural_join(df, fix, "left", on=[c])
                  .withColumn(c, F.coalesce("__use", c)).drop("__use"))
    df = _alternatives(df, "plname", S.LAST_NAME_NOISE, S.LAST_NAME_TAIL_NOISE,
                       joiner=("OR", " OR"), separator=", ")
    df = df.where(~F.coalesce(F.col("plname").contains(")"), F.lit(False)))
    df = _alternatives(df, "pfname", S.FIRST_NAME_NOISE, [])
    none = (F.col("pfname") == "NONE") & (F.col("plname") == "NONE")
    df = df.where(~F.coalesce(none, F.lit(False)))
    return df.withColumn("pfname", drop_chars("pfname", ")")).na.fill("").distinct()


def suffix_out_of_last_name(df: DataFrame, last: str, suffix: str,
                            never_end: Sequence[str] = S.NEVER_END_SUFFIXES) -> DataFrame:
    """Move a generation suffix from the end of the last name to its column.

    What counts as a suffix is read off the data: the values seen in the
    suffix column, and the same spelled with spaces. The longest ending wins.
    Endings are looked up with a join, so the list never visits the driver.
    """
    seen = df.where(F.col(suffix) != "").select(suffix).distinct()
    spaced = F.regexp_replace(F.col(suffix), "(?<=.)(?=.)", " ")
    known = seen.select(F.explode(F.array(F.col(suffix), spaced)).alias("__s")).distinct()
    name = F.col(last)
    marks = F.filter(F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1))),
                     lambda i: F.substring(name, i, F.lit(1)).isin(" ", ","))
    endings = F.transform(marks, lambda i: F.struct(
        F.substring(name, i + 1, F.length(name)).alias("s"),
        F.substring(name, F.lit(1), i - 1).alias("kept")))
    glued = F.filter(F.array(*[F.when(name.endswith(s), F.struct(
        F.lit(s).alias("s"), F.expr(f"substring(`{last}`, 1, length(`{last}`) - {len(s)})")
        .alias("kept"))) for s in never_end]), lambda x: x.isNotNull())
    names = df.select(last).distinct()
    found = (names.select(last, F.explode(F.concat(endings, glued)).alias("__e"))
             .select(last, F.col("__e.s").alias("__s"), F.col("__e.kept").alias("__kept")))
    found = natural_join(found, known, on=["__s"], null_equal=False)
    kept = F.trim(F.regexp_replace(F.trim("__kept"), ",$", ""))
    best = (found.withColumn("__kept", kept).groupBy(last)
            .agg(F.max(F.struct(F.length("__s").alias("n"), "__s", "__kept")).alias("__b")))
    out = join_group_stats(df, best, [last])
    tidy = F.trim(F.regexp_replace(name, ",$", ""))
    return out.withColumns({suffix: F.coalesce("__b.__s", suffix),
                            last: F.coalesce("__b.__kept", tidy)}).drop("__b")


def expand_names(df: DataFrame, key: str, first: str, middle: str, last: str, suffix: str,
                 suffix_in_last: bool = False) -> DataFrame:
    """Every sensible spelling of a name, in ``name``.

    Middle name in full, as an initial, or left out; with and without
    periods; with a suffix also appended. Blank parts are empty strings.
    """
    def form(m: Column, clean) -> Column:
        return F.struct(clean(F.col(first)).alias("f"), clean(m).alias("m"),
                        clean(F.col(last)).alias("l"))

    as_is, bare = (lambda c: c), (lambda c: drop_chars(c, "."))
    middles = [F.col(middle), F.substring(middle, 1, 1), F.lit("")]
    forms = F.array_distinct(F.array(*[form(m, c) for c in (as_is, bare) for m in middles]))
    out = df.select(key, suffix, F.explode(forms).alias("__n")).select(
        key, suffix, F.col("__n.f").alias(first), F.col("__n.m").alias(middle),
        F.col("__n.l").alias(last)).distinct()
    if suffix_in_last:
        out = suffix_out_of_last_name(out, last, suffix)
    name = full_name(first, middle, last)
    plain = F.struct(F.lit("").alias("s"), name.alias("n"))
    suffixed = F.struct(F.col(suffix).alias("s"),
                        F.concat(name, F.lit(" "), F.col(suffix)).alias("n"))
    out = out.withColumn("__v", F.explode(
        F.when(F.col(suffix) == "", F.array(plain)).otherwise(F.array(plain, suffixed))))
    return out.select(key, first, middle, last, F.col("__v.s").alias(suffix),
                      F.col("__v.n").alias("name")).distinct()


# ------------------------------------------------------------ licence list

def strip_endings(df: DataFrame, column: str, endings: Sequence[str],
                  parts: str = "stripped") -> DataFrame:
    """Cut credentials off the end of a free-text name, to a fixed point.

    One pass tries each ending in list order: cut where the name ends in a
    space and the ending, trim, drop one trailing comma. Between the first and
    the later passes the period after an initial goes. What was cut is kept in
    ``parts`` in order of removal. A pass that changes a name shortens it, so
    the passes are bounded by the name's own length.
    """
    tokens = F.array(*[F.lit(" " + e) for e in endings])
    # a name that no ending fits and that needs no trimming is settled: a pass
    # leaves it as it is
    fits = "|".join(rf"\Q{e}\E" for e in endings)
    unsettled = rf"(?: (?:{fits})|[, ])\z|^ "

    def step(acc: Column, token: Column) -> Column:
        n = acc["n"]
        hit = n.endswith(token)
        left = F.trim(F.when(hit, F.substring(n, F.lit(1), F.length(n) - F.length(token) + 1))
                      .otherwise(n))
        left = F.when(left.endswith(","), F.substring(left, F.lit(1), F.length(left) - 1)
                      ).otherwise(left)
        cut = F.when(hit, F.concat(acc["c"], F.array(F.substring(token, F.lit(2), F.length(token))))
                     ).otherwise(acc["c"])
        same = ~(hit | n.endswith(",") | n.endswith(" ") | n.startswith(" "))
        return F.when(same, acc).otherwise(F.struct(left.alias("n"), cut.alias("c")))

    def one_pass(acc: Column) -> Column:
        return F.when(acc["n"].rlike(unsettled), F.aggregate(tokens, acc, step)).otherwise(acc)

    start = F.struct(F.col(column).alias("n"), F.array().cast("array<string>").alias("c"))
    # names are short and passes long: small files would leave them to a task or two
    out = df.hint("rebalance").withColumn("__p", one_pass(start))
    out = out.withColumn("__p", F.struct(
        drop_inner_initial_period(F.col("__p.n")).alias("n"), F.col("__p.c").alias("c")))
    rounds = F.sequence(F.lit(1), F.greatest(F.length(F.col("__p.n")), F.lit(1)))
    out = out.withColumn("__p", F.when(F.col("__p.n").rlike(unsettled), F.aggregate(
        rounds, F.col("__p"), lambda acc, _: one_pass(acc))).otherwise(F.col("__p")))
    return out.withColumns({column: F.col("__p.n"), parts: F.col("__p.c")}).drop("__p")


def suffix_tokens(df: DataFrame, key: str, parts: str = "stripped",
                  keep: Sequence[str] | None = S.GENERATION_SUFFIXES) -> DataFrame:
    """Tokens of the stripped parts, one per row; by default only generation
    suffixes."""
    flat = F.replace(drop_chars("__part", ". "), F.lit("M,D"), F.lit("MD"))
    # an inner explode would have Spark filter by the parts, and make them, twice
    out = (df.select(key, F.explode_outer(parts).alias("__part"))
           .select(key, F.explode(F.split(flat, ",")).alias("Suffix")))
    if keep is not None:
        out = out.where(F.col("Suffix").isin(list(keep)))
    return out.distinct()


def split_name(c: Column | str) -> dict[str, Column]:
    """First, middle and last token(s) of a name."""
    tokens = F.split(F.trim(collapse_spaces(c)), " ")
    inner = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0)))
    return {"firstname": F.element_at(tokens, 1), "middlename": F.array_join(inner, " "),
            "lastname": F.element_at(tokens, -1)}


def listed_names(people: DataFrame, key: str = "samhsa_id", name: str = "NameFull",
                 endings: Sequence[str] = S.NAME_ENDINGS) -> tuple[DataFrame, DataFrame]:
    """(name variants with priority ``order``, all stripped tokens) per entry."""
    base = cut(strip_endings(people.select(key, name).distinct(), name, endings))
    named = base.select(key, "stripped", *[c.alias(n) for n, c in split_name(name).items()])
    suffix = suffix_tokens(named, key)
    named = (natural_join(named, suffix, "left", on=[key], null_equal=False)
             .na.fill("", ["Suffix"]))
    variants = expand_names(named, key, "firstname", "middlename", "lastname", "Suffix")
    # an entry has one name, so its variants are a dozen or so rows
    w = Window.partitionBy(key).orderBy(F.desc("Suffix"), F.desc("middlename"),
                                        F.desc("name"), F.desc("firstname"),
                                        F.desc("lastname"))
    return (variants.withColumn("order", F.row_number().over(w)),
            suffix_tokens(named, key, keep=None))


def reconcat(df: DataFrame, first: str, middle: str, last: str) -> DataFrame:
    """Join the three parts and split again: multi-word parts move inward."""
    whole = F.concat_ws(" ", first, middle, last)
    f, m, la = split_name(whole).values()
    return df.withColumns({f"{first}_r": f, f"{middle}_r": m, f"{last}_r": la})
