"""Linking a list without ids to the registry, one to one, tier by tier.

A match survives only when it is unique on the list side and then on the
registry side. Attributes attach independently, so two ids match on a name and
some attributes exactly if they share the name and, attribute by attribute, a
value. Candidates are therefore paired by name once per source, with one bit
per attribute they agree on; every tier, source and name priority is a filter
on that stored table. A name that would make more than ``NAME_PAIRS`` pairs is
never spelled out: per key the smallest and the largest registry id tell
whether there is exactly one, so it stays linear however common it is, and
both kinds of candidates are settled together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rosterlake import schemas as S
from rosterlake.functions.text import drop_chars
from rosterlake.operators.joins import anti_join, join_group_stats, natural_join, semi_join
from rosterlake.operators.reshape import indicators_to_long
from rosterlake.operators.rows import only_unique
from rosterlake.session import cut


def _dealt(join):
    """The join with both sides dealt by key. Every side here grows with the
    list or the registry, and a broadcast one would pass through the driver."""
    def run(left: DataFrame, right: DataFrame, *args, **options) -> DataFrame:
        return join(left, right.hint("merge"), *args, **options)
    return run


_anti_join, _semi_join, _join_group_stats, _natural_join = map(
    _dealt, (anti_join, semi_join, join_group_stats, natural_join))


@dataclass
class Source:
    """One side of the linkage: names, and the values of each attribute.

    ``names`` has the id, ``name`` and on the list side ``order`` and
    ``middlename``. ``attributes`` maps an attribute name to a frame of
    (id, attribute).
    """

    id: str
    names: DataFrame
    attributes: Mapping[str, DataFrame] = field(default_factory=dict)
    name_keys: Sequence[str] = ("name",)


def conform(source: Source, wanted: Sequence[str], extra: Sequence[str] = (),
            within: DataFrame | None = None) -> DataFrame:
    """(id, name keys, wanted attributes): every name with every combination
    of the id's attribute values, as they attach independently.

    ``within`` holds the keys of the other side. Rows are narrowed to those
    after the names and after each attribute, so an id with many names and
    places never makes combinations that could not match.
    """
    keys = list(source.name_keys)
    out = source.names.select(source.id, *keys, *extra).distinct()
    if within is not None:
        out = _semi_join(out, within.select(*keys).distinct(), on=keys)
    for a in wanted:
        out = _natural_join(out, source.attributes[a].select(source.id, a).distinct(),
                           on=[source.id], null_equal=False)
        keys.append(a)
        if within is not None:
            out = _semi_join(out, within.select(*keys).distinct(), on=keys)
    return out


def clean_matches(left: DataFrame, right: DataFrame, id_use: str, id_target: str,
                  keys: Sequence[str], blocked: DataFrame | None = None) -> DataFrame:
    """Pairs unique on ``id_use``, then unique on ``id_target`` among those.

    ``blocked`` holds both ids; matched ids are out on either side. Null keys
    match each other.
    """
    if blocked is not None:
        left = _anti_join(left, blocked.select(id_use), on=[id_use], null_equal=False)
        right = _anti_join(right, blocked.select(id_target), on=[id_target], null_equal=False)
    targets = right.groupBy(*keys).agg(F.min(id_target).alias("__lo"),
                                       F.max(id_target).alias("__hi"))
    hits = _join_group_stats(left.select(id_use, *keys), targets, keys, how="inner")
    sure = (hits.groupBy(id_use).agg(F.min("__lo").alias("__lo"), F.max("__hi").alias(id_target))
            .where(F.col("__lo") == F.col(id_target)).select(id_use, id_target))
    return only_unique(sure, [id_target])


def _free(df: DataFrame, found: DataFrame | None, id_column: str) -> DataFrame:
    if found is None:
        return df
    return _anti_join(df, found.select(id_column), on=[id_column], null_equal=False)


def _all(frames: Sequence[DataFrame]) -> DataFrame | None:
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def match_by_order(listed: DataFrame, target: DataFrame, id_use: str, id_target: str,
                   keys: Sequence[str], orders: Sequence[int],
                   found: DataFrame | None = None) -> DataFrame:
    """Clean matches for each name priority in turn; each round blocks the
    ids the rounds before matched and is written once. ``found`` grows by
    (ids, ``order``)."""
    listed, target = _free(listed, found, id_use), _free(target, found, id_target)
    rounds: list[DataFrame] = []
    for o in orders:
        rounds.append(cut(clean_matches(listed.where(F.col("order") == o), target, id_use, id_target,
                                        keys, _all(rounds)).withColumn("order", F.lit(o))))
    return _all(rounds if found is None else [found, *rounds])


ATTRIBUTES = ["practitioner_type", "state", "zip5", "tel"]
NAME_PAIRS = 10_000       # candidate pairs one name may make in a source


class TieredLinkage:
    """Chained tiers, open branches and a punctuation-free pass.

    ``targets`` are tried in order within a tier. ``types`` lists the types a
    target may have when type is among the attributes.
    """

    def __init__(self, listed: Source, targets: Sequence[Source],
                 types: Sequence[str] = S.LINK_TYPES, orders: Sequence[int] | None = None,
                 name_pairs: int = NAME_PAIRS):
        self.targets, self.types = list(targets), list(types)
        names = cut(listed.names)
        self.listed = Source(listed.id, names, listed.attributes, listed.name_keys)
        self.target_id = targets[0].id
        self._values = cut(self._sets(self.listed, names.select(listed.id).distinct()))
        frequent = cut(_all([self._frequent(i, t, name_pairs) for i, t in enumerate(self.targets)]))
        # a few source numbers
        self.crowded = {r[0] for r in frequent.select("source").distinct().collect()}
        self._names_in = frequent
        self.candidates = cut(_all([self._candidates(i, t) for i, t in enumerate(self.targets)]))
        # at most sources x priorities x 16 rows: rounds without a candidate are not run
        self.counts = [(r["source"], r["order"], r["mask"]) for r in self.candidates.select(
            "source", "order", "mask").distinct().collect()]
        if orders is None:
            # priorities are a handful of small integers by construction
            orders = sorted(r[0] for r in names.select("order").distinct().collect())
        self.orders = list(orders)

    def _shared(self, target: Source) -> list[str]:
        return [k for k in self.listed.name_keys if k in target.name_keys]

    def _typed(self, target: Source) -> Source:
        attributes = dict(target.attributes)
        if "practitioner_type" in attributes:
            attributes["practitioner_type"] = attributes["practitioner_type"].where(
                F.col("practitioner_type").isin(self.types))
        return Source(target.id, target.names, attributes, target.name_keys)

    def _frequent(self, i: int, target: Source, limit: int) -> DataFrame:
        """(source, name keys) that would make more than ``limit`` pairs."""
        keys = self._shared(target)
        sizes = [side.names.select(side.id, *keys).distinct().groupBy(*keys).agg(
            F.count(F.lit(1)).alias(n)) for side, n in ((self.listed, "__l"), (target, "__r"))]
        both = _natural_join(*sizes, on=keys).where(F.col("__l") * F.col("__r") > limit)
        missing = [k for k in self.listed.name_keys if k not in keys]
        return both.select(F.lit(i).alias("source"), *keys,
                           *[F.lit(None).cast("string").alias(k) for k in missing])

    @staticmethod
    def _sets(source: Source, ids: DataFrame) -> DataFrame:
        """One row per id of ``ids``: the values of each attribute as a set; a
        null value is a value, an id without any has no set."""
        rows = _all([_semi_join(source.attributes[a], ids, on=[source.id], null_equal=False).select(
            source.id, F.lit(a).alias("__a"), F.coalesce(F.col(a), F.lit("\0")).alias("__v"))
            for a in ATTRIBUTES if a in source.attributes])
        return rows.groupBy(source.id).agg(*[
            F.collect_set(F.when(F.col("__a") == a, F.col("__v"))).alias(f"__{a}") for a in ATTRIBUTES])

    def _candidates(self, i: int, target: Source) -> DataFrame:
        """(source, list id, registry id, order, mask) of ids that share a name."""
        keys, target = self._shared(target), self._typed(target)
        mine = self.listed.names.select(self.listed.id, *keys, "order").distinct()
        theirs = target.names.select(target.id, *keys).distinct()
        if i in self.crowded:
            crowded = self._names_in.where(F.col("source") == i).select(*keys)
            mine = _anti_join(mine, crowded, on=keys)
        pairs = _join_group_stats(theirs, mine, keys, how="inner").select(
            self.listed.id, target.id, "order").distinct()
        sets = self._sets(target, pairs.select(target.id).distinct())
        there = {f"__{a}": f"__t_{a}" for a in ATTRIBUTES}
        pairs = _join_group_stats(pairs, self._values, [self.listed.id])
        pairs = _join_group_stats(pairs, sets.withColumnsRenamed(there), [target.id])
        mask = reduce(lambda x, y: x + y, [
            F.when(F.arrays_overlap(f"__{a}", f"__t_{a}"), 1 << n).otherwise(0)
            for n, a in enumerate(ATTRIBUTES)])
        return pairs.select(F.lit(i).alias("source"), self.listed.id, target.id, "order",
                            mask.alias("mask"))

    def _crowd(self, i: int, attributes: Sequence[str], found: DataFrame | None
               ) -> tuple[DataFrame, DataFrame, list[str]] | None:
        """Keys of both sides under the source's frequent names, not yet matched."""
        if i not in self.crowded:
            return None
        keys = self._shared(self.targets[i])
        names = self._names_in.where(F.col("source") == i).select(*keys)

        def under(source: Source) -> Source:
            return Source(source.id, _semi_join(source.names, names, on=keys), source.attributes, keys)

        mine = cut(_free(conform(under(self.listed), attributes, ["order"]), found, self.listed.id))
        theirs = cut(_free(conform(under(self._typed(self.targets[i])), attributes, (), mine), found,
                           self.target_id))
        return mine, theirs, [*keys, *attributes]

    def _round(self, near: DataFrame, order: int, crowd, new: DataFrame | None) -> DataFrame:
        """Clean matches of one source and name priority, ``new`` ids blocked."""
        a, b = self.listed.id, self.target_id
        near = _free(_free(near, new, a), new, b)
        hits = near.groupBy(a).agg(F.min(b).alias("__lo"), F.max(b).alias("__hi"))
        if crowd is not None:
            mine, theirs, keys = crowd
            per_key = _free(theirs, new, b).groupBy(*keys).agg(
                F.min(b).alias("__lo"), F.max(b).alias("__hi"))
            mine = _free(mine.where(F.col("order") == order), new, a).select(a, *keys)
            more = _join_group_stats(mine, per_key, keys, how="inner").select(a, "__lo", "__hi")
            hits = hits.unionByName(more).groupBy(a).agg(F.min("__lo").alias("__lo"),
                                                         F.max("__hi").alias("__hi"))
        sure = hits.where(F.col("__lo") == F.col("__hi")).select(a, F.col("__lo").alias(b))
        return only_unique(sure, [b]).withColumn("order", F.lit(order))

    def tier(self, attributes: Sequence[str], found: DataFrame | None) -> DataFrame:
        """All targets, all name priorities, on the given attributes.

        What is still free is filtered and written once for the tier; a source
        and priority without a free candidate costs nothing.
        """
        bits = sum(1 << ATTRIBUTES.index(a) for a in attributes)
        near = self.candidates.where(F.col("mask").bitwiseAND(F.lit(bits)) == bits).drop("mask")
        open_ = {(s, o) for s, o, m in self.counts if m & bits == bits}
        if open_ and found is not None:
            near = cut(_free(_free(near, found, self.listed.id), found, self.target_id))
            # at most sources x priorities rows
            open_ = {(r[0], r[1]) for r in near.select("source", "order").distinct().collect()}
        new: list[DataFrame] = []
        for i in range(len(self.targets)):
            crowd = self._crowd(i, attributes, found)
            for o in self.orders:
                if crowd is None and (i, o) not in open_:
                    continue
                made = cut(self._round(near.where((F.col("source") == i) & (F.col("order") == o)),
                                       o, crowd, _all(new)))
                if not made.isEmpty():
                    new.append(made)
        if new:
            return cut(_all(new if found is None else [found, *new]))
        return found if found is not None else self.candidates.select(
            self.listed.id, self.target_id, "order").limit(0)

    def run(self, chained: Sequence[Sequence[str]] = S.CHAINED_TIERS,
            branches: Sequence[Sequence[str]] = S.OPEN_BRANCHES,
            middle_branches: Sequence[Sequence[str]] = S.MIDDLE_NAME_BRANCHES,
            overrides: DataFrame | None = None, min_length: int = 10) -> DataFrame:
        """The one-to-one crosswalk."""
        ids = [self.listed.id, self.target_id]
        base = None
        for attributes in chained:
            base = self.tier(attributes, base)
        loose = []
        for attributes in branches:
            loose.append(_anti_join(self.tier(attributes, base).select(*ids),
                                   base.select(*ids), null_equal=False))
        with_middle = (self.listed.names.where(F.col("middlename") != "")
                       .where(F.col("order") == 1).select(self.listed.id).distinct())
        for attributes in middle_branches:
            new = self.tier(attributes, base).where(F.col("order") == 1).select(*ids)
            new = _semi_join(new, with_middle, on=[self.listed.id], null_equal=False)
            loose.append(_anti_join(new, base.select(*ids), null_equal=False))
        out = base.select(*ids)
        if loose:
            more = reduce(lambda a, b: a.unionByName(b), loose).distinct()
            more = only_unique(only_unique(more, [ids[0]]), [ids[1]])
            out = out.unionByName(more)
        if overrides is not None:
            out = out.unionByName(overrides.select(*ids))
        out = cut(out.distinct())
        return out.unionByName(self.unpunctuated(out, min_length))

    def unpunctuated(self, found: DataFrame, min_length: int = 10) -> DataFrame:
        """Matches on names without apostrophes, hyphens and spaces, among the
        entries not matched yet; short names do not count."""
        a, b = self.listed.id, self.target_id

        def flat(df: DataFrame, i: str) -> DataFrame:
            return df.select(i, drop_chars("name", "'- ").alias("__flat")).distinct()

        mine = flat(_anti_join(self.listed.names, found.select(a), on=[a], null_equal=False), a)
        theirs = flat(self.targets[0].names, b)
        pairs = clean_matches(mine, theirs, a, b, ["__flat"])
        agreed = _natural_join(_natural_join(pairs, mine, on=[a], null_equal=False), theirs,
                              on=[b, "__flat"], null_equal=False)
        new = agreed.where(F.length("__flat") >= min_length).select(a, b).distinct()
        return _anti_join(new, found.select(b), on=[b], null_equal=False)


def list_source(people: DataFrame, names: DataFrame) -> Source:
    """The licence list: type, state, 5-digit ZIP and phone as listed."""
    phone = drop_chars("Phone", "-() ")
    return Source("samhsa_id", names, {
        "practitioner_type": people.select(
            "samhsa_id", F.col("PractitionerType").alias("practitioner_type")),
        "state": people.select("samhsa_id", F.col("State").alias("state")),
        "zip5": people.select("samhsa_id", F.substring("Zip", 1, 5).alias("zip5")),
        "tel": people.select("samhsa_id", phone.alias("tel")),
    }, ("name", "Suffix"))


def registry_source(names: DataFrame, types: DataFrame, state: DataFrame, zips: DataFrame,
                    phones: DataFrame, link_types: Sequence[str] = S.LINK_TYPES) -> Source:
    """The registry's primary locations (or secondary ones, renamed)."""
    return Source("npi", names, {
        "practitioner_type": indicators_to_long(types, ["npi"], list(link_types),
                                                "practitioner_type"),
        "state": state.select("npi", F.col("plocstatename").alias("state")),
        "zip5": zips.select("npi", F.substring("ploczip", 1, 5).alias("zip5")),
        # blank phones never match across sources
        "tel": phones.select("npi", F.col("ploctel").alias("tel")).na.drop(),
    })


def secondary_source(names: DataFrame, types: DataFrame, locations: DataFrame,
                     link_types: Sequence[str] = S.LINK_TYPES) -> Source:
    """The registry's secondary locations (``ploc2...``), under its own names."""
    def renamed(column: str) -> DataFrame:
        return locations.select("npi", F.col(f"ploc2{column}").alias(f"ploc{column}"))

    return registry_source(names, types, renamed("statename"), renamed("zip"), renamed("tel"), link_types)


def directory_source(names: DataFrame, types: DataFrame, directory: DataFrame) -> Source:
    """The clinician directory. It shares the suffix column with the list."""
    kind = (F.when(F.col("credential").isin("MD", "DO"), "MD/DO")
            .when(F.col("credential") == "CNA", "CRNA").otherwise(F.col("credential")))
    return Source("npi", names.withColumnRenamed("suffix", "Suffix"), {
        "practitioner_type": types.select("npi", kind.alias("practitioner_type")),
        "state": directory.select("npi", "state"),
        "zip5": directory.select("npi", F.substring("zip", 1, 5).alias("zip5")).na.drop(),
        "tel": directory.select("npi", F.col("phone").alias("tel")).na.drop(),
    }, ("name", "Suffix"))


def crosswalk(people: DataFrame, list_names: DataFrame, names: DataFrame, types: DataFrame,
              state: DataFrame, zips: DataFrame, phones: DataFrame, directory_names: DataFrame,
              directory_types: DataFrame, directory: DataFrame, secondary: DataFrame,
              link_types: Sequence[str] = S.LINK_TYPES, orders: Sequence[int] | None = None,
              **tiers) -> DataFrame:
    """From panels, directory and licence list to the one-to-one crosswalk:
    registry locations first, then the directory, then secondary locations.
    ``tiers`` are those of ``TieredLinkage.run``."""
    sources = [registry_source(names, types, state, zips, phones, link_types),
               directory_source(directory_names, directory_types, directory),
               secondary_source(names, types, secondary, link_types)]
    return TieredLinkage(list_source(people, list_names), sources, link_types, orders).run(**tiers)


# ----------------------------------------------------------- death records

def name_classes(rows: DataFrame, key: str) -> DataFrame:
    """Each id's set of (pfname, plname, middle) and the set's digest, so that
    ids with the same names are one class."""
    named = rows.where("pfname IS NOT NULL AND plname IS NOT NULL")
    sets = named.groupBy(key).agg(
        F.array_sort(F.collect_set(F.struct("pfname", "plname", "middle"))).alias("names"))
    return sets.withColumn("class", F.sha2(F.to_json("names"), 256))


def agreeing_classes(cases: DataFrame, people: DataFrame) -> DataFrame:
    """Pairs of name classes that share a first and last name, with no conflict
    of middle names in any they share. As many rows as there are different sets
    of names, however many ids bear them."""
    def spelled(classes: DataFrame, c: str, m: str) -> DataFrame:
        one = classes.groupBy("class").agg(F.any_value("names").alias("names"))
        return one.select(F.col("class").alias(c), F.inline("names")).withColumnRenamed("middle", m)

    met = natural_join(spelled(cases, "case_class", "__a"), spelled(people, "npi_class", "__b"),
                       on=["pfname", "plname"], null_equal=False)
    a, b = F.length("__a"), F.length("__b")
    same_kind = ((a > 1) & (b > 1)) | ((a == 1) & (b == 1))
    conflict = F.coalesce(same_kind & (F.col("__a") != F.col("__b")), F.lit(False))
    return (met.groupBy("case_class", "npi_class").agg(F.max(conflict).alias("__bad"))
            .where(~F.col("__bad")).drop("__bad"))


def death_matches(cases: DataFrame, names: DataFrame, case_id: str, first: str, middle: str,
                  last: str) -> DataFrame:
    """(case, npi) pairs with the same first and last name and no conflict of
    middle names: full against full, or initial against initial. Conflicts are
    settled between sets of names; ids come back at the end."""
    def tidy(c: str):
        return F.trim(F.upper(c))

    c = cases.select(F.col(case_id), tidy(first).alias("pfname"), tidy(last).alias("plname"),
                     F.trim(drop_chars(F.coalesce(tidy(middle), F.lit("")), ".")).alias("middle"))
    n = semi_join(names.select("npi", "pfname", "plname", F.col("pmname").alias("middle")),
                  c.select("pfname", "plname"), on=["pfname", "plname"], null_equal=False)
    c, n = name_classes(c, case_id), name_classes(n, "npi")
    pairs = agreeing_classes(c, n)
    found = join_group_stats(c.select(case_id, F.col("class").alias("case_class")), pairs,
                             ["case_class"], "inner", null_equal=False)
    found = join_group_stats(n.select("npi", F.col("class").alias("npi_class")), found,
                             ["npi_class"], "inner", null_equal=False)
    return found.select(case_id, "npi")


def death_and_deactivation(matches: DataFrame, cases: DataFrame, removed: DataFrame,
                           case_id: str, death: str) -> DataFrame:
    """Matched cases whose death is on or before the deactivation, with the
    days between."""
    out = natural_join(natural_join(matches, cases, on=[case_id], null_equal=False),
                       removed, on=["npi"], null_equal=False)
    return (out.where(F.col(death) <= F.col("npideactdate"))
            .withColumn("days_betw_death_deact", F.datediff("npideactdate", death)))


def matching_state(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Whether the target state equals any of the listed columns."""
    hit = reduce(lambda a, b: a | b, [
        F.coalesce(F.col(c) == F.col(target), F.lit(False)) for c in columns])
    return df.withColumn("has_matching_state", hit)
