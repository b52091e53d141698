"""Linking list and registry, and death records."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from harness.registry import query
from rosterlake import schemas as S
from rosterlake.operators.joins import natural_join, semi_join
from rosterlake.operators.reshape import numbered_columns
from rosterlake.plans import linkage as L
from rosterlake.sources.crosswalk import attach_crosswalk, read_crosswalk, store_crosswalk


_ATTRS = ["practitioner_type", "state", "zip5", "tel"]
# blank phones never match across sources; other blanks do
_SAME = {a: f"l.{a} IS NOT DISTINCT FROM r.{a}" for a in _ATTRS[:3]} | {"tel": "l.tel = r.tel"}


def _sources(t):
    def attrs(df, i):
        return {a: df.select(F.col("k").alias(i), a) for a in _ATTRS}

    mine = t.link_attr.where("side = 1")
    theirs = t.link_attr.where("side = 0")
    listed = L.Source("samhsa_id", t.link_list.withColumnRenamed("ord", "order"),
                      attrs(mine, "samhsa_id"), ("name", "Suffix"))
    there = attrs(theirs, "npi")
    there["tel"] = there["tel"].na.drop()
    primary = L.Source("npi", t.link_target.drop("Suffix"), there)
    listed_too = L.Source("npi", t.link_target.where("npi % 3 <> 1"), there, ("name", "Suffix"))
    return listed, primary, listed_too


class _Sql:
    """CTEs of the same matching with the pairs spelled out."""

    def __init__(self):
        self.parts, self.n = [
            "l AS (SELECT samhsa_id, name, middlename, ord, practitioner_type, state, zip5, tel FROM link_list JOIN link_attr ON k = samhsa_id AND side = 1)",
            "r0 AS (SELECT npi, name, practitioner_type, state, zip5, tel FROM link_target JOIN link_attr ON k = npi AND side = 0)",
            "r1 AS (SELECT * FROM r0 WHERE npi % 3 <> 1)"], 0

    def add(self, body):
        self.n += 1
        self.parts.append(f"s{self.n} AS ({body})")
        return f"s{self.n}"

    def round(self, attrs, target, order, found):
        on = " AND ".join(["l.name = r.name"] + [_SAME[a] for a in attrs])
        free = "" if found is None else (f" AND l.samhsa_id NOT IN (SELECT samhsa_id FROM {found})"
                                         f" AND r.npi NOT IN (SELECT npi FROM {found})")
        p = self.add(f"SELECT DISTINCT samhsa_id, npi FROM l JOIN {target} r ON {on} WHERE ord = {order}{free}")
        a = self.add(f"SELECT samhsa_id, min(npi) AS npi FROM {p} GROUP BY 1 HAVING count(*) = 1")
        b = self.add(f"SELECT min(samhsa_id) AS samhsa_id, npi, {order} AS ord FROM {a} GROUP BY 2 HAVING count(*) = 1")
        return b if found is None else self.add(f"SELECT * FROM {found} UNION ALL SELECT * FROM {b}")

    def tier(self, attrs, found, targets=("r0", "r1"), orders=(1, 2)):
        for target in targets:
            for o in orders:
                found = self.round(attrs, target, o, found)
        return found

    def finish(self, base, loose):
        """Union of the branches, unique both ways, and the punctuation-free pass."""
        s = self
        u = s.add(f"SELECT * FROM ({' UNION '.join(loose)}) EXCEPT SELECT samhsa_id, npi FROM {base}")
        a = s.add(f"SELECT samhsa_id, min(npi) AS npi FROM {u} GROUP BY 1 HAVING count(*) = 1")
        b = s.add(f"SELECT min(samhsa_id) AS samhsa_id, npi FROM {a} GROUP BY 2 HAVING count(*) = 1")
        fin = s.add(f"SELECT samhsa_id, npi FROM {base} UNION SELECT samhsa_id, npi FROM {b}")

        def flat(c):
            return f"replace(replace(replace({c}, '''', ''), '-', ''), ' ', '')"

        x = s.add(f"SELECT DISTINCT samhsa_id, {flat('name')} AS f FROM l WHERE samhsa_id NOT IN (SELECT samhsa_id FROM {fin})")
        y = s.add(f"SELECT DISTINCT npi, {flat('name')} AS f FROM r0")
        p = s.add(f"SELECT samhsa_id, min(npi) AS npi, max(length({x}.f)) AS n FROM {x} JOIN {y} ON {x}.f = {y}.f GROUP BY 1 HAVING count(DISTINCT npi) = 1")
        q = s.add(f"SELECT min(samhsa_id) AS samhsa_id, npi, max(n) AS n FROM {p} GROUP BY 2 HAVING count(*) = 1")
        return s.text(f"SELECT samhsa_id, npi FROM {fin} UNION ALL SELECT samhsa_id, npi FROM {q} WHERE n >= 10 "
                      f"AND npi NOT IN (SELECT npi FROM {fin})")

    def text(self, tail):
        return "WITH " + ",\n".join(self.parts) + "\n" + tail


_USES = ["link_list", "link_target", "link_attr"]


def _l5():
    s = _Sql()
    out = s.round(["practitioner_type", "state"], "r0", 1, None)
    return s.text(f"SELECT samhsa_id, npi FROM {out}")


@query("l5_clean_match", _USES, _l5())
def _(t):
    listed, primary, _ = _sources(t)
    keys = ["practitioner_type", "state"]
    a = L.conform(L.Source(listed.id, listed.names, listed.attributes), keys, ["order"])
    b = L.conform(primary, keys)
    return L.clean_matches(a.where(F.col("order") == 1), b, "samhsa_id", "npi", ["name", *keys])


def _l6():
    s = _Sql()
    out = s.tier(["state", "zip5"], None)
    return s.text(f"SELECT samhsa_id, npi, CAST(ord AS INT) AS \"order\" FROM {out}")


@query("l6_match_by_order", _USES, _l6())
def _(t):
    return L.TieredLinkage(*(lambda a, b, c: (a, [b, c]))(*_sources(t)), orders=[1, 2]).tier(
        ["state", "zip5"], None)


_CHAIN = [["practitioner_type", "state", "zip5", "tel"], ["practitioner_type", "state"]]
_OPEN = [["state", "zip5"]]
_MIDDLE = [["state"], []]


def _l8():
    s = _Sql()
    base = None
    for attrs in _CHAIN:
        base = s.tier(attrs, base)
    loose = []
    for attrs in _OPEN:
        loose.append(f"SELECT samhsa_id, npi FROM {s.tier(attrs, base)}")
    for attrs in _MIDDLE:
        loose.append(f"SELECT samhsa_id, npi FROM {s.tier(attrs, base)} WHERE ord = 1 AND samhsa_id IN "
                     "(SELECT samhsa_id FROM l WHERE middlename <> '' AND ord = 1)")
    return s.finish(base, loose)


@query("l8_tiered_match", _USES, _l8())
def _(t):
    listed, primary, listed_too = _sources(t)
    run = L.TieredLinkage(listed, [primary, listed_too], orders=[1, 2])
    return run.run(chained=_CHAIN, branches=_OPEN, middle_branches=_MIDDLE)


def _s16():
    s = _Sql()
    out = s.round(["state"], "r0", 1, None)
    return s.text(f"SELECT DISTINCT t.npi, t.name, samhsa_id FROM {out} JOIN link_target t ON {out}.npi = t.npi")


def _three():
    """All ten tiers on registry locations, directory and secondary locations."""
    s = _Sql()
    s.parts.append("r2 AS (SELECT npi, name, practitioner_type, CASE WHEN state IS NOT NULL THEN 'ZZ' END AS state, zip5, tel FROM r0 WHERE npi % 2 = 0)")
    at = ("r0", "r1", "r2")
    base = None
    for attrs in S.CHAINED_TIERS:
        base = s.tier(attrs, base, at)
    loose = [f"SELECT samhsa_id, npi FROM {s.tier(attrs, base, at)}" for attrs in S.OPEN_BRANCHES]
    loose += [f"SELECT samhsa_id, npi FROM {s.tier(attrs, base, at)} WHERE ord = 1 AND samhsa_id IN "
              "(SELECT samhsa_id FROM l WHERE middlename <> '' AND ord = 1)" for attrs in S.MIDDLE_NAME_BRANCHES]
    return s.finish(base, loose)


def _people_of(t):
    """The stand-ins in the shapes that the sources are read from."""
    mine, theirs = t.link_attr.where("side = 1"), t.link_attr.where("side = 0").withColumnRenamed("k", "npi")
    people = mine.select(F.col("k").alias("samhsa_id"), F.col("practitioner_type").alias("PractitionerType"),
                         F.col("state").alias("State"), F.concat("zip5", F.lit("-0000")).alias("Zip"),
                         F.concat(F.lit("("), F.col("tel"), F.lit(")")).alias("Phone"))
    types = theirs.select("npi", *[(F.col("practitioner_type") == p).cast("int").alias(p) for p in S.LINK_TYPES])
    place = theirs.select("npi", F.col("state").alias("plocstatename"), F.col("zip5").alias("ploczip"),
                          F.col("tel").alias("ploctel"))
    second = place.where("npi % 2 = 0").select(
        "npi", F.when(F.col("plocstatename").isNotNull(), "ZZ").alias("ploc2statename"),
        F.col("ploczip").alias("ploc2zip"), F.col("ploctel").alias("ploc2tel"))
    directory = theirs.where("npi % 3 <> 1").select("npi", "state", F.col("zip5").alias("zip"), F.col("tel").alias("phone"))
    listed_types = theirs.where("npi % 3 <> 1").select("npi", F.when(F.col("practitioner_type") == "MD/DO", "MD").otherwise(
        F.col("practitioner_type")).alias("credential"))
    names = t.link_target
    return dict(people=people, list_names=t.link_list.withColumnRenamed("ord", "order"), names=names.drop("Suffix"),
                types=types, state=place, zips=place, phones=place,
                directory_names=names.where("npi % 3 <> 1").withColumnRenamed("Suffix", "suffix"),
                directory_types=listed_types, directory=directory, secondary=second)


@query("l8_three_sources", _USES, _three())
def _(t):
    return L.crosswalk(**_people_of(t))


@query("s16_stored_crosswalk", _USES, _s16())
def _(t):
    """Matches stored in buckets, read back and joined to who they are."""
    listed, primary, _ = _sources(t)
    found = L.TieredLinkage(listed, [primary], orders=[1]).tier(["state"], None)
    table = f"crosswalk_{uuid.uuid4().hex}"
    store_crosswalk(found, table, buckets=8)
    return attach_crosswalk(t.link_target.select("npi", "name").distinct(),
                            read_crosswalk(t.spark, table, check=True))


_DEATH = """c AS (SELECT case_id, upper(trim(first)) AS f, replace(upper(trim(coalesce(middle, ''))), '.', '') AS m, upper(trim(last)) AS l FROM deaths),
    p AS (SELECT case_id, npi, m, pmname FROM c JOIN death_names ON f = pfname AND l = plname),
    bad AS (SELECT case_id, npi FROM p WHERE m <> pmname AND ((length(m) > 1 AND length(pmname) > 1) OR (length(m) = 1 AND length(pmname) = 1))),
    ok AS (SELECT DISTINCT case_id, npi FROM p WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.case_id = p.case_id AND b.npi = p.npi))"""


def _deaths(t):
    return L.death_matches(t.deaths, t.death_names, "case_id", "first", "middle", "last")


@query("l9_death_match", ["deaths", "death_names"], f"WITH {_DEATH} SELECT * FROM ok")
def _(t):
    return _deaths(t)


@query("l10_death_review", ["deaths", "death_names", "death_removed", "death_states", "licence_state"], f"""WITH {_DEATH},
    lic AS (SELECT npi, row_number() OVER (PARTITION BY npi ORDER BY PLICSTATE) AS n, PLICSTATE FROM (SELECT DISTINCT npi, PLICSTATE FROM licence_state)),
    w AS (SELECT npi, max(CASE WHEN n = 1 THEN PLICSTATE END) AS PLICSTATE1, max(CASE WHEN n = 2 THEN PLICSTATE END) AS PLICSTATE2 FROM lic GROUP BY 1)
    SELECT ok.case_id, ok.npi, death_date, npideactdate, death_state, plocstatename, PLICSTATE1, PLICSTATE2,
      CAST(npideactdate - death_date AS INT) AS days_betw_death_deact,
      coalesce(death_state = plocstatename, false) OR coalesce(death_state = PLICSTATE1, false) OR coalesce(death_state = PLICSTATE2, false) AS has_matching_state
    FROM ok JOIN deaths d ON ok.case_id = d.case_id JOIN death_removed x ON ok.npi = x.npi AND death_date <= npideactdate
    LEFT JOIN w ON ok.npi = w.npi LEFT JOIN death_states s ON ok.npi = s.npi""")
def _(t):
    """Review list: matched deaths before deactivation, with licences side by
    side and whether any state agrees."""
    m = L.death_and_deactivation(_deaths(t), t.deaths.drop("first", "middle", "last"),
                                 t.death_removed, "case_id", "death_date")
    lic = numbered_columns(semi_join(t.licence_state, m.select("npi"), on=["npi"], null_equal=False),
                           ["npi"], ["PLICSTATE"], 7).select("npi", "PLICSTATE1", "PLICSTATE2")
    out = natural_join(natural_join(m, lic, "left", on=["npi"], null_equal=False), t.death_states,
                       "left", on=["npi"], null_equal=False)
    return L.matching_state(out, "death_state", ["plocstatename", "PLICSTATE1", "PLICSTATE2"])
