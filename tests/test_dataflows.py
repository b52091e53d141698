import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterlake import schemas as S
from rosterlake.functions import dates as D
from rosterlake.plans import directory as Dir
from rosterlake.plans import linkage as L
from rosterlake.plans import names as N
from rosterlake.plans import practices as P
from rosterlake.plans import registry as G
from tests.conftest import rows


# ------------------------------------------------------------------- names

def _loop(name, endings):
    """The ordered loop, to a fixed point, on one name."""
    import re

    def one(n, cut):
        for e in endings:
            if n.endswith(" " + e):
                cut.append(e)
                n = n[:len(n) - len(e)]
            n = n.strip()
            if n.endswith(","):
                n = n[:-1]
        return n
    cut = []
    n = one(name, cut)
    n = re.sub(r"(.*\s[A-Z]?)(\.)(\s)", r"\1\3", n)
    while True:
        again = one(n, cut)
        if again == n:
            return n, cut
        n = again


def test_strip_endings_against_the_loop(spark):
    rnd = random.Random(9)
    tokens = ["M.D.", "M. D.", "D.", "PHD", "JR.", "MD", ",", "III,", "SR", "PA-C", "X"]
    data = []
    for i in range(300):
        tail = "".join(rnd.choice([" ", ", ", ","]) + rnd.choice(tokens) for _ in range(rnd.randint(0, 4)))
        data.append((i, rnd.choice(["ANN Q. LEE", "BO ST. JAMES", "CY"]) + tail))
    df = spark.createDataFrame(data, "i int, NameFull string")
    got = {r.i: (r.NameFull, list(r.stripped)) for r in N.strip_endings(df, "NameFull", S.NAME_ENDINGS).collect()}
    want = {i: _loop(n, S.NAME_ENDINGS) for i, n in data}
    assert got == want


def test_endings_as_tried_one_by_one(spark):
    """The same names and parts as trying every ending in order, pass by pass;
    the passes are planned once and not left to the few tasks of a small file."""
    import re

    def reference(n):
        cut, first, before = [], True, None
        while n != before:
            before = n
            for e in S.NAME_ENDINGS:
                hit = n.endswith(" " + e)
                n = (n[:-len(e)] if hit else n).strip(" ")
                n = n[:-1] if n.endswith(",") else n
                cut += [e] * hit
            if first:
                n, first, before = re.sub(r"(.*\s[A-Z]?)(\.)(\s)", r"\1\3", n), False, None
        return n, cut

    rnd = random.Random(3)
    bits = [*S.NAME_ENDINGS, "JOHN", "Q.", "LEE", "ST. JAMES", ",", ",,", "", "A"]
    names = ["", " ", ",", "MD", " MD", "A\n", "A MD\n", "A,, MD, ,", "  A B, JR. MD ,"]
    names += [rnd.choice([" ", ", ", "  "]).join(rnd.choices(bits, k=rnd.randint(1, 6))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(names)) + [(-1, None)], "i int, NameFull string").coalesce(1)
    out = N.strip_endings(df, "NameFull", S.NAME_ENDINGS)
    got = {r.i: (r.NameFull, list(r.stripped)) for r in out.collect()}
    assert got.pop(-1) == (None, [])
    assert got == {i: reference(n) for i, n in enumerate(names)}
    plan = N.suffix_tokens(out, "i")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and plan.count("namedlambdavariable") == \
        out._jdf.queryExecution().optimizedPlan().toString().count("namedlambdavariable")


def test_listed_names_order_and_suffix(spark):
    df = spark.createDataFrame([(1, "ANN  Q. LEE, JR., M.D."), (2, "CHER")], "samhsa_id int, NameFull string")
    names, tokens = N.listed_names(df)
    first = {r.samhsa_id: r for r in names.where("order = 1").collect()}
    assert first[1]["name"] == "ANN Q LEE JR" and first[1].Suffix == "JR"
    assert first[2]["name"] == "CHER CHER"
    assert (1, "MD") in rows(tokens)


def test_suffix_moves_out_of_last_name(spark):
    df = spark.createDataFrame(
        [(1, "A", "", "SMITH, JR", ""), (2, "A", "", "SMITH JR", ""), (3, "A", "", "SMITHJR", ""),
         (4, "A", "", "SMITH,J R", ""), (5, "A", "", "SMITH", "JR"), (6, "A", "", "O'BRIEN-SMITH", ""),
         (7, "A", "", "JR SMITH JR", "")],
        "npi int, f string, m string, l string, s string")
    out = {r.npi: (r.l, r.s) for r in N.suffix_out_of_last_name(df, "l", "s").collect()}
    assert out[1] == out[2] == out[3] == ("SMITH", "JR") and out[4] == ("SMITH", "J R")
    assert out[5] == ("SMITH", "JR") and out[6] == ("O'BRIEN-SMITH", "") and out[7] == ("JR SMITH", "JR")


def test_parentheses_become_alternatives(spark):
    df = spark.createDataFrame(
        [(1, "ANN", "", "JONES (MAIDEN DOE)", "JR", 0), (2, "NONE", "", "NONE", "", 0), (3, "P", "", "X)Y", "", 0)],
        "npi int, pfname string, pmname string, plname string, pnamesuffix string, othflag int")
    out = rows(N.resolve_parentheses(df), "npi", "plname", "pnamesuffix")
    assert out == [(1, "DOE", "JR"), (1, "JONES", "JR")]
    fix = spark.createDataFrame([("plname", "X)Y", "XY")], "column string, found string, use string")
    assert (3, "XY", "") in rows(N.resolve_parentheses(df, fix), "npi", "plname", "pnamesuffix")


def test_expand_names_spells_out(spark):
    df = spark.createDataFrame([(1, "J.", "QUINN", "LEE", "III")], "npi int, f string, m string, l string, s string")
    got = {r.name for r in N.expand_names(df, "npi", "f", "m", "l", "s").collect()}
    assert {"J. QUINN LEE", "J Q LEE", "J LEE III", "J. LEE"} <= got and len(got) == 12


# ---------------------------------------------------------------- registry

def test_removals(spark):
    d = [(1, date(2015, 1, 1)), (2, date(2015, 1, 1)), (3, date(2015, 1, 1)), (4, date(2015, 1, 1))]
    r = [(2, date(2016, 1, 1)), (3, date(2014, 1, 1)), (4, date(2015, 1, 1))]
    out = G.removals(spark.createDataFrame(d, "npi long, npideactdate date"),
                     spark.createDataFrame(r, "npi long, npireactdate date"))
    assert [x[0] for x in rows(out)] == [1, 3]


def test_entities_are_checked():
    assert G.normalize_entities([2, 1]) == [1, 2]
    with pytest.raises(ValueError):
        G.normalize_entities(3)


def test_student_and_no_category_give_way(spark):
    creds = spark.createDataFrame([(1, "MD/DO"), (1, None), (2, None)], "npi int, cat string")
    codes = spark.createDataFrame([(1, "Student"), (2, "Student"), (3, "Student"), (3, "RN")], "npi int, cat string")
    out = {r.npi: r for r in G.practitioner_types(creds, codes).collect()}
    assert (out[1]["MD/DO"], out[1]["Student"], out[1]["No Category"]) == (1, 0, 0)
    assert (out[2]["Student"], out[2]["No Category"]) == (1, 1)
    assert (out[3]["RN"], out[3]["Student"]) == (1, 0)


# --------------------------------------------------------------- directory

def test_school_choice(spark):
    df = spark.createDataFrame(
        [(1, "OTHER", None), (2, "OTHER", 1990), (2, "YALE", 1991), (2, "YALE", None), (3, "OTHER", 1990),
         (3, "YALE", None), (4, "OTHER", None), (4, "YALE", None), (4, None, 1980), (5, None, None), (5, "OTHER", None)],
        "npi long, medical_school string, graduation_year long")
    assert [r[1] for r in rows(Dir.medical_school(df))] == ["OTHER", "YALE", "OTHER", "YALE", "OTHER"]


def test_credential_from_specialty_with_ties(spark):
    data = [(i, "A", "MD") for i in range(3)] + [(9, "A", " "), (10, "B", "NP"), (11, "B", "PA"), (12, "B", None), (13, "C", None)]
    df = spark.createDataFrame(data, "npi int, primary_specialty string, credential string")
    out = rows(Dir.directory_types(df, 0), "npi", "credential")
    assert (9, "MD/DO") in out and {(12, "NP"), (12, "PA")} <= set(out) and (13, None) in out


def test_group_passes_do_not_depend_on_order(spark):
    rnd = random.Random(4)
    data = [(rnd.randint(1, 12), date(rnd.choice([2014, 2016, 2018, 2019]), 1, 1), rnd.choice(["O1", "O2", None]),
             rnd.choice([1, 2, 3, None, None]), rnd.choice([5, None]), rnd.choice(["MA", "NY", None]),
             rnd.choice(["02139", "10001"]), rnd.choice(["6175550000", None, "6175550001"])) for _ in range(300)]
    df = spark.createDataFrame(data, "npi int, date date, org_name string, group_id int, group_size int, "
                                     "state string, zip string, phone string")
    a = P.infer_groups(df)
    for x, y in zip(a, P.infer_groups(df.orderBy(F.rand(3)).repartition(5, "zip"))):
        assert rows(x) == rows(y)
    assert a[0].where("group_id is null").isEmpty() and a[1].where("group_id is not null").isEmpty()


def test_group_passes_move_persons_once(spark, monkeypatch):
    rnd = random.Random(9)
    data = [(rnd.choice([None, *range(1, 40)]), rnd.choice([None, date(rnd.choice([2014, 2018, 2019]), 1, 1)]),
             rnd.choice(["O1", "O2", None]), rnd.choice([1, 2, 3, None, None]), rnd.choice([5, None]),
             rnd.choice(["MA", "NY", None]), rnd.choice(["02139", "10001", None]),
             rnd.choice(["6175550000", None, "6175550001"])) for _ in range(700)]
    data = [r if (r[0] or 1) % 3 else (*r[:3], None, *r[4:]) for r in data]
    df = spark.createDataFrame(data, "npi int, date date, org_name string, group_id int, group_size int, "
                                     "state string, zip string, phone string")
    written, cut = [], P.cut
    monkeypatch.setattr(P, "cut", lambda d: written.append(1) or cut(d))
    beside = [rows(d) for d in P.infer_groups(df)]
    assert len(written) <= 4    # a pass is no table of its own
    # persons of any size, and some of each kind
    for limit in (0, 20):
        assert [rows(d) for d in P.infer_groups(df, person_rows=limit)] == beside


# ----------------------------------------------------------------- linkage

def _pairs(left, right, blocked):
    used1, used2 = {a for a, _ in blocked}, {b for _, b in blocked}
    m = {(i, j) for i, k in left for j, k2 in right if k == k2 and i not in used1 and j not in used2}
    one = {i for i, _ in m if sum(a == i for a, _ in m) == 1}
    m = {p for p in m if p[0] in one}
    return {p for p in m if sum(b == p[1] for _, b in m) == 1}


def test_counts_come_along_only_for_the_rows_asked_for(spark):
    q = date(2015, 1, 1)
    people = spark.createDataFrame([(1, q, "S", 7, 8, 9), (2, q, "S", 7, 8, None), (3, q, None, 7, None, 9)],
                                   "npi long, quarter date, state string, group_id long, "
                                   "my_group_id long, my_group_id_npi long")
    types = spark.createDataFrame([(1, 1, 0, "MD/DO"), (2, 0, 1, "NP"), (3, 1, 1, "both")],
                                  '`npi` long, `MD/DO` long, `NP` long, `cat` string')
    theirs = P.physician_rows(people, types)
    counts = P.role_counts(people, types, of=theirs)
    assert rows(counts, "npi", "MDDO_gppid", "NP_gppid", "MDDO_mgi", "NP_mgi", "MDDO_mginpi",
                "NP_mginpi") == [(1, 2, 2, 1, 1, 2, 1)]
    assert rows(P.largest_counts(counts)) == rows(P.copractices(P.role_counts(people, types), types))


def test_listed_sizes_need_no_count(spark):
    d = date(2015, 1, 1)
    listed = spark.createDataFrame([
        (1, d, 5, 3, "A", "S", "1", "9"), (2, d, 5, None, "A", "S", "1", "9"), (2, d, 5, None, "B", "S", "1", "9"),
        (3, d, None, None, "C", "S", "1", "9"), (4, None, 5, 3, "A", "S", "1", "9")],
        "npi long, date date, group_id long, group_size long, org_name string, state string, zip string, phone string")
    alone = S.ID_BY_PHONE_PLACE
    assert rows(P.sole_practices(listed), "npi", "group_id", "group_size", "org_name") == [
        (1, 5, 3, "A"), (2, 5, 2, "A"), (2, 5, 2, "B"), (3, alone, 1, "C")]
    assert rows(P.sole_practices(listed, details=()), "npi", "group_id", "group_size") == [
        (1, 5, 3), (2, 5, 2), (3, alone, 1)]


def test_clean_matches_against_all_pairs(spark):
    rnd = random.Random(8)
    for _ in range(4):
        left = {(rnd.randint(0, 25), rnd.choice("abcdefghijklmnop")) for _ in range(45)}
        right = {(rnd.randint(100, 125), rnd.choice("abcdefghijklmnopqrs")) for _ in range(30)}
        blocked = [(3, 107), (5, 110)]
        got = L.clean_matches(spark.createDataFrame(sorted(left), "i int, k string"),
                              spark.createDataFrame(sorted(right), "j int, k string"), "i", "j", ["k"],
                              spark.createDataFrame(blocked, "i int, j int"))
        assert set(map(tuple, got.collect())) == _pairs(left, right, blocked)


def test_linkage_sends_no_side_through_the_driver(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, k string")
    right = spark.createDataFrame([(7, "a"), (8, "b"), (9, "b"), (6, None)], "j int, k string")
    out = L.clean_matches(left, right, "i", "j", ["k"], spark.createDataFrame([(5, 5)], "i int, j int"))
    assert rows(out) == [(1, 7), (3, 6)]
    near = L.conform(L.Source("j", right.withColumnRenamed("k", "name"), {"state": right.select("j", F.col("k").alias("state"))}),
                     ["state"])
    assert rows(near) == [(6, None, None), (7, "a", "a"), (8, "b", "b"), (9, "b", "b")]
    for df in (out, near):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_crosswalk_is_one_to_one_and_uses_tiers(spark):
    listed = spark.createDataFrame(
        [(1, "ANN LEE", "", "", 1), (2, "BO O'HARA-KAY", "", "", 1), (3, "CY MO", "Q", "", 1), (4, "ANN LEE", "", "", 1)],
        "samhsa_id int, name string, middlename string, Suffix string, order int")
    people = spark.createDataFrame(
        [(1, "MD/DO", "MA", "02139", "1"), (2, "NP", "NY", "10001", "2"), (3, "PA", "TX", "73301", "3"),
         (4, "MD/DO", "CA", "90210", None)],
        "samhsa_id int, PractitionerType string, State string, Zip string, Phone string")
    source = L.list_source(people, listed)
    names = spark.createDataFrame([(11, "ANN LEE"), (12, "BO OHARAKAY"), (13, "CY MO"), (14, "ANN LEE")],
                                  "npi int, name string")
    types = spark.createDataFrame([(11, 1, 0), (14, 1, 0), (12, 0, 1), (13, 0, 0)], "npi int, `MD/DO` int, NP int")
    place = spark.createDataFrame([(11, "MA", "02139", "1"), (14, "CA", "90210", None), (12, "NY", "10001", "2"), (13, "TX", "00000", "9")],
                                  "npi int, plocstatename string, ploczip string, ploctel string")
    target = L.registry_source(names, types, place, place, place, ["MD/DO", "NP"])
    out = L.TieredLinkage(source, [target]).run()
    assert rows(out) == [(1, 11), (2, 12), (3, 13), (4, 14)]


def _two_sides(spark, seed=4):
    rnd = random.Random(seed)
    names = [f"N{i} {c}" for i in range(12) for c in "AB"] + ["COMMON NAME"] * 12
    def side(ids, id_, extra):
        made = [(i, n, *extra(k)) for i in ids for k, n in enumerate(dict.fromkeys(rnd.sample(names, 2)), 1)]
        attrs = {a: [(i, rnd.choice(["p", "q", "r", None])) for i in ids for _ in range(rnd.choice([1, 1, 2]))]
                 for a in L.ATTRIBUTES}
        return made, {a: spark.createDataFrame(v, f"{id_} int, {a} string").distinct() for a, v in attrs.items()}
    mine, a = side(range(1, 60), "samhsa_id", lambda k: ("", "", k))
    theirs, b = side(range(100, 160), "npi", lambda k: ())
    b["practitioner_type"] = b["practitioner_type"].na.fill("MD/DO")
    listed = L.Source("samhsa_id", spark.createDataFrame(
        mine, "samhsa_id int, name string, middlename string, Suffix string, order int"), a, ("name", "Suffix"))
    return listed, L.Source("npi", spark.createDataFrame(theirs, "npi int, name string"), b)


def test_frequent_names_match_the_same_way(spark):
    """No pairs at all, some, and all of them lead to the same matches."""
    listed, target = _two_sides(spark)
    found = []
    for limit in (0, 30, 10 ** 9):
        link = L.TieredLinkage(listed, [target], ["p", "q", "MD/DO"], name_pairs=limit)
        first = link.tier(["state", "tel"], None)
        found.append(rows(link.tier([], link.tier(["practitioner_type"], first))))
        assert bool(link.crowded) == (limit < 10 ** 9)
    assert found[0] == found[1] == found[2] and len(found[0]) > 5


def test_an_id_with_many_names_and_places_stays_small(spark):
    """20 spellings and 200 places of one id would combine to 4,000 rows for
    each attribute pair; narrowed, no step holds more than the list's keys."""
    names = spark.createDataFrame([(1, f"S{i}") for i in range(20)], "npi int, name string")
    attrs = {a: spark.createDataFrame([(1, f"{a}{i}") for i in range(200)], f"npi int, {a} string")
             for a in ("state", "zip5")}
    within = spark.createDataFrame([(f"S{i}", "state7", f"zip5{i}") for i in range(5)],
                                   "name string, state string, zip5 string")
    source = L.Source("npi", names, attrs)
    assert L.conform(source, ["state"]).count() == 4000
    assert L.conform(source, ["state"], within=within).count() == 5
    assert L.conform(source, ["state", "zip5"], within=within).count() == 5


def test_stored_crosswalk_is_not_moved(spark):
    from rosterlake.operators.quality import AuditError
    from rosterlake.sources import crosswalk as C
    pairs = spark.range(500).select(F.col("id").alias("samhsa_id"), (F.col("id") + 1000).alias("npi"))
    table = f"crosswalk_test_{random.randint(0, 10 ** 9)}"
    C.store_crosswalk(pairs, table, buckets=8)
    stored = C.read_crosswalk(spark, table, check=True)
    people = spark.range(1000, 1400).select(F.col("id").alias("npi"))
    out = C.attach_crosswalk(people, stored)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 400 and plan.count("Exchange ") == 1 and "Bucketed: true" in plan
    both = C.read_crosswalk(spark, table).withColumnRenamed("samhsa_id", "other")
    plan = C.attach_crosswalk(both, stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 0
    with pytest.raises(AuditError):
        C.store_crosswalk(pairs.unionByName(pairs.selectExpr("samhsa_id + 1 AS samhsa_id", "npi")), table)
    spark.sql(f"DROP TABLE {table}")


def test_names_are_cleaned_in_few_exchanges(spark):
    part = lambda c, v: spark.createDataFrame([(1, v), (2, v + "?")], f"npi int, {c} string")
    legal = {p: part(p, "A") for p in N.PARTS}
    other = {p: part(f"{p}oth", "B") for p in N.PARTS}
    plan = N.clean_full_names(N.full_names(legal, other))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 15


def test_conflicting_middle_names(spark):
    cases = spark.createDataFrame([(1, "ann", "q.", "lee"), (2, "Ann", "Quinn", "Lee"), (3, "Ann", None, "Lee")],
                                  "c int, f string, m string, l string")
    names = spark.createDataFrame([(11, "ANN", "Z", "LEE"), (12, "ANN", "QUINN", "LEE"), (13, "ANN", "", "LEE")],
                                  "npi int, pfname string, pmname string, plname string")
    assert rows(L.death_matches(cases, names, "c", "f", "m", "l")) == [
        (1, 12), (1, 13), (2, 11), (2, 12), (2, 13), (3, 11), (3, 12), (3, 13)]


def test_conflict_in_any_shared_name_ends_a_pair(spark):
    cases = spark.createDataFrame([(1, "Ann", "Q", "Lee"), (1, "Ann", "Q", "Roe"), (2, None, "Q", "Lee"), (3, "Ann", "", "Lee")],
                                  "c int, f string, m string, l string")
    names = spark.createDataFrame([(11, "ANN", "Q", "LEE"), (11, "ANN", "Z", "ROE"), (12, "ANN", None, "LEE"), (12, "ANN", None, "LEE")],
                                  "npi int, pfname string, pmname string, plname string")
    assert rows(L.death_matches(cases, names, "c", "f", "m", "l")) == [(1, 12), (3, 11), (3, 12)]


@pytest.mark.parametrize("people", [1, 100])
def test_conflicts_are_settled_between_sets_of_names(spark, people):
    """As many pairs of classes with one person per name as with hundreds."""
    middles = ["", "A", "B", "ANN", "BETH"]
    made = spark.range(people * 5).select(F.col("id").alias("npi"), F.lit("ANN").alias("pfname"), F.lit("LEE").alias("plname"),
                                          F.element_at(F.lit(middles), (F.col("id") % 5 + 1).cast("int")).alias("middle"))
    a, b = L.name_classes(made, "npi"), L.name_classes(made, "npi")
    pairs = L.agreeing_classes(a, b)
    assert pairs.count() == 25 - 4
    cases = made.select(F.col("npi").alias("c"), F.col("pfname").alias("f"), F.col("middle").alias("m"), F.col("plname").alias("l"))
    found = L.death_matches(cases, made.withColumnRenamed("middle", "pmname"), "c", "f", "m", "l")
    assert found.count() == 21 * people * people


# ------------------------------------------------------------------- dates

@pytest.mark.parametrize("name,want", [
    ("Physician_Compare_2014-03-01.csv", date(2014, 3, 1)), ("National_March_2015.csv", date(2015, 3, 1)),
    ("National_Dec_2016.csv", date(2016, 12, 1)), ("file_7_2017.csv", date(2017, 7, 1)),
    ("two_2014_2015_June.csv", None), ("nothing.csv", None)])
def test_detect_date(spark, name, want):
    df = spark.createDataFrame([(name,)], "p string")
    assert df.select(D.detect_date("p")).first()[0] == want


def test_elapsed_dates(spark):
    import datetime as dt
    df = spark.createDataFrame([(52, 2015, 1_000)], "n int, y int, ms long")
    r = df.select(D.elapsed_to_timestamp("n", "%tw"), D.elapsed_to_timestamp("n", "td"), D.elapsed_to_timestamp("n", "tm"),
                  D.elapsed_to_timestamp("n", "tq"), D.elapsed_to_timestamp("n", "th"), D.elapsed_to_timestamp("y", "ty"),
                  D.elapsed_to_timestamp("ms", "tc"), D.elapsed_to_timestamp(-F.col("n"), "tm")).first()
    assert [x.date() for x in r] == [date(1961, 1, 1), date(1960, 2, 22), date(1964, 5, 1), date(1973, 1, 1),
                                     date(1986, 1, 1), date(2015, 1, 1), date(1960, 1, 1), date(1955, 9, 1)]
    assert r[6] == dt.datetime(1960, 1, 1, 0, 0, 1)
    with pytest.raises(ValueError):
        D.elapsed_to_timestamp("n", "tx")


# --------------------------------------------------- the chain moves rows once

def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda: spark.conf.set("spark.sql.adaptive.enabled", "false")
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_distinct_rows_move_by_person_only(spark):
    df = spark.createDataFrame([(1, date(2014, 1, 1), "O", 7, 5, "MA", "1", "2")] * 2 + [(1, None, None, None, None, None, None, None)],
                               "npi int, date date, org_name string, group_id int, group_size int, state string, zip string, phone string")
    out = P._passes_beside(df.distinct(), F.lit(False))
    assert _physical(out).count("Exchange hashpartitioning") == 1 and out.count() == 2
    # many distinct rows make a person large, many copies do not
    many = spark.range(40_000).select((F.col("id") % 2).alias("npi"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    assert rows(P._large_persons(many, 1000)) == [(0,)] and rows(P._large_persons(many, 0)) == [(0,), (1,)]


def test_all_groups_against_the_passes(spark, no_broadcast):
    rnd = random.Random(11)
    quarters = [date(2014, 1, 1), date(2014, 4, 1), date(2014, 7, 1), None]
    places = [(s, z, p) for s in ("S", "T", None) for z in ("1", None) for p in ("5", "6", None)]
    inferred = [(*rnd.choice(places), rnd.choice([7, 8, None]), rnd.choice([90, 91]), rnd.choice([1, 2, 3, 4, None]), rnd.choice(quarters))
                for _ in range(90)]
    located = [(rnd.choice([1, 2, 3, 4, 5, None]), rnd.choice(quarters), *rnd.choice(places)) for _ in range(70)]
    back = [("2014-07-01", "2014-04-01")]    # some copies are there already
    dated = {r for r in inferred if r[6]}    # a row without a date has no quarter to stand in
    base = dated | {(*r[:6], date(2014, 4, 1)) for r in dated if r[6] == date(2014, 7, 1)}
    called = [r for r in base if None not in r[:3]]

    def only(values):
        values = {v for v in values if v is not None}
        return values.pop() if len(values) == 1 else None

    loc = set(located)
    hits = set()
    for npi, q, *place in loc:
        if place[2] is not None:
            at = [r for r in called if [*r[:3], r[6]] == [*place, q]]
            own = [r for r in at if r[5] == npi]
            found = [{only(r[c] for r in some) for some in (at, own)} - {None} for c in (3, 4)]
            if any(found):
                hits |= {(*place, g, m, npi, q) for g in found[0] or [None] for m in found[1] or [None]}
    grown, ids = base | hits, {}
    for npi, q, *place in sorted(loc, key=lambda r: [(v is not None, v) for v in (r[1], *r[2:])]):
        ids.setdefault((q, *place), S.ID_BY_REGISTRY_PLACE + len(ids))
    want = [(*r, ids[(r[6], *r[:3])] if r[2] is not None and (r[5], r[6], *r[:3]) in loc else None) for r in grown]
    met = {(r[5], r[6], *r[:3]) for r in grown if r[2] is not None}
    want += [(*r[2:], None, None, r[0], r[1], ids[r[1:]]) for r in loc if r not in met]

    args = (spark.createDataFrame(inferred, "state string, zip string, phone string, group_id long, my_group_id long, npi long, date date"),
            spark.createDataFrame(located, "npi long, quarter date, plocstatename string, ploczip string, ploctel string"), back)
    out, _, _, dates = P.infer_all_groups(*args)
    names = ["state", "zip", "phone", "group_id", "my_group_id", "npi", "quarter", "my_group_id_npi"]
    assert out.columns == names
    assert rows(out) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert rows(dates) == rows(out.groupBy("npi").agg(F.min("quarter"), F.max("quarter")))
    no_broadcast()    # the listed and the registry's rows move once each for both joins
    assert _physical(P.infer_all_groups(*args)[0]).count("ReusedExchange") == 2


def test_rows_meet_roles_in_one_move(spark, no_broadcast, monkeypatch):
    q = date(2015, 1, 1)
    people = spark.createDataFrame([(1, q, 7, 8, None), (1, q, 7, 9, None), (2, q, 7, 8, 5), (2, None, 7, None, 5), (3, q, 7, 8, 5), (None, q, 7, 8, 5)],
                                   "npi long, quarter date, group_id int, my_group_id long, my_group_id_npi long")
    types = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 0, 1), (None, 1, 1)], "`npi` long, `MD/DO` int, `NP` int")
    plans, cut = [], P.cut
    monkeypatch.setattr(P, "cut", lambda d: plans.append(_physical(d)) or cut(d))
    got = P.role_counts(people, types)
    assert rows(got.where("npi = 2"), "quarter", "MDDO_gppid", "NP_gppid", "MDDO_mgi", "NP_mgi", "MDDO_mginpi", "NP_mginpi") == [
        (None, 0, 1, None, None, 0, 1), (q, 2, 2, 2, 2, 0, 1)]
    assert rows(got.where("my_group_id = 9"), "npi", "MDDO_mgi", "NP_mgi", "MDDO_mginpi") == [(1, 2, 1, None)]
    # rows and roles by person, the roles' sums and the counts: persons are not dealt again
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning") == 4


def test_urban_classes_of_zips(spark):
    q = date(2015, 1, 1)
    seen = spark.createDataFrame([(1, q, "S", "123450001"), (1, q, "S", "12399"), (2, q, "S", "12349"), (3, q, "S", "55555"), (3, q, "S", None),
                                  (4, q, "S", "1234"), (5, q, "S", "77777"), (6, q, None, "12345"), (1, None, "S", "12345")],
                                 "npi long, quarter date, state string, zip string")
    urban = spark.createDataFrame([("12345", 1), ("12346", 2), ("12399", 6), ("55555", 9), ("55556", 3), ("77778", None)], "ZCTA5 string, NCHSUR2013 int")
    final = seen.select("npi", "quarter", "state").distinct().withColumn("x", F.col("npi") * 2)
    out = P.urban_classes(seen, final, urban)
    names = [f"NCHSUR2013_{c}" for c in range(1, 7)]
    assert out.columns == [*final.columns, *names] and out.count() == 7
    got = {(r.npi, r.quarter): [c for c in range(1, 7) if r[f"NCHSUR2013_{c}"]] for r in out.collect()}
    # a class that has no column is found all the same, so no 4-digit ZIP is tried
    assert got == {(1, q): [1, 6], (2, q): [1, 2], (3, q): [], (4, q): [1, 2], (5, q): [], (6, q): [], (1, None): []}
    assert "RepartitionByExpression" not in _physical(out) and "LeftAnti" not in _physical(out)
    short = P.urban_classes(seen, final, urban, four_digit=False)
    assert rows(short.where("npi = 2"), *names) == [(0,) * 6]


def test_written_tables_leave_no_shuffle_files(spark):
    import time

    from rosterlake.session import CLEANUP, cut

    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {f for f in found.split() if f.endswith(".data") and "shuffle_" in f}

    before, setting = shuffled(), spark.conf.get(CLEANUP, None)
    table = cut(spark.range(2000).groupBy((F.col("id") % 500).alias("k")).count())
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and table.count() == 500
    assert spark.conf.get(CLEANUP, None) == setting
    spark.range(2000).groupBy((F.col("id") % 500).alias("k")).count().write.format("noop").mode("overwrite").save()
    assert shuffled() - before    # so the above is seen at all


def test_specialties_are_narrowed_to_the_panel_first(spark):
    cols = ["primary_specialty", *[f"secondary_specialty_{i}" for i in range(1, 5)]]
    listed = spark.createDataFrame([(1, "PREVENTATIVE MEDICINE", " ", "SUB", None, None), (1, "PREVENTIVE MEDICINE", "SUB", None, " ", None),
                                    (2, "SUB", None, None, None, None), (3, None, " ", None, None, None), (None, "SUB", None, None, None, None)],
                                   "npi int, " + ", ".join(f"{c} string" for c in cols))
    codes = spark.createDataFrame([(1, "T1"), (1, "T1"), (2, "T2"), (3, "T2"), (None, "T1")], "npi int, ptaxcode string")
    taxonomy = spark.createDataFrame([("T1", "Sub", "Adult -"), ("T2", "General Practice", "General Practice")],
                                     "TaxonomyCode string, Classification string, Specialization string")
    out = P.long_specialties(listed.distinct(), codes, taxonomy, spark.createDataFrame([(1,), (1,), (3,)], "npi int"))
    # two spellings are put right after copies are left out, so both stay
    assert rows(out, "npi", "spec") == [(1, "ADULT"), (1, "PREVENTIVE MEDICINE"), (1, "PREVENTIVE MEDICINE"), (1, "SUB")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("LeftSemi") and plan.count("LeftSemi") == 2
    # the distinct of all rows, which changes no set, is not run
    assert plan.count("Aggregate [") == 2
