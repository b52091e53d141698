import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import impute as I
from rosterlake.operators import joins as J
from rosterlake.operators import quality as Q
from rosterlake.operators import reshape as R
from rosterlake.operators import rows as W
from rosterlake.plans import practices as P
from tests.conftest import rows


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# ------------------------------------------------------------------- joins

@pytest.fixture
def sides(spark):
    left = frame(spark, [(1, "a", 10), (1, None, 11), (2, "b", 12), (None, None, 13)],
                 "k long, t string, x int")
    right = frame(spark, [(1, "a", 20), (1, None, 21), (None, None, 22), (3, "c", 23)],
                  "k long, t string, y int")
    return left, right


def test_null_keys_match(sides):
    out = J.natural_join(*sides)
    assert rows(out, "k", "t", "x", "y") == [(None, None, 13, 22), (1, None, 11, 21), (1, "a", 10, 20)]


def test_outer_keeps_both_sides_and_one_key_column(sides):
    out = J.natural_join(*sides, "outer")
    assert out.columns == ["k", "t", "x", "y"]
    assert out.count() == 5
    assert (3, "c", None, 23) in rows(out)


def test_right_join_takes_right_keys(sides):
    assert {r.k for r in J.natural_join(*sides, "right").collect()} == {1, None, 3}


@pytest.mark.parametrize("spread", [True, False])
def test_semi_and_anti_are_complements(sides, spread):
    left, right = sides
    a = rows(J.semi_join(left, right, spread=spread))
    b = rows(J.anti_join(left, right, spread=spread))
    assert a == [(None, None, 13), (1, None, 11), (1, "a", 10)] and b == [(2, "b", 12)]


def test_no_shared_columns_is_an_error(spark):
    with pytest.raises(ValueError):
        J.natural_join(frame(spark, [(1,)], "a int"), frame(spark, [(1,)], "b int"))


def test_clashing_columns_are_an_error(spark):
    a = frame(spark, [(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        J.natural_join(a, a, on=["k"])


def test_provenance(sides):
    out = J.provenance_join(*sides)
    assert sorted(r._merge for r in out.collect()) == ["both"] * 3 + ["left_only", "right_only"]


def test_hot_key_is_split_over_tasks(spark):
    old = {k: spark.conf.get(k, None) for k in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("50KB", "100KB", "2", "-1", "-1")):
            spark.conf.set(k, v)
        df = spark.range(0, 400000, 1, 12).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
            F.xxhash64("id").alias("v"))
        out = J.with_group_stats(df, ["k"], n=F.count(F.lit(1)))
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert {r.n for r in got if r.k == 7} == {133335} and len(got) == 400000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_nearest_month_keeps_ties(spark):
    t = frame(spark, [(1, date(2015, 3, 20))], "npi long, d date")
    p = frame(spark, [(1, date(2015, 1, 1), "a"), (1, date(2015, 5, 1), "b"), (1, date(2014, 1, 1), "c")],
              "npi long, month date, v string")
    out = J.nearest_month(t, p, "npi", "d", "month")
    assert rows(out, "v", "gap_days") == [("a", 59)]
    p = frame(spark, [(1, date(2015, 2, 1), "a"), (1, date(2015, 3, 29), "x"), (1, date(2015, 2, 1), "b")],
              "npi long, month date, v string")
    assert rows(J.nearest_month(t, p, "npi", "d", "month"), "v") == [("a",), ("b",), ("x",)]


def test_copresent_counts_against_all_pairs(spark):
    rnd = random.Random(5)
    data = {(rnd.randint(0, 30), rnd.randint(0, 12), rnd.randint(0, 2)) for _ in range(260)}
    role = {p: (p % 2 == 0, p % 3 == 0) for p in range(31)}
    df = frame(spark, [(p, f"L{g}", q, *role[p]) for p, g, q in data],
               "p int, place string, q int, md boolean, np boolean")
    want = {}
    for p, g, q in data:
        if role[p][0]:
            want.setdefault((p, q), set()).update(
                o for o, g2, q2 in data if g2 == g and q2 == q and role[o][1])
    got = {(r.p, r.q): r.n_others for r in J.count_copresent(
        df, "p", ["place"], ["q"], F.col("md"), F.col("np")).collect()}
    assert got == {k: len(v) for k, v in want.items()}


def test_copresent_one_place_of_many_sets(spark):
    """5,000 people with a set of places each meet 5,000 others at one hot
    place: the rows between stay as many as the places of the sets."""
    n = 5000
    rows_ = [(i, 1, "hot") for i in range(2 * n)] + [(i, 1, f"own{i}") for i in range(2 * n)]
    df = frame(spark, rows_, "p int, q int, a string").withColumn("md", F.col("p") < n)
    mine, places = J._place_sets(df.where("md").select("p", "q", "a"), "p", ["q"], ["a"])
    maps = J.place_bitmaps(df.where("NOT md").select("p", "q", "a"), "p", ["q"], ["a"])
    met = J.join_group_stats(places, maps, ["q", "a"], how="inner")
    assert places.count() == 2 * n and met.count() <= n * 2
    out = J.count_copresent(df, "p", ["a"], ["q"], F.col("md"), ~F.col("md"))
    assert out.count() == n and {r[0] for r in out.select("n_others").distinct().collect()} == {n}


def test_copresent_hot_and_null_places(spark):
    # everyone is at the hot place or at none; two-part places differ in which part is null
    data = [(p, "hot", None, p % 2 == 0) for p in range(400)]
    data += [(p, None, None, p % 2 == 0) for p in range(300, 600)]
    data += [(700, "a", None, True), (701, None, "a", False), (702, "a", None, False)]
    df = frame(spark, [(p, a, b, 1, m, not m) for p, a, b, m in data],
               "p int, a string, b string, q int, md boolean, np boolean")
    out = J.count_copresent(df, "p", ["a", "b"], ["q"], F.col("md"), F.col("np"))
    got = {r.p: r.n_others for r in out.collect()}
    want = {p: 200 if p < 300 else 300 if p < 400 else 150 for p in range(0, 600, 2)}
    assert got == {**want, 700: 1}


def test_copresent_few_and_crowded_places_against_all_pairs(spark):
    """Sets mix crowded places, places of a few, repeated and null ones; a place
    of a few makes no bitmap."""
    rnd = random.Random(11)
    data = [(rnd.randint(0, 250), rnd.choice(["hot", "warm", None, *[f"L{i}" for i in range(60)]]),
             rnd.randint(0, 1)) for _ in range(1500)]
    df = frame(spark, data, "p int, a string, q int").withColumn("md", F.col("p") % 2 == 0)
    want = {(p, q): {p3 for p2, a2, q2 in data if (p2, q2) == (p, q)
                     for p3, a3, q3 in data if (a3, q3) == (a2, q2) and p3 % 2}
            for p, _, q in data if p % 2 == 0}
    for few in (0, 3, 64):
        out = J.count_copresent(df, "p", ["a"], ["q"], F.col("md"), ~F.col("md"), few=few)
        assert {(r.p, r.q): r.n_others for r in out.collect()} == {k: len(v) for k, v in want.items()}


def test_copresent_makes_no_bitmap_where_few_meet(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(J, "_bitmaps", lambda rows, *a, real=J._bitmaps: made.append(real(rows, *a)) or made[-1])
    df = spark.range(600).select((F.col("id") % 200).alias("p"), (F.col("id") % 120).alias("a"),
                                 F.lit(1).alias("q")).withColumn("md", F.col("p") % 2 == 0)
    assert J.count_copresent(df, "p", ["a"], ["q"], F.col("md"), ~F.col("md")).count() == 100
    assert made[0].count() == 0


def test_prefix_fallback(spark):
    df = frame(spark, [(1, "021390001"), (2, "02138"), (3, "99999")], "i int, zip string")
    dim = frame(spark, [("02139", 1), ("02137", 2)], "z string, u int")
    assert rows(J.prefix_fallback(df, dim, "zip", "z", "u"), "i", "u") == [(1, 1), (2, 1), (2, 2)]


# -------------------------------------------------------------------- rows

def test_unique_and_repeated_with_null_keys(spark):
    df = frame(spark, [(1, None, "a"), (1, None, "b"), (2, None, "c"), (None, "x", "d")],
               "k int, t string, v string")
    assert rows(W.only_unique(df, ["k", "t"]), "v") == [("c",), ("d",)]
    assert rows(W.only_repeated(df, ["k", "t"]), "v") == [("a",), ("b",)]


def test_last_non_null_decides_per_column(spark):
    df = frame(spark, [(1, 1, "a", None), (1, 2, None, "y"), (1, 3, None, None), (None, 1, "z", "z")],
               "k int, o int, a string, b string")
    assert rows(W.last_non_null(df, ["k"], ["o"], ["a", "b"])) == [(1, "a", "y")]


def test_last_non_null_leaves_out_what_only_repeats_rows(spark):
    df = frame(spark, [(1, 1, "a"), (1, 1, "a"), (1, 2, None)], "k int, o int, a string")
    more = frame(spark, [(1, "x"), (1, "y")], "k int, b string")
    first = W.last_non_null(df.distinct().join(more, "k", "left"), ["k"], ["o"], ["a"])
    assert rows(first) == [(1, "a")]
    assert "Join" not in first._jdf.queryExecution().optimizedPlan().toString()


def test_surrogate_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    got = [tuple(r) for r in W.surrogate_id(df, ["v"], "i", 100).collect()]
    assert all(i == v + 100 for v, i in got) and len(got) == 5000


def test_sequence_of_a_hot_key_over_many_slices(spark):
    df = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    got = W.sequence_in_group(df, ["k"], ["o"])
    hot = [(r.o, r.seq) for r in got.where("k = 1").collect()]
    assert [s for _, s in sorted(hot)] == list(range(1, len(hot) + 1)) and len(hot) == 4000
    assert got.where("k <> 1").agg(F.max("seq")).first()[0] == 1


def test_quantile_bins_match_linear_interpolation(spark):
    import numpy as np
    rnd = random.Random(3)
    vals = [rnd.randint(0, 400) / 4 for _ in range(500)]
    df = frame(spark, [(v,) for v in vals], "v double")
    edges = W.quantile_edges(df, "v", 20)
    assert np.allclose(edges, np.quantile(vals, [i / 20 for i in range(21)]))
    out = W.quantile_bins(df, "v", 4, "b")
    assert out.where("v > b_hi or (v <= b_lo and b > 1)").count() == 0


def test_quantile_bins_refuse_repeated_edges(spark):
    with pytest.raises(ValueError):
        W.quantile_bins(frame(spark, [(1.0,)] * 5, "v double"), "v", 4, "b")


def test_modes_keep_ties(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (2, "c"), (2, "c"), (2, "d")], "k int, v string")
    assert rows(W.modes(df, ["k"], "v"), "k", "v") == [(1, "a"), (1, "b"), (2, "c")]
    assert rows(W.modes(df, ["k"], "v", 1), "k", "v") == [(2, "c")]


# ------------------------------------------------------------------ impute

def _brute_fill(data, ids, targets):
    """Column by column on plain dictionaries."""
    data = [dict(r) for r in data]
    for t in targets:
        seen = {}
        for r in data:
            if r[t] is not None and all(r[i] is not None for i in ids):
                seen.setdefault(tuple(r[i] for i in ids), set()).add(r[t])
        for r in data:
            vals = seen.get(tuple(r[i] for i in ids))
            if r[t] is None and vals and len(vals) == 1:
                r[t] = next(iter(vals))
    return data


def test_fills_agree_with_brute_force(spark):
    rnd = random.Random(11)
    data = [{"a": rnd.choice([1, 2, 3, None]), "b": rnd.choice(["x", "y", None]),
             "s": rnd.choice(["p", "q", None, None]), "u": rnd.choice([5, None, None])}
            for _ in range(60)]
    df = frame(spark, [(r["a"], r["b"], r["s"], r["u"]) for r in data], "a int, b string, s string, u int")
    want = sorted({(r["a"], r["b"], r["s"], r["u"]) for r in _brute_fill(data, ["a", "b"], ["s", "u"])},
                  key=str)
    assert sorted({tuple(r) for r in I.batch_fill(df, ["a", "b"], ["s", "u"]).collect()}, key=str) == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_only_rows_with_a_blank_meet_in_the_join(spark, seed):
    rnd = random.Random(seed)
    pick = lambda xs: rnd.choice([None, *xs])
    df = frame(spark, [(pick("ab"), pick("xy"), pick("st"), pick([1, 2])) for _ in range(120)],
               "a string, b string, s string, u int")
    for blank_ids in ([], ["b"]):
        one, two = (I.batch_fill(df, ["a", "b"], ["s", "u"], blank_ids, distinct=False, split=f) for f in (False, True))
        assert rows(one) == rows(two)
    lookup = I.consistent_tuple(df, ["a", "b"], ["s", "u"])
    one, two = (I.fill_from(df, lookup, ["a", "b"], split=f) for f in (False, True))
    assert rows(one) == rows(two)


def test_fill_never_touches_known_cells(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (1, None), (2, "c"), (2, None)], "k int, v string")
    out = I.batch_fill(df, ["k"], ["v"], distinct=False)
    assert rows(out) == [(1, None), (1, "a"), (1, "b"), (2, "c"), (2, "c")]


def test_blank_phone_may_identify_but_null_state_may_not(spark):
    df = frame(spark, [("MA", None, 7), ("MA", None, None), (None, "1", 8), (None, "1", None)],
               "state string, phone string, g int")
    out = I.batch_fill(df, ["state", "phone"], ["g"], blank_ids=["phone"], distinct=False)
    assert rows(out) == [(None, "1", None), (None, "1", 8), ("MA", None, 7), ("MA", None, 7)]


def test_tuple_fill_copies_whole_tuples(spark):
    df = frame(spark, [(1, None, "x", 5), (1, None, None, None), (2, "s", "x", None), (2, "s", None, 6)],
               "k int, t string, a string, b int")
    joined = I.fill_from(df, I.consistent_tuple(df, ["k", "t"], ["a", "b"]), ["k", "t"])
    assert rows(joined).count((1, None, "x", 5)) == 2


def test_purge_nulls(spark):
    df = frame(spark, [(1, None), (1, "a"), (2, None)], "k int, v string")
    assert rows(I.purge_nulls(df, "v", ["k"])) == [(1, "a"), (2, None)]


def test_purge_symbols_pass_by_pass(spark):
    rnd = random.Random(2)
    cols, symbols = ["x", "y"], ["?", "+"]
    data = sorted({(rnd.randint(0, 6), rnd.choice(["a", "a?", "a+", "?+"]), rnd.choice(["b", "b?", "b+"]))
                   for _ in range(40)})
    alive = list(data)
    for s in symbols:
        for i, _ in enumerate(cols, 1):
            good = {r[0] for r in alive if s not in r[i]}
            alive = [r for r in alive if s not in r[i] or r[0] not in good]
    df = frame(spark, data, "k int, x string, y string")
    assert rows(I.purge_symbols(df, cols, symbols, ["k"])) == sorted(alive, key=lambda r: tuple((True, str(v)) for v in r))


def test_zip_repair(spark):
    df = frame(spark, [(1, "MA", "2139"), (1, "NY", "2139"), (2, "NY", "501"), (2, "NY", "00501"),
                       (3, "NY", "501"), (4, "NJ", "70010001"), (5, "OH", None)],
               "group_id int, state string, zip string")
    assert [r[2] for r in rows(I.repair_zips(df), "group_id", "state", "zip")] == [
        "02139", "2139", "00501", "00501", "501", "070010001", None]


def test_phone_repair_needs_exactly_one_number(spark):
    d1, d2 = date(2015, 1, 1), date(2016, 1, 1)
    df = frame(spark, [(1, d1, None, "MA", "1", "6175550000.0"), (1, d2, None, "MA", "1", None),
                       (2, d1, 9, "MA", "1", "12345"), (3, d1, 9, "MA", "1", "6175551111"),
                       (4, d2, 8, "MA", "2", None), (4, d2, 8, "MA", "2", "6175551111"),
                       (5, d2, 8, "MA", "2", "6175552222"), (6, d2, 8, "MA", "2", None)],
               "npi int, date date, group_id int, state string, zip string, phone string")
    got = {}
    for r in I.repair_phones(df).collect():
        got.setdefault(r.npi, set()).add(r.phone)
    assert got[1] == {"6175550000"} and got[2] == {"6175551111"}
    assert got[4] == {"6175551111"} and got[6] == {None}


def test_backfill_copies_listed_periods(spark):
    df = frame(spark, [(1, date(2013, 4, 1)), (2, date(2014, 4, 1))], "k int, quarter date")
    out = I.backfill_periods(df, [("2013-04-01", "2013-01-01")])
    assert rows(out) == [(1, date(2013, 1, 1)), (1, date(2013, 4, 1)), (2, date(2014, 4, 1))]


# ---------------------------------------------------- reshape and quality

def test_slots_to_long(spark):
    df = frame(spark, [(1, "a", None, "c")], "npi int, s_1 string, s_2 string, s_12 string")
    assert rows(R.slots_to_long(df, ["npi"], ["s_1", "s_2", "s_12"], "v")) == [(1, 1, "a"), (1, 12, "c")]


def test_numbered_columns_refuse_to_drop(spark):
    df = frame(spark, [(1, "b"), (1, "a"), (1, "a")], "k int, v string")
    assert rows(R.numbered_columns(df, ["k"], ["v"], 2)) == [(1, "a", "b")]
    assert R.widest(df, ["k"], ["v"]) == 2
    with pytest.raises(Exception, match="more than 1"):
        R.numbered_columns(df, ["k"], ["v"], 1).collect()


def test_numbered_columns_gather_no_key(spark):
    """A hot id fails at its first number too many; values are never collected."""
    df = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("v"))
    wide = R.numbered_columns(df, ["k"], ["v"], 3)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and not [x for x in plan.split("collect_list(")[1:] if x.startswith("v")]
    with pytest.raises(Exception, match="more than 3"):
        wide.collect()
    some = frame(spark, [(1, None, 2), (1, None, 1), (2, "x", None)], "k int, v string, w int")
    assert rows(R.numbered_columns(some, ["k"], ["v", "w"], 2)) == [(1, None, 1, None, 2), (2, "x", None, None, None)]


def test_sketches_merge(spark):
    from rosterlake.operators import sketches as K
    df = spark.range(60000).selectExpr("id % 20000 AS npi", "id % 3 AS g", "id % 7 AS m")
    df = df.unionByName(frame(spark, [(None, 1, 1), (5, None, 1)], "npi long, g long, m long"))
    monthly = K.member_sketches(df, ["g", "m"])
    whole = {r.g: r.members_estimate for r in K.estimates(K.merged_sketches(monthly, ["g"])).collect()}
    exact = {r.g: r.n for r in df.where("g IS NOT NULL").groupBy("g").agg(F.count_distinct("npi").alias("n")).collect()}
    assert whole.keys() == exact.keys()
    assert all(abs(whole[g] - exact[g]) <= K.ERROR * exact[g] for g in exact)


def test_reorder():
    assert R.reorder(["a", "b", "c"], ["c"]) == ["c", "a", "b"]
    assert R.reorder(["a", "b", "c"], ["a"], "last") == ["b", "c", "a"]
    with pytest.raises(ValueError):
        R.reorder(["a"], ["a"], "middle")


def test_is_id(spark):
    df = frame(spark, [(1, "a"), (1, "b")], "k int, v string")
    assert Q.is_id(df, ["k", "v"]) and not Q.is_id(df, ["k"])
    with pytest.raises(Q.AuditError):
        Q.require_id(df, ["k"])
    with pytest.raises(Q.AuditError):
        Q.require_one_to_one(df, "v", "k")


def test_casts_are_audited(spark):
    good = frame(spark, [("1",), (None,)], "v string")
    assert Q.require_cast(good, {"v": "long"}).schema["v"].dataType.simpleString() == "bigint"
    for bad in ("x", "1.5"):
        with pytest.raises(Q.AuditError):
            Q.require_cast(frame(spark, [(bad,)], "v string"), {"v": "long"})


def test_named_blank_may_fail_others_may_not(spark):
    df = frame(spark, [("7",), (" ",)], "v string")
    assert rows(df.select(Q.integer_or_null("v", " ").alias("v"))) == [(None,), (7,)]
    with pytest.raises(Exception):
        frame(spark, [("x",)], "v string").select(Q.integer_or_null("v", " ")).collect()


def test_entity_scope(spark):
    e = frame(spark, [(1, 1), (2, 2)], "npi long, entity int")
    Q.require_entity(frame(spark, [(1,)], "npi long"), e)
    with pytest.raises(Q.AuditError):
        Q.require_entity(frame(spark, [(2,)], "npi long"), e)


def test_update_audit_tolerance(spark):
    old = frame(spark, [(i, date(2020, 1, 1), "a") for i in range(10)], "npi long, month date, v string")
    Q.require_update(old, old, ["npi", "month"])
    with pytest.raises(Q.AuditError):
        Q.require_update(old, old.where("npi > 0"), ["npi", "month"])
    Q.require_update(old, old.where("npi > 0"), ["npi", "month"], tolerance=0.5)


def test_date_rule(spark):
    d = date(2015, 1, 1)
    df = frame(spark, [(d, d, None), (d, None, d), (d, date(2014, 1, 1), None), (d, date(2014, 1, 1), d)],
               "d date, g date, c date")
    got = [r[0] for r in df.select(Q.exactly_one_date_rule("d", "g", "c")).collect()]
    assert got == [True, True, False, False]


def test_values_as_columns_are_bounded(spark):
    df = frame(spark, [(1, "ST. X"), (1, "ST. X"), (2, "A`B"), (3, None)], "npi long, spec string")
    assert list(R.value_columns(df, "spec")) == ["A`B", "ST. X"]
    with pytest.raises(ValueError):
        R.value_columns(df, "spec", most=1)
    people = frame(spark, [(1,), (2,), (3,), (4,), (4,)], "npi long")
    wide = P.specialty_indicators(df, people)
    assert wide.columns == ["npi", "A`B", "ST. X"]
    assert sorted(map(tuple, wide.collect())) == [(1, 0, 2), (2, 1, 0), (3, 0, 0), (4, 0, 0)]
    none = P.specialty_indicators(df.where("false"), people)
    assert none.columns == ["npi"] and none.count() == 4
