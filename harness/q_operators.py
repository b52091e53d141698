"""Scans, joins, aggregates, ordering, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness.registry import query
from rosterlake.functions import dates as D
from rosterlake.functions import text as X
from rosterlake.operators import joins as J
from rosterlake.operators import quality as Q
from rosterlake.operators import reshape as R
from rosterlake.operators import rows as W


@query("s1_semi_scan", ["panel", "ends"], """
    SELECT npi, month, value FROM panel WHERE npi IN (SELECT npi FROM ends)""")
def _(t):
    return J.semi_join(t.panel.select("npi", "month", "value"), t.ends.select("npi"),
                       on=["npi"], null_equal=False)


@query("s17_code_months", ["code_panel"], """
    SELECT npi, month FROM code_panel WHERE ptaxcode = '390200000X'""")
def _(t):
    from rosterlake.sources.panels import months_with_code
    return months_with_code(t.code_panel)


@query("s13_snapshot_dates", [], """
    WITH p AS (SELECT o_orderkey AS rid, CASE o_orderkey % 5
        WHEN 0 THEN 'snap_' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '.csv'
        WHEN 1 THEN 'National_File_' || strftime(o_orderdate, '%b') || '_20' || lpad(CAST(o_orderkey % 20 AS VARCHAR), 2, '0') || '.csv'
        WHEN 2 THEN 'snap_' || CAST(1 + o_orderkey % 12 AS VARCHAR) || '_2016.csv'
        WHEN 3 THEN 'snap_2014_2016_' || CAST(1 + o_orderkey % 12 AS VARCHAR) || '_.csv'
        ELSE 'nothing.csv' END AS path FROM orders),
    e AS (SELECT rid, path,
        try_cast(regexp_extract(path, '20[0-9]{2}-[0-9]{2}-[0-9]{2}') AS DATE) AS iso,
        list_distinct(regexp_extract_all(path, '20[0-9]?[0-9]?')) AS ys,
        regexp_extract(path, '_(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)_', 1) AS mn,
        regexp_extract(path, '_([0-9]{1,2})_', 1) AS mm FROM p)
    SELECT rid, CASE WHEN iso IS NOT NULL THEN iso
        WHEN len(ys) = 1 AND mn <> '' THEN make_date(CAST(ys[1] AS INT), CAST((strpos('JanFebMarAprMayJunJulAugSepOctNovDec', mn) + 2) / 3 AS INT), 1)
        WHEN len(ys) = 1 AND mm <> '' THEN make_date(CAST(ys[1] AS INT), CAST(mm AS INT), 1) END AS date
    FROM e""")
def _(t):
    k = F.col("o_orderkey")
    path = (F.when(k % 5 == 0, F.concat(F.lit("snap_"), F.to_date("o_orderdate").cast("string"), F.lit(".csv")))
            .when(k % 5 == 1, F.concat(F.lit("National_File_"), F.date_format("o_orderdate", "MMM"), F.lit("_20"),
                                       F.lpad((k % 20).cast("string"), 2, "0"), F.lit(".csv")))
            .when(k % 5 == 2, F.concat(F.lit("snap_"), (1 + k % 12).cast("string"), F.lit("_2016.csv")))
            .when(k % 5 == 3, F.concat(F.lit("snap_2014_2016_"), (1 + k % 12).cast("string"), F.lit("_.csv")))
            .otherwise(F.lit("nothing.csv")))
    return t.orders.select(k.alias("rid"), D.detect_date(path).alias("date"))


@query("p5_checked_cast", [], """
    SELECT 'o_orderstatus' AS "column", count_if(o_orderstatus IS NULL)::BIGINT AS nulls_before,
           count_if(try_cast(o_orderstatus AS BIGINT) IS NULL)::BIGINT AS nulls_after, CAST(0 AS BIGINT) AS rounded FROM orders
    UNION ALL
    SELECT 'priority', 0, count_if(try_cast(substr(o_orderpriority, 1, 1) AS BIGINT) IS NULL)::BIGINT, 0 FROM orders
    UNION ALL
    SELECT 'price', 0, 0, count_if(o_totalprice <> trunc(o_totalprice))::BIGINT FROM orders""")
def _(t):
    df = t.orders.select("o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("priority"),
                         F.col("o_totalprice").alias("price"))
    return Q.cast_audit(df, {"o_orderstatus": "long", "priority": "long", "price": "long"})


@query("p6_integers_or_null", ["panel"], """
    SELECT rid, try_cast(substr(value, 1, 1) AS BIGINT) AS first_digit, try_cast(value AS BIGINT) AS whole
    FROM panel""")
def _(t):
    df = t.panel.withColumn("d", F.substring("value", 1, 1))
    return df.select("rid", Q.integer_or_null("d").alias("first_digit"),
                     Q.integer_or_null("value").alias("whole"))


@query("p10_blank_rows", ["addresses"], """
    SELECT npi, month, plocline1, plocstatename FROM addresses
    WHERE plocline1 IS NULL AND plocline2 IS NULL AND ploctel IS NULL""")
def _(t):
    return (t.addresses.where(Q.all_blank(["plocline1", "plocline2", "ploctel"]))
            .select("npi", "month", "plocline1", "plocstatename"))


@query("p15_first_after_sort", ["panel"], """
    SELECT npi, month, rid, value, status FROM (SELECT *, row_number() OVER (
        PARTITION BY npi ORDER BY month, rid) AS rn FROM panel) WHERE rn = 1""")
def _(t):
    return W.first_row(t.panel, ["npi"], ["month", "rid"])


@query("p16_only_unique", ["panel"], """
    SELECT npi, month, rid, value, status FROM (SELECT *, count(*) OVER (
        PARTITION BY npi, value) AS n FROM panel) WHERE n = 1""")
def _(t):
    return W.only_unique(t.panel, ["npi", "value"])


@query("p17_only_repeated", ["panel"], """
    SELECT npi, month, rid, value, status FROM (SELECT *, count(*) OVER (
        PARTITION BY npi, value) AS n FROM panel) WHERE n > 1""")
def _(t):
    return W.only_repeated(t.panel, ["npi", "value"])


@query("p18_null_counts", ["addresses"], """
    SELECT npi, month, CAST((plocline1 IS NULL)::INT + (plocstatename IS NULL)::INT
        + (ploctel IS NULL)::INT AS INT) AS n_null FROM addresses
    WHERE (plocline1 IS NULL)::INT + (plocstatename IS NULL)::INT + (ploctel IS NULL)::INT >= 2""")
def _(t):
    n = Q.null_count(["plocline1", "plocstatename", "ploctel"])
    return t.addresses.select("npi", "month", n.alias("n_null")).where("n_null >= 2")


# ------------------------------------------------------------------- joins

_PAIR = """a AS (SELECT DISTINCT npi, value FROM panel WHERE month < DATE '1997-01-01'),
    b AS (SELECT npi, value, count(*) AS n FROM panel WHERE month >= DATE '1997-01-01' GROUP BY 1, 2)"""


def _pair(t):
    cut = F.lit("1997-01-01").cast("date")
    a = t.panel.where(F.col("month") < cut).select("npi", "value").distinct()
    b = (t.panel.where(F.col("month") >= cut).groupBy("npi", "value")
         .agg(F.count(F.lit(1)).alias("n")))
    return a, b


@query("j1_natural_nullsafe", ["panel"], f"""WITH {_PAIR}
    SELECT a.npi, a.value, n FROM a JOIN b ON a.npi = b.npi AND a.value IS NOT DISTINCT FROM b.value""")
def _(t):
    return J.natural_join(*_pair(t))


@query("j2_left", ["panel"], f"""WITH {_PAIR}
    SELECT a.npi, a.value, n FROM a LEFT JOIN b ON a.npi = b.npi AND a.value IS NOT DISTINCT FROM b.value""")
def _(t):
    return J.natural_join(*_pair(t), "left")


@query("j3_right", ["panel"], f"""WITH {_PAIR}
    SELECT b.npi, b.value, n FROM a RIGHT JOIN b ON a.npi = b.npi AND a.value IS NOT DISTINCT FROM b.value""")
def _(t):
    return J.natural_join(*_pair(t), "right")


@query("j4_outer", ["panel"], f"""WITH {_PAIR}
    SELECT coalesce(a.npi, b.npi) AS npi, coalesce(a.value, b.value) AS value, n
    FROM a FULL JOIN b ON a.npi = b.npi AND a.value IS NOT DISTINCT FROM b.value""")
def _(t):
    return J.natural_join(*_pair(t), "outer")


@query("j5_renamed_keys", ["ends"], """
    SELECT c_custkey, c_name, npideactdate FROM customer JOIN ends ON c_custkey = npi""")
def _(t):
    return J.renamed_key_join(t.customer.select("c_custkey", "c_name"), t.ends,
                              {"c_custkey": "npi"})


@query("j6_anti_nullsafe", ["panel"], f"""WITH {_PAIR}
    SELECT npi, value FROM a WHERE NOT EXISTS (SELECT 1 FROM b
        WHERE a.npi = b.npi AND a.value IS NOT DISTINCT FROM b.value)""")
def _(t):
    return J.anti_join(*_pair(t))


@query("j7_semi", ["panel"], f"""WITH {_PAIR}
    SELECT npi, value FROM a WHERE EXISTS (SELECT 1 FROM b
        WHERE a.npi = b.npi AND a.value IS NOT DISTINCT FROM b.value)""")
def _(t):
    return J.semi_join(*_pair(t))


@query("j8_provenance", ["panel"], f"""WITH {_PAIR}
    SELECT CASE WHEN a.npi IS NULL THEN 'right_only' WHEN b.npi IS NULL THEN 'left_only' ELSE 'both' END
        AS _merge, count(*) AS n
    FROM a FULL JOIN b ON a.npi = b.npi AND a.value IS NOT DISTINCT FROM b.value GROUP BY 1""")
def _(t):
    a, b = _pair(t)
    return J.provenance_join(a, b.drop("n")).groupBy("_merge").agg(F.count(F.lit(1)).alias("n"))


@query("j9_valid_time", ["panel", "ends"], """
    SELECT p.npi, month, rid, value FROM panel p LEFT JOIN ends e ON p.npi = e.npi
    WHERE npideactdate IS NULL OR month <= npideactdate""")
def _(t):
    return J.valid_until(t.panel.drop("status"), t.ends)


@query("j10_theta", ["deact_panel", "react_panel"], """
    WITH d AS (SELECT npi, max(npideactdate) AS npideactdate FROM deact_panel GROUP BY 1),
    r AS (SELECT npi, max(npireactdate) AS npireactdate FROM react_panel GROUP BY 1)
    SELECT d.npi, npideactdate, npireactdate FROM d JOIN r ON d.npi = r.npi AND npireactdate >= npideactdate""")
def _(t):
    from rosterlake.plans.registry import latest_date
    return J.at_or_after(latest_date(t.deact_panel, "npideactdate"),
                         latest_date(t.react_panel, "npireactdate"),
                         "npi", "npireactdate", "npideactdate")


@query("j11_nearest", ["panel", "waiver_dates"], """
    WITH x AS (SELECT w.npi, w.Date, p.month, p.rid, p.value,
        abs(p.month - CAST(date_trunc('month', w.Date) AS DATE)) AS gap
      FROM waiver_dates w JOIN panel p ON w.npi = p.npi),
    y AS (SELECT *, min(gap) OVER (PARTITION BY npi, Date) AS best FROM x)
    SELECT npi, Date, month, rid, value, CAST(gap AS INT) AS gap_days FROM y WHERE gap = best""")
def _(t):
    return J.nearest_month(t.waiver_dates, t.panel.drop("status"), "npi", "Date", "month")


@query("j12_multiway", ["panel", "ends", "entity"], """
    SELECT p.npi, month, rid, npideactdate, entity FROM panel p JOIN ends e ON p.npi = e.npi
    JOIN entity n ON p.npi = n.npi""")
def _(t):
    return J.natural_join_all([t.panel.select("npi", "month", "rid"), t.ends, t.entity])


@query("j14_colocated", ["members"], """
    SELECT m.npi, m.quarter, count(DISTINCT n.npi) AS n_others
    FROM members m LEFT JOIN members n ON m.quarter = n.quarter
      AND m.group_quarter_loc_id = n.group_quarter_loc_id AND n.NP = 1
    WHERE m.md_do = 1 GROUP BY 1, 2""")
def _(t):
    return J.count_copresent(t.members, "npi", ["group_quarter_loc_id"], ["quarter"],
                             F.col("md_do") == 1, F.col("NP") == 1)


@query("j17_prefix_fallback", ["group_rows", "urban"], """
    WITH r AS (SELECT DISTINCT npi, zip FROM group_rows),
    a AS (SELECT r.npi, r.zip, u.NCHSUR2013 FROM r JOIN (SELECT DISTINCT substr(ZCTA5, 1, 5) z, NCHSUR2013 FROM urban) u
        ON substr(r.zip, 1, 5) = u.z),
    b AS (SELECT r.npi, r.zip, u.NCHSUR2013 FROM r JOIN (SELECT DISTINCT substr(ZCTA5, 1, 4) z, NCHSUR2013 FROM urban) u
        ON substr(r.zip, 1, 4) = u.z
        WHERE substr(r.zip, 1, 5) NOT IN (SELECT substr(ZCTA5, 1, 5) FROM urban))
    SELECT * FROM a UNION ALL SELECT * FROM b""")
def _(t):
    return J.prefix_fallback(t.group_rows.select("npi", "zip").distinct(), t.urban, "zip",
                             "ZCTA5", "NCHSUR2013")


@query("j18_agreement", ["registry_types", "type_listed"], """
    WITH b AS (SELECT npi, max(CASE WHEN credential = 'MD' THEN 1 ELSE 0 END) AS md_do,
        max(CASE WHEN credential = 'NP' THEN 1 ELSE 0 END) AS NP FROM type_listed GROUP BY 1),
    u AS (SELECT npi, md_do, NP FROM registry_types UNION SELECT npi, md_do, NP FROM b)
    SELECT *, count(*) OVER (PARTITION BY npi) AS n_versions FROM u""")
def _(t):
    listed = R.indicators(t.type_listed, ["npi"], "credential", {"MD": "md_do", "NP": "NP"})
    return J.agreeing_rows(t.registry_types, listed, "npi")


# -------------------------------------------------------------- aggregates

@query("a1_spans", ["panel"], """
    SELECT npi, min(month) AS first_month, max(month) AS last_month, count(*) AS n FROM panel GROUP BY 1""")
def _(t):
    return t.panel.groupBy("npi").agg(F.min("month").alias("first_month"),
                                      F.max("month").alias("last_month"),
                                      F.count(F.lit(1)).alias("n"))


@query("a3_distinct_members", ["directory"], """
    SELECT group_id, date, count(DISTINCT npi) AS members FROM directory
    WHERE group_id IS NOT NULL GROUP BY 1, 2""")
def _(t):
    from rosterlake.plans.practices import members_per
    return members_per(t.directory, "group_id", "date", "members")


@query("a6_last_nonnull", ["panel"], """
    SELECT npi, arg_max(value, (month, rid)) FILTER (WHERE value IS NOT NULL) AS value,
           arg_max(status, (month, rid)) FILTER (WHERE status IS NOT NULL) AS status
    FROM panel GROUP BY 1""")
def _(t):
    return W.last_non_null(t.panel, ["npi"], ["month", "rid"], ["value", "status"])


@query("a7_row_of_max", ["panel"], """
    SELECT npi, month, rid, value, status FROM (SELECT *, row_number() OVER (
        PARTITION BY npi ORDER BY month DESC, rid DESC) AS rn FROM panel) WHERE rn = 1""")
def _(t):
    return W.first_row(t.panel, ["npi"], ["month", "rid"], last=True)


@query("a8_mode_ties", ["panel"], """
    WITH c AS (SELECT npi, value, count(*) AS n FROM panel GROUP BY 1, 2)
    SELECT npi, value, n FROM (SELECT *, max(n) OVER (PARTITION BY npi) AS m FROM c) WHERE n = m""")
def _(t):
    return W.modes(t.panel, ["npi"], "value")


@query("a9_mode_supported", ["panel"], """
    WITH c AS (SELECT npi, value, count(*) AS n FROM panel GROUP BY 1, 2)
    SELECT npi, value, n FROM (SELECT *, max(n) OVER (PARTITION BY npi) AS m FROM c) WHERE n = m AND n > 3""")
def _(t):
    return W.modes(t.panel, ["npi"], "value", min_count=3)


@query("a10_one_hot", ["panel"], """
    SELECT npi, max((status IS NOT DISTINCT FROM 'F')::INT) AS is_f, max((status IS NOT DISTINCT FROM 'O')::INT) AS is_o,
           max((status IS NOT DISTINCT FROM 'P')::INT) AS is_p FROM panel GROUP BY 1""")
def _(t):
    return R.indicators(t.panel, ["npi"], "status", {"F": "is_f", "O": "is_o", "P": "is_p"})


@query("a11_value_counts", ["panel"], """
    SELECT value, count(*) AS n FROM panel GROUP BY 1""")
def _(t):
    return t.panel.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


@query("a12_frequent", ["directory_people"], """
    SELECT npi, credential, primary_specialty FROM (SELECT *, count(*) OVER (PARTITION BY primary_specialty) AS n
        FROM directory_people) WHERE n > 500""")
def _(t):
    return W.frequent_values(t.directory_people, "primary_specialty", 500)


@query("a13_quantile_bins", [], """
    WITH q AS (SELECT quantile_cont(p_retailprice, [i / 20.0 FOR i IN range(21)]) AS e FROM part),
    u AS (SELECT unnest(range(21)) AS i, unnest(e) AS v FROM q),
    n AS (SELECT p_partkey, greatest(count(*) FILTER (WHERE v < p_retailprice), 1) AS b FROM part, u GROUP BY 1)
    SELECT p_partkey, CAST(b AS INT) AS bin, round(lo.v, 4) AS bin_lo, round(hi.v, 4) AS bin_hi
    FROM n JOIN u lo ON lo.i = b - 1 JOIN u hi ON hi.i = b""")
def _(t):
    out = W.quantile_bins(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", 20, "bin")
    return out.select("p_partkey", "bin", F.round("bin_lo", 4).alias("bin_lo"),
                      F.round("bin_hi", 4).alias("bin_hi"))


@query("a14_row_sums", [], """
    SELECT d.doc_id, CAST(quality + toxic AS INT) AS flags, (quality = 1 OR toxic = 1) AS any_flag
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def _(t):
    df = J.natural_join(t.labels, t.documents.select("doc_id"), on=["doc_id"], null_equal=False)
    return df.select("doc_id", (F.col("quality") + F.col("toxic")).alias("flags"),
                     ((F.col("quality") == 1) | (F.col("toxic") == 1)).alias("any_flag"))


@query("a15_censoring", ["claims_detail"], """
    SELECT Year, count(*) AS n_rows, count(*) FILTER (WHERE total_claim_count IS NULL) AS n_null,
      count(*) FILTER (WHERE total_claim_count = 0) AS n_0, count(*) FILTER (WHERE total_claim_count = 10) AS n_10,
      count(*) FILTER (WHERE total_claim_count = 11) AS n_11, count(*) FILTER (WHERE total_claim_count = 12) AS n_12
    FROM claims_detail GROUP BY 1""")
def _(t):
    return Q.profile_counts(t.claims_detail, "total_claim_count", by=["Year"])


@query("a16_first_date_pivot", ["waivers", "crosswalk"], """
    SELECT npi, min(CASE WHEN WaiverType = 30 THEN Date END) AS date_30,
      min(CASE WHEN WaiverType = 100 THEN Date END) AS date_100,
      min(CASE WHEN WaiverType = 275 THEN Date END) AS date_275
    FROM waivers w JOIN crosswalk c ON w.samhsa_id = c.samhsa_id GROUP BY 1""")
def _(t):
    from rosterlake.plans.practices import waiver_dates
    return waiver_dates(t.waivers, t.crosswalk)


# -------------------------------------------------- numbering and ordering

@query("w1_sequence", ["panel"], """
    SELECT npi, month, rid, CAST(row_number() OVER (PARTITION BY npi ORDER BY month, rid) AS INT) AS seq
    FROM panel""")
def _(t):
    return W.sequence_in_group(t.panel.select("npi", "month", "rid"), ["npi"], ["month", "rid"])


@query("w2_priority", ["panel"], """
    SELECT npi, rid, value, CAST(row_number() OVER (PARTITION BY npi ORDER BY value DESC NULLS LAST, rid DESC)
        AS INT) AS priority FROM panel""")
def _(t):
    return W.sequence_in_group(t.panel.select("npi", "rid", "value"), ["npi"],
                               [F.desc("value"), F.desc("rid")], "priority")


@query("w4_first_last", ["panel"], """
    SELECT npi, arg_min(rid, (month, rid)) AS first_rid, arg_max(rid, (month, rid)) AS last_rid
    FROM panel GROUP BY 1""")
def _(t):
    packed = F.struct("month", "rid")
    return (t.panel.groupBy("npi").agg(F.min(packed).alias("a"), F.max(packed).alias("b"))
            .select("npi", F.col("a.rid").alias("first_rid"), F.col("b.rid").alias("last_rid")))


@query("w5_rows_at_minimum", ["panel"], """
    SELECT npi, month, rid FROM (SELECT *, min(month) OVER (PARTITION BY npi) AS m FROM panel) WHERE month = m""")
def _(t):
    return W.rows_at_extreme(t.panel.select("npi", "month", "rid"), ["npi"], "month", largest=False)


@query("o2_latest_n", ["panel"], """
    SELECT npi, month, rid, value FROM panel ORDER BY month DESC, rid DESC LIMIT 60""")
def _(t):
    return t.panel.drop("status").orderBy(F.desc("month"), F.desc("rid")).limit(60)


@query("k1_surrogate", ["directory"], """
    SELECT state, zip, phone, row_number() OVER (ORDER BY state NULLS FIRST, zip NULLS FIRST, phone NULLS FIRST)
        - 1 + 100000000000 AS place_id
    FROM (SELECT DISTINCT state, zip, phone FROM directory)""")
def _(t):
    return W.surrogate_id(t.directory.select("state", "zip", "phone").distinct(),
                          ["state", "zip", "phone"], "place_id", 100_000_000_000)


# --------------------------------------------------------- set operations

@query("u1_union_by_name", ["licence_state", "licence_number"], """
    SELECT npi, month, seq, PLICSTATE, NULL AS PLICNUM FROM licence_state
    UNION ALL SELECT npi, month, seq, NULL, PLICNUM FROM licence_number""")
def _(t):
    return t.licence_state.unionByName(t.licence_number, allowMissingColumns=True)


@query("u3_common_rows", ["panel"], """
    WITH a AS (SELECT npi, value, status FROM panel WHERE month < DATE '1998-01-01'),
    b AS (SELECT npi, value, status FROM panel WHERE month >= DATE '1998-01-01')
    SELECT a.* FROM a JOIN b ON a.npi = b.npi AND a.value IS NOT DISTINCT FROM b.value
      AND a.status IS NOT DISTINCT FROM b.status""")
def _(t):
    from rosterlake.plans.claims import common_rows
    p, at = t.panel.select("npi", "value", "status", "month"), F.lit("1998-01-01").cast("date")
    return common_rows(p.where(F.col("month") < at).drop("month"),
                       p.where(F.col("month") >= at).drop("month"))


@query("u5_replace_tail", ["panel"], """
    WITH n AS (SELECT npi, month, rid, 'new' AS value FROM panel WHERE month >= DATE '2000-06-01' AND rid % 2 = 0)
    SELECT npi, month, rid, value FROM panel WHERE month < (SELECT min(month) FROM n)
    UNION ALL SELECT * FROM n""")
def _(t):
    old = t.panel.drop("status")
    new = (old.where((F.col("month") >= F.lit("2000-06-01").cast("date")) & (F.col("rid") % 2 == 0))
           .withColumn("value", F.lit("new")))
    return W.replace_tail(old, new)


# ---------------------------------------------------------------- reshape

@query("r1_wide_to_long", ["slots"], """
    SELECT npi, CAST(seq AS INT) AS seq, code FROM (
      SELECT npi, 1 AS seq, code_1 AS code FROM slots UNION ALL SELECT npi, 2, code_2 FROM slots
      UNION ALL SELECT npi, 3, code_3 FROM slots UNION ALL SELECT npi, 10, code_10 FROM slots)
    WHERE code IS NOT NULL""")
def _(t):
    return R.slots_to_long(t.slots, ["npi"], ["code_1", "code_2", "code_3", "code_10"], "code")


@query("r2_stack", ["slots"], """
    SELECT npi, slot, code FROM (
      SELECT npi, 'code_1' AS slot, code_1 AS code FROM slots UNION ALL SELECT npi, 'code_2', code_2 FROM slots
      UNION ALL SELECT npi, 'code_10', code_10 FROM slots) WHERE code IS NOT NULL""")
def _(t):
    return R.to_long(t.slots, ["npi"], ["code_1", "code_2", "code_10"], "slot", "code")


@query("r3_split_explode", [], """
    SELECT DISTINCT doc_id, trim(part) AS part FROM (
      SELECT doc_id, unnest(string_split(text, ',')) AS part FROM documents)""")
def _(t):
    df = t.documents.select("doc_id", F.col("text").alias("part"))
    return R.split_to_rows(df, "part", ",").distinct()


@query("r4_numbered_pivot", ["panel"], """
    WITH v AS (SELECT npi, value, row_number() OVER (PARTITION BY npi ORDER BY value) AS n FROM (
        SELECT DISTINCT npi, value FROM panel WHERE value IS NOT NULL))
    SELECT npi, max(CASE WHEN n = 1 THEN value END) AS value1, max(CASE WHEN n = 2 THEN value END) AS value2,
      max(CASE WHEN n = 3 THEN value END) AS value3, max(CASE WHEN n = 4 THEN value END) AS value4,
      max(CASE WHEN n = 5 THEN value END) AS value5 FROM v GROUP BY 1""")
def _(t):
    known = t.panel.where(F.col("value").isNotNull())
    return R.numbered_columns(known, ["npi"], ["value"], 5)


@query("r5_matrix_to_long", ["types"], """
    SELECT npi, 'md_do' AS kind FROM types WHERE md_do = 1
    UNION ALL SELECT npi, 'NP' FROM types WHERE NP = 1""")
def _(t):
    return R.indicators_to_long(t.types, ["npi"], ["md_do", "NP"], "kind")


@query("r7_coverage_matrix", ["panel"], """
    WITH w AS (SELECT month, max((status IS NOT DISTINCT FROM 'F')::INT) AS F, max((status IS NOT DISTINCT FROM 'O')::INT) AS O,
        max((status IS NOT DISTINCT FROM 'P')::INT) AS P FROM panel GROUP BY 1)
    SELECT month, F, O, P, F + O + P AS total, ((F + O + P) < 3)::INT AS incomplete FROM w""")
def _(t):
    return R.coverage(t.panel, ["month"], "status", ["F", "O", "P"], complete_at=3)


# ---------------------------------------------------------------- scalars

@query("f_text_cleaning", ["phone_panel"], """
    SELECT rid, upper(replace(replace(replace(replace(string_split(ploctel, '.')[1], '-', ''), '(', ''), ')', ''), ' ', '')) AS tel,
      '(' || substr(upper(replace(replace(replace(replace(string_split(ploctel, '.')[1], '-', ''), '(', ''), ')', ''), ' ', '')), 1, 3)
      || ') ' || substr(upper(replace(replace(replace(replace(string_split(ploctel, '.')[1], '-', ''), '(', ''), ')', ''), ' ', '')), 4, 3)
      || '-' || substr(upper(replace(replace(replace(replace(string_split(ploctel, '.')[1], '-', ''), '(', ''), ')', ''), ' ', '')), 7) AS shown
    FROM phone_panel""")
def _(t):
    tel = X.registry_phone("ploctel")
    return t.phone_panel.select("rid", tel.alias("tel"), X.display_phone(tel).alias("shown"))


@query("f_initials", ["listed_people"], r"""
    SELECT samhsa_id, regexp_replace(regexp_replace(NameFull, ' +', ' ', 'g'), '(.*\s[A-Z]?)(\.)(\s)', '\1\3', 'g') AS name,
      upper(replace(replace(NameFull, '.', ''), ' ', '')) AS flat FROM listed_people""")
def _(t):
    return t.listed_people.select(
        "samhsa_id", X.drop_inner_initial_period(X.collapse_spaces("NameFull")).alias("name"),
        X.credential_key("NameFull").alias("flat"))


@query("f16_quarter", [], """
    SELECT o_orderkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter,
      year(o_orderdate)::VARCHAR || 'Q' || quarter(o_orderdate)::VARCHAR AS label,
      CAST(date_trunc('month', o_orderdate) - INTERVAL 6 MONTH AS DATE) AS back FROM orders""")
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", D.quarter_start(d).alias("quarter"),
                           D.quarter_label(d).alias("label"),
                           F.add_months(D.month_start(d), -6).alias("back"))


@query("f18_date_gaps", ["panel", "ends"], """
    SELECT rid, CAST(abs(month - npideactdate) AS INT) AS days FROM panel p JOIN ends e ON p.npi = e.npi""")
def _(t):
    df = J.natural_join(t.panel, t.ends, on=["npi"], null_equal=False)
    return df.select("rid", F.abs(D.days_between("month", "npideactdate")).alias("days"))


@query("f20_elapsed_dates", [], """
    SELECT o_orderkey,
      CAST(DATE '1960-01-01' + CAST(n AS INT) AS DATE) AS td,
      CAST(DATE '1960-01-01' + INTERVAL 1 MONTH * n AS DATE) AS tm,
      CAST(DATE '1960-01-01' + INTERVAL 3 MONTH * n AS DATE) AS tq,
      CAST(DATE '1960-01-01' + INTERVAL 6 MONTH * n AS DATE) AS th,
      CAST(make_date(CAST(1960 + n // 52 AS INT), 1, 1) + CAST((n % 52) * 7 AS INT) AS DATE) AS tw,
      make_date(CAST(1900 + n % 100 AS INT), 1, 1) AS ty
    FROM (SELECT o_orderkey, o_custkey % 900 AS n FROM orders)""")
def _(t):
    n = F.col("o_custkey") % 900
    cols = {f: D.elapsed_to_timestamp(n, f).cast("date") for f in ("td", "tm", "tq", "th", "tw")}
    cols["ty"] = D.elapsed_to_timestamp(1900 + n % 100, "ty").cast("date")
    return t.orders.select("o_orderkey", *[c.alias(k) for k, c in cols.items()])


# ---------------------------------------------------------------- quality

@query("q1_duplicates", [], """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t):
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("q3_entity_scope", ["panel", "entity"], """
    SELECT DISTINCT p.npi FROM panel p JOIN entity e ON p.npi = e.npi WHERE entity <> 1""")
def _(t):
    return Q.outside_entity(t.panel, t.entity)


@query("q4_update_audit", ["panel"], """
    WITH o AS (SELECT npi, month, max(value) AS value FROM panel WHERE month >= DATE '2000-06-01' GROUP BY 1, 2),
    n AS (SELECT npi, month, max(value) AS value FROM panel WHERE month >= DATE '2000-06-01' AND rid % 11 <> 0 GROUP BY 1, 2),
    a AS (SELECT DISTINCT npi, value FROM o WHERE value IS NOT NULL),
    b AS (SELECT DISTINCT npi, value FROM n WHERE value IS NOT NULL)
    SELECT (SELECT count(*) FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.npi = b.npi AND a.value = b.value)) AS left_only,
      (SELECT count(*) FROM a JOIN b ON a.npi = b.npi AND a.value = b.value) AS "both",
      (SELECT count(*) FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE o.npi = n.npi AND o.month = n.month)) AS missing_keys""")
def _(t):
    tail = t.panel.where(F.col("month") >= F.lit("2000-06-01").cast("date"))

    def fold(df):
        return df.groupBy("npi", "month").agg(F.max("value").alias("value"))

    return Q.update_audit(fold(tail), fold(tail.where(F.col("rid") % 11 != 0)), ["npi", "month"])


@query("q5_reconcile", ["claims_summary", "claims_shown"], """
    WITH a AS (SELECT DISTINCT npi, Year FROM claims_summary), b AS (SELECT DISTINCT npi, Year FROM claims_shown)
    SELECT coalesce(a.npi, b.npi) AS npi, coalesce(a.Year, b.Year) AS Year,
      CASE WHEN a.npi IS NULL THEN 'right_only' ELSE 'left_only' END AS _merge
    FROM a FULL JOIN b ON a.npi = b.npi AND a.Year = b.Year WHERE a.npi IS NULL OR b.npi IS NULL""")
def _(t):
    return Q.id_differences(t.claims_summary, t.claims_shown, ["npi", "Year"])


@query("q6_misfiled", ["directory"], """
    SELECT CAST(count(*) FILTER (WHERE npi % 2 = 0 AND group_id IS NULL) AS BIGINT) AS null_in_known,
      CAST(count(*) FILTER (WHERE npi % 2 = 1 AND group_id IS NOT NULL) AS BIGINT) AS value_in_missing FROM directory""")
def _(t):
    return Q.misfiled(t.directory.where("npi % 2 = 0"), t.directory.where("npi % 2 = 1"), "group_id")
