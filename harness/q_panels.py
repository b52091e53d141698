"""Group practices, quarterly panels and analysis data."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness.q_directory import _COLS, _TARGETS, _fill_sql
from harness.registry import query
from rosterlake.plans import practices as P
from rosterlake.session import cut


_LATE = [1998, 1999, 2000]


def _g1_sql() -> str:
    cols = [*_COLS, "late"]
    steps = ["r0 AS (SELECT *, max(CASE WHEN group_id IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY npi) AS g, "
             "(year(date) IN (1998, 1999, 2000)) AS late FROM directory)",
             f"k0 AS (SELECT {', '.join(cols)} FROM r0 WHERE g = 1)",
             f"m0 AS (SELECT {', '.join(cols)} FROM r0 WHERE g = 0)",
             _fill_sql("k0", "k1", ["npi", "state", "zip", "phone"], ["group_id"], cols, ("phone",)),
             _fill_sql("k1", "k2", ["npi", "group_id"], _TARGETS, cols),
             _fill_sql("k2", "k3", ["npi", "group_id", "late"], _TARGETS, cols),
             _fill_sql("k3", "k4", ["npi", "state", "zip", "phone", "late"], ["group_id"], cols, ("phone",)),
             "t5 AS (SELECT DISTINCT npi, state, zip, late, org_name, phone, group_id FROM k4 "
             "WHERE org_name IS NOT NULL OR phone IS NOT NULL OR group_id IS NOT NULL)",
             "u5 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY npi, state, zip, late) AS n FROM t5) WHERE n = 1)",
             "k5 AS (SELECT DISTINCT k4.npi, k4.date, coalesce(k4.org_name, u5.org_name) AS org_name, "
             "coalesce(k4.group_id, u5.group_id) AS group_id, k4.group_size, k4.state, k4.zip, coalesce(k4.phone, u5.phone) AS phone "
             "FROM k4 LEFT JOIN u5 ON k4.npi = u5.npi AND k4.late = u5.late AND k4.state IS NOT DISTINCT FROM u5.state "
             "AND k4.zip IS NOT DISTINCT FROM u5.zip)",
             "k5p AS (SELECT * FROM k5 WHERE phone IS NOT NULL)",
             _fill_sql("k5p", "k6p", ["date", "state", "zip", "phone"], ["group_id"], _COLS),
             "k6 AS (SELECT * FROM k6p UNION SELECT * FROM k5 WHERE phone IS NULL)",
             "u7 AS (SELECT state, zip, date, phone, max(group_id) AS gid FROM k6 WHERE state IS NOT NULL AND zip IS NOT NULL "
             "AND phone IS NOT NULL AND group_id IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING min(group_id) = max(group_id))",
             f"r7 AS (SELECT {', '.join(_COLS)} FROM m0 UNION ALL SELECT {', '.join(_COLS)} FROM k6 WHERE group_id IS NULL)",
             "d7 AS (SELECT r7.npi, r7.date, org_name, coalesce(group_id, gid) AS group_id, group_size, r7.state, r7.zip, r7.phone "
             "FROM r7 LEFT JOIN u7 ON r7.state = u7.state AND r7.zip = u7.zip AND r7.date = u7.date AND r7.phone = u7.phone)",
             "gknown AS (SELECT * FROM k6 WHERE group_id IS NOT NULL UNION ALL SELECT * FROM d7 WHERE group_id IS NOT NULL)",
             "gmiss AS (SELECT * FROM d7 WHERE group_id IS NULL)"]
    return ",\n".join(steps)


_G1 = _g1_sql()


@query("g1_group_fill", ["directory"], f"WITH {_G1} SELECT *, 'known' AS side FROM gknown UNION ALL SELECT *, 'missing' FROM gmiss")
def _(t):
    known, missing = P.infer_groups(t.directory, _LATE)
    return (known.withColumn("side", F.lit("known"))
            .unionByName(missing.withColumn("side", F.lit("missing"))))


_G2 = """rows2 AS (SELECT * FROM directory),
    byp AS (SELECT *, row_number() OVER (ORDER BY state NULLS FIRST, zip NULLS FIRST, phone NULLS FIRST) - 1 + 100000000000 AS my_group_id
      FROM (SELECT DISTINCT state, zip, phone FROM rows2 WHERE phone IS NOT NULL)),
    byn AS (SELECT *, row_number() OVER (ORDER BY npi NULLS FIRST, state NULLS FIRST, zip NULLS FIRST) - 1 + 200000000000 AS my_group_id
      FROM (SELECT DISTINCT npi, state, zip FROM rows2 WHERE phone IS NULL)),
    inferred AS (SELECT r.*, my_group_id FROM rows2 r JOIN byp b ON r.state IS NOT DISTINCT FROM b.state
        AND r.zip IS NOT DISTINCT FROM b.zip AND r.phone = b.phone
      UNION ALL SELECT r.*, my_group_id FROM rows2 r JOIN byn b ON r.phone IS NULL AND r.npi = b.npi
        AND r.state IS NOT DISTINCT FROM b.state AND r.zip IS NOT DISTINCT FROM b.zip)"""


def _impute(t):
    d = cut(t.directory)
    return P.impute_groups(d.where("group_id is not null"), d.where("group_id is null"))


@query("g2_own_groups", ["directory"], f"WITH {_G2} SELECT npi, date, group_id, state, zip, phone, my_group_id FROM inferred")
def _(t):
    return _impute(t)[0].select("npi", "date", "group_id", "state", "zip", "phone", "my_group_id")


@query("g2_own_group_members", ["directory"], f"""WITH {_G2}
    SELECT my_group_id, date, count(DISTINCT npi) AS num_group_members_myid_recalc FROM inferred GROUP BY 1, 2""")
def _(t):
    return _impute(t)[2]


_BACK = [("1996-01-01", "1995-10-01"), ("1998-04-01", "1998-01-01")]

_G3 = _G2 + """, q0 AS (SELECT DISTINCT state, zip, phone, group_id, my_group_id, npi, CAST(date_trunc('quarter', date) AS DATE) AS quarter FROM inferred),
    q AS (SELECT * FROM q0 UNION ALL SELECT state, zip, phone, group_id, my_group_id, npi, CAST(quarter - INTERVAL 3 MONTH AS DATE)
        FROM q0 WHERE quarter IN (DATE '1996-01-01', DATE '1998-04-01')),
    loc AS (SELECT npi, quarter, plocstatename AS state, ploczip AS zip, ploctel AS phone FROM locations),
    places AS (SELECT *, row_number() OVER (ORDER BY quarter NULLS FIRST, state NULLS FIRST, zip NULLS FIRST, phone NULLS FIRST) - 1 + 300000000000 AS my_group_id_npi
        FROM (SELECT DISTINCT quarter, state, zip, phone FROM loc)),
    reg AS (SELECT l.*, my_group_id_npi FROM loc l JOIN places p ON l.quarter = p.quarter AND l.state IS NOT DISTINCT FROM p.state
        AND l.zip IS NOT DISTINCT FROM p.zip AND l.phone IS NOT DISTINCT FROM p.phone),
    g_own AS (SELECT npi, quarter, state, zip, phone, max(group_id) AS group_id FROM q WHERE phone IS NOT NULL AND state IS NOT NULL AND zip IS NOT NULL
        AND group_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5 HAVING min(group_id) = max(group_id)),
    g_any AS (SELECT quarter, state, zip, phone, max(group_id) AS group_id FROM q WHERE phone IS NOT NULL AND state IS NOT NULL AND zip IS NOT NULL
        AND group_id IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING min(group_id) = max(group_id)),
    y_own AS (SELECT npi, quarter, state, zip, phone, max(my_group_id) AS my_group_id FROM q WHERE phone IS NOT NULL AND state IS NOT NULL AND zip IS NOT NULL
        GROUP BY 1, 2, 3, 4, 5 HAVING min(my_group_id) = max(my_group_id)),
    y_any AS (SELECT quarter, state, zip, phone, max(my_group_id) AS my_group_id FROM q WHERE phone IS NOT NULL AND state IS NOT NULL AND zip IS NOT NULL
        GROUP BY 1, 2, 3, 4 HAVING min(my_group_id) = max(my_group_id)),
    a AS (SELECT l.*, group_id FROM loc l JOIN g_any USING (quarter, state, zip, phone)
        UNION ALL SELECT l.*, group_id FROM loc l JOIN g_own USING (npi, quarter, state, zip, phone)),
    b AS (SELECT l.*, my_group_id FROM loc l JOIN y_any USING (quarter, state, zip, phone)
        UNION ALL SELECT l.*, my_group_id FROM loc l JOIN y_own USING (npi, quarter, state, zip, phone)),
    f AS (SELECT coalesce(a.state, b.state) AS state, coalesce(a.zip, b.zip) AS zip, coalesce(a.phone, b.phone) AS phone, group_id, my_group_id,
        coalesce(a.npi, b.npi) AS npi, coalesce(a.quarter, b.quarter) AS quarter FROM a FULL JOIN b
        ON a.npi = b.npi AND a.quarter = b.quarter AND a.state = b.state AND a.zip = b.zip AND a.phone = b.phone),
    grown AS (SELECT state, zip, phone, group_id, my_group_id, npi, quarter FROM q UNION SELECT state, zip, phone, group_id, my_group_id, npi, quarter FROM f),
    allrows AS (SELECT coalesce(x.state, r.state) AS state, coalesce(x.zip, r.zip) AS zip, coalesce(x.phone, r.phone) AS phone, group_id, my_group_id,
        coalesce(x.npi, r.npi) AS npi, coalesce(x.quarter, r.quarter) AS quarter, my_group_id_npi
        FROM grown x FULL JOIN reg r ON x.npi = r.npi AND x.quarter = r.quarter AND x.state IS NOT DISTINCT FROM r.state
        AND x.zip IS NOT DISTINCT FROM r.zip AND x.phone = r.phone)"""


def _all_groups(t):
    return P.infer_all_groups(_impute(t)[0], t.locations, _BACK)


@query("g3_all_groups", ["directory", "locations"], f"WITH {_G3} SELECT * FROM allrows")
def _(t):
    return _all_groups(t)[0]


@query("g3_all_dates", ["directory", "locations"], f"""WITH {_G3}
    SELECT npi, min(quarter) AS quarter_x, max(quarter) AS quarter_y FROM allrows GROUP BY 1""")
def _(t):
    return _all_groups(t)[3]


_G4 = """c1 AS (SELECT quarter, group_id, CAST(sum(md_do) AS BIGINT) AS a, CAST(sum(NP) AS BIGINT) AS b FROM (SELECT DISTINCT npi, quarter, group_id FROM group_rows
        WHERE group_id IS NOT NULL) g JOIN types y ON g.npi = y.npi GROUP BY 1, 2),
    c2 AS (SELECT quarter, my_group_id, CAST(sum(md_do) AS BIGINT) AS a, CAST(sum(NP) AS BIGINT) AS b FROM (SELECT DISTINCT npi, quarter, my_group_id FROM group_rows) g
        JOIN types y ON g.npi = y.npi GROUP BY 1, 2),
    c3 AS (SELECT quarter, my_group_id_npi, CAST(sum(md_do) AS BIGINT) AS a, CAST(sum(NP) AS BIGINT) AS b FROM (SELECT DISTINCT npi, quarter, my_group_id_npi FROM group_rows
        WHERE my_group_id_npi IS NOT NULL) g JOIN types y ON g.npi = y.npi GROUP BY 1, 2),
    counts AS (SELECT r.*, c1.a AS "MDDO_gppid", c1.b AS "NP_gppid", c2.a AS "MDDO_mgi", c2.b AS "NP_mgi", c3.a AS "MDDO_mginpi", c3.b AS "NP_mginpi"
      FROM group_rows r LEFT JOIN c1 ON r.quarter = c1.quarter AND r.group_id = c1.group_id
      LEFT JOIN c2 ON r.quarter = c2.quarter AND r.my_group_id = c2.my_group_id
      LEFT JOIN c3 ON r.quarter = c3.quarter AND r.my_group_id_npi = c3.my_group_id_npi)"""


def _named_types(t):
    return t.types.withColumnRenamed("md_do", "MD/DO")


@query("g4_group_counts", ["group_rows", "types"], f"WITH {_G4} SELECT * FROM counts")
def _(t):
    return P.role_counts(t.group_rows, _named_types(t))


@query("g5_copractices", ["group_rows", "types"], f"""WITH {_G4}
    SELECT c.npi, quarter, state, max("MDDO_gppid") AS "MDDO_gppid", max("NP_gppid") AS "NP_gppid", max("MDDO_mgi") AS "MDDO_mgi",
      max("NP_mgi") AS "NP_mgi", max("MDDO_mginpi") AS "MDDO_mginpi", max("NP_mginpi") AS "NP_mginpi"
    FROM counts c JOIN types y ON c.npi = y.npi WHERE md_do = 1 AND cat <> 'both' AND quarter < DATE '2000-01-01' AND state IS NOT NULL
    GROUP BY 1, 2, 3""")
def _(t):
    return P.copractices(P.role_counts(t.group_rows, _named_types(t)), _named_types(t), "2000-01-01")


@query("g6_urban", ["group_rows", "urban"], """
    WITH fin AS (SELECT DISTINCT npi, quarter, state FROM group_rows WHERE state IS NOT NULL),
    p AS (SELECT DISTINCT g.npi, g.quarter, g.state, zip FROM group_rows g JOIN fin USING (npi, quarter, state)),
    a AS (SELECT DISTINCT npi, quarter, state, NCHSUR2013 AS u FROM p JOIN (SELECT DISTINCT substr(ZCTA5, 1, 5) z, NCHSUR2013 FROM urban) ON substr(zip, 1, 5) = z),
    b AS (SELECT DISTINCT p.npi, p.quarter, p.state, NCHSUR2013 AS u FROM p LEFT JOIN (SELECT DISTINCT npi, quarter, state FROM a) x USING (npi, quarter, state)
      JOIN (SELECT DISTINCT substr(ZCTA5, 1, 4) z, NCHSUR2013 FROM urban) ON substr(zip, 1, 4) = z
      WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.npi = p.npi AND a.quarter = p.quarter AND a.state = p.state)),
    k AS (SELECT * FROM a UNION ALL SELECT * FROM b)
    SELECT fin.npi, fin.quarter, fin.state, """ + ", ".join(
        f'CAST(coalesce(max((u = {i})::INT), 0) AS INT) AS "NCHSUR2013_{i}"' for i in range(1, 7)) + """
    FROM fin LEFT JOIN k ON fin.npi = k.npi AND fin.quarter = k.quarter AND fin.state = k.state GROUP BY 1, 2, 3""")
def _(t):
    final = (t.group_rows.where("state is not null")
             .select("npi", "quarter", "state").distinct())
    return P.urban_classes(t.group_rows, final, t.urban)


@query("g7_first_working_quarter", ["code_panel"], """
    SELECT npi, CAST(min(date_trunc('quarter', month)) AS DATE) AS quarter FROM code_panel
    WHERE ptaxcode <> '390200000X' AND npi IN (SELECT c_custkey + 50 FROM customer) GROUP BY 1""")
def _(t):
    people = t.customer.select((F.col("c_custkey") + 50).alias("npi"))
    spans = t.panel.groupBy("npi").agg(F.min("month").alias("quarter_x"), F.max("month").alias("quarter_y"))
    return P.enrollment_dates(people, spans, spans, t.code_panel)[2]


@query("g8_locations", ["addresses", "ends"], """
    WITH s AS (SELECT npi, month, plocstatename FROM addresses WHERE npi IN (SELECT npi FROM ends) AND month >= DATE '1996-01-01' AND month < DATE '1999-01-01'),
    z AS (SELECT npi, month, ploczip FROM addresses), h AS (SELECT npi, month, ploctel FROM addresses)
    SELECT DISTINCT s.npi, plocstatename, ploczip, ploctel, CAST(date_trunc('quarter', s.month) AS DATE) AS quarter
    FROM s JOIN z ON s.npi = z.npi AND s.month = z.month JOIN h ON s.npi = h.npi AND s.month = h.month""")
def _(t):
    a = t.addresses
    return P.enrollee_locations(t.ends, a.select("npi", "month", "plocstatename"),
                                a.select("npi", "month", "ploczip"),
                                a.select("npi", "month", "ploctel"), "1996-02-01", "1999-01-01")


_G9 = """mdnp AS (SELECT npi, md_do AS md, NP FROM registry_types WHERE md_do + NP > 0),
    cc AS (SELECT npi, min(cat) AS cat, count(DISTINCT cat) AS n FROM type_creds GROUP BY 1),
    mine AS (SELECT m.*, CASE WHEN n = 1 THEN cat END AS cat FROM mdnp m LEFT JOIN cc ON m.npi = cc.npi),
    theirs AS (SELECT npi, max((credential IN ('MD', 'DO', 'MD/DO') AND credential IS NOT NULL)::INT) AS md,
      max((primary_specialty = 'NURSE PRACTITIONER' OR coalesce(credential = 'NP', false))::INT) AS NP FROM type_listed GROUP BY 1),
    m AS (SELECT coalesce(a.npi, b.npi) AS npi, coalesce(a.md, b.md) AS md, coalesce(a.NP, b.NP) AS NP, cat FROM mine a
      FULL JOIN (SELECT * FROM theirs WHERE md + NP > 0) b ON a.npi = b.npi AND a.md = b.md AND a.NP = b.NP),
    single AS (SELECT npi, cat FROM cc WHERE n = 1), two AS (SELECT npi FROM cc WHERE n = 2),
    one AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY npi) AS k FROM m) WHERE k = 1 AND NOT (md = 1 AND NP = 1)
      AND NOT coalesce(cat = 'NP' AND md = 1, false) AND NOT coalesce(cat = 'MD/DO' AND NP = 1, false)),
    p1 AS (SELECT npi, CASE WHEN NP = 1 THEN 'NP' ELSE 'MD/DO' END AS cat FROM one),
    sums AS (SELECT m.npi, sum(md) AS md, sum(NP) AS NP FROM m WHERE npi NOT IN (SELECT npi FROM one) GROUP BY 1),
    p2 AS (SELECT s.npi, 'MD/DO' AS cat FROM sums s JOIN single c ON s.npi = c.npi WHERE NP = 1 AND md IN (1, 2) AND cat = 'MD/DO'
      UNION ALL SELECT s.npi, 'NP' FROM sums s JOIN single c ON s.npi = c.npi WHERE md = 1 AND NP IN (1, 2) AND cat = 'NP'),
    rest AS (SELECT * FROM sums WHERE npi NOT IN (SELECT npi FROM p2) AND npi NOT IN (SELECT npi FROM two)),
    p3 AS (SELECT npi, CASE WHEN md > NP THEN 'MD/DO' WHEN md < NP THEN 'NP' ELSE 'both' END AS cat FROM rest),
    p4 AS (SELECT npi, 'both' AS cat FROM two),
    allp AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3 UNION ALL SELECT * FROM p4)"""


@query("g9_reconcile_types", ["registry_types", "type_creds", "type_listed"], f"""WITH {_G9}
    SELECT npi, CAST((cat <> 'NP')::INT AS INT) AS "MD/DO", CAST((cat <> 'MD/DO')::INT AS INT) AS "NP", cat FROM allp""")
def _(t):
    return P.reconcile_types(t.registry_types.withColumnRenamed("md_do", "MD/DO"), t.type_creds,
                             t.type_listed)[1]


_PERIOD = dict(start="1996-01-01", end="2000-01-01")

_G10 = """q0 AS (SELECT DISTINCT npi, group_id, state, phone, zip, CAST(date_trunc('quarter', date) AS DATE) AS quarter FROM directory WHERE group_id IS NOT NULL),
    grp AS (SELECT * FROM (SELECT * FROM q0 UNION ALL SELECT npi, group_id, state, phone, zip, CAST(quarter - INTERVAL 3 MONTH AS DATE)
        FROM q0 WHERE quarter IN (DATE '1996-01-01', DATE '1998-04-01')) WHERE quarter >= DATE '1996-01-01' AND quarter < DATE '2000-01-01')"""

_G11 = _G10 + """, loc AS (SELECT DISTINCT npi, quarter, plocstatename AS state, ploczip AS zip, coalesce(ploctel, 'NAN') AS telephone FROM locations),
    have AS (SELECT DISTINCT l.npi, l.quarter, l.state, l.zip, l.telephone, group_id FROM loc l JOIN grp g ON l.npi = g.npi AND l.quarter = g.quarter
      UNION SELECT DISTINCT l.npi, l.quarter, g.state, g.zip, coalesce(g.phone, 'nan'), group_id FROM loc l JOIN grp g ON l.npi = g.npi AND l.quarter = g.quarter),
    nums AS (SELECT *, row_number() OVER (ORDER BY state, zip, telephone, quarter) - 1 + 900000000000 AS gid
      FROM (SELECT DISTINCT state, zip, telephone, quarter FROM loc WHERE state IS NOT NULL AND zip IS NOT NULL)),
    comb AS (SELECT DISTINCT n.state, n.zip, n.telephone, n.quarter, coalesce(h.group_id, gid) AS group_id FROM nums n LEFT JOIN have h
      ON n.state = h.state AND n.zip = h.zip AND n.telephone = h.telephone AND n.quarter = h.quarter),
    added AS (SELECT l.npi, l.quarter, l.state, l.zip, l.telephone, c.group_id FROM loc l JOIN comb c ON l.state = c.state AND l.zip = c.zip
      AND l.telephone = c.telephone AND l.quarter = c.quarter WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.npi = l.npi AND h.quarter = l.quarter)),
    fullg AS (SELECT *, group_id::VARCHAR || '-' || year(quarter)::VARCHAR || 'Q' || quarter(quarter)::VARCHAR || '-' || state || '-' || zip || '-' || telephone
      AS group_quarter_loc_id FROM (SELECT * FROM have UNION SELECT * FROM added))"""


@query("g10_master_groups", ["directory"], f"WITH {_G10} SELECT * FROM grp")
def _(t):
    return P.master_group_practices(t.directory.where("group_id is not null"), backfill=_BACK, **_PERIOD)


@query("g11_match_groups", ["directory", "locations"], f"WITH {_G11} SELECT * FROM fullg")
def _(t):
    groups = P.master_group_practices(t.directory.where("group_id is not null"), backfill=_BACK, **_PERIOD)
    return P.match_to_groups(t.locations, groups)


@query("g12_np_counts", ["members", "types", "locations"], """
    WITH lq AS (SELECT DISTINCT npi, quarter FROM locations),
    c AS (SELECT m.npi, m.quarter, count(DISTINCT n.npi) AS k FROM members m JOIN members n ON m.quarter = n.quarter
      AND m.group_quarter_loc_id = n.group_quarter_loc_id AND n.NP = 1 WHERE m.md_do = 1 GROUP BY 1, 2)
    SELECT lq.npi, lq.quarter, cat, CAST(coalesce(k, 0) AS INT) AS npcount FROM lq JOIN types y ON lq.npi = y.npi AND md_do = 1
    LEFT JOIN c ON lq.npi = c.npi AND lq.quarter = c.quarter""")
def _(t):
    return P.np_counts_for_mds(t.locations, t.members.withColumnRenamed("md_do", "MD/DO"), _named_types(t))


@query("g12_np_counts_master", ["directory", "locations", "types"], f"""WITH {_G11},
    mem AS (SELECT DISTINCT f.npi, quarter, group_quarter_loc_id, md_do, NP FROM fullg f JOIN types y ON f.npi = y.npi),
    c AS (SELECT m.npi, m.quarter, count(DISTINCT n.npi) AS k FROM mem m JOIN mem n ON m.quarter = n.quarter
      AND m.group_quarter_loc_id IS NOT DISTINCT FROM n.group_quarter_loc_id AND n.NP = 1 WHERE m.md_do = 1 GROUP BY 1, 2)
    SELECT lq.npi, lq.quarter, cat, CAST(coalesce(k, 0) AS INT) AS npcount FROM (SELECT DISTINCT npi, quarter FROM locations) lq
    JOIN types y ON lq.npi = y.npi AND md_do = 1 LEFT JOIN c ON lq.npi = c.npi AND lq.quarter = c.quarter""")
def _(t):
    return P.np_counts_master(t.locations, t.directory.where("group_id is not null"), _named_types(t),
                              backfill=_BACK, **_PERIOD)


_SOLE = """a AS (SELECT *, row_number() OVER (ORDER BY npi NULLS FIRST, date NULLS FIRST, group_size NULLS FIRST, org_name NULLS FIRST,
        state NULLS FIRST, zip NULLS FIRST, phone NULLS FIRST) - 1 + 100000000000 AS gid FROM directory WHERE group_id IS NULL),
    ra AS (SELECT npi, date, group_id, group_size, org_name, state, zip, phone FROM directory WHERE group_id IS NOT NULL
      UNION ALL SELECT npi, date, gid, group_size, org_name, state, zip, phone FROM a),
    za AS (SELECT group_id, date, count(DISTINCT npi) AS s FROM ra GROUP BY 1, 2),
    sole AS (SELECT npi, ra.date, ra.group_id, coalesce(group_size, s) AS group_size, org_name, state, zip, phone FROM ra JOIN za
      ON ra.group_id = za.group_id AND ra.date = za.date)"""


@query("g13_sole_practices", ["directory"], f"WITH {_SOLE} SELECT * FROM sole")
def _(t):
    return P.sole_practices(t.directory)


_EXTREME = """r AS (SELECT DISTINCT npi, group_id, group_size, state, zip, date FROM {src} WHERE group_id IS NOT NULL),
    pl AS (SELECT *, row_number() OVER (ORDER BY group_id, group_size NULLS FIRST, state NULLS FIRST, zip NULLS FIRST, date) - 1 AS pid
      FROM (SELECT DISTINCT group_id, group_size, state, zip, date FROM r)),
    x AS (SELECT r.*, pid FROM r JOIN pl ON r.group_id = pl.group_id AND r.date = pl.date AND r.group_size IS NOT DISTINCT FROM pl.group_size
      AND r.state IS NOT DISTINCT FROM pl.state AND r.zip IS NOT DISTINCT FROM pl.zip),
    n AS (SELECT pid, date, count(DISTINCT npi) AS k FROM x WHERE npi % 3 = 1 GROUP BY 1, 2),
    y AS (SELECT x.*, coalesce(k, 0) AS np_count, row_number() OVER (PARTITION BY npi, x.date ORDER BY coalesce(k, 0), x.pid) AS lo,
        row_number() OVER (PARTITION BY npi, x.date ORDER BY coalesce(k, 0) DESC, x.pid DESC) AS hi
      FROM x LEFT JOIN n ON x.pid = n.pid AND x.date = n.date WHERE npi % 3 = 0),
    ext AS (SELECT a.npi, a.date, a.np_count AS np_count_min, a.pid AS group_prac_zip_date_id_min, a.group_id AS group_id_min, a.group_size AS group_size_min,
      a.state AS state_min, a.zip AS zip_min, b.np_count AS np_count_max, b.pid AS group_prac_zip_date_id_max, b.group_id AS group_id_max,
      b.group_size AS group_size_max, b.state AS state_max, b.zip AS zip_max
    FROM y a JOIN y b ON a.npi = b.npi AND a.date = b.date AND a.lo = 1 AND b.hi = 1)"""


@query("g13_extreme_practices", ["directory"], f"WITH {_EXTREME.replace('{src}', 'directory')} SELECT * FROM ext")
def _(t):
    d = t.directory.where("group_id is not null")
    who = d.select("npi").distinct()
    return P.extreme_practices(d, who.where("npi % 3 = 0"), who.where("npi % 3 = 1"))


_SPEC_USES = ["specialty_rows"]


@query("g13_specialties", _SPEC_USES, """
    WITH s AS (SELECT * FROM specialty_rows WHERE npi % 3 = 0), p AS (SELECT npi, date, min(primary_specialty) AS primary_specialty FROM s GROUP BY 1, 2),
    l AS (SELECT DISTINCT npi, date, v FROM (SELECT npi, date, secondary_specialty_1 AS v FROM s UNION SELECT npi, date, secondary_specialty_2 FROM s
      UNION SELECT npi, date, secondary_specialty_3 FROM s) WHERE v IS NOT NULL AND v <> ' ')
    SELECT p.npi, p.date, primary_specialty, coalesce(max((v = 'SUB 1')::INT), 0) AS sub_1, coalesce(max((v = 'SUB 2')::INT), 0) AS sub_2
    FROM p LEFT JOIN l ON p.npi = l.npi AND p.date = l.date GROUP BY 1, 2, 3""")
def _(t):
    from rosterlake.operators.joins import natural_join
    from rosterlake.operators.reshape import indicators
    mds = t.part.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("npi"))
    primary, secondary = P.specialties(t.specialty_rows, mds)
    flags = indicators(secondary, ["npi", "date"], "secondary_spec", {"SUB 1": "sub_1", "SUB 2": "sub_2"})
    return natural_join(primary, flags, "left", on=["npi", "date"]).na.fill(0, ["sub_1", "sub_2"])


_PANEL_COLUMNS = ["npi", "date", "np_count_min", "group_id_min", "group_size_min", "np_count_max", "group_id_max",
                  "group_size_max", "primary_specialty", "sub_1", "gradyear", "pgender", "date_30", "date_100", "date_275"]


@query("g13_analysis_dataset", ["directory", "specialty_rows", "waivers", "crosswalk"],
       f"""WITH {_SOLE}, {_EXTREME.replace('{src}', 'sole')},
    pr AS (SELECT npi, date, min(primary_specialty) AS primary_specialty, max((secondary_specialty_1 IS NOT DISTINCT FROM 'SUB 1')::INT) AS sub_1
      FROM specialty_rows GROUP BY 1, 2),
    yr AS (SELECT npi, npi AS y FROM (SELECT DISTINCT npi FROM directory)),
    base AS (SELECT ext.*, pr.primary_specialty, coalesce(pr.sub_1, 0) AS sub_1, y FROM ext LEFT JOIN pr ON ext.npi = pr.npi AND ext.date = pr.date
      JOIN yr ON ext.npi = yr.npi),
    q AS (SELECT quantile_cont(y, [i / 20.0 FOR i IN range(21)]) AS ed FROM base), u AS (SELECT unnest(ed) AS v FROM q),
    bn AS (SELECT k.y, greatest(count(*) FILTER (WHERE v < k.y), 1) AS b FROM (SELECT DISTINCT y FROM base) k, u GROUP BY 1),
    w AS (SELECT npi, min(CASE WHEN WaiverType = 30 THEN Date END) AS date_30, min(CASE WHEN WaiverType = 100 THEN Date END) AS date_100,
      min(CASE WHEN WaiverType = 275 THEN Date END) AS date_275 FROM waivers x JOIN crosswalk c ON x.samhsa_id = c.samhsa_id GROUP BY 1)
    SELECT base.npi, date, np_count_min, group_id_min, group_size_min, np_count_max, group_id_max, group_size_max, primary_specialty, sub_1,
      CAST(b AS INT) AS gradyear, CASE WHEN p_size % 2 = 0 THEN 'F' ELSE 'M' END AS pgender, date_30, date_100, date_275
    FROM base JOIN bn ON base.y = bn.y JOIN part ON base.npi = p_partkey LEFT JOIN w ON base.npi = w.npi""")
def _(t):
    """The whole panel, one row per physician and date."""
    genders = t.part.select(F.col("p_partkey").alias("npi"),
                            F.when(F.col("p_size") % 2 == 0, "F").otherwise("M").alias("pgender"))
    who = t.part.select(F.col("p_partkey").alias("npi"))
    rows = (t.directory.withColumn("graduation_year", F.col("npi"))
            .join(t.specialty_rows, ["npi", "date"], "left"))
    return P.analysis_dataset(rows, who.where("npi % 3 = 0"), who.where("npi % 3 = 1"), genders,
                              t.waivers, t.crosswalk, {"SUB 1": "sub_1"}).select(*_PANEL_COLUMNS)


_ALLSPEC = """ls AS (SELECT DISTINCT npi, spec FROM (SELECT npi, primary_specialty AS spec FROM specialty_rows UNION SELECT npi, secondary_specialty_1 FROM specialty_rows
      UNION SELECT npi, secondary_specialty_2 FROM specialty_rows UNION SELECT npi, secondary_specialty_3 FROM specialty_rows)
      WHERE spec IS NOT NULL AND spec <> ' '),
    tx AS (SELECT DISTINCT npi, Classification, Specialization FROM code_panel JOIN taxonomy ON ptaxcode = TaxonomyCode),
    ts AS (SELECT npi, upper(Classification) AS spec, Specialization FROM tx UNION SELECT npi, upper(Specialization), Specialization FROM tx WHERE Specialization IS NOT NULL),
    u AS (SELECT npi, spec FROM ls UNION SELECT npi, CASE WHEN suffix_(spec) THEN replace(spec, ' -', '') ELSE spec END FROM ts
      WHERE NOT (coalesce(Specialization = 'General Practice', false) AND spec = 'GENERAL PRACTICE')),
    alls AS (SELECT npi, trim(CASE WHEN spec = 'PREVENTATIVE MEDICINE' THEN 'PREVENTIVE MEDICINE' ELSE spec END) AS spec FROM u
      WHERE npi IN (SELECT npi FROM ends))""".replace("suffix_(spec)", "spec LIKE '% -'")


def _allspec(t):
    return P.long_specialties(t.specialty_rows, t.code_panel, t.taxonomy, t.ends)


@query("g14_long_specialties", ["specialty_rows", "code_panel", "taxonomy", "ends"], f"WITH {_ALLSPEC} SELECT * FROM alls")
def _(t):
    return _allspec(t)


@query("g14_frequent_specialties", ["specialty_rows", "code_panel", "taxonomy", "ends"], f"""WITH {_ALLSPEC}
    SELECT npi, spec FROM (SELECT *, count(*) OVER (PARTITION BY spec) AS n FROM alls) WHERE n > 20""")
def _(t):
    return P.frequent_specialties(_allspec(t), 20)


@query("g14_specialty_indicators", ["specialty_rows", "code_panel", "taxonomy", "ends"], f"""WITH {_ALLSPEC}
    SELECT e.npi, CAST(count(*) FILTER (WHERE spec = 'DENTIST') AS INT) AS dentist, CAST(count(*) FILTER (WHERE spec = 'ADULT') AS INT) AS adult
    FROM (SELECT DISTINCT npi FROM ends) e LEFT JOIN alls a ON e.npi = a.npi GROUP BY 1""")
def _(t):
    return P.specialty_indicators(_allspec(t), t.ends, {"DENTIST": "dentist", "ADULT": "adult"})


def _cells(wide):
    """The counts of an indicator table that are not 0, one row each."""
    names = [F.col(f"`{c}`") for c in wide.columns if c != "npi"]
    return wide.unpivot(["npi"], names, "spec", "n").where("n > 0")


@query("g14_panel_specialties", ["specialty_rows", "code_panel", "taxonomy", "ends"], f"""WITH {_ALLSPEC}
    SELECT npi, spec, CAST(k AS INT) AS n FROM (SELECT npi, spec, count(*) AS k, sum(count(*)) OVER (PARTITION BY spec) AS held FROM alls GROUP BY 1, 2)
    WHERE held > 20""")
def _(t):
    """One column per specialty that the data hold often enough."""
    return _cells(P.panel_specialties(t.specialty_rows, t.code_panel, t.taxonomy, t.ends, 20)[1])


@query("g13_practitioners", ["type_listed", "registry_types"], """
    WITH r AS (SELECT l.npi, credential AS c, primary_specialty AS p, md_do, NP FROM type_listed l LEFT JOIN registry_types y ON l.npi = y.npi)
    SELECT DISTINCT npi, 'physician' AS role FROM r WHERE c IN ('MD/DO', 'MD', 'DO') OR md_do = 1
    UNION ALL SELECT DISTINCT npi, 'nurse' FROM r WHERE c = 'NP' OR p = 'NURSE PRACTITIONER' OR NP = 1""")
def _(t):
    """Physicians and nurse practitioners from directory and registry together."""
    from rosterlake.operators.reshape import indicators_to_long
    types = indicators_to_long(t.registry_types.withColumnRenamed("md_do", "MD/DO"), ["npi"],
                               ["MD/DO", "NP"], "PractitionerType")
    mds, nps = P.listed_and_registered(t.type_listed.withColumnRenamed("credential", "Credential"), types)
    return mds.withColumn("role", F.lit("physician")).unionAll(nps.withColumn("role", F.lit("nurse")))


@query("g14_final_analysis", ["waivers", "crosswalk"], """
    WITH f AS (SELECT DISTINCT o_custkey AS npi, 'S' || CAST(o_custkey % 4 AS VARCHAR) AS state, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter FROM orders),
    g AS (SELECT c_custkey + 50 AS npi, CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS pgender FROM customer),
    e AS (SELECT c_custkey AS npi, 'SCHOOL' AS medical_school, CAST(c_custkey AS BIGINT) AS graduation_year FROM customer),
    q AS (SELECT quantile_cont(graduation_year, [i / 20.0 FOR i IN range(21)]) AS ed FROM e),
    u AS (SELECT unnest(range(21)) AS i, unnest(ed) AS v FROM q),
    b AS (SELECT npi, greatest(count(*) FILTER (WHERE v < graduation_year), 1) AS b FROM e, u GROUP BY 1),
    w AS (SELECT npi, State AS state, min(CASE WHEN WaiverType = 30 THEN Date END) AS date_30, min(CASE WHEN WaiverType = 100 THEN Date END) AS date_100,
      min(CASE WHEN WaiverType = 275 THEN Date END) AS date_275 FROM waivers x JOIN crosswalk c ON x.samhsa_id = c.samhsa_id GROUP BY 1, 2)
    SELECT f.npi, f.state, f.quarter, medical_school, graduation_year, CAST(b AS INT) AS gradyear, round(lo.v, 4) AS gradyear_lo, round(hi.v, 4) AS gradyear_hi,
      pgender, date_30, date_100, date_275
    FROM f JOIN g ON f.npi = g.npi LEFT JOIN e ON f.npi = e.npi LEFT JOIN b ON f.npi = b.npi LEFT JOIN u lo ON lo.i = b - 1 LEFT JOIN u hi ON hi.i = b
    LEFT JOIN w ON f.npi = w.npi AND f.state = w.state""")
def _(t):
    final = t.orders.select(F.col("o_custkey").alias("npi"),
                            F.concat(F.lit("S"), (F.col("o_custkey") % 4).cast("string")).alias("state"),
                            F.date_trunc("quarter", "o_orderdate").cast("date").alias("quarter")).distinct()
    genders = (t.customer
               .select((F.col("c_custkey") + 50).alias("npi"), F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("pgender")))
    educ = t.customer.select(F.col("c_custkey").alias("npi"), F.lit("SCHOOL").alias("medical_school"),
                             F.col("c_custkey").alias("graduation_year"))
    out = P.final_analysis(final, educ, genders, t.waivers, t.crosswalk)
    return out.withColumns({c: F.round(c, 4) for c in ("gradyear_lo", "gradyear_hi")})


_G15 = ", ".join([
    _G1.replace("IN (1998, 1999, 2000)", "IN (2018, 2019, 2020)"),
    _G2.replace("SELECT * FROM directory", "SELECT * FROM gknown UNION ALL SELECT * FROM gmiss", 1),
    _G9, """ty AS (SELECT npi, (cat <> 'NP')::INT AS md_do, (cat <> 'MD/DO')::INT AS NP, cat FROM allp),
    adr AS (SELECT * FROM addresses WHERE npi IN (SELECT npi FROM allp) AND month >= DATE '1995-01-01' AND month < DATE '2002-01-01'),
    lcs AS (SELECT DISTINCT s.npi, s.plocstatename, z.ploczip, h.ploctel, CAST(date_trunc('quarter', s.month) AS DATE) AS quarter
      FROM adr s JOIN adr z ON s.npi = z.npi AND s.month = z.month JOIN adr h ON s.npi = h.npi AND s.month = h.month)""",
    _G3[len(_G2) + 2:].replace("FROM locations", "FROM lcs").replace("DATE '1996-01-01', DATE '1998-04-01'", "DATE '1900-01-01'"),
    _G4.replace("group_rows", "allrows").replace("JOIN types y", "JOIN ty y"),
    """copr AS (SELECT c.npi, quarter, state, max("MDDO_gppid") AS "MDDO_gppid", max("NP_gppid") AS "NP_gppid", max("MDDO_mgi") AS "MDDO_mgi",
      max("NP_mgi") AS "NP_mgi", max("MDDO_mginpi") AS "MDDO_mginpi", max("NP_mginpi") AS "NP_mginpi"
      FROM counts c JOIN ty y ON c.npi = y.npi WHERE cat = 'MD/DO' AND state IS NOT NULL GROUP BY 1, 2, 3),
    edges AS (SELECT unnest(quantile_cont(c_custkey, [i / 20.0 FOR i IN range(21)])) AS v FROM customer),
    bins AS (SELECT c_custkey AS npi, greatest(count(*) FILTER (WHERE v < c_custkey), 1) AS bin FROM customer, edges GROUP BY 1),
    wv AS (SELECT npi, State AS state, min(CASE WHEN WaiverType = 30 THEN Date END) AS date_30, min(CASE WHEN WaiverType = 100 THEN Date END) AS date_100,
      min(CASE WHEN WaiverType = 275 THEN Date END) AS date_275 FROM waivers x JOIN crosswalk k ON x.samhsa_id = k.samhsa_id GROUP BY 1, 2),
    fa AS (SELECT p.*, CAST(bin AS INT) AS gradyear, CASE WHEN p.npi % 2 = 0 THEN 'F' ELSE 'M' END AS pgender, date_30, date_100, date_275
      FROM copr p JOIN bins ON p.npi = bins.npi LEFT JOIN wv ON p.npi = wv.npi AND p.state = wv.state),
    up AS (SELECT DISTINCT r.npi, r.quarter, r.state, r.zip FROM allrows r JOIN fa ON r.npi = fa.npi AND r.quarter = fa.quarter AND r.state = fa.state),
    ua AS (SELECT DISTINCT npi, quarter, state, NCHSUR2013 AS cls FROM up JOIN urban ON substr(zip, 1, 5) = ZCTA5),
    ub AS (SELECT DISTINCT npi, quarter, state, NCHSUR2013 AS cls FROM up JOIN urban ON substr(zip, 1, 4) = substr(ZCTA5, 1, 4)
      WHERE NOT EXISTS (SELECT 1 FROM ua WHERE ua.npi = up.npi AND ua.quarter = up.quarter AND ua.state = up.state)),
    uk AS (SELECT npi, quarter, state, """ + ", ".join(
        f'max((cls = {i})::INT) AS "NCHSUR2013_{i}"' for i in range(1, 7)) + """ FROM (SELECT * FROM ua UNION ALL SELECT * FROM ub) GROUP BY 1, 2, 3)"""])


@query("g15_waiver_analysis", ["directory", "registry_types", "type_creds", "type_listed", "addresses", "urban", "waivers", "crosswalk"],
       f"WITH {_G15} SELECT fa.*, " + ", ".join(f'CAST(coalesce("NCHSUR2013_{i}", 0) AS INT) AS "NCHSUR2013_{i}"' for i in range(1, 7)) +
       " FROM fa LEFT JOIN uk ON fa.npi = uk.npi AND fa.quarter = uk.quarter AND fa.state = uk.state")
def _(t):
    """The whole chain, from directory and registry to the final panel."""
    return _panel(t)["final"].drop("medical_school", "graduation_year", "gradyear_lo", "gradyear_hi")


@query("g15_specializations", ["directory", "registry_types", "type_creds", "type_listed", "addresses", "urban", "waivers", "crosswalk",
                               "specialty_rows", "code_panel", "taxonomy"],
       f"WITH {_G15}, {_ALLSPEC.replace('FROM ends', 'FROM fa')}" + """
    SELECT npi, spec, CAST(k AS INT) AS n FROM (SELECT npi, spec, count(*) AS k, sum(count(*)) OVER (PARTITION BY spec) AS held FROM alls GROUP BY 1, 2)
    WHERE held > 20""")
def _(t):
    """The whole chain's specialties of the panel's people, as columns."""
    return _cells(_panel(t)["specializations"])


def _panel(t):
    a = t.addresses
    people = t.customer.select(F.col("c_custkey").alias("npi"))
    educ = people.select("npi", F.lit("SCHOOL").alias("medical_school"), F.col("npi").alias("graduation_year"))
    genders = people.select("npi", F.when(F.col("npi") % 2 == 0, "F").otherwise("M").alias("pgender"))
    return P.waiver_analysis(
        t.directory, t.registry_types.withColumnRenamed("md_do", "MD/DO"), t.type_creds, t.type_listed,
        a.select("npi", "month", "plocstatename"), a.select("npi", "month", "ploczip"),
        a.select("npi", "month", "ploctel"), t.urban, educ, genders, t.waivers, t.crosswalk,
        people.withColumn("penumdate", F.lit("2005-01-01").cast("date")), t.code_panel,
        t.specialty_rows, t.taxonomy, more_than=20, start="1995-01-01", end="2002-01-01")
