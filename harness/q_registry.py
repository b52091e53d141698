"""Registry attributes, reports, panel refresh and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness.registry import query
from rosterlake import schemas as S
from rosterlake.operators import impute as I
from rosterlake.plans import names as N
from rosterlake.plans import refresh as P
from rosterlake.plans import registry as G

_REMOVED = """d AS (SELECT npi, max(npideactdate) AS npideactdate FROM deact_panel GROUP BY 1),
    r AS (SELECT npi, max(npireactdate) AS npireactdate FROM react_panel GROUP BY 1),
    removed AS (SELECT d.npi, npideactdate FROM d LEFT JOIN r ON d.npi = r.npi
        WHERE npireactdate IS NULL OR npireactdate < npideactdate)"""


def _removed(t, entities=(1, 2)):
    return G.removals(G.latest_date(t.deact_panel, "npideactdate"),
                      G.latest_date(t.react_panel, "npireactdate"), t.entity, entities)


@query("d5_entity", ["entity_panel"], """
    SELECT DISTINCT npi, CAST(entity AS INT) AS entity FROM entity_panel WHERE entity IS NOT NULL""")
def _(t):
    return G.entity_types(t.entity_panel)


@query("d6_last_deactivation", ["deact_panel"], """
    SELECT npi, max(npideactdate) AS npideactdate FROM deact_panel GROUP BY 1""")
def _(t):
    return G.latest_date(t.deact_panel, "npideactdate")


@query("d7_removals", ["deact_panel", "react_panel", "entity"], f"""WITH {_REMOVED}
    SELECT removed.* FROM removed JOIN entity e ON removed.npi = e.npi WHERE entity = 1""")
def _(t):
    return _removed(t, 1)


@query("d8_legal_names", ["n_first", "entity"], """
    WITH v AS (SELECT DISTINCT n.npi, upper(pfname) AS pfname FROM n_first n JOIN entity e ON n.npi = e.npi WHERE entity = 1)
    SELECT npi, pfname FROM (SELECT *, count(pfname) OVER (PARTITION BY npi) AS k FROM v)
    WHERE pfname IS NOT NULL OR k = 0""")
def _(t):
    return G.legal_name_part(t.n_first, t.entity, "pfname")


@query("d9_other_names", ["o_first", "entity"], """
    SELECT DISTINCT n.npi, upper(pfnameoth) AS pfnameoth FROM o_first n JOIN entity e ON n.npi = e.npi
    WHERE entity = 1 AND pfnameoth IS NOT NULL""")
def _(t):
    return G.other_name_part(t.o_first, t.entity, "pfnameoth")


@query("d10_gender", ["panel", "entity"], """
    SELECT p.npi, arg_max(upper(status), (month, upper(status))) FILTER (WHERE status IS NOT NULL) AS pgender
    FROM panel p JOIN entity e ON p.npi = e.npi WHERE entity = 1 GROUP BY 1""")
def _(t):
    return G.gender(t.panel.select("npi", "month", F.col("status").alias("pgender")), t.entity)


@query("d11_enumeration", [], """
    SELECT DISTINCT c_custkey AS npi, DATE '2005-06-01' AS penumdate FROM customer WHERE c_custkey % 4 > 0""")
def _(t):
    day = F.when(F.col("c_custkey") % 4 > 0, F.lit("2005-06-01").cast("date"))
    return G.enumeration_dates(t.customer.select(F.col("c_custkey").alias("npi"),
                                                 day.alias("penumdate")))


_CREDS = """c1 AS (SELECT DISTINCT npi, trim(part) AS pcredential FROM (
        SELECT npi, unnest(string_split(replace(upper(pcredential), '.', ''), ',')) AS part
        FROM cred_panel WHERE pcredential IS NOT NULL AND npi IN (SELECT npi FROM entity WHERE entity = 1))),
    c2 AS (SELECT DISTINCT npi, trim(part) AS pcredential FROM (
        SELECT npi, unnest(string_split(replace(upper(pcredentialoth), '.', ''), ',')) AS part
        FROM credoth_panel WHERE pcredentialoth IS NOT NULL AND npi IN (SELECT npi FROM entity WHERE entity = 1))),
    cmap AS (SELECT * FROM (VALUES {values}) v(credential, cat)),
    creds AS (SELECT npi, pcredential, upper(replace(replace(pcredential, '.', ''), ' ', '')) AS pcredential_stripped, cat
        FROM (SELECT * FROM c1 UNION SELECT * FROM c2) u
        LEFT JOIN cmap ON credential = upper(replace(replace(pcredential, '.', ''), ' ', '')))""".replace(
    "{values}", ", ".join(f"('{c}', '{cat}')" for cat, cs in S.CREDENTIALS.items() for c in cs))


def _creds(t):
    return G.credentials(G.credential_parts(t.cred_panel, t.entity, "pcredential"),
                         G.credential_parts(t.credoth_panel, t.entity, "pcredentialoth"))


@query("d12_credential_parts", ["cred_panel", "credoth_panel", "entity"], f"WITH {_CREDS} SELECT * FROM c1")
def _(t):
    return G.credential_parts(t.cred_panel, t.entity, "pcredential")


@query("d13_credentials", ["cred_panel", "credoth_panel", "entity"], f"WITH {_CREDS} SELECT * FROM creds")
def _(t):
    return _creds(t)


_CODES = """codes AS (SELECT DISTINCT p.npi, p.ptaxcode FROM code_panel p JOIN entity e ON p.npi = e.npi WHERE entity = 1),
    detailed AS (SELECT c.npi, c.ptaxcode, Type, Classification, Specialization FROM codes c JOIN taxonomy x
        ON c.ptaxcode = x.TaxonomyCode),
    catmap AS (SELECT TaxonomyCode AS ptaxcode, CASE
        WHEN TaxonomyCode = '390200000X' THEN 'Student'
        WHEN Classification = 'Psychologist' THEN 'Psychologist' WHEN Classification = 'Optometrist' THEN 'Optometrist'
        WHEN Classification = 'Pharmacist' THEN 'Pharmacist' WHEN Classification = 'Podiatrist' THEN 'Podiatrist'
        WHEN Classification = 'Dentist' THEN 'Dentist' WHEN Classification = 'Chiropractor' THEN 'Chiropractor'
        WHEN TaxonomyCode = '367H00000X' THEN 'Other APRN'
        WHEN Type LIKE 'Nursing Service%' AND Classification IN ('Licensed Practical Nurse', 'Licensed Vocational Nurse') THEN 'LPN/LVN'
        WHEN Type LIKE 'Nursing Service%' AND Classification = 'Registered Nurse' THEN 'RN'
        WHEN Type LIKE 'Nursing Service%' THEN 'Other Nurse'
        WHEN Classification = 'Clinical Nurse Specialist' THEN 'CNS'
        WHEN Classification = 'Advanced Practice Midwife' THEN 'CNM'
        WHEN Classification = 'Nurse Anesthetist, Certified Registered' THEN 'CRNA'
        WHEN Type = 'Allopathic & Osteopathic Physicians' THEN 'MD/DO'
        WHEN Classification = 'Nurse Practitioner' THEN 'NP'
        WHEN Classification = 'Physician Assistant' THEN 'PA' END AS cat FROM taxonomy),
    catcodes AS (SELECT c.npi, c.ptaxcode, m.cat FROM codes c LEFT JOIN catmap m ON c.ptaxcode = m.ptaxcode)"""


def _codes(t):
    return G.taxonomy_codes(t.code_panel, t.entity, 1)


@query("d14_taxonomy_details", ["code_panel", "entity", "taxonomy"], f"WITH {_CODES} SELECT * FROM detailed")
def _(t):
    return G.taxonomy_codes(t.code_panel, t.entity, 1, t.taxonomy)


@query("d15_code_categories", ["code_panel", "entity", "taxonomy"], f"WITH {_CODES} SELECT * FROM catcodes")
def _(t):
    return G.categorized_codes(_codes(t), t.taxonomy)


_TYPES = _CREDS + ", " + _CODES + ", allcats AS (SELECT npi, coalesce(cat, 'No Category') AS cat FROM creds " \
    "UNION ALL SELECT npi, coalesce(cat, 'No Category') FROM catcodes), wide AS (SELECT npi, " + ", ".join(
        f"max((cat = '{c}')::INT) AS \"{c}\"" for c in S.PRACTITIONER_TYPES) + \
    " FROM allcats GROUP BY 1), ptypes AS (SELECT * REPLACE (CASE WHEN hit THEN 0 ELSE \"Student\" END AS \"Student\", " \
    "CASE WHEN hit THEN 0 ELSE \"No Category\" END AS \"No Category\") FROM (SELECT *, (" + " + ".join(
        f'"{c}"' for c in S.PRACTITIONER_TYPES[:-2]) + ") > 0 AS hit FROM wide))"


def _types(t):
    return G.practitioner_types(_creds(t), G.categorized_codes(_codes(t), t.taxonomy))


@query("d16_types", ["cred_panel", "credoth_panel", "code_panel", "entity", "taxonomy"],
       f"WITH {_TYPES} SELECT * EXCLUDE (hit) FROM ptypes")
def _(t):
    return _types(t)


@query("d16_types_long", ["cred_panel", "credoth_panel", "code_panel", "entity", "taxonomy"],
       f"""WITH {_TYPES} SELECT npi, 'MD/DO' AS "PractitionerType" FROM ptypes WHERE "MD/DO" = 1
       UNION ALL SELECT npi, 'NP' FROM ptypes WHERE "NP" = 1 UNION ALL SELECT npi, 'PA' FROM ptypes WHERE "PA" = 1""")
def _(t):
    return G.practitioner_types_long(_types(t))


@query("d17_licences", ["licence_state", "licence_number", "ends"], """
    WITH a AS (SELECT s.* FROM licence_state s LEFT JOIN ends e ON s.npi = e.npi WHERE npideactdate IS NULL OR month <= npideactdate),
    b AS (SELECT s.* FROM licence_number s LEFT JOIN ends e ON s.npi = e.npi WHERE npideactdate IS NULL OR month <= npideactdate)
    SELECT DISTINCT coalesce(a.npi, b.npi) AS npi, PLICNUM, PLICSTATE FROM a FULL JOIN b
      ON a.npi = b.npi AND a.month = b.month AND a.seq = b.seq""")
def _(t):
    return G.licences(t.licence_state, t.licence_number, t.ends)


@query("d18_addresses", ["phone_panel", "entity", "ends"], """
    SELECT p.npi, month, rid, upper(replace(replace(replace(replace(string_split(ploctel, '.')[1], '-', ''), '(', ''), ')', ''), ' ', '')) AS ploctel
    FROM phone_panel p JOIN entity n ON p.npi = n.npi AND entity = 1 LEFT JOIN ends e ON p.npi = e.npi
    WHERE npideactdate IS NULL OR month <= npideactdate""")
def _(t):
    return G.address_part(t.phone_panel, t.entity, t.ends, "ploctel", 1)


@query("d19_secondary_locations", ["licence_state", "licence_number"], """
    SELECT a.npi, a.month, a.seq, PLICSTATE AS ploc2statename, PLICNUM AS ploc2zip, PLICNUM AS ploc2tel
    FROM licence_state a JOIN licence_number b ON a.npi = b.npi AND a.month = b.month AND a.seq = b.seq""")
def _(t):
    return G.secondary_locations([
        t.licence_state.withColumnRenamed("PLICSTATE", "ploc2statename"),
        t.licence_number.withColumnRenamed("PLICNUM", "ploc2zip"),
        t.licence_number.withColumnRenamed("PLICNUM", "ploc2tel")])


@query("d25_credential_pairs", ["cred_panel", "credoth_panel", "code_panel", "entity", "taxonomy"], f"""
    WITH {_CREDS}, {_CODES}
    SELECT Classification, count(*) AS n FROM (SELECT DISTINCT npi FROM creds WHERE pcredential_stripped = 'MD') w
    JOIN codes c ON w.npi = c.npi JOIN taxonomy x ON c.ptaxcode = x.TaxonomyCode GROUP BY 1""")
def _(t):
    return G.credential_classification_pairs(_creds(t), _codes(t), t.taxonomy, credential="MD")


@query("d25_classification_pairs", ["cred_panel", "credoth_panel", "code_panel", "entity", "taxonomy"], f"""
    WITH {_CREDS}, {_CODES}
    SELECT pcredential_stripped, count(*) AS n FROM (SELECT DISTINCT npi FROM codes c JOIN taxonomy x
        ON c.ptaxcode = x.TaxonomyCode WHERE Classification = 'Dentist') w
    JOIN creds c ON w.npi = c.npi GROUP BY 1""")
def _(t):
    return G.credential_classification_pairs(_creds(t), _codes(t), t.taxonomy,
                                             classification="Dentist")


@query("d26_likely_doctors", ["cred_panel", "credoth_panel", "code_panel", "entity", "taxonomy"], f"""
    WITH {_CREDS}, {_CODES}
    SELECT npi FROM creds WHERE pcredential_stripped IN ('MD', 'DO') UNION
    SELECT npi FROM catcodes WHERE cat IN ('MD/DO', 'MD/DO Student')""")
def _(t):
    return G.likely_doctors(_creds(t), G.categorized_codes(_codes(t), t.taxonomy))


_OTHER = """o AS (SELECT i.npi, i.month, i.seq, OTHPID, OTHPIDST, OTHPIDTY FROM other_ids i
      LEFT JOIN other_id_states s ON i.npi = s.npi AND i.month = s.month AND i.seq = s.seq
      LEFT JOIN other_id_types k ON i.npi = k.npi AND i.month = k.month AND i.seq = k.seq),
    who AS (SELECT DISTINCT npi FROM o WHERE OTHPIDTY = 5 AND OTHPIDST = 'IL')"""


def _medicaid(t):
    ids = G.other_id_rows(t.other_ids, t.other_id_states, t.other_id_types)
    return G.medicaid_providers(ids, [t.panel.select("npi", "month", "value").distinct(),
                                      t.entity_panel.distinct()],
                                t.licence_state, t.licence_number, t.code_panel, "IL")


@query("d27_medicaid_ids", ["other_ids", "other_id_states", "other_id_types"], f"""WITH {_OTHER}
    SELECT * FROM o WHERE npi IN (SELECT npi FROM who)""")
def _(t):
    return _medicaid(t)["other_ids"]


@query("d27_medicaid_attributes", ["other_ids", "other_id_states", "other_id_types", "panel", "entity_panel"], f"""
    WITH {_OTHER}, a AS (SELECT DISTINCT npi, month, value FROM panel WHERE npi IN (SELECT npi FROM who)),
    b AS (SELECT DISTINCT npi, month, entity FROM entity_panel WHERE npi IN (SELECT npi FROM who))
    SELECT coalesce(a.npi, b.npi) AS npi, coalesce(a.month, b.month) AS month, value, entity
    FROM a FULL JOIN b ON a.npi = b.npi AND a.month = b.month""")
def _(t):
    return _medicaid(t)["attributes"]


@query("d27_medicaid_licences", ["other_ids", "other_id_states", "other_id_types", "licence_state", "licence_number"], f"""
    WITH {_OTHER}, a AS (SELECT * FROM licence_state WHERE npi IN (SELECT npi FROM who)),
    b AS (SELECT * FROM licence_number WHERE npi IN (SELECT npi FROM who))
    SELECT npi, month, seq, PLICSTATE, PLICNUM FROM a FULL JOIN b USING (npi, month, seq)""")
def _(t):
    return _medicaid(t)["licences"]


@query("d27_medicaid_taxonomy", ["other_ids", "other_id_states", "other_id_types", "code_panel"], f"""
    WITH {_OTHER} SELECT * FROM code_panel WHERE npi IN (SELECT npi FROM who)""")
def _(t):
    return _medicaid(t)["taxonomy"]


@query("d28_removals_report",
       ["deact_panel", "react_panel", "entity", "cred_panel", "credoth_panel", "code_panel",
        "taxonomy", "panel", "person_names"], f"""
    WITH {_REMOVED}, {_TYPES},
    st AS (SELECT npi, arg_max(status, (month, status)) FILTER (WHERE status IS NOT NULL) AS state FROM panel GROUP BY 1),
    act AS (SELECT o_custkey AS npi, CAST(max(year(o_orderdate)) AS INT) AS "PartB_Max_Year" FROM orders GROUP BY 1)
    SELECT r.npi, npideactdate, pcredential, cat, state, pfname, pmname, plname, pnamesuffix, "PartB_Max_Year"
    FROM removed r JOIN entity e ON r.npi = e.npi AND entity = 1
    JOIN ptypes p ON r.npi = p.npi JOIN creds c ON r.npi = c.npi JOIN st ON r.npi = st.npi
    JOIN person_names n ON r.npi = n.npi LEFT JOIN act ON r.npi = act.npi
    WHERE "MD/DO" + "CNM" + "CNS" + "CRNA" + "NP" + "Other APRN" + "PA" + "RN" + "LPN/LVN" + "Other Nurse" + "Student" > 0
    ORDER BY npideactdate DESC, r.npi DESC, pcredential DESC NULLS LAST LIMIT 60""")
def _(t):
    act = (t.orders.groupBy(F.col("o_custkey").alias("npi"))
           .agg(F.max(F.year("o_orderdate")).alias("PartB_Max_Year")))
    state = G.last_observed(t.panel.select("npi", "month", F.col("status").alias("state")), ["state"])
    return G.removals_report(_removed(t, 1), _types(t), _creds(t), state, t.person_names, act)


@query("d29_last_practice", ["directory"], """
    SELECT npi, arg_max(org_name, (date, org_name)) FILTER (WHERE org_name IS NOT NULL) AS org_name,
      arg_max(group_id, (date, group_id)) FILTER (WHERE group_id IS NOT NULL) AS group_id,
      arg_max(group_size, (date, group_size)) FILTER (WHERE group_size IS NOT NULL) AS group_size
    FROM directory GROUP BY 1""")
def _(t):
    from rosterlake.plans.directory import last_place_practiced
    return last_place_practiced(t.directory, ["org_name", "group_id", "group_size"])


@query("d30_detail_codes", ["code_panel", "entity", "taxonomy"], f"""WITH {_CODES},
    k AS (SELECT *, count(*) OVER (PARTITION BY npi, Type, Classification) AS n FROM detailed)
    SELECT npi, ptaxcode, Type, Classification, Specialization FROM k WHERE NOT (n > 1 AND Specialization IS NULL)""")
def _(t):
    return G.detailed_codes(G.taxonomy_codes(t.code_panel, t.entity, 1, t.taxonomy))


@query("d30_numbered_codes", ["code_panel", "entity", "taxonomy"], f"""WITH {_CODES},
    k AS (SELECT *, row_number() OVER (PARTITION BY npi ORDER BY ptaxcode) AS n FROM detailed)
    SELECT npi, max(CASE WHEN n = 1 THEN ptaxcode END) AS ptaxcode1, max(CASE WHEN n = 1 THEN Type END) AS Type1,
      max(CASE WHEN n = 1 THEN Classification END) AS Classification1, max(CASE WHEN n = 1 THEN Specialization END) AS Specialization1,
      count(*) AS n_codes FROM k GROUP BY 1""")
def _(t):
    from rosterlake.operators.reshape import widest
    codes = G.taxonomy_codes(t.code_panel, t.entity, 1, t.taxonomy)
    width = widest(codes, ["npi"], ["ptaxcode"])
    wide = G.numbered_codes(codes, width)
    n = sum((F.col(f"ptaxcode{i}").isNotNull().cast("bigint") for i in range(2, width + 1)),
            F.col("ptaxcode1").isNotNull().cast("bigint"))
    return wide.select("npi", "ptaxcode1", "Type1", "Classification1", "Specialization1",
                       n.alias("n_codes"))


@query("d30_latest_phone", ["phone_panel"], """
    SELECT npi, month, ploctel FROM (SELECT *, row_number() OVER (PARTITION BY npi
      ORDER BY month DESC, ploctel DESC NULLS LAST) AS n FROM phone_panel) WHERE n = 1""")
def _(t):
    return G.latest_phone(t.phone_panel)


_PLACES = """rows_ AS (SELECT *, substr(ploczip, 1, 5) AS zip FROM addresses),
    people AS (SELECT DISTINCT npi, plocline1, plocline2, ploccityname, plocstatename, ploczip, ploctel, zip FROM rows_
      WHERE (plocline1 IS NULL)::INT + (plocline2 IS NULL)::INT + (ploccityname IS NULL)::INT + (plocstatename IS NULL)::INT
        + (ploczip IS NULL)::INT + (ploctel IS NULL)::INT + (zip IS NULL)::INT <> 6),
    locs AS (SELECT *, row_number() OVER (ORDER BY ploctel NULLS FIRST, zip NULLS FIRST, plocstatename NULLS FIRST) - 1 AS location_no
      FROM (SELECT DISTINCT ploctel, zip, plocstatename FROM people))"""


@query("d31_shared_locations", ["addresses"], f"""WITH {_PLACES}
    SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY ploctel, zip, plocstatename) AS n FROM people) WHERE n > 1""")
def _(t):
    return G.practice_locations(t.addresses)[0]


@query("d31_nearest_location", ["addresses", "waiver_dates"], f"""WITH {_PLACES},
    x AS (SELECT w.npi, w.Date, location_no, abs(r.month - CAST(date_trunc('month', w.Date) AS DATE)) AS gap
      FROM waiver_dates w JOIN rows_ r ON w.npi = r.npi JOIN locs l ON r.ploctel IS NOT DISTINCT FROM l.ploctel
        AND r.zip IS NOT DISTINCT FROM l.zip AND r.plocstatename IS NOT DISTINCT FROM l.plocstatename)
    SELECT DISTINCT npi, Date, location_no FROM (SELECT *, min(gap) OVER (PARTITION BY npi, Date) AS m FROM x) WHERE gap = m""")
def _(t):
    _, numbered = G.practice_locations(t.addresses)
    return G.nearest_location(t.addresses, numbered, t.waiver_dates)


# ----------------------------------------------------------------- refresh

_WEEKS = """w AS (SELECT npi, CAST(date_trunc('month', week) AS DATE) AS month,
      arg_max(value, (week, value)) AS value FROM weekly WHERE value IS NOT NULL GROUP BY 1, 2)"""


@query("d2_weekly_fold", ["weekly"], f"WITH {_WEEKS} SELECT * FROM w")
def _(t):
    return P.fold_weeks(t.weekly, "value")


@query("d1_monthly_with_weeks", ["weekly", "monthly"], f"""WITH {_WEEKS}
    SELECT coalesce(m.npi, w.npi) AS npi, coalesce(m.month, w.month) AS month,
      CASE WHEN w.npi IS NULL THEN m.value ELSE w.value END AS value
    FROM monthly m FULL JOIN w ON m.npi = w.npi AND m.month = w.month""")
def _(t):
    return P.with_weeks(t.monthly, t.weekly, "value")


@query("d3_refresh", ["panel"], """
    WITH o AS (SELECT npi, month, max(value) AS value FROM panel GROUP BY 1, 2)
    SELECT npi, month, value FROM o WHERE month < DATE '2001-02-01'
    UNION ALL SELECT npi, month, coalesce(value, 'late') FROM o WHERE month >= DATE '2001-02-01'""")
def _(t):
    stored = t.panel.groupBy("npi", "month").agg(F.max("value").alias("value"))
    remade = (stored.where(F.col("month") >= F.lit("2001-02-01").cast("date"))
              .withColumn("value", F.coalesce("value", F.lit("late"))))
    return P.refreshed(stored, remade)


@query("s18_panel_round_trip", ["panel"], """
    SELECT npi, month, max(value) AS pgender FROM panel GROUP BY 1, 2""")
def _(t):
    """Write a panel by month, then read it for its ids."""
    from rosterlake.session import work_path
    from rosterlake.sources.panels import read_panel, write_panel
    root = work_path(t.spark, "panel")
    write_panel(t.panel.groupBy("npi", "month").agg(F.max("value").alias("pgender")), root, "pgender")
    return read_panel(t.spark, root, "pgender", t.customer.select(F.col("c_custkey").alias("npi")))


@query("s2_snapshot_scan", [], """
    SELECT c_custkey AS npi, CAST(seq AS INT) AS seq, v AS ptaxcode, DATE '2014-08-01' AS month FROM (
      SELECT c_custkey, 1 AS seq, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS v FROM customer
      UNION ALL SELECT c_custkey, 12, '0' || CAST(c_nationkey AS VARCHAR) FROM customer) WHERE v IS NOT NULL""")
def _(t):
    """Land a wide snapshot as text, then scan one repeated variable of it."""
    from rosterlake.session import work_path
    from rosterlake.sources.files import list_files, paths_of, snapshot_files, snapshot_month
    from rosterlake.sources.panels import read_snapshots
    stem = S.SLOT_STEMS["ptaxcode"][0]
    root = work_path(t.spark, "landing")
    wide = t.customer.select(
        F.col("c_custkey").alias("NPI"), F.col("c_name").alias("Provider First Name"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias(f"{stem}_1"),
        F.concat(F.lit("0"), F.col("c_nationkey").cast("string")).alias(f"{stem}_12"))
    (wide.write.option("header", "true")
     .csv(f"{root}/NPPES_Data_Dissemination_August_2014/npidata_20050523-20140810.csv"))
    found = snapshot_files(list_files(t.spark, root, "*.csv"))
    return read_snapshots(t.spark, paths_of(found), "ptaxcode", {"month": snapshot_month("__path")})


# ------------------------------------------------------------------- names

_FULL = """fn AS (SELECT npi, upper(pfname) AS pfname FROM n_first), lg AS (
      SELECT DISTINCT f.npi, pfname, pmname, plname, pnamesuffix FROM n_first f FULL JOIN n_last l ON f.npi = l.npi
      FULL JOIN n_middle m ON coalesce(f.npi, l.npi) = m.npi FULL JOIN n_suffix s ON m.npi = s.npi),
    ids AS (SELECT npi FROM o_first UNION SELECT npi FROM o_last UNION SELECT npi FROM o_middle UNION SELECT npi FROM o_suffix),
    alt AS (SELECT i.npi, a.pfnameoth AS f, b.plnameoth AS l, c.pmnameoth AS m, d.pnamesuffixoth AS s FROM ids i
      LEFT JOIN o_first a ON i.npi = a.npi LEFT JOIN o_last b ON i.npi = b.npi
      LEFT JOIN o_middle c ON i.npi = c.npi LEFT JOIN o_suffix d ON i.npi = d.npi),
    alt2 AS (SELECT a.npi, coalesce(f, pfname) AS pfname, coalesce(m, pmname) AS pmname, coalesce(l, plname) AS plname,
        coalesce(s, pnamesuffix) AS pnamesuffix FROM alt a LEFT JOIN lg ON a.npi = lg.npi
      UNION SELECT a.npi, coalesce(f, pfname), m, coalesce(l, plname), s FROM alt a LEFT JOIN lg ON a.npi = lg.npi),
    fulln AS (SELECT *, 0 AS othflag FROM lg UNION ALL
      SELECT *, 1 FROM (SELECT * FROM alt2 EXCEPT SELECT * FROM lg))"""
_FULL_USES = ["n_first", "n_middle", "n_last", "n_suffix", "o_first", "o_middle", "o_last", "o_suffix"]


def _full(t):
    legal = {"pfname": t.n_first, "pmname": t.n_middle, "plname": t.n_last, "pnamesuffix": t.n_suffix}
    other = {"pfname": t.o_first, "pmname": t.o_middle, "plname": t.o_last, "pnamesuffix": t.o_suffix}
    return N.full_names({p: d.distinct() for p, d in legal.items()},
                        {p: d.distinct() for p, d in other.items()})


@query("d20_fullnames", _FULL_USES, f"WITH {_FULL} SELECT * FROM fulln")
def _(t):
    return _full(t)


_PURGE_TESTS = [(c, s) for s in ["?", "+", "[", "]", ";"] for c in ("pfname", "pmname", "plname")]
_PURGED = "p0 AS (SELECT * FROM fulln), " + ", ".join(
    f"p{i + 1} AS (SELECT * EXCLUDE (bad, clean) FROM (SELECT *, max(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY npi) AS clean "
    f"FROM (SELECT *, coalesce(contains({c}, '{s}'), false) AS bad FROM p{i})) WHERE NOT bad OR clean = 0)"
    for i, (c, s) in enumerate(_PURGE_TESTS))


@query("i5_purge_symbol", _FULL_USES, f"WITH {_FULL}, {_PURGED} SELECT * FROM p{len(_PURGE_TESTS)}")
def _(t):
    return I.purge_symbols(_full(t), ["pfname", "pmname", "plname"], ["?", "+", "[", "]", ";"], ["npi"])


def _strip(c):
    return f"replace(replace(replace(replace(trim({c}), '+', ''), '[', ''), ']', ''), ';', '')"


_CLEAN = f"""c1 AS (SELECT npi, coalesce({_strip('pfname')}, '') AS pfname,
      coalesce({_strip("regexp_replace(pmname, '^([A-Za-z]?)[.]$', '" + chr(92) + "1')")}, '') AS pmname,
      coalesce({_strip('plname')}, '') AS plname,
      coalesce(pnamesuffix, '') AS pnamesuffix, othflag FROM p{len(_PURGE_TESTS)}),
    c2 AS (SELECT npi, pfname, pmname, plname, min(pnamesuffix) AS pnamesuffix, min(othflag) AS othflag FROM c1 GROUP BY ALL),
    c2b AS (SELECT npi, pfname, pmname, plname, min(pnamesuffix) AS pnamesuffix, min(othflag) AS othflag FROM c2 GROUP BY 1, 2, 3, 4),
    c3 AS (SELECT * FROM c2b WHERE NOT contains(plname, '(')
      UNION SELECT npi, pfname, pmname, trim(string_split(plname, '(')[1]), pnamesuffix, othflag FROM c2b WHERE contains(plname, '(')
      UNION SELECT npi, pfname, pmname, trim(replace(replace(string_split(string_split(plname, '(')[2], ')')[1], 'MAIDEN', ''), ', ', '')), pnamesuffix, othflag
        FROM c2b WHERE contains(plname, '(')),
    c4 AS (SELECT npi, pfname, pmname, plname, min(pnamesuffix) AS pnamesuffix, CAST(min(othflag) AS INT) AS othflag FROM c3
      WHERE NOT contains(plname, ')') GROUP BY 1, 2, 3, 4)"""


@query("d21_clean_fullnames", _FULL_USES, f"WITH {_FULL}, {_PURGED}, {_CLEAN} SELECT * FROM c4")
def _(t):
    return N.clean_full_names(_full(t))


@query("d22_parens", ["person_names"], """
    WITH b AS (SELECT npi, pfname || CASE WHEN npi % 9 = 0 THEN ' (LEGAL NAME ANNE)' ELSE '' END AS pfname, pmname,
      CASE npi % 8 WHEN 0 THEN plname || ' (FORMERLY DOE) REED' WHEN 1 THEN plname || ' (OR) KANE' WHEN 2 THEN 'BAD) NAME'
        ELSE plname END AS plname, pnamesuffix, 0 AS othflag FROM person_names),
    l AS (SELECT npi, pfname, pmname, plname, pnamesuffix, othflag FROM b WHERE npi % 8 > 2
      UNION ALL SELECT npi, pfname, pmname, replace(trim(string_split(plname, '(')[1]), ', ', ''), pnamesuffix, othflag FROM b WHERE npi % 8 IN (0, 1)
      UNION ALL SELECT npi, pfname, pmname, 'DOE', pnamesuffix, othflag FROM b WHERE npi % 8 = 0
      UNION ALL SELECT npi, pfname, pmname, CASE WHEN npi % 8 = 0 THEN 'REED' ELSE 'KANE' END, pnamesuffix, othflag FROM b WHERE npi % 8 IN (0, 1))
    SELECT npi, trim(string_split(pfname, '(')[1]) AS pfname, pmname, plname, pnamesuffix, othflag FROM l
    UNION SELECT npi, 'ANNE', pmname, plname, pnamesuffix, othflag FROM l WHERE npi % 9 = 0""")
def _(t):
    k = F.col("npi") % 8
    b = (t.person_names
         .withColumn("pfname", F.when(F.col("npi") % 9 == 0, F.concat("pfname", F.lit(" (LEGAL NAME ANNE)"))).otherwise(F.col("pfname")))
         .withColumn("plname", F.when(k == 0, F.concat("plname", F.lit(" (FORMERLY DOE) REED")))
                     .when(k == 1, F.concat("plname", F.lit(" (OR) KANE")))
                     .when(k == 2, F.lit("BAD) NAME")).otherwise(F.col("plname")))
         .withColumn("othflag", F.lit(0)))
    return N.resolve_parentheses(b)


_VARIANTS = """m AS (SELECT npi, pfname AS f, pmname AS mid, plname AS l, pnamesuffix AS s FROM person_names
      UNION SELECT npi, pfname, substr(pmname, 1, 1), plname, pnamesuffix FROM person_names
      UNION SELECT npi, pfname, '', plname, pnamesuffix FROM person_names),
    v AS (SELECT * FROM m UNION SELECT npi, replace(f, '.', ''), replace(mid, '.', ''), replace(l, '.', ''), s FROM m)"""
_NAMED = """named AS (SELECT *, CASE WHEN mid = '' THEN f || ' ' || l ELSE f || ' ' || mid || ' ' || l END AS n FROM {src}),
    outn AS (SELECT npi, f AS pfname, mid AS pmname, l AS plname, '' AS pnamesuffix, n AS name FROM named
      UNION SELECT npi, f, mid, l, s, n || ' ' || s FROM named WHERE s <> '')"""


@query("d23_variants", ["person_names"], f"WITH {_VARIANTS}, {_NAMED.replace('{src}', 'v')} SELECT * FROM outn")
def _(t):
    return N.expand_names(t.person_names, "npi", "pfname", "pmname", "plname", "pnamesuffix")


_SUFFIXED = f"""known AS (SELECT DISTINCT pnamesuffix AS s FROM person_names WHERE pnamesuffix <> ''
      UNION SELECT DISTINCT array_to_string(string_split(pnamesuffix, ''), ' ') FROM person_names WHERE pnamesuffix <> ''),
    cuts AS (SELECT DISTINCT v.l, k.s, trim(regexp_replace(trim(substr(v.l, 1, length(v.l) - length(k.s) - 1)), ',$', '')) AS kept
        FROM (SELECT DISTINCT l FROM v) v JOIN known k ON ends_with(v.l, ' ' || k.s) OR ends_with(v.l, ',' || k.s)
      UNION SELECT DISTINCT v.l, k.s, trim(regexp_replace(trim(substr(v.l, 1, length(v.l) - length(k.s))), ',$', ''))
        FROM (SELECT DISTINCT l FROM v) v JOIN known k ON ends_with(v.l, k.s) WHERE k.s IN ('JR', 'III', 'VIII')),
    best AS (SELECT l, max((length(s), s, kept)) AS b FROM cuts GROUP BY 1),
    w AS (SELECT npi, f, mid, CASE WHEN b IS NULL THEN v.l ELSE b[3] END AS l, CASE WHEN b IS NULL THEN v.s ELSE b[2] END AS s
      FROM v LEFT JOIN best ON v.l = best.l), {_NAMED.replace('{src}', 'w')}"""


@query("d24_suffix", ["person_names"], f"WITH {_VARIANTS}, {_SUFFIXED} SELECT * FROM outn")
def _(t):
    return N.expand_names(t.person_names, "npi", "pfname", "pmname", "plname", "pnamesuffix",
                          suffix_in_last=True)


@query("d23_expanded_fullnames", _FULL_USES, f"""WITH {_FULL}, {_PURGED}, {_CLEAN},
    person_names AS (SELECT npi, pfname, pmname, plname, pnamesuffix FROM c4), {_VARIANTS}, {_SUFFIXED} SELECT * FROM outn""")
def _(t):
    """Cleaned full names spelled out, suffixes taken out of last names."""
    return N.expand_names(N.clean_full_names(_full(t)), "npi", "pfname", "pmname", "plname",
                          "pnamesuffix", suffix_in_last=True)


@query("l11_reconcat", ["person_names"], """
    WITH n AS (SELECT npi, pfname, pmname, plname, pnamesuffix, string_split(trim(regexp_replace(pfname || ' ' || pmname || ' ' || plname, ' +', ' ', 'g')), ' ') AS a FROM person_names)
    SELECT npi, pfname, pmname, plname, pnamesuffix, a[1] AS pfname_r, array_to_string(a[2:len(a) - 1], ' ') AS pmname_r, a[-1] AS plname_r FROM n""")
def _(t):
    return N.reconcat(t.person_names, "pfname", "pmname", "plname")


@query("l1_strip_suffix", ["listed_people"], """
    WITH b AS (SELECT samhsa_id, regexp_replace(NameFull, '(.*[A-Z]) ?(, M[.]D[.], PHD|, III, M[.] D[.]|JR[.] MD)$', '\\1') AS x, NameFull FROM listed_people)
    SELECT samhsa_id, regexp_replace(CASE samhsa_id % 10 WHEN 0 THEN replace(NameFull, ' M.D.', '')
      WHEN 1 THEN replace(NameFull, ', M.D., PHD', '') WHEN 2 THEN replace(NameFull, ' JR. MD', '')
      WHEN 3 THEN replace(NameFull, ', III, M. D.', '') WHEN 4 THEN replace(NameFull, ' NP FNP-BC', '')
      WHEN 5 THEN replace(NameFull, ' D.O.,', '') WHEN 6 THEN replace(NameFull, ' SR', '') ELSE NameFull END,
      ' Q[.] ', ' Q ') AS NameFull FROM b""")
def _(t):
    return N.strip_endings(t.listed_people, "NameFull", S.NAME_ENDINGS).drop("stripped")


@query("l2_suffix_tokens", ["listed_people"], """
    SELECT samhsa_id, CASE samhsa_id % 10 WHEN 2 THEN 'JR' WHEN 3 THEN 'III' ELSE 'SR' END AS "Suffix"
    FROM listed_people WHERE samhsa_id % 10 IN (2, 3, 6)""")
def _(t):
    return N.suffix_tokens(N.strip_endings(t.listed_people, "NameFull", S.NAME_ENDINGS), "samhsa_id")


@query("l3_listed_names", ["listed_people"], """
    WITH b AS (SELECT samhsa_id, string_split(NameFull, ' ')[1] AS f,
        CASE samhsa_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'Q' ELSE string_split(regexp_replace(NameFull, ' +', ' ', 'g'), ' ')[2] END AS mid,
        regexp_extract(NameFull, '([A-Z]+[0-9]+)', 1) AS l,
        CASE samhsa_id % 10 WHEN 2 THEN 'JR' WHEN 3 THEN 'III' WHEN 6 THEN 'SR' ELSE '' END AS s FROM listed_people),
    m AS (SELECT * FROM b UNION SELECT samhsa_id, f, substr(mid, 1, 1), l, s FROM b UNION SELECT samhsa_id, f, '', l, s FROM b),
    n AS (SELECT *, CASE WHEN mid = '' THEN f || ' ' || l ELSE f || ' ' || mid || ' ' || l END AS nm FROM m),
    o AS (SELECT samhsa_id, f, mid, l, '' AS s, nm FROM n UNION SELECT samhsa_id, f, mid, l, s, nm || ' ' || s FROM n WHERE s <> '')
    SELECT samhsa_id, f AS firstname, mid AS middlename, l AS lastname, s AS "Suffix", nm AS name,
      CAST(row_number() OVER (PARTITION BY samhsa_id ORDER BY s DESC, mid DESC, nm DESC) AS INT) AS "order" FROM o""")
def _(t):
    return N.listed_names(t.listed_people)[0]
