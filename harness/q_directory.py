"""Imputation, directory dataflows and claims reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness.q_registry import _SUFFIXED, _VARIANTS
from harness.registry import query
from rosterlake.operators import impute as I
from rosterlake.plans import claims as C
from rosterlake.plans import directory as D
from rosterlake.session import cut
from rosterlake.sources import licences as L


def _fill_sql(src: str, out: str, ids: list[str], targets: list[str], columns: list[str],
              nullable: tuple[str, ...] = (), distinct: bool = True) -> str:
    """SQL of a consistent-value fill, by windows."""
    part = ", ".join(ids)
    ok = " AND ".join(f"{i} IS NOT NULL" for i in ids if i not in nullable) or "true"
    cols = ", ".join(
        f"CASE WHEN {c} IS NULL AND {ok} AND min({c}) OVER (PARTITION BY {part}) = max({c}) OVER (PARTITION BY {part}) "
        f"THEN max({c}) OVER (PARTITION BY {part}) ELSE {c} END AS {c}" if c in targets else c for c in columns)
    return f"{out} AS (SELECT {'DISTINCT' if distinct else ''} {cols} FROM {src})"


@query("i1_consistent", ["directory"], """
    SELECT npi, state, zip, phone, min(group_id) AS group_id FROM directory
    WHERE npi IS NOT NULL AND state IS NOT NULL AND zip IS NOT NULL AND group_id IS NOT NULL
    GROUP BY 1, 2, 3, 4 HAVING min(group_id) = max(group_id)""")
def _(t):
    return I.consistent_value(t.directory, ["npi", "state", "zip", "phone"], "group_id",
                              blank_ids=["phone"])


@query("i1_consistent_tuple", ["directory"], """
    WITH d AS (SELECT DISTINCT npi, state, zip, org_name, phone, group_id FROM directory
      WHERE org_name IS NOT NULL OR phone IS NOT NULL OR group_id IS NOT NULL)
    SELECT npi, state, zip, org_name, phone, group_id FROM (SELECT *, count(*) OVER (PARTITION BY npi, state, zip) AS n FROM d)
    WHERE n = 1""")
def _(t):
    return I.consistent_tuple(t.directory, ["npi", "state", "zip"], ["org_name", "phone", "group_id"])


@query("i2_fill_from_lookup", ["directory"], """
    WITH k AS (SELECT npi, group_id, max(org_name) AS org_name FROM directory WHERE group_id IS NOT NULL AND org_name IS NOT NULL
      GROUP BY 1, 2 HAVING min(org_name) = max(org_name))
    SELECT d.npi, d.date, d.group_id, coalesce(d.org_name, k.org_name) AS org_name, d.phone
    FROM directory d LEFT JOIN k ON d.npi = k.npi AND d.group_id = k.group_id""")
def _(t):
    d = t.directory.select("npi", "date", "group_id", "org_name", "phone")
    return I.fill_from(d, I.consistent_value(d, ["npi", "group_id"], "org_name"), ["npi", "group_id"])


_COLS = ["npi", "date", "org_name", "group_id", "group_size", "state", "zip", "phone"]
_TARGETS = ["zip", "org_name", "group_size", "state", "phone"]


@query("i3_batch_fill", ["directory"], "WITH " + _fill_sql(
    "directory", "f", ["npi", "group_id"], _TARGETS, _COLS) + " SELECT * FROM f")
def _(t):
    return I.batch_fill(t.directory, ["npi", "group_id"], _TARGETS)


@query("i4_purge_nulls", ["panel"], """
    SELECT npi, month, rid, value FROM (SELECT *, count(value) OVER (PARTITION BY npi, month) AS k FROM panel)
    WHERE value IS NOT NULL OR k = 0""")
def _(t):
    return I.purge_nulls(t.panel.drop("status"), "value", ["npi", "month"])


_ZIPS = """z1 AS (SELECT npi, date, group_id, state, CASE WHEN length(zip) IN (4, 8) AND state IN
        ('CT', 'MA', 'ME', 'NH', 'NJ', 'PR', 'RI', 'VT', 'VI') THEN '0' || zip ELSE zip END AS zip, phone FROM raw_directory),
    gz AS (SELECT DISTINCT group_id, zip FROM z1 WHERE group_id IS NOT NULL),
    z2 AS (SELECT npi, date, z1.group_id, state, CASE WHEN length(z1.zip) IN (3, 7) AND b.zip IS NOT NULL THEN b.zip ELSE z1.zip END AS zip, phone
      FROM z1 LEFT JOIN gz b ON z1.group_id = b.group_id AND b.zip = '00' || z1.zip)"""


@query("i6_zip_repair", ["raw_directory"], f"WITH {_ZIPS} SELECT * FROM z2")
def _(t):
    return I.repair_zips(t.raw_directory)


_PHONES = """h0 AS (SELECT npi, date, group_id, state, zip, CASE WHEN length(string_split(phone, '.')[1]) >= 10
        THEN string_split(phone, '.')[1] END AS phone FROM {src}), """ + _fill_sql(
    "h0", "h1", ["npi", "group_id", "state", "zip"], ["phone"], ["npi", "date", "group_id", "state", "zip", "phone"],
    ("npi", "group_id", "state", "zip"), False) + ", " + _fill_sql(
    "h1", "h2", ["date", "group_id", "state", "zip"], ["phone"], ["npi", "date", "group_id", "state", "zip", "phone"],
    ("date", "group_id", "state", "zip"), False)


@query("i7_phone_repair", ["raw_directory"], f"WITH {_PHONES.replace('{src}', 'raw_directory')} SELECT * FROM h2")
def _(t):
    return I.repair_phones(t.raw_directory)


@query("m3_repaired_directory", ["raw_directory"],
       f"""WITH {_ZIPS}, {_PHONES.replace('{src}', 'z2')}
       SELECT DISTINCT npi, date, group_id, state, zip, phone, nullif(CASE WHEN npi % 2 = 0 THEN ' ' ELSE 'ORG' END, ' ') AS org_name FROM h2""")
def _(t):
    org = F.when(F.col("npi") % 2 == 0, " ").otherwise("ORG")
    return D.repaired(t.raw_directory.withColumn("org_name", org))


@query("i8_mode_impute", ["directory_people"], """
    WITH r AS (SELECT DISTINCT npi, primary_specialty, nullif(credential, ' ') AS credential FROM directory_people),
    c AS (SELECT primary_specialty, CASE WHEN credential IN ('MD', 'DO') THEN 'MD/DO' ELSE credential END AS top, count(*) AS n
      FROM r WHERE credential IS NOT NULL AND primary_specialty IS NOT NULL GROUP BY 1, 2),
    u AS (SELECT primary_specialty, top FROM (SELECT *, max(n) OVER (PARTITION BY primary_specialty) AS m FROM c) WHERE n = m AND n > 20)
    SELECT DISTINCT r.npi, r.primary_specialty, CASE WHEN top IS NOT NULL THEN coalesce(credential, top) END AS credential
    FROM r LEFT JOIN u ON r.primary_specialty = u.primary_specialty""")
def _(t):
    return D.directory_types(t.directory_people, min_count=20)


@query("i8_fill_by_mode", ["directory_people"], """
    WITH c AS (SELECT primary_specialty, credential, count(*) AS n FROM directory_people WHERE credential IS NOT NULL GROUP BY 1, 2),
    u AS (SELECT primary_specialty, credential AS top FROM (SELECT *, max(n) OVER (PARTITION BY primary_specialty) AS m FROM c) WHERE n = m)
    SELECT DISTINCT r.npi, r.primary_specialty, CASE WHEN top IS NOT NULL THEN coalesce(credential, top) END AS credential
    FROM directory_people r LEFT JOIN u ON r.primary_specialty = u.primary_specialty""")
def _(t):
    return I.fill_by_mode(t.directory_people, "primary_specialty", "credential", 0)


_PAIRS = [("1996-01-01", "1995-10-01"), ("1998-04-01", "1998-01-01"), ("2000-10-01", "2000-07-01")]


@query("i10_backfill", ["directory"], """
    SELECT npi, date, group_id FROM directory UNION ALL
    SELECT npi, CAST(date - INTERVAL 3 MONTH AS DATE), group_id FROM directory
    WHERE date IN (DATE '1996-01-01', DATE '1998-04-01', DATE '2000-10-01')""")
def _(t):
    return I.backfill_periods(t.directory.select("npi", "date", "group_id"), _PAIRS, "date")


@query("m1_directory_names", ["person_names"], f"""
    WITH src AS (SELECT DISTINCT npi, pfname, pmname, plname, CASE WHEN npi % 5 = 0 THEN 'SR' ELSE '' END AS pnamesuffix FROM person_names),
    {_VARIANTS.replace('FROM person_names', 'FROM src')}, {_SUFFIXED.replace('FROM person_names', 'FROM src')}
    SELECT npi, pfname AS first_name, pmname AS middle_name, plname AS last_name, pnamesuffix AS suffix, name FROM outn""")
def _(t):
    d = t.person_names.select(
        "npi", F.concat(F.lit(" "), "pfname").alias("first_name"),
        F.nullif("pmname", F.lit("")).alias("middle_name"), F.col("plname").alias("last_name"),
        F.when(F.col("npi") % 5 == 0, "S.R.").alias("suffix"))
    return D.name_variants(d)


@query("m4_engagement", [], """
    WITH d AS (SELECT l_suppkey AS npi, min(year(l_shipdate)) - l_suppkey % 3 a, max(year(l_shipdate)) - l_suppkey % 3 b FROM lineitem GROUP BY 1),
    o AS (SELECT o_custkey AS npi, min(year(o_orderdate)) - o_custkey % 4 a, max(year(o_orderdate)) - o_custkey % 4 b FROM orders GROUP BY 1),
    c AS (SELECT l_partkey AS npi, min(year(l_shipdate)) - l_partkey % 5 a, max(year(l_shipdate)) - l_partkey % 5 b FROM lineitem GROUP BY 1),
    k AS (SELECT npi FROM d UNION SELECT npi FROM o UNION SELECT npi FROM c)
    SELECT k.npi, CAST(c.a AS INT) AS "PC_Min_Year", CAST(c.b AS INT) AS "PC_Max_Year", CAST(d.a AS INT) AS "PartD_Min_Year",
      CAST(d.b AS INT) AS "PartD_Max_Year", CAST(o.a AS INT) AS "PartB_Min_Year", CAST(o.b AS INT) AS "PartB_Max_Year",
      (coalesce(c.b = 2001, false) OR coalesce(d.b = 2000, false) OR coalesce(o.b = 2000, false))
        AND NOT (d.b IS NOT NULL AND o.b IS NOT NULL AND coalesce(c.b < 2001, false)) AS maybe_active,
      coalesce(c.b = 2001, false) AS active_2001
    FROM k LEFT JOIN d ON k.npi = d.npi LEFT JOIN o ON k.npi = o.npi LEFT JOIN c ON k.npi = c.npi""")
def _(t):
    d, o, c = (df.selectExpr(f"{key} AS npi", f"CAST(year({day}) - {key} % {k} AS INT) AS Year")
               for df, key, day, k in ((t.lineitem, "l_suppkey", "l_shipdate", 3),
                                       (t.orders, "o_custkey", "o_orderdate", 4),
                                       (t.lineitem, "l_partkey", "l_shipdate", 5)))
    return D.program_engagement(d, o, c, directory_last=2001, claims_last=2000)


@query("m5_one_school", ["schools"], """
    WITH r AS (SELECT DISTINCT * FROM schools),
    k AS (SELECT *, CASE WHEN medical_school IS NOT NULL AND graduation_year IS NOT NULL AND medical_school <> 'OTHER' THEN 0
        WHEN medical_school IS NOT NULL AND graduation_year IS NOT NULL THEN 1 WHEN medical_school IS NULL THEN 4
        WHEN medical_school = 'OTHER' THEN 3 ELSE 2 END AS q FROM r),
    b AS (SELECT npi, medical_school, graduation_year FROM (SELECT *, row_number() OVER (PARTITION BY npi
        ORDER BY q, medical_school NULLS LAST, graduation_year NULLS LAST) AS n FROM k) WHERE n = 1)
    SELECT * FROM b UNION ALL SELECT c_custkey, 'EXTRA', CAST(2001 AS BIGINT) FROM customer
    WHERE c_custkey NOT IN (SELECT npi FROM b)""")
def _(t):
    extra = t.customer.select(F.col("c_custkey").alias("npi"), F.lit("EXTRA").alias("medical_school_upper"),
                              F.lit(2001).alias("grad_year"))
    return D.medical_school(t.schools, extra)


# ------------------------------------------------------------------ claims

@query("m6_summary_with_detail", ["claims_summary", "claims_shown"], """
    WITH d AS (SELECT npi, Year, CAST(sum(total_claim_count) AS BIGINT) AS total_claim_count_detail FROM claims_shown GROUP BY 1, 2)
    SELECT coalesce(s.npi, d.npi) AS npi, coalesce(s.Year, d.Year) AS Year, total_claim_count, total_claim_count_detail,
      CASE WHEN s.npi IS NULL THEN 'right_only' WHEN d.npi IS NULL THEN 'left_only' ELSE 'both' END AS _merge
    FROM claims_summary s FULL JOIN d ON s.npi = d.npi AND s.Year = d.Year""")
def _(t):
    s = t.claims_summary.select("npi", "Year", "total_claim_count")
    return C.summary_with_detail(s, t.claims_shown, ["npi", "Year"], ["total_claim_count"])


def _part_d(t):
    s = t.claims_summary.withColumn("la_opioid_claim_count", F.lit(0))
    return C.part_d_info(s, t.claims_shown, s.where("opioid_claim_count is null or opioid_claim_count <> 11"))


@query("m6_part_d_null_in_detail", ["claims_summary", "claims_shown"], """
    SELECT CASE WHEN d.npi IS NULL THEN 'left_only' ELSE 'both' END AS _merge, count(*) AS n
    FROM (SELECT DISTINCT npi, Year FROM claims_summary WHERE opioid_claim_count IS NULL) s
    LEFT JOIN (SELECT DISTINCT npi, Year FROM claims_shown) d ON s.npi = d.npi AND s.Year = d.Year GROUP BY 1""")
def _(t):
    return _part_d(t)["null_in_detail"]


@query("m6_part_d_same_rows", ["claims_summary"], """
    SELECT npi, Year, total_claim_count, opioid_claim_count, CAST(0 AS INT) AS la_opioid_claim_count FROM claims_summary
    WHERE opioid_claim_count IS NULL OR opioid_claim_count <> 11""")
def _(t):
    return _part_d(t)["same_rows"]


def _profile(df, name):
    return df.withColumn("frame", F.lit(name))


_COUNTS = ", ".join(["count(*) AS n_rows", "count(*) FILTER (WHERE {0} IS NULL) AS n_null",
                     *[f"count(*) FILTER (WHERE {{0}} = {v}) AS n_{v}" for v in (0, 10, 11, 12)]])


@query("m6_part_d_profiles", ["claims_summary", "claims_shown"], f"""
    SELECT {_COUNTS.format("total_claim_count")}, 'summary' AS frame FROM claims_summary
    UNION ALL SELECT {_COUNTS.format("total_claim_count")}, 'detail' FROM claims_shown
    UNION ALL SELECT {_COUNTS.format("opioid_claim_count")}, 'opioid' FROM claims_summary
      WHERE opioid_claim_count IS NULL OR opioid_claim_count <> 11""")
def _(t):
    got = _part_d(t)
    out = [_profile(got[f"{n}_profile"], n) for n in ("summary", "detail", "opioid")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("m6_part_d_zero_in_detail", ["claims_summary", "claims_shown"], """
    SELECT CASE WHEN d.npi IS NULL THEN 'left_only' ELSE 'both' END AS _merge, count(*) AS n
    FROM (SELECT DISTINCT npi, Year FROM claims_summary WHERE opioid_claim_count = 0) s
    LEFT JOIN (SELECT DISTINCT npi, Year FROM claims_shown) d ON s.npi = d.npi AND s.Year = d.Year GROUP BY 1""")
def _(t):
    return _part_d(t)["zero_in_detail"]


@query("m6_part_d_id_differences", ["claims_summary"], """
    SELECT npi, Year, 'left_only' AS _merge FROM claims_summary WHERE total_claim_count % 3 = 0""")
def _(t):
    """Person-years of the summary that an opioid file with gaps lacks."""
    s = t.claims_summary.withColumn("la_opioid_claim_count", F.lit(0))
    return C.part_d_info(s, t.claims_shown, s.where("total_claim_count % 3 <> 0"))["id_differences"]


@query("m6_part_d_duplicates", ["claims_summary", "claims_shown"], """
    WITH s AS (SELECT npi, Year FROM claims_summary UNION ALL SELECT npi, Year FROM claims_summary WHERE npi % 5 = 0),
    d AS (SELECT npi, Year, drug_name, generic_name FROM claims_shown UNION ALL
      SELECT npi, Year, drug_name, generic_name FROM claims_shown WHERE npi % 3 = 0)
    SELECT npi, Year, CAST(NULL AS BIGINT) AS drug_name, CAST(NULL AS VARCHAR) AS generic_name, count(*) AS n
      FROM s GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL SELECT npi, Year, drug_name, generic_name, count(*) FROM d GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""")
def _(t):
    """Rows of both files that break their grain, on files with repeated rows."""
    s = t.claims_summary.withColumn("la_opioid_claim_count", F.lit(0))
    s = s.unionByName(s.where("npi % 5 = 0"))
    d = t.claims_shown.unionByName(t.claims_shown.where("npi % 3 = 0"))
    got = C.part_d_info(s, d, s)
    return got["detail_duplicates"].unionByName(got["summary_duplicates"], allowMissingColumns=True)


@query("m7_part_b_null_rows", ["services"], "SELECT * FROM services WHERE beneficiaries IS NULL")
def _(t):
    return C.part_b_info(t.services, t.services)["null_rows"]


@query("m7_part_b_summary", ["services"], f"""
    SELECT {_COUNTS.format("beneficiaries")} FROM services WHERE hcpcs_code = 'A'""")
def _(t):
    return C.part_b_info(t.services.where("hcpcs_code = 'A'"), t.services)["summary_profile"]


@query("m7_part_b_duplicates", ["services"], """
    SELECT npi, Year, CAST(NULL AS VARCHAR) AS hcpcs_code, CAST(NULL AS VARCHAR) AS place_of_service, count(*) AS n
      FROM services GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL SELECT npi, Year, hcpcs_code, place_of_service, count(*) FROM
      (SELECT * FROM services UNION ALL SELECT * FROM services WHERE npi % 3 = 0) GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""")
def _(t):
    """Rows of both files that break their grain, on files with repeated rows."""
    got = C.part_b_info(t.services, t.services.unionByName(t.services.where("npi % 3 = 0")))
    return got["detail_duplicates"].unionByName(got["summary_duplicates"], allowMissingColumns=True)


@query("m7_part_b", ["services"], """
    WITH s AS (SELECT npi, Year, count(*) * 3 AS beneficiaries FROM services WHERE hcpcs_code = 'A' GROUP BY 1, 2),
    d AS (SELECT npi, Year, CAST(sum(beneficiaries) AS BIGINT) AS beneficiaries_detail FROM services WHERE beneficiaries IS NOT NULL GROUP BY 1, 2)
    SELECT coalesce(s.npi, d.npi) AS npi, coalesce(s.Year, d.Year) AS Year, beneficiaries, beneficiaries_detail,
      CASE WHEN s.npi IS NULL THEN 'right_only' WHEN d.npi IS NULL THEN 'left_only' ELSE 'both' END AS _merge
    FROM s FULL JOIN d ON s.npi = d.npi AND s.Year = d.Year""")
def _(t):
    s = (t.services.where("hcpcs_code = 'A'").groupBy("npi", "Year")
         .agg((F.count(F.lit(1)) * 3).alias("beneficiaries")))
    return C.part_b_info(s, t.services)["joined"]


@query("m7_part_b_profile", ["services"], """
    SELECT count(*) AS n_rows, count(*) FILTER (WHERE beneficiaries IS NULL) AS n_null,
      count(*) FILTER (WHERE beneficiaries = 0) AS n_0, count(*) FILTER (WHERE beneficiaries = 10) AS n_10,
      count(*) FILTER (WHERE beneficiaries = 11) AS n_11, count(*) FILTER (WHERE beneficiaries = 12) AS n_12 FROM services""")
def _(t):
    return C.part_b_info(t.services.select("npi", "Year", "beneficiaries"), t.services)["detail_profile"]


def _years_of(df):
    return sorted(r.Year for r in df.select("Year").distinct().collect())


@query("s8_part_d_scan", ["claims_detail"], """
    SELECT CAST(npi AS VARCHAR) AS npi, Year + 18 AS Year, CAST(drug_name AS VARCHAR) AS drug_name,
      CAST(total_claim_count AS VARCHAR) AS total_claim_count FROM claims_detail""")
def _(t):
    """Land yearly tab-separated files, find them by name, scan some columns."""
    from rosterlake.session import work_path
    from rosterlake.sources.claims import part_d
    detail = cut(t.claims_detail)     # read once a year
    root, years = work_path(t.spark, "claims"), _years_of(detail)
    for year in years:
        (detail.where(F.col("Year") == year).drop("Year").write.option("sep", "\t")
         .option("header", "true").csv(f"{root}/PartD_Prescriber_PUF_NPI_DRUG_{year + 18}.txt"))
    return part_d(t.spark, root, columns=["npi", "drug_name", "total_claim_count"],
                  years=[y + 18 for y in years])


@query("s10_part_b_headers", ["services"], """
    SELECT CAST(npi AS VARCHAR) AS "National Provider Identifier", hcpcs_code AS "HCPCS Code",
      CAST(beneficiaries AS VARCHAR) AS "Number of Medicare Beneficiaries", Year + 18 AS Year FROM services""")
def _(t):
    """Years with different headers made one."""
    from rosterlake.session import work_path
    from rosterlake.sources.claims import PART_B_DETAIL, part_b
    wanted = ["National Provider Identifier", "HCPCS Code", "Number of Medicare Beneficiaries"]
    headers = [["National Provider Identifier ", "HCPCS Code", " Number of Medicare Beneficiaries"],
               ["NPI", "HCPCS_CODE", "BENE_UNIQUE_CNT"]]
    services = cut(t.services)        # read once a year
    root, years = work_path(t.spark, "partb"), _years_of(services)
    for year in years:
        (services.where(F.col("Year") == year).select(*[
            F.col(c).alias(n) for c, n in zip(["npi", "hcpcs_code", "beneficiaries"], headers[year % 2])])
         .write.option("header", "true").csv(f"{root}/{PART_B_DETAIL}{year + 18}.csv"))
    return part_b(t.spark, root, columns=wanted, years=[y + 18 for y in years])


@query("s11_directory_scan", ["directory"], """
    SELECT DISTINCT npi, zip, group_id, CASE WHEN year(date) % 2 = 1 THEN NULL ELSE phone END AS phone,
      CASE WHEN year(date) % 2 = 1 THEN DATE '2014-12-01' ELSE DATE '2016-03-01' END AS date
    FROM directory""")
def _(t):
    """Two snapshots of different layout, one without phones."""
    from rosterlake.session import work_path
    from rosterlake.sources.directory import read_directory
    root = work_path(t.spark, "directory")
    d = t.directory
    (d.where("year(date) % 2 = 1").select(F.col("npi").alias("NPI"), F.col("zip").alias("Zip Code"),
                                           F.coalesce(F.col("group_id").cast("string"), F.lit(" ")).alias("Group Practice PAC ID"))
     .write.option("header", "true").option("ignoreTrailingWhiteSpace", "false").csv(f"{root}/2014-12-01/Directory_2014-12-01.csv"))
    (d.where("year(date) % 2 = 0").select(F.col("npi").alias(" NPI"), F.col("zip"), F.col("group_id").alias("org_pac_id"),
                                           F.col("phone").alias("phn_numbr"), F.col("state").alias("unused"))
     .write.option("header", "true").csv(f"{root}/x/National_Mar_2016.csv"))
    return read_directory(t.spark, root, ["zip", "group_id", "phone"], with_date=True)


@query("s14_licence_list", ["licence_rows"], """
    WITH u AS (SELECT rid, upper(NameFull) AS "NameFull", upper(PractitionerType) AS "PractitionerType",
        DateLastCertified, DateGranted, CAST(DATE '1960-01-01' + CAST(Date AS INT) AS DATE) AS Date FROM licence_rows),
    i AS (SELECT *, row_number() OVER (ORDER BY "NameFull", DateLastCertified, "PractitionerType") - 1 AS samhsa_id
      FROM (SELECT DISTINCT "NameFull", DateLastCertified, "PractitionerType" FROM u))
    SELECT u.*, samhsa_id, (DateGranted IS NOT NULL) <> (DateGranted IS NULL) AS date_rule FROM u JOIN i
      ON u."NameFull" = i."NameFull" AND u.DateLastCertified = i.DateLastCertified AND u."PractitionerType" = i."PractitionerType" """)
def _(t):
    return L.dated(L.identified(t.licence_rows))
