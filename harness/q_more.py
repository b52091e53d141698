"""Inventory items that are one or two built-ins, and landed-file scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from harness.registry import query
from rosterlake import schemas as S
from rosterlake.functions import text as X
from rosterlake.operators import joins as J
from rosterlake.operators import quality as Q
from rosterlake.operators import reshape as R
from rosterlake.plans import directory as Dir
from rosterlake.plans import names as N
from rosterlake.plans import registry as G
from rosterlake.session import cut, work_path
from rosterlake.sources import files as Fi


def _land(df, path, **options):
    w = df.write.option("header", "true")
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)


@query("s4_s7_monthly_files", [], """
    SELECT c_custkey AS npi, DATE '2014-08-01' AS month, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'm' END AS pgender FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT c_custkey, DATE '2014-09-01', 'f' FROM customer""")
def _(t):
    """Monthly folders found, dated by name and read together."""
    from rosterlake.sources.panels import read_months
    root = work_path(t.spark, "months")
    c = t.customer.select(F.col("c_custkey").alias("NPI"), F.col("c_name").alias("Provider First Name"))
    g = S.SINGLE_HEADERS["pgender"]
    _land(c.where("NPI % 2 = 0").withColumn(g, F.when(F.col("NPI") % 3 > 0, "m")),
          f"{root}/NPPES_Data_Dissemination_August_2014/npidata_20050523-20140810.csv")
    _land(c.withColumn(g, F.lit("f")).select(g, "NPI", "Provider First Name"),
          f"{root}/NPPES_Data_Dissemination_September_2014/npidata_20050523-20140907.csv")
    return read_months(t.spark, root, "pgender")


def _months(t, root, flags):
    c = t.customer.select(F.col("c_custkey").alias("NPI"))
    for (folder, day), value in flags.items():
        _land(c.withColumn(S.SINGLE_HEADERS["pgender"], F.lit(value)),
              f"{root}/NPPES_Data_Dissemination_{folder}_2014/npidata_20050523-2014{day}.csv")


_AUG, _SEP, _OCT = ("August", "0810"), ("September", "0907"), ("October", "1012")


@query("d4_full_rebuild", [], "SELECT c_custkey AS npi, DATE '2014-09-01' AS month, 'g' AS pgender FROM customer")
def _(t):
    """A full rebuild leaves nothing of months that are not landed any more."""
    from rosterlake.plans.refresh import refresh_variable
    from rosterlake.sources.panels import read_panel
    root = work_path(t.spark, "rebuild")
    _months(t, f"{root}/old", {_AUG: "m", _SEP: "f"})
    _months(t, f"{root}/new", {_SEP: "g"})
    for folder in ("old", "new"):
        refresh_variable(t.spark, f"{root}/{folder}", f"{root}/panels", "pgender", update=False)
    return read_panel(t.spark, f"{root}/panels", "pgender").select("npi", "month", "pgender")


@query("d4_incremental", [], """SELECT c_custkey AS npi, DATE '2014-08-01' AS month, 'm' AS pgender FROM customer
    UNION ALL SELECT c_custkey, DATE '2014-09-01', 'g' FROM customer UNION ALL SELECT c_custkey, DATE '2014-10-01', 'h' FROM customer""")
def _(t):
    """An update rebuilds the last months from what is landed and adds new ones."""
    from rosterlake.plans.refresh import refresh_variable
    from rosterlake.sources.panels import read_panel
    root = work_path(t.spark, "update")
    _months(t, f"{root}/old", {_AUG: "m", _SEP: "f"})
    _months(t, f"{root}/new", {_AUG: "m", _SEP: "g", _OCT: "h"})
    refresh_variable(t.spark, f"{root}/old", f"{root}/panels", "pgender", update=False)
    refresh_variable(t.spark, f"{root}/new", f"{root}/panels", "pgender")
    return read_panel(t.spark, f"{root}/panels", "pgender").select("npi", "month", "pgender")


_LOCATION = """CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS ploc2line1, CAST(NULL AS {text}) AS ploc2line2,
    c_mktsegment AS ploc2cityname, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE substr(c_mktsegment, 1, 2) END AS ploc2statename,
    CAST(c_custkey % 50 AS {text}) AS ploc2zip, CAST(c_custkey AS {text}) AS ploc2tel"""


@query("d19_landed_locations", [], f"""SELECT CAST(c_nationkey AS BIGINT) AS npi, DATE '2014-09-01' AS month, {_LOCATION.format(text="VARCHAR")}
    FROM customer""")
def _(t):
    """Six variables of one landed file share their row numbers, so joined they
    give the rows that were landed."""
    from rosterlake.sources.panels import read_months
    root = work_path(t.spark, "locations")
    rows = t.spark.sql(f"SELECT c_nationkey AS NPI, {_LOCATION.format(text='STRING')} FROM {{c}}", c=t.customer)
    _land(rows.withColumnsRenamed(S.SECONDARY_HEADERS),
          f"{root}/NPPES_Data_Dissemination_September_2014/pl_pfile_20050523-20140907.csv")
    parts = [cut(read_months(t.spark, root, v)) for v in S.SECONDARY_HEADERS]
    return G.secondary_locations(parts).drop("seq")


@query("d2_fewer_slots", [], """SELECT l_orderkey AS npi, DATE '1996-01-01' AS month, l_linenumber AS seq,
      CASE WHEN l_orderkey % 2 = 0 AND l_linenumber = 1 THEN l_returnflag ELSE l_linestatus END AS value
    FROM (SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus
          FROM lineitem GROUP BY 1, 2) QUALIFY l_orderkey % 2 = 1 OR l_linenumber = 1 OR min(l_linenumber) OVER (PARTITION BY l_orderkey) > 1""")
def _(t):
    """The latest weekly record replaces a provider's slots, also by fewer."""
    from rosterlake.plans.refresh import with_weeks
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("npi"), F.col("l_linenumber").cast("int").alias("seq")).agg(
        F.min("l_linestatus").alias("value"), F.min("l_returnflag").alias("flag"))
    monthly = rows.select("npi", F.lit("1996-01-01").cast("date").alias("month"), "seq", "value")
    seen = rows.where("npi % 2 = 0")
    weekly = (seen.select("npi", F.lit("1996-01-08").cast("date").alias("week"), "seq", "value").unionByName(
        seen.where("seq = 1").select("npi", F.lit("1996-01-15").cast("date").alias("week"), "seq", F.col("flag").alias("value"))))
    return with_weeks(monthly, weekly, "value")


@query("s6_weekly_files", ["weekly"], """
    SELECT DISTINCT npi, DATE '2014-09-15' AS week, value AS pgender FROM weekly WHERE npi % 2 = 1""")
def _(t):
    """Only weeks past the last monthly file are read."""
    from rosterlake.sources.panels import read_weeks
    root = work_path(t.spark, "weeks")
    w = t.weekly.select(F.col("npi").alias("NPI"), F.col("value").alias(S.SINGLE_HEADERS["pgender"])).distinct()
    _land(w.where("NPI < 0"), f"{root}/NPPES_Data_Dissemination_September_2014/npidata_20050523-20140914.csv")
    _land(w.where("NPI % 2 = 0"), f"{root}/NPPES_Data_Dissemination_090814_091414_Weekly/npidata_20140908-20140914.csv")
    _land(w.where("NPI % 2 = 1"), f"{root}/NPPES_Data_Dissemination_091514_092114_Weekly/npidata_20140915-20140921.csv")
    return read_weeks(t.spark, root, "pgender")


@query("s9_opioid_scan", ["claims_summary"], """
    SELECT CAST(npi AS VARCHAR) AS "NPI", CAST(opioid_claim_count AS VARCHAR) AS "Opioid Claim Count", Year + 18 AS "Year"
    FROM claims_summary""")
def _(t):
    """Yearly opioid files, two columns of them."""
    from rosterlake.sources.claims import OPIOID, part_d_opioid
    root = work_path(t.spark, "opioid")
    years = sorted(r.Year for r in t.claims_summary.select("Year").distinct().collect())
    d = t.claims_summary.select("Year", F.col("npi").alias("NPI"), F.col("opioid_claim_count").alias(
        "Opioid Claim Count"), F.lit("x").alias("unused"))
    for year in years:
        _land(d.where(F.col("Year") == year).drop("Year"), f"{root}/{OPIOID}{year + 18}.csv")
    return part_d_opioid(t.spark, root, ["NPI", "Opioid Claim Count"], [y + 18 for y in years])


@query("s12_headerless_vintage", ["directory"], """
    SELECT DISTINCT npi, zip, phone FROM directory""")
def _(t):
    """A directory file without header, read by position."""
    from rosterlake.sources.directory import read_directory
    root = work_path(t.spark, "vintage")
    named = {v: k for k, v in S.DIRECTORY_COLUMNS.items()}
    d = t.directory.select("npi", "zip", "phone").withColumnsRenamed(named)
    full = d.select(*[F.col(f"`{c}`") if c in d.columns else F.lit("x").alias(c) for c in S.DIRECTORY_COLUMNS])
    full.write.csv(f"{root}/a/Directory_2014-03-01.csv")
    return read_directory(t.spark, root, ["zip", "phone"])


@query("s19_csv_sink", ["ends"], """
    SELECT CAST(npi AS VARCHAR) AS npi, CAST(npideactdate AS VARCHAR) AS npideactdate FROM ends""")
def _(t):
    from rosterlake.sources.panels import write_csv
    path = work_path(t.spark, "report")
    write_csv(t.ends, path)
    return Fi.read_text_table(t.spark, path)


@query("p1_rename_headers", [], """
    SELECT c_custkey AS npi, c_name AS last_name, c_mktsegment AS state FROM customer""")
def _(t):
    """Header variants, spaces and case do not matter."""
    odd = t.customer.withColumnsRenamed({"c_custkey": " NPI", "c_name": "LST_NM", "c_mktsegment": "St "})
    return Fi.harmonize(odd, {**S.DIRECTORY_COLUMNS, **S.DIRECTORY_SHORT}, ["npi", "last_name", "state"])


@query("p7_filters", ["panel"], """
    SELECT npi, rid, value FROM panel WHERE status = 'F' AND value IS NOT NULL AND month >= DATE '1998-01-01'""")
def _(t):
    return (t.panel.where((F.col("status") == "F") & F.col("value").isNotNull()
                          & (F.col("month") >= F.lit("1998-01-01").cast("date"))).select("npi", "rid", "value"))


@query("p8_entity_filter", ["panel", "entity"], """
    SELECT p.npi, rid FROM panel p JOIN entity e ON p.npi = e.npi WHERE entity = 2""")
def _(t):
    return G.of_entity(t.panel.select("npi", "rid"), t.entity, 2)


@query("p9_membership", ["panel", "ends"], """
    SELECT npi, rid FROM panel WHERE value IN ('1-URGENT', '2-HIGH') AND npi NOT IN (SELECT npi FROM ends)""")
def _(t):
    return J.anti_join(t.panel.where(F.col("value").isin("1-URGENT", "2-HIGH")).select("npi", "rid"),
                       t.ends.select("npi"), on=["npi"], null_equal=False)


@query("p11_p12_p19_conditional", ["directory_people"], """
    SELECT npi, primary_specialty, nullif(credential, ' ') AS credential,
      CASE WHEN credential IN ('MD', 'DO') THEN 'MD/DO' ELSE coalesce(nullif(credential, ' '), 'none') END AS kind FROM directory_people""")
def _(t):
    c = X.blank_to_null("credential", " ")
    return t.directory_people.select("npi", "primary_specialty", c.alias("credential"), F.when(
        c.isin("MD", "DO"), "MD/DO").otherwise(c).alias("kind")).na.fill("none", ["kind"])


@query("j13_per_key_product", ["n_first", "n_last"], """
    SELECT coalesce(f.npi, l.npi) AS npi, pfname, plname FROM n_first f FULL JOIN n_last l ON f.npi = l.npi""")
def _(t):
    return J.natural_join(t.n_first, t.n_last, "outer")


@query("j16_derived_key", ["raw_directory"], """
    SELECT DISTINCT a.group_id, a.zip, b.zip AS padded FROM raw_directory a JOIN raw_directory b
      ON a.group_id = b.group_id AND '00' || a.zip = b.zip""")
def _(t):
    z = t.raw_directory.select("group_id", "zip").distinct()
    return J.natural_join(z.withColumn("padded", F.concat(F.lit("00"), "zip")),
                          z.withColumnRenamed("zip", "padded"), on=["group_id", "padded"], null_equal=False)


@query("j20_attach_attribute", ["person_names", "types"], """
    SELECT DISTINCT n.npi, pfname, plname, cat AS practitioner_type FROM person_names n JOIN types y ON n.npi = y.npi""")
def _(t):
    names = t.person_names.select("npi", "pfname", "plname").distinct()
    return J.natural_join(names, t.types.select("npi", F.col("cat").alias("practitioner_type")).distinct(),
                          on=["npi"], null_equal=False)


@query("j21_small_dimension", [], """
    SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    """Dimensions joined by size: Spark's own threshold decides."""
    c = J.renamed_key_join(t.customer, t.nation, {"c_nationkey": "n_nationkey"})
    return J.renamed_key_join(c, t.region, {"n_regionkey": "r_regionkey"}).select("c_custkey", "n_name", "r_name")


@query("a2_group_size", ["directory"], """
    SELECT group_id, zip, count(*) AS n FROM directory WHERE group_id IS NOT NULL AND zip IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return t.directory.na.drop(subset=["group_id", "zip"]).groupBy("group_id", "zip").agg(F.count(F.lit(1)).alias("n"))


@query("a4_group_sums", ["claims_detail"], """
    SELECT npi, Year, CAST(sum(total_claim_count) AS BIGINT) AS total_claim_count_detail FROM claims_detail GROUP BY 1, 2""")
def _(t):
    from rosterlake.plans.claims import detail_totals
    return detail_totals(t.claims_detail, ["npi", "Year"], ["total_claim_count"])


@query("a5_group_max_many", ["directory"], """
    SELECT npi, max(group_id) AS group_id, max(group_size) AS group_size, max(date) AS date FROM directory GROUP BY 1""")
def _(t):
    return t.directory.groupBy("npi").agg(*[F.max(c).alias(c) for c in ("group_id", "group_size", "date")])


@query("a17_years_active", [], """
    SELECT o_custkey AS npi, CAST(min(year(o_orderdate)) AS INT) AS "PartB_Min_Year", CAST(max(year(o_orderdate)) AS INT) AS "PartB_Max_Year"
    FROM orders GROUP BY 1""")
def _(t):
    return Dir.years_active(t.orders.withColumn("Year", F.year("o_orderdate")), "o_custkey", "Year", "PartB")


@query("a18_share_filled", ["directory"], """
    WITH f AS (SELECT org_name IS NULL AS blank, CASE WHEN npi IS NOT NULL AND group_id IS NOT NULL
        AND min(org_name) OVER (PARTITION BY npi, group_id) = max(org_name) OVER (PARTITION BY npi, group_id) THEN 1 ELSE 0 END AS one FROM directory)
    SELECT count(*) FILTER (WHERE blank) AS blanks, count(*) FILTER (WHERE blank AND one = 1) AS filled FROM f""")
def _(t):
    """How much a fill changes: blanks before and cells it fills."""
    from rosterlake.operators.impute import batch_fill
    d = t.directory.select("npi", "group_id", "org_name", "date", "phone", "zip", "state", "group_size",
                           F.col("org_name").isNull().alias("was_blank"))
    out = batch_fill(d, ["npi", "group_id"], ["org_name"], distinct=False)
    return out.agg(F.count_if("was_blank").alias("blanks"),
                   F.count_if(F.col("was_blank") & F.col("org_name").isNotNull()).alias("filled"))


@query("w3_multiplicity", ["panel"], """
    SELECT npi, month, rid, count(*) OVER (PARTITION BY npi, month) AS n FROM panel""")
def _(t):
    return J.with_group_stats(t.panel.select("npi", "month", "rid"), ["npi", "month"], n=F.count(F.lit(1)))


@query("w6_constant_in_group", ["panel"], """
    SELECT npi, month, rid, value FROM (SELECT *, min(value) OVER (PARTITION BY npi, month) AS a, max(value) OVER (PARTITION BY npi, month) AS b
      FROM panel) WHERE a = b""")
def _(t):
    out = J.with_group_stats(t.panel.drop("status"), ["npi", "month"], a=F.min("value"), b=F.max("value"))
    return out.where("a = b").drop("a", "b")


@query("u2_union_distinct", ["n_first", "n_last"], """
    SELECT npi, pfname AS word FROM n_first UNION SELECT npi, plname FROM n_last""")
def _(t):
    return (t.n_first.withColumnRenamed("pfname", "word")
            .unionByName(t.n_last.withColumnRenamed("plname", "word")).distinct())


@query("u4_difference", ["n_first", "person_names"], """
    SELECT DISTINCT npi, pfname FROM n_first EXCEPT SELECT npi, pfname FROM person_names""")
def _(t):
    return J.anti_join(t.n_first.distinct(), t.person_names.select("npi", "pfname"))


@query("r6_first_middle_last", ["person_names"], """
    WITH a AS (SELECT npi, string_split(trim(regexp_replace(pfname || ' ' || pmname || ' ' || plname, ' +', ' ', 'g')), ' ') AS a FROM person_names)
    SELECT npi, a[1] AS firstname, array_to_string(a[2:len(a) - 1], ' ') AS middlename, a[-1] AS lastname FROM a""")
def _(t):
    whole = F.concat_ws(" ", "pfname", "pmname", "plname")
    return t.person_names.select("npi", *[c.alias(n) for n, c in N.split_name(whole).items()])


@query("f10_f13_ids", ["directory"], """
    SELECT npi, date, group_id::VARCHAR || '-' || year(date)::VARCHAR || 'Q' || quarter(date)::VARCHAR || '-' || state || '-' || zip || '-' || phone AS id,
      CASE WHEN length(substr(zip, 1, 4)) = 4 AND state = 'S1' THEN '0' || substr(zip, 1, 4) ELSE substr(zip, 1, 4) END AS padded FROM directory""")
def _(t):
    four = F.substring("zip", 1, 4)
    state = F.when(F.col("state") == "S1", "MA").otherwise(F.col("state"))
    return t.directory.select("npi", "date", X.group_location_id("group_id", "date", "state", "zip", "phone").alias("id"),
                              X.pad_zip(four, state).alias("padded"))


@query("q2_crosswalk_duplicates", ["crosswalk"], """
    SELECT npi, count(*) AS n FROM crosswalk GROUP BY 1 HAVING count(*) > 1""")
def _(t):
    return Q.duplicate_keys(t.crosswalk, ["npi"])


@query("q7_date_rule", ["licence_rows"], """
    SELECT count(*) AS n_rows, count(*) FILTER (WHERE CASE WHEN DateGranted IS NULL THEN
        CAST(DATE '1960-01-01' + CAST(Date AS INT) AS DATE) = CAST(DateLastCertified AS DATE) AND rid % 7 <> 0
        ELSE CAST(DATE '1960-01-01' + CAST(Date AS INT) AS DATE) = CAST(DateGranted AS DATE) END) AS holds FROM licence_rows""")
def _(t):
    from rosterlake.sources.licences import dated
    late = F.when(F.col("rid") % 7 == 0, "1990-01-01").otherwise(F.col("DateLastCertified"))
    return dated(t.licence_rows.withColumn("DateLastCertified", late)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("date_rule").alias("holds"))


@query("o1_sorted_report", ["panel"], """
    SELECT npi, count(*) AS n, max(month) AS last_month FROM panel GROUP BY 1 ORDER BY 2 DESC, 1""")
def _(t):
    out = t.panel.groupBy("npi").agg(F.count(F.lit(1)).alias("n"), F.max("month").alias("last_month"))
    return out.orderBy(F.desc("n"), "npi").select(*R.reorder(out.columns, ["npi"]))


@query("a14_any_all", ["slots"], """
    SELECT npi, (code_1 IS NOT NULL)::INT + (code_2 IS NOT NULL)::INT + (code_10 IS NOT NULL)::INT AS n_codes,
      code_1 IS NOT NULL AND code_2 IS NOT NULL AND code_10 IS NOT NULL AS all_codes FROM slots""")
def _(t):
    have = [F.col(c).isNotNull() for c in ("code_1", "code_2", "code_10")]
    return t.slots.select("npi", reduce(lambda a, b: a + b, [h.cast("int") for h in have]).alias("n_codes"),
                          reduce(lambda a, b: a & b, have).alias("all_codes"))
