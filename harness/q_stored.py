"""Jobs that land files or keep state: the weekly stream, the licence file, sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness.q_registry import _WEEKS
from harness.registry import query
from rosterlake import schemas as S
from rosterlake.operators import sketches as K
from rosterlake.operators.joins import join_group_stats
from rosterlake.operators.quality import cast_losses, observed
from rosterlake.plans.practices import members_per
from rosterlake.session import cut, work_path
from rosterlake.sources.directory import read_directory, store_directory
from rosterlake.sources.licences import read_licences
from rosterlake.streaming import weekly as W


@query("stream_weekly_fold", ["weekly"], f"WITH {_WEEKS} SELECT * FROM w")
def _(t):
    """Weeks land in two goes, every other week late and the first go's files
    once more; each go runs the stream to its end, and a last run finds nothing
    new. The panel equals the batch fold."""
    root = work_path(t.spark, "stream")
    landing, panel, state = f"{root}/landing", f"{root}/panel", f"{root}/state"
    weeks = t.weekly.select("npi", "week", "value")
    first = F.pmod(F.floor(F.unix_date("week") / 7), F.lit(2)) == 0
    stream = "npi long, week date, value string"
    for part in (weeks.where(first), weeks, weeks.limit(0)):
        part.write.mode("append").parquet(landing)
        W.start(W.weekly_stream(t.spark, landing, stream), panel, "value", state).awaitTermination()
    return t.spark.read.schema("npi long, month date, week date, value string").parquet(
        f"{panel}/value").select("npi", "month", "value")


@query("s14_licence_file", ["licence_rows"], """
    WITH u AS (SELECT CAST(rid AS VARCHAR) AS rid, upper(NameFull) AS "NameFull", upper(PractitionerType) AS "PractitionerType",
        DateLastCertified, DateGranted, CAST(DATE '1960-01-01' + CAST(Date AS INT) AS DATE) AS Date FROM licence_rows),
    i AS (SELECT *, row_number() OVER (ORDER BY "NameFull", DateLastCertified, "PractitionerType") - 1 AS samhsa_id
      FROM (SELECT DISTINCT "NameFull", DateLastCertified, "PractitionerType" FROM u))
    SELECT u.*, samhsa_id FROM u JOIN i ON u."NameFull" = i."NameFull" AND u.DateLastCertified = i.DateLastCertified
      AND u."PractitionerType" = i."PractitionerType" """)
def _(t):
    """The list as a landed text file, read with ids and dates."""
    path = work_path(t.spark, "licences")
    t.licence_rows.write.option("header", "true").csv(path)
    return read_licences(t.spark, path)


@query("a3_member_sketches", ["directory"], """
    SELECT group_id, count(DISTINCT npi) AS members, TRUE AS near FROM directory
    WHERE group_id IS NOT NULL AND date IS NOT NULL GROUP BY 1""")
def _(t):
    """Members of the whole span: sketches per group and month, merged, beside
    the exact count; ``near``: within the stated error."""
    monthly = K.member_sketches(t.directory, ["group_id", "date"])
    whole = K.estimates(K.merged_sketches(monthly, ["group_id"]))
    exact = members_per(t.directory.withColumn("span", F.when(F.col("date").isNotNull(), 1)), "group_id", "span", "members")
    gap = F.abs(F.col("members_estimate") - F.col("members"))
    return join_group_stats(exact, whole, ["group_id"]).select(
        "group_id", "members", F.coalesce(gap <= F.greatest(F.lit(1.0), K.ERROR * F.col("members")), F.lit(False)).alias("near"))


def _vintages(t) -> str:
    """The directory landed as three vintages: no phones and the header as a
    row (2014-06); lines with a field too few or too many (2014-12); a column
    that holds nothing and has no header (2016-07)."""
    root = work_path(t.spark, "vintages")
    # landed three times from one written table
    d = cut(t.directory.select(F.col("npi").cast("string").alias("npi"), F.coalesce("zip", F.lit("")).alias("zip")))
    names = [n for n in S.DIRECTORY_COLUMNS if n != "Phone Number"]
    own = {k: v for k, v in S.DIRECTORY_COLUMNS.items() if v in d.columns}
    line = F.concat_ws(",", *[F.col(own[n]) if n in own else F.lit("x") for n in names])

    def landed(lines, name: str, header: str | None = None) -> None:
        # whole lines: a separator that does not occur, and no quotes
        (lines.toDF(header or "line").write.mode("append").option("header", str(header is not None).lower())
         .option("sep", "\u0001").option("quote", "").csv(f"{root}/a/Directory_{name}.csv"))

    landed(d.select(line), "2014-06-01")
    landed(t.spark.range(1).select(F.lit(",".join(names))), "2014-06-01")
    spoilt = F.when(F.pmod(F.col("npi").cast("long"), F.lit(7)) == 0, F.col("npi")).when(
        F.pmod(F.col("npi").cast("long"), F.lit(11)) == 0, F.concat_ws(",", "npi", "zip", "zip")).otherwise(F.concat_ws(",", "npi", "zip"))
    landed(d.select(spoilt), "2014-12-01", "NPI,Zip Code")
    landed(d.select(F.concat_ws(",", "npi", F.lit(""), "zip")), "2016-07-01", "NPI,Zip Code")
    return root


@query("s12_other_vintages", ["directory"], """
    SELECT npi, zip, DATE '2014-06-01' AS date FROM directory
    UNION SELECT npi, zip, DATE '2014-12-01' FROM directory WHERE npi % 7 <> 0 AND npi % 11 <> 0
    UNION SELECT npi, zip, DATE '2016-07-01' FROM directory""")
def _(t):
    """Three odd layouts read as one table."""
    return read_directory(t.spark, _vintages(t), ["zip"], with_date=True)


@query("s12_dropped_lines", ["directory"], """
    SELECT d.date, count(*) AS kept_and_malformed, CAST(count_if(d.date = DATE '2014-12-01' AND (npi % 7 = 0 OR npi % 11 = 0)) AS BIGINT) AS malformed,
      d.date <> DATE '2014-12-01' AS has_headers_inside
    FROM directory x, (VALUES (DATE '2014-06-01'), (DATE '2014-12-01'), (DATE '2016-07-01')) d(date) GROUP BY d.date""")
def _(t):
    """Lines left out of a stored directory, counted while it was written. A
    header is repeated by every part of a landed folder, so those are not
    counted here."""
    report = store_directory(t.spark, _vintages(t), ["zip"], work_path(t.spark, "directory"))
    return report.select("date", (F.col("lines") - F.col("without_id")).alias("kept_and_malformed"), "malformed",
                         (F.col("without_id") > 0).alias("has_headers_inside"))


@query("p5_observed_cast", [], """
    SELECT count(*) AS n_rows, CAST(count_if(try_cast(c_name AS BIGINT) IS NULL AND c_name IS NOT NULL) AS BIGINT) AS lost_name,
      CAST(count_if(trunc(c_acctbal) <> c_acctbal) AS BIGINT) AS lost_balance,
      0::BIGINT AS lost_key, count_if(c_nationkey % 5 = 0) / count(*) AS share_filled FROM customer""")
def _(t):
    """Values a cast loses and the share of rows changed, counted while the
    rows are written (P5, A18)."""
    raw = t.customer.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"),
                            F.col("c_acctbal").cast("double").alias("balance"), "c_nationkey")
    rows, seen = observed(raw, {**cast_losses({"key": "long", "name": "long", "balance": "long"}), "n_rows": F.count(F.lit(1)),
                                "share_filled": F.avg((F.col("c_nationkey") % 5 == 0).cast("double"))})
    rows.write.parquet(work_path(t.spark, "cast"))
    found = seen.get
    names = ["n_rows", "lost_name", "lost_balance", "lost_key", "share_filled"]
    return t.spark.createDataFrame([tuple(found[n] for n in names)],
                                   "n_rows long, lost_name long, lost_balance long, lost_key long, share_filled double")
