"""Work that must be done once, or only on the rows that need it."""

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from harness.catalog import SPARK
from rosterlake.operators import impute as I
from rosterlake.plans import practices as P
from tests.conftest import rows


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def landed_plans(monkeypatch, build) -> list[str]:
    """The plans behind all CSV files that ``build`` lands."""
    plans, csv = [], DataFrameWriter.csv

    def spy(self, *args, **kwargs):
        plans.append(optimized(self._df))
        return csv(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "csv", spy)
    build()
    return plans


def line_tables(spark, root) -> str:
    lines = [(o, 1 + o % 3, 1 + o % 2, 1, datetime(1996, 1 + o % 9, 3), "A", "F", 3.0) for o in range(12)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp, "
                          "l_returnflag string, l_linestatus string, l_quantity double").write.parquet(f"{root}/lineitem.parquet")
    orders = [(o, o % 4, datetime(1995 + o % 3, 2, 1)) for o in range(12)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{root}/orders.parquet")
    return str(root)


def test_yearly_files_are_landed_from_one_written_table(spark, tmp_path, monkeypatch):
    at = line_tables(spark, tmp_path)
    for name in ("s10_part_b_headers", "s8_part_d_scan"):
        plans = landed_plans(monkeypatch, lambda: SPARK[name](spark, at))
        assert plans and not any("Aggregate" in p for p in plans)


def test_vintages_are_landed_from_one_written_table(spark, tmp_path, monkeypatch):
    at = line_tables(spark, tmp_path)
    plans = landed_plans(monkeypatch, lambda: SPARK["s12_other_vintages"](spark, at))
    assert plans and not any("Aggregate" in p for p in plans)


DIRECTORY = "npi long, date date, group_id long, state string, zip string, phone string"


def test_repairs_join_only_rows_that_need_one(spark):
    day = date(2020, 1, 1)
    d = spark.createDataFrame([
        (1, day, 7, "OH", "123", "5551234567"), (1, day, 7, "OH", "00123", "5551234567"), (2, day, None, "OH", "123", None),
        (2, day, 7, "OH", None, None), (3, day, 8, "OH", "456", "5550000001"), (4, day, 7, "OH", "00123", None),
        (4, day, 7, "OH", "00123", None)], DIRECTORY)
    zips = I.repair_zips(d)
    assert rows(zips, "npi", "zip", "phone") == [
        (1, "00123", "5551234567"), (1, "00123", "5551234567"), (2, None, None), (2, "123", None),
        (3, "456", "5550000001"), (4, "00123", None), (4, "00123", None)]
    joins = optimized(zips).split("Join LeftOuter")
    assert len(joins) == 2 and joins[1].count("length(zip") >= 2
    phones = I.repair_phones(zips)
    assert [r for r in rows(phones, "npi", "phone") if r[0] == 4] == [(4, "5551234567")] * 2
    assert "__todo" in optimized(phones)


def test_dates_of_all_rows_need_no_outer_join(spark):
    day, later = date(2020, 1, 1), date(2020, 7, 1)
    inferred = spark.createDataFrame(
        [("S", "1", "5", 9, 90, 1, day), ("S", "1", None, None, 91, 2, later), ("S", None, "5", 9, 90, None, day)],
        "state string, zip string, phone string, group_id long, my_group_id long, npi long, date date")
    locations = spark.createDataFrame(
        [(1, later, "S", "1", "5"), (3, day, "S", "1", "5"), (3, None, None, "1", None), (4, None, "S", "1", "5"), (None, later, "S", "1", "5")],
        "npi long, quarter date, plocstatename string, ploczip string, ploctel string")
    out, _, _, dates = P.infer_all_groups(inferred, locations, [])
    assert rows(dates) == rows(out.groupBy("npi").agg(F.min("quarter"), F.max("quarter")))
    assert "FullOuter" not in optimized(dates) and "FullOuter" in optimized(out)
