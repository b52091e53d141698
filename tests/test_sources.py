"""Landed files of every layout, refresh end to end, and the weekly stream."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from rosterlake import schemas as S
from rosterlake.operators.quality import AuditError
from rosterlake.plans import refresh as P
from rosterlake.plans.registry import Registry
from rosterlake.sources import claims, directory, files, licences, panels
from rosterlake.streaming import weekly
from tests.conftest import rows

TAX = "Healthcare Provider Taxonomy Code"


def put(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "raw"
    month = root / "NPPES_Data_Dissemination_{}_2020"
    head = f'NPI,"Entity Type Code","Provider Gender Code","{TAX}_1","{TAX}_2"\n'
    put(Path(str(month).format("January")) / "npidata_pfile_20050523-20200112.csv", head + '1,1,M,A,\n2,2,,B,C\n')
    put(Path(str(month).format("January")) / "npidata_pfile_20050523-20200112_FileHeader.csv", head)
    put(Path(str(month).format("February")) / "npidata_pfile_20050523-20200209.csv", head + '1,1,M,A,D\n2,2,,B,C\n')
    wk = root / "NPPES_Data_Dissemination_{}_Weekly"
    put(Path(str(wk).format("020320_020920")) / "npidata_pfile_20200203-20200209.csv", head + '1,1,X,A,D\n')
    put(Path(str(wk).format("021020_021620")) / "npidata_pfile_20200210-20200216.csv", head + '1,1,F,A,D\n')
    put(Path(str(wk).format("021720_022320")) / "npidata_pfile_20200217-20200223.csv", head + '1,1,U,A,D\n3,1,F,Z,\n')
    put(root / "pgender201912.csv", "npi,pgender\n1,M\n")
    put(root / "pgender20113.csv", "npi,pgender\n1,Q\n")
    return str(root)


def test_file_discovery(spark, landing):
    all_files = files.list_files(spark, landing)
    found = rows(files.snapshot_files(all_files), "month")
    assert found == [(date(2020, 1, 1),), (date(2020, 2, 1),)]
    weeks = rows(files.weekly_updates(all_files), "week", "week_end")
    assert weeks == [(date(2020, 2, 10), date(2020, 2, 16)), (date(2020, 2, 17), date(2020, 2, 23))]
    assert rows(files.single_variable_files(all_files, "pgender"), "month") == [(date(2011, 3, 1),), (date(2019, 12, 1),)]


def test_header_of_a_file_longer_than_one_split(spark, tmp_path):
    """A scan in pieces leaves open which piece's first line comes first."""
    long = tmp_path / "long.csv"
    put(long, "NPI, Code \n" + "".join(f"{i},x\n" for i in range(5000)))
    sizes = {"spark.sql.files.maxPartitionBytes": "1024", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        assert spark.read.text(str(long)).rdd.getNumPartitions() > 8
        # unlimited, the head's scan is still one piece
        assert files.first_lines(spark, str(long), 10_000).rdd.getNumPartitions() == 1
        assert files.first_lines(spark, str(long), 10_000).count() == 5001
        assert files.header_catalogue(spark, [str(long)]) == {str(long): ("NPI", " Code ")}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_panel_from_landed_files(spark, landing, tmp_path):
    root = str(tmp_path / "panels")
    P.refresh_variable(spark, landing, root, "pgender", update=False)
    got = rows(panels.read_panel(spark, root, "pgender"), "npi", "month", "pgender")
    assert got == [(1, date(2019, 12, 1), "M"), (1, date(2020, 1, 1), "M"), (1, date(2020, 2, 1), "U"),
                   (2, date(2020, 1, 1), None), (2, date(2020, 2, 1), None), (3, date(2020, 2, 1), "F")]
    # refreshing again changes nothing
    P.refresh(spark, landing, root, include=["pgender"])
    assert rows(panels.read_panel(spark, root, "pgender"), "npi", "month", "pgender") == got
    with pytest.raises(ValueError):
        P.refresh(spark, landing, root, include=["a"], exclude=["b"])


def test_slots_keep_their_number(spark, landing, tmp_path):
    root = str(tmp_path / "panels")
    P.refresh_variable(spark, landing, root, "ptaxcode", update=False)
    jan = panels.read_panel(spark, root, "ptaxcode").where("month = '2020-01-01'")
    assert rows(jan, "npi", "seq", "ptaxcode") == [(1, 1, "A"), (2, 1, "B"), (2, 2, "C")]
    only = panels.read_panel(spark, root, "ptaxcode", spark.createDataFrame([(3,)], "npi long"))
    assert {r.npi for r in only.collect()} == {3}


def test_refresh_refuses_to_lose_values(spark):
    old = spark.createDataFrame([(i, date(2020, 1, 1), "a") for i in range(5)], "npi long, month date, v string")
    with pytest.raises(AuditError):
        P.refreshed(old, old.where("npi > 1"))


def test_secondary_locations_are_numbered(spark):
    h = S.SECONDARY_HEADERS["ploc2statename"]
    wide = spark.createDataFrame([("1", "MA"), ("1", "NY"), ("2", "CA")], f"NPI string, `{h}` string")
    out = panels.snapshot_to_panel(wide, "ploc2statename", {"month": F.lit("2020-01-01").cast("date")})
    assert rows(out, "npi", "seq", "ploc2statename") == [(1, 1, "MA"), (1, 2, "NY"), (2, 1, "CA")]


def test_registry_catalog(spark, landing, tmp_path):
    root = str(tmp_path / "panels")
    for v in ("entity", "pgender", "ptaxcode"):
        P.refresh_variable(spark, landing, root, v, update=False)
    tax = spark.createDataFrame([("A", "T", "Dentist", None)], "TaxonomyCode string, Type string, Classification string, Specialization string")
    reg = Registry(spark, root, tax, entities=1)
    assert rows(reg.gender()) == [(1, "U"), (3, "F")]
    assert rows(reg.ptaxcode(), "npi", "Classification") == [(1, "Dentist")]
    assert "gender" in Registry.attributes()


def test_stata_files(spark, tmp_path):
    import pandas as pd
    for m in (1, 2):
        pd.DataFrame({"npi": [1, 2], "seq": [1, 2], "ptaxcode": ["390200000X", f"T{m}"]}).to_stata(
            tmp_path / f"ptaxcode2008{m}.dta", write_index=False)
    schema = T.StructType.fromDDL("npi long, ptaxcode string, path string")
    out = files.read_stata(spark, str(tmp_path / "*.dta"), ["npi", "ptaxcode"], schema, chunk=1)
    assert out.count() == 4
    dated = files.single_variable_files(out, "ptaxcode")
    assert rows(panels.months_with_code(dated)) == [(1, date(2008, 1, 1)), (1, date(2008, 2, 1))]
    back = panels.read_months(spark, str(tmp_path), "ptaxcode")
    assert rows(back.where("npi = 2"), "seq", "ptaxcode", "month") == [
        (2, "T1", date(2008, 1, 1)), (2, "T2", date(2008, 2, 1))]


def test_text_keeps_words_and_zeros(spark, tmp_path):
    put(tmp_path / "a.csv", 'npi,plname,zip\n1,NA,02139\n2,NULL,\n3,"O""HARA, X",1\n')
    out = files.read_text_table(spark, str(tmp_path / "a.csv"))
    assert rows(out) == [("1", "NA", "02139"), ("2", "NULL", None), ("3", 'O"HARA, X', "1")]


def test_claims_files(spark, tmp_path):
    put(tmp_path / "d/PartD_Prescriber_PUF_NPI_DRUG_15/x_DRUG_15.txt", "npi\tdrug_name\ttotal_claim_count\n1\tA\t11\n")
    put(tmp_path / "d/PartD_Prescriber_PUF_NPI_15/x_NPI_15.txt", "npi\ttotal_claim_count\n1\t12\n")
    put(tmp_path / "d/PartD_Prescriber_PUF_NPI_12/x_NPI_12.txt", "npi\ttotal_claim_count\n9\t12\n")
    assert rows(claims.part_d(spark, str(tmp_path / "d"), summary=True)) == [("1", "12", 2015)]
    assert rows(claims.part_d(spark, str(tmp_path / "d"), columns=["npi", "drug_name"])) == [("1", "A", 2015)]
    put(tmp_path / f"o/{claims.OPIOID}2016.csv", "NPI,Opioid Claim Count\n1,\n")
    assert rows(claims.part_d_opioid(spark, str(tmp_path / "o"))) == [("1", None, 2016)]
    put(tmp_path / f"b/{claims.PART_B_DETAIL}CY2012.csv", "NPI,HCPCS_CODE,BENE_UNIQUE_CNT\n1,X,5\n")
    put(tmp_path / f"b/{claims.PART_B_DETAIL}CY2016.csv", "National Provider Identifier ,HCPCS Code,Other\n2,Y,z\n")
    wanted = ["National Provider Identifier", "HCPCS Code", "Number of Medicare Beneficiaries"]
    got = claims.part_b(spark, str(tmp_path / "b"), columns=wanted)
    assert rows(got, *wanted, "Year") == [("1", "X", "5", 2012), ("2", "Y", None, 2016)]


def test_directory_vintages(spark, tmp_path):
    names = list(S.DIRECTORY_COLUMNS)
    line = ",".join(["7"] + ["x"] * 17 + ["55"] + ["3"] + ["x"] * 5 + ["02139", "6175550000"] + ["x"] * 14)
    put(tmp_path / "a/Directory_2014-03-01.csv", line + "\nbroken,line\n" + line.replace("7,", "99,", 1) + ",one,too,many\n")
    short = ",".join(["8"] + ["x"] * 17 + ["56"] + ["3"] + ["x"] * 5 + ["10001"] + ["x"] * 14)
    header = ",".join(n for n in names if n != "Phone Number")
    put(tmp_path / "a/Directory_2014-06-01.csv", header + "\n" + short + "\n")
    put(tmp_path / "a/Directory_2016-07-01.csv", "NPI,Zip Code,Group Practice PAC ID\n9,90210,,57\n")
    put(tmp_path / "a/National_June_2017.csv", "npi,zip,org_pac_id,phn_numbr\n10,73301, ,5125550000\n")
    out = directory.read_directory(spark, str(tmp_path), ["zip", "group_id", "phone"], with_date=True)
    assert rows(out, "npi", "zip", "group_id", "phone", "date") == [
        (10, "73301", None, "5125550000", date(2017, 6, 1)), (7, "02139", 55, "6175550000", date(2014, 3, 1)),
        (8, "10001", 56, None, date(2014, 6, 1)), (9, "90210", 57, None, date(2016, 7, 1))]
    put(tmp_path / "a/Directory_2014-12-01.csv", "NPI,Zip Code\n11,60601\n12\n13,1,2\n")
    again = directory.read_directory(spark, str(tmp_path), ["zip", "group_id", "phone"], False, with_date=True)
    report = directory.store_directory(spark, str(tmp_path), ["zip", "group_id", "phone"], str(tmp_path / "stored"))
    order = ["npi", "zip", "group_id", "phone", "date"]
    assert rows(spark.read.parquet(str(tmp_path / "stored")), *order) == rows(again, *order)
    assert rows(report, "date", "lines", "malformed", "without_id") == [
        (date(2014, 3, 1), 3, 2, 0), (date(2014, 6, 1), 2, 0, 1), (date(2014, 12, 1), 3, 2, 0),
        (date(2016, 7, 1), 2, 0, 1), (date(2017, 6, 1), 1, 0, 0)]


def test_licence_list(spark, tmp_path):
    put(tmp_path / "l.csv", "NameFull,DateLastCertified,PractitionerType,Date,DateGranted,State\n"
        "ann lee,2015-01-01,md,20089,,MA\nbo kay,2014-01-01,np,20089,2015-01-01,NY\nAnn Lee,2015-01-01,MD,20089,,CA\n")
    out = licences.read_licences(spark, str(tmp_path / "l.csv"))
    assert rows(out, "NameFull", "samhsa_id", "Date", "State") == [
        ("ANN LEE", 0, date(2015, 1, 1), "CA"), ("ANN LEE", 0, date(2015, 1, 1), "MA"), ("BO KAY", 1, date(2015, 1, 1), "NY")]
    put(tmp_path / "bad.csv", "NameFull,DateLastCertified,PractitionerType,Date,DateGranted,State\nx,2015-01-02,md,20089,,MA\n")
    with pytest.raises(AuditError):
        licences.read_licences(spark, str(tmp_path / "bad.csv"))


def test_csv_sink(spark, tmp_path):
    panels.write_csv(spark.createDataFrame([(1, "a")], "k int, v string"), str(tmp_path / "out"))
    assert rows(files.read_text_table(spark, str(tmp_path / "out"))) == [("1", "a")]


def test_weekly_stream_keeps_latest_week(spark, tmp_path):
    landing, root, state = (str(tmp_path / n) for n in ("in", "panels", "state"))
    schema = "npi long, week date, pgender string"

    def land(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(landing)

    def run():
        q = weekly.start(weekly.weekly_stream(spark, landing, schema), root, "pgender", state)
        q.awaitTermination(120)

    land([(1, date(2020, 2, 10), "F"), (2, date(2020, 1, 6), "M")])
    run()
    land([(1, date(2020, 2, 3), "OLD"), (2, date(2020, 2, 3), "M")])
    run()
    got = spark.read.schema("npi long, week date, pgender string, month date").parquet(f"{root}/pgender")
    assert rows(got, "npi", "month", "pgender") == [
        (1, date(2020, 2, 1), "F"), (2, date(2020, 1, 1), "M"), (2, date(2020, 2, 1), "M")]


def test_secondary_location_rows_stay_together(spark):
    """All variables of a file number its rows alike."""
    heads = S.SECONDARY_HEADERS
    names = ["ploc2line1", "ploc2cityname"]
    data = [("1", "ZED ST", "ALBANY"), ("1", "ASH ST", "YONKERS"), ("1", None, "BOSTON"), ("1", None, "BOSTON")]
    wide = spark.createDataFrame(data, "NPI string, " + ", ".join(f"`{heads[n]}` string" for n in names))
    parts = [panels.snapshot_to_panel(wide, n, {"month": F.lit("2020-01-01").cast("date")}) for n in names]
    joined = parts[0].join(parts[1], ["npi", "month", "seq"])
    assert rows(joined, *names) == sorted([d[1:] for d in data], key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_unreadable_values_are_errors(spark):
    h = S.SINGLE_HEADERS["penumdate"]
    wide = spark.createDataFrame([("1", "13/45/2014")], f"NPI string, `{h}` string")
    with pytest.raises(Exception, match="not readable: penumdate"):
        panels.snapshot_to_panel(wide, "penumdate").collect()
    blank = spark.createDataFrame([("1", " "), ("2", "01/31/2014"), ("3", None)], f"NPI string, `{h}` string")
    assert rows(panels.snapshot_to_panel(blank, "penumdate"), "npi", "penumdate") == [
        (1, None), (2, date(2014, 1, 31)), (3, None)]


def test_shared_folder_is_what_the_session_names(spark):
    from rosterlake import session

    class Fake:
        def __init__(self, conf, master, checkpoint=None):
            self.conf, self.sparkContext, self.master = conf, self, master
            self.getCheckpointDir = lambda: checkpoint

    assert session.shared_dir(Fake({"spark.checkpoint.dir": "s3a://a"}, "yarn", "s3a://b")) == "s3a://a"
    assert session.shared_dir(Fake({}, "yarn", "s3a://b")) == "s3a://b"
    assert session.shared_dir(Fake({"spark.sql.warehouse.dir": "file:/w"}, "local[2]")) == "file:/w"
    assert session.shared_dir(Fake({"spark.sql.warehouse.dir": "s3a://w"}, "yarn")) == "s3a://w"
    for folder in ("file:/w", "/w"):
        with pytest.raises(ValueError):
            session.shared_dir(Fake({"spark.sql.warehouse.dir": folder}, "yarn"))


def test_stream_reads_only_touched_months(spark, tmp_path, monkeypatch):
    plans = []
    cut = weekly.cut
    monkeypatch.setattr(weekly, "cut", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    for week in (date(2020, 1, 6), date(2020, 2, 3)):
        batch = spark.createDataFrame([(1, week, "M")], "npi long, week date, pgender string")
        weekly.upsert_weeks(batch, str(tmp_path), "pgender")
    line = next(x for x in plans[-1].splitlines() if "PartitionFilters" in x)
    assert "month" in line.split("PartitionFilters:")[1].split("]")[0] and "2020-02-01" in plans[-1]


def test_many_files_are_as_many_scans_as_headers(spark, tmp_path):
    """60 files with 3 headers: 3 branches, whatever the files' order, and the
    year of each row from its own file."""
    from rosterlake.sources import claims, files
    heads = ["npi\tdrug\tn", "npi\tn\tdrug", "npi\tdrug\tn\textra"]
    for i in range(60):
        year, k = 2013 + i % 5, i % 3
        row = {0: f"{i}\tA\t{year}", 1: f"{i}\t{year}\tA", 2: f"{i}\tA\t{year}\tz"}[k]
        (tmp_path / f"PartD_NPI_DRUG_{i:03d}_{year}.txt").write_text(f"{heads[k]}\n{row}\n")
    paths = files.paths_of(files.list_files(spark, str(tmp_path)))
    assert len(files.read_groups(spark, paths, "\t")) == 3
    out = claims.part_d(spark, str(tmp_path), columns=["npi", "drug", "n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3
    got = out.collect()
    assert len(got) == 60 and all(r.drug == "A" and r.n == str(r.Year) == str(2013 + int(r.npi) % 5) for r in got)


def test_header_names_that_repeat_or_miss(spark, tmp_path):
    from rosterlake.sources import files
    (tmp_path / "a b+c.csv").write_text("npi,x,X,\n1,2,3,4\n")
    df, = files.read_groups(spark, [f"file:{tmp_path}/a b+c.csv"])
    assert df.columns == ["npi", "x1", "X2", "_c3", "__path"]
    assert tuple(df.first())[:4] == ("1", "2", "3", "4") and df.first()["__path"].endswith("/a b+c.csv")
