import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans.layers import RAW_TABLES
from ledgerloom.session import at_once, session_aside
from ledgerloom.sources import Lake, export_csv, ingest_table, read_csv, read_csv_head, scratch_folder, written
from ledgerloom.sources import files, lake
from ledgerloom.sources.files import type_of_name


def test_ingest_keeps_or_replaces_history(spark, tmp_path):
    export_csv(spark.createDataFrame([(1, "a"), (2, None)], "ID int, Name string"), f"{tmp_path}/raw/T.csv")
    bronze = Lake(spark, f"{tmp_path}/bronze")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    for day in days:
        ingest_table(f"{tmp_path}/raw", bronze, "T", day, keep_history=True)
    assert bronze.read("t").count() == 4 and bronze.read("t", days[0]).count() == 2
    assert bronze.read("t").columns == ["id", "name", "ingest_timestamp", "ingest_date"]
    ingest_table(f"{tmp_path}/raw", bronze, "T", days[1])
    assert bronze.read("t").count() == 2


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.range(4).withColumn("ingest_date", F.lit(dt.date(2024, 1, 1)))
    lake.replace(df, "t", ["ingest_date"])
    plan = lake.read("t", dt.date(2024, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_schema_must_match_where_asked(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.replace_rows(spark.range(3), "t")
    lake.replace_rows(spark.range(5), "t")
    assert lake.read("t").count() == 5
    with pytest.raises(ValueError):
        lake.replace_rows(spark.range(3).withColumn("more", F.lit(1)), "t")


def test_csv(spark, tmp_path):
    export_csv(spark.range(30).repartition(3), f"{tmp_path}/out", sep=";", n_files=2)
    assert read_csv(spark, f"{tmp_path}/out", "id long", ";").count() == 30
    assert len(list((tmp_path / "out").glob("part-*"))) == 2
    assert read_csv_head(spark, f"{tmp_path}/out", 7).count() == 7


class Cluster:
    """A session stand-in: only its settings are asked for."""

    def __init__(self, master="spark://somewhere", **settings):
        self.master = master
        self.settings = settings
        self.sparkContext = self

    def getConf(self):
        return {k.replace("__", "."): v for k, v in self.settings.items()}


def test_scratch_follows_the_session():
    shared = Cluster(spark__checkpoint__dir="s3://shared/tmp/")
    assert scratch_folder(shared, "x").startswith("s3://shared/tmp/x-")
    with pytest.raises(ValueError):
        scratch_folder(Cluster(), "x")
    assert scratch_folder(Cluster("local[4]"), "x").startswith("/tmp/run-")


def test_raw_tables():
    assert len(RAW_TABLES) == 8


def test_types_follow_the_header(spark, tmp_path):
    """Only the header line is read for the schema, and a bad line is reported with its text."""
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = ["SK_ID_CURR,NAME_TYPE,AMT_CREDIT,CNT_CHILDREN", "1,a,2.5,3", "2,b,oops,1", "3,c", "4,d,1,2,9", "5,,,", '6,"x,y",7,']
    (raw / "T.csv").write_text("\n".join(lines) + "\n")
    bronze = Lake(spark, f"{tmp_path}/bronze")
    loaded = ingest_table(str(raw), bronze, "T", dt.date(2024, 1, 1))
    assert (loaded.table, loaded.rows, loaded.rejected) == ("t", 3, 3)
    kept = bronze.read("t")
    assert kept.dtypes[:4] == [("sk_id_curr", "bigint"), ("name_type", "string"), ("amt_credit", "double"), ("cnt_children", "int")]
    assert sorted(tuple(r)[:4] for r in kept.collect()) == [(1, "a", 2.5, 3), (5, None, None, None), (6, "x,y", 7.0, None)]
    assert sorted(r["line"] for r in bronze.read("t_rejected").collect()) == ["2,b,oops,1", "3,c", "4,d,1,2,9"]
    # A later clean load leaves no old complaint behind.
    (raw / "T.csv").write_text("\n".join(lines[:2]) + "\n")
    assert ingest_table(str(raw), bronze, "T", dt.date(2024, 1, 1)).rejected == 0
    assert bronze.read("t_rejected").count() == 0


@pytest.mark.parametrize("name,kind", [
    ("SK_ID_PREV", "bigint"), ("sk_dpd_def", "int"), ("NAME_CONTRACT_STATUS", "string"), ("FLAG_OWN_CAR", "string"),
    ("FLAG_DOCUMENT_3", "int"), ("EXT_SOURCE_1", "double"), ("FONDKAPREMONT_MODE", "string"), ("YEARS_BUILD_MODE", "double"),
    ("DAYS_BIRTH", "int"), ("DAYS_LAST_DUE", "double"), ("AMT_REQ_CREDIT_BUREAU_DAY", "double"),
])
def test_type_of_name(name, kind):
    assert type_of_name(name) == kind


def test_header_with_other_names_is_an_error(spark, tmp_path):
    (tmp_path / "T.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|column"):
        ingest_table(str(tmp_path), Lake(spark, f"{tmp_path}/bronze"), "T", schema="a int, c int")


def test_tables_are_known_to_other_sessions(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/it's a lake")
    assert lake.names() == []
    lake.replace(spark.range(5), "plain")
    lake.replace(spark.range(6).withColumn("day", F.col("id") % 2), "parted", ["day"])
    assert lake.names() == ["parted", "plain"]
    other = spark.newSession()
    assert Lake(spark, lake.base).create_tables("known") == ["parted", "plain"]
    assert other.sql("SELECT count(*), sum(id) FROM known.parted WHERE day = 1").first() == (3, 9)
    # A new partition and a new schema are seen after the next registration; data survive a drop.
    lake.replace(spark.range(6, 8).withColumn("day", F.lit(7)), "parted", ["day"], only_partitions_written=True)
    lake.replace(spark.range(2).withColumn("more", F.lit("x")), "plain")
    lake.create_tables("known")
    assert other.sql("SELECT count(*) FROM known.parted").first()[0] == 8
    assert other.table("known.plain").columns == ["id", "more"]
    other.sql("DROP TABLE known.plain")
    assert lake.read("plain").count() == 2
    spark.sql("DROP DATABASE known CASCADE")


def test_scratch_tables_and_raw_files_can_be_small(spark, tmp_path):
    """What the layers write in between is compressed and reads back the same."""
    df = spark.range(2000).select(F.col("id").alias("ID"), F.when(F.col("id") % 3 > 0, "word").alias("NAME"))
    export_csv(df, f"{tmp_path}/raw/T.csv", compression="gzip")
    assert list((tmp_path / "raw" / "T.csv").glob("*.csv.gz")) and not list((tmp_path / "raw" / "T.csv").glob("*.csv"))
    bronze = Lake(spark, f"{tmp_path}/bronze", options={"compression": "zstd"})
    assert ingest_table(f"{tmp_path}/raw", bronze, "T", schema="ID bigint, NAME string").rows == 2000
    assert bronze.read("t").select("id", "name").exceptAll(df.toDF("id", "name")).count() == 0
    kept = written(df)
    for files in (kept.inputFiles(), bronze.read("t").inputFiles()):
        assert all(f.endswith(".zstd.parquet") for f in files)


def test_a_raw_file_is_written_once(spark, tmp_path, monkeypatch):
    """No scratch copy, and counting on the way leaves a session that fitted models can serialise."""
    def no_scratch(*_):
        raise AssertionError("a scratch table")

    monkeypatch.setattr(files, "scratch_folder", no_scratch)
    (tmp_path / "T.csv").write_text("SK_ID_CURR,AMT\n" + "".join(f"{i},{'x' if i % 50 == 7 else i}\n" for i in range(200)))
    bronze = Lake(spark, f"{tmp_path}/bronze")
    for history in (False, True):
        loaded = ingest_table(str(tmp_path), bronze, "T", dt.date(2024, 1, 1), keep_history=history)
        assert (loaded.rows, loaded.rejected) == (196, 4)
        assert bronze.read("t").count() == 196 and bronze.read("t_rejected").count() == 4
    assert all(r["file"].endswith("T.csv") for r in bronze.read("t_rejected").collect())
    assert len(spark._jvm.org.apache.spark.util.Utils.serialize(spark._jsparkSession)) > 0


def test_the_session_aside_has_the_settings_of_the_other(spark):
    kept = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        aside = session_aside(spark)
        assert aside.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_tables_that_do_not_need_each_other_are_made_side_by_side(spark, monkeypatch):
    """Each waits for another that has begun."""
    both = threading.Barrier(2)

    def meet(raw, bronze, name, *_):
        both.wait(30)
        return name

    monkeypatch.setattr(lake, "ingest_table", meet)
    assert lake.ingest_tables("raw", Lake(spark, "bronze"), ["A", "B", "C", "D"]) == ["A", "B", "C", "D"]


def test_an_error_of_one_table_is_raised(spark):
    def fail():
        raise ValueError("no such table")

    with pytest.raises(ValueError, match="no such table"):
        at_once(spark, [lambda: spark.range(3).count(), fail])
    assert at_once(spark, [lambda i=i: spark.range(i).count() for i in range(9)]) == list(range(9))
    assert at_once(spark, []) == []
