from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from __spark_entry__ import queries
from basketlens import config as K
from basketlens.session import scratch_path, shared_dir
from basketlens.sources import readers as I
from basketlens.sources import roles as R
from basketlens.sources import writers as O
from basketlens.streaming.feedback import feedback_stream, stage_available

SCHEMA = StructType([StructField("dib_cust_code", StringType()), StructField("note", StringType())])


def _deliver(folder, name, text, encoding):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))


def test_windows_text(spark, tmp_path):
    _deliver(tmp_path / "a", "x_AZAY_FDBK1_202208.txt", "dib_cust_code|note\n01|5 € – “ok” é\n", "cp1252")
    row = I.read_delimited_feedback(
        spark, f"{tmp_path}/{I.feedback_glob('AZAY')}", SCHEMA, K.FEEDBACK_SOURCES["AZAY"]).first()
    assert tuple(row) == ("01", "5 € – “ok” é", "x_AZAY_FDBK1_202208.txt", "AAC")


def test_glob_of_one_lot(spark, tmp_path):
    for lot in ("202208", "202209"):
        _deliver(tmp_path / lot, f"CIGNA_FDBK1_{lot}.txt", f"dib_cust_code|note\n{lot}|n\n", "utf-8")
    glob = I.feedback_glob("CIGNA", lot="202209")
    got = I.read_delimited_feedback(spark, f"{tmp_path}/{glob}", SCHEMA, K.FEEDBACK_SOURCES["CIGNA"]).collect()
    assert [r.dib_cust_code for r in got] == ["202209"]


def test_append_is_once_per_file(spark, tmp_path):
    path = str(tmp_path / "staged")
    columns = "dib_cust_code string, src_file string"
    O.write_file(spark.createDataFrame([("1", "f1")], columns), path)
    incoming = spark.createDataFrame([("1", "f1"), ("9", "f1"), ("2", "f2"), (None, "f2")], columns)
    for _ in range(3):
        O.append_new_files(incoming, path)
    assert sorted(tuple(r) for r in I.read_staged(spark, path).collect()) == [("1", "f1"), ("2", "f2")]
    assert I.read_staged_count(spark, path).first().prior_rows == 2


def test_an_append_that_dies_before_its_manifest_stages_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "staged")
    columns = "dib_cust_code string, src_file string"
    O.write_file(spark.createDataFrame([("1", "f1")], columns), path)
    second = spark.createDataFrame([("2", "f2"), ("3", "f2")], columns)

    def dies(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(O, "publish", dies)
        for _ in range(2):
            try:
                O.append_new_files(second, path)
            except RuntimeError:
                pass
    assert [tuple(r) for r in I.read_staged(spark, path).collect()] == [("1", "f1")]
    assert O.ledger(spark, path).count() == 0
    O.append_new_files(second, path)
    O.append_new_files(spark.createDataFrame([("4", "f3"), ("2", "f2")], columns), path)
    assert sorted(tuple(r) for r in I.read_staged(spark, path).collect()) == [("1", "f1"), ("2", "f2"), ("3", "f2"), ("4", "f3")]
    runs = O.ledger(spark, path).collect()
    assert sorted((r["src_file"], r["n_rows"]) for r in runs) == [("f2", 2), ("f3", 1)] and len({r["run"] for r in runs}) == 2


def test_stream_stages_each_file_once(spark, tmp_path):
    inbox, staged, checkpoint = (tmp_path / n for n in ("in", "staged", "cp"))
    source = K.FEEDBACK_SOURCES["CIGNA"]
    for n, text in enumerate(("1|a\n|b\n", "2|c\n")):
        _deliver(inbox, f"f{n}.txt", f"dib_cust_code|note\n{text}", "utf-8")
        stage_available(feedback_stream(spark, str(inbox), SCHEMA, source), str(staged), str(checkpoint))
    got = sorted((r.dib_cust_code, r.src_file) for r in spark.read.parquet(str(staged)).collect())
    assert got == [("1", "f0.txt"), ("2", "f1.txt")]


def test_lead_files(spark):
    leads = spark.createDataFrame([("LOT_A_1",)], "Filename string")
    assert I.lead_file_map(leads).first().Filename == "LOT_A.txt"


def test_shared_folder_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    df = spark.range(1000).withColumnRenamed("id", "household_id")
    for name in ("left_t", "right_t"):
        O.write_bucketed(df, name, 4, "household_id", str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_t").join(spark.table("right_t"), "household_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_scan_reads_the_whole_year(spark):
    run, sf = queries()["scan_txn_window"], "/root/testdata/sf0.01"
    sales = R.sales(spark, sf).where(F.col("date_id").between(R.YEAR.start, R.YEAR.end) & (F.col("channel") == "OFFLINE") & (F.col("net_spend_amt") > 0))
    ends = F.min("date_id").alias("first"), F.max("date_id").alias("last"), F.count(F.lit(1)).alias("n")
    assert run(spark, sf).agg(*ends).first() == sales.agg(*ends).first()
