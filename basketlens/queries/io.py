"""Source and sink queries. What is written goes below the shared folder and is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.operators import filters as L
from basketlens.operators.identity import join_ident_resolve
from basketlens.functions.columns import iso_week_id
from basketlens.queries import sqlparts as Q
from basketlens.queries.flagging import YEAR_END, YEAR_START
from basketlens.queries.registry import query
from basketlens.queries.relational import RESOLVED
from basketlens.session import scratch_path
from basketlens.sources import readers as I
from basketlens.sources import roles as R
from basketlens.sources import writers as O

ITEM_SQL = "transaction_uid, upc_id, store_id, date_id, net_spend_amt, unit"
ITEM = ITEM_SQL.split(", ")


@query("scan_txn_window", Q.with_(
    f"SELECT {ITEM_SQL}, coalesce(CASE WHEN store_region <> 'ASIA' THEN store_region END, 'Unidentified') "
    f"AS store_region FROM txn WHERE date_id BETWEEN {YEAR_START} AND {YEAR_END} AND channel = 'OFFLINE' "
    "AND net_spend_amt > 0", "txn"))
def scan_txn_window(spark, sf):
    region = F.when(F.col("store_region") != "ASIA", F.col("store_region"))
    fact = R.store_sales(spark, sf).withColumns({"store_region": region, "week_id": iso_week_id(F.col("date_id"))})
    wanted = (F.col("channel") == "OFFLINE") & (F.col("net_spend_amt") > 0)
    return L.scan_txn_window(fact, R.YEAR, wanted).select(*ITEM, "store_region")


@query("scan_sql_filtered", Q.with_(
    f"SELECT {ITEM_SQL} FROM txn WHERE date_id BETWEEN {YEAR_START} AND {YEAR_END} AND format_id IN "
    "(1, 2, 3, 4) AND net_spend_amt > 0 AND unit > 0 AND CAST(store_id AS VARCHAR) NOT LIKE '8%'", "txn"))
def scan_sql_filtered(spark, sf):
    return L.scan_sql_filtered(
        R.store_sales(spark, sf), R.YEAR.start, R.YEAR.end, (1, 2, 3, 4), "8%"
    ).select(*ITEM)


@query("read_csv_mapping", Q.with_(
    "SELECT upc_id, class_code, subclass_name FROM products", "products"))
def read_csv_mapping(spark, sf):
    path = scratch_path(spark, "mapping")
    R.products(spark, sf).select("upc_id", "class_code", "subclass_name").write.csv(
        path, header=True
    )
    return I.read_csv_mapping(spark, path, "upc_id bigint, class_code string, subclass_name string")


FEEDBACK_COLUMNS = (
    "feedback_id", "dib_cust_code", "Bought_Status", "Contact_Status", "Reason_code",
    "First_Call_Date",
)
FEEDBACK_SCHEMA = "feedback_id bigint, " + ", ".join(f"{c} string" for c in FEEDBACK_COLUMNS[1:])


def _deliver(spark, sf, source: K.FeedbackSource) -> str:
    """One insurer's feedback as pipe-separated files; returns their folder."""
    path = scratch_path(spark, "feedback")
    (
        R.feedback(spark, sf).where(F.col("insurer_nm") == source.insurer_nm)
        .select(*FEEDBACK_COLUMNS)
        .write.options(header=True, sep="|", encoding=I.reader_charset(source.encoding))
        .csv(path)
    )
    return path


def delivered(spark, sf, source: K.FeedbackSource) -> DataFrame:
    folder = _deliver(spark, sf, source)
    return I.read_delimited_feedback(spark, f"{folder}/*.csv", FEEDBACK_SCHEMA, source)


@query("read_delimited_feedback", Q.with_(
    f"SELECT {', '.join(FEEDBACK_COLUMNS)}, insurer_nm, true AS has_file FROM feedback", "feedback"))
def read_delimited_feedback(spark, sf):
    parts = [delivered(spark, sf, s) for s in K.FEEDBACK_SOURCES.values()]
    return parts[0].unionByName(parts[1]).select(
        *FEEDBACK_COLUMNS, "insurer_nm", F.col("src_file").endswith(".csv").alias("has_file")
    )


@query("stage_feedback", Q.with_(
    f"SELECT {', '.join(c for c in FEEDBACK_COLUMNS if c != 'dib_cust_code')}, insurer_nm, ngc_customer_id, "
    "household_id, golden_id FROM res", "feedback", "numbers", "known",
    s="SELECT * FROM feedback WHERE insurer_nm = 'CIG'", res=RESOLVED.format(source="s")))
def stage_feedback(spark, sf):
    raw = delivered(spark, sf, K.FEEDBACK_SOURCES["CIGNA"]).drop("src_file")
    return join_ident_resolve(raw, R.customer_numbers(spark, sf), R.known_customers(spark, sf))


def _staged(spark, sf) -> str:
    """Staged feedback of the first half of the month."""
    path = scratch_path(spark, "staged")
    early = R.feedback(spark, sf).where(F.col("src_file") < "lot_20240116.txt")
    O.write_file(early, path)
    return path


@query("append_new_files", Q.with_(
    "SELECT * FROM feedback WHERE src_file < 'lot_20240116.txt' OR dib_cust_code IS NOT NULL", "feedback"))
def append_new_files(spark, sf):
    path = _staged(spark, sf)
    for _ in range(2):  # the second run finds every file staged
        O.append_new_files(R.feedback(spark, sf), path)
    return I.read_staged(spark, path)


@query("read_staged_count", Q.with_(
    "SELECT count(*) AS prior_rows FROM feedback WHERE src_file < 'lot_20240116.txt'", "feedback"))
def read_staged_count(spark, sf):
    return I.read_staged_count(spark, _staged(spark, sf))


@query("read_feature_tables", Q.with_(
    "SELECT household_id, count(*) AS n, 'baskets' AS feature FROM baskets GROUP BY 1 UNION ALL SELECT "
    "user_id, count(*), 'events' FROM events GROUP BY 1", "baskets"))
def read_feature_tables(spark, sf):
    base = scratch_path(spark, "features")
    registry = {"baskets": ("features", "cust_baskets"), "events": ("events", "cust_events")}
    frames = {
        "baskets": R.baskets(spark, sf),
        "events": R.table(spark, sf, "events").withColumnRenamed("user_id", "household_id"),
    }
    for feature, (folder, name) in registry.items():
        counted = frames[feature].groupBy("household_id").agg(F.count(F.lit(1)).alias("n"))
        O.write_file(counted, f"{base}/{folder}/{name}.parquet")
    tables = I.read_feature_tables(spark, base, registry)
    parts = [df.withColumn("feature", F.lit(f)) for f, df in tables.items()]
    return parts[0].unionByName(parts[1])


@query("lead_file_map", Q.with_(
    "SELECT feedback_id, src_file, lead_day FROM feedback LEFT JOIN (SELECT DISTINCT src_file AS f, "
    "substr(src_file, 5, 8) AS lead_day FROM feedback WHERE src_file < 'lot_20240121.txt') ON f = src_file",
    "feedback"))
def lead_file_map(spark, sf):
    feedback = R.feedback(spark, sf)
    leads = feedback.where(F.col("src_file") < "lot_20240121.txt").select(
        F.regexp_replace("src_file", r"\.txt$", "_1").alias("Filename"),
        F.substring("src_file", 5, 8).alias("lead_day"),
    ).distinct()
    return I.join_lead_files(feedback, I.lead_file_map(leads)).select(
        "feedback_id", "src_file", "lead_day"
    )


@query("write_table", Q.with_("SELECT household_id, channel, n FROM t", "baskets",
    t="SELECT household_id, channel, count(*) AS n FROM baskets GROUP BY ALL"))
def write_table(spark, sf):
    counted = R.baskets(spark, sf).groupBy("household_id", "channel").agg(
        F.count(F.lit(1)).alias("n")
    )
    name = f"basketlens_{uuid.uuid4().hex}"
    O.write_table(counted, name, scratch_path(spark, "table"))
    return spark.table(name)


@query("write_file", Q.with_(
    "SELECT transaction_uid, household_id, date_id, channel FROM baskets UNION ALL SELECT "
    "transaction_uid, household_id, date_id, channel FROM baskets WHERE channel = 'ONLINE'", "baskets"))
def write_file(spark, sf):
    rows = R.baskets(spark, sf).select("transaction_uid", "household_id", "date_id", "channel")
    path = scratch_path(spark, "file")
    O.write_file(rows, path, "orc")
    O.write_file(rows.where(F.col("channel") == "ONLINE"), path, "orc", "append")
    return I.read_staged(spark, path, "orc")


@query("sample_rows")
def sample_rows(spark, sf):
    return L.sample_rows(R.sales(spark, sf), 0.001, seed=7)
