"""Maps the star-schema test tables to the retail roles the operators work on.

Every role is a lazy DataFrame over the whole of its tables; nothing is invented except by
expressions on their columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.config import Window
from basketlens.functions import columns as C
from basketlens.functions.sizing import broadcast_if_small, join_parts
from basketlens.operators.joins import join_sized
from basketlens.sources.calendar import date_dim

HISTORY = Window(date(1995, 1, 1), date(2001, 8, 31))
YEAR = Window(date(2000, 9, 1), date(2001, 8, 31))
PREMIUM, NOT_PREMIUM, BUDGET = "%HOT%", "%RING%", "(?i)(small|old|bolt)"
DIVISIONS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
DEPARTMENTS = tuple(f"Brand#{n}" for n in range(1, 26))
SECTIONS = tuple(str(n) for n in range(1, 51))
DEPARTMENT_EXCLUDE = ("Brand#24", "Brand#25")
SECTION_EXCLUDE = ("49", "50")
DEPARTMENT_MERGE = {"Brand#1&Brand#2": ("Brand#1", "Brand#2")}
SECTION_MERGE = {"1&2": ("1", "2"), "10&20": ("10", "20")}
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
MONEY = "decimal(18,4)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def calendar(spark: SparkSession, window: Window = HISTORY) -> DataFrame:
    return date_dim(spark, window.start, window.end)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("upc_id"),
        F.col("p_type").alias("division_id"),
        F.col("p_brand").alias("department_code"),
        size.alias("section_code"),
        F.concat_ws("_", "p_brand", size).alias("class_code"),
        F.col("p_name").alias("subclass_code"),
        F.col("p_name").alias("subclass_name"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    fmt = F.element_at(
        F.array(F.lit("HDE"), F.lit("Talad"), F.lit("GoFresh")),
        (F.col("s_suppkey") % 3 + 1).cast("int"),
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("store_id"),
            (F.col("s_suppkey") % 6 + 1).cast("int").alias("format_id"),
            fmt.alias("store_format"),
            F.col("s_nationkey").alias("zone_id"),
            F.col("r_name").alias("store_region"),
        )
    )


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket headers. Orders carry no time of day; the hour comes from the order key."""
    hour = (F.col("o_orderkey") % 24).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_uid"),
        F.col("o_custkey").alias("household_id"),
        F.to_date("o_orderdate").alias("date_id"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=hour)).alias("tran_datetime"),
        F.when(F.col("o_orderstatus") == "P", "ONLINE").otherwise("OFFLINE").alias("channel"),
        tender_of(F.col("o_orderpriority")).alias("tender_type_group"),
        F.col("o_totalprice").cast(MONEY).alias("basket_amt"),
    )


def tender_of(priority):
    return (
        F.when(priority == "1-URGENT", "CASH")
        .when(priority == "2-HIGH", "CCARD")
        .when(priority == "3-MEDIUM", "COUPON")
        .when(priority == "4-NOT SPECIFIED", "VOUCH")
        .otherwise("OTHER")
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item lines with money as exact decimals."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_uid"),
        F.col("l_partkey").alias("upc_id"),
        F.col("l_suppkey").alias("store_id"),
        (price * (1 - discount)).cast(MONEY).alias("net_spend_amt"),
        (price * discount).cast(MONEY).alias("discount_amt"),
        F.col("l_quantity").alias("unit"),
    )


def sales(spark: SparkSession, sf_dir: str, headers: DataFrame | None = None) -> DataFrame:
    """Item lines with their basket header; with ``headers``, some rows of ``baskets``, the lines of these."""
    if headers is not None:
        return join_sized(items(spark, sf_dir), headers, "transaction_uid")
    sources = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return join_parts(items(spark, sf_dir), baskets(spark, sf_dir), "transaction_uid", *sources)


def with_products(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = broadcast_if_small(products(spark, sf_dir), table(spark, sf_dir, "part"))
    return df.join(dim, "upc_id")


def with_stores(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = broadcast_if_small(stores(spark, sf_dir), table(spark, sf_dir, "supplier"))
    return df.join(dim, "store_id")


def product_sales(spark: SparkSession, sf_dir: str, headers: DataFrame | None = None) -> DataFrame:
    return with_products(sales(spark, sf_dir, headers), spark, sf_dir)


def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_stores(sales(spark, sf_dir), spark, sf_dir)


def txn(spark: SparkSession, sf_dir: str, headers: DataFrame | None = None) -> DataFrame:
    """Item-level transaction fact: basket, product and store attributes on every line (of ``headers``, if given)."""
    return with_stores(product_sales(spark, sf_dir, headers), spark, sf_dir)


def event_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second transaction source with real times of day: one visit per user and hour."""
    hour = F.date_format("ts", "yyyyMMddHH")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("household_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), hour).alias("transaction_uid"),
        F.to_date("ts").alias("date_id"),
        F.col("ts").alias("tran_datetime"),
        F.col("value").cast(MONEY).alias("net_spend_amt"),
        F.lit(1.0).alias("unit"),
        F.col("event_type"),
    )


def till_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Till payments of a basket in a store; several kinds make a mixed payment."""
    kind = (
        F.when(F.col("l_returnflag") == "R", " CASH")
        .when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") <= 4), "CCARD ")
        .when(F.col("l_returnflag") == "A", "COUPON")
        .when(F.col("l_linenumber") <= 4, "VOUCH")
    )
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    dates = orders.select(F.col("o_orderkey").alias("transaction_uid"), F.to_date("o_orderdate").alias("date_id"))
    paid = lines.select(
        F.col("l_orderkey").alias("transaction_uid"),
        F.col("l_suppkey").alias("store_id"),
        kind.alias("tender_type_group"),
    )
    return join_parts(paid, dates, "transaction_uid", lines, orders).select(
        "transaction_uid", "store_id", "date_id", "tender_type_group")


def online_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "CASH")
        .when(F.col("o_orderpriority") == "2-HIGH", "CreditCard")
        .otherwise("Wallet")
    )
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "P")
        .select(F.col("o_orderkey").alias("transaction_uid"), kind.alias("tender_type_group"))
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card issue is the first order; every seventh customer has no issue date on file."""
    first = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("household_id"))
        .agg(F.min(F.to_date("o_orderdate")).alias("first_order"))
    )
    known = F.when(F.col("household_id") % 7 != 0, F.col("first_order"))
    return (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("household_id"),
            F.concat(F.lit("G"), F.col("c_custkey").cast("string")).alias("golden_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )
        .join(first, "household_id", "left")
        .withColumn("card_issue_date", known)
        .drop("first_order")
    )


def first_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("golden_id"))
        .agg(F.min(F.to_date("o_orderdate")).alias("first_txn_date"))
    )


def trader_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Households that bought like a trader in a quarter: four baskets or more."""
    return (
        baskets(spark, sf_dir)
        .groupBy("household_id", C.quarter_id(F.col("date_id")).alias("quarter_id"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n >= 4")
        .drop("n")
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First contact of a household: the day of its last basket, for some 20 days later."""
    later = (F.col("household_id") % 2 * 20).cast("int")
    return (
        baskets(spark, sf_dir)
        .groupBy("household_id")
        .agg(F.max("date_id").alias("last_day"))
        .select("household_id", F.date_add("last_day", later).alias("first_contact_date"))
    )


def promotions(spark: SparkSession, sf_dir: str, window: Window = HISTORY) -> DataFrame:
    """Thirty-day promotions of single products, set for a zone or for one store."""
    key, size = F.col("p_partkey"), F.col("p_size")
    start = F.date_add(F.lit(window.start), (key * 37 % (window.days - 40)).cast("int"))
    length = F.when(size % 13 == 0, -1).otherwise(29)
    by_zone = size % 4 != 0
    return table(spark, sf_dir, "part").select(
        key.alias("promo_id"),
        (size % 6 + 1).cast("int").alias("promo_offer_id"),
        F.when(size % 10 != 0, "PRICE").alias("change_type"),
        F.when(size % 5 == 0, "Cancelled").when(size % 5 != 1, "Live").alias("state_desc"),
        F.when(F.col("p_type").isin("PROMO", "ECONOMY"), "Y").otherwise("N").alias("active_flag"),
        start.alias("promo_start_date"),
        F.date_add(start, length).alias("promo_end_date"),
        F.when(by_zone, key % 25).alias("promo_storegroup_id"),
        F.when(~by_zone, (key % 10).cast("bigint")).alias("store_id"),
        key.alias("upc_id"),
        F.when(size % 3 == 0, key + 1).alias("upc_id_cond"),
        F.when(size % 3 != 0, key).alias("upc_id_reward"),
        F.when(key % 2 == 0, "rms12").otherwise("rms19").alias("source"),
    )


def promo_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores of each promotion zone, once per source system."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("bigint").alias("zone_id"),
        F.col("s_suppkey").alias("store_id"),
        F.explode(F.array(F.lit("rms12"), F.lit("rms19"))).alias("source"),
    )


def feedback(spark: SparkSession, sf_dir: str, years_back: int = 0) -> DataFrame:
    """Call-centre feedback of two insurers, as text the way their files carry it.

    ``years_back`` moves the calls: the test tables' events are 23 years later than their last orders.
    """
    kind, even = F.col("event_type"), F.col("event_id") % 2 == 0
    day = F.add_months(F.to_date("ts"), -12 * years_back)
    called = F.when(even, F.date_format(day, "MM/d/yyyy")).otherwise(
        F.date_format(day, "yyyy-MM-dd")
    )
    status = (
        F.when(kind == "click", "CONTACT")
        .when(kind.isin("view", "purchase"), "Contactable")
        .when(kind == "error", "Uncontactable")
        .otherwise("Pending")
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("feedback_id"),
        F.when(F.col("event_id") % 11 != 0, F.col("user_id").cast("string")).alias("dib_cust_code"),
        F.when(kind == "purchase", "Bought").otherwise("Not Bought").alias("Bought_Status"),
        status.alias("Contact_Status"),
        F.when(kind == "error", "U").when(kind != "view", kind).alias("Reason_code"),
        F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(called).alias("First_Call_Date"),
        F.when(even, "AAC").otherwise("CIG").alias("insurer_nm"),
        F.concat(F.lit("lot_"), F.date_format(day, "yyyyMMdd"), F.lit(".txt")).alias("src_file"),
    )


def household_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known outcome of a household, as a label."""
    bought = F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), "Bought")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("household_id"),
        bought.otherwise("Not Bought").alias("Bought_Status"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consent of each customer account."""
    key = F.col("c_custkey")
    golden = F.concat(F.lit("G"), key.cast("string"))
    return table(spark, sf_dir, "customer").select(
        F.when(key % 9 != 0, golden).otherwise("merged").alias("customer_id"),
        golden.alias("golden_id"),
        F.when(F.col("c_acctbal") >= 0, "Active").otherwise("Closed").alias("customer_status"),
        F.when(key % 4 != 0, "true").otherwise("false").alias("opted_in"),
        F.when(key % 6 == 0, "true").otherwise("false").alias("do_not_call"),
    )


def customer_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer numbers of the loyalty programme and their golden ids; not every one has one."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(key % 3 == 0).select(
        (key + 5).cast("string").alias("ngc_customer_id"),
        F.concat(F.lit("G"), key.cast("string")).alias("golden_id"),
    )


def known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden id of the households on file."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(key % 2 == 0).select(
        key.alias("household_id"), F.concat(F.lit("G"), key.cast("string")).alias("golden_id")
    )


def price_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.sum("basket_amt")
    label = (
        F.when(amount > 400000, "Most Price Insensitive").when(amount > 250000, "Price Insensitive")
        .when(amount > 100000, "Price Neutral").otherwise("Price Sensitive")
    )
    return (
        baskets(spark, sf_dir)
        .groupBy("household_id", C.month_id(F.col("date_id")).alias("period_id"))
        .agg(label.alias("truprice_seg_desc"))
    )


def fact_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.count(F.lit(1)) > 1, "Frequent").otherwise("Light")
    return (
        baskets(spark, sf_dir)
        .groupBy("household_id", C.iso_week_id(F.col("date_id")).alias("week_id"))
        .agg(label.alias("facts_seg_desc"))
    )


def life_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.count(F.lit(1)) > 1, "Family").otherwise("Single")
    return (
        baskets(spark, sf_dir)
        .groupBy("household_id", C.quarter_id(F.col("date_id")).alias("quarter_id"))
        .agg(label.alias("lifestage_seg_name"))
    )


def preferred_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.max("transaction_uid")
    return (
        baskets(spark, sf_dir)
        .groupBy("household_id", C.month_id(F.col("date_id")).alias("period_id"))
        .agg(
            (last % 100).cast("string").alias("pref_store_id"),
            F.when(last % 3 == 0, "missing").otherwise("HDE").alias("pref_store_format"),
            F.when(last % 4 == 0, "BKK").when(last % 4 == 1, "NORTH").alias("pref_store_region"),
        )
    )


def lifecycle_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        baskets(spark, sf_dir)
        .groupBy("household_id", C.iso_week_id(F.col("date_id")).alias("week_id"))
        .agg((F.max("transaction_uid") % 3).cast("int").alias("lifecycle_detailed_code"))
    )


LIFECYCLES = ((0, "New"), (1, "Growing"))


def lifecycle_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(LIFECYCLES), "lifecycle_detailed_code int, lifecycle_name string"
    )


def store_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales under the ids of baskets split by store and day."""
    parts = [F.col(c).cast("string") for c in ("transaction_uid", "store_id", "date_id")]
    return sales(spark, sf_dir).select(
        "household_id", "upc_id", "net_spend_amt", "unit",
        F.concat_ws("_", *parts).alias("transaction_uid"),
        F.concat(*parts).alias("transaction_concat"),
        C.iso_week_id(F.col("date_id")).alias("week_id"),
    )


def missions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shopping mission of each basket in a store."""
    parts = [F.col(c).cast("string") for c in ("transaction_uid", "store_id", "date_id")]
    return sales(spark, sf_dir).select(
        F.concat(*parts).alias("transaction_concat"),
        F.col("transaction_uid").cast("string").alias("transaction_uid"),
        (F.col("transaction_uid") % 8).cast("int").alias("shopping_missions_id"),
        C.iso_week_id(F.col("date_id")).alias("week_id"),
        F.when(F.col("store_id") % 5 != 0, "th").otherwise("my").alias("country"),
    )
