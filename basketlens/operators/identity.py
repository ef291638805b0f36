"""Customer identity and the latest feedback of a household."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_ident_resolve(
    feedback: DataFrame, mapping: DataFrame, customers: DataFrame, number: str = "dib_cust_code"
) -> DataFrame:
    """Household of each feedback row.

    A customer number maps to a golden id and on to a household; a number that already is a
    household id stands for itself. ``mapping``: ngc_customer_id, golden_id. ``customers``:
    household_id, golden_id.
    """
    mapping = mapping.select("ngc_customer_id", "golden_id").dropDuplicates()
    links = customers.select("household_id", "golden_id").dropDuplicates()
    direct = links.select(
        F.col("household_id").cast("string").alias("ngc_customer_id"),
        F.col("household_id").alias("direct_household"),
        F.col("golden_id").alias("direct_golden"),
    )
    # Both ways of a number are put on one lookup first: the feedback is matched once.
    mapped = mapping.join(links, "golden_id", "left").select(
        "ngc_customer_id", "household_id", "golden_id"
    )
    ways = mapped.join(direct, "ngc_customer_id", "full").select(
        "ngc_customer_id",
        F.coalesce("direct_household", "household_id").alias("household_id"),
        F.coalesce("direct_golden", "golden_id").alias("golden_id"),
    )
    named = feedback.withColumnRenamed(number, "ngc_customer_id")
    # rows without a number match nothing; as join keys their nulls would meet in one task
    known = named.where("ngc_customer_id IS NOT NULL").join(ways.dropDuplicates(), "ngc_customer_id", "left")
    unknown = named.where("ngc_customer_id IS NULL").select(
        "*", *[F.lit(None).cast(ways.schema[c].dataType).alias(c) for c in ("household_id", "golden_id")])
    return known.unionByName(unknown).dropDuplicates()


def win_latest_call(
    feedback: DataFrame, day: str = "First_Call_Date", tie: str = "feedback_id"
) -> DataFrame:
    """One row per household: its latest call, calls without a date last.

    An aggregate with map-side combining instead of a ranked window: a household with very many
    calls never meets in one task.
    """
    kept = ["Bought_Status", "Contact_Status", "Reason_code"]
    # Later date first, then the smaller id; a struct compares field by field, nulls lowest.
    order = F.struct(F.col(day), (-F.col(tie)).alias("first_id"))
    row = F.max_by(F.struct(*kept, F.col(day).alias("first_contact_date")), order)
    return (
        feedback.where(F.col("household_id").isNotNull())
        .groupBy("household_id")
        .agg(row.alias("row"))
        .select("household_id", "row.*")
    )
