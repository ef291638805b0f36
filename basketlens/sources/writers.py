"""Sinks."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.session import scratch_path


def write_file(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.format(fmt).mode(mode).save(path)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Overwrite a catalog table and its schema; with a path the table is external."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, buckets: int, key: str, path: str) -> None:
    """Table bucketed and sorted by ``key``, so that later joins on it need no exchange."""
    (
        df.write.mode("overwrite").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    )


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    A stage boundary: what follows restarts from storage, reads only the columns it needs, and
    several readers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def new_rows(incoming: DataFrame, staged: DataFrame, key: str = "dib_cust_code") -> DataFrame:
    """Rows with a key whose file is not staged yet."""
    return incoming.where(F.col(key).isNotNull()).join(
        staged.select("src_file").distinct(), "src_file", "left_anti"
    )


RUNS, LEDGER = "_runs", "_ledger"  # hidden from readers of the folder itself


def ledger(spark: SparkSession, staged_path: str) -> DataFrame:
    """``run``, ``src_file`` and ``n_rows`` of what appends have published below ``staged_path``."""
    return _published(spark, staged_path).select("run", "src_file", "n_rows")


def _published(spark: SparkSession, staged_path: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{staged_path}/{LEDGER}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "run string, src_file string, n_rows long")


def publish(spark: SparkSession, staged_path: str, run: str, fmt: str) -> None:
    """The run's manifest, one file that appears at once: the files it holds and their rows."""
    rows = spark.read.format(fmt).load(f"{staged_path}/{RUNS}/run={run}")
    files = rows.groupBy("src_file").agg(F.count(F.lit(1)).alias("n_rows"))
    files.select(F.lit(run).alias("run"), "src_file", "n_rows").coalesce(1).write.mode("append").parquet(f"{staged_path}/{LEDGER}")


def append_new_files(
    incoming: DataFrame, staged_path: str, key: str = "dib_cust_code", fmt: str = "parquet"
) -> None:
    """Append the rows of files that are not staged yet; a second run appends nothing.

    Rows go to a folder of their own run, which counts from the moment its manifest is in the ledger. A
    run that dies before that has staged nothing, and its files are taken by the next one. Which files
    are staged is read from the ledger, and for what was there before it from the rows.
    """
    spark, run = incoming.sparkSession, uuid.uuid4().hex
    first = spark.read.format(fmt).load(staged_path)
    known = first.select("src_file").unionByName(ledger(spark, staged_path).select("src_file"))
    fresh = new_rows(incoming, known, key).select(*first.columns)
    fresh.write.format(fmt).save(f"{staged_path}/{RUNS}/run={run}")
    publish(spark, staged_path, run, fmt)


def staged_rows(spark: SparkSession, staged_path: str, fmt: str = "parquet") -> DataFrame:
    """The rows below ``staged_path`` that count: those of the folder itself and of published runs."""
    first = spark.read.format(fmt).load(staged_path)
    published = ledger(spark, staged_path)
    if published.isEmpty():
        return first
    runs = spark.read.format(fmt).option("basePath", f"{staged_path}/{RUNS}").load(f"{staged_path}/{RUNS}")
    counted = runs.withColumn("run", F.col("run").cast("string")).join(published.select("run").distinct(), "run", "left_semi")
    return first.unionByName(counted.select(*first.columns))
