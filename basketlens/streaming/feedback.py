"""Incremental staging of feedback files as a stream: every file once, across restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.config import FeedbackSource
from basketlens.sources.readers import reader_charset, stamped


def feedback_stream(
    spark: SparkSession, folder: str, schema: StructType, source: FeedbackSource, sep: str = "|"
) -> DataFrame:
    charset = reader_charset(source.encoding)
    raw = spark.readStream.options(header=True, sep=sep, encoding=charset).schema(schema).csv(folder)
    return stamped(raw, source)


def stage_available(
    stream: DataFrame, staged_path: str, checkpoint: str, key: str = "dib_cust_code"
) -> None:
    """Stage whatever files are there and stop. The checkpoint remembers the files."""
    query = (
        stream.where(F.col(key).isNotNull())
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(staged_path)
    )
    query.awaitTermination()
