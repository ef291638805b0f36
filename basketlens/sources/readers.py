"""Readers for lookups, feedback files, staged feedback and feature tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from basketlens.config import FeedbackSource
from basketlens.sources.writers import staged_rows


def read_csv_mapping(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Small CSV lookup with a header; a fixed schema instead of a pass to infer one."""
    return spark.read.csv(path, header=True, schema=schema)


def _upper_windows() -> tuple[str, str]:
    """Characters 0x80-0x9F as Latin-1 and as windows-1252 read them."""
    pairs = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
    kept = [(latin, win) for latin, win in pairs if win]
    return "".join(p[0] for p in kept), "".join(p[1] for p in kept)


def reader_charset(encoding: str) -> str:
    """Charset for the CSV source, which knows Latin-1 but not windows-1252."""
    return "ISO-8859-1" if encoding.lower() in ("windows-1252", "cp1252") else encoding


def decoded(df: DataFrame, encoding: str) -> DataFrame:
    """Text columns of a file read as Latin-1, turned into what windows-1252 means by them."""
    if reader_charset(encoding) == encoding:
        return df
    latin, windows = _upper_windows()
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.translate(c, latin, windows) for c in texts})


def stamped(raw: DataFrame, source: FeedbackSource) -> DataFrame:
    """Rows with the name of their file and of the insurer."""
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    with_file = raw.select("*", name.alias("src_file"))
    return decoded(with_file, source.encoding).withColumn("insurer_nm", F.lit(source.insurer_nm))


def read_delimited_feedback(
    spark: SparkSession, glob: str, schema: StructType | str, source: FeedbackSource,
    sep: str = "|",
) -> DataFrame:
    """Pipe-separated feedback files by glob, each row with its file name and insurer."""
    charset = reader_charset(source.encoding)
    raw = spark.read.options(header=True, sep=sep, encoding=charset).schema(schema).csv(glob)
    return stamped(raw, source)


def feedback_glob(source: str, kind: int = 1, lot: str | None = None) -> str:
    """File pattern of one insurer's feedback, of all lots or of one."""
    return f"*/*{source}*FDBK{kind}*{lot or ''}.txt"


def read_staged(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Staged rows, without those of appends that were never published."""
    return staged_rows(spark, path, fmt)


def read_staged_count(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row: number of rows already staged."""
    return read_staged(spark, path, fmt).agg(F.count(F.lit(1)).alias("prior_rows"))


def read_feature_tables(
    spark: SparkSession, base: str, registry: Mapping[str, tuple[str, str]], suffix: str = ""
) -> dict[str, DataFrame]:
    """Feature name → table; the registry gives sub-folder and file name of each."""
    return {
        feature: spark.read.parquet(f"{base}/{folder}/{name}{suffix}.parquet")
        for feature, (folder, name) in registry.items()
    }


def lead_file_map(leads: DataFrame, name: str = "Filename") -> DataFrame:
    """Lead list with the name of the text file it became: two characters off, ``.txt`` on."""
    text = F.col(name)
    return leads.withColumn(
        name, F.concat(F.substring(text, F.lit(1), F.length(text) - 2), F.lit(".txt"))
    )


def join_lead_files(feedback: DataFrame, leads: DataFrame, name: str = "Filename") -> DataFrame:
    return feedback.join(leads, F.col("src_file") == F.col(name), "left")
