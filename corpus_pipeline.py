"""From raw documents to a training mix: five stages, each written and read again.

Quality and toxicity, repeated line runs, near duplicates, benchmark leaks, mixing. Every stage works on
all its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import decontaminate, lines, mixing, neardup, quality
from basketlens.sources.writers import staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, holds good; toxic and poor ones go.

    Null and empty texts are judged like others, by no features."""
    return quality.select_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of two and more lines, and single lines of ten words and more, stay where they occur first;
    emptied documents go. Null and empty texts stay as they are; repeated rows are one document."""
    return lines.shorten_documents(docs, min_lines=2)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 on two-word shingles, that of the smallest id.

    Documents without words are linked with nothing and stay, as do rows with a null id."""
    return neardup.deduplicate(docs, shingle=2, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; null texts and rows with a null id hold none."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken, for the target weights of the sources.

    Texts without words have size 0 and are not taken; a null source is a source; repeated rows are
    documents of their own."""
    return mixing.pareto_mix(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("source mixing", mix_stage),
]

#: The first stage applies a trained model, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
