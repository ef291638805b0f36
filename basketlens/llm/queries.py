"""Registered queries: each operator with its production parameters on its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import (
    bytedup, decontaminate, language, lines, mixing, neardup, pii, quality, runs, spelling, substring, topk, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.pareto_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return rated.select("doc_id", "expected_grade", "tail_probability", "accepted")


@query
def op9_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


@query
def op6_super_k_mer_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op10_suffix_array_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = lines.remove_repeated_lines(docs, min_lines=2)
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op10_suffix_array_lines"] = lines.CHECK_SQL


@query
def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_bilstm_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query
def op5_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLE["op5_kd_tree_top_k"] = topk.CHECK_SQL


@query
def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.through_archives(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op3_arc_to_warc"] = warc.CHECK_SQL


@query
def op11_branching_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.described(runs.find_runs(runs.repeat_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))))


@query
def op12_pivotal_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query
def op13_bucket_pointer_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bytedup.remove_repeated_bytes(table(spark, sf_dir, "documents"), window=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.coalesce("sha", F.sha2("kept", 256)).alias("kept_sha256"))
