"""The registered queries: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm import (
    alignment, hard_negatives, language, line_rules, mixing, packing, quality, shingle_join, sql, toxicity, url_rules, warc)
from portolan.llm.near_vectors import near_vectors
from portolan.llm.passages import without_repeats
from portolan.llm.scratch import scratch_path

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rule_table(spark, URL_RULES)
    return url_rules.url_verdicts(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op3_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_links", "class_id", "kept")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    part = language.part_of("doc_id", 5)
    net = quality.train(documents, table(spark, sf_dir, "labels"), part != 0)
    return quality.scored(documents, net, part == 0)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    part = language.part_of("doc_id", 4)
    return language.languages_of(documents, language.train(documents.filter(part != 2)), part == 2)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    clusters = shingle_join.near_classes(documents).select(
        F.col("id").alias("doc_id"), "t1", "t2", F.col("class_key").alias("cluster"))
    return packing.packed(documents, clusters=clusters)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    part = language.part_of("doc_id", 4)
    machine = toxicity.train(documents, table(spark, sf_dir, "labels"), part != 2)
    return toxicity.scored(documents, machine, part == 2)


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(table(spark, sf_dir, "documents")).drop("left_text")


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return found.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_near_vectors, op2_url_verdicts, op3_shingle_join, op4_source_mix, op5_quality, op6_language,
        op7_best_fit_packing, op8_toxicity, op9_line_rules, op10_passages,
        op11_warc_records, op12_token_alignment, op13_hard_negatives)
}

ORACLES: dict[str, str] = {
    "op1_near_vectors": sql.NEAR_VECTORS,
    "op2_url_verdicts": sql.URL_VERDICTS,
    "op3_shingle_join": sql.SHINGLE_JOIN,
    "op4_source_mix": sql.SOURCE_MIX,
    "op9_line_rules": sql.LINE_RULES,
    "op10_passages": sql.PASSAGES,
    "op11_warc_records": sql.WARC_RECORDS,
    "op13_hard_negatives": sql.HARD_NEGATIVES,
}
