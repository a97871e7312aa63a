"""A training corpus in five stages, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept:

1. ``quality``: documents that the classifier rejects go;
2. ``near_duplicates``: of each group of near copies (Jaccard 0.8 on five-word runs) one row
   stays, with the smallest id; distinct texts under one id are not copies;
3. ``repeated_passages``: words under a 35-word run that occurs elsewhere go; a document that
   had words and has none left goes;
4. ``mix``: each document as often as its source's target weight asks for;
5. ``packing``: bins of 2048 words, one row per piece of a document.

All but the last return the columns of ``documents``.  No stage is fit for SQL as a whole
(training, forests, sequential packing), so ``ORACLE_SQL`` is None and tests compare the
stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm import language, mixing, packing, passages, quality, shingle_join
from portolan.llm.scratch import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.train(docs, labels, language.part_of("doc_id", 5) != 0)
    return quality.accepted(docs, net)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, whatever the ids; a text without words has no class and stays."""
    found = shingle_join.near_classes(docs).filter("class_key is not null")
    first = found.groupBy("class_key").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "t1", "t2")).alias("f"))
    keys = ["__none", "__id", "__t1", "__t2"]

    def keyed(df: DataFrame, i: Column, t1: Column, t2: Column) -> DataFrame:
        return df.withColumns(dict(zip(keys, [i.isNull(), F.coalesce(i.cast("long"), F.lit(0)), t1, t2], strict=True)))

    first = keyed(first, F.col("f.id"), F.col("f.t1"), F.col("f.t2")).select(*keys)
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = keyed(docs.filter(worded), F.col("doc_id"), *shingle_join.text_keys(F.col("text"))).dropDuplicates(keys)
    return rows.join(first, keys, "left_semi").select(*docs.columns).unionByName(docs.filter(~worded))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that lost words are the words left, joined by one space; ``n_chars`` follows them."""
    out = passages.without_repeats(docs).filter("n_removed = 0 or n_removed < n_words")
    changed = {"text": F.col("stripped"), "n_chars": F.when(F.col("n_removed") > 0, F.length("stripped").cast("long"))
               .otherwise(F.col("n_chars"))}
    return out.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", passage_stage),
    ("mix", mix_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
