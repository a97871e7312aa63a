"""Ranked text search (BM25) and vector search.

Index: one posting per (term, document) with term frequency and document length, and one
per document under the empty term.  A query reads only the postings of its own terms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.functions.text import token_list, tokens

K1, B = 1.2, 0.75


# The posting every document has, so that the index also lists documents without tokens.
EVERY_DOCUMENT = ""


def postings(docs: DataFrame, key: str, text: str, *keep: str, by_range: bool = True) -> DataFrame:
    """(term, key, kept attributes, doc_length, tf), in one pass over the documents.

    Grouping by term and document spreads a term that is in every document over all
    tasks.  ``by_range`` deals tokens by (term, key), as an index lies, before they are
    counted, so there is one shuffle in place of two and a task that reads texts keeps no
    counts.  Without it a task combines all tokens of its documents before the shuffle, for
    texts in which nearly every token repeats.
    """
    words = tokens(F.col(text))
    found = (
        docs.where(F.col(text).isNotNull())
        .select(F.col(key), *keep, words.alias("words"))
        .select(
            key, *keep, F.size("words").alias("doc_length"),
            F.explode(F.array_append("words", EVERY_DOCUMENT)).alias("term"),
        )
    )
    dealt = found.repartitionByRange("term", key) if by_range else found
    return dealt.groupBy("term", key, *keep, "doc_length").agg(F.count("*").alias("tf"))


def write_index(
    docs: DataFrame, key: str, text: str, path: str, batch: str, *keep: str, version: int = 0, short: bool = True,
) -> None:
    """Write one batch of the index; writing the same batch again replaces it.

    Postings are laid out by (term, key): a query's terms touch few files and row
    groups, and a frequent term spans several files instead of one.  The attributes in
    ``keep`` stand in every posting, so a search can be restricted by them.  A document
    written again in a batch of a higher ``version`` replaces its earlier text.  ``short``
    says that tokens are dealt by range before they are counted (see ``postings``); the index
    is the same.
    """
    rows = postings(docs, key, text, *keep, by_range=short).withColumn("version", F.lit(version).cast("bigint"))
    laid = rows if short else rows.repartitionByRange("term", key)
    laid.sortWithinPartitions("term", key).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_index(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """All postings; with ``key`` only those of each document's newest version.

    The newest versions come from the one posting that every document has, one row per
    document and version; a filter on terms still reaches the scan.
    """
    rows = spark.read.parquet(path)
    if key is None:
        return rows
    newest = rows.where(F.col("term") == EVERY_DOCUMENT).groupBy(key).agg(F.max("version").alias("version"))
    return rows.join(newest, [key, "version"])


def _bm25(tf: Column, doc_length: Column, df: Column, n: Column, mean_length: Column) -> Column:
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * doc_length / mean_length))


def bm25_top(hits: DataFrame, key: str, n: Column, mean_length: Column, k: int) -> DataFrame:
    """The ``k`` best documents out of the postings of a query's terms: (key, score), ties by key."""
    # At most one row per query term.
    term_stats = hits.groupBy("term").agg(F.count("*").alias("df"))
    score = _bm25(F.col("tf"), F.col("doc_length"), F.col("df"), n, mean_length)
    return (
        hits.join(F.broadcast(term_stats), "term")
        .groupBy(key)
        .agg(F.round(F.sum(score), 6).alias("score"))
        .orderBy(F.desc("score"), key)
        .limit(k)
    )


def search(index: DataFrame, key: str, query: str, k: int) -> DataFrame:
    """The ``k`` best documents for a query: (key, score), ties by key."""
    hits = index.where(F.col("term").isin(*token_list(query)))
    corpus = index.where(F.col("term") == EVERY_DOCUMENT).agg(
        F.struct(F.count("*").alias("n"), F.avg("doc_length").alias("mean_length"))
    ).scalar()
    return bm25_top(hits, key, corpus["n"], corpus["mean_length"], k)


def _occurrences(words: str, term: str) -> Column:
    return F.size(words) - F.size(F.array_remove(words, term))


def scan_search(docs: DataFrame, key: str, text: str, query: str, k: int, *keep: str) -> DataFrame:
    """The same ranking without an index, by scanning the documents.

    Term counts are a per-row expression; one aggregate over the scan gives the corpus
    figures and each task keeps its ``k`` best rows, so documents are never shuffled.  A query
    without a token finds nothing.
    """
    terms = token_list(query)
    if not terms:  # nothing to look for
        return docs.select(key, text, *keep, F.lit(0.0).alias("score")).limit(0)
    # The one-element explode keeps the counting in one place of the plan; a projection
    # would be copied into the filter and the score.
    counts = F.struct(
        F.size("words").alias("doc_length"),
        *[_occurrences("words", t).alias(f"tf_{i}") for i, t in enumerate(terms)],
    )
    counted = (
        docs.where(F.col(text).isNotNull())
        .select(key, text, *keep, tokens(F.col(text)).alias("words"))
        .select(key, text, *keep, F.explode(F.array(counts)).alias("counts"))
        .select(key, text, *keep, "counts.*")
    )
    corpus = counted.agg(
        F.struct(
            F.count("*").alias("n"),
            F.avg("doc_length").alias("mean_length"),
            *[F.count_if(F.col(f"tf_{i}") > 0).alias(f"df_{i}") for i in range(len(terms))],
        )
    ).scalar()
    score = reduce(
        lambda a, b: a + b,
        [_bm25(F.col(f"tf_{i}"), F.col("doc_length"), corpus[f"df_{i}"], corpus["n"], corpus["mean_length"])
         for i in range(len(terms))],
    )
    any_hit = reduce(lambda a, b: a | b, [F.col(f"tf_{i}") > 0 for i in range(len(terms))])
    return (
        counted.where(any_hit)
        .select(key, text, *keep, F.round(score, 6).alias("score"))
        .orderBy(F.desc("score"), key)
        .limit(k)
    )


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """NULL where either vector is zero."""
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def nearest(vectors: DataFrame, key: str, vector: str, target: list[float] | Column, k: int) -> DataFrame:
    """The ``k`` vectors with the highest cosine to one target vector, ties by key.

    The target is a literal or a scalar subquery, so the scan is a narrow map and each task
    keeps its ``k`` best rows.  A zero vector, or an absent target, has a NULL similarity
    and ranks last.
    """
    one = target if isinstance(target, Column) else F.array(*[F.lit(float(x)) for x in target])
    return (
        vectors.withColumn("__target", one)  # on its own, since lambdas take no subquery
        .withColumn("similarity", F.round(cosine(F.col(vector), F.col("__target")), 6))
        .drop(vector, "__target")
        .orderBy(F.desc_nulls_last("similarity"), key)
        .limit(k)
    )
