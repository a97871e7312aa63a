"""Labels from descriptions by the company that words keep.

A term's vector says in which distinct notes it occurs.  A term belongs to a label as far as its vector meets those
of the words of the label's description: the normalised pointwise mutual information, of which
only the positive part counts.  So a note gets a label whose description shares no word with it, if its own words
come up beside the description's elsewhere.

Counts are over all distinct notes.  They need no pairs of terms: a note's words are counted once, with
a flag for each description word the note holds, and these come from the descriptions, a short list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions.text import tokens

MIN_NOTES = 3


def _distinct_texts(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct()


def _text_keys(text: Column) -> list[Column]:
    """128 bits stand for a text in joins."""
    return [F.xxhash64(text).alias("__k1"), F.xxhash64(F.lit(1), text).alias("__k2")]


def related_terms(df: DataFrame, text: str, marks: dict[str, list[str]], min_notes: int = MIN_NOTES) -> DataFrame:
    """(term, weights): how far a term belongs to each label, in the order of ``marks``; terms of none are left out.

    A weight is the mean, over the label's words, of their relatedness to the term, from 0 to 1.  Words
    seen together in fewer than ``min_notes`` notes count as unrelated.
    """
    seeds = sorted({w for words in marks.values() for w in words})
    notes = _distinct_texts(df, text).select(F.array_distinct(tokens(F.col("text"))).alias("terms"))
    flagged = notes.select("terms", *[F.array_contains("terms", w).alias(f"s{i}") for i, w in enumerate(seeds)])
    together = [F.count_if(F.col(f"s{i}")).alias(f"s{i}") for i in range(len(seeds))]
    totals = flagged.agg(F.count("*").alias("n"), *together)
    per_term = flagged.select(F.explode("terms").alias("term"), *[f"s{i}" for i in range(len(seeds))]).groupBy("term").agg(
        F.count("*").alias("n"), *together).where(F.col("n") >= min_notes)
    # One row of figures, as a scalar of the query.
    known = per_term.withColumn("all", totals.select(F.struct("*")).scalar())

    def relatedness(i: int) -> Column:
        both, whole = F.col(f"s{i}").cast("double"), F.col("all.n").cast("double")
        lift = F.ln(both * whole / (F.col("n") * F.col(f"all.s{i}")))
        said = (both >= min_notes) & (both < whole) & (lift > 0)
        return F.when(said, lift / -F.ln(both / whole)).otherwise(0.0)

    by_seed = known.select("term", *[relatedness(i).alias(f"r{i}") for i in range(len(seeds))])
    weights = [
        reduce(lambda a, b: a + b, [F.col(f"r{seeds.index(w)}") for w in words], F.lit(0.0)) / max(len(words), 1)
        for words in marks.values()
    ]
    return by_seed.select("term", F.array(*weights).alias("weights")).where(F.array_max("weights") > 0)


def label_by_related_terms(
    df: DataFrame, text: str, marks: dict[str, list[str]], default: str, column: str = "classification",
    min_notes: int = MIN_NOTES,
) -> DataFrame:
    """Add the label with the highest sum of weights over a note's distinct terms, to six digits.

    Earlier labels win ties; ``default`` is for notes without a related term, NULL for a NULL text.  Equal notes are
    read once.
    """
    names = list(marks)
    notes = _distinct_texts(df, text)
    words = notes.select(*_text_keys(F.col("text")), F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    sums = words.join(related_terms(df, text, marks, min_notes), "term").groupBy("__k1", "__k2").agg(
        *[F.round(F.sum(F.get("weights", F.lit(i))), 6).alias(f"w{i}") for i in range(len(names))])
    scores = F.array(*[F.col(f"w{i}") for i in range(len(names))])
    best = F.get(F.array(*map(F.lit, names)), (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))
    found = sums.where(F.array_max(scores) > 0).select("__k1", "__k2", best.alias("__label"))
    keyed = df.select("*", *_text_keys(F.col(text)))
    return keyed.join(found, ["__k1", "__k2"], "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.when(F.col(text).isNotNull(), F.coalesce("__label", F.lit(default))).alias(column))
