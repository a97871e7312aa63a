"""Reading trade notes by rules: label, sentiment, risk.

The rules are tables of phrases.  A note is read once for all of them, in one expression of a
size that does not depend on their number, so scoring is a narrow map inside the JVM: no join,
no shuffle, and no text is skipped or cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.functions import rules as r
from portolan.functions import values as v
from portolan.functions.columns import percent
from portolan.functions.phrases import phrases_in, table
from portolan.functions.text import token_list, tokens


def _scores(text: Column, rules: list[tuple[str, str, int]], order: list[str]) -> Column:
    """The weights of the phrases found, summed per label, as an array in the order of the labels."""
    weights: dict[str, list[int]] = {}
    for label, phrase, weight in rules:
        if label in order:
            weights.setdefault(phrase, [0] * len(order))[order.index(label)] += weight
    none = F.array(*[F.lit(0)] * len(order))
    if not weights:
        return F.when(text.isNotNull(), none)
    by_phrase = table({p: F.array(*map(F.lit, own)) for p, own in weights.items()})
    return F.aggregate(
        phrases_in(text, weights), none, lambda sums, p: F.zip_with(sums, by_phrase[p], lambda a, b: a + b)
    )


def _best_label(scores: Column, order: list[str]) -> Column:
    """The label with the highest positive score, as an array of one; earlier labels win ties.

    The last label is the default.  The scores travel through an array of one, so that they are
    worked out once; callers deal with NULL texts.
    """
    names = F.array(*map(F.lit, order))

    def best(s: Column) -> Column:
        top = F.array_max(s)
        return F.when(top > 0, F.element_at(names, F.array_position(s, top).cast("int"))).otherwise(order[-1])

    return F.transform(F.array(scores), best)


def labels(text: Column, label_rules=r.LABEL_RULES, order=r.LABELS) -> Column:
    """The label of a note by weighted phrases, as an array of one."""
    return F.when(text.isNotNull(), _best_label(_scores(text, label_rules, order), order))


def described_terms(descriptions: dict[str, str], stop_words=r.DESCRIPTION_STOP_WORDS) -> dict[str, list[str]]:
    """Words of each label's name and description that mark the label."""
    return {
        label: [t for t in token_list(f"{label} {text}") if t not in stop_words]
        for label, text in descriptions.items()
    }


def labels_by_description(text: Column, descriptions=v.LABEL_DESCRIPTIONS, order=r.LABELS) -> Column:
    """The label of a note by words shared with the label's description, as an array of one."""
    words = tokens(text)
    terms = described_terms(descriptions)
    scores = F.array(*[F.size(F.array_intersect(words, F.array(*map(F.lit, terms[name])))) for name in order])
    return F.when(text.isNotNull(), _best_label(scores, order))


def classify(df: DataFrame, text: str, column: Column | None = None) -> DataFrame:
    """Add ``classification``, the first element of the note's label array."""
    found = labels(F.col(text)) if column is None else column
    return df.withColumn("classification", F.get(found, F.lit(0)))


def label_shares(df: DataFrame, text: str) -> DataFrame:
    """Rows per label and percent; equal notes are counted first, then read once.

    The unpartitioned window sees one row per label, a handful by construction.
    """
    per_text = df.groupBy(text).agg(F.count("*").alias("n"))
    counts = classify(per_text, text).groupBy("classification").agg(F.sum("n").alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy())
    return counts.withColumn("pct", percent(F.col("cnt"), total))


def sentiment(text: Column, positive=r.POSITIVE_PHRASES, negative=r.NEGATIVE_PHRASES) -> Column:
    """positive, negative, mixed or neutral, by the phrases found; NULL for a NULL text."""
    rules = [("good", p, 1) for p in positive] + [("bad", p, 1) for p in negative]

    def tone(s: Column) -> Column:
        good, bad = s[0] > 0, s[1] > 0
        return F.when(good & bad, "mixed").when(good, "positive").when(bad, "negative").otherwise("neutral")

    return F.when(text.isNotNull(), F.transform(F.array(_scores(text, rules, ["good", "bad"])), tone)[0])


def risk(text: Column, risk_rules=r.RISK_RULES) -> tuple[Column, Column]:
    """Risk level and the reason, from the first rule whose phrase occurs; NULL for a NULL text."""
    rank = {p: i for i, (_, p) in reversed(list(enumerate(risk_rules)))}
    if not rank:
        return F.when(text.isNotNull(), "LOW"), F.when(text.isNotNull(), r.NO_RISK_REASON)
    by_phrase = table({p: F.lit(i) for p, i in rank.items()})
    first = F.array_min(F.transform(phrases_in(text, rank), lambda p: by_phrase[p]))
    level = F.get(F.array(*[F.lit(lv) for lv, _ in risk_rules]), first)
    reason = F.get(F.array(*[F.lit(f"contains '{p}'") for _, p in risk_rules]), first)
    return (
        F.when(text.isNotNull(), F.coalesce(level, F.lit("LOW"))),
        F.when(text.isNotNull(), F.coalesce(reason, F.lit(r.NO_RISK_REASON))),
    )


def remittance_risk(df: DataFrame, text: str) -> DataFrame:
    """Add ``risk_level`` and ``reason``; both NULL where there is no text."""
    level, reason = risk(F.col(text))
    return df.withColumns({"risk_level": level, "reason": reason})
