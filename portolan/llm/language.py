"""Language identification by multilingual mixture inference.

Each language has an n-gram model: counts of hashed byte n-grams over all its training texts.
A text is taken as a mixture: every word is drawn from one language, and its likelihood in a
language is the product of its n-grams' probabilities.  Expectation-maximisation estimates the
proportions of the languages, first over all of them; then languages are dropped, the smallest
first, for as long as the likelihood with a penalty of ``0.5 * log(words)`` per language rises.
The prediction is the language with the largest proportion in the selected set.

Counting combines within each task before one shuffle by bucket.  The model holds one number
per bucket and language, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.words import SLICE, mix, slices, words

BREAK = np.zeros(256, bool)
BREAK[[b for b in range(128) if not chr(b).isalpha()]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A"):ord("Z") + 1] += np.uint64(32)


@dataclass(frozen=True)
class Grams:
    """``orders``: bytes per n-gram, the gap before and after a word included."""

    bits: int = 15
    orders: tuple[int, ...] = (2, 3, 4)
    rounds: int = 8
    held: int = 1 << 22  # counts that a task keeps apart before it adds them up

    @property
    def buckets(self) -> int:
        return 1 << self.bits


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # buckets x languages, float32
    grams: Grams


def _grams(data: np.ndarray, start: np.ndarray, end: np.ndarray, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, and the bounds of each word's n-grams."""
    # words laid out with one zero before and after each
    size = end - start + 2
    bounds = np.concatenate([[0], np.cumsum(size)])
    laid = np.zeros(bounds[-1] + max(grams.orders), np.uint64)
    word = np.repeat(np.arange(len(start)), size - 2)
    inner = np.arange(len(word)) - (bounds[:-1] - 2 * np.arange(len(start)))[word]
    laid[bounds[:-1][word] + 1 + inner] = LOWER[data[start[word] + inner]]
    place = np.arange(bounds[-1])
    left = np.repeat(bounds[1:], size) - place
    out = np.full((len(grams.orders), bounds[-1]), -1, np.int32)
    for i, n in enumerate(grams.orders):
        code = np.zeros(bounds[-1], np.uint64)
        for j in range(n):
            code = code << np.uint64(8) | laid[j:j + bounds[-1]]
        hashed = mix(code + np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - grams.bits)
        # an n-gram begins anywhere in the padded word and ends in it; a word shorter than n has none
        fits = left >= n
        out[i, fits] = hashed[fits].astype(np.int32)
    return out, bounds


def _count(grams: Grams, languages: list[str]):
    """Per task: how often each bucket occurs in each language."""
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            key, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, back, np.concatenate([n for _, n in held]))
            return key, n

        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for part in slices(batch.column("text")):
                found = words(part, BREAK)
                if not len(found.start):
                    continue
                out, bounds = _grams(part.data, found.start, found.end, grams)
                own = np.repeat(lang[part.first + found.row], np.diff(bounds)) * grams.buckets
                held.append(np.unique(np.concatenate([own[code >= 0] + code[code >= 0] for code in out]),
                                      return_counts=True))
                n_held += len(held[-1][0])
                if n_held > grams.held:
                    key, n = added()
                    # many languages fill no table here; what is counted so far goes on as it is
                    yield pa.RecordBatch.from_arrays([pa.array(key // grams.buckets), pa.array(key % grams.buckets),
                                                      pa.array(n)], names=["language", "bucket", "n"])
                    held, n_held = held[:1], 0
        key, n = added()
        yield pa.RecordBatch.from_arrays([pa.array(key // grams.buckets), pa.array(key % grams.buckets), pa.array(n)],
                                         names=["language", "bucket", "n"])

    return count


def train(texts: DataFrame, grams: Grams = Grams()) -> Model:
    """A model from all rows of ``text, lang``; rows with a null text or language are left out.

    Any value of ``lang`` is a language; each adds ``4 * grams.buckets`` bytes to the model.
    """
    rows = texts.dropna(subset=["text", "lang"]).select("text", F.col("lang").cast("string").alias("lang"))
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    counts = np.zeros((grams.buckets, max(1, len(languages))))
    if languages:
        summed = (rows.mapInArrow(_count(grams, languages), "language long, bucket long, n long")
                  .groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow())  # buckets x languages rows at most
        counts[summed["bucket"].to_numpy(), summed["language"].to_numpy()] = summed["n"].to_numpy()
    share = (counts + 0.5) / (counts + 0.5).sum(axis=0)
    return Model(languages, np.log(share).astype(np.float32), grams)


def _sum_rows(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of each row's columns ``bounds[r]:bounds[r + 1]``; empty stretches give zero."""
    out = np.zeros((len(values), len(bounds) - 1), np.float32)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        out[:, filled] = np.add.reduceat(values, bounds[:-1][filled], axis=1)
    return out


def _fit(like: np.ndarray, bounds: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions per text and the log likelihood, by EM from ``share``; what is zero there stays zero."""
    sizes = np.diff(bounds)
    n = np.maximum(sizes, 1)
    for step in range(rounds + 1):
        part = like * np.repeat(share, sizes, axis=1)
        total = np.maximum(part.sum(axis=0), np.float32(1e-30))
        if step < rounds:
            part /= total
            share = _sum_rows(part, bounds) / n
    return share, _sum_rows(np.log(total)[None], bounds)[0]


def proportions(like: np.ndarray, bounds: np.ndarray, rounds: int) -> np.ndarray:
    """Proportions of the selected languages per text; both have a row per language, ``like`` a column per word."""
    k, n = len(like), np.diff(bounds)
    cost = (0.5 * np.log(np.maximum(n, 2))).astype(np.float32)
    share, value = _fit(like, bounds, np.full((k, len(n)), 1 / k, np.float32), rounds)
    active = np.ones((k, len(n)), bool)
    best = value - cost * k
    settled = n == 0
    while True:
        open_ = np.flatnonzero(~settled & (active.sum(axis=0) > 1))
        if not len(open_):
            return share
        low = np.where(active, share, np.float32(2)).argmin(axis=0)[open_]
        trial = active[:, open_]
        trial[low, np.arange(len(open_))] = False
        sizes = n[open_]
        own = np.concatenate([[0], np.cumsum(sizes)])
        pick = np.repeat(bounds[:-1][open_] - own[:-1], sizes) + np.arange(own[-1])
        # the others begin where they are, a little apart from zero
        start = np.where(trial, share[:, open_] + np.float32(1e-3), np.float32(0))
        new_share, new_value = _fit(like[:, pick], own, start / start.sum(axis=0), rounds)
        score = new_value - cost[open_] * trial.sum(axis=0)
        better = score >= best[open_]
        took = open_[better]
        active[:, took], share[:, took], best[took] = trial[:, better], new_share[:, better], score[better]
        settled[open_[~better]] = True


def _predicted(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], dtype=object)
        logs = np.vstack([model.logs, np.zeros((1, model.logs.shape[1]), np.float32)]).T.copy()
        # the likelihoods of a slice have a row per language
        size = max(1, 16 * SLICE // max(16, len(names)))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lang, score = np.full(batch.num_rows, len(names) - 1), np.zeros(batch.num_rows)
            for part in slices(batch.column("text"), size):
                found = words(part, BREAK)
                if not len(found.start) or not model.languages:
                    continue
                out, bounds = _grams(part.data, found.start, found.end, model.grams)
                flat = logs[:, out[0]]
                for code in out[1:]:
                    flat += logs[:, code]  # the last bucket, zero, stands for no n-gram
                total = np.add.reduceat(flat, bounds[:-1], axis=1)
                like = np.exp(total - total.max(axis=0))
                share = proportions(like, found.bounds, model.grams.rounds)
                top = share.argmax(axis=0)
                lang[part.first:part.first + part.n_rows] = top
                score[part.first:part.first + part.n_rows] = share[top, np.arange(part.n_rows)]
            none = np.array([not any(map(str.isalpha, t or "")) for t in texts], bool)
            lang[none], score[none] = len(names) - 1, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(names[lang], pa.string()),
                 pa.array(np.clip(score, 0, 1))], names=["id", "held_out", "lang_pred", "score"])

    return predict


def part_of(id_col: str, parts: int) -> Column:
    """The remainder that deals rows into folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % parts


def languages_of(documents: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per input row.

    ``score`` is the share of the words in the predicted language.  A null text, or one without
    a letter, is ``und`` with score 0; so is every text if nothing was learned.  Letters of
    scripts the model has never seen still give the likeliest learned language.  Null ids and
    repeated rows are kept; an empty table gives an empty result; further columns are left out.
    """
    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), held_out.alias("held_out"),
                            F.col(f"`{text_col}`").cast("string").alias("text"))
    out = rows.mapInArrow(_predicted(model), "id long, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
