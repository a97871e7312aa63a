"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms: its words in lower case, and for longer words their
first letters, so that inflected forms share a term.  The score is a bias, a weight per term,
and for each pair of terms the product of their factors; so a pair such as an insult beside the
mention of a group can weigh more, or less, than its two words.  With ``k`` factors the sum over
all pairs takes time linear in the terms.

The machine learns from a bounded sample of labelled texts (``Settings.sample``), on all
terms whose presence differs between the classes (by chi-square), and is applied to every whole
text.  A pair of terms of which neither says anything alone is not learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.quality import labelled_sample
from portolan.llm.words import Slice, Words, slices, spans_hash, words

BREAK = np.zeros(256, bool)
BREAK[[b for b in range(128) if not chr(b).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A"):ord("Z") + 1] += np.uint64(32)


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    stem: int = 5  # bytes of the first part of a longer word
    factors: int = 4
    sample: int = 20_000
    rounds: int = 300
    seed: int = 9


@dataclass(frozen=True)
class Machine:
    place: np.ndarray  # bucket -> term number, or -1
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    settings: Settings

    def logits(self, row: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(row, self.weights[term], n)
        pairs = np.zeros(n)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            pairs += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
        return self.bias + linear + pairs


def _terms(part: Slice, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of the distinct terms of each row."""
    found = words(part, BREAK)
    lower = LOWER[part.data] + np.uint64(1)
    shift = np.uint64(64 - settings.bits)
    row = found.row
    whole = spans_hash(lower, found.start, found.end) >> shift
    long_ = found.end - found.start > settings.stem
    start = found.start[long_]
    stem = (spans_hash(lower, start, start + settings.stem) ^ np.uint64(0x5555555555555555)) >> shift
    key = np.unique(np.concatenate([row, row[long_]]) * (1 << settings.bits)
                    + np.concatenate([whole, stem]).astype(np.int64))
    return key >> settings.bits, key & ((1 << settings.bits) - 1)


def _listed(settings: Settings):
    def list_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                row, bucket = _terms(part, settings)
                ends = np.searchsorted(row, np.arange(part.n_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(part.first, part.n_rows) for c in ("id", "label")]
                    + [pa.ListArray.from_arrays(ends, pa.array(bucket.astype(np.int32)))],
                    names=["id", "label", "terms"])

    return list_terms


def fit_machine(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, settings: Settings) -> Machine:
    """Adam over all rows at once; small weights are shrunk to zero on the way."""
    n, size = len(y), 1 << settings.bits
    one, all_ = max(y.sum(), 1e-9), max(n, 1)
    seen = np.bincount(bucket, minlength=size).astype(float)
    toxic = np.bincount(bucket, y[row], size) if n else np.zeros(size)
    expected = seen * one / all_
    chi = (toxic - expected) ** 2 / np.maximum(expected * (1 - one / all_), 1e-9)
    chi[seen < 3] = 0
    best = np.flatnonzero(chi > 6.6)  # one per cent of terms without effect pass this
    place = np.full(size, -1, np.int32)
    place[best] = np.arange(len(best))
    use = place[bucket] >= 0 if n else np.zeros(0, bool)
    row, term = row[use], place[bucket[use]]
    draw = np.random.default_rng(settings.seed)
    k, m = settings.factors, len(best)
    rate = float(np.clip(one / all_, 1e-3, 1 - 1e-3))
    bias = np.array([np.log(rate / (1 - rate))])
    w, v = np.zeros(m), 0.05 * draw.standard_normal((m, k))
    p = [bias, w, v]
    first, second = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, settings.rounds + 1 if n and m else 1):
        sums = np.column_stack([np.bincount(row, p[2][term, f], n) for f in range(k)])
        squares = sum(np.bincount(row, p[2][term, f] ** 2, n) for f in range(k))
        z = p[0][0] + np.bincount(row, p[1][term], n) + 0.5 * ((sums**2).sum(axis=1) - squares)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        e = error[row]
        plain = np.bincount(term, e, m)
        grads = [np.array([error.sum()]), plain + 1e-5 * p[1],
                 np.column_stack([np.bincount(term, e * sums[row, f], m) for f in range(k)])
                 - p[2] * plain[:, None] + 1e-4 * p[2]]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            move = (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
            p[i] = p[i] - 0.03 * move
        p[1] = np.sign(p[1]) * np.maximum(np.abs(p[1]) - 3e-4, 0)
    return Machine(place, float(p[0][0]), p[1], p[2], settings)


def train(documents: DataFrame, labels: DataFrame, usable: Column, settings: Settings = Settings()) -> Machine:
    """A machine from at most ``settings.sample`` labelled rows.

    ``usable`` tells which rows of ``labels`` (``doc_id, toxic``) may be learned from.
    """
    rows = labelled_sample(documents, labels, usable, "toxic", settings.sample)
    got = (rows.mapInArrow(_listed(settings), "id long, label double, terms array<int>")
           .dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").toArrow())  # at most settings.sample rows
    if not got.num_rows:
        return fit_machine(np.zeros(0, int), np.zeros(0, int), np.zeros(0), settings)
    terms = got["terms"].combine_chunks()
    row = np.repeat(np.arange(got.num_rows), np.diff(terms.offsets.to_numpy()))
    return fit_machine(row, terms.flatten().to_numpy(), got["label"].to_numpy(), settings)


def _scored(machine: Machine, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.zeros(0)]
            for part in slices(batch.column("text")):
                row, bucket = _terms(part, machine.settings)
                term = machine.place[bucket]
                use = term >= 0
                z = machine.logits(row[use], term[use], part.n_rows)
                got.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            s = np.concatenate(got)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["id", "held_out", "score", "predicted"])

    return score


def scored(documents: DataFrame, machine: Machine, held_out: Column, threshold: float = 0.3,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per input row; the text is the only input of a score.

    A null or empty text, or one without a learned term, gets the score of the bias.  Null ids
    and repeated rows are kept, an empty table gives an empty result, further columns are left out.
    """
    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), held_out.alias("held_out"),
                            F.col(f"`{text_col}`").cast("string").alias("text"))
    out = rows.mapInArrow(_scored(machine, threshold), "id long, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
