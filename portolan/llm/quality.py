"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Random indexing gives every hashed word a sparse random vector and adds up, over the whole
corpus, the random vectors of the words around it.  Beside the word itself, each position
carries its shape (case, digits, symbols, length, whether the word just repeats), which is
indexed the same way.  A document is pooled from the word vectors of all its positions: mean
word vector, mean shape vector, and their spread.

The network has one hidden layer and is trained with numpy on a bounded sample of labelled
documents (``Settings.sample``).  Its logits are divided by a temperature fitted on rows that
the training did not see, so scores can be read as probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.scratch import kept
from portolan.llm.words import Slice, Words, slices, word_hashes, words
from portolan.operators.reports import sample_rows

SHAPES = 1 << 10


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 13
    size: int = 32
    filled: int = 4
    hidden: int = 32
    sample: int = 20_000
    rounds: int = 60
    seed: int = 3


@dataclass(frozen=True)
class Network:
    vectors: np.ndarray  # (SHAPES + buckets) x size
    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    bias: float
    temperature: float
    settings: Settings

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        x = (pooled - self.centre) / self.scale
        return np.tanh(x @ self.first + self.first_bias) @ self.second + self.bias

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -30, 30)))


def index_vectors(settings: Settings) -> np.ndarray:
    """Sparse rows of +1 and -1."""
    draw = np.random.default_rng(settings.seed)
    rows = SHAPES + settings.buckets
    out = np.zeros((rows, settings.size), np.float32)
    for _ in range(settings.filled):
        out[np.arange(rows), draw.integers(0, settings.size, rows)] = draw.choice([-1, 1], rows)
    return out


KINDS = np.zeros(256, np.uint8)
KINDS[ord("a"):ord("z") + 1] = 1
KINDS[ord("A"):ord("Z") + 1] = 2
KINDS[ord("0"):ord("9") + 1] = 4
KINDS[128:] = 8
KINDS[[ord(c) for c in "#*$%&|<>"]] = 16
KINDS[[ord(c) for c in "!\"'()+,-./:;=?@[\\]^_`{}~"]] = 32


def tokens(part: Slice, found: Words, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Shape and word bucket of every position; word buckets follow the shapes."""
    if not len(found.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = KINDS[part.data]
    seen = np.zeros(len(found.start), np.int64)
    for bit in (1, 2, 4, 8, 16):
        count = np.concatenate([[0], np.cumsum(kind == bit)])
        seen |= np.where(count[found.end] > count[found.start], bit, 0)
    marks = np.concatenate([[0], np.cumsum(kind == 32)])
    seen |= np.where(marks[found.end] - marks[found.start] > 1, 32, 0)
    length = found.end - found.start
    seen |= np.where(length > 3, 64, 0) | np.where(length > 16, 128, 0)
    hashes = word_hashes(part, found)
    again = np.zeros(len(hashes), bool)
    row = found.row
    for back in (1, 2):
        again[back:] |= (hashes[back:] == hashes[:-back]) & (row[back:] == row[:-back])
    seen |= np.where(again, 256, 0)
    return seen, SHAPES + (hashes % np.uint64(settings.buckets)).astype(np.int64)


def _contexts(settings: Settings):
    """Per task: the summed surroundings of each bucket."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors(settings)
        n = len(index)
        total, often = np.zeros((n, settings.size), np.int64), np.zeros(n, np.int64)
        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                shape, word = tokens(part, found, settings)
                if not len(word):
                    continue
                both = index[shape] + index[word]
                row = found.row
                near = np.zeros_like(both)
                same = (row[1:] == row[:-1])[:, None]
                near[1:] += both[:-1] * same
                near[:-1] += both[1:] * same
                often += np.bincount(word, minlength=n) + np.bincount(shape, minlength=n)
                for own, beside in ((word, shape), (shape, word)):
                    around = near + index[beside]
                    for d in range(settings.size):
                        total[:, d] += np.bincount(own, around[:, d], n).astype(np.int64)
        some = np.flatnonzero(often)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(often[some]), *(pa.array(total[some, d]) for d in range(settings.size))],
            names=["bucket", "n", *(f"d{d}" for d in range(settings.size))])

    return add


def word_vectors(texts: DataFrame, settings: Settings) -> np.ndarray:
    """Word and shape vectors of the whole corpus; the sums are whole numbers, so order plays no part."""
    names = ["n", *(f"d{d}" for d in range(settings.size))]
    sums = (texts.select("text").mapInArrow(_contexts(settings), ", ".join(["bucket long", *(f"{c} long" for c in names)]))
            .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).toArrow())  # one row per bucket
    out = np.zeros((SHAPES + settings.buckets, settings.size))
    if sums.num_rows:
        often = sums["n"].to_numpy().astype(float)
        mean = np.column_stack([sums[c].to_numpy() for c in names[1:]]) / often[:, None]
        out[sums["bucket"].to_numpy()] = mean
    return out.astype(np.float32)


def _pool(part: Slice, vectors: np.ndarray, settings: Settings) -> np.ndarray:
    found = words(part)
    shape, word = tokens(part, found, settings)
    size = vectors.shape[1]
    out = np.zeros((part.n_rows, 3 * size + 2))
    n = np.diff(found.bounds)
    filled = np.flatnonzero(n)
    if len(filled):
        first = found.bounds[:-1][filled]
        per = n[filled][:, None]
        lexical, formal = vectors[word], vectors[shape]
        out[filled, :size] = np.add.reduceat(lexical, first, axis=0) / per
        out[filled, size:2 * size] = np.add.reduceat(formal, first, axis=0) / per
        out[filled, 2 * size:3 * size] = np.add.reduceat(formal * formal, first, axis=0) / per
    out[:, -2] = np.log1p(n)
    out[:, -1] = n == 0
    return out


def _pooled(vectors: np.ndarray, settings: Settings):
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                x = _pool(part, vectors, settings)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(part.first, part.n_rows) for c in ("id", "label")]
                    + [pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())],
                    names=["id", "label", "x"])

    return pool


def fit_network(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, settings: Settings) -> Network:
    """Adam on the cross-entropy, then the temperature on the fifth of the rows that was held back."""
    draw = np.random.default_rng(settings.seed)
    centre, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (0.0, 1.0)
    x = (x - centre) / scale
    width = vectors.shape[1] * 3 + 2
    p = [draw.standard_normal((width, settings.hidden)) / np.sqrt(width), np.zeros(settings.hidden),
         draw.standard_normal(settings.hidden) / np.sqrt(settings.hidden), np.zeros(1)]
    held = np.arange(len(y)) % 5 == 4
    own, truth = x[~held], y[~held]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(settings.rounds):
        order = draw.permutation(len(own))
        for lo in range(0, len(own), 512):
            some = order[lo:lo + 512]
            a, t = own[some], truth[some]
            h = np.tanh(a @ p[0] + p[1])
            error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - t) / len(some)
            back = error[:, None] * p[2] * (1 - h * h)
            grads = [a.T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ error + 1e-4 * p[2], error.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(vectors, centre, scale, p[0].astype(np.float32), p[1], p[2], float(p[3][0]), 1.0, settings)
    temperature = 1.0
    if held.any() and len(set(y[held])) == 2:
        z = np.tanh(x[held] @ p[0] + p[1]) @ p[2] + p[3]
        choices = np.geomspace(0.5, 8, 60)
        loss = [np.mean(np.logaddexp(0, np.where(y[held] > 0, -z, z) / c)) for c in choices]
        temperature = float(choices[int(np.argmin(loss))])
    return Network(vectors, centre, scale, net.first, net.first_bias, net.second, net.bias, temperature, settings)


def labelled_sample(documents: DataFrame, labels: DataFrame, usable: Column, label: str, size: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, label`` of at most ``size`` labelled documents, chosen by a hash of the id.

    Ids with several labels take the larger.  At most ``size`` rows of two numbers are broadcast.
    """
    known = (labels.filter(usable & F.col(label).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("own")).agg(F.max(label).cast("double").alias("label")))
    chosen = kept(sample_rows(known, "own", size, 1), "labels")
    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), F.col("id") == F.col("own")).select("id", "text", "label")


def train(documents: DataFrame, labels: DataFrame, usable: Column, settings: Settings = Settings()) -> Network:
    """Word vectors from all of ``documents``; the network from at most ``settings.sample`` labelled ones.

    ``usable`` tells which rows of ``labels`` (``doc_id, quality``) may be learned from.  Without
    a usable label all scores are near one half.
    """
    vectors = word_vectors(documents.select(F.col("text").cast("string").alias("text")), settings)
    rows = labelled_sample(documents, labels, usable, "quality", settings.sample)
    table = rows.mapInArrow(_pooled(vectors, settings), "id long, label double, x array<double>")
    got = table.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").toArrow()
    width = 3 * settings.size + 2
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, width) if got.num_rows else np.zeros((0, width))
    y = got["label"].to_numpy().astype(float) if got.num_rows else np.zeros(0)
    return fit_network(vectors, x, y, settings)


def _scored(net: Network, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [net.scores(_pool(part, net.vectors, net.settings)) for part in slices(batch.column("text"))]
            s = np.concatenate([*got, np.zeros(0)])
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=[*names, "score", "predicted"])

    return score


def scored(documents: DataFrame, net: Network, held_out: Column, threshold: float = 0.3, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per input row; the text is the only input of a score.

    Null and empty texts are pooled to zeros and a mark for emptiness, and get the network's
    score for that.  Null ids and repeated rows are kept, an empty table gives an empty result,
    and further columns are left out.
    """
    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), held_out.alias("held_out"),
                            F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_scored(net, threshold), "id long, held_out boolean, score double, predicted int"
                           ).withColumnRenamed("id", id_col)


def accepted(documents: DataFrame, net: Network, threshold: float = 0.3) -> DataFrame:
    """The rows of ``documents`` with a score of ``threshold`` or more, all columns unchanged."""
    columns = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("row"),
                            F.col("text").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double, predicted int"
    return rows.mapInArrow(_scored(net, threshold), schema).filter("predicted = 1").select(
        *[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(columns)])
