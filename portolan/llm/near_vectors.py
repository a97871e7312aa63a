"""Embedding near-duplicates by collision-counting projections.

Every vector is scaled to length one and projected onto many random lines.  On each line the
values are sorted, and a vector's window is centred on its own value; two vectors collide on a
line if one lies in the window of the other.  Pairs with enough collisions are verified by
their cosine in double precision.  For two vectors at the threshold the difference on a line is
normal with deviation ``sqrt(2 - 2 * threshold)``, so the number of collisions is binomial, and
the count that a pair must reach follows from the wanted recall (``Plan``).

Counting pairs line by line through a shuffle would move most pairs of the table, so the rows
are dealt first: on some further lines the values are cut at the median, and a row just above
a cut, within one window, is also copied below it.  A pair meets in exactly one cell: the copy
marks of its rows tell all other cells to skip it.  Cells are split into blocks of bounded
size, so neither a cell of near copies nor a dense region ends in one task.

Equal vectors are one class and never expanded into pairs.  A block reports a count per vector
and one spanning edge per linked vector, never the pairs, so the output stays linear.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.links import FOUND, Pieces, components, found_batch, groups, in_blocks
from portolan.llm.scratch import hot_join, kept


def _tail(z: float) -> float:
    """Mean of ``max(|Z| - z, 0)`` for a standard normal Z."""
    return 2 * (math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - z * math.erfc(z / math.sqrt(2)) / 2)


@dataclass(frozen=True)
class Plan:
    """Windows and counts that follow from threshold, recall and number of rows."""

    threshold: float = 0.95
    recall: float = 0.98
    n_lines: int = 32
    window: float = 1.5  # in deviations of a pair at the threshold
    cell_rows: int = 2048
    block_rows: int = 2048
    seed: int = 7
    n_cuts: int = 0

    @property
    def deviation(self) -> float:
        return math.sqrt(2 - 2 * self.threshold)

    @property
    def needed(self) -> int:
        """The most collisions that a pair at the threshold still reaches with half the allowed loss."""
        p, n = math.erf(self.window / math.sqrt(2)), self.n_lines
        lost, k = 0.0, 0
        while True:
            lost += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if lost > (1 - self.recall) / 2:
                return k
            k += 1

    def dealt_over(self, rows: int) -> Plan:
        """One more cut leaves about 0.65 of a cell's rows in the larger half."""
        cuts = max(0, math.ceil(math.log(max(rows, 1) / self.cell_rows) / -math.log(0.62)))
        return Plan(self.threshold, self.recall, self.n_lines, self.window, self.cell_rows, self.block_rows,
                    self.seed, min(cuts, 40))

    @property
    def overlap(self) -> float:
        """Width of the copied strip: pairs further apart on a cut line may be parted by it.

        The chance is the mean excess over the strip times the density at the median, taken
        as that of a standard normal line; the other half of the allowed loss is spread over
        the cuts.
        """
        z = 0.0
        while self.n_cuts and self.n_cuts * _tail(z) * self.deviation * 0.4 > (1 - self.recall) / 2:
            z += 0.01
        return z * self.deviation

    def lines(self, dim: int) -> np.ndarray:
        """One column per line: first the cuts, then the lines on which collisions count."""
        return np.random.default_rng([self.seed, dim]).standard_normal((dim, self.n_cuts + self.n_lines))


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of a list column of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    bounds = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), bounds


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """``(id, k1, k2)`` of every row, and one row per distinct usable vector: node, copies, vector."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    usable = (v.isNotNull() & (F.size(v) > 0) & F.col(f"`{id_col}`").isNotNull()
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(v, lambda x: x != 0))
    # adding zero turns minus zero into zero
    plain = F.when(usable, F.transform(v, lambda x: x + F.lit(0.0)))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), plain.alias("v"))
    keyed = rows.select("id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"))
    distinct = keyed.filter("v is not null").groupBy("k1", "k2", "v").agg(
        F.min("id").alias("node"), F.count("*").alias("copies"))
    return keyed.select("id", F.when(F.col("v").isNotNull(), F.col("k1")).alias("k1"), "k2"), distinct


def _dealt(plan: Plan, cuts: list[float]):
    """Rows to cells: every row to its own, and copies to the cells below near cuts."""
    cut = np.array(cuts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bounds = _vectors(batch.column("v"))
            sizes = np.diff(bounds)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                at = unit(values[(bounds[own][:, None] + np.arange(dim)).ravel()].reshape(-1, dim))
                on = at @ plan.lines(int(dim))[:, :plan.n_cuts]
                idx, code, marks = np.arange(len(own)), np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
                for d in range(plan.n_cuts):
                    above = on[idx, d] > cut[d]
                    copied = above & (on[idx, d] <= cut[d] + plan.overlap)
                    idx, code, marks = (np.concatenate([idx, idx[copied]]),
                                        np.concatenate([code | (above.astype(np.int64) << d), code[copied]]),
                                        np.concatenate([marks, marks[copied] | (1 << d)]))
                rows = pa.array(own[idx])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(idx), dim, np.int64)), pa.array(code), pa.array(marks),
                     batch.column("node").take(rows), batch.column("copies").take(rows),
                     batch.column("v").take(rows)],
                    names=["dim", "cell", "marks", "node", "copies", "v"])

    return deal


def _counted(plan: Plan):
    """Collisions of all pairs of a block, then cosines of the pairs with enough of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, ["dim", "cell", "low", "high"]):
            low, high = block["low"][0].as_py(), block["high"][0].as_py()
            chunk = block["chunk"].to_numpy()
            values, bounds = _vectors(block["v"].combine_chunks())
            dim = int(bounds[1] - bounds[0])
            at = unit(values[bounds[0]:bounds[-1]].reshape(-1, dim))
            on = at @ plan.lines(dim)[:, plan.n_cuts:]
            node, copies, marks = (block[c].to_numpy() for c in ("node", "copies", "marks"))
            left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
            if not len(left) or not len(right):
                continue
            order = np.sort(on[right], axis=0)
            place = np.empty((plan.n_lines, len(right)), np.uint16)
            for m in range(plan.n_lines):
                place[m, np.argsort(on[right, m], kind="stable")] = np.arange(len(right))
            pieces, links = Pieces(len(node)), np.zeros(len(node), np.int64)
            reach = plan.window * plan.deviation
            for first in range(0, len(left), 256):
                some = left[first:first + 256]
                hits = np.zeros((len(some), len(right)), np.uint8)
                for m in range(plan.n_lines):
                    begin = np.searchsorted(order[:, m], on[some, m] - reach, "left")
                    end = np.searchsorted(order[:, m], on[some, m] + reach, "right")
                    hits += (place[m] - begin.astype(np.uint16)[:, None]) < (end - begin).astype(np.uint16)[:, None]
                i, j = np.nonzero(hits >= plan.needed)
                a, b = some[i], right[j]
                fit = (marks[a] & marks[b]) == 0
                if low == high:
                    fit &= a < b
                a, b = a[fit], b[fit]
                for lo in range(0, len(a), 1 << 14):
                    x, y = a[lo:lo + (1 << 14)], b[lo:lo + (1 << 14)]
                    near = np.einsum("ij,ij->i", at[x], at[y]) >= plan.threshold
                    x, y = x[near], y[near]
                    links += np.bincount(x, copies[y], len(node)).astype(np.int64)
                    links += np.bincount(y, copies[x], len(node)).astype(np.int64)
                    pieces.join(x, y)
            some = np.flatnonzero(links)
            if len(some):
                yield found_batch(node[some], links[some], node[pieces.roots()][some])

    return count


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 plan: Plan | None = None) -> DataFrame:
    """Links between vectors of cosine ``plan.threshold`` or more.

    Returns one row per input row: the id, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable, its own included) and ``kept`` (the id is the
    component's).  Further columns of the input are left out, whatever their names.

    Null, empty or zero vectors, and vectors with a null or non-finite component, link with
    nothing.  Vectors of different length link with nothing.  A row with a null id links with
    nothing and has a null component.  Repeated rows count as rows of their own.  An empty
    table gives an empty result.
    """
    plan = plan or Plan()
    rows, distinct = classes(vectors, id_col, vector_col)
    distinct = kept(distinct, "vectors")
    plan = plan.dealt_over(distinct.count())
    cuts: list[float] = []
    if plan.n_cuts:
        lines = distinct.select("v").mapInArrow(_projected(plan), "p array<double>")
        cuts = list(lines.agg(*[F.percentile_approx(F.col("p")[d], 0.5).alias(f"c{d}")
                                for d in range(plan.n_cuts)]).first())
    cells = distinct.select("node", "copies", "v").mapInArrow(
        _dealt(plan, cuts), "dim long, cell long, marks long, node long, copies long, v array<double>")
    cells = kept(cells, "cells")
    sizes = cells.groupBy("dim", "cell").agg(F.count("*").alias("rows")).filter("rows > 1")
    dealt = in_blocks(hot_join(cells, sizes, ["dim", "cell"]),
                      F.ceil(F.col("rows") / plan.block_rows).cast("long"), "node").drop("rows")
    parts = max(24, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = (dealt.repartition(parts, "dim", "cell", "low", "high")
             .sortWithinPartitions("dim", "cell", "low", "high")
             .mapInArrow(_counted(plan), FOUND))
    found = kept(found, "links")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (distinct.select("k1", "k2", "node", "copies")
             .join(counted, "node", "left").join(whole, "node", "left"))
    return (rows.join(known, ["k1", "k2"], "left")
            .select(F.col("id").alias(id_col),
                    F.coalesce(F.col("links") + F.col("copies") - 1, F.col("copies") - 1, F.lit(0)).alias("n_links"),
                    F.coalesce("component", "node", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(f"`{id_col}`") == F.col("component_id"), F.lit(False))))


def _projected(plan: Plan):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bounds = _vectors(batch.column("v"))
            sizes = np.diff(bounds)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                at = unit(values[(bounds[own][:, None] + np.arange(dim)).ravel()].reshape(-1, dim))
                on = at @ plan.lines(int(dim))[:, :plan.n_cuts]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(np.arange(0, on.size + 1, plan.n_cuts, dtype=np.int32), on.ravel())],
                    names=["p"])

    return project
