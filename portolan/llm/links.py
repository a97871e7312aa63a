"""Shared ends of the two similarity joins: blocks, groups in a sorted stream, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.scratch import kept

#: What a task reports of one block of pairs: links found, and one linked row that stands for its piece.
FOUND = "node long, links long, root long"


def in_blocks(df: DataFrame, n_chunks: Column, node: str) -> DataFrame:
    """Deal the rows of each group into chunks, and copy each row into the blocks of its chunk.

    A group of ``k`` chunks has the blocks (0, 0), (0, 1) ... (k-1, k-1); every pair of rows
    meets in exactly one of them, and no block holds more than two chunks.  Adds ``chunk``,
    ``low`` and ``high``.
    """
    dealt = df.withColumn("n_chunks", n_chunks).withColumn(
        "chunk", F.pmod(F.xxhash64(F.col(node), F.lit(11)), F.col("n_chunks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1))
    return (dealt.withColumn("other", other)
            .withColumn("low", F.least("chunk", "other"))
            .withColumn("high", F.greatest("chunk", "other"))
            .drop("other", "n_chunks"))


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(n, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(new).tolist(), n]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class Pieces:
    """Union-find over the rows of one block, fed with arrays of linked pairs."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            top = self.roots()
            ra, rb = top[a], top[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            if len(a):
                np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))


def found_batch(node: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(node, pa.int64()), pa.array(links, pa.int64()), pa.array(root, pa.int64())],
        names=["node", "links", "root"])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for each node of the edges ``a, b``: the smallest node it reaches.

    Alternates the two star steps known from connected components on MapReduce.  A step is a
    minimum per node, which combines before the shuffle, and an equi-join, so a node with very
    many neighbours is no single task's work.  Each round is written to the shared folder; the
    rounds end when every node hangs directly on one smaller node that hangs on none.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    now = kept(edges.filter("a <> b").select(hi, lo).distinct(), "edges")
    while not _stars(now):
        # large star: whatever hangs on a node moves to the smallest of the node's surroundings
        around = now.select(F.col("lo").alias("n"), F.col("lo").alias("m")).union(
            now.select("hi", "lo")).groupBy("n").agg(F.min("m").alias("m"))
        large = now.join(around, now["lo"] == around["n"]).select("hi", F.col("m").alias("lo")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy(F.col("hi").alias("n")).agg(F.min("lo").alias("m"))
        pairs = large.join(least, large["hi"] == least["n"])
        small = pairs.select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.hi", "e.lo")
        now = kept(small.filter("hi <> lo").distinct(), "edges")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)


def _stars(edges: DataFrame) -> bool:
    twice = edges.groupBy("hi").count().filter("count > 1").select("hi")
    chained = edges.select(F.col("lo").alias("hi")).distinct().join(edges.select("hi"), "hi", "left_semi")
    return twice.union(chained).isEmpty()
