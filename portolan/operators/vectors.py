"""An index for vector search: inverted lists around centroids, exact ranking inside them.

Centroids are fitted on a bounded sample; every row goes to the list of its nearest centroid,
and a list knows its radius, the largest distance of a row from its centroid.  An approximate
search reads the few lists nearest to the target, as many as a measured recall asks for.  An
exact one then also reads each list that could hold a better row by its radius; the others are
pruned as partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portolan.operators.reports import sample_rows

#: Lists grow with the square root of the rows up to this number, so what the driver and each
#: task hold of them is bounded.
MOST_LISTS = 1024
SAMPLE_PER_LIST = 16
#: Rounding of similarities; rows closer than this to the k-th best are compared by Spark.
SLACK = 2e-6


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _usable(vector: str, dim: int) -> Column:
    """Vectors of the index's width whose components are finite and not all zero."""
    v = F.col(f"`{vector}`")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(v) == dim) & F.forall(v, number) & F.exists(v, lambda x: x != 0), F.lit(False))


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 10, seed: int = 1) -> np.ndarray:
    """Spherical k-means over unit vectors; an emptied list keeps its centroid."""
    draw = np.random.default_rng(seed)
    centroids = sample[draw.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(sample @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centroids)
    return centroids


def _assigned(centroids: np.ndarray, vector: str):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _unit(_matrix(batch.column(vector), centroids.shape[1]))
            near = np.argmax(rows @ centroids.T, axis=1)
            away = np.linalg.norm(rows - centroids[near], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(away), pa.array(near.astype(np.int32))],
                names=[*batch.schema.names, "away", "list"])

    return assign


def build_index(vectors: DataFrame, key: str, vector: str, path: str, *keep: str, seed: int = 1) -> VectorIndex:
    """Write the index of all vectors that have a direction, with the attributes in ``keep``.

    NULL and zero vectors, vectors with components that are NULL or not finite, and those of
    another width than the most frequent one are left out: they are near to nothing.  The
    sample holds 16 rows per list, 16,384 at most.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key), *keep, F.col(vector).cast("array<double>").alias("vector"))
    widths = rows.where("size(vector) > 0").groupBy(F.size("vector").alias("dim")).count()
    dim = widths.orderBy(F.desc("count"), "dim").first()
    dim = dim.dim if dim else 1
    rows = rows.where(_usable("vector", dim))
    lists = int(min(MOST_LISTS, max(1, rows.count() ** 0.5)))
    sample = sample_rows(rows.select(key, "vector"), key, lists * SAMPLE_PER_LIST, seed).select("vector").collect()
    found = np.array([r.vector for r in sample], float).reshape(-1, dim)
    centroids = fit_centroids(_unit(found), lists, seed=seed) if len(found) else np.zeros((0, dim))
    if len(centroids):
        schema = rows.withColumn("away", F.lit(0.0)).withColumn("list", F.lit(0)).schema
        (rows.mapInArrow(_assigned(centroids, "vector"), schema)
         .repartitionByRange("list", key)  # a long list is spread over several files
         .write.mode("overwrite").partitionBy("list").parquet(f"{path}/rows"))
        held = spark.read.schema(schema).parquet(f"{path}/rows").groupBy("list").agg(
            F.max("away").alias("radius"), F.count("*").alias("rows"))
    else:
        rows.withColumn("away", F.lit(0.0)).withColumn("list", F.lit(0)).write.mode("overwrite").parquet(f"{path}/rows")
        held = spark.createDataFrame([], "list int, radius double, rows bigint")
    # at most 1024 lists
    middles = spark.createDataFrame(
        [(i, c.tolist()) for i, c in enumerate(centroids)], "list int, centroid array<double>")
    held.join(F.broadcast(middles), "list").coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")
    return VectorIndex(spark, path, key, dim)


def _best(targets: np.ndarray, key: str, k: int):
    """For each target the rows of each batch that may be among its ``k`` best."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.clip(_unit(_matrix(batch.column("vector"), targets.shape[1])) @ targets.T, -1, 1)
            rest = batch.drop_columns(["vector"])
            for t in range(len(targets)):
                kth = np.partition(near[:, t], -k)[-k] if k < len(near) else -1.0
                some = np.flatnonzero(near[:, t] >= kth - SLACK)
                picked = rest.take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), t, np.int32)), *picked.columns, pa.array(near[some, t])],
                    names=["target", *picked.schema.names, "similarity"])

    return rank


@dataclass(frozen=True)
class VectorIndex:
    spark: SparkSession
    path: str
    key: str
    dim: int

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, centroid and radius of each list: at most 1024 rows."""
        held = self.spark.read.parquet(f"{self.path}/lists").orderBy("list").collect()
        return (np.array([r.list for r in held], int), np.array([r.centroid for r in held], float).reshape(-1, self.dim),
                np.array([r.radius for r in held], float))

    def _ranked(self, rows: DataFrame, targets: np.ndarray, k: int) -> DataFrame:
        rows = rows.drop("away")
        kept = [f for f in rows.schema if f.name != "vector"]
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
        return rows.mapInArrow(_best(targets, self.key, k), f"target int, {fields}, similarity double").withColumn(
            "similarity", F.round("similarity", 6))

    def search(self, target: list[float], k: int, probes: int = 4, exact: bool = True,
               where: Column | None = None) -> DataFrame:
        """The ``k`` rows with the highest cosine to the target, ties by key, with kept attributes.

        Reads the ``probes`` nearest lists; if ``exact``, a first job finds their k-th best
        similarity and every list whose radius reaches it is read as well, so that no row is
        missed.  ``where`` restricts the rows by their attributes.
        """
        if len(target) != self.dim or not np.linalg.norm(target) or not np.all(np.isfinite(target)):
            raise ValueError(f"a target is a vector of {self.dim} finite components, not all of them zero")
        aim = _unit(np.array([target], float))
        numbers, centroids, radius = self.lists()
        away = np.linalg.norm(centroids - aim, axis=1)
        order = np.argsort(away, kind="stable")
        rows = self.rows() if where is None else self.rows().where(where)

        def best(chosen: np.ndarray) -> DataFrame:
            part = rows.where(F.col("list").isin([int(i) for i in numbers[chosen]]))
            return self._ranked(part, aim, k).drop("target", "list").orderBy(F.desc("similarity"), self.key).limit(k)

        near = best(order[:probes])
        if not exact:
            return near
        found = near.select("similarity").collect()  # k rows at most
        least = min(r.similarity for r in found) - SLACK if len(found) == k else -1.0
        reach = np.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
        return best(order[(np.arange(len(order)) < probes) | ((away - radius)[order] <= reach)])

    def needed_probes(self, k: int, targets: int = 64, seed: int = 1) -> np.ndarray:
        """For each true neighbour of a sample of rows, how many lists must be read to find it.

        One scan of the index ranks all rows for at most ``targets`` sampled targets.
        """
        sample = sample_rows(self.rows().select(self.key, "vector"), self.key, targets, seed).select("vector").collect()
        if not sample:
            return np.zeros(0, int)
        aims = _unit(np.array([r.vector for r in sample], float))
        numbers, centroids, _ = self.lists()
        place = np.argsort(np.argsort(-(aims @ centroids.T), axis=1, kind="stable"), axis=1)
        best = Window.partitionBy("target").orderBy(F.desc("similarity"), self.key)
        hits = self._ranked(self.rows(), aims, k).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
        at = {int(n): i for i, n in enumerate(numbers)}
        return np.array([place[h.target, at[h.list]] + 1 for h in hits.select("target", "list").collect()])

    def probes_for(self, k: int, recall: float = 0.95, targets: int = 64, seed: int = 1) -> int:
        """The fewest lists with which the sampled targets find that share of their neighbours."""
        needed = np.sort(self.needed_probes(k, targets, seed))
        return int(needed[max(0, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1
