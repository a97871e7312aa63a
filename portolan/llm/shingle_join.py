"""N-gram Jaccard join: banded MinHash with a fixed prefix, then exact verification.

A text is the set of its runs of five words.  Each tree (band) has its own sequence of minimum
hashes, and texts that share its prefix are a bucket.  Two sets of similarity ``s``
share a prefix of length ``k`` in a tree with chance ``s ** k``; ``Forest.depth`` is the longest
with which ``trees`` trees reach the target recall at the threshold, fixed before data is read.

Texts with the same shingles are one class.  A bucket with the very members of a bucket of an
earlier tree is dropped; what remains is verified on the full shingle sets, and a pair counts
only in the first tree that brings it together, so each link is found once.  Large buckets are
split into blocks of bounded size in which all pairs are compared at once; a block reports a
count per text and one spanning edge per linked text, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.links import FOUND, Pieces, components, found_batch, groups, in_blocks
from portolan.llm.scratch import hot_join, kept
from portolan.llm.words import mix, slices, word_hashes, words

SIGNED = ["id", "t1", "t2", "k1", "k2", "size", "keys"]
STEP = np.uint64(0x9FB21C651E98DF25)


@dataclass(frozen=True)
class Forest:
    threshold: float = 0.8
    width: int = 5
    trees: int = 16
    longest: int = 8
    recall: float = 0.995
    seed: int = 5
    block_rows: int = 1024
    block_shingles: int = 1 << 20

    @property
    def depth(self) -> int:
        """The longest prefix with which the trees find a pair at the threshold often enough."""
        k = self.longest
        while k > 1 and 1 - (1 - self.threshold**k) ** self.trees < self.recall:
            k -= 1
        return k

    def permutations(self) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng(self.seed)
        n = self.trees * self.depth
        return (draw.integers(0, 1 << 63, n, dtype=np.uint64),
                draw.integers(0, 1 << 63, n, dtype=np.uint64) | np.uint64(1))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and the bounds of each row's runs.

    A row with fewer words, but at least one, has a single run of all its words.
    """
    n_words = np.diff(bounds)
    n = np.where(n_words > 0, np.maximum(n_words - width + 1, 1), 0)
    own = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(own[-1]) - own[:-1][row] + bounds[:-1][row]
    total = np.zeros(len(start), np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    end = bounds[1:][row]
    for j in range(width):
        total = total * STEP + np.where(start + j < end, padded[start + j], np.uint64(0))
    return mix(total), own


def _signed(forest: Forest):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flip, turn = forest.permutations()
        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                grams, bounds = shingles(word_hashes(part, found), found.bounds, forest.width)
                filled = np.flatnonzero(np.diff(bounds))
                rows = [batch.column(c).slice(part.first, part.n_rows) for c in SIGNED[:3]]
                bare = np.flatnonzero(np.diff(bounds) == 0)
                if len(bare):
                    none = [pa.nulls(len(bare), kind) for kind in (*[pa.int64()] * 3, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(bare)) for c in rows), *none], names=SIGNED)
                if not len(filled):
                    continue
                first = bounds[:-1][filled]
                low = np.empty((len(filled), len(flip)), np.uint64)
                for m in range(len(flip)):
                    low[:, m] = np.minimum.reduceat((grams ^ flip[m]) * turn[m], first)
                keys = np.zeros((len(filled), forest.trees), np.uint64)
                for t in range(forest.trees):
                    for m in range(t * forest.depth, (t + 1) * forest.depth):
                        keys[:, t] = mix(keys[:, t] * STEP + low[:, m])
                k1 = np.add.reduceat(mix(grams + STEP), first)
                k2 = np.add.reduceat(mix(grams ^ STEP), first)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(filled)) for c in rows),
                     pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                     pa.array(np.diff(bounds)[filled]),
                     pa.ListArray.from_arrays(np.arange(0, keys.size + 1, forest.trees, dtype=np.int32),
                                              keys.view(np.int64).ravel())],
                    names=SIGNED)

    return sign


def _sets(forest: Forest):
    """The buckets of each node, with the sorted set of its shingles; repeated rows of a node give one."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            new = [n not in seen and not seen.add(n) for n in nodes]
            if not all(new):
                batch = batch.filter(pa.array(new))
            for part in slices(batch.column("text")):
                found = words(part)
                grams, bounds = shingles(word_hashes(part, found), found.bounds, forest.width)
                own = [np.unique(grams[bounds[r]:bounds[r + 1]]).view(np.int64) for r in range(part.n_rows)]
                sets = pa.ListArray.from_arrays(
                    np.cumsum([0, *map(len, own)], dtype=np.int32), np.concatenate([*own, np.zeros(0, np.int64)]))
                rest = batch.slice(part.first, part.n_rows)
                yield pa.RecordBatch.from_arrays(
                    [*(rest.column(c) for c in ("node", "copies", "keys", "buckets")), sets],
                    names=["node", "copies", "keys", "buckets", "grams"])

    return expand


def shared(sets: list[np.ndarray], cells: int = 1 << 22) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets."""
    n = len(sets)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]], np.float32)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    total = np.full((n, n), np.count_nonzero(often == n), np.float32)
    use = (often > 1) & (often < n)
    number = np.cumsum(use) - 1
    some = use[column]
    row, column = row[some], number[column[some]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(1, cells // n)
    for first in range(0, int(use.sum()), width):
        lo, hi = np.searchsorted(column, [first, first + width])
        hot = np.zeros((n, width), np.float32)
        hot[row[lo:hi], column[lo:hi] - first] = 1
        total += hot @ hot.T
    return total


def _verified(forest: Forest):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, ["bucket", "low", "high"]):
            low, high = block["low"][0].as_py(), block["high"][0].as_py()
            node, once = np.unique(block["node"].to_numpy(), return_index=True)
            if len(node) < 2:
                continue
            tree = block["bucket"][0].as_py() >> 58
            chunk, copies = block["chunk"].to_numpy()[once], block["copies"].to_numpy()[once]
            keys = block["keys"].combine_chunks().values.to_numpy().reshape(-1, forest.trees)[once]
            lists = block["grams"].combine_chunks()
            values, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
            sets = [values[bounds[i]:bounds[i + 1]] for i in once]
            size = np.array([len(s) for s in sets])
            ok = np.triu(np.ones((len(node), len(node)), bool), 1)
            if low != high:
                ok &= chunk[:, None] != chunk
            ok &= np.minimum(size[:, None], size) >= forest.threshold * np.maximum(size[:, None], size)
            ok &= keys[:, tree][:, None] == keys[:, tree]
            for t in range(tree):
                ok &= keys[:, t][:, None] != keys[:, t]
            if not ok.any():
                continue
            common = shared(sets)
            ok &= common >= forest.threshold * (size[:, None] + size - common) - 1e-6
            a, b = np.nonzero(ok)
            if not len(a):
                continue
            pieces = Pieces(len(node))
            pieces.join(a, b)
            links = (np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))).astype(np.int64)
            some = np.flatnonzero(links)
            yield found_batch(node[some], links[some], node[pieces.roots()][some])

    return verify


def text_keys(text: Column) -> list[Column]:
    """Two hashes that stand for a text where rows meet it again."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def near_classes(documents: DataFrame, forest: Forest = Forest(), id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """What ``near_texts`` says of each row, and the class itself.

    Returns ``id``, ``t1`` and ``t2`` (``text_keys`` of the text), ``class_key`` (a number for
    all texts that links connect, null for a text without words), ``n_links``, ``class_id`` and
    ``copy_id``.  The nodes of the join are sets of shingles; ids are attached at the end.
    """
    spark = documents.sparkSession
    text = F.col(f"`{text_col}`")
    texts = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), *text_keys(text), text.alias("text"))
    signed = texts.mapInArrow(_signed(forest), "id long, t1 long, t2 long, k1 long, k2 long, size long, keys array<long>")
    signed = kept(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    # a class of equal shingles is the node; its number is that of one of its rows
    distinct = signed.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.min("row").alias("node"), F.min("id").alias("first_id"), F.count("*").alias("copies"))
    distinct = kept(distinct, "copies")
    firsts = (signed.select("row", "id", "t1", "t2", "size", "keys").join(distinct.select("node", "copies"), F.col("row") == F.col("node"))
              .select("node", "copies", "size", "keys", F.col("id").alias("node_id"), F.col("t1").alias("n1"), F.col("t2").alias("n2")))
    firsts = kept(firsts, "firsts")

    low58 = F.shiftrightunsigned(F.col("key"), 6)
    spread = firsts.select("node", "size", F.posexplode("keys").alias("tree", "key")).select(
        "node", "size", (F.shiftleft(F.col("tree").cast("long"), 58) + low58).alias("bucket"))
    buckets = spread.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.sum("size").alias("sizes"), F.bit_xor(F.xxhash64("node")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("x2")).filter("rows > 1")
    buckets = kept(buckets.groupBy("rows", "sizes", "x1", "x2").agg(F.min("bucket").alias("bucket")), "buckets")
    chunks = F.greatest(F.ceil(F.col("rows") / forest.block_rows), F.ceil(F.col("sizes") / forest.block_shingles))
    members = (spread.select("node", "bucket").join(buckets.select("bucket", chunks.cast("long").alias("chunks")), "bucket")
               .groupBy("node").agg(F.collect_list(F.struct("bucket", "chunks")).alias("buckets")))  # one per tree at most
    wanted = members.join(firsts.select("node", "copies", "keys", "node_id", "n1", "n2"), "node")

    same = F.col("id").eqNullSafe(F.col("node_id")) & (F.col("t1") == F.col("n1")) & (F.col("t2") == F.col("n2"))
    sets = texts.join(wanted, same).select("text", "node", "copies", "keys", "buckets")
    sets = sets.mapInArrow(_sets(forest), "node long, copies long, keys array<long>, "
                           "buckets array<struct<bucket: long, chunks: long>>, grams array<long>")
    rows = sets.select("node", "copies", "keys", "grams", F.explode("buckets").alias("b")).select(
        "node", "copies", "keys", "grams", "b.bucket", F.col("b.chunks"))
    parts = max(24, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = in_blocks(rows, F.col("chunks"), "node").drop("chunks")
    found = kept(dealt.repartition(parts, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
                 .mapInArrow(_verified(forest), FOUND), "links")

    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    least = whole.join(distinct.select("node", "first_id"), "node").groupBy("component").agg(F.min("first_id").alias("least"))
    whole = hot_join(whole, least, ["component"])
    known = distinct.join(counted, "node", "left").join(whole, "node", "left")
    ids = signed.select("id", "t1", "t2", "k1", "k2").join(known, ["k1", "k2"]).select(
        "id", "t1", "t2", F.coalesce("component", "node").alias("class_key"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("least", "first_id")).alias("class_id"),
        F.when(F.col("id").isNotNull(), F.col("first_id")).alias("copy_id"))
    bare = signed.filter("k1 is null").select(
        "id", "t1", "t2", F.lit(None).cast("long").alias("class_key"), F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("class_id"), F.col("id").alias("copy_id"))
    return ids.union(bare)


def near_texts(documents: DataFrame, forest: Forest = Forest(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Links between texts whose sets of five-word runs have a Jaccard similarity of 0.8 or more.

    Returns one row per input row: the id, ``n_links`` (other rows linked directly),
    ``class_id`` (smallest id reachable by links, its own included), ``copy_id`` (smallest id
    with the same shingles) and ``kept`` (the id is its class's).  Words are runs without white
    space, unchanged; shingles are compared by 64-bit hashes.

    Texts are compared whatever their ids: several texts under one id are texts of their own,
    and so are texts with null ids.  A text of one to four words has one shingle of all its
    words.  A null text, or one without words, links with nothing.  A row with a null id has
    null class and copy ids and is never kept, though it counts among the links of its copies.
    Repeated rows are rows of their own.  An empty table gives an empty result; further columns
    are left out.
    """
    return near_classes(documents, forest, id_col, text_col).select(
        F.col("id").alias(id_col), "n_links", "class_id", "copy_id",
        F.coalesce(F.col("id") == F.col("class_id"), F.lit(False)).alias("kept"))
