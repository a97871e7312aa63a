"""Best-fit packing of documents into bins of fixed size, with conflicts.

Documents are cut into pieces of at most ``capacity`` words; a full piece fills a bin alone.
The rest goes, longest first, into the bin that it fills best: the open bins stand ordered by
what is left in them, the search begins at the first that has room and goes on to the next
larger one until a bin is compatible.  A bin carries two bitmaps, one of the sources and one of
the duplicate clusters it holds; a piece whose bit is set in either is not put there.

Packing is sequential, so rows are dealt into independent shards of bounded size by a hash of
document, copy and piece: a hot source or cluster spreads evenly, and the shard number grows with the
rows.  Only ids and sizes are shuffled, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.links import groups
from portolan.llm.mixing import word_count
from portolan.llm.scratch import kept
from portolan.llm.shingle_join import text_keys

PACKED = "shard long, bin long, doc_id long, copy long, piece long, n_words long, place long"


@dataclass(frozen=True)
class Bins:
    capacity: int = 2048
    shard_rows: int = 20_000
    #: How many pieces of one source a bin may hold; 0: any number.
    same_source: int = 2


class Packer:
    """The open bins of one shard; a bin's source bitmap has one level per piece allowed of a source."""

    def __init__(self, capacity: int, same_source: int):
        self.capacity, self.same_source = capacity, same_source
        self.open: list[tuple[int, int]] = []  # (words left, bin), ascending
        self.used: list[int] = []
        self.sources: list[list[int]] = []  # per bin: one bitmap per further piece of a source
        self.clusters: list[int] = []

    def _new(self) -> int:
        self.used.append(0)
        self.sources.append([0] * max(1, self.same_source))
        self.clusters.append(0)
        return len(self.used) - 1

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and first word of a piece with these bits; opens a bin if none is compatible."""
        at = bisect_left(self.open, (size, -1))
        while at < len(self.open):
            b = self.open[at][1]
            if not self.clusters[b] & cluster and not (self.same_source and self.sources[b][-1] & source):
                break
            at += 1
        if at < len(self.open):
            left, b = self.open.pop(at)
        else:
            left, b = self.capacity, self._new()
        place = self.used[b]
        self.used[b] += size
        self.clusters[b] |= cluster
        for level, bits in enumerate(self.sources[b]):
            if not bits & source:
                self.sources[b][level] |= source
                break
        if left > size:
            insort(self.open, (left - size, b))
        return b, place


def _bits(values: list) -> list[int]:
    """A bit for each distinct value that occurs more than once; a value of its own conflicts with nothing."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    number = {v: i for i, v in enumerate(v for v, n in seen.items() if n > 1)}
    return [1 << number[v] if v in number else 0 for v in values]


def _packed(bins: Bins):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in groups(batches, ["shard"]):
            size, doc, copy, piece, source, cluster = (
                shard[c].to_pylist() for c in ("n_words", "doc_id", "copy", "piece", "source", "cluster"))
            order = sorted(range(len(size)), key=lambda i: (-size[i], doc[i] is None, doc[i] or 0, copy[i], piece[i]))
            source_bit, cluster_bit = _bits(source), _bits(cluster)
            packer = Packer(bins.capacity, bins.same_source)
            put = [packer.put(size[i], source_bit[i], cluster_bit[i]) for i in order]
            rows = pa.array(order, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [shard["shard"].combine_chunks().take(rows), pa.array([b for b, _ in put], pa.int64()),
                 *(shard[c].combine_chunks().take(rows) for c in ("doc_id", "copy", "piece", "n_words")),
                 pa.array([p for _, p in put], pa.int64())],
                names=["shard", "bin", "doc_id", "copy", "piece", "n_words", "place"])

    return pack


def packed(documents: DataFrame, bins: Bins = Bins(), clusters: DataFrame | None = None) -> DataFrame:
    """Where each piece of each document lies: one row per piece.

    ``doc_id, copy, piece, first_word, n_words, bin_id, place``: words ``first_word`` (from 0)
    to ``first_word + n_words`` of the document lie at word ``place`` of bin ``bin_id``.
    ``copy`` numbers rows that agree in id, source, words and cluster, from 1.  No bin exceeds
    the capacity, holds two pieces of one duplicate cluster, or more than ``same_source``
    pieces of one source.

    ``clusters`` (``doc_id, cluster``) names the duplicate cluster of documents; without it, or
    for a document it lacks, texts with equal words are a cluster.  With columns ``t1, t2``
    (``shingle_join.text_keys``) it names single texts, also of several under one id.  A null source conflicts
    with other null sources.  Null and empty texts have no words and no piece.  Null ids are
    packed like others.  An empty table gives an empty result; further columns are left out.
    """
    words = word_count(F.col("text"))
    own = F.xxhash64(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")))
    rows = documents.select("doc_id", "source", words.alias("words"), own.alias("cluster"), *text_keys(F.col("text")))
    rows = rows.filter("words > 0")
    if clusters is not None:
        by_text = [c for c in ("t1", "t2") if c in clusters.columns]
        named = clusters.groupBy(F.col("doc_id").alias("named"), *[F.col(c).alias(f"named_{c}") for c in by_text]).agg(
            F.min("cluster").alias("named_cluster"))
        same = F.col("doc_id").eqNullSafe(F.col("named")) if by_text else F.col("doc_id") == F.col("named")
        for c in by_text:
            same &= F.col(c) == F.col(f"named_{c}")
        rows = rows.join(named, same, "left").select(
            "doc_id", "source", "words",
            F.when(F.col("named_cluster").isNull(), F.xxhash64(F.lit(1), "cluster"))
            .otherwise(F.xxhash64(F.lit(2), "named_cluster")).alias("cluster"))
    # repeated rows are counted, then numbered: no window has to gather them
    rows = rows.groupBy("doc_id", "source", "words", "cluster").agg(F.count("*").alias("n"))
    pieces = rows.select("doc_id", F.coalesce("source", F.lit("\0null")).alias("source"), "words", "cluster",
                         F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    size = F.lit(bins.capacity)
    pieces = pieces.withColumn("last", F.floor(F.col("words") / size)).withColumn("rest", F.col("words") % size)
    pieces = kept(pieces, "pieces")
    full = pieces.filter("last > 0").select(
        "doc_id", "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last") - 1)).alias("piece"),
        size.cast("long").alias("n_words"), F.lit(0).cast("long").alias("place"),
        F.hex(F.xxhash64("source", "words", "cluster")).alias("text"))
    full = full.withColumn("bin_id", F.concat_ws(
        "-", F.lit("f"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text", "copy", "piece"))
    rest = pieces.filter("rest > 0")
    shards = max(1, -(-rest.count() // bins.shard_rows))
    dealt = rest.select(
        F.pmod(F.xxhash64("doc_id", "copy", "cluster"), F.lit(shards)).alias("shard"), "doc_id", "copy",
        F.col("last").alias("piece"), F.col("rest").alias("n_words"), "source", "cluster")
    parts = max(shards, 1)
    placed = (dealt.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(_packed(bins), PACKED))
    placed = placed.withColumn("bin_id", F.concat_ws("-", F.lit("s"), "shard", "bin"))
    columns = ["doc_id", "copy", "piece", (F.col("piece") * bins.capacity).alias("first_word"), "n_words",
               "bin_id", "place"]
    return placed.select(*columns).union(full.select(*columns))
