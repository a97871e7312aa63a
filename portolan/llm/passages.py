"""Removal of repeated passages by compaction of a token de Bruijn graph.

An edge of the graph is a run of ``k`` consecutive words, leading from its first ``k - 1``
words to its last ``k - 1``.  An edge that occurs at two places is repeated, and every word
under a repeated edge is to go.

Shuffling every edge would move many times the text, so consecutive edges of a document travel
as one stretch: edges that share the same least ``seed``-word hash (their minimizer).  Equal
edges have equal minimizers at equal offsets, so they meet among the stretches of one minimizer:

1. minimizers seen only once drop out with their stretches, which ends the work for most of a
   clean corpus; of the others, stretches with equal words are counted;
2. a repeated stretch is linked to the one before it if that is the same at all its places and
   occurs as often (a nonbranching link, found by a join), and chains of links compact into
   paths; since all places of a path run in parallel, the path is laid out along the source
   coordinates of its first place, without pointer chasing;
3. only the start of a path is joined back to the places where it occurs: each gives one long
   span of the document;
4. where stretches of one minimizer differ, they are compared edge by edge on the words at
   their source coordinates.

Content is compared by a 64-bit hash among the stretches or edges of one minimizer only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from portolan.llm.scratch import hot_join, kept
from portolan.llm.words import mix, slices, spans_hash, windows, word_hashes, words

STRETCHES = "row long, first long, edges long, times long, seed long, words long, before long"


@dataclass(frozen=True)
class Graph:
    width: int = 35
    seed: int = 6


def _positions(graph: Graph, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """All edges by first word: start, row, and the position of each edge's minimizer."""
    start, row = windows(bounds, graph.width)
    if not len(start):
        return start, row, start, hashes[:0]
    n = len(hashes) - graph.seed + 1
    grams = np.zeros(n, np.uint64)
    for j in range(graph.seed):
        grams = grams * np.uint64(0x2545F4914F6CDD1D) + hashes[j:j + n]
    grams = mix(grams)
    span = graph.width - graph.seed + 1
    best = np.empty(len(start), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    for lo in range(0, len(start), 1 << 14):
        some = start[lo:lo + (1 << 14)]
        best[lo:lo + (1 << 14)] = some + view[some].argmin(axis=1)
    return start, row, best, grams


def _stretched(graph: Graph):
    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                hashes = word_hashes(part, found)
                start, row, best, grams = _positions(graph, hashes, found.bounds)
                if not len(start):
                    continue
                new = np.ones(len(start), bool)
                new[1:] = (best[1:] != best[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                edges = np.diff(np.append(at, len(start)))
                first, own = start[at], row[at]
                content = spans_hash(hashes, first, first + edges + graph.width - 1)
                before = np.zeros(len(at), np.uint64)
                same = own[1:] == own[:-1]
                before[1:][same] = content[:-1][same]
                # the same stretch again and again, as in a repeated word, is one record
                run = np.ones(len(at), bool)
                run[1:][same] = content[1:][same] != content[:-1][same]
                run = np.flatnonzero(run)
                times = np.diff(np.append(run, len(at)))
                own = own[run]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(part.first, part.n_rows).take(pa.array(own)),
                     pa.array(first[run] - found.bounds[own]), pa.array(edges[run]), pa.array(times),
                     *(pa.array(x[run].view(np.int64)) for x in (grams[best[at]], content, before))],
                    names=["row", "first", "edges", "times", "seed", "words", "before"])

    return stretch


def _edges(graph: Graph):
    """The single edges of the wanted stretches of a text."""

    def list_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                hashes = word_hashes(part, found)
                lists = batch.column("wanted").slice(part.first, part.n_rows)
                n = np.diff(lists.offsets.to_numpy())
                first, edges, copies, seed = (
                    lists.flatten().field(c).to_numpy() for c in ("first", "edges", "copies", "seed"))
                row = np.repeat(np.repeat(np.arange(part.n_rows), n), edges)
                step = np.arange(len(row)) - np.repeat(np.cumsum(edges) - edges, edges)
                place = np.repeat(first, edges) + step
                at = place + found.bounds[:-1][row]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(part.first, part.n_rows).take(pa.array(row)), pa.array(place),
                     pa.array(np.repeat(copies, edges)), pa.array(np.repeat(seed, edges)),
                     pa.array(spans_hash(hashes, at, at + graph.width).view(np.int64))],
                    names=["row", "first", "copies", "seed", "edge"])

    return list_edges


def _paths(counted: DataFrame) -> DataFrame:
    """Compacts repeated stretches; per path the ``seed, words`` of its first stretch and its length in edges."""
    known = counted.filter("copies > 1")
    left = known.select(F.col("words").alias("left_words"), F.col("copies").alias("left_copies")).distinct()
    # a stretch that begins a document somewhere, follows several others, or itself, begins a path
    steady = (F.col("least_before") == F.col("most_before")) & (F.col("least_before") != 0) & (F.col("times") == 1)
    follows = known.where(steady).join(
        left, (F.col("least_before") == F.col("left_words")) & (F.col("copies") == F.col("left_copies")), "left")
    shape = ["seed", "words", "edges", "place"]
    marked = follows.select(*shape, F.col("left_words").isNull().cast("long").alias("head")).union(
        known.where(~steady).select(*shape, F.lit(1).cast("long")))
    along = Window.partitionBy("place.row").orderBy("place.first").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    numbered = marked.withColumn("path", F.sum("head").over(along))
    return numbered.groupBy(F.col("place.row").alias("row"), "path").agg(
        F.sum("edges").alias("length"), F.max(F.when(F.col("head") == 1, F.col("seed"))).alias("seed"),
        F.max(F.when(F.col("head") == 1, F.col("words"))).alias("words")).select("seed", "words", "length")


def repeated_spans(texts: DataFrame, graph: Graph = Graph()) -> DataFrame:
    """``row, first, n_words`` of repeated passages of ``texts`` (``row`` and ``text``, further columns ignored).

    ``row`` names a row; rows that share it must share their text.  The spans of a row may touch
    or overlap; their union is what repeats.
    """
    found = texts.select("row", "text").mapInArrow(_stretched(graph), STRETCHES)
    seeds = found.groupBy("seed").agg(F.sum("times").alias("n")).filter("n > 1").select("seed")
    found = kept(hot_join(found, seeds, ["seed"], "left_semi"), "stretches")
    # the first place in one number, since a minimum of numbers combines by hash; no column holds 2**31 words
    places = F.lit(1 << 31).cast("decimal(10,0)")
    at = F.col("row").cast("decimal(19,0)") * places + F.col("first")
    split = F.floor(F.col("at") / places).cast("long")
    counted = found.groupBy("seed", "words").agg(
        F.sum("times").alias("copies"), F.max("times").alias("times"), F.max("edges").alias("edges"), F.min("before").alias("least_before"),
        F.max("before").alias("most_before"), F.min(at.cast("decimal(30,0)")).alias("at")).withColumn("r", split)
    counted = kept(counted.select(
        "seed", "words", "copies", "times", "edges", "least_before", "most_before",
        F.struct(F.col("r").alias("row"), (F.col("at") - F.col("r").cast("decimal(19,0)") * places)
                 .cast("long").alias("first")).alias("place")), "counted")
    length = F.col("length") + (F.col("times") - 1) * F.col("edges") + graph.width - 1
    passages = found.join(_paths(counted), ["seed", "words"]).select("row", "first", length.alias("n_words"))

    mixed = counted.groupBy("seed").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("seed")
    wanted = (hot_join(counted, mixed, ["seed"], "left_semi").groupBy(F.col("place.row").alias("own"))
              .agg(F.collect_list(F.struct("place.first", "edges", "copies", "seed")).alias("wanted")))
    edges = (texts.join(wanted, F.col("own") == F.col("row"))
             .mapInArrow(_edges(graph), "row long, first long, copies long, seed long, edge long"))
    often = edges.groupBy("seed", "edge").agg(F.sum("copies").alias("n")).filter("n > 1").select("seed", "edge")
    single = hot_join(edges.filter("copies = 1"), often, ["seed", "edge"], "left_semi").select(
        "row", "first", F.lit(graph.width).cast("long").alias("n_words"))
    return passages.union(single)


def _stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, n_words, n_removed, digests = [], [], [], []
        lists = batch.column("spans")
        ends = (lists.fill_null([]) if lists.null_count else lists).offsets.to_numpy()
        first, length = (lists.flatten().field(c).to_numpy() for c in ("first", "n_words"))
        ends = ends - ends[0]
        for i, text in enumerate(batch.column("text")):
            whole = text.as_py()
            raw = (whole or "").encode().split()
            keep = np.ones(len(raw), bool)
            for j in range(ends[i], ends[i + 1]):
                keep[first[j]:first[j] + length[j]] = False
            left = raw if keep.all() else [raw[k] for k in np.flatnonzero(keep)]
            joined = b" ".join(left)
            texts.append(whole if len(left) == len(raw) else joined.decode())
            n_words.append(len(raw))
            n_removed.append(len(raw) - len(left))
            digests.append(hashlib.sha256(joined).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("rest"), batch.column("text"), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
            names=["rest", "text", "stripped", "n_words", "n_removed", "kept_sha256"])


def without_repeats(documents: DataFrame, graph: Graph = Graph(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The columns of ``documents``, then ``stripped``, ``n_words``, ``n_removed`` and ``kept_sha256``.

    A word is removed if a run of ``graph.width`` words that covers it also starts at any other
    place of the table, in the same document or another; both places lose it.  Runs are judged
    on the input.  ``stripped`` is the text itself if nothing was removed, else the words left,
    joined by one space; ``kept_sha256`` is the hash of the words left joined by one space.

    Rows that agree in id and text share one list of spans, each once.  Null texts have no words and a null ``stripped``.  Repeated rows are places of their own,
    so rows that agree in id and text lose all runs they have.  Ids may be null or repeated.
    Columns of the input named like one of the four are replaced.  An empty table gives an empty result.
    """
    added = "stripped string, n_words long, n_removed long, kept_sha256 string"
    taken = {c.split()[0] for c in added.split(", ")}
    columns = [c for c in documents.columns if c.lower() not in taken]
    others = [c for c in columns if c != text_col]
    text = F.col(f"`{text_col}`").cast("string")
    texts = documents.select(
        F.xxhash64(F.col(f"`{id_col}`"), text).alias("row"), text.alias("text"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("rest"))
    spans = repeated_spans(texts, graph).groupBy(F.col("row").alias("own")).agg(
        F.collect_set(F.struct("first", "n_words")).alias("spans"))
    schema = StructType([texts.schema["rest"], texts.schema["text"], *_parse(added)])
    done = texts.join(spans, F.col("row") == F.col("own"), "left").mapInArrow(_stripped, schema)
    back = {c: F.col("rest")[f"c{i}"] for i, c in enumerate(others)} | {text_col: F.col("text")}
    return done.select(*[back[c].alias(c) for c in columns], "stripped", "n_words", "n_removed", "kept_sha256")


def _parse(columns: str) -> list[StructField]:
    kinds = {"string": StringType(), "long": LongType()}
    return [StructField(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))]
