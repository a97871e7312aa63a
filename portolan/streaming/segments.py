"""A search index of segments: refreshed by batches, merged by levels, searched at the cost of the query.

A batch of documents becomes one segment of postings, sorted by term.  A document written again
leaves a tombstone for its earlier self, a row (segment, key), so a search drops replaced
postings with a join on the replaced documents only, not on the versions of all.  The state
lists the live segments with their document count and total length, of which the corpus figures
of a ranking are a sum; a search thus reads the postings of its own terms and nothing per
document.  When ``fanout`` segments of a level have come together they are merged into one of
the next level, which drops the replaced postings for good; a posting is rewritten once a level.

Each state is a small file of its own, written when everything that it names is complete;
readers take the last one.  A batch that is replayed after its state was written does nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.functions.text import token_list
from portolan.operators.search import EVERY_DOCUMENT, bm25_top, postings

STATE = "version bigint, upto bigint, segment string, level int, documents bigint, length bigint, dead array<string>"


@dataclass(frozen=True)
class SegmentedIndex:
    """Documents with a key, a text and attributes to keep; keys are unique within a batch.

    ``short`` says that tokens are dealt out once, before they are counted (see ``postings``).
    """

    spark: SparkSession
    path: str
    key: str
    text: str
    keep: tuple[str, ...] = ()
    fanout: int = 8
    short: bool = True

    # --- state ------------------------------------------------------------------------------

    def state(self) -> list:
        """The live segments of the last state: a few rows per level."""
        try:
            states = self.spark.read.schema(STATE).parquet(f"{self.path}/state/*")
        except AnalysisException:
            return []
        last = states.agg(F.max("version")).scalar()
        return states.where(F.col("version") == last).orderBy("segment").collect()

    def _name(self, version: int, upto: int, segments: list[tuple]) -> None:
        rows = [(version, upto, *s) for s in segments] or [(version, upto, None, 0, 0, 0, [])]
        self.spark.createDataFrame(rows, STATE).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/{version}")

    def _postings(self, segments: list[tuple]) -> DataFrame:
        """The postings of segments, with their tombstones' rows still in."""
        return self.spark.read.option("basePath", f"{self.path}/segments").parquet(
            *[f"{self.path}/segments/segment={s[0]}" for s in segments])

    def _live(self, rows: DataFrame, segments: list[tuple]) -> DataFrame:
        folders = sorted({folder for s in segments for folder in s[4]})
        if not folders:
            return rows
        return rows.join(self.spark.read.parquet(*folders).select("segment", self.key), ["segment", self.key], "left_anti")

    def _write(self, rows: DataFrame, name: str, dealt: bool = False) -> tuple[int, int]:
        target = f"{self.path}/segments/segment={name}"
        laid = rows if dealt else rows.repartitionByRange("term", self.key)
        laid.sortWithinPartitions("term", self.key).write.mode("overwrite").parquet(target)
        every = self.spark.read.schema(rows.schema).parquet(target).where(F.col("term") == EVERY_DOCUMENT)
        held = every.agg(F.count("*").alias("n"), F.coalesce(F.sum("doc_length"), F.lit(0)).alias("length")).first()
        return held.n, held.length

    # --- refresh ----------------------------------------------------------------------------

    def add(self, docs: DataFrame, batch: int) -> None:
        """Index a batch; batches are numbered upwards.  A NULL text takes its document out."""
        rows = self.state()
        if rows and batch <= rows[0].upto:
            return
        version = rows[0].version + 1 if rows else 0
        segments = [tuple(r)[2:] for r in rows if r.segment is not None]
        if segments:
            segments = self._buried(segments, docs, batch)
        name = f"0-{batch}"
        n, length = self._write(
            postings(docs, self.key, self.text, *self.keep, by_range=self.short), name, self.short)
        if n:
            segments.append((name, 0, n, length, []))
        self._name(version, batch, segments)
        self._merge(version, batch, segments)

    def _buried(self, segments: list[tuple], docs: DataFrame, batch: int) -> list[tuple]:
        """Tombstones for the documents that a batch replaces, and the figures without them."""
        every = self._postings(segments).where(F.col("term") == EVERY_DOCUMENT).select("segment", self.key, "doc_length")
        replaced = self._live(every, segments).join(docs.select(self.key), self.key, "left_semi")
        target = f"{self.path}/dead/{batch}"
        replaced.select(F.col("segment").cast("string"), self.key, "doc_length").write.mode("overwrite").parquet(target)
        dead = {r.segment: r for r in self.spark.read.parquet(target).groupBy("segment").agg(
            F.count("*").alias("n"), F.sum("doc_length").alias("length")).collect()}  # a row per segment
        return [
            (s, level, n - dead[s].n, length - dead[s].length, [*folders, target]) if s in dead
            else (s, level, n, length, folders)
            for s, level, n, length, folders in segments
        ]

    def _merge(self, version: int, batch: int, segments: list[tuple]) -> None:
        level = 0
        while True:
            whole = [s for s in segments if s[1] == level]
            if not whole and level > max((s[1] for s in segments), default=0):
                return
            if len(whole) >= self.fanout:
                name = f"{level + 1}-{batch}"
                n, length = self._write(self._live(self._postings(whole), whole).drop("segment"), name)
                segments = [s for s in segments if s[1] != level] + ([(name, level + 1, n, length, [])] if n else [])
                version += 1
                self._name(version, batch, segments)
            level += 1

    # --- search -----------------------------------------------------------------------------

    def postings(self, where: Column | None = None) -> DataFrame:
        """All live postings, with the attributes kept."""
        segments = [tuple(r)[2:] for r in self.state() if r.segment is not None]
        if not segments:
            raise ValueError(f"no documents below {self.path}")
        rows = self._postings(segments) if where is None else self._postings(segments).where(where)
        return self._live(rows, segments)

    def search(self, query: str, k: int, where: Column | None = None) -> DataFrame:
        """The ``k`` best documents for a query: (key, score), ties by key.

        Restricted by attributes, the documents that meet the condition are the corpus, and their
        figures are read from one posting of each; otherwise the state has them.
        """
        segments = [tuple(r)[2:] for r in self.state() if r.segment is not None]
        n, length = sum(s[2] for s in segments), sum(s[3] for s in segments)
        hits = self.postings(where).where(F.col("term").isin(*token_list(query)))
        if where is None:
            return bm25_top(hits, self.key, F.lit(n), F.lit(length / n if n else 0.0), k)
        corpus = self.postings(where).where(F.col("term") == EVERY_DOCUMENT).agg(
            F.struct(F.count("*").alias("n"), F.avg("doc_length").alias("mean_length"))).scalar()
        return bm25_top(hits, self.key, corpus["n"], corpus["mean_length"], k)
