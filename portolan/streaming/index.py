"""Keeping a search index up to date with appended documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from portolan.operators.search import write_index
from portolan.streaming.incremental import change_stream
from portolan.streaming.ingest import run_available


def refresh_index(
    spark: SparkSession, source: str, schema, key: str, text: str, path: str, checkpoint: str, *keep: str,
    max_files: int = 1000,
) -> int:
    """Index the documents appended since the last run; a replayed batch replaces itself.

    A document appended again in a later batch replaces its earlier text for readers that
    name the key (``search.read_index``).
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        write_index(batch, key, text, path, f"stream-{batch_id}", *keep, version=batch_id)

    return run_available(change_stream(spark, source, schema, max_files), add, checkpoint)
