"""The ledger of a load as state: what each batch brought, per file, merged by levels.

A batch writes its own figures beside the target (``<target>.ledger/level=0/first=<batch>``), from
narrow columns of the rows it has just written.  Every ``FANOUT`` batches the newest segments of a
level become one segment of the next, so a reader opens a few segments per level whatever the
number of batches, and never the loaded rows.  A replayed batch overwrites its segment and the
merges that end with it; a segment whose merge is missing is read from its parts.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FANOUT = 8
_SCHEMA = ("source_file string, rows_loaded bigint, rows_rejected bigint, misfit_rows bigint, "
           "first_error string, loaded_at timestamp")
_COLUMNS = [c.split()[0] for c in _SCHEMA.split(", ")]
_SEGMENT = re.compile(r"/level=(\d+)/first=(\d+)/[^/]+$")


def _base(target: str) -> str:
    return f"{target.rstrip('/')}.ledger"


def file_figures(rows: DataFrame) -> DataFrame:
    """Per file: rows loaded and rejected, rows of another width, the first error, time of the load.

    Errors are looked for among the rejects alone; counts combine before the shuffle.
    """
    misfit = F.col("misfit") if "misfit" in rows.columns else F.lit(False)
    counts = rows.groupBy("source_file").agg(
        F.count_if(F.col("rejected") == 0).alias("rows_loaded"),
        F.count_if(F.col("rejected") == 1).alias("rows_rejected"),
        F.count_if(misfit).alias("misfit_rows"),
        F.min("loaded_at").alias("loaded_at"),
    )
    error = F.concat_ws(": ", F.array_join("bad_columns", ","), "raw_row")
    errors = rows.where("rejected = 1").groupBy("source_file").agg(F.min(error).alias("first_error"))
    return counts.join(errors, "source_file", "left").select(*_COLUMNS)


def merged(figures: DataFrame) -> DataFrame:
    """The figures of several batches as one; a file that came in parts is one row."""
    return figures.groupBy("source_file").agg(
        *[F.sum(c).alias(c) for c in ("rows_loaded", "rows_rejected", "misfit_rows")],
        F.min("first_error").alias("first_error"), F.min("loaded_at").alias("loaded_at"),
    )


def record(spark: SparkSession, target: str, batch_id: int, rows: DataFrame, fanout: int = FANOUT) -> None:
    """Write the figures of a batch; part of the batch's own commit.

    ``rows`` are those the batch has written, with ``rejected``.
    """
    base = _base(target)
    file_figures(rows).write.mode("overwrite").parquet(f"{base}/level=0/first={batch_id}")
    level, span = 1, fanout
    while (batch_id + 1) % span == 0:
        start = batch_id + 1 - span
        below = {(lv, first) for lv, first in _segments(spark, base) if lv < level and start <= first <= batch_id}
        paths = [f"{base}/level={lv}/first={first}" for lv, first in newest(below, fanout)]
        merged(spark.read.schema(_SCHEMA).parquet(*paths)).write.mode("overwrite").parquet(
            f"{base}/level={level}/first={start}")
        level, span = level + 1, span * fanout


def _segments(spark: SparkSession, base: str) -> set[tuple[int, int]]:
    """(level, first batch) of the segments there, from the listing; a handful per ``FANOUT`` batches."""
    try:
        files = spark.read.schema(f"{_SCHEMA}, level int, first bigint").parquet(base).inputFiles()
    except AnalysisException:  # nothing was ever loaded
        return set()
    return {(int(m[1]), int(m[2])) for m in map(_SEGMENT.search, files) if m}


def newest(segments: set[tuple[int, int]], fanout: int = FANOUT) -> list[tuple[int, int]]:
    """The fewest segments that hold every batch once: of those over a batch, the one of the highest level."""
    chosen: list[tuple[int, int]] = []
    for level, first in sorted(segments, key=lambda s: (-s[0], s[1])):
        if not any(start <= first < start + fanout**up for up, start in chosen):
            chosen.append((level, first))
    return chosen


def held(spark: SparkSession, target: str, fanout: int = FANOUT) -> DataFrame:
    """Per loaded file its figures and ``status``; opens no loaded row.

    A target without a ledger, since nothing was ever loaded, has none.
    """
    base = _base(target)
    paths = [f"{base}/level={level}/first={first}" for level, first in newest(_segments(spark, base), fanout)]
    figures = spark.read.schema(_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], _SCHEMA)
    return merged(figures).withColumn(
        "status", F.when(F.col("rows_rejected") == 0, "LOADED").when(F.col("rows_loaded") > 0, "PARTLY LOADED")
        .otherwise("REJECTED"))
