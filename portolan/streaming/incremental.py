"""Incremental aggregates that agree with full recomputation.

A micro-batch is grouped to its delta and written under its batch id; readers sum the
deltas.  Adding straight into a table would count a replayed batch twice, overwriting
the batch's own folder does not.  Batch ids restart with a new checkpoint, so the state
records the checkpoint it belongs to and refuses any other.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.operators.joins import merge_additive
from portolan.operators.layers import DAILY_KEYS
from portolan.sources.spanning import ANY_AGE
from portolan.streaming.declared import DeclaredSummary, appended, difference
from portolan.streaming.ingest import run_available

MEASURES = ["tx_count", "total_amount"]


def change_stream(spark: SparkSession, source: str, schema, max_files: int = 1000) -> DataFrame:
    """Rows appended to a parquet table since the last run of the reading job."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", ANY_AGE)
        .parquet(source)
    )


def capture_appends(
    spark: SparkSession, source: str, schema, target: str, checkpoint: str, max_files: int = 1000
) -> int:
    """Copy appended rows to ``target`` exactly once; returns the micro-batches run."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return run_available(change_stream(spark, source, schema, max_files), write, checkpoint)


def daily_delta(trades: DataFrame) -> DataFrame:
    return trades.groupBy(*DAILY_KEYS).agg(
        F.count("*").alias("tx_count"), F.sum("amount").cast("decimal(38,2)").alias("total_amount")
    )


def write_delta(batch: DataFrame, batch_id: int, state: str, held: int = -1) -> None:
    """Write the delta of a batch; batches up to ``held`` are in the state already."""
    if batch_id <= held:
        return
    (
        daily_delta(batch)
        .withColumn("last_updated_at", F.current_timestamp())
        .write.mode("overwrite")
        .parquet(f"{state}/deltas/batch_id={batch_id}")
    )


_OWNER = "checkpoint_id string, held bigint"


def _owner(spark: SparkSession, state: str) -> tuple[str | None, int]:
    """The checkpoint a state belongs to, and the last batch its compacted part holds."""
    try:
        row = spark.read.schema(_OWNER).parquet(f"{state}/owner").first()
    except AnalysisException:
        row = None
    return (row.checkpoint_id, row.held) if row else (None, -1)


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that the streaming engine keeps in a checkpoint; None before its first run."""
    try:
        return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id
    except (AnalysisException, AttributeError):
        return None


def _has_deltas(spark: SparkSession, state: str) -> bool:
    try:
        return not spark.read.parquet(f"{state}/deltas").isEmpty()
    except AnalysisException:
        return False


def update_daily_totals(
    spark: SparkSession, source: str, schema, state: str, checkpoint: str, max_files: int = 1000
) -> int:
    """Fold newly appended trades into the daily totals; no new file, no batch.

    A state that another checkpoint wrote, or whose checkpoint is gone, is refused.
    """
    owner, held = _owner(spark, state)
    current = _checkpoint_id(spark, checkpoint)
    if owner != current and (owner or (current is None and _has_deltas(spark, state))):
        raise ValueError(f"state {state} belongs to another checkpoint than {checkpoint}; rebuild both from the source")
    stream = change_stream(spark, source, schema, max_files)
    batches = run_available(stream, lambda batch, batch_id: write_delta(batch, batch_id, state, held), checkpoint)
    if owner is None:
        _claim(spark, state, _checkpoint_id(spark, checkpoint), held)
    return batches


def _claim(spark: SparkSession, state: str, checkpoint_id: str | None, held: int) -> None:
    spark.createDataFrame([(checkpoint_id, held)], _OWNER).coalesce(1).write.mode("overwrite").parquet(f"{state}/owner")


def read_daily_totals(spark: SparkSession, state: str) -> DataFrame:
    """Daily totals: the sum of all deltas, with the time of the last change."""
    return (
        spark.read.parquet(f"{state}/deltas")
        .groupBy(*DAILY_KEYS)
        .agg(*[F.sum(m).alias(m) for m in MEASURES], F.max("last_updated_at").alias("last_updated_at"))
    )


def compact_daily_totals(spark: SparkSession, state: str, compacted: str) -> None:
    """Write the current totals as the first delta of a new state folder.

    The new folder takes over the checkpoint and records the last batch it holds, so a batch
    that was written but not yet committed is not counted again when it is replayed.
    """
    owner, held = _owner(spark, state)
    last = spark.read.parquet(f"{state}/deltas").agg(F.max("batch_id")).first()[0]
    read_daily_totals(spark, state).write.mode("overwrite").parquet(f"{compacted}/deltas/batch_id=-1")
    _claim(spark, compacted, owner, max(held, int(last) if last is not None else -1))


def refresh_daily_summary(trades: DataFrame, customers: DataFrame, path: str) -> DataFrame:
    """The declarative twin for sources without a change feed: joined table, then its summary.

    The changes are found by comparing both tables with what is held; what is written follows
    the changes.  A caller that knows its changes hands them to ``DeclaredSummary.refresh``.
    """
    held = DeclaredSummary(trades.sparkSession, path)
    if held.ledger().isEmpty():
        held.refresh(appended(trades), appended(customers))
    else:
        held.refresh(difference(held.trades(), trades), difference(held.customers(), customers))
    return held.summary()


def apply_delta(totals: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch form of the same step: existing totals plus the delta of new rows."""
    return merge_additive(totals, daily_delta(batch), DAILY_KEYS, MEASURES)
