"""Reports over the log of scheduled runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.operators.reports import top


def latest_runs(log: DataFrame, since: str, n: int) -> DataFrame:
    """The last ``n`` runs scheduled from a time on, with their outcome."""
    recent = log.where(F.col("scheduled_time") >= F.lit(since).cast("timestamp_ntz"))
    return top(recent, n, F.desc("completed_time"), F.desc("run_id")).select(
        "name", "state", "scheduled_time", "completed_time", "error_message"
    )


def run_report(log: DataFrame, as_of: str, target_lag_seconds: int) -> DataFrame:
    """Per job: its last run, success and failure counts, and the lag against its target.

    The lag counts from the last success; a job that never succeeded is late.
    """
    ok = F.col("state") == "SUCCEEDED"
    last = F.max(F.struct("scheduled_time", "run_id", "state", "error_message")).alias("last")
    end = F.lit(as_of).cast("timestamp_ntz")
    lag = F.timestamp_diff("SECOND", F.col("last_success"), end)
    return (
        log.where(F.col("scheduled_time") <= end)
        .groupBy("name")
        .agg(
            last, F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"),
            F.max(F.when(ok, F.col("completed_time"))).alias("last_success"),
        )
        .select(
            "name",
            F.col("last.scheduled_time").alias("last_scheduled"),
            F.col("last.state").alias("last_state"),
            F.col("last.error_message").alias("last_error"),
            "succeeded",
            "failed",
            lag.alias("lag_seconds"),
            F.coalesce(lag > target_lag_seconds, F.lit(True)).alias("is_late"),
        )
    )
