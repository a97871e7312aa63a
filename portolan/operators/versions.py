"""Earlier states of a table: copies, as-of reads from a change log, restores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.operators.joins import not_in


def without(df: DataFrame, condition: Column) -> DataFrame:
    """A copy after ``DELETE ... WHERE condition``; rows where it is NULL stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def last_changes(changes: DataFrame, key: str, time: str, sequence: str) -> DataFrame:
    """The last change per key.

    Taking a maximum per key combines on the map side, so a key with a third of all changes
    shrinks before the shuffle, which a row number over a window would not.  The combining
    sorts within each task, since a whole row is kept; ``streaming.history`` keeps its input short.
    """
    rest = [c for c in changes.columns if c not in (key, time, sequence)]
    last = F.max(F.struct(time, sequence, *rest)).alias("last")
    return changes.groupBy(key).agg(last).select(key, "last.*")


def state_as_of(
    changes: DataFrame, key: str, time: str, sequence: str, op: str, as_of: str | None = None
) -> DataFrame:
    """Table state from its whole change log: the last change per key, deleted keys left out."""
    seen = changes if as_of is None else changes.where(F.col(time) <= F.lit(as_of).cast("timestamp_ntz"))
    return last_changes(seen, key, time, sequence).where(F.col(op) != "DELETE").drop(op)


def restore(current: DataFrame, earlier: DataFrame, key: str, condition: Column) -> DataFrame:
    """Append the rows of an earlier state that meet the condition and are now missing."""
    missing = not_in(earlier.where(condition), key, current)
    return current.unionByName(missing.select(*current.columns))
