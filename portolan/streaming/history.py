"""The history of a table: a log of changes by batch and day, and snapshots that shorten reads.

An as-of read takes the newest snapshot before its time and, of the log, only the days after
that snapshot and the batches written since; both are folders, so the rest is pruned before
any file is opened.  Snapshots keep the time of each key's last change, and deleted keys, so
changes that arrive late are just merged in and never make a snapshot wrong.

A ledger names each batch and snapshot when its files are complete; readers go by the ledger.
A batch written again under its number replaces itself.  Snapshots are worked out from the one
before them and grow with the keys, not with the log.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.operators.versions import last_changes

LEDGER = "kind string, batch bigint, at timestamp_ntz, folder string, row_count bigint"
_DAY = "__day"


@dataclass(frozen=True)
class History:
    """Changes with a key, a time, a sequence number that orders equal times, and an operation.

    Changes without a time belong to no state and are kept in the log only.
    """

    spark: SparkSession
    path: str
    key: str
    time: str
    sequence: str
    op: str

    def ledger(self) -> DataFrame:
        """One row per batch and snapshot."""
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/*")
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER)

    def _name(self, entry: str, kind: str, batch: int, at: datetime | None, folder: str, rows: int) -> None:
        self.spark.createDataFrame([(kind, batch, at, folder, rows)], LEDGER).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/ledger/{entry}")

    def append(self, changes: DataFrame, batch: int) -> None:
        """Add a batch of changes, of any times; batches are numbered upwards.

        A batch that a snapshot holds already may be replayed with the same rows only.
        """
        target = f"{self.path}/log/batch={batch}"
        (changes.withColumn(_DAY, F.to_date(self.time))
         .repartitionByRange(_DAY, self.key)  # a long day is spread over several files
         .write.mode("overwrite").partitionBy(_DAY).parquet(target))
        rows = self.spark.read.schema(changes.schema).parquet(target).count()
        self._name(f"batch-{batch}", "batch", batch, None, target, rows)

    def _parts(self, as_of: datetime | None) -> tuple[DataFrame, int, datetime | None]:
        """Changes that decide the state at a time, the last batch among them, and the snapshot used."""
        named = self.ledger().orderBy("kind", "at", "batch").collect()  # one row per batch and snapshot
        batches = [r for r in named if r.kind == "batch" and r.row_count]
        if not batches:
            raise ValueError(f"no changes below {self.path}")
        last = max(r.batch for r in named if r.kind == "batch")
        usable = [r for r in named if r.kind == "snapshot" and (as_of is None or r.at <= as_of)]
        base = max(usable, key=lambda r: (r.at, r.batch), default=None)
        log = self.spark.read.option("basePath", f"{self.path}/log").parquet(*[r.folder for r in batches])
        when, day = F.col(self.time), F.col(_DAY)
        if as_of is not None:
            log = log.where((day <= F.lit(as_of.date())) & (when <= F.lit(as_of)))
        else:
            log = log.where(day.isNotNull())
        if base is not None:
            log = log.where((F.col("batch") > base.batch) | (day >= F.lit(base.at.date())))
            log = log.where((F.col("batch") > base.batch) | (when > F.lit(base.at)))
        log = log.drop("batch", _DAY)
        if base is not None:
            log = self.spark.read.schema(log.schema).parquet(base.folder).unionByName(log)
        return log, last, base.at if base else None

    def _last(self, as_of: datetime | None) -> DataFrame:
        return last_changes(self._parts(as_of)[0], self.key, self.time, self.sequence)

    def snapshot(self, at: datetime) -> None:
        """Write each key's last change up to a time, out of the snapshot before and the log since."""
        changes, last, _ = self._parts(at)
        target = f"{self.path}/snapshots/{at:%Y%m%dT%H%M%S%f}-{last}"
        rows = last_changes(changes, self.key, self.time, self.sequence)
        rows.select(*changes.columns).write.mode("overwrite").parquet(target)
        count = self.spark.read.schema(changes.schema).parquet(target).count()
        self._name(f"snapshot-{at:%Y%m%dT%H%M%S%f}-{last}", "snapshot", last, at, target, count)

    def as_of(self, at: datetime | None = None) -> DataFrame:
        """The table at a time (default: now), as ``versions.state_as_of`` gives it for the whole log."""
        return self._last(at).where(F.col(self.op) != "DELETE").drop(self.op)
