"""Declared tables that follow their sources by signed deltas.

Two tables hang on each other as declared: trades left-joined with their customers, and a
summary of the joined rows.  Every refresh works on *changes*: rows with a weight, +1 for a
row that came and -1 for one that went; a changed row is both.  It writes a delta of each table
under the number of its version, and names the version in a ledger only when all of them are
complete.  Readers take the last named version, so they never see half of one, and a refresh
that died is written again under the same number.

Joined table: ``changes of trades`` join ``customers now``, plus, for trades of a changed
customer alone, what they look like now minus what they looked like before.  Rows are laid out
by customer, so a changed customer reads its own share of the trades.

Summary: counts and sums of the signed rows add up over the deltas.  A minimum or maximum only
moves inwards if a row that held it goes; just these groups are computed anew from the joined
rows, all others merge what came with what they had.

A refresh whose changes outgrow a share of the rows held computes both tables anew instead
(``mode`` in the ledger).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.operators.layers import DAILY_KEYS, harmonized_trades

WEIGHT = "weight"

#: Rows of one folder are dealt over so many tasks at most, each row by all its columns.
SHARES = 16
LEDGER = ("version bigint, mode string, source_base bigint, derived_base bigint, trade_rows bigint, "
          "customer_rows bigint, joined_rows bigint, summary_rows bigint, held_rows bigint")


def appended(rows: DataFrame) -> DataFrame:
    return rows.withColumn(WEIGHT, F.lit(1).cast("bigint"))


def removed(rows: DataFrame) -> DataFrame:
    return rows.withColumn(WEIGHT, F.lit(-1).cast("bigint"))


def net(signed: DataFrame) -> DataFrame:
    """One row per distinct row with its summed weight; rows that cancel out are gone."""
    columns = [c for c in signed.columns if c != WEIGHT]
    return signed.groupBy(*columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0)


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """The changes that turn the rows of ``old`` into those of ``new``; repeated rows count."""
    return net(removed(old).unionByName(appended(new)))


def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _within(rows: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur in ``few``; NULL keys are equal to each other."""
    return rows.alias("r").join(few.select(*keys).distinct().alias("f"), _same("r", "f", keys), "left_semi")


@dataclass(frozen=True)
class DeclaredSummary:
    """The joined table and its summary by ``keys``, held with their sources below ``path``."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...] = tuple(DAILY_KEYS)
    parts: int = 64  # folders by customer in each delta
    full_beyond: float = 0.3  # share of the rows held at which computing anew is chosen

    # --- what is held ---------------------------------------------------------------------

    def ledger(self) -> DataFrame:
        """One row per version: how it was made and how many rows its deltas have."""
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger")
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER)

    def _last(self):
        rows = self.ledger().orderBy(F.desc("version")).limit(1).collect()
        return rows[0] if rows else None

    def _log(self, name: str, first: int, last: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").where(F.col("version").between(first, last))

    def _signed(self, name: str, first: int, last: int) -> DataFrame:
        return self._log(name, first, last).drop("version", "part")

    def _rows(self, signed: DataFrame) -> DataFrame:
        """Signed rows as plain rows, each as often as its weight says."""
        return self._plain(net(signed))

    def _held(self, name: str, first: int, last: int) -> DataFrame:
        """The plain rows that the deltas add up to; a single delta is net as it was written."""
        signed = self._signed(name, first, last)
        return self._plain(signed) if first == last else self._rows(signed)

    def _plain(self, netted: DataFrame) -> DataFrame:
        times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(WEIGHT)))
        return netted.where(F.col(WEIGHT) > 0).withColumn("__copy", times).drop("__copy", WEIGHT)

    def _current(self, name: str, derived: bool) -> DataFrame:
        last = self._last()
        return self._held(name, last.derived_base if derived else last.source_base, last.version)

    def trades(self) -> DataFrame:
        return self._current("trades", False)

    def customers(self) -> DataFrame:
        return self._current("customers", False)

    def joined(self) -> DataFrame:
        """The joined table of the last version."""
        return self._current("joined", True)

    def summary(self) -> DataFrame:
        """The summary of the last version: count, sum, average, minimum and maximum per group."""
        last = self._last()
        state = self._state(self._log("summary", last.derived_base, last.version))
        average = (F.col("total_amount") / F.col("amounts").cast("decimal(20,0)")).cast("decimal(22,6)")
        return state.where("tx_count > 0").select(
            *self.keys, "tx_count", "total_amount", F.when(F.col("amounts") > 0, average).alias("avg_amount"),
            "min_amount", "max_amount")

    def _state(self, deltas: DataFrame) -> DataFrame:
        """Summed measures, and the extremes that the latest delta of a group states."""
        return deltas.groupBy(*self.keys).agg(
            F.sum("tx_count").alias("tx_count"), F.sum("amounts").alias("amounts"),
            F.sum("total").cast("decimal(38,2)").alias("total"), F.max_by("low", "version").alias("min_amount"),
            F.max_by("high", "version").alias("max_amount"),
        ).withColumn("total_amount", F.when(F.col("amounts") > 0, F.col("total"))).drop("total")

    def _as_held(self, name: str, changes: DataFrame) -> DataFrame:
        """Changes in the columns and types of the table; a value that does not fit is an error."""
        held = self.spark.read.parquet(f"{self.path}/{name}").drop("version", "part").schema
        return changes.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in held])

    # --- refresh --------------------------------------------------------------------------

    def refresh(self, trade_changes: DataFrame | None = None, customer_changes: DataFrame | None = None) -> int:
        """Follow the changes of the sources; returns the version that holds them.

        The first refresh needs both tables (``appended``).  Without any change left after
        cancelling out, no version is made.
        """
        last = self._last()
        if last is None and (trade_changes is None or customer_changes is None):
            raise ValueError("the first refresh needs the rows of both tables")
        version = last.version + 1 if last else 1
        counts = {}
        for name, changes in (("trades", trade_changes), ("customers", customer_changes)):
            counts[name] = 0
            if changes is not None:
                own = self._as_held(name, changes) if last else changes
                counts[name] = self._write_net(name, version, own)
        if last and not counts["trades"] and not counts["customers"]:
            return last.version
        size = counts["trades"] + counts["customers"]
        mode = "full" if last is None or size > self.full_beyond * last.held_rows else "incremental"
        source_base = last.source_base if last else version
        derived_base = version if mode == "full" else last.derived_base
        if mode == "full":
            joined = self._join(self._held("trades", source_base, version),
                                self._held("customers", source_base, version))
            n_joined = self._write("joined", version, appended(joined), True)
        else:
            n_joined = self._write_net("joined", version, self._joined_delta(source_base, version, counts))
        n_summary = self._write("summary", version, self._summary_delta(derived_base, version), False)
        self._name(version, mode, source_base, derived_base, counts["trades"], counts["customers"], n_joined,
                   n_summary, (last.held_rows if last else 0) + size)
        return version

    def compact(self) -> int:
        """Write the tables of the last version as one delta each, for shorter reads."""
        last = self._last()
        version = last.version + 1
        n = {}
        for name, base in (("trades", last.source_base), ("customers", last.source_base),
                           ("joined", last.derived_base)):
            n[name] = self._write_net(name, version, self._signed(name, base, last.version))
        state = self._state(self._log("summary", last.derived_base, last.version)).where("tx_count > 0")
        state = state.select(*self.keys, "tx_count", "amounts", F.col("total_amount").alias("total"),
                             F.col("min_amount").alias("low"), F.col("max_amount").alias("high"))
        n["summary"] = self._write("summary", version, state, False)
        self._name(version, "compaction", version, version, 0, 0, n["joined"], n["summary"],
                   n["trades"] + n["customers"])
        return version

    def _join(self, trades: DataFrame, customers: DataFrame) -> DataFrame:
        """Trades, plain or signed, with the attributes of plain customers."""
        return harmonized_trades(trades, customers).drop("contact_email", "contact_phone")

    def _joined_delta(self, base: int, version: int, counts: dict[str, int]) -> DataFrame:
        parts = []
        if counts["trades"]:
            came = self._signed("trades", version, version)
            now = self._rows(_within(self._signed("customers", base, version), came, ["customer_id"]))
            parts.append(self._join(came, now))
        if counts["customers"]:
            touched = self._log("customers", version, version).select("customer_id", "part").distinct()
            own = [r.part for r in touched.select("part").distinct().collect()]  # at most ``parts`` numbers
            before = self._log("trades", base, version - 1).where(F.col("part").isin(own)).drop("version", "part")
            before = net(_within(before, touched, ["customer_id"]))

            def known(upto: int) -> DataFrame:
                rows = self._log("customers", base, upto).where(F.col("part").isin(own)).drop("version", "part")
                return self._rows(_within(rows, touched, ["customer_id"]))

            lost = before.withColumn(WEIGHT, -F.col(WEIGHT))
            parts += [self._join(before, known(version)), self._join(lost, known(version - 1))]
        return reduce(DataFrame.unionByName, parts)

    def _summary_delta(self, base: int, version: int) -> DataFrame:
        keys, amount, weight = list(self.keys), F.col("amount"), F.col(WEIGHT)
        came, went = F.when(weight > 0, amount), F.when(weight < 0, amount)
        delta = self._signed("joined", version, version).groupBy(*keys).agg(
            F.sum(WEIGHT).alias("tx_count"),
            F.sum(F.when(amount.isNotNull(), weight).otherwise(0)).alias("amounts"),
            F.sum(F.coalesce(amount, F.lit(0)) * weight.cast("decimal(19,0)")).cast("decimal(38,2)").alias("total"),
            F.min(came).alias("low_in"), F.max(came).alias("high_in"),
            F.min(went).alias("low_out"), F.max(went).alias("high_out"))
        measures = ["tx_count", "amounts", "total"]
        if base == version:
            return delta.select(*keys, *measures, F.col("low_in").alias("low"), F.col("high_in").alias("high"))
        held = _within(self._log("summary", base, version - 1), delta, keys).groupBy(*keys).agg(
            F.max_by("low", "version").alias("low"), F.max_by("high", "version").alias("high"))
        merged = delta.alias("d").join(held.alias("h"), _same("d", "h", keys), "left").select(
            "d.*", F.col("h.low").alias("low"), F.col("h.high").alias("high"))
        # an extreme that went is only made up for by a row at least as extreme that came
        lost = (((F.col("low_out") <= F.col("low")) & ~F.coalesce(F.col("low_in") <= F.col("low"), F.lit(False)))
                | ((F.col("high_out") >= F.col("high")) & ~F.coalesce(F.col("high_in") >= F.col("high"), F.lit(False))))
        merged = merged.withColumn("anew", F.coalesce(lost, F.lit(False)))
        days = merged.where("anew").select(*keys)
        found = net(_within(self._signed("joined", base, version), days, keys)).where(weight > 0).groupBy(*keys).agg(
            F.min("amount").alias("low"), F.max("amount").alias("high"))
        return merged.alias("m").join(found.alias("n"), _same("m", "n", keys), "left").select(
            *[F.col(f"m.{k}").alias(k) for k in keys], *measures,
            F.when(F.col("anew"), F.col("n.low")).otherwise(F.least("m.low", "low_in")).alias("low"),
            F.when(F.col("anew"), F.col("n.high")).otherwise(F.greatest("m.high", "high_in")).alias("high"))

    def _write(self, name: str, version: int, rows: DataFrame, by_customer: bool) -> int:
        """One version's delta of a table; the number of rows written."""
        target = f"{self.path}/{name}/version={version}"
        if not by_customer:
            rows.write.mode("overwrite").parquet(target)
            return self.spark.read.schema(rows.schema).parquet(target).count()
        # files follow parts, and a part in which one customer owns a third of the rows is split
        rows = self._with_part(rows)
        return self._store(rows.hint("rebalance", "part"), target)

    def _with_part(self, rows: DataFrame) -> DataFrame:
        owner = F.xxhash64(F.col("customer_id").cast("string"))
        return rows.withColumn("part", F.pmod(owner, F.lit(self.parts)).cast("int"))

    def _write_net(self, name: str, version: int, signed: DataFrame) -> int:
        """The net of signed rows as one version's delta; the number of rows written."""
        return self._store(self._dealt_net(signed), f"{self.path}/{name}/version={version}")

    def _dealt_net(self, signed: DataFrame) -> DataFrame:
        """``net`` with the rows dealt as files want them, so they are shuffled once.

        Equal rows have one share of one part, and the rows of one large customer have many.
        """
        columns = [c for c in signed.columns if c != WEIGHT]
        share = F.pmod(F.xxhash64(*columns), F.lit(SHARES)).cast("int")
        dealt = self._with_part(signed).withColumn("__share", share).repartition("part", "__share")
        return dealt.groupBy("part", "__share", *columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(
            F.col(WEIGHT) != 0).drop("__share")

    def _store(self, rows: DataFrame, target: str) -> int:
        rows.write.mode("overwrite").partitionBy("part").parquet(target)
        n = self.spark.read.schema(rows.schema).parquet(target).count()
        if not n:  # a file that tells the columns
            rows.drop("part").limit(0).write.mode("overwrite").parquet(f"{target}/part=0")
        return n

    def _name(self, *record) -> None:
        self.spark.createDataFrame([record], LEDGER).coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
