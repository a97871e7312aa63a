"""Queries that run incremental jobs over the given tables and read their state."""

from __future__ import annotations

from pyspark.sql import functions as F

from portolan import bridge
from portolan.operators import joins, layers, runs
from portolan.plans import sql as q
from portolan.plans.registry import query
from portolan.plans.trade import _DAILY_GROUP, _DAILY_SQL
from portolan.session import scratch_dir
from portolan.streaming import incremental
from portolan.streaming.declared import DeclaredSummary, appended, removed

_KEYS_SQL = f"{q.day('trade_date')} AS trade_date, booking_branch, currency_code, transaction_type"
_TOTALS_SQL = f"count(*) AS tx_count, {q.dbl('sum(amount)')} AS total_amount"
_BATCHES = 5


def _appended(spark, sf_dir, base, condition=None):
    """Append trades to a source table, as a producer would.

    Returns the schema and the files per micro-batch that make about five batches,
    however many files the table has.
    """
    trades = bridge.trades(spark, sf_dir).select("transaction_id", *layers.DAILY_KEYS, "amount")
    rows = trades if condition is None else trades.where(condition)
    rows.write.mode("append").parquet(f"{base}/source")
    written = len(spark.read.schema(trades.schema).parquet(f"{base}/source").inputFiles())
    return trades.schema, -(-written // _BATCHES)


def _updated_state(spark, sf_dir, base):
    """Two waves of appends, each folded in by several micro-batches."""
    for condition in ("trade_date < DATE '1998-01-01'", "trade_date >= DATE '1998-01-01'"):
        schema, files = _appended(spark, sf_dir, base, condition)
        incremental.update_daily_totals(
            spark, f"{base}/source", schema, f"{base}/state", f"{base}/checkpoint", max_files=files
        )
    return incremental.read_daily_totals(spark, f"{base}/state")


@query("J1 J2", q.query(
    """SELECT booking_branch, count(*) AS tx_count, count(DISTINCT transaction_id) AS distinct_ids,
       true AS first_run_loaded, 0 AS second_run_batches FROM trades GROUP BY booking_branch""", "trades"))
def captured_appends(spark, sf_dir):
    base = scratch_dir(spark, "capture")
    schema, files = _appended(spark, sf_dir, base)
    args = (spark, f"{base}/source", schema, f"{base}/target", f"{base}/checkpoint")
    first = incremental.capture_appends(*args, max_files=files)
    second = incremental.capture_appends(*args, max_files=files)
    return spark.read.parquet(f"{base}/target").groupBy("booking_branch").agg(
        F.count("*").alias("tx_count"), F.count_distinct("transaction_id").alias("distinct_ids")
    ).withColumns({"first_run_loaded": F.lit(first > 0), "second_run_batches": F.lit(second)})


@query("J3 C7", q.query(
    f"SELECT {_KEYS_SQL}, {_TOTALS_SQL}, true AS has_update_time FROM trades GROUP BY ALL", "trades"))
def incremental_daily_totals(spark, sf_dir):
    totals = _updated_state(spark, sf_dir, scratch_dir(spark, "incremental"))
    return totals.withColumn("has_update_time", F.col("last_updated_at").isNotNull()).drop("last_updated_at")


def _followed(spark, sf_dir, name, keys=tuple(layers.DAILY_KEYS), waves=5):
    """A declared summary after loads, a late append, changed customers, and rows that came and went.

    At the end it holds the given tables as they are.
    """
    trades, customers = bridge.trades(spark, sf_dir), bridge.customers(spark, sf_dir)
    early = F.col("trade_date") < F.lit("1998-01-01").cast("date")
    stale = customers.where("customer_id % 40 = 1").withColumn("customer_segment", F.lit("stale"))
    extreme = trades.where("trade_date = DATE '1997-05-05'").withColumn(
        "amount", (F.col("amount") + 9_000_000).cast("decimal(18,2)"))
    declared = DeclaredSummary(spark, scratch_dir(spark, name), keys, parts=8, full_beyond=4.0)
    changes = [
        (appended(trades.where(early)), appended(customers.where("customer_id % 40 > 1").union(stale))),
        (appended(trades.where(~early)), None),
        (None, removed(stale).union(appended(customers.where("customer_id % 40 <= 1")))),
        (appended(extreme), None),
        (removed(extreme), None),
    ]
    for of_trades, of_customers in changes[:waves]:
        declared.refresh(of_trades, of_customers)
    return declared


@query("J4 D4", q.query(
    f"""{_DAILY_SQL}, {q.dbl('min(amount)')} AS min_amount, {q.dbl('max(amount)')} AS max_amount
        FROM trades t LEFT JOIN customers c ON t.customer_id = c.customer_id {_DAILY_GROUP}""",
    "trades", "customers"))
def declared_daily_summary(spark, sf_dir):
    return _followed(spark, sf_dir, "declared").summary()


@query("J4 J5 C2", q.query(
    f"""SELECT region AS customer_region, customer_segment, currency_code, count(*) AS tx_count,
        {q.dbl('sum(amount)')} AS total_amount, {q.dbl('min(amount)')} AS min_amount,
        {q.dbl('max(amount)')} AS max_amount
        FROM trades t LEFT JOIN customers c ON t.customer_id = c.customer_id GROUP BY ALL""", "trades", "customers"))
def declared_segment_summary(spark, sf_dir):
    """The same by attributes of the customer, after a compaction: changed customers move their trades."""
    declared = _followed(spark, sf_dir, "segments", ("customer_region", "customer_segment", "currency_code"), waves=3)
    declared.compact()
    return declared.summary().drop("avg_amount")


@query("J5 J8", q.query(
    """SELECT 1::BIGINT AS version, 'full' AS mode,
        (SELECT count(*) FROM trades WHERE trade_date < DATE '1998-01-01') AS trade_rows,
        (SELECT count(*) FROM customers WHERE customer_id % 40 > 0) AS customer_rows,
        (SELECT count(*) FROM trades WHERE trade_date < DATE '1998-01-01') AS joined_rows
      UNION ALL SELECT 2, 'incremental', count(*), 0, count(*) FROM trades WHERE trade_date >= DATE '1998-01-01'
      UNION ALL SELECT 3, 'incremental', 0,
        (SELECT sum(CASE WHEN customer_id % 40 = 1 THEN 2 ELSE 1 END) FROM customers WHERE customer_id % 40 <= 1)::BIGINT,
        2 * count(*) FROM trades t JOIN customers c ON t.customer_id = c.customer_id WHERE c.customer_id % 40 <= 1
      UNION ALL SELECT v, 'incremental', n, 0, n FROM (VALUES (4), (5)) u(v),
        (SELECT count(*) AS n FROM trades WHERE trade_date = DATE '1997-05-05')""", "trades", "customers"))
def declared_refreshes(spark, sf_dir):
    """Rows that each refresh wrote: they follow the changes, not the tables."""
    return _followed(spark, sf_dir, "refreshes").ledger().select(
        "version", "mode", "trade_rows", "customer_rows", "joined_rows")


@query("J5", q.query(
    "SELECT count(DISTINCT (trade_date, booking_branch, currency_code, transaction_type)) AS groups, "
    "0::BIGINT AS different FROM trades", "trades"))
def incremental_equals_full(spark, sf_dir):
    """Groups in which the folded state differs from a recomputation over all rows."""
    state = _updated_state(spark, sf_dir, scratch_dir(spark, "equals"))
    full = incremental.daily_delta(bridge.trades(spark, sf_dir))
    compared = joins.reconcile(state, full, layers.DAILY_KEYS, incremental.MEASURES, one_sided=True)
    wrong = (F.col("diff_tx_count") != 0) | (F.col("diff_total_amount") != 0)
    return compared.agg(F.count("*").alias("groups"), F.count_if(wrong).alias("different"))


@query("J6 C3 F1", q.query(
    f"""SELECT {q.day('coalesce(a.trade_date, b.trade_date)')} AS trade_date, booking_branch, currency_code,
        transaction_type, a.n AS left_tx_count, b.n AS right_tx_count, {q.dbl('a.s')} AS left_total_amount,
        {q.dbl('b.s')} AS right_total_amount, coalesce(a.n, 0) - coalesce(b.n, 0) AS diff_tx_count,
        {q.dbl('coalesce(a.s, 0) - coalesce(b.s, 0)')} AS diff_total_amount
        FROM (SELECT trade_date, booking_branch, currency_code, transaction_type, count(*) AS n, sum(amount) AS s
              FROM trades WHERE trade_date < DATE '2001-06-01' GROUP BY ALL) a
        FULL JOIN (SELECT trade_date, booking_branch, currency_code, transaction_type, count(*) AS n, sum(amount) AS s
              FROM trades WHERE trade_date >= DATE '1995-03-01' GROUP BY ALL) b
        USING (trade_date, booking_branch, currency_code, transaction_type)""", "trades"))
def reconciled_with_one_sided_keys(spark, sf_dir):
    """Two aggregates over different periods: equal keys agree, the others are listed too."""
    trades = bridge.trades(spark, sf_dir)
    left = incremental.daily_delta(trades.where("trade_date < DATE '2001-06-01'"))
    right = incremental.daily_delta(trades.where("trade_date >= DATE '1995-03-01'"))
    return joins.reconcile(left, right, layers.DAILY_KEYS, incremental.MEASURES, one_sided=True)


@query("C7", q.query(f"SELECT {_KEYS_SQL}, {_TOTALS_SQL} FROM trades GROUP BY ALL", "trades"))
def totals_after_batch_merge(spark, sf_dir):
    trades = bridge.trades(spark, sf_dir)
    before = incremental.daily_delta(trades.where("trade_date < DATE '1998-01-01'"))
    return incremental.apply_delta(before, trades.where("trade_date >= DATE '1998-01-01'"))


_LOG_END = "2024-01-29 12:00:00"


@query("J8", q.query(
    f"""SELECT name, state, {q.stamp('scheduled_time')} AS scheduled_time,
        {q.stamp('completed_time')} AS completed_time, error_message FROM refresh_log
        WHERE scheduled_time >= TIMESTAMP '2024-01-28 12:00:00'
        ORDER BY completed_time DESC, run_id DESC LIMIT 5""", "refresh_log"))
def latest_runs(spark, sf_dir):
    return runs.latest_runs(bridge.refresh_log(spark, sf_dir), "2024-01-28 12:00:00", 5)


@query("J8", q.query(
    f"""SELECT name, {q.stamp('max(scheduled_time)')} AS last_scheduled, arg_max(state, run_id) AS last_state,
        (array_agg(error_message ORDER BY scheduled_time DESC, run_id DESC))[1] AS last_error,
        count(*) FILTER (state = 'SUCCEEDED') AS succeeded, count(*) FILTER (state = 'FAILED') AS failed,
        CAST(floor(epoch(TIMESTAMP '{_LOG_END}' - max(completed_time) FILTER (state = 'SUCCEEDED'))) AS BIGINT) AS lag_seconds,
        CAST(floor(epoch(TIMESTAMP '{_LOG_END}' - max(completed_time) FILTER (state = 'SUCCEEDED'))) AS BIGINT) > 600 AS is_late
        FROM refresh_log WHERE scheduled_time <= TIMESTAMP '{_LOG_END}' GROUP BY name""", "refresh_log"))
def run_report(spark, sf_dir):
    return runs.run_report(bridge.refresh_log(spark, sf_dir), _LOG_END, target_lag_seconds=600)
