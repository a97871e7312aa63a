"""Queries over earlier table states."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from portolan import bridge
from portolan.operators import joins, range_hashes, versions
from portolan.plans import sql as q
from portolan.plans.registry import query
from portolan.session import scratch_dir
from portolan.streaming.history import History

_EARLY, _LATE = "2024-01-10 00:00:00", "2024-01-20 00:00:00"


def _state_sql(as_of: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY account_id
        ORDER BY changed_at DESC, change_seq DESC) AS rn FROM changes
        WHERE changed_at <= TIMESTAMP '{as_of}') WHERE rn = 1 AND op <> 'DELETE'"""


def _state(spark, sf_dir, as_of):
    changes = bridge.account_changes(spark, sf_dir)
    return versions.state_as_of(changes, "account_id", "changed_at", "change_seq", "op", as_of)


@query("L1", q.query(
    """SELECT booking_branch, count(*) AS original_count,
       count(*) FILTER (booking_branch <> 'NewYork') AS copy_count FROM trades GROUP BY booking_branch""", "trades"))
def copy_after_delete(spark, sf_dir):
    trades = bridge.trades(spark, sf_dir)
    copy = versions.without(trades, F.col("booking_branch") == "NewYork")
    original = trades.groupBy("booking_branch").agg(F.count("*").alias("original_count"))
    remaining = copy.groupBy("booking_branch").agg(F.count("*").alias("copy_count"))
    return original.join(remaining, "booking_branch", "left").na.fill(0)


@query("L2", q.query(
    f"""SELECT account_id, {q.stamp('changed_at')} AS changed_at, change_seq, status, {q.dbl('balance')} AS balance
        FROM ({_state_sql(_LATE)})""", "changes"))
def accounts_as_of(spark, sf_dir):
    return _state(spark, sf_dir, _LATE)


@query("L2", q.query(
    f"""SELECT account_id, {q.stamp('changed_at')} AS changed_at, change_seq, status, {q.dbl('balance')} AS balance
        FROM ({_state_sql(_LATE)})""", "changes"))
def accounts_as_of_snapshots(spark, sf_dir):
    """The same state from two snapshots and three batches, all but the first full of late changes."""
    changes = bridge.account_changes(spark, sf_dir)
    held = History(spark, scratch_dir(spark, "history"), "account_id", "changed_at", "change_seq", "op")
    for batch, at in enumerate([datetime(2024, 1, 12), datetime(2024, 1, 17, 12), None]):
        held.append(changes.where(F.col("change_seq") % 3 == batch), batch)
        if at:
            held.snapshot(at)
    return held.as_of(datetime.fromisoformat(_LATE))


_LOST = "booking_branch = 'Tokyo' AND trade_date < DATE '1998-01-01'"


@query("L3 C4", q.query(
    f"""SELECT booking_branch, count(*) AS tx_count, {q.dbl('sum(amount)')} AS total_amount FROM (
        SELECT * FROM (SELECT * FROM trades WHERE NOT ({_LOST}))
        UNION ALL
        SELECT * FROM trades WHERE {_LOST}
          AND transaction_id NOT IN (SELECT transaction_id FROM trades WHERE NOT ({_LOST})))
        GROUP BY booking_branch""", "trades"))
def trades_after_restore(spark, sf_dir):
    earlier = bridge.trades(spark, sf_dir)
    current = versions.without(earlier, F.expr(_LOST))
    restored = versions.restore(current, earlier, "transaction_id", F.expr(_LOST))
    return restored.groupBy("booking_branch").agg(
        F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount")
    )


@query("C4", q.query(
    """SELECT customer_id, customer_name FROM customers
       WHERE customer_id NOT IN (SELECT customer_id FROM trades WHERE booking_branch = 'Tokyo')""",
    "customers", "trades"))
def customers_without_tokyo_trades(spark, sf_dir):
    tokyo = bridge.trades(spark, sf_dir).where(F.col("booking_branch") == "Tokyo").select("customer_id")
    return joins.not_in(bridge.customers(spark, sf_dir), "customer_id", tokyo).select("customer_id", "customer_name")


@query("C4", q.query(
    """SELECT customer_id, customer_name FROM customers WHERE customer_id NOT IN
       (SELECT CASE WHEN booking_branch = 'Tokyo' THEN customer_id END FROM trades)""", "customers", "trades"))
def not_in_with_null_keys(spark, sf_dir):
    """A NULL among the keys leaves no row, as SQL demands."""
    keys = bridge.trades(spark, sf_dir).select(
        F.when(F.col("booking_branch") == "Tokyo", F.col("customer_id")).alias("customer_id")
    )
    return joins.not_in(bridge.customers(spark, sf_dir), "customer_id", keys).select("customer_id", "customer_name")


_BETWEEN_SQL = q.query(
    f"""SELECT coalesce(a.account_id, b.account_id) AS account_id,
        CASE WHEN a.account_id IS NULL THEN 'INSERT' WHEN b.account_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op,
        b.status, {q.dbl('b.balance')} AS balance, a.status AS old_status, {q.dbl('a.balance')} AS old_balance
        FROM ({_state_sql(_EARLY)}) a FULL JOIN ({_state_sql(_LATE)}) b ON a.account_id = b.account_id
        WHERE a.account_id IS NULL OR b.account_id IS NULL OR a.status IS DISTINCT FROM b.status
           OR a.balance IS DISTINCT FROM b.balance""", "changes")


@query("J7", _BETWEEN_SQL)
def account_changes_between(spark, sf_dir):
    columns = ["account_id", "status", "balance"]
    return joins.snapshot_diff(
        _state(spark, sf_dir, _EARLY).select(*columns), _state(spark, sf_dir, _LATE).select(*columns), ["account_id"]
    )


@query("J7", _BETWEEN_SQL)
def account_changes_by_range_hashes(spark, sf_dir):
    """The same changes from two stored snapshots: only key ranges whose hashes differ are read and joined."""
    layout = range_hashes.Layout(("account_id",), width=64)
    paths = [scratch_dir(spark, "snapshot") for _ in range(2)]
    for path, as_of in zip(paths, (_EARLY, _LATE), strict=True):
        range_hashes.store(_state(spark, sf_dir, as_of).select("account_id", "status", "balance"), layout, path)
    return range_hashes.stored_diff(spark, *paths, layout)


_RESTATED = "o_orderdate >= DATE '1998-07-01' AND o_orderkey % 5 = 0"


@query("J7", f"""SELECT o_orderkey AS order_key, 'UPDATE' AS op, {q.dbl('o_totalprice + 1')} AS price, {q.dbl('o_totalprice')} AS old_price
    FROM orders WHERE {_RESTATED} AND o_orderkey % 10 <> 0
    UNION ALL SELECT o_orderkey, 'DELETE', NULL, {q.dbl('o_totalprice')} FROM orders WHERE {_RESTATED} AND o_orderkey % 10 = 0
    UNION ALL SELECT -1 - o_orderkey, 'INSERT', {q.dbl('o_totalprice')}, NULL FROM orders WHERE {_RESTATED}""")
def restated_orders_by_range_hashes(spark, sf_dir):
    """Orders of the last weeks change, go, or come under new keys; ranges by the hash of the key."""
    orders = bridge.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("price"), F.expr(_RESTATED).alias("restated"))
    gone = orders.where("NOT restated OR order_key % 10 <> 0")
    restated = gone.withColumn("price", F.when(F.col("restated"), F.col("price") + 1).otherwise(F.col("price")))
    fresh = orders.where("restated").withColumn("order_key", -1 - F.col("order_key"))
    layout = range_hashes.Layout(("order_key",), ranges=16_384)
    paths = [scratch_dir(spark, "orders") for _ in range(2)]
    range_hashes.store(orders.drop("restated"), layout, paths[0])
    range_hashes.store(restated.unionByName(fresh).drop("restated"), layout, paths[1])
    return range_hashes.stored_diff(spark, *paths, layout)
