"""What the plans must and must not contain."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from portolan import bridge
from portolan.operators import joins, layers, messages, reports, search
from portolan.plans.all import REGISTRY

XML_QUERIES = [n for n, query in REGISTRY.items() if query.run and n in (
    "transfer_headers", "transfer_details", "transfer_currency_totals", "large_value_alerts", "statement_entries",
    "account_totals", "second_statement_entry", "remittance_red_flags",
)]


@pytest.mark.parametrize("name", XML_QUERIES)
def test_payload_is_parsed_once(name, spark, data):
    assert plan_of(REGISTRY[name].run(spark, data)).count("from_xml(") == 1


BATCH = [n for n, query in REGISTRY.items() if not set(query.survey.split()) & {
    "A1", "A2", "A3", "A5", "A6", "A8", "J1", "J3", "J4", "J5", "M12"
}]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_unbounded_window(name, spark, data):
    plan = plan_of(REGISTRY[name].run(spark, data))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "CollectLimit" not in plan
    # One row per calendar month, label, or hash prefix is all an unpartitioned window ever sees.
    assert ("Window (" not in plan) or name in (
        "monthly_won_running_total", "label_shares_of_sample", "random_trade_sample"
    )
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark, data):
    trades = bridge.trades(spark, data)
    plan = plan_of(trades.where(F.col("customer_id") == 5).select("amount"))
    assert "EqualTo(o_custkey,5)" in plan and "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan


def test_top_k_keeps_k_rows_per_task(spark, data):
    top = reports.top(bridge.trades(spark, data), 5, F.desc("amount"), F.asc("transaction_id"))
    assert "TakeOrderedAndProject" in plan_of(top)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert "TakeOrderedAndProject" in plan_of(search.scan_search(docs, "doc_id", "text", "the and", 5))


def test_not_in_is_no_broadcast_of_the_subquery(spark, data):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trades = bridge.trades(spark, data)
        plan = plan_of(joins.not_in(trades, "transaction_id", trades.where("amount > 100")))
        joined = layers.customer_summary(bridge.customers(spark, data), trades)
        summary_plan = plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin LeftAnti" in plan and "Broadcast" not in plan
    # Trades are grouped below the join, on the join key.
    assert summary_plan.index("HashAggregate") < len(summary_plan) and "SortMergeJoin LeftOuter" in summary_plan


def test_transfers_keep_malformed_payload_rows_apart(spark):
    frame = spark.createDataFrame([("<Document><a></Document>",), ("no xml",), (None,)], "payload string")
    parsed = messages.parse(frame)
    assert messages.transfers(parsed).count() == 0 and messages.unreadable(parsed).count() == 3


def test_hot_customer_is_split_in_the_join(spark, data):
    """A customer with a third of all trades does not end up in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "24",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        trades = bridge.trades(spark, "/root/testdata/sf0.01")
        hot = trades.withColumn(
            "customer_id", F.when(F.xxhash64("transaction_id") % 3 == 0, 7).otherwise(F.col("customer_id"))
        )
        hot = hot.repartition(8)
        joined = layers.harmonized_trades(hot, bridge.customers(spark, data))
        assert len(joined.collect()) == hot.count()
        assert "SortMergeJoin(skew=true) LeftOuter" in plan_of(joined)
    finally:
        for k, value in old.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


@pytest.mark.parametrize("name", [
    "amounts_never_mix_currencies", "top_countries_by_trade_count", "trade_count_by_year_and_month",
    "daily_summary_of_joined_trades",
])
def test_no_join_without_customer_columns(name, spark, data):
    assert "Join" not in plan_of(REGISTRY[name].run(spark, data))


def test_not_in_reduces_its_subquery(spark, data):
    trades = bridge.trades(spark, data)
    plan = plan_of(joins.not_in(bridge.customers(spark, data), "customer_id", trades.where("amount > 100")))
    below = plan[plan.index("LeftAnti") if "LeftAnti" in plan else 0:]
    assert "keys=[__key" in below or "keys [1]: [__key" in below.lower() or "Keys [1]: [__key" in plan
