"""Layered views: raw -> harmonized -> analytics -> semantic.

Each function takes DataFrames and returns one; nothing runs until the caller acts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions import values as v
from portolan.functions.columns import won_ratio

DAILY_KEYS = ["trade_date", "booking_branch", "currency_code", "transaction_type"]
CUSTOMER_KEYS = ["customer_id", "customer_name", "region", "customer_segment", "risk_rating"]

SEMANTIC_TRADE_COLUMNS = [
    "transaction_id", "trade_date", "settlement_date", "customer_id", "customer_region",
    "customer_segment", "risk_rating", "counterparty_country", "transaction_type",
    "currency_code", "amount", "booking_branch", "instrument_type",
]
SEMANTIC_SALES_COLUMNS = [
    "deal_id", "sales_rep", "industry", "company_size", "opportunity_amount", "stage",
    "region", "last_visit_date", "expected_close_date",
]


def harmonized_trades(trades: DataFrame, customers: DataFrame) -> DataFrame:
    """Every trade with its customer's attributes; a trade without a customer stays.

    A hot customer sits on the left side of a left join, which adaptive execution splits.
    """
    attributes = customers.select(
        "customer_id", "customer_name", "contact_email", "contact_phone",
        F.col("region").alias("customer_region"), "customer_segment", "risk_rating",
    )
    return trades.join(attributes, "customer_id", "left").select(
        *[trades[c] for c in trades.columns], *attributes.columns[1:]
    )


def daily_summary(trades: DataFrame, extremes: bool = False) -> DataFrame:
    """Date x branch x currency x type: count, sum, average; optionally min and max."""
    aggregates = [
        F.count("*").alias("tx_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
    ]
    if extremes:
        aggregates += [F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount")]
    return trades.groupBy(*DAILY_KEYS).agg(*aggregates)


def joined_daily_summary(trades: DataFrame, customers: DataFrame, unique_customers: bool = False) -> DataFrame:
    """The daily summary, with extremes, of trades joined with their customers.

    No customer column is asked for, so with ``unique_customers`` (``customer_id`` is stated to
    be a key) the left join changes nothing and the trades are grouped without it.
    """
    if unique_customers:
        return daily_summary(trades, extremes=True)
    return daily_summary(harmonized_trades(trades, customers), extremes=True)


def customer_summary(customers: DataFrame, trades: DataFrame) -> DataFrame:
    """Per customer: trade count (0 without trades), sum and latest date (NULL without).

    Trades are reduced to one row per customer before the join, so a customer with a
    third of all trades shrinks on the map side and the join carries no skew.
    """
    per_customer = trades.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("transaction_id").alias("tx_count"),
        F.sum("amount").alias("total_amount"),
        F.max("trade_date").alias("latest_trade_date"),
    )
    return customers.select(*CUSTOMER_KEYS).join(per_customer, "customer_id", "left").withColumn(
        "tx_count", F.coalesce("tx_count", F.lit(0))
    )


def semantic_trades(harmonized: DataFrame) -> DataFrame:
    """Trades without personal data, the customer key as text."""
    return harmonized.withColumn("customer_id", F.col("customer_id").cast("string")).select(
        *SEMANTIC_TRADE_COLUMNS
    )


def trade_orders_view(trades: DataFrame, customers: DataFrame) -> Callable[[set[str]], DataFrame]:
    """The semantic view of trades for a set of asked names and conditions.

    Customers are joined only if one of their attributes is named; without, these columns are
    absent.
    """
    attributes = ("customer_region", "customer_segment", "risk_rating")

    def view(asked: set[str]) -> DataFrame:
        if any(a in text for a in attributes for text in asked):
            return semantic_trades(harmonized_trades(trades, customers))
        return trades.withColumn("customer_id", F.col("customer_id").cast("string")).select(
            *[c for c in SEMANTIC_TRADE_COLUMNS if c not in attributes]
        )

    return view


def harmonized_sales(sales: DataFrame) -> DataFrame:
    """Deals plus the flags won / lost / active as 1 or 0."""
    return sales.withColumns(
        {
            "won_flag": F.when(F.col("stage") == v.WON, 1).otherwise(0),
            "lost_flag": F.when(F.col("stage") == v.LOST, 1).otherwise(0),
            "active_flag": F.when(F.col("stage").isin(v.PROPOSAL, v.QUOTE), 1).otherwise(0),
        }
    )


def rep_performance(harmonized: DataFrame) -> DataFrame:
    won, lost = F.sum("won_flag"), F.sum("lost_flag")
    return harmonized.groupBy("sales_rep").agg(
        F.count("*").alias("total_deals"),
        won.alias("won_deals"),
        lost.alias("lost_deals"),
        F.sum("active_flag").alias("active_deals"),
        won_ratio(won, lost).alias("win_rate"),
        F.sum(F.when(F.col("stage") == v.WON, F.col("opportunity_amount"))).alias("won_amount"),
        F.sum("opportunity_amount").alias("pipeline_amount"),
    )


def deal_summary(harmonized: DataFrame) -> DataFrame:
    """Industry x size x region x stage."""
    return harmonized.groupBy("industry", "company_size", "region", "stage").agg(
        F.count("*").alias("deal_count"),
        F.sum("opportunity_amount").alias("total_amount"),
        F.avg("opportunity_amount").alias("avg_amount"),
    )


def semantic_sales(harmonized: DataFrame) -> DataFrame:
    return harmonized.select(*SEMANTIC_SALES_COLUMNS)
