"""Metric queries over the semantic views."""

from __future__ import annotations

from pyspark.sql import functions as F

from portolan import bridge
from portolan.functions import values as v
from portolan.operators import layers, metrics
from portolan.plans import sql as q
from portolan.plans.registry import query


def _views(spark, sf_dir):
    return {
        "trade_orders": layers.trade_orders_view(bridge.trades(spark, sf_dir), bridge.customers(spark, sf_dir)),
        "corporate_sales": layers.semantic_sales(layers.harmonized_sales(bridge.sales(spark, sf_dir))),
    }


_JOINED = "trades t LEFT JOIN customers c ON t.customer_id = c.customer_id"
_CLOSED = f"count(*) FILTER (stage IN ('{v.WON}', '{v.LOST}'))"
_WON = f"count(*) FILTER (stage = '{v.WON}')"


@query("N1 N2", q.query(
    f"""SELECT c.customer_segment, t.currency_code, {q.dbl('sum(t.amount)')} AS total_trade_amount,
        count(*) AS trade_count, round(avg(t.amount), 6) AS avg_trade_amount FROM {_JOINED}
        WHERE c.risk_rating = 'HIGH' GROUP BY ALL""", "trades", "customers"))
def metrics_by_segment_and_currency(spark, sf_dir):
    return metrics.metric_query(
        _views(spark, sf_dir), ["取引総額", "件数", "average"], ["segment", "通貨"],
        filters=[F.col("risk_rating") == "HIGH"],
    )


@query("N3", q.query(
    """SELECT CAST(year(trade_date) AS INTEGER) AS trade_year, CAST(month(trade_date) AS INTEGER) AS trade_month,
       count(*) AS trade_count FROM trades GROUP BY ALL""", "trades"))
def trade_count_by_year_and_month(spark, sf_dir):
    return metrics.metric_query(_views(spark, sf_dir), ["trade_count"], ["year", "month"])


@query("N5", q.query(
    f"""SELECT booking_branch, currency_code, {q.dbl('sum(amount)')} AS total_trade_amount
        FROM trades GROUP BY ALL""", "trades"))
def amounts_never_mix_currencies(spark, sf_dir):
    """Asked by branch only; the currency joins the grain by itself."""
    return metrics.metric_query(_views(spark, sf_dir), ["total amount"], ["branch"])


@query("N4 N6", q.query(
    f"""SELECT industry, region, count(*) AS deal_count, {q.dbl('sum(opportunity_amount)')} AS total_pipeline,
        round({_WON} / nullif({_CLOSED}, 0), 6) AS win_rate,
        {q.dbl(f"sum(opportunity_amount) FILTER (stage IN ('{v.PROPOSAL}', '{v.QUOTE}'))")} AS open_balance
        FROM sales GROUP BY ALL""", "sales"))
def sales_metrics_by_industry_and_region(spark, sf_dir):
    df = metrics.metric_query(
        _views(spark, sf_dir), ["案件数", "total_pipeline", "受注率", "open_balance"], ["業種", "営業地域"]
    )
    return df.withColumn("win_rate", F.round("win_rate", 6))


@query("N7", q.query(
    f"""SELECT sales_rep, count(*) AS deal_count,
        CAST(((2000 * {_WON} + {_CLOSED}) // (2 * {_CLOSED})) // 10 AS VARCHAR) || '.' ||
        CAST(((2000 * {_WON} + {_CLOSED}) // (2 * {_CLOSED})) % 10 AS VARCHAR) || '%' AS win_rate,
        {q.money(f"sum(opportunity_amount) FILTER (stage IN ('{v.PROPOSAL}', '{v.QUOTE}'))")} AS open_balance
        FROM sales GROUP BY sales_rep
        ORDER BY sum(opportunity_amount) FILTER (stage IN ('{v.PROPOSAL}', '{v.QUOTE}')) DESC NULLS LAST, sales_rep
        LIMIT 10""", "sales"))
def sales_status_top_ten(spark, sf_dir):
    return metrics.sales_status(_views(spark, sf_dir)["corporate_sales"])


@query("N7 N1", q.query(
    """SELECT counterparty_country, count(*) AS trade_count FROM trades GROUP BY counterparty_country
       ORDER BY count(*) DESC, counterparty_country LIMIT 10""", "trades"))
def top_countries_by_trade_count(spark, sf_dir):
    return metrics.metric_query(
        _views(spark, sf_dir), ["count"], ["相手国"], entity="trade_orders", limit=metrics.DEFAULT_TOP
    )
