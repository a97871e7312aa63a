"""Queries over corporate sales deals."""

from __future__ import annotations

from pyspark.sql import functions as F

from portolan import bridge
from portolan.functions import values as v
from portolan.operators import layers, reports
from portolan.plans import sql as q
from portolan.plans.registry import query

_WON = f"count(*) FILTER (stage = '{v.WON}')"
_LOST = f"count(*) FILTER (stage = '{v.LOST}')"
_OPEN = f"count(*) FILTER (stage IN ('{v.PROPOSAL}', '{v.QUOTE}'))"
_WON_AMOUNT = f"sum(opportunity_amount) FILTER (stage = '{v.WON}')"
_OPEN_AMOUNT = f"sum(opportunity_amount) FILTER (stage IN ('{v.PROPOSAL}', '{v.QUOTE}'))"
# Percent with one decimal, rounded half up in whole numbers.
_WIN_PCT = f"CASE WHEN {_WON} + {_LOST} > 0 THEN ((2000 * {_WON} + {_WON} + {_LOST}) // (2 * ({_WON} + {_LOST}))) / 10.0 END"


def _harmonized(spark, sf_dir):
    return layers.harmonized_sales(bridge.sales(spark, sf_dir))


@query("B7 B8", q.query(
    f"""SELECT deal_id, sales_rep, stage, {q.dbl('opportunity_amount')} AS opportunity_amount,
        CAST(stage = '{v.WON}' AS INTEGER) AS won_flag, CAST(stage = '{v.LOST}' AS INTEGER) AS lost_flag,
        CAST(stage IN ('{v.PROPOSAL}', '{v.QUOTE}') AS INTEGER) AS active_flag FROM sales""", "sales"))
def sales_flags(spark, sf_dir):
    return _harmonized(spark, sf_dir).select(
        "deal_id", "sales_rep", "stage", "opportunity_amount", "won_flag", "lost_flag", "active_flag"
    )


@query("B2", q.query(
    f"""SELECT deal_id, sales_rep, industry, company_size, {q.dbl('opportunity_amount')} AS opportunity_amount,
        stage, region, {q.day('last_visit_date')} AS last_visit_date,
        {q.day('expected_close_date')} AS expected_close_date FROM sales""", "sales"))
def semantic_sales(spark, sf_dir):
    return layers.semantic_sales(_harmonized(spark, sf_dir))


@query("D6 H2", q.query(
    f"""SELECT sales_rep, count(*) AS total_deals, {_WON} AS won_deals, {_LOST} AS lost_deals,
        {_OPEN} AS active_deals, round({_WON} / nullif({_WON} + {_LOST}, 0), 6) AS win_rate,
        {q.dbl(_WON_AMOUNT)} AS won_amount, {q.dbl('sum(opportunity_amount)')} AS pipeline_amount
        FROM sales GROUP BY sales_rep""", "sales"))
def rep_performance(spark, sf_dir):
    df = layers.rep_performance(_harmonized(spark, sf_dir))
    # A rep without wins has a NULL amount and comes first, as the dialect sorts NULLs high.
    return df.withColumn("win_rate", F.round("win_rate", 6)).orderBy(F.desc_nulls_first("won_amount"))


@query("D7", q.query(
    f"""SELECT industry, company_size, region, stage, count(*) AS deal_count,
        {q.dbl('sum(opportunity_amount)')} AS total_amount, round(avg(opportunity_amount), 6) AS avg_amount
        FROM sales GROUP BY ALL""", "sales"))
def deal_summary(spark, sf_dir):
    return layers.deal_summary(_harmonized(spark, sf_dir))


@query("D8", q.query(
    f"""SELECT count(*) AS total_rows, count(DISTINCT deal_id) AS unique_deals,
        {q.dbl('sum(opportunity_amount)')} AS total_opportunity_amount,
        round(avg(opportunity_amount), 2) AS avg_opportunity_amount,
        {q.day('min(last_visit_date)')} AS earliest_visit, {q.day('max(expected_close_date)')} AS latest_close_date
        FROM sales""", "sales"))
def sales_statistics(spark, sf_dir):
    return bridge.sales(spark, sf_dir).agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("deal_id").alias("unique_deals"),
        F.sum("opportunity_amount").alias("total_opportunity_amount"),
        F.round(F.avg("opportunity_amount"), 2).alias("avg_opportunity_amount"),
        F.min("last_visit_date").alias("earliest_visit"),
        F.max("expected_close_date").alias("latest_close_date"),
    )


@query("D9", q.query(
    f"""SELECT stage, count(*) AS deal_count, {q.dbl('sum(opportunity_amount)')} AS total_amount,
        round(avg(opportunity_amount), 0) AS avg_amount FROM sales GROUP BY stage""", "sales"))
def stage_distribution(spark, sf_dir):
    return bridge.sales(spark, sf_dir).groupBy("stage").agg(
        F.count("*").alias("deal_count"),
        F.sum("opportunity_amount").alias("total_amount"),
        F.round(F.avg("opportunity_amount"), 0).alias("avg_amount"),
    ).orderBy(F.desc("total_amount"))


@query("F2", q.query(
    f"""SELECT sales_rep, count(*) AS deal_count, {q.dbl('sum(opportunity_amount)')} AS total_amount
        FROM sales GROUP BY sales_rep ORDER BY sum(opportunity_amount) DESC, sales_rep LIMIT 5""", "sales"))
def top_reps_by_amount(spark, sf_dir):
    per_rep = bridge.sales(spark, sf_dir).groupBy("sales_rep").agg(
        F.count("*").alias("deal_count"), F.sum("opportunity_amount").alias("total_amount"),
    )
    return reports.top(per_rep, 5, F.desc("total_amount"), F.asc("sales_rep"))


@query("E1", q.query(
    f"""SELECT industry, count(*) AS deal_count, {q.dbl('sum(opportunity_amount)')} AS total_amount,
        ((2000 * count(*) + sum(count(*)) OVER ()) // (2 * sum(count(*)) OVER ())) / 10.0::DOUBLE AS pct
        FROM sales GROUP BY industry""", "sales"))
def industry_share(spark, sf_dir):
    return reports.share_of_total(
        bridge.sales(spark, sf_dir), "industry", F.sum("opportunity_amount").alias("total_amount")
    ).orderBy(F.desc("deal_count"))


@query("D10", q.query(
    f"""SELECT region, count(*) FILTER (stage = '{v.PROPOSAL}') AS proposals,
        count(*) FILTER (stage = '{v.QUOTE}') AS quotes, {_WON} AS won, {_LOST} AS lost, count(*) AS total
        FROM sales GROUP BY region""", "sales"))
def region_by_stage(spark, sf_dir):
    stages = {"proposals": v.PROPOSAL, "quotes": v.QUOTE, "won": v.WON, "lost": v.LOST}
    return reports.crosstab(bridge.sales(spark, sf_dir), "region", "stage", stages).orderBy(F.desc("total"))


def _size_sql(name: str, size: str) -> str:
    total = q.money(f"sum(opportunity_amount) FILTER (company_size = '{size}')")
    return f"count(*) FILTER (company_size = '{size}') AS {name}_count, {total} AS {name}_amount"


@query("D11 H1", q.query(
    f"""SELECT region, {_size_sql('large', v.LARGE)}, {_size_sql('medium', v.MEDIUM)},
        {_size_sql('small', v.SMALL)} FROM sales GROUP BY region""", "sales"))
def region_by_company_size(spark, sf_dir):
    return reports.region_by_size(_harmonized(spark, sf_dir)).orderBy("region")


@query("D12 H1", q.query(
    f"""SELECT sales_rep, count(*) AS deals, {_WON} AS won, {_LOST} AS lost, {_OPEN} AS active,
        {_WIN_PCT} AS win_rate_pct, {q.money(_WON_AMOUNT)} AS won_amount, {q.money(_OPEN_AMOUNT)} AS open_amount
        FROM sales GROUP BY sales_rep""", "sales"))
def rep_report(spark, sf_dir):
    return reports.rep_report(_harmonized(spark, sf_dir)).orderBy(F.desc_nulls_first("win_rate_pct"))


@query("D13 H1", q.query(
    f"""SELECT industry, count(*) AS deals, {_WON} AS won, {_LOST} AS lost, {_WIN_PCT} AS win_rate_pct,
        {q.money('sum(opportunity_amount)')} AS total_amount, {q.money(_WON_AMOUNT)} AS won_amount,
        {q.money('avg(opportunity_amount)')} AS avg_amount FROM sales GROUP BY industry""", "sales"))
def industry_report(spark, sf_dir):
    return reports.industry_report(_harmonized(spark, sf_dir)).orderBy(F.desc_nulls_first("win_rate_pct"))


@query("E2 H3", q.query(
    f"""SELECT {q.day('close_month')} AS close_month, won_count, {q.money('won_amount')} AS won_amount,
        CAST(sum(won_count) OVER w AS BIGINT) AS running_count, {q.money('sum(won_amount) OVER w')} AS running_amount
        FROM (SELECT CAST(date_trunc('month', expected_close_date) AS DATE) AS close_month, count(*) AS won_count,
              sum(opportunity_amount) AS won_amount FROM sales WHERE stage = '{v.WON}' GROUP BY 1)
        WINDOW w AS (ORDER BY close_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "sales"))
def monthly_won_running_total(spark, sf_dir):
    return reports.monthly_won(_harmonized(spark, sf_dir)).orderBy("close_month")


_STAGES = [v.PROPOSAL, v.QUOTE, v.WON, v.LOST]


@query("D20", q.query(
    "SELECT industry, " + ", ".join(f"count(*) FILTER (stage = '{s}') AS \"{s}\"" for s in _STAGES)
    + " FROM sales GROUP BY industry", "sales"))
def industry_by_stage_pivot(spark, sf_dir):
    return reports.stage_pivot(layers.deal_summary(_harmonized(spark, sf_dir)))


@query("D20", q.query(
    "SELECT industry, "
    + ", ".join(f"coalesce(round(avg(n) FILTER (stage = '{s}'), 6), 0) AS \"{s}\"" for s in _STAGES)
    + " FROM (SELECT industry, company_size, region, stage, count(*) AS n FROM sales GROUP BY ALL) GROUP BY industry",
    "sales"))
def industry_by_stage_pivot_mean(spark, sf_dir):
    pivot = reports.stage_pivot(layers.deal_summary(_harmonized(spark, sf_dir)), how="avg")
    return pivot.select("industry", *[F.round(s, 6).alias(s) for s in _STAGES])


@query("D21", q.query(
    f"""SELECT count(*) AS total_deals, {_WON} AS won_deals, {q.dbl(_WON_AMOUNT)} AS won_amount FROM sales""",
    "sales"))
def sales_headline(spark, sf_dir):
    return layers.rep_performance(_harmonized(spark, sf_dir)).agg(
        F.sum("total_deals").alias("total_deals"),
        F.sum("won_deals").alias("won_deals"),
        F.sum("won_amount").alias("won_amount"),
    )


@query("D17 A7", q.query(
    f"""SELECT count(*) AS total_rows, count(DISTINCT deal_id) AS unique_deals, source_file,
        {q.stamp('min(loaded_at)')} AS first_loaded, {q.stamp('max(loaded_at)')} AS last_loaded
        FROM sales GROUP BY source_file""", "sales"))
def load_history_per_file(spark, sf_dir):
    return bridge.sales(spark, sf_dir).groupBy("source_file").agg(
        F.count("*").alias("total_rows"), F.count_distinct("deal_id").alias("unique_deals"),
        F.min("loaded_at").alias("first_loaded"), F.max("loaded_at").alias("last_loaded"),
    )


@query("A7", q.query(
    f"""SELECT count(*) AS row_count, {q.day('min(last_visit_date)')} AS min_date,
        {q.day('max(last_visit_date)')} AS max_date, count(DISTINCT source_file) AS file_count FROM sales""", "sales"))
def load_report(spark, sf_dir):
    return bridge.sales(spark, sf_dir).agg(
        F.count("*").alias("row_count"), F.min("last_visit_date").alias("min_date"),
        F.max("last_visit_date").alias("max_date"), F.count_distinct("source_file").alias("file_count"),
    )
