"""Grouped reports over trades and deals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.functions import values as v
from portolan.functions.columns import money_text, month_start, percent


def where_optional(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Keep one value of a column, or everything when no value is given."""
    return df if value is None else df.where(F.col(column) == value)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps at most ``n``."""
    return df.orderBy(*order).limit(n)


def share_of_total(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Count per key and its share of all rows in percent, one decimal.

    The total is a scalar subquery that counts rows and reads no column, so there may be
    any number of groups and no task sees them all.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("deal_count"), *aggregates)
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("pct", percent(F.col("deal_count"), total))


def crosstab(df: DataFrame, row: str, column: str, choices: dict[str, str]) -> DataFrame:
    """One count column per choice, plus the row total."""
    return df.groupBy(row).agg(
        *[F.count_if(F.col(column) == value).alias(name) for name, value in choices.items()],
        F.count("*").alias("total"),
    )


def region_by_size(harmonized: DataFrame) -> DataFrame:
    sizes = {"large": v.LARGE, "medium": v.MEDIUM, "small": v.SMALL}
    aggregates = []
    for name, size in sizes.items():
        hit = F.col("company_size") == size
        aggregates.append(F.count(F.when(hit, 1)).alias(f"{name}_count"))
        aggregates.append(money_text(F.sum(F.when(hit, F.col("opportunity_amount")))).alias(f"{name}_amount"))
    return harmonized.groupBy("region").agg(*aggregates)


def rep_report(harmonized: DataFrame) -> DataFrame:
    won, lost = F.sum("won_flag"), F.sum("lost_flag")
    amount = F.col("opportunity_amount")
    return harmonized.groupBy("sales_rep").agg(
        F.count("*").alias("deals"),
        won.alias("won"),
        lost.alias("lost"),
        F.sum("active_flag").alias("active"),
        percent(won, won + lost).alias("win_rate_pct"),
        money_text(F.sum(F.when(F.col("stage") == v.WON, amount))).alias("won_amount"),
        money_text(F.sum(F.when(F.col("active_flag") == 1, amount))).alias("open_amount"),
    )


def industry_report(harmonized: DataFrame) -> DataFrame:
    won, lost = F.sum("won_flag"), F.sum("lost_flag")
    amount = F.col("opportunity_amount")
    return harmonized.groupBy("industry").agg(
        F.count("*").alias("deals"),
        won.alias("won"),
        lost.alias("lost"),
        percent(won, won + lost).alias("win_rate_pct"),
        money_text(F.sum(amount)).alias("total_amount"),
        money_text(F.sum(F.when(F.col("stage") == v.WON, amount))).alias("won_amount"),
        money_text(F.avg(amount)).alias("avg_amount"),
    )


def monthly_won(harmonized: DataFrame) -> DataFrame:
    """Won deals per expected month with running totals.

    The window has no partition key, but it only sees one row per calendar month.
    """
    monthly = (
        harmonized.where(F.col("stage") == v.WON)
        .groupBy(month_start(F.col("expected_close_date")).alias("close_month"))
        .agg(F.count("*").alias("won_count"), F.sum("opportunity_amount").alias("won_amount"))
    )
    running = Window.orderBy("close_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "close_month",
        "won_count",
        money_text(F.col("won_amount")).alias("won_amount"),
        F.sum("won_count").over(running).alias("running_count"),
        money_text(F.sum("won_amount").over(running)).alias("running_amount"),
    )


def stage_pivot(summary: DataFrame, how: str = "sum") -> DataFrame:
    """Industry x stage deal counts, zero where a pair is absent.

    ``sum`` adds the summary rows of a pair; ``avg`` averages them instead.
    """
    aggregate = {"sum": F.sum, "avg": F.avg}[how]
    stages = [v.PROPOSAL, v.QUOTE, v.WON, v.LOST]
    return summary.groupBy("industry").pivot("stage", stages).agg(aggregate("deal_count")).na.fill(0)


def roll_up(summary: DataFrame, key: str) -> DataFrame:
    """Sum an existing daily summary by one of its keys; sums of sums stay exact."""
    return summary.groupBy(key).agg(
        F.sum("total_amount").alias("total_amount"), F.sum("tx_count").alias("tx_count")
    )


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` pseudo-random rows, the same for the same seed; all rows if there are fewer.

    Rows are ranked by a seeded hash.  Counts per hash prefix, at most 65,536 whatever the
    size of the table, tell the prefix at which ``n`` rows are reached; only rows up to it
    are ranked, so the last task gets about ``n`` rows and not ``n`` of every task.
    """
    rank = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    counts = df.groupBy(F.substring(rank, 1, 4).alias("prefix")).agg(F.count("*").alias("n"))
    reached = counts.withColumn("upto", F.sum("n").over(Window.orderBy("prefix"))).where(F.col("upto") >= n)
    last = F.coalesce(reached.agg(F.min("prefix")).scalar(), F.lit("ffff"))
    return df.where(F.substring(rank, 1, 4) <= last).orderBy(rank, key).limit(n)
