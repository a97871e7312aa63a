"""A small metric layer: named dimensions and metrics over the semantic views.

A metric query names metrics, dimensions and filters; it becomes one ``groupBy().agg()``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.functions import values as v
from portolan.functions.columns import money_text, percent_text, safe_ratio


@dataclass(frozen=True)
class Entity:
    """One semantic view: its dimensions, metrics, and the names people use for them."""

    dimensions: dict[str, Column]
    metrics: dict[str, Column]
    synonyms: dict[str, tuple[str, ...]]
    # Metrics that add amounts of several currencies unless grouped by this dimension.
    per_currency: tuple[str, ...] = ()
    currency: str | None = None


class AmbiguousName(ValueError):
    """A name that stands for more than one dimension or metric."""


def entities() -> dict[str, Entity]:
    """The trade and sales models."""
    won = F.count_if(F.col("stage") == v.WON)
    closed = F.count_if(F.col("stage").isin(v.WON, v.LOST))
    still_open = F.col("stage").isin(v.PROPOSAL, v.QUOTE)
    plain = lambda *names: {n: F.col(n) for n in names}
    return {
        "trade_orders": Entity(
            dimensions={
                **plain("transaction_id", "customer_id", "customer_region", "customer_segment", "risk_rating",
                        "counterparty_country", "transaction_type", "currency_code", "booking_branch",
                        "instrument_type", "trade_date"),
                "trade_year": F.year("trade_date"),
                "trade_month": F.month("trade_date"),
            },
            metrics={
                "total_trade_amount": F.sum("amount"),
                "trade_count": F.count("transaction_id"),
                "avg_trade_amount": F.avg("amount"),
            },
            synonyms=v.TRADE_SYNONYMS,
            per_currency=("total_trade_amount", "avg_trade_amount"),
            currency="currency_code",
        ),
        "corporate_sales": Entity(
            dimensions=plain("deal_id", "sales_rep", "industry", "company_size", "stage", "region",
                             "expected_close_date"),
            metrics={
                "total_pipeline": F.sum("opportunity_amount"),
                "deal_count": F.count("deal_id"),
                "win_rate": safe_ratio(won, closed),
                "open_balance": F.sum(F.when(still_open, F.col("opportunity_amount"))),
            },
            synonyms=v.SALES_SYNONYMS,
        ),
    }


def synonym_rows() -> list[tuple[str, str, str]]:
    """(name in lower case, entity, canonical name) of everything that can be asked for."""
    rows = []
    for entity_name, entity in entities().items():
        for canonical in [*entity.dimensions, *entity.metrics]:
            for name in (canonical, *entity.synonyms.get(canonical, ())):
                rows.append((name.lower(), entity_name, canonical))
    return rows


def synonym_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(synonym_rows(), "name string, entity string, canonical string").distinct()


def resolve(name: str, entity: str | None = None) -> tuple[str, str]:
    """(entity, canonical name) of a name or synonym; ambiguous names are refused."""
    found = {
        (e, c) for n, e, c in synonym_rows() if n == name.lower() and entity in (None, e)
    }
    if len(found) > 1:
        raise AmbiguousName(f"{name!r} may mean {', '.join(sorted(f'{e}.{c}' for e, c in found))}")
    if not found:
        raise KeyError(f"unknown name {name!r}")
    return found.pop()


def metric_query(
    views: dict[str, DataFrame | Callable[[set[str]], DataFrame]],
    metrics: list[str],
    dimensions: list[str] = (),
    filters: list[Column] = (),
    entity: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Metrics by dimensions over one entity.

    Amounts of different currencies are never added: such a metric brings the currency
    into the grain.  With ``limit`` the rows with the highest first metric are kept.  A view may
    be a function of the names and conditions asked for, so that it joins no more than it must.
    """
    resolved = [resolve(n, entity) for n in [*metrics, *dimensions]]
    names = {e for e, _ in resolved}
    if len(names) != 1:
        raise ValueError(f"one query reads one entity, not {sorted(names)}")
    name = names.pop()
    model = entities()[name]
    chosen = [c for _, c in resolved[: len(metrics)]]
    grain = [c for _, c in resolved[len(metrics):]]
    wrong = [c for c in chosen if c not in model.metrics] + [c for c in grain if c not in model.dimensions]
    if wrong:
        raise ValueError(f"used in the wrong place: {wrong}")
    if model.currency and model.currency not in grain and any(c in model.per_currency for c in chosen):
        grain.append(model.currency)

    rows = views[name]
    if callable(rows):
        rows = rows({*grain, *chosen, *map(str, filters)})
    for condition in filters:
        rows = rows.where(condition)
    result = rows.groupBy(*[model.dimensions[d].alias(d) for d in grain]).agg(
        *[model.metrics[m].alias(m) for m in chosen]
    )
    if limit is not None:
        result = result.orderBy(F.desc_nulls_last(chosen[0]), *grain).limit(limit)
    return result


DEFAULT_TOP = 10


def sales_status(sales_view: DataFrame) -> DataFrame:
    """Per rep: deals, win rate as text, open balance as text; the ten largest balances."""
    won = F.count_if(F.col("stage") == v.WON)
    closed = F.count_if(F.col("stage").isin(v.WON, v.LOST))
    balance = entities()["corporate_sales"].metrics["open_balance"]
    return (
        sales_view.groupBy("sales_rep")
        .agg(F.count("deal_id").alias("deal_count"), percent_text(won, closed).alias("win_rate"),
             balance.alias("balance"))
        .orderBy(F.desc_nulls_last("balance"), "sales_rep")
        .limit(DEFAULT_TOP)
        .select("sales_rep", "deal_count", "win_rate", money_text(F.col("balance")).alias("open_balance"))
    )
