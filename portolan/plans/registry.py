"""Registry of runnable queries: name -> Spark callable, DuckDB oracle, survey id."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    survey: str
    sql: str | None


REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Column types that both engines hand over alike.

    The library works in decimals, dates and timestamps.  Only here, at the border to the
    side-by-side check, money becomes double and points in time become text.
    """
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            col = F.substring(col.cast("string"), 1, 19)
        out.append(col.alias(field.name))
    return df.select(*out)


def query(survey: str, sql: str | None = None):
    """Register a function under its own name."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        name = run.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(lambda spark, sf_dir: portable(run(spark, sf_dir)), survey, sql)
        return run

    return add
