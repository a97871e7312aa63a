"""Joins that need more than ``df.join``: additive merge, reconcile, NOT IN, diff."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_additive(target: DataFrame, delta: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Upsert where a matched key adds its measures and a new key is inserted.

    Written as union + group: the sums combine on the map side, a key with NULL parts
    meets its equal (``<=>``), and several delta rows of one key are fine.
    """
    columns = [*keys, *measures]
    return (
        target.select(*columns)
        .unionByName(delta.select(*columns))
        .groupBy(*keys)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], measures: list[str], one_sided: bool = False
) -> DataFrame:
    """Measures of two aggregates side by side on equal keys.

    With ``one_sided`` keys found on one side only are listed too, and each measure gets
    a difference column that counts a missing side as zero.
    """
    a, b = left.alias("l"), right.alias("r")
    if not one_sided:
        return a.join(b, keys, "inner").select(
            *keys,
            *[F.col(f"{side}.{m}").alias(f"{name}_{m}") for m in measures
              for side, name in (("l", "left"), ("r", "right"))],
        )
    on = reduce(lambda x, y: x & y, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    zero = F.lit(0)
    return a.join(b, on, "full").select(
        *[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys],
        *[F.col(f"{side}.{m}").alias(f"{name}_{m}") for m in measures
          for side, name in (("l", "left"), ("r", "right"))],
        *[(F.coalesce(F.col(f"l.{m}"), zero) - F.coalesce(F.col(f"r.{m}"), zero)).alias(f"diff_{m}")
          for m in measures],
    )


def not_in(left: DataFrame, key: str, right: DataFrame, right_key: str | None = None) -> DataFrame:
    """``key NOT IN (SELECT right_key ...)`` with SQL's NULL rules, without a broadcast.

    Spark runs a null-aware anti join only by broadcasting the whole subquery.  Here the
    rows go through an ordinary anti join, and two flags from one aggregate settle the
    NULL cases: any NULL in the subquery rejects every row, and a NULL on the left passes
    only when the subquery is empty.
    """
    other = right.select(F.col(right_key or key).alias("__key"))
    facts = other.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.col("__key").isNull()), F.lit(False)).alias("has_null")
    )
    allowed = facts.select(F.when(F.col("has_null"), "none").when(F.col("n") == 0, "all").otherwise("keyed"))
    kept = left.where(
        (allowed.scalar() == "all") | ((allowed.scalar() == "keyed") & F.col(key).isNotNull())
    )
    # One row per value: a value that fills the subquery would else be one task's work.
    distinct = other.where(F.col("__key").isNotNull()).distinct()
    return kept.join(distinct, kept[key] == distinct["__key"], "left_anti")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Row changes between two snapshots of a keyed table: INSERT, DELETE or UPDATE.

    NULL keys are equal to each other.
    """
    values = [c for c in new.columns if c not in keys]
    a = old.select(*keys, F.struct(*values).alias("old_row"))
    b = new.select(*keys, F.struct(*values).alias("new_row"))
    op = (
        F.when(F.col("old_row").isNull(), "INSERT")
        .when(F.col("new_row").isNull(), "DELETE")
        .when(~F.col("old_row").eqNullSafe(F.col("new_row")), "UPDATE")
    )
    on = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return (
        a.alias("a").join(b.alias("b"), on, "full")
        .withColumn("op", op)
        .where(F.col("op").isNotNull())
        .select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
                "op", *[F.col(f"new_row.{c}").alias(c) for c in values],
                *[F.col(f"old_row.{c}").alias(f"old_{c}") for c in values])
    )
