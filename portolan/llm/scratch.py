"""Intermediate tables in the folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; only a local session may set its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="portolan-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table and read again: cuts the lineage and outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_join(many: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join of ``many`` rows per key with an aggregate that has one.

    Joined on its own grouping keys, the aggregate would stay where it was made, and adaptive
    execution splits a hot key only between two plain exchanges.  A further key, a hash of the
    others, deals both sides anew.
    """
    spare = F.xxhash64(*keys)
    return (many.withColumn("__spare", spare).join(few.withColumn("__spare", spare), [*keys, "__spare"], how)
            .drop("__spare"))
