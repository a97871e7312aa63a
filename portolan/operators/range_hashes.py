"""Differences of two stored snapshots by hashes of key ranges.

A snapshot is stored with a hash tree of three levels: the whole table is pages, a page is key ranges, a range
is rows.  A node is a count and two sums of its rows' hashes, so it does not depend on the order of
the rows and comes from its parts.  Two snapshots of one layout are compared from the top: pages that agree are
not opened, of the others only the ranges that differ are read and joined by key.  So a diff costs
the pages (4096 at most) and what changed, not the tables.

Keys must be unique within a snapshot, as for ``joins.snapshot_diff``; NULL keys are equal to each other.
Hashes of 64 bits stand for rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, MapType, StructType, VariantType

from portolan.operators.joins import snapshot_diff

PAGES = 4096
RANGES_OF_PAGE = 256
_HALF = (1 << 32) - 1
_NODE = ["n", "low", "high"]


@dataclass(frozen=True)
class Layout:
    """How keys fall into ranges; snapshots are comparable if theirs are equal.

    With ``width`` a range is that many consecutive whole numbers of the first key, so that changes to
    neighbouring keys meet in few ranges.  Without it, a range is a share of the hashes
    of the keys, ``ranges`` in number, which suits keys of any type.
    """

    keys: tuple[str, ...]
    width: int | None = None
    ranges: int = PAGES * RANGES_OF_PAGE

    def leaf(self) -> Column:
        if self.width is not None:
            return F.coalesce(F.floor(F.col(self.keys[0]) / F.lit(self.width).cast("decimal(20,0)")).cast("bigint"), F.lit(0))
        return F.pmod(row_hash([F.col(k) for k in self.keys]), F.lit(self.ranges).cast("bigint"))

    @staticmethod
    def page(leaf: Column) -> Column:
        """Neighbouring ranges share a page; pages start over after the last, so their number is bounded."""
        return F.pmod(F.floor(leaf / F.lit(RANGES_OF_PAGE)).cast("bigint"), F.lit(PAGES).cast("bigint")).cast("int")


def row_hash(columns: list[Column]) -> Column:
    """A hash of the values and of which of them are NULL; the engine's hash alone skips NULLs."""
    return F.xxhash64(F.concat(*[F.isnull(c).cast("string") for c in columns]), *columns)


def _hashable(df: DataFrame) -> list[Column]:
    """Nested values as text, in which an empty array and one of a NULL differ."""
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, StructType, MapType)):
            col = F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})
        elif isinstance(field.dataType, VariantType):
            col = F.to_json(col)
        out.append(col)
    return out


def _sums(low: Column, high: Column, n: Column) -> list[Column]:
    """A node from its parts; halves of 32 bits keep the sums of up to 2^31 parts within a long."""
    return [n.alias("n"), F.sum(low).bitwiseAND(F.lit(_HALF)).alias("low"), F.sum(high).bitwiseAND(F.lit(_HALF)).alias("high")]


def store(df: DataFrame, layout: Layout, path: str) -> None:
    """Write a snapshot: rows by page, sorted by range, and the nodes of its ranges and pages.

    Column names starting with ``__`` are the layout's own.
    """
    spark = df.sparkSession
    told = df.select("*", layout.leaf().alias("__leaf"), row_hash(_hashable(df)).alias("__hash"))
    told = told.withColumn("__page", Layout.page(F.col("__leaf")))
    # By range and hash, so that a page with a third of all rows is many tasks.
    (
        told.repartitionByRange("__page", "__leaf", "__hash").sortWithinPartitions("__page", "__leaf")
        .write.partitionBy("__page").parquet(f"{path}/rows")
    )
    written = spark.read.schema("__leaf bigint, __hash bigint, __page int").parquet(f"{path}/rows")
    low, high = F.col("__hash").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned("__hash", 32)
    leaves = written.groupBy("__page", "__leaf").agg(*_sums(low, high, F.count("*")))
    leaves.repartition("__page").write.partitionBy("__page").parquet(f"{path}/leaves")
    nodes = spark.read.schema("__leaf bigint, n bigint, low bigint, high bigint, __page int").parquet(f"{path}/leaves")
    pages = nodes.groupBy("__page").agg(*_sums(F.col("low"), F.col("high"), F.sum("n")))
    pages.coalesce(1).write.parquet(f"{path}/pages")
    df.limit(0).write.parquet(f"{path}/columns")


def _unequal(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """Nodes of either side that the other lacks or tells otherwise."""
    node = F.struct(*_NODE)
    a, b = old.select(*by, node.alias("a")), new.select(*by, node.alias("b"))
    return a.join(b, by, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(*by)


def changed_pages(spark: SparkSession, old: str, new: str) -> DataFrame:
    """Pages whose nodes differ; ``PAGES`` rows at most."""
    return _unequal(spark.read.parquet(f"{old}/pages"), spark.read.parquet(f"{new}/pages"), ["__page"])


def changed_ranges(spark: SparkSession, old: str, new: str) -> DataFrame:
    """(page, range) of the ranges that differ; only pages that differ are opened."""
    pages = F.broadcast(changed_pages(spark, old, new))
    sides = [spark.read.schema("__leaf bigint, n bigint, low bigint, high bigint, __page int").parquet(f"{p}/leaves")
             .join(pages, "__page", "left_semi") for p in (old, new)]
    return _unequal(*sides, ["__page", "__leaf"])


def rows_of_changed_ranges(spark: SparkSession, old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """The rows of both snapshots that lie in ranges that differ.

    Pages are partitions of the files and a broadcast of at most ``PAGES`` rows prunes them;
    the ranges, whose number grows with the changes, are joined as adaptive execution sees fit.
    """
    pages, ranges = F.broadcast(changed_pages(spark, old, new)), changed_ranges(spark, old, new)
    out = []
    for path in (old, new):
        columns = spark.read.parquet(f"{path}/columns").schema
        stored = StructType(columns.fields).add("__leaf", LongType()).add("__page", IntegerType())
        rows = spark.read.schema(stored).parquet(f"{path}/rows").join(pages, "__page", "left_semi")
        out.append(rows.join(ranges, ["__page", "__leaf"], "left_semi").select(*[f"`{c}`" for c in columns.names]))
    return out[0], out[1]


def stored_diff(spark: SparkSession, old: str, new: str, layout: Layout) -> DataFrame:
    """``joins.snapshot_diff`` of two stored snapshots of the same layout."""
    a, b = rows_of_changed_ranges(spark, old, new)
    return snapshot_diff(a, b, list(layout.keys))
