"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

Every document of a source expects ``target / source size`` copies.  The expected copies are
summed up along the documents of a source, one offset per source is added, and a document is
emitted once for each whole number that its stretch of the sum crosses.  Documents are lined up
by size, the longest first: neighbours are alike, so the words taken stay close to the target.
The offset is the one of ``draws`` random numbers whose words come closest to the target; this
matters where a source has few documents of very unequal size.

The running sum needs a document's position within its source.  One source may hold a third of
all rows, so no window spans a source: rows are sorted by range over all executors, counted
per range and source, and a window over these few counts gives each range its start.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.scratch import kept

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Mix:
    """``weights`` go to the sources in code-point order, null last, and repeat."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: float = 3.0
    seed: str = "mix"
    draws: int = 16


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, target``: one row per source.

    Targets share the sum of all sizes by weight; none exceeds ``most`` times its source's
    size, and what that leaves over goes to the others by weight.  This settles at one level:
    with the sources in the order of ``most * size / weight``, the first are held at their
    limit and the rest get ``level * weight``.  Windows here span one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(w) for w in mix.weights])
    per = per.withColumn("rank", F.row_number().over(listed)).withColumn(
        "weight", F.element_at(choices, ((F.col("rank") - 1) % len(mix.weights) + 1).cast("int")))
    per = per.withColumn("limit", F.lit(mix.most) * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    upto = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(upto), F.lit(0.0)))
             / F.sum("weight").over(after))
    per = per.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") < F.col("limit"))
    # the level of the first source that stays below its limit holds for all after it
    settled = F.min(F.when(F.col("free"), F.struct((F.col("limit") / F.col("weight")).alias("a"), "rank", "level")))
    per = per.withColumn("settled", settled.over(Window.partitionBy())["level"])
    return per.select("source", "source_size", F.coalesce(
        F.least(F.col("limit"), F.col("settled") * F.col("weight")), F.col("limit")).alias("target"))


def offset(source: Column, seed: str, draw: int) -> Column:
    """A number in [0, 1) that depends on seed, draw and source alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}{draw}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mixed(documents: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` per input row.

    ``size`` counts words (0 for null and empty texts), ``copies`` is how often the mix takes
    the document, at most ``most`` rounded up, and ``taken`` is ``copies * size``.  A null
    source is a source of its own, listed last.  If no text has a word, all targets are 0 and
    nothing is taken.  Ties in size are ordered by id; rows that agree in source, size and id
    are interchangeable.  Repeated rows are rows of their own, an empty table gives an empty
    result, and further columns are left out.  The result depends on the rows alone.
    """
    sized = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                             word_count(F.col(f"`{text_col}`")).alias("size"))
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id")]
    sized = kept(sized, "sizes")  # else sampling the range bounds would read the texts again
    ranged = kept(sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sized")
    goal = targets(ranged, mix)
    counts = ranged.groupBy("part", "source").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "source", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part", "source").orderBy(F.col("size").desc(), "doc_id")
    known = starts.join(goal, starts["source"].eqNullSafe(goal["source"])).select(
        F.col("part").alias("p"), starts["source"].alias("s"), "start", "source_size", "target")
    placed = kept(ranged.withColumn("place", F.row_number().over(within)).join(
        known, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("start") + F.col("place")).alias("rank")), "placed")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))

    def copies(shift: Column) -> Column:
        return F.floor(expected * F.col("rank") + shift) - F.floor(expected * (F.col("rank") - 1) + shift)

    tried = placed.groupBy("source", "target").agg(*[
        F.sum(copies(offset(F.col("source"), mix.seed, i)) * F.col("size")).alias(f"t{i}") for i in range(mix.draws)])
    best = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"t{i}") - F.col("target")).alias("miss"),
                 offset(F.col("source"), mix.seed, i).alias("offset")) for i in range(mix.draws)]))
    chosen = kept(tried.select(F.col("source").alias("s"), best["offset"].alias("offset")), "offsets")
    rows = placed.join(chosen, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", copies(F.col("offset")))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))


def repeated(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixed corpus: every row of ``documents`` as often as the mix takes it.

    Rows that agree in id (null included), source and size share their copies evenly; the
    copies left over by that go to rows chosen by a hash of their position in the input.
    """
    keyed = documents.select(
        "*", word_count(F.col("text")).alias("__rows_size"),
        (F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)) / float(1 << 20)).alias("__chance"))
    drawn = mixed(documents, mix).groupBy(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size")).agg(
        F.sum("copies").alias("__copies"), F.count("*").alias("__n")).filter("__copies > 0")
    drawn = kept(drawn, "draws")
    same = (F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
            & (F.col("__rows_size") == F.col("__size")))
    share = F.col("__copies") / F.col("__n")
    often = (F.floor(share) + F.when(F.col("__chance") < share - F.floor(share), 1).otherwise(0)).cast("int")
    rows = keyed.join(drawn, same).withColumn("__often", often).filter("__often > 0")
    return rows.select(*[F.col(f"`{c}`") for c in documents.columns],
                       F.explode(F.array_repeat(F.lit(1), F.col("__often"))).alias("__copy")).drop("__copy")
