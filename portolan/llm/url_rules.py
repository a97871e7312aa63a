"""URL filters by a sort-merge range join.

A host is written label by label from the right, each label closed by a dot: ``www.a.org``
becomes ``org.a.www.``.  A host and all its subdomains then fill one interval of the sorted
keys, from ``org.a.`` up to but without ``org.a/`` (the slash follows the dot).  Intervals of
two rules are nested or apart.  URLs and interval starts are sorted together, and one sweep
keeps the rules whose interval is open on a stack; a URL is decided by the longest rule on the
stack whose path its own path starts with.

The sorted keys are cut into ranges at bounds taken from a sample of ``n_sample`` keys; the
sample only sets how even the ranges are.  URL keys end with path and row id, so one hot host,
or one URL that a third of the rows share, spans as many ranges as it needs.  A rule goes to
every range that its interval touches, since it is open there when the sweep begins.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.operators.reports import sample_rows

RULES = "host string, path string, verdict string"
RESULT = "id long, host string, path string, rule string, verdict string"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), upper, lower)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def reversed_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def rule_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules from ``(verdict, "host/path")`` pairs; the path begins at the first slash."""
    rows = []
    for verdict, text in rules:
        host, slash, path = text.partition("/")
        rows.append((host, slash + path, verdict))
    return spark.createDataFrame(rows, RULES)


def _ranged(bounds: list[bytes], kind: str):
    """Adds the number of the range that a key falls in, or of each range that a rule touches."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k.encode() for k in batch.column("key").to_pylist()]
            rows, places = [], []
            for i, key in enumerate(keys):
                first = bisect_right(bounds, key)
                last = first if kind == "url" else bisect_left(bounds, key[:-1] + b"/") if key else len(bounds)
                rows.extend([i] * (last - first + 1))
                places.extend(range(first, last + 1))
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), *taken.columns],
                                             names=["part", *taken.schema.names])

    return deal


def _swept(default: str):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, stack = row["part"], []
                key = row["key"].encode()
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if row["is_url"]:
                    fits = [(len(text), text, verdict) for _, path, text, verdict in stack
                            if row["path"].startswith(path)]
                    best = max(fits, default=(0, None, default))
                    out.append((row["id"], row["host"], row["path"], best[1], best[2]))
                else:
                    stack.append((key, row["path"], row["host"] + row["path"], row["verdict"]))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])],
                names=["id", "host", "path", "rule", "verdict"])

    return sweep


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow", n_sample: int = 20_000) -> DataFrame:
    """The rule and verdict of each URL: ``id, host, path, rule, verdict``, one row per input row.

    A rule fits its host and all subdomains if the path starts with the rule's path; the
    longest rule text wins, then the greater text, then the greater verdict.  A URL without a
    fitting rule gets a null rule and ``default``.  A null URL, or one without ``://``, has an
    empty host and path, which only a rule with both empty would fit.  Rules with a null host
    or path are left out; equal rules count once.  Null ids and repeated rows are kept as they
    are.  Further columns of ``pages`` are left out, whatever their names.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col(f"`{url_col}`"))
    urls = (pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), host.alias("host"), path.alias("path"))
            .withColumn("key", F.concat(reversed_key(F.col("host")), F.lit("\0"), "path", F.lit("\0"),
                                        F.coalesce(F.col("id").cast("string"), F.lit(""))))
            .select("id", "host", "path", "key"))
    ruled = (rules.select("host", "path", "verdict").dropna(subset=["host", "path"]).distinct()
             .select("host", "path", "verdict", reversed_key(F.col("host")).alias("key")))
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sample = sample_rows(urls.select("key"), "key", n_sample, 1).collect()  # at most n_sample keys
    sample = sorted(r[0].encode() for r in sample)
    bounds = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []
    spread = urls.mapInArrow(_ranged(bounds, "url"), "part long, id long, host string, path string, key string")
    opened = ruled.mapInArrow(_ranged(bounds, "rule"),
                              "part long, host string, path string, verdict string, key string")
    columns = ["part", "key", "is_url", "id", "host", "path", "verdict"]
    together = spread.select(
        "part", "key", F.lit(True).alias("is_url"), "id", "host", "path", F.lit(None).cast("string").alias("verdict"),
    ).union(opened.select(
        "part", "key", F.lit(False).alias("is_url"), F.lit(None).cast("long").alias("id"), "host", "path", "verdict"))
    return (together.select(*columns).repartition(parts, "part")
            .sortWithinPartitions("part", "key", "is_url").mapInArrow(_swept(default), RESULT))
