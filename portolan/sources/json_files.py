"""Schemaless JSON: one object per row, kept as variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.sources import spanning


def _items(doc: Column) -> Column:
    """The elements of a JSON array or single object; NULL if the text is neither."""
    parsed = F.try_parse_json(doc)
    single = F.when(parsed.isNotNull(), F.array(parsed))
    return F.when(F.ltrim(doc).startswith("{"), single).otherwise(F.from_json(doc, "array<variant>"))


def explode_json_array(rows: DataFrame, text: str, path: str = "$") -> DataFrame:
    """One row per element of the JSON array in a text column; other columns are kept.

    ``path`` names an array inside the document.  A single object counts as an array of
    one.  Text that is not JSON gives no row; see ``invalid_json``.  A whole-text array is
    parsed element by element, so the size limit of a variant holds for each element, not
    for the array.
    """
    keep = [c for c in rows.columns if c != text]
    doc = F.col(text) if path == "$" else F.get_json_object(text, path)
    parsed = rows.where(F.trim(text) != "").select(*keep, _items(doc).alias("__items"))
    return parsed.select(*keep, F.posexplode("__items").alias("element", "payload")).where(F.col("payload").isNotNull())


def elements_and_rejects(rows: DataFrame, text: str) -> DataFrame:
    """As ``explode_json_array`` in one pass, with the texts that are no JSON kept as rejects.

    A reject has no payload; ``bad_columns`` names it and ``raw_row`` is its text.
    """
    keep = [c for c in rows.columns if c != text]
    parsed = rows.where(F.trim(text) != "").select("*", _items(F.col(text)).alias("__items"))
    bad = F.col("__items").isNull()
    listed = parsed.select(
        *keep, F.when(bad, F.array(F.lit("payload"))).otherwise(F.array().cast("array<string>")).alias("bad_columns"),
        F.when(bad, F.col(text)).alias("raw_row"), F.posexplode_outer("__items").alias("element", "payload"),
    )
    return listed.where(F.col("payload").isNotNull() | F.col("raw_row").isNotNull())


def invalid_json(rows: DataFrame, text: str) -> DataFrame:
    return rows.where((F.trim(text) != "") & F.try_parse_json(text).isNull())


def array_elements(records: DataFrame) -> DataFrame:
    """``source_file, element, payload, bad_columns, raw_row`` of the records of whole files.

    Each element is parsed by itself, so a broken one is a reject and the others are rows.  After a
    missing bracket the rest of the file is one element.  A file that was cut off between
    elements keeps them.  A file of a single object is one element.
    """
    blank = F.lit(" \n\r\t\ufeff")
    text = F.btrim("text", blank)
    opened = (F.col("number") == 0) & text.startswith("[")
    text = F.when(opened, F.expr("substring(btrim(text, ' \n\r\t\ufeff'), 2)")).otherwise(text)
    whole = (F.col("number") == 0) & ~opened
    ended = F.col("closed") | whole | text.endswith("]")
    text = F.when(~F.col("closed") & ~whole & text.endswith("]"), F.regexp_replace(text, r"\]$", "")).otherwise(text)
    text = F.btrim(text, blank)
    told = records.select("source_file", F.col("number").alias("element"), "closed", text.alias("raw_row"),
                          F.when(ended, F.try_parse_json(text)).alias("payload"))
    nothing = (F.col("element") == 0) & ~F.col("closed") & (F.col("raw_row") == "")
    bad = F.col("payload").isNull()
    return told.where(~nothing).select(
        "source_file", "element", "payload",
        F.when(bad, F.array(F.lit("payload"))).otherwise(F.array().cast("array<string>")).alias("bad_columns"),
        F.when(bad, F.col("raw_row")).alias("raw_row"))


def read_array_elements(spark: SparkSession, path: str) -> DataFrame:
    machine = spanning.json_elements()
    return array_elements(spanning.records(spanning.units(spark.read, path, machine), machine))


def array_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Elements of whole-file arrays that are no JSON, by file and place in the array."""
    return read_array_elements(spark, path).where(F.size("bad_columns") > 0).select(
        "source_file", "element", "bad_columns", "raw_row")


def load_json_array(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Load files that hold a JSON array: outer array stripped, one object per row.

    Files split, also inside an array; what is no JSON is left to ``array_rejects``.
    ``whole_file=False`` reads one array per line.
    """
    if whole_file:
        rows = read_array_elements(spark, path).where(F.size("bad_columns") == 0).drop("bad_columns", "raw_row")
        return rows.withColumn("loaded_at", F.current_timestamp())
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return explode_json_array(text.withColumnRenamed("value", "__text"), "__text").withColumn(
        "loaded_at", F.current_timestamp()
    )


def load_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Load files with one JSON object per line, each kept as variant; files split.

    Lines that are not JSON are left out; ``invalid_json(spark.read.text(path), "value")``
    lists them.
    """
    return (
        spark.read.option("singleVariantColumn", "payload")
        .json(path)
        .select("payload", F.col("_metadata.file_path").alias("source_file"))
        .where(F.col("payload").isNotNull())
        .withColumn("loaded_at", F.current_timestamp())
    )


def variant_columns(df: DataFrame, fields: dict[str, str], payload: str = "payload") -> DataFrame:
    """Typed columns out of a variant by key; a missing key or a misfit gives NULL."""
    return df.select(
        *[F.try_variant_get(payload, f"$.{name}", kind).alias(name) for name, kind in fields.items()],
        *[c for c in df.columns if c != payload],
    )
