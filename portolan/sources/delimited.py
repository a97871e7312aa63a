"""Delimited files: typed rows and rejects, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portolan.functions.columns import NULL_TOKENS, null_if_token, try_typed
from portolan.schemas import as_struct, as_text
from portolan.sources import spanning
from portolan.sources.spanning import ANY_AGE

#: Holds the text of a row whose number of values is not that of the schema.
_MISFIT = "__misfit_row"


def read_text_columns(
    spark: SparkSession, path: str, schema: StructType, multiline: bool = True, **options: str,
) -> DataFrame:
    """All columns as text plus ``source_file``, and the text of rows of another width.

    Columns go by position: a short row gives NULLs, surplus values are dropped.  Values may
    hold line breaks inside quotes, and files split all the same; ``multiline=False`` leaves out
    the search for such rows in files that the caller knows to have none.
    """
    if multiline:
        machine = spanning.quoted_lines()
        return text_columns(spanning.records(spanning.units(spark.read, path, machine), machine), schema, **options)
    return (
        spark.read.schema(as_text(schema).add(_MISFIT, "string"))
        .option("columnNameOfCorruptRecord", _MISFIT)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .options(**options)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )


def text_columns(records: DataFrame, schema: StructType, **options: str) -> DataFrame:
    """The same columns out of the records of whole files, whose first one is the header."""
    text = F.rtrim(F.replace("text", F.lit("\r\n"), F.lit("\n")), F.lit("\r"))
    kinds = as_text(schema).add(_MISFIT, "string")
    given = {"columnNameOfCorruptRecord": _MISFIT, "quote": '"', "escape": '"', "multiLine": "true"}
    # an array of one keeps Catalyst from copying the parse into every filter
    parsed = F.explode(F.array(F.from_csv(text, kinds.toDDL(), given | options)))
    return records.where((F.col("number") > 0) & (text != "")).select("source_file", parsed.alias("__row")).select(
        "__row.*", "source_file")


def _cleaned(name: str, null_tokens: tuple[str, ...]) -> Column:
    return null_if_token(F.col(name), null_tokens)


def typed_rows(
    raw: DataFrame, schema: StructType, null_tokens: tuple[str, ...] = NULL_TOKENS, strict: bool = False
) -> DataFrame:
    """Every raw row with its typed columns and ``bad_columns``, the names that do not fit.

    ``misfit`` tells rows with too few or too many values, and ``raw_row`` keeps their text;
    ``strict`` makes them bad rows, with ``(width)`` among the bad columns.
    """
    typed, bad = {}, []
    for field in schema:
        text = _cleaned(field.name, null_tokens)
        value = try_typed(text, field.dataType.simpleString())
        typed[field.name] = value
        if field.dataType.simpleString() != "string":
            bad.append(F.when(text.isNotNull() & value.isNull(), F.lit(field.name)))
    misfit = F.col(_MISFIT).isNotNull()
    if strict:
        bad.append(F.when(misfit, F.lit("(width)")))
    row = F.to_json(F.struct(*[F.col(f.name) for f in schema]))
    return raw.withColumns(
        {"bad_columns": F.array_compact(F.array(*bad)), "misfit": misfit,
         "raw_row": F.when(misfit, F.col(_MISFIT)).otherwise(row)}
    ).select(
        *[typed[f.name].alias(f.name) for f in schema],
        "source_file",
        "misfit",
        "bad_columns",
        F.when((F.size("bad_columns") > 0) | F.col("misfit"), F.col("raw_row")).alias("raw_row"),
    )


def good_rows(rows: DataFrame) -> DataFrame:
    """Rows in which every value fits, with the load time as column default."""
    return (
        rows.where(F.size("bad_columns") == 0)
        .drop("bad_columns", "raw_row", "misfit")
        .withColumn("loaded_at", F.current_timestamp())
    )


def rejected_rows(rows: DataFrame) -> DataFrame:
    """The other rows: file, offending columns, and the row as it was read."""
    return rows.where(F.size("bad_columns") > 0).select("source_file", "bad_columns", "raw_row")


def width_report(rows: DataFrame) -> DataFrame:
    """Per file: rows, how many of them have too few or too many values, and one of these."""
    return rows.groupBy("source_file").agg(
        F.count("*").alias("row_count"), F.count_if("misfit").alias("misfit_rows"),
        F.min(F.when(F.col("misfit"), F.col("raw_row"))).alias("example"),
    )


def load_csv(
    spark: SparkSession, path: str, schema_ddl: str, null_tokens: tuple[str, ...] = NULL_TOKENS,
    strict: bool = False, **options,
) -> tuple[DataFrame, DataFrame]:
    """Load delimited files; a bad row is set aside and the rest is kept.

    Returns (good, rejects); together they hold every line read.  With ``strict`` a row of
    another width is bad too.
    """
    schema = as_struct(schema_ddl)
    rows = typed_rows(read_text_columns(spark, path, schema, **options), schema, null_tokens, strict)
    return good_rows(rows), rejected_rows(rows)
