"""Incremental file loads as Structured Streaming jobs.

The checkpoint remembers which files were read, so running a load again reads only new
files.  Each micro-batch writes a folder named after its batch id; a batch replayed
after a failure overwrites its own folder and nothing is loaded twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from portolan.functions.columns import base_name, null_if_token, try_typed
from portolan.schemas import as_struct
from portolan.sources import delimited, json_files, spanning, xml_files
from portolan.streaming import ledger


def run_available(stream: DataFrame, handle, checkpoint: str) -> int:
    """Process all data that is there, then stop; the number of micro-batches run."""
    batches = []

    def each(batch: DataFrame, batch_id: int) -> None:
        handle(batch, batch_id)
        batches.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)


def ingest_csv(
    spark: SparkSession, landing: str, schema_ddl: str, target: str, checkpoint: str, max_files: int = 1000,
    strict: bool = False,
) -> int:
    """Load new delimited files below ``landing``; good rows and rejects in one pass.

    With ``strict`` a row with too few or too many values is a reject.
    """
    schema = as_struct(schema_ddl)
    machine = spanning.quoted_lines()
    lines = spanning.units(spark.readStream, landing, machine, maxFilesPerTrigger=str(max_files))

    def write(batch: DataFrame, batch_id: int) -> None:
        raw = delimited.text_columns(spanning.records(batch, machine), schema)
        _write_rows(delimited.typed_rows(raw, schema, strict=strict), target, batch_id)

    return run_available(lines, write, checkpoint)


def ingest_json(
    spark: SparkSession, landing: str, target: str, checkpoint: str, whole_file: bool = True, max_files: int = 1000
) -> int:
    """Load new files of JSON arrays or objects below ``landing``; texts that are no JSON are rejects."""
    machine = spanning.json_elements()
    options = {"maxFilesPerTrigger": str(max_files)}
    raw = (
        spanning.units(spark.readStream, landing, machine, **options) if whole_file else
        spark.readStream.option("maxFileAge", spanning.ANY_AGE).options(**options).text(landing)
        .select(F.col("value").alias("__text"), F.col("_metadata.file_path").alias("source_file"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = (json_files.array_elements(spanning.records(batch, machine)) if whole_file
                else json_files.elements_and_rejects(batch, "__text"))
        _write_rows(rows, target, batch_id)

    return run_available(raw, write, checkpoint)


def ingest_xml(spark: SparkSession, landing: str, target: str, checkpoint: str, max_files: int = 1000) -> int:
    """Load new message files below ``landing``; text outside all documents is a reject."""
    units = xml_files.read_units(spark.readStream, landing, maxFilesPerTrigger=str(max_files))

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_rows(xml_files.rows_of(xml_files.records_of(batch), landing), target, batch_id)

    return run_available(units, write, checkpoint)


def _write_rows(rows: DataFrame, target: str, batch_id: int) -> None:
    """Good rows and rejects of a batch, told apart by ``rejected``, and the batch's part of the ledger."""
    told = rows.withColumns({
        "loaded_at": F.current_timestamp(),
        "rejected": F.when(F.size("bad_columns") > 0, 1).otherwise(0),
    })
    path = f"{target}/batch_id={batch_id}"
    told.write.mode("overwrite").partitionBy("rejected").parquet(path)
    spark = rows.sparkSession
    ledger.record(spark, target, batch_id, spark.read.schema(told.schema).parquet(path))


def ingested(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of an ingest target; ``rejected`` is a partition column."""
    rows = spark.read.parquet(target)
    good = rows.where("rejected = 0").drop("rejected", "bad_columns", "raw_row", "misfit", "batch_id")
    return good, rows.where("rejected = 1").select("source_file", "bad_columns", "raw_row")


def load_ledger(spark: SparkSession, target: str) -> DataFrame:
    """Per loaded file: rows loaded and rejected, the first error, status, time of the load.

    ``misfit_rows`` counts rows with too few or too many values; formats without a width have none.
    """
    return ledger.held(spark, target)


# --- drop folder ------------------------------------------------------------------------

_REPORT = "source_file string, status string, row_count bigint, message string"
_LISTING = "source_file string, uri string, modified bigint, size bigint"


def _folder_files(spark: SparkSession, folder: str) -> DataFrame:
    """What lies in the folder now; the listing is on the driver in any case."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(folder, "*.[cC][sS][vV]")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    rows = [
        (f.getPath().getName(), f.getPath().toUri().toString(), f.getModificationTime(), f.getLen())
        for f in found or []
    ]
    return spark.createDataFrame(rows, _LISTING)


def _move_files(spark: SparkSession, uris: list[str], folder: str) -> None:
    """Move files into a folder through the Hadoop file system API."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for uri in uris:
        source = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        fs.rename(source, jvm.org.apache.hadoop.fs.Path(target, source.getName()))


def _first_positions(named: DataFrame) -> DataFrame:
    """Where each file's rows begin; needs no cell, so none is made, and numbers combine before the shuffle."""
    return named.groupBy("path", "modified").agg(F.min("position").alias("header_position"))


def load_drop_folder(
    spark: SparkSession,
    folder: str,
    archive: str,
    target: str,
    checkpoint: str,
    schema_ddl: str,
    key_column: str,
    max_files: int = 1000,
) -> DataFrame:
    """Load the tabular files people drop into a folder; returns the report per file.

    Columns are matched by the trimmed header names of each file, whatever their order.
    A value that does not fit its column becomes NULL.  A file without data rows is an
    error entry and stays in the folder; the other files are loaded and moved to
    ``archive``.  The header of a file is its first record, which must name ``key_column``.
    Cells may hold line breaks; the number of columns is that of the widest line there.

    Files move only after their micro-batch is committed, so a batch replayed after a
    failure still finds them, and a run that died before moving is made up for by the
    next one.  A name that was loaded before is not loaded again; it is an error entry.
    """
    schema = as_struct(schema_ddl)
    # Commas inside quotes count too, so this is the width or more.
    there = spark.read.option("pathGlobFilter", "*.[cC][sS][vV]").text(folder)
    width = there.agg(F.max(F.length("value") - F.length(F.replace("value", F.lit(",")))) + 1).first()[0] or 1
    positions = StructType([StructField(f"_c{i}", StringType()) for i in range(width)])
    cells = F.array(*[F.col(f.name) for f in positions])
    lines = (
        spark.readStream.schema(positions)
        .option("header", False)
        .option("escape", '"')
        .option("multiLine", True)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFileAge", spanning.ANY_AGE)
        .option("maxFilesPerTrigger", max_files)
        .csv(folder)
        .select(
            cells.alias("cells"), F.col("_metadata.file_path").alias("path"),
            F.unix_millis("_metadata.file_modification_time").alias("modified"),
        )
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("position", F.monotonically_increasing_id())
        # One row per file of the batch, so never more than ``max_files`` rows.
        tops = _first_positions(named).persist()
        top = named.join(F.broadcast(tops.select(F.col("header_position").alias("position"))), "position", "left_semi")
        names = F.transform("cells", lambda c: F.lower(F.trim(c)))
        headers = top.select(
            "path", F.col("position").alias("header_position"),
            F.coalesce(F.array_contains(names, key_column), F.lit(False)).alias("has_header"),
            # Position 0 means the file lacks the column; get(-1) is NULL.
            *[(F.array_position(names, f.name) - 1).cast("int").alias(f"__at_{i}") for i, f in enumerate(schema)],
        ).persist()
        rows = named.join(F.broadcast(headers), "path")
        data = rows.where(F.col("has_header") & (F.col("position") != F.col("header_position")))
        columns = [
            try_typed(null_if_token(F.trim(F.get("cells", F.col(f"__at_{i}")))), field.dataType.simpleString()).alias(field.name)
            for i, field in enumerate(schema)
        ]
        path = f"{target}/rows/batch_id={batch_id}"
        written = data.select(
            *columns, F.current_timestamp().alias("loaded_at"), base_name(F.col("path")).alias("source_file"))
        written.write.mode("overwrite").parquet(path)
        # All rows below a header were written, so what lies there is counted and no file is parsed again.
        loaded = batch.sparkSession.read.schema(written.schema).parquet(path).groupBy("source_file").agg(
            F.count("*").alias("row_count"))
        found = tops.join(headers.select("path", "has_header"), "path").withColumn("source_file", base_name(F.col("path")))
        report = found.join(loaded, "source_file", "left").select(
            "modified",
            "source_file",
            F.when(F.col("row_count") > 0, "LOADED").otherwise("ERROR").alias("status"),
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
            F.when(~F.col("has_header"), f"no header row with {key_column}")
            .when(F.col("row_count").isNull(), "empty or header-only").alias("message"),
        )
        report.write.mode("overwrite").parquet(f"{target}/report/batch_id={batch_id}")
        tops.unpersist()
        headers.unpersist()

    run_available(lines, load, checkpoint)

    try:
        report = spark.read.schema(f"modified bigint, {_REPORT}, batch_id bigint").parquet(f"{target}/report")
    except AnalysisException:  # nothing was ever loaded
        report = spark.createDataFrame([], f"modified bigint, {_REPORT}, batch_id bigint")
    here = _folder_files(spark, folder)
    known = report.where(F.col("status") == "LOADED").select(
        "source_file", F.col("modified").alias("loaded_modified")
    )
    # The folder listing holds one row per file that is still there.
    loaded = F.broadcast(here).join(known, "source_file")
    done = loaded.where(F.col("modified") == F.col("loaded_modified")).select("uri").distinct().collect()
    again = loaded.groupBy("source_file").agg(
        F.bool_or(F.col("modified") == F.col("loaded_modified")).alias("same")
    ).where(~F.col("same"))
    # Spark's readers skip files of zero bytes, so those come from the listing.
    errors = here.where(F.col("size") == 0).select("source_file", F.lit("empty or header-only").alias("message")).unionByName(
        again.select("source_file", F.lit("a file of this name was loaded before").alias("message"))
    )
    error_rows = [
        (r.source_file, "ERROR", 0, r.message) for r in errors.collect()
    ]
    _move_files(spark, [r.uri for r in done], archive)
    return report.drop("modified", "batch_id").unionByName(spark.createDataFrame(error_rows, _REPORT))
