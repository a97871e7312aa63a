"""Queries that write the given tables as files and load them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from portolan import bridge, schemas
from portolan.plans import sql as q
from portolan.plans.registry import query
from portolan.session import scratch_dir
from portolan.sources import delimited, json_files
from portolan.streaming import ingest, ledger

# Damage done to the files, by value: text in a number, an impossible date, NULL tokens.
_BAD_AMOUNT = "booking_branch = 'London' AND currency_code = 'CNY'"
_BAD_DATE = "booking_branch = 'Tokyo' AND counterparty_country = 'IN'"
_NO_NOTE = "transaction_type IN ('IMPORT', 'EXPORT') AND instrument_type = 'LC'"


def _damaged_trades(spark, sf_dir):
    trades = bridge.trades(spark, sf_dir)
    names = [f.name for f in schemas.as_struct(schemas.TRADES)]
    text = trades.select(*[F.col(n).cast("string").alias(n) for n in names])
    return text.withColumns(
        {
            "amount": F.when(F.expr(_BAD_AMOUNT), "n/a").otherwise(F.col("amount")),
            "settlement_date": F.when(F.expr(_BAD_DATE), "1998-13-45").otherwise(F.col("settlement_date")),
            "free_text_notes": F.when(
                F.expr(_NO_NOTE), F.when(F.col("transaction_type") == "IMPORT", "NULL").otherwise("null")
            ).otherwise(F.concat(F.col("free_text_notes"), F.lit(', said "ok"'))),
        }
    ).select(*names)


_GOOD_SQL = f"""SELECT transaction_id, {q.day('trade_date')} AS trade_date, {q.day('settlement_date')} AS settlement_date,
    customer_id, counterparty_country, transaction_type, currency_code, {q.dbl('amount')} AS amount, booking_branch,
    instrument_type, CASE WHEN NOT ({_NO_NOTE}) THEN free_text_notes || ', said "ok"' END AS free_text_notes
    FROM trades WHERE NOT ({_BAD_AMOUNT}) AND NOT ({_BAD_DATE})"""


@query("A1 A11", q.query(f"SELECT *, true AS has_load_time FROM ({_GOOD_SQL})", "trades"))
def csv_good_rows(spark, sf_dir):
    landing = scratch_dir(spark, "csv")
    _damaged_trades(spark, sf_dir).write.option("header", True).option("escape", '"').csv(landing)
    good, _ = delimited.load_csv(spark, landing, schemas.TRADES)
    return good.withColumn("has_load_time", F.col("loaded_at").isNotNull()).drop("loaded_at", "source_file")


@query("A1", q.query(
    f"""SELECT transaction_id, CASE WHEN {_BAD_AMOUNT} THEN 'amount' ELSE 'settlement_date' END AS bad_columns
        FROM trades WHERE ({_BAD_AMOUNT}) OR ({_BAD_DATE})""", "trades"))
def csv_rejected_rows(spark, sf_dir):
    landing = scratch_dir(spark, "csv")
    _damaged_trades(spark, sf_dir).write.option("header", True).option("escape", '"').csv(landing)
    _, rejects = delimited.load_csv(spark, landing, schemas.TRADES)
    return rejects.select(
        F.get_json_object("raw_row", "$.transaction_id").alias("transaction_id"),
        F.array_join("bad_columns", ",").alias("bad_columns"),
    )


@query("A5 A6", q.query(
    f"""SELECT booking_branch, count(*) AS tx_count,
        {q.dbl('sum(CAST(amount AS DECIMAL(18,2)))')} AS total_amount FROM ({_GOOD_SQL}) GROUP BY booking_branch""", "trades"))
def continuous_csv_ingest(spark, sf_dir):
    """Files arrive in two waves; a run after each wave, and one more that finds nothing."""
    base = scratch_dir(spark, "ingest")
    landing, target, checkpoint = f"{base}/landing", f"{base}/target", f"{base}/checkpoint"
    trades = _damaged_trades(spark, sf_dir)
    early = F.col("trade_date") < "1998-01-01"
    for wave in (trades.where(early), trades.where(~early)):
        wave.write.mode("append").option("header", True).option("escape", '"').csv(landing)
        ingest.ingest_csv(spark, landing, schemas.TRADES, target, checkpoint)
    ingest.ingest_csv(spark, landing, schemas.TRADES, target, checkpoint)
    good, _ = ingest.ingested(spark, target)
    return good.groupBy("booking_branch").agg(
        F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount")
    )


@query("A5", q.query(
    f"""SELECT count(*) AS good_rows, (SELECT count(*) FROM trades WHERE ({_BAD_AMOUNT}) OR ({_BAD_DATE})) AS rejects,
        0 AS batches_of_second_run FROM ({_GOOD_SQL})""", "trades"))
def reload_finds_nothing(spark, sf_dir):
    base = scratch_dir(spark, "reload")
    landing, target, checkpoint = f"{base}/landing", f"{base}/target", f"{base}/checkpoint"
    _damaged_trades(spark, sf_dir).write.option("header", True).option("escape", '"').csv(landing)
    ingest.ingest_csv(spark, landing, schemas.TRADES, target, checkpoint)
    again = ingest.ingest_csv(spark, landing, schemas.TRADES, target, checkpoint)
    good, rejects = ingest.ingested(spark, target)
    return good.agg(F.count("*").alias("good_rows")).select(
        "good_rows",
        rejects.agg(F.count("*")).scalar().alias("rejects"),
        F.lit(again).alias("batches_of_second_run"),
    )


@query("A7 A5", q.query(
    f"""SELECT (SELECT count(*) FROM ({_GOOD_SQL})) AS rows_loaded, count(*) AS rows_rejected, true AS every_error_named,
        true AS every_file_timed FROM trades WHERE ({_BAD_AMOUNT}) OR ({_BAD_DATE})""", "trades"))
def load_ledger_totals(spark, sf_dir):
    """The ledger of a load, added up over its files."""
    base = scratch_dir(spark, "ledger")
    landing, target = f"{base}/landing", f"{base}/target"
    _damaged_trades(spark, sf_dir).write.option("header", True).option("escape", '"').csv(landing)
    ingest.ingest_csv(spark, landing, schemas.TRADES, target, f"{base}/checkpoint")
    named = (F.col("rows_rejected") > 0) == F.col("first_error").isNotNull()
    return ingest.load_ledger(spark, target).agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"),
        F.bool_and(named).alias("every_error_named"), F.bool_and(F.col("loaded_at").isNotNull()).alias("every_file_timed"),
    )


@query("A7 A5", q.query(
    f"""SELECT 10 AS files, (SELECT count(*) FROM ({_GOOD_SQL})) AS rows_loaded, count(*) AS rows_rejected,
        0 AS files_told_otherwise FROM trades WHERE ({_BAD_AMOUNT}) OR ({_BAD_DATE})""", "trades"))
def ledger_of_many_batches(spark, sf_dir):
    """A file a batch, so the ledger is a merged segment and a tail; held against a regrouping of all rows."""
    base = scratch_dir(spark, "batches")
    landing, target = f"{base}/landing", f"{base}/target"
    _damaged_trades(spark, sf_dir).repartition(10).write.option("header", True).option("escape", '"').csv(landing)
    ingest.ingest_csv(spark, landing, schemas.TRADES, target, f"{base}/checkpoint", max_files=1)
    told = ingest.load_ledger(spark, target).drop("status")
    counted = ledger.file_figures(spark.read.parquet(target)).select(*told.columns)
    return told.agg(
        F.count("*").cast("int").alias("files"), F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("rows_rejected").alias("rows_rejected"),
    ).withColumn("files_told_otherwise", told.exceptAll(counted).agg(F.count("*").cast("int")).scalar())


@query("A2 I10", q.query(
    """SELECT customer_id, customer_name, risk_rating, NULL::VARCHAR AS contact_phone, 0 AS element FROM customers
       UNION ALL SELECT customer_id, NULL, NULL, contact_phone, 1 FROM customers""", "customers"))
def json_array_elements(spark, sf_dir):
    """Lines of two-object arrays; the second object lacks most keys and has one of its own."""
    landing = scratch_dir(spark, "json")
    both = F.concat(
        F.lit("["), F.to_json(F.struct("customer_id", "customer_name", "risk_rating")), F.lit(", "),
        F.to_json(F.struct("customer_id", "contact_phone")), F.lit("]"),
    )
    bridge.customers(spark, sf_dir).select(both.alias("value")).write.text(landing)
    loaded = json_files.load_json_array(spark, landing, whole_file=False)
    fields = {"customer_id": "bigint", "customer_name": "string", "risk_rating": "string", "contact_phone": "string"}
    return json_files.variant_columns(loaded, fields).drop("source_file", "loaded_at")


@query("A2", q.query(
    """SELECT customer_id, customer_name || '], "' AS customer_name, [customer_id, 7]::VARCHAR AS pair, false AS rejected
        FROM customers WHERE customer_id % 11 <> 4
       UNION ALL SELECT NULL, NULL, NULL, true FROM customers WHERE customer_id % 11 = 4""", "customers"))
def json_array_file(spark, sf_dir):
    """Files that are one array each, over many lines; strings hold brackets and commas, some elements are broken."""
    landing = scratch_dir(spark, "json-file")
    told = F.to_json(F.struct("customer_id", F.concat("customer_name", F.lit('], "')).alias("customer_name"),
                              F.array("customer_id", F.lit(7)).alias("pair")))
    broken = F.concat(F.lit('{"customer_id": '), F.col("customer_id").cast("string"), F.lit(' "no": [1, 2]}'))
    item = F.when(F.col("customer_id") % 11 == 4, broken).otherwise(told)
    files = bridge.customers(spark, sf_dir).groupBy((F.col("customer_id") % 16).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(item), ",\n"), F.lit("]")).alias("value"))
    files.repartition(16, "file").select("value", "file").write.partitionBy("file").text(landing)
    rows = json_files.read_array_elements(spark, landing)
    fields = {"customer_id": "bigint", "customer_name": "string", "pair": "string"}
    return json_files.variant_columns(rows, fields).select(
        "customer_id", "customer_name", F.replace("pair", F.lit(","), F.lit(", ")).alias("pair"),
        (F.size("bad_columns") > 0).alias("rejected"))


@query("A2 I1", q.query(
    f"""SELECT customer_id, customer_name, contact_email, country_code, customer_segment, risk_rating,
        {q.day('onboarded_date')} AS onboarded_date FROM customers""", "customers"))
def json_path_columns(spark, sf_dir):
    landing = scratch_dir(spark, "json")
    bridge.customers(spark, sf_dir).write.json(landing)
    fields = {
        "customer_id": "bigint", "customer_name": "string", "contact_email": "string", "country_code": "string",
        "customer_segment": "string", "risk_rating": "string", "onboarded_date": "date",
    }
    return json_files.variant_columns(json_files.load_json_lines(spark, landing), fields).drop(
        "source_file", "loaded_at"
    )


@query("I1", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, NULL::VARCHAR AS missing
    FROM events""")
def event_properties(spark, sf_dir):
    events = bridge.table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("payload"))
    return json_files.variant_columns(events, {"k": "int", "missing": "string"})


@query("I8", q.query(
    f"""SELECT transaction_id, 0 AS element, booking_branch, {q.dbl('amount')} AS amount FROM trades
        UNION ALL SELECT transaction_id, 1, currency_code, NULL FROM trades""", "trades"))
def results_of_json_responses(spark, sf_dir):
    """Response texts ``{"results": [..]}``: parse, flatten, and cast where the text fits."""
    trades = bridge.trades(spark, sf_dir)
    hits = F.array(
        F.struct(F.col("booking_branch").alias("place"), F.col("amount").cast("string").alias("amount")),
        F.struct(F.col("currency_code").alias("place"), F.lit("n/a").alias("amount")),
    )
    responses = trades.select("transaction_id", F.to_json(F.struct(hits.alias("results"))).alias("response"))
    results = json_files.explode_json_array(responses, "response", "$.results")
    return results.select(
        "transaction_id", "element",
        F.try_variant_get("payload", "$.place", "string").alias("booking_branch"),
        F.try_variant_get("payload", "$.amount", "string").try_cast("decimal(18,2)").alias("amount"),
    )


@query("A1 A7", q.query(
    f"""SELECT count(*) AS row_count, count(*) FILTER (customer_id % 5 < 2) AS misfit_rows,
        count(*) FILTER (customer_id % 5 < 2) AS strict_rejects, true AS every_misfit_shown FROM trades""", "trades"))
def csv_rows_of_wrong_width(spark, sf_dir):
    """Some rows lack their last values, others have one too many; the report counts them, strict rejects them."""
    landing = scratch_dir(spark, "width")
    trades = bridge.trades(spark, sf_dir)
    names = [f.name for f in schemas.as_struct(schemas.TRADES)]
    for kind, columns in ((0, names[:-2]), (1, [*names, "booking_branch"]), (2, names)):
        wave = trades.where(F.least(F.col("customer_id") % 5, F.lit(2)) == kind)
        wave.select(*[F.col(c).alias(f"{c}_{i}") for i, c in enumerate(columns)]).write.mode(
            "append").option("header", True).option("escape", '"').csv(landing)
    schema = schemas.as_struct(schemas.TRADES)
    report = delimited.width_report(delimited.typed_rows(delimited.read_text_columns(spark, landing, schema), schema))
    _, rejects = delimited.load_csv(spark, landing, schemas.TRADES, strict=True)
    shown = (F.col("misfit_rows") > 0) == F.col("example").isNotNull()
    return report.agg(
        F.sum("row_count").alias("row_count"), F.sum("misfit_rows").alias("misfit_rows"),
        F.bool_and(shown).alias("every_misfit_shown"),
    ).withColumn("strict_rejects", rejects.agg(F.count("*")).scalar())


@query("A5 A2 A7", q.query(
    """SELECT customer_segment, count(*) AS customers, CAST(sum(1 + customer_id % 2) AS BIGINT) AS elements,
        (SELECT count(*) FROM customers WHERE customer_id % 7 = 3) AS rejects, 0 AS batches_of_last_run
        FROM customers GROUP BY customer_segment""", "customers"))
def continuous_json_ingest(spark, sf_dir):
    """Arrays of one or two objects arrive in two waves, broken lines among them; a third run finds nothing."""
    base = scratch_dir(spark, "json-ingest")
    landing, target, checkpoint = f"{base}/landing", f"{base}/target", f"{base}/checkpoint"
    one = F.to_json(F.struct("customer_id", "customer_segment"))
    lines = bridge.customers(spark, sf_dir).select("customer_id", F.explode(F.array(
        F.when(F.col("customer_id") % 2 == 0, F.concat(F.lit("["), one, F.lit("]")))
        .otherwise(F.concat(F.lit("["), one, F.lit(", "), one, F.lit("]"))),
        F.when(F.col("customer_id") % 7 == 3, F.concat(F.lit("["), one, F.lit(", {\"customer_id\": ")))
    )).alias("value")).where("value IS NOT NULL")
    for wave in (lines.where("customer_id % 3 = 0"), lines.where("customer_id % 3 <> 0")):
        wave.select("value").write.mode("append").text(landing)
        ingest.ingest_json(spark, landing, target, checkpoint, whole_file=False)
    again = ingest.ingest_json(spark, landing, target, checkpoint, whole_file=False)
    good, rejects = ingest.ingested(spark, target)
    found = json_files.variant_columns(good, {"customer_id": "bigint", "customer_segment": "string"})
    return found.groupBy("customer_segment").agg(
        F.count_distinct("customer_id").alias("customers"), F.count("*").alias("elements"),
    ).withColumns({"rejects": rejects.agg(F.count("*")).scalar(), "batches_of_last_run": F.lit(again)})


@query("A5 A3 A7", q.query(
    """SELECT 'LOADED' AS status, count(*) AS rows_loaded, count(*) AS distinct_ids, true AS every_error_named,
        0 AS batches_of_last_run FROM trades
       UNION ALL SELECT 'REJECTED', 0, 0, true, 0""", "trades"))
def continuous_xml_ingest(spark, sf_dir):
    """Message files arrive in two waves, with files that hold no message; a third run finds nothing."""
    base = scratch_dir(spark, "xml-ingest")
    landing, target, checkpoint = f"{base}/pacs_008", f"{base}/target", f"{base}/checkpoint"
    trades = bridge.trades(spark, sf_dir)
    early = F.col("trade_date") < "1998-01-01"
    for wave in (trades.where(early), trades.where(~early)):
        bridge.credit_transfer_xml(wave).write.mode("append").text(landing)
        wave.select("free_text_notes").write.mode("append").text(landing)
        ingest.ingest_xml(spark, landing, target, checkpoint)
    again = ingest.ingest_xml(spark, landing, target, checkpoint)
    good, _ = ingest.ingested(spark, target)
    ids = good.agg(F.count_distinct("message_id")).scalar()
    named = (F.col("rows_rejected") > 0) == F.col("first_error").isNotNull()
    return ingest.load_ledger(spark, target).groupBy("status").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.bool_and(named).alias("every_error_named"),
    ).select("status", "rows_loaded", F.when(F.col("status") == "LOADED", ids).otherwise(0).alias("distinct_ids"),
             "every_error_named", F.lit(again).alias("batches_of_last_run"))


_BAD_DEAL = "company_size = '大手' AND region = '海外'"


def _dropped_sales(spark, sf_dir, base):
    """Deals as files with shuffled columns and padded headers, and one file without rows."""
    names = [f.name for f in schemas.as_struct(schemas.CORPORATE_SALES)]
    text = bridge.sales(spark, sf_dir).select(*[F.col(n).cast("string").alias(n) for n in names]).withColumns(
        {
            "opportunity_amount": F.when(F.expr(_BAD_DEAL), "unknown").otherwise(F.col("opportunity_amount")),
            "expected_close_date": F.when(F.expr(_BAD_DEAL), "soon").otherwise(F.col("expected_close_date")),
        }
    )
    padded = text.select(*[F.col(n).alias(f" {n.upper()} ") for n in reversed(names)])
    folder = f"{base}/drop"
    padded.write.mode("append").option("header", True).csv(folder)
    padded.where(F.lit(False)).write.mode("append").option("header", True).csv(folder)
    return ingest.load_drop_folder(
        spark, folder, f"{base}/archive", f"{base}/target", f"{base}/checkpoint", schemas.CORPORATE_SALES, "deal_id"
    )


@query("A8", q.query(
    """SELECT 'LOADED' AS status, true AS any_files, count(*) AS row_count, NULL::VARCHAR AS message FROM sales
       UNION ALL SELECT 'ERROR', true, 0, 'empty or header-only'""", "sales"))
def drop_folder_report(spark, sf_dir):
    report = _dropped_sales(spark, sf_dir, scratch_dir(spark, "drop"))
    return report.groupBy("status", "message").agg(
        (F.count("*") > 0).alias("any_files"), F.sum("row_count").alias("row_count")
    )


@query("A8 A11", q.query(
    f"""SELECT stage, region, company_size, count(*) AS deal_count, 0::BIGINT AS without_load_time,
        count(*) FILTER (NOT ({_BAD_DEAL})) AS with_amount, count(*) FILTER (NOT ({_BAD_DEAL})) AS with_date,
        {q.dbl(f'sum(opportunity_amount) FILTER (NOT ({_BAD_DEAL}))')} AS total_amount
        FROM sales GROUP BY ALL""", "sales"))
def drop_folder_rows(spark, sf_dir):
    base = scratch_dir(spark, "drop")
    _dropped_sales(spark, sf_dir, base)
    return spark.read.parquet(f"{base}/target/rows").groupBy("stage", "region", "company_size").agg(
        F.count("*").alias("deal_count"),
        F.count_if(F.col("loaded_at").isNull()).alias("without_load_time"),
        F.count("opportunity_amount").alias("with_amount"),
        F.count("expected_close_date").alias("with_date"),
        F.sum("opportunity_amount").alias("total_amount"),
    )
