"""Domain tables derived from the given tables.

Every domain table is a row-wise projection of one given table, so reading it needs no
shuffle, and column pruning and filters still reach the parquet scan.  Categories are
picked by key arithmetic with a different divisor per column, so they do not move
together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.functions import values as v
from portolan.functions.columns import pad_key, pick


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_key(key: str, divisor: int, choices: list) -> Column:
    return pick(choices, F.expr(f"({key} div {divisor}) % {len(choices)}"))


def _orders(spark: SparkSession, sf_dir: str, dealt: bool) -> DataFrame:
    """The orders; ``dealt`` over all tasks, whatever the row groups of their files."""
    orders = table(spark, sf_dir, "orders")
    return orders.hint("rebalance") if dealt else orders


def trades(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """``trade_transactions``: one row per order."""
    key = "o_orderkey"
    day = F.col("o_orderdate").cast("date")
    return _orders(spark, sf_dir, dealt).select(
        F.concat(
            F.lit("TX-"), F.replace(day.cast("string"), F.lit("-"), F.lit("")), F.lit("-"), pad_key(F.col(key), 7)
        ).alias("transaction_id"),
        day.alias("trade_date"),
        F.date_add(day, (2 + F.col(key) % 29).cast("int")).alias("settlement_date"),
        F.col("o_custkey").alias("customer_id"),
        _by_key(key, 7, [c[0] for c in v.COUNTRIES]).alias("counterparty_country"),
        _by_key(key, 17, v.TRANSACTION_TYPES).alias("transaction_type"),
        _by_key(key, 5, v.TRADE_CURRENCIES).alias("currency_code"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        _by_key(key, 3, v.BRANCHES).alias("booking_branch"),
        _by_key(key, 11, v.INSTRUMENTS).alias("instrument_type"),
        _by_key(key, 13, v.NOTES).alias("free_text_notes"),
        (F.col("o_orderdate") + F.make_interval(secs=F.col(key) % 86400)).alias("created_at"),
    )


_JAPAN = [c[0] for c in v.COUNTRIES].index("JP")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customers``: one row per customer; names of customers in Japan are Japanese."""
    key = F.col("c_custkey")
    japanese = F.concat(
        _by_key("c_custkey", 1, v.FAMILY_NAMES_JA), F.lit(" "), _by_key("c_custkey", 9, v.GIVEN_NAMES_JA)
    )
    english = F.concat(
        _by_key("c_custkey", 1, v.GIVEN_NAMES_EN), F.lit(" "), _by_key("c_custkey", 11, v.FAMILY_NAMES_EN)
    )
    return table(spark, sf_dir, "customer").select(
        key.alias("customer_id"),
        F.when(F.col("c_nationkey") % len(v.COUNTRIES) == _JAPAN, japanese).otherwise(english).alias("customer_name"),
        F.concat(F.lit("contact"), key.cast("string"), F.lit("@example.com")).alias("contact_email"),
        F.concat(
            F.lit("+81-3-"), (1000 + key % 9000).cast("string"), F.lit("-"),
            (1000 + key * 7 % 9000).cast("string"),
        ).alias("contact_phone"),
        _by_key("c_nationkey", 1, [c[0] for c in v.COUNTRIES]).alias("country_code"),
        _by_key("c_nationkey", 1, v.CUSTOMER_REGIONS).alias("region"),
        _by_key("c_custkey", 3, v.SEGMENTS).alias("customer_segment"),
        F.date_sub(F.lit("2001-12-31").cast("date"), (key * 13 % 3650).cast("int")).alias("onboarded_date"),
        F.when(F.col("c_acctbal") < 0, "HIGH").when(F.col("c_acctbal") < 5000, "MEDIUM")
        .otherwise("LOW").alias("risk_rating"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``corporate_sales``: one row per order line; a deal id may come more than once."""
    order = F.col("l_orderkey")
    day = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(
            F.lit("DEAL-"), pad_key(order, 7), F.lit("-"), F.col("l_linenumber").cast("string")
        ).alias("deal_id"),
        F.concat(F.lit("rep."), pad_key(F.col("l_suppkey"), 4)).alias("sales_rep"),
        F.concat(F.lit("Company "), pad_key(F.col("l_partkey"), 6)).alias("customer_name"),
        _by_key("l_partkey", 1, v.INDUSTRIES).alias("industry"),
        _by_key("l_partkey", 6, v.SIZE_SLOTS).alias("company_size"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("opportunity_amount"),
        pick(v.STAGE_SLOTS, (order + F.col("l_linenumber") * 7) % 20).alias("stage"),
        _by_key("(l_orderkey + l_suppkey)", 1, v.SALES_REGION_SLOTS).alias("region"),
        day.alias("last_visit_date"),
        F.date_add(day, (order % 365).cast("int")).alias("expected_close_date"),
        (F.col("l_shipdate") + F.make_interval(secs=order % 86400)).alias("loaded_at"),
        F.concat(F.lit("batch_"), (order % 8).cast("string"), F.lit(".csv")).alias("source_file"),
    )


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access history: one row per event, with the array of objects it touched."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    touched = F.struct(
        F.concat(F.lit("RAW."), F.when(k % 3 == 0, "CUSTOMERS").when(k % 3 == 1, "TRADES").otherwise("SALES"))
        .alias("object_name"),
        F.when(k % 2 == 0, F.array(F.lit("ID"), F.lit("AMOUNT"))).otherwise(F.array(F.lit("ID")))
        .alias("columns"),
    )
    joined = F.struct(
        F.lit("HARMONIZED.Customers_View").alias("object_name"), F.array(F.lit("NAME")).alias("columns")
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("query_id"),
        F.col("ts").alias("query_start_time"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_name"),
        F.when(k >= 90, F.array().cast("array<struct<object_name:string,columns:array<string>>>"))
        .when(k >= 60, F.array(touched, joined)).otherwise(F.array(touched)).alias("base_objects_accessed"),
    )


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query history: one row per event."""
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("query_id"),
        F.concat(F.lit("SELECT * FROM "), F.upper("event_type"), F.repeat(F.lit(" WHERE user_id = "), 8), user)
        .alias("query_text"),
        F.concat(F.lit("user-"), user).alias("user_name"),
        pick(["ANALYST", "DATA_ENGINEER", "ADMIN"], F.col("user_id") % 3).alias("role_name"),
        F.when(F.col("event_type") == "error", "FAIL").otherwise("SUCCESS").alias("execution_status"),
        F.when(F.col("user_id") % 2 == 0, "TRADE_DB").otherwise("OTHER_DB").alias("database_name"),
        F.col("ts").alias("start_time"),
        F.round(F.col("value") * 10, 0).cast("bigint").alias("total_elapsed_time"),
    )


def refresh_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of scheduled loads: one row per event, the event type names the job."""
    millis = F.round(F.col("value") * 1000, 0).cast("bigint")
    failed = F.col("value") > 100
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("refresh_"), F.col("event_type")).alias("name"),
        F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("scheduled_time"),
        (F.col("ts") + F.make_interval(secs=F.floor(millis / 1000))).alias("completed_time"),
        F.when(failed, F.concat(F.lit("timeout after "), F.floor(F.col("value")).cast("string"), F.lit("s")))
        .alias("error_message"),
    )


def account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of user accounts: signup inserts, error deletes, the rest update."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("account_id"),
        F.col("ts").alias("changed_at"),
        F.col("event_id").alias("change_seq"),
        F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE")
        .otherwise("UPDATE").alias("op"),
        F.col("event_type").alias("status"),
        F.col("value").cast("decimal(18,2)").alias("balance"),
    )


def entitlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User -> sales rep mapping: one row per customer account that may see a rep's deals."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("USER_"), F.col("s_nationkey").cast("string")).alias("user_name"),
        F.concat(F.lit("rep."), pad_key(F.col("s_suppkey"), 4)).alias("sales_rep"),
    )


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def credit_transfer_xml(trades: DataFrame) -> DataFrame:
    """Render each trade as one credit-transfer message (ISO 20022 pacs.008 shape).

    A message has one to three transactions, by the customer; each holds the trade's amount
    plus its number from 0, and the later ones a second line of remittance information.
    """

    letter_of_credit = F.col("instrument_type") == "LC"
    # What all transactions of a message share is put together once; a lambda over their numbers is not compiled.
    parts = trades.select(
        "transaction_id", "created_at", "amount", letter_of_credit.alias("letter_of_credit"),
        (F.col("customer_id") % 3 + 1).cast("int").alias("count"),
        F.concat(F.lit("<CdtTrfTxInf><PmtId><EndToEndId>E2E-"), F.col("customer_id").cast("string"), F.lit("-"))
        .alias("id_part"),
        F.concat(F.lit('</EndToEndId></PmtId><IntrBkSttlmAmt Ccy="'), F.col("currency_code"), F.lit('">'))
        .alias("currency_part"),
        F.concat(
            F.lit("</IntrBkSttlmAmt><InstgAgt><FinInstnId><BICFI>"),
            F.upper("booking_branch"), F.lit("XX</BICFI></FinInstnId></InstgAgt><Dbtr><Nm>Debtor "),
            F.col("customer_id").cast("string"), F.lit("</Nm></Dbtr><Cdtr><Nm>Creditor "),
            F.col("counterparty_country"), F.lit("</Nm></Cdtr>"),
            # A message without remittance information has no RmtInf element at all.
            F.when(letter_of_credit, F.lit("")).otherwise(
                F.concat(F.lit("<RmtInf><Ustrd>"), _escaped(F.col("free_text_notes")), F.lit("</Ustrd>"))),
        ).alias("party_part"),
    )

    def transaction(n: int) -> Column:
        rest = f"<Ustrd>part {n}</Ustrd></RmtInf></CdtTrfTxInf>" if n > 0 else "</RmtInf></CdtTrfTxInf>"
        return F.concat(
            "id_part", F.lit(str(n)), "currency_part", (F.col("amount") + n).cast("decimal(18,2)").cast("string"),
            "party_part", F.when(F.col("letter_of_credit"), "</CdtTrfTxInf>").otherwise(rest),
        )

    count = F.col("count")
    # the numbers from 0 to count - 1, which run down where a key below 0 gives a count below 1
    transactions = [transaction(0), *(F.when(count > n, transaction(n)) for n in (1, 2)),
                    *(F.when(count <= n + 1, transaction(n)) for n in (-1, -2))]
    return parts.select(
        F.concat(
            F.lit('<?xml version="1.0" encoding="UTF-8"?>'
                  '<Document xmlns="urn:iso:std:iso:20022:tech:xsd:pacs.008.001.10"><FIToFICstmrCdtTrf><GrpHdr><MsgId>'),
            F.col("transaction_id"), F.lit("</MsgId><CreDtTm>"),
            F.replace(F.col("created_at").cast("string"), F.lit(" "), F.lit("T")),
            F.lit("</CreDtTm><NbOfTxs>"), count.cast("string"), F.lit("</NbOfTxs></GrpHdr>"),
            F.array_join(F.array(*transactions), ""),
            F.lit("</FIToFICstmrCdtTrf></Document>"),
        ).alias("payload")
    )


STATEMENT_CURRENCIES = ["EUR", "USD", "JPY"]


def statement_xml(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Render each order as one message of account statements (camt.053 shape).

    Every fifth order has a second statement, of another account, with the same entries; an
    entry has one detail with a line per entry number.
    """
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast("decimal(18,2)")

    def entry(n: int) -> Column:
        return F.concat(
            F.lit(f'<Ntry><Amt Ccy="{STATEMENT_CURRENCIES[n % 3]}">'), (amount + n).cast("decimal(18,2)").cast("string"),
            F.lit("</Amt><CdtDbtInd>"), F.when((key + n) % 2 == 0, "CRDT").otherwise("DBIT"),
            F.lit("</CdtDbtInd><BookgDt><Dt>"),
            F.date_add(F.col("o_orderdate").cast("date"), n).cast("string"),
            F.lit(f"</Dt></BookgDt><NtryDtls><TxDtls><RmtInf><Ustrd>Entry {n}"
                  "</Ustrd><Ustrd>of the day</Ustrd></RmtInf></TxDtls>"
                  "<TxDtls><RmtInf><Ustrd>closing</Ustrd></RmtInf></TxDtls></NtryDtls></Ntry>"),
        )

    count = (key % 4).cast("int")
    entries = F.array(*(F.when(count >= n, entry(n)) for n in (1, 2, 3)))

    def statement(iban: Column) -> Column:
        return F.concat(
            F.lit("<Stmt><Id>STMT"), key.cast("string"), F.lit("</Id><Acct><Id><IBAN>"), iban,
            F.lit("</IBAN></Id><Ccy>JPY</Ccy></Acct><Bal><Amt Ccy=\"JPY\">1</Amt><CdtDbtInd>CRDT</CdtDbtInd></Bal>"),
            F.array_join(entries, ""), F.lit("</Stmt>"),
        )

    account = pad_key(F.col("o_custkey"), 10)
    second = F.when(key % 5 == 0, statement(F.concat(F.lit("SG"), account))).otherwise(F.lit(""))
    return _orders(spark, sf_dir, dealt).select(
        F.concat(
            F.lit('<?xml version="1.0" encoding="UTF-8"?>'
                  '<Document xmlns="urn:iso:std:iso:20022:tech:xsd:camt.053.001.08"><BkToCstmrStmt>'),
            statement(F.concat(F.lit("JP"), account)), second, F.lit("</BkToCstmrStmt></Document>"),
        ).alias("payload")
    )
