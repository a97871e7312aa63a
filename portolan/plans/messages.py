"""Queries over XML messages rendered from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from portolan import bridge
from portolan.operators import messages
from portolan.operators.triage import remittance_risk
from portolan.plans import sql as q
from portolan.plans.notes import RISK_SQL
from portolan.plans.registry import query
from portolan.schemas import AMOUNTS
from portolan.session import scratch_dir
from portolan.sources import xml_files

_TRANSFER_SQL = f"""transaction_id AS msg_id, 'E2E-' || customer_id || '-' || i AS end_to_end_id,
    {q.dbl('tx_amount')} AS settlement_amount, currency_code AS currency, 'Debtor ' || customer_id AS debtor_name,
    'Creditor ' || counterparty_country AS creditor_name"""


def _transfers(spark, sf_dir):
    return messages.parse(bridge.credit_transfer_xml(bridge.trades(spark, sf_dir)))


def _statements(spark, sf_dir):
    return messages.parse(bridge.statement_xml(spark, sf_dir))


@query("I4 I2", q.query(
    f"""SELECT transaction_id AS msg_id, {q.stamp('created_at')} AS created_at, customer_id % 3 + 1 AS num_transactions
        FROM trades""", "trades"))
def transfer_headers(spark, sf_dir):
    return messages.transfer_headers(_transfers(spark, sf_dir))


@query("I5 I2 I3 I10", q.query(
    f"""SELECT {_TRANSFER_SQL}, remittance AS remittance_info,
        upper(booking_branch) || 'XX' AS instructing_agent_bic FROM transfers""", "transfers"))
def transfer_details(spark, sf_dir):
    return messages.transfers(_transfers(spark, sf_dir))


@query("D14", q.query(
    f"""SELECT currency_code AS currency, count(*) AS msg_count, {q.dbl('sum(tx_amount)')} AS total_amount,
        round(avg(tx_amount), 6) AS avg_amount FROM transfers GROUP BY currency_code""", "transfers"))
def transfer_currency_totals(spark, sf_dir):
    return messages.currency_totals(messages.transfers(_transfers(spark, sf_dir))).orderBy(F.desc("total_amount"))


@query("B9", q.query(
    f"""SELECT {_TRANSFER_SQL}, 'LARGE_VALUE_ALERT' AS flag FROM transfers WHERE tx_amount >= 400000""", "transfers"))
def large_value_alerts(spark, sf_dir):
    found = messages.large_value_alerts(messages.transfers(_transfers(spark, sf_dir)), at_least=400_000)
    return found.drop("remittance_info", "instructing_agent_bic").orderBy(F.desc("settlement_amount"))


@query("I6 C6", q.query(
    f"""SELECT account_iban, 'JPY' AS account_currency, CAST(statement_index AS INTEGER) AS statement_index,
        CAST(n - 1 AS INTEGER) AS entry_index,
        {q.dbl('entry_amount')} AS entry_amount, entry_currency, debit_credit,
        {q.day('booking_date')} AS booking_date, 'Entry ' || n || ' of the day closing' AS remittance_info FROM entries""", "entries"))
def statement_entries(spark, sf_dir):
    return messages.statement_entries(_statements(spark, sf_dir))


@query("D15", q.query(
    f"""SELECT account_iban, debit_credit, count(*) AS entry_count, {q.dbl('sum(entry_amount)')} AS total_amount
        FROM entries GROUP BY account_iban, debit_credit""", "entries"))
def account_totals(spark, sf_dir):
    entries = messages.statement_entries(_statements(spark, sf_dir))
    return messages.account_totals(entries).orderBy("account_iban", "debit_credit")


@query("D15", q.query(
    f"""SELECT account_iban, debit_credit, entry_currency, count(*) AS entry_count,
        {q.dbl('sum(entry_amount)')} AS total_amount
        FROM entries GROUP BY account_iban, debit_credit, entry_currency""", "entries"))
def account_totals_per_currency(spark, sf_dir):
    return messages.account_totals(messages.statement_entries(_statements(spark, sf_dir)), per_currency=True)


@query("I7 I10", q.query(
    f"""SELECT {q.dbl('e.entry_amount')} AS entry_amount, e.entry_currency
        FROM statements o LEFT JOIN entries e
        ON o.o_orderkey = e.o_orderkey AND o.statement_index = e.statement_index AND e.n = 2""", "statements", "entries"))
def second_statement_entry(spark, sf_dir):
    return messages.nth_entry(_statements(spark, sf_dir), 1)


@query("M8", q.query(
    f"""SELECT transaction_id AS msg_id, n.remittance_info, risk_level, reason
        FROM (SELECT transaction_id, remittance AS remittance_info, CASE WHEN instrument_type <> 'LC' THEN free_text_notes END
              AS note FROM transfers) n
        LEFT JOIN ({RISK_SQL}) r USING (note)""", "trades", "transfers"))
def remittance_red_flags(spark, sf_dir):
    rows = messages.transfers(_transfers(spark, sf_dir))
    return remittance_risk(rows, "remittance_info").select("msg_id", "remittance_info", "risk_level", "reason")


@query("A3 A4", q.query(
    f"""SELECT 'pacs.008' AS message_type, count(*) AS message_count, count(*) AS distinct_ids,
        {q.dbl('(SELECT sum(tx_amount) FROM transfers)')} AS total_amount FROM trades
        UNION ALL
        SELECT 'camt.053', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), {q.dbl('sum(entry_amount)')}
        FROM entries
        UNION ALL SELECT 'unknown', count(*), count(*), {q.dbl('(SELECT sum(tx_amount) FROM transfers)')}
        FROM trades""", "trades", "transfers", "entries"))
def xml_files_loaded(spark, sf_dir):
    """Write message files below three folders, load them all, and total them by type."""
    landing = scratch_dir(spark, "xml")
    transfers = bridge.credit_transfer_xml(bridge.trades(spark, sf_dir, dealt=True))
    transfers.write.text(f"{landing}/PACS_008")
    bridge.statement_xml(spark, sf_dir, dealt=True).write.text(f"{landing}/camt_053")
    transfers.write.text(f"{landing}/other")

    parsed = messages.parse(xml_files.load_xml_messages(spark, landing), schema=AMOUNTS)
    amounts = F.coalesce(
        F.col("doc.FIToFICstmrCdtTrf.CdtTrfTxInf.IntrBkSttlmAmt._VALUE"),
        F.flatten(F.filter("doc.BkToCstmrStmt.Stmt.Ntry", lambda n: n.isNotNull()))["Amt"]["_VALUE"],
    )
    total = F.aggregate(
        amounts, F.lit(0).cast("decimal(28,2)"),
        lambda acc, x: (acc + x.cast("decimal(18,2)")).cast("decimal(28,2)"),
    )
    return parsed.select("message_type", "message_id", total.alias("amount")).groupBy("message_type").agg(
        F.count("*").alias("message_count"),
        F.count_distinct("message_id").alias("distinct_ids"),
        F.sum("amount").alias("total_amount"),
    )
