"""Typed rows out of ISO 20022 messages.

Each payload is parsed once into a struct of text leaves; casts happen on extraction, so
a bad amount is NULL in its own column and the rest of the message survives.  A missing
element is NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions import values as v
from portolan.schemas import PAYLOAD, as_struct

_XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreNamespace": "true"}


def parse(messages: DataFrame, payload: str = "payload", schema: str = PAYLOAD) -> DataFrame:
    """Add ``doc``, the parsed payload; both message roots are NULL in a broken document.

    The whole document is read whatever the ``schema``, but only the elements in it become
    columns, since Spark prunes no columns of parsed XML by itself.

    The one-element explode keeps the parse in one place of the plan.  As a plain
    projection Catalyst would copy it into every filter it pushes down and infers.
    """
    doc = F.from_xml(payload, as_struct(schema), _XML_OPTIONS)
    return messages.select("*", F.explode(F.array(doc)).alias("doc"))


def unreadable(parsed: DataFrame) -> DataFrame:
    """Messages whose payload is no well-formed document of a known type."""
    return parsed.where(
        F.col("doc.FIToFICstmrCdtTrf").isNull() & F.col("doc.BkToCstmrStmt").isNull()
    )


def _money(amount: Column) -> Column:
    return amount["_VALUE"].try_cast("decimal(18,2)")


def transfer_headers(parsed: DataFrame, *keep: str) -> DataFrame:
    header = F.col("doc.FIToFICstmrCdtTrf.GrpHdr")
    return parsed.where(F.col("doc.FIToFICstmrCdtTrf").isNotNull()).select(
        *keep,
        header["MsgId"].alias("msg_id"),
        header["CreDtTm"].try_cast("timestamp_ntz").alias("created_at"),
        header["NbOfTxs"].try_cast("decimal(38,0)").try_cast("bigint").alias("num_transactions"),
    )


def _joined(texts: Column) -> Column:
    """All texts of a repeated element, in order; NULL without any."""
    return F.when(F.size(texts) > 0, F.array_join(texts, " "))


def transfers(parsed: DataFrame, *keep: str, nth: int | None = None) -> DataFrame:
    """One row per transaction of each credit transfer message, or only the ``nth`` from 0.

    The remittance information joins all its lines by a blank.
    """
    all_tx = F.col("doc.FIToFICstmrCdtTrf.CdtTrfTxInf")
    rows = parsed.select(
        *keep,
        F.col("doc.FIToFICstmrCdtTrf.GrpHdr.MsgId").alias("msg_id"),
        F.explode(all_tx if nth is None else F.slice(all_tx, nth + 1, 1)).alias("tx"),
    )
    return rows.select(
        *keep,
        "msg_id",
        F.col("tx.PmtId.EndToEndId").alias("end_to_end_id"),
        _money(F.col("tx.IntrBkSttlmAmt")).alias("settlement_amount"),
        F.col("tx.IntrBkSttlmAmt._Ccy").alias("currency"),
        F.col("tx.Dbtr.Nm").alias("debtor_name"),
        F.col("tx.Cdtr.Nm").alias("creditor_name"),
        _joined(F.col("tx.RmtInf.Ustrd")).alias("remittance_info"),
        F.col("tx.InstgAgt.FinInstnId.BICFI").alias("instructing_agent_bic"),
    )


def currency_totals(transfer_rows: DataFrame) -> DataFrame:
    return transfer_rows.groupBy("currency").agg(
        F.count("*").alias("msg_count"),
        F.sum("settlement_amount").alias("total_amount"),
        F.avg("settlement_amount").alias("avg_amount"),
    )


def large_value_alerts(transfer_rows: DataFrame, at_least: int = v.LARGE_VALUE_AT_LEAST) -> DataFrame:
    """Transfers at or above a threshold, amounts compared as they stand in any currency."""
    return transfer_rows.where(F.col("settlement_amount") >= at_least).withColumn(
        "flag", F.lit(v.LARGE_VALUE_FLAG)
    )


def statement_entries(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per entry of every statement; a statement without entries gives none.

    ``statement_index`` and ``entry_index`` count from 0.  The remittance information joins
    the lines of all details of the entry by a blank.
    """
    rows = parsed.select(*keep, F.posexplode("doc.BkToCstmrStmt.Stmt").alias("statement_index", "stmt")).select(
        *keep,
        "statement_index",
        F.col("stmt.Acct.Id.IBAN").alias("account_iban"),
        F.col("stmt.Acct.Ccy").alias("account_currency"),
        F.posexplode("stmt.Ntry").alias("entry_index", "entry"),
    )
    return rows.select(
        *keep,
        "account_iban",
        "account_currency",
        "statement_index",
        "entry_index",
        _money(F.col("entry.Amt")).alias("entry_amount"),
        F.col("entry.Amt._Ccy").alias("entry_currency"),
        F.col("entry.CdtDbtInd").alias("debit_credit"),
        F.col("entry.BookgDt.Dt").try_cast("date").alias("booking_date"),
        _joined(F.flatten(F.flatten(F.transform(
            "entry.NtryDtls", lambda d: F.transform(d["TxDtls"], lambda t: F.coalesce(t["RmtInf"]["Ustrd"], F.array())))
        ))).alias("remittance_info"),
    )


def nth_entry(parsed: DataFrame, index: int, *keep: str) -> DataFrame:
    """The n-th entry of every statement by position; NULLs when it has fewer."""
    statements = parsed.select(*keep, F.explode("doc.BkToCstmrStmt.Stmt").alias("stmt"))
    return statements.select(*keep, F.get("stmt.Ntry", F.lit(index)).alias("entry")).select(
        *keep,
        _money(F.col("entry.Amt")).alias("entry_amount"),
        F.col("entry.Amt._Ccy").alias("entry_currency"),
    )


def account_totals(entries: DataFrame, per_currency: bool = False) -> DataFrame:
    """Account x debit/credit totals; mixed currencies are added unless kept apart."""
    keys = ["account_iban", "debit_credit", *(["entry_currency"] if per_currency else [])]
    return entries.groupBy(*keys).agg(
        F.count("*").alias("entry_count"), F.sum("entry_amount").alias("total_amount")
    )
