"""Explicit schemas of the domain tables (DDL text, parsed by Spark)."""

from pyspark.sql.types import StringType, StructField, StructType

TRADES = """
    transaction_id string, trade_date date, settlement_date date, customer_id bigint,
    counterparty_country string, transaction_type string, currency_code string,
    amount decimal(18,2), booking_branch string, instrument_type string,
    free_text_notes string
"""

CORPORATE_SALES = """
    deal_id string, sales_rep string, customer_name string, industry string,
    company_size string, opportunity_amount decimal(18,2), stage string, region string,
    last_visit_date date, expected_close_date date
"""

# Leaves stay text: one bad amount must not void the message, casts happen on extraction.
_AGENT = "struct<FinInstnId: struct<BICFI: string>>"
_AMOUNT = "struct<_VALUE: string, _Ccy: string>"
PAYLOAD = f"""
    FIToFICstmrCdtTrf struct<
        GrpHdr: struct<MsgId: string, CreDtTm: string, NbOfTxs: string>,
        CdtTrfTxInf: array<struct<
            PmtId: struct<EndToEndId: string>,
            IntrBkSttlmAmt: {_AMOUNT},
            InstgAgt: {_AGENT},
            Dbtr: struct<Nm: string>,
            Cdtr: struct<Nm: string>,
            RmtInf: struct<Ustrd: array<string>>>>>,
    BkToCstmrStmt struct<
        Stmt: array<struct<
            Acct: struct<Id: struct<IBAN: string>, Ccy: string>,
            Ntry: array<struct<
                Amt: {_AMOUNT},
                CdtDbtInd: string,
                BookgDt: struct<Dt: string>,
                NtryDtls: array<struct<TxDtls: array<struct<RmtInf: struct<Ustrd: array<string>>>>>>>>>>>
"""

# The amounts of a payload alone, for queries that read no other element of it.
AMOUNTS = """
    FIToFICstmrCdtTrf struct<CdtTrfTxInf: array<struct<IntrBkSttlmAmt: struct<_VALUE: string>>>>,
    BkToCstmrStmt struct<Stmt: array<struct<Ntry: array<struct<Amt: struct<_VALUE: string>>>>>>
"""


def as_struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def as_text(schema: StructType) -> StructType:
    """Same columns, all text: the shape in which delimited files are read."""
    return StructType([StructField(f.name, StringType()) for f in schema])
