"""The domain tables as DuckDB common table expressions, for the oracle queries.

Written against the given tables only; nothing here is executed by Spark.
"""

from __future__ import annotations

from portolan import bridge
from portolan.functions import values as v


def text_list(items: list[str]) -> str:
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]"


def rows(items: list[tuple]) -> str:
    def cell(x):
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)

    return ", ".join("(" + ", ".join(cell(c) for c in r) + ")" for r in items)


def pad(key: str, width: int) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


def choose(key: str, divisor: int, choices: list[str]) -> str:
    return f"({text_list(choices)})[1 + ({key} // {divisor}) % {len(choices)}]"


def day(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def money(expr: str) -> str:
    text = f"format('{{:,}}', CAST(round({expr}, 0) AS BIGINT))"
    return f"lpad({text}, CAST(greatest(15, length({text})) AS INTEGER), ' ')"


_CTE = {
    "trades": f"""SELECT
        'TX-' || strftime(o_orderdate, '%Y%m%d') || '-' || {pad('o_orderkey', 7)} AS transaction_id,
        CAST(o_orderdate AS DATE) AS trade_date,
        CAST(o_orderdate AS DATE) + CAST(2 + o_orderkey % 29 AS INTEGER) AS settlement_date,
        o_custkey AS customer_id,
        {choose('o_orderkey', 7, [c[0] for c in v.COUNTRIES])} AS counterparty_country,
        {choose('o_orderkey', 17, v.TRANSACTION_TYPES)} AS transaction_type,
        {choose('o_orderkey', 5, v.TRADE_CURRENCIES)} AS currency_code,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
        {choose('o_orderkey', 3, v.BRANCHES)} AS booking_branch,
        {choose('o_orderkey', 11, v.INSTRUMENTS)} AS instrument_type,
        {choose('o_orderkey', 13, v.NOTES)} AS free_text_notes,
        o_orderdate + to_seconds(o_orderkey % 86400) AS created_at
        FROM orders""",
    "customers": f"""SELECT
        c_custkey AS customer_id,
        CASE WHEN ({text_list([c[0] for c in v.COUNTRIES])})[1 + c_nationkey % {len(v.COUNTRIES)}] = 'JP'
             THEN {choose('c_custkey', 1, v.FAMILY_NAMES_JA)} || ' ' || {choose('c_custkey', 9, v.GIVEN_NAMES_JA)}
             ELSE {choose('c_custkey', 1, v.GIVEN_NAMES_EN)} || ' ' || {choose('c_custkey', 11, v.FAMILY_NAMES_EN)}
        END AS customer_name,
        'contact' || c_custkey || '@example.com' AS contact_email,
        '+81-3-' || (1000 + c_custkey % 9000) || '-' || (1000 + c_custkey * 7 % 9000) AS contact_phone,
        {choose('c_nationkey', 1, [c[0] for c in v.COUNTRIES])} AS country_code,
        {choose('c_nationkey', 1, v.CUSTOMER_REGIONS)} AS region,
        {choose('c_custkey', 3, v.SEGMENTS)} AS customer_segment,
        DATE '2001-12-31' - CAST(c_custkey * 13 % 3650 AS INTEGER) AS onboarded_date,
        CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 5000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_rating
        FROM customer""",
    "sales": f"""SELECT
        'DEAL-' || {pad('l_orderkey', 7)} || '-' || l_linenumber AS deal_id,
        'rep.' || {pad('l_suppkey', 4)} AS sales_rep,
        'Company ' || {pad('l_partkey', 6)} AS customer_name,
        {choose('l_partkey', 1, v.INDUSTRIES)} AS industry,
        {choose('l_partkey', 6, v.SIZE_SLOTS)} AS company_size,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS opportunity_amount,
        {choose('(l_orderkey + l_linenumber * 7)', 1, v.STAGE_SLOTS)} AS stage,
        {choose('(l_orderkey + l_suppkey)', 1, v.SALES_REGION_SLOTS)} AS region,
        CAST(l_shipdate AS DATE) AS last_visit_date,
        CAST(l_shipdate AS DATE) + CAST(l_orderkey % 365 AS INTEGER) AS expected_close_date,
        l_shipdate + to_seconds(l_orderkey % 86400) AS loaded_at,
        'batch_' || (l_orderkey % 8) || '.csv' AS source_file
        FROM lineitem""",
    "access_log": """SELECT event_id AS query_id, ts AS query_start_time, 'user-' || user_id AS user_name,
        CAST(json_extract(props, '$.k') AS INTEGER) AS k
        FROM events""",
    # One row per accessed object.
    "accessed": """SELECT query_id, query_start_time, user_name,
        CASE k % 3 WHEN 0 THEN 'RAW.CUSTOMERS' WHEN 1 THEN 'RAW.TRADES' ELSE 'RAW.SALES' END AS object_name,
        CASE WHEN k % 2 = 0 THEN 'ID,AMOUNT' ELSE 'ID' END AS columns
        FROM access_log WHERE k < 90
        UNION ALL
        SELECT query_id, query_start_time, user_name, 'HARMONIZED.Customers_View', 'NAME'
        FROM access_log WHERE k >= 60 AND k < 90""",
    "query_log": """SELECT event_id AS query_id,
        'SELECT * FROM ' || upper(event_type) || repeat(' WHERE user_id = ', 8) || user_id AS query_text,
        'user-' || user_id AS user_name,
        (['ANALYST', 'DATA_ENGINEER', 'ADMIN'])[1 + user_id % 3] AS role_name,
        CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status,
        CASE WHEN user_id % 2 = 0 THEN 'TRADE_DB' ELSE 'OTHER_DB' END AS database_name,
        ts AS start_time, CAST(round(value * 10, 0) AS BIGINT) AS total_elapsed_time
        FROM events""",
    "refresh_log": """SELECT event_id AS run_id, 'refresh_' || event_type AS name,
        CASE WHEN value > 100 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, ts AS scheduled_time,
        ts + to_seconds(CAST(round(value * 1000, 0) AS BIGINT) // 1000) AS completed_time,
        CASE WHEN value > 100 THEN 'timeout after ' || CAST(floor(value) AS BIGINT) || 's' END AS error_message
        FROM events""",
    "changes": """SELECT user_id AS account_id, ts AS changed_at, event_id AS change_seq,
        CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
        event_type AS status, CAST(value AS DECIMAL(18,2)) AS balance
        FROM events""",
    "entitlements": f"""SELECT 'USER_' || s_nationkey AS user_name,
        'rep.' || {pad('s_suppkey', 4)} AS sales_rep FROM supplier""",
    "transfers": """SELECT t.*, i, t.amount + i AS tx_amount,
        CASE WHEN instrument_type <> 'LC' THEN free_text_notes || CASE WHEN i > 0 THEN ' part ' || i ELSE '' END END
          AS remittance
        FROM trades t, (VALUES (0), (1), (2)) AS g(i) WHERE i <= customer_id % 3""",
    "statements": f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, s AS statement_index,
        CASE s WHEN 0 THEN 'JP' ELSE 'SG' END || {pad('o_custkey', 10)} AS account_iban
        FROM orders, (VALUES (0), (1)) AS g(s) WHERE s = 0 OR o_orderkey % 5 = 0""",
    "entries": f"""SELECT o_orderkey, account_iban, statement_index, n,
        CAST(o_totalprice AS DECIMAL(18,2)) + n AS entry_amount,
        ({text_list(bridge.STATEMENT_CURRENCIES)})[1 + n % 3] AS entry_currency,
        CASE WHEN (o_orderkey + n) % 2 = 0 THEN 'CRDT' ELSE 'DBIT' END AS debit_credit,
        CAST(o_orderdate AS DATE) + CAST(n AS INTEGER) AS booking_date
        FROM statements, (VALUES (1), (2), (3)) AS g(n) WHERE n <= o_orderkey % 4""",
}
_NEEDS = {"accessed": ["access_log"], "transfers": ["trades"], "entries": ["statements"]}


def query(body: str, *names: str, **ctes: str) -> str:
    """``WITH`` the named domain tables (and given extra tables) in front of ``body``."""
    parts: list[str] = []
    for name in names:
        for need in _NEEDS.get(name, []):
            if need not in names:
                parts.append(f"{need} AS ({_CTE[need]})")
        parts.append(f"{name} AS ({_CTE[name]})")
    parts += [f"{name} AS ({text})" for name, text in ctes.items()]
    return ("WITH " + ", ".join(parts) + " " if parts else "") + body


def rows_cte(columns: str, items: list[tuple]) -> str:
    return f"SELECT * FROM (VALUES {rows(items)}) AS t({columns})"
