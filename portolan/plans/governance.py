"""Queries over governed reads, tags, PII detection and audit logs."""

from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import functions as F

from portolan import bridge
from portolan.functions import values as v
from portolan.operators import governance as g
from portolan.operators import layers, reports
from portolan.plans import sql as q
from portolan.plans.registry import query

# Driver amounts stay below 505,000, so the masking threshold is scaled to them.
_ABOVE = 400_000
_MASK = f"'{v.MASKED_TEXT}'"
_MASKED_AMOUNT = f"CASE WHEN amount > {_ABOVE} THEN NULL ELSE {q.dbl('amount')} END"


def _tagged(spark, sf_dir, name):
    return g.tag_columns(getattr(bridge, name)(spark, sf_dir), g.COLUMN_TAGS[name])


def _masked(spark, sf_dir, name, role):
    return g.mask_tagged(_tagged(spark, sf_dir, name), role, g.default_policies(_ABOVE))


@query("K3 K5", q.query(
    f"""SELECT customer_id, {_MASK} AS customer_name, {_MASK} AS contact_email, {_MASK} AS contact_phone, region
        FROM customers""", "customers"))
def customers_seen_by_analyst(spark, sf_dir):
    return _masked(spark, sf_dir, "customers", "analyst").select(
        "customer_id", "customer_name", "contact_email", "contact_phone", "region"
    )


@query("K3 K5", q.query(
    "SELECT customer_id, customer_name, contact_email, contact_phone, region FROM customers", "customers"))
def customers_seen_by_engineer(spark, sf_dir):
    return _masked(spark, sf_dir, "customers", "data_engineer").select(
        "customer_id", "customer_name", "contact_email", "contact_phone", "region"
    )


@query("K4 B11", q.query(
    f"SELECT transaction_id, {_MASKED_AMOUNT} AS amount, booking_branch FROM trades", "trades"))
def amounts_seen_by_analyst(spark, sf_dir):
    return _masked(spark, sf_dir, "trades", "ANALYST").select("transaction_id", "amount", "booking_branch")


@query("F3 K4", q.query(
    f"""SELECT transaction_id, {_MASKED_AMOUNT} AS amount, booking_branch FROM trades
        ORDER BY amount > {_ABOVE} DESC, CASE WHEN amount > {_ABOVE} THEN 0 ELSE amount END DESC, transaction_id
        LIMIT 10""", "trades"))
def largest_amounts_seen_by_analyst(spark, sf_dir):
    df = _masked(spark, sf_dir, "trades", "ANALYST").select("transaction_id", "amount", "booking_branch")
    return reports.top(df, 10, F.desc_nulls_first("amount"), F.asc("transaction_id"))


@query("K5 F3", q.query(
    f"""SELECT deal_id, {_MASK} AS customer_name, CASE WHEN opportunity_amount > 100000 THEN NULL
        ELSE {q.dbl('opportunity_amount')} END AS opportunity_amount, stage FROM sales""", "sales"))
def deals_seen_by_analyst(spark, sf_dir):
    df = g.mask_tagged(_tagged(spark, sf_dir, "sales"), "ANALYST", g.default_policies(100_000))
    return df.select("deal_id", "customer_name", "opportunity_amount", "stage")


@query("K6", q.query(
    f"""SELECT t.transaction_id, CASE WHEN c.customer_id IS NOT NULL THEN {_MASK} END AS customer_name,
        CASE WHEN c.customer_id IS NOT NULL THEN {_MASK} END AS contact_email, {_MASKED_AMOUNT} AS amount
        FROM trades t LEFT JOIN customers c ON t.customer_id = c.customer_id
        WHERE t.booking_branch = 'Tokyo'""", "trades", "customers"))
def masked_view_of_analyst(spark, sf_dir):
    """Row filter on the raw table, masks, then the joined view on top."""
    trades = _tagged(spark, sf_dir, "trades")
    visible = trades.where(g.branch_access(F.col("booking_branch"), "ANALYST"))
    masked = g.mask_tagged(visible, "ANALYST", g.default_policies(_ABOVE))
    view = layers.harmonized_trades(masked, _masked(spark, sf_dir, "customers", "ANALYST"))
    return view.select("transaction_id", "customer_name", "contact_email", "amount")


@query("K7 D16", q.query(
    """SELECT role, booking_branch, count(*) AS tx_count FROM trades,
       (VALUES ('ADMIN'), ('ANALYST'), ('DEVELOPER'), ('VISITOR')) AS r(role)
       WHERE role IN ('ADMIN', 'DEVELOPER') OR (role = 'ANALYST' AND booking_branch = 'Tokyo')
       GROUP BY role, booking_branch""", "trades"))
def branch_counts_per_role(spark, sf_dir):
    trades = bridge.trades(spark, sf_dir)

    def counts(role):
        seen = trades.where(g.branch_access(F.col("booking_branch"), role))
        return (
            seen.groupBy("booking_branch").agg(F.count("*").alias("tx_count")).distinct()
            .select(F.lit(role).alias("role"), "booking_branch", "tx_count")
        )

    return reduce(lambda a, b: a.unionByName(b), [counts(r) for r in ("ADMIN", "ANALYST", "DEVELOPER", "VISITOR")])


@query("K8 C5", q.query(
    f"""SELECT deal_id, sales_rep, stage, {q.dbl('opportunity_amount')} AS opportunity_amount FROM sales s
        WHERE EXISTS (SELECT 1 FROM entitlements e WHERE e.user_name = 'USER_3' AND e.sales_rep = s.sales_rep)""",
    "sales", "entitlements"))
def deals_of_entitled_user(spark, sf_dir):
    seen = g.rep_access(bridge.sales(spark, sf_dir), bridge.entitlements(spark, sf_dir), "USER_3", "ANALYST")
    return seen.select("deal_id", "sales_rep", "stage", "opportunity_amount")


_TEXT_COLUMNS = [
    "customer_name", "contact_email", "contact_phone", "country_code", "region", "customer_segment", "risk_rating",
]
_DETECTED_SQL = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{r.category}' AS semantic_category, "
    f"avg(CAST(regexp_matches({c}, {q.text_list([r.pattern])[1:-1]}) AS DOUBLE)) AS match_rate FROM customers"
    for c in _TEXT_COLUMNS for r in g.PII_RULES if not re.search(r.unless_column, c)
) + ") WHERE match_rate >= 0.8"


@query("K11", q.query(
    f"""SELECT column_name, semantic_category, 'IDENTIFIER' AS privacy_category, round(match_rate, 6) AS match_rate
        FROM ({_DETECTED_SQL})""", "customers"))
def detected_pii_columns(spark, sf_dir):
    return g.detect_pii(bridge.customers(spark, sf_dir)).withColumn("match_rate", F.round("match_rate", 6))


@query("K11 K5", q.query(
    f"""SELECT customer_id, {_MASK} AS customer_name, {_MASK} AS contact_email, {_MASK} AS contact_phone, region,
        country_code, risk_rating FROM customers""", "customers"))
def customers_masked_by_detection(spark, sf_dir):
    """No tag is set by hand: detection tags the columns, and the masks follow the tags."""
    customers = bridge.customers(spark, sf_dir)
    tagged = g.tag_columns(customers, g.detected_tags(g.detect_pii(customers)))
    return g.mask_tagged(tagged, "analyst", g.default_policies()).select(
        "customer_id", "customer_name", "contact_email", "contact_phone", "region", "country_code", "risk_rating"
    )


# Columns that shape alone reads wrongly: places of two words, names in small letters.
_SITED = ["customer_name", "lower(customer_name) AS holder",
          "concat(upper(substr(n_name, 1, 1)), lower(substr(n_name, 2)), ' East') AS site"]
_NAME_WORDS = [(w, "name") for w in v.FAMILY_NAMES_JA + v.FAMILY_NAMES_EN + v.GIVEN_NAMES_JA + v.GIVEN_NAMES_EN]
_SHAPE = q.text_list([next(r.pattern for r in g.PII_RULES if r.category == "NAME")])[1:-1]


@query("K11", q.query(
    f"""SELECT column_name, semantic_category, 'IDENTIFIER' AS privacy_category, round(match_rate, 6) AS match_rate FROM (
        WITH cells AS (SELECT unnest(['customer_name', 'holder', 'site']) AS column_name,
                unnest([customer_name, holder, site]) AS value FROM (SELECT {", ".join(_SITED)}
                FROM customers JOIN nation ON n_nationkey = customer_id % 25)),
            dict AS (SELECT DISTINCT lower(word) AS word, kind FROM (
                SELECT * FROM (VALUES {q.rows(_NAME_WORDS)}) AS t(word, kind)
                UNION ALL SELECT unnest(string_split_regex(n_name, '\\s+')), 'place' FROM nation)),
            rates AS (SELECT column_name, avg(CAST(regexp_matches(value, {_SHAPE}) AS DOUBLE)) AS shape,
                avg(CAST(EXISTS (SELECT 1 FROM dict WHERE kind = 'name'
                    AND list_contains(string_split_regex(lower(value), '\\s+'), word)) AS DOUBLE)) AS named,
                avg(CAST(EXISTS (SELECT 1 FROM dict WHERE kind = 'place'
                    AND list_contains(string_split_regex(lower(value), '\\s+'), word)) AS DOUBLE)) AS placed
                FROM cells GROUP BY column_name)
        SELECT column_name, 'NAME' AS semantic_category, CASE WHEN shape >= 0.8 THEN shape ELSE named END AS match_rate
        FROM rates WHERE named >= 0.8 OR (shape >= 0.8 AND placed < 0.8))""",
    "customers"))
def detected_names_by_dictionary(spark, sf_dir):
    nation = bridge.table(spark, sf_dir, "nation")
    names = spark.createDataFrame(_NAME_WORDS, "word string, kind string")
    places = nation.select(F.explode(F.split("n_name", r"\s+")).alias("word"), F.lit("place").alias("kind"))
    customers = bridge.customers(spark, sf_dir)
    sited = customers.join(nation, F.col("n_nationkey") == F.col("customer_id") % 25).selectExpr(*_SITED)
    return g.detect_pii_with_dictionary(sited, names.unionByName(places)).withColumn(
        "match_rate", F.round("match_rate", 6))


_ASSIGNED = [(t, c, tag, value) for t, cols in g.COLUMN_TAGS.items() for c, (tag, value) in cols.items()]


@query("K12", q.query(
    f"""SELECT coalesce(m.column_name, d.column_name) AS column_name, m.tag_value AS manual_value, d.semantic_category,
        coalesce(starts_with(d.semantic_category, m.tag_value), false) AS agrees
        FROM (SELECT * FROM assigned WHERE table_name = 'customers') m
        FULL JOIN ({_DETECTED_SQL}) d ON m.column_name = d.column_name""",
    "customers", assigned=q.rows_cte("table_name, column_name, tag_name, tag_value", _ASSIGNED)))
def manual_and_detected_tags(spark, sf_dir):
    manual = g.tag_assignments(spark).where(F.col("table_name") == "customers")
    return g.compare_tags(manual, g.detect_pii(bridge.customers(spark, sf_dir)))


@query("K1", q.query(
    f"""SELECT 'customers' AS table_name, column_name, 'pii_tag' AS tag_name, semantic_category AS tag_value
        FROM ({_DETECTED_SQL}) WHERE semantic_category NOT IN ('NAME', 'EMAIL', 'PHONE')""", "customers"))
def tag_value_violations(spark, sf_dir):
    """Detected categories put forward as tags; those outside the allowed set are listed."""
    proposed = g.detect_pii(bridge.customers(spark, sf_dir)).select(
        F.lit("customers").alias("table_name"), "column_name", F.lit(g.PII_TAG).alias("tag_name"),
        F.col("semantic_category").alias("tag_value"),
    )
    return g.tag_violations(proposed, g.allowed_values(spark))


@query("K2", q.query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{tag}' AS tag_name, '{value}' AS tag_value, "
        f"count(*) AS row_count, count({c}) AS value_count FROM {t}"
        for t, c, tag, value in _ASSIGNED), "customers", "trades", "sales"))
def tagged_columns(spark, sf_dir):
    parts = [g.tag_coverage(_tagged(spark, sf_dir, name), name) for name in g.COLUMN_TAGS]
    return reduce(lambda a, b: a.unionByName(b), parts)


_AS_OF = "2024-01-30 00:00:00"


@query("B10 B6 I9", q.query(
    f"""SELECT query_id, {q.stamp('query_start_time')} AS query_start_time, user_name,
        CASE WHEN k >= 60 THEN 2 ELSE 1 END AS object_count,
        CASE k % 3 WHEN 0 THEN 'RAW.CUSTOMERS' WHEN 1 THEN 'RAW.TRADES' ELSE 'RAW.SALES' END AS first_object
        FROM access_log WHERE k < 90 AND query_start_time >= TIMESTAMP '{_AS_OF}' - INTERVAL 24 HOUR""", "access_log"))
def recent_accesses(spark, sf_dir):
    log = g.recent(bridge.access_log(spark, sf_dir), "query_start_time", _AS_OF, 24)
    objects = F.col("base_objects_accessed")
    return log.where(F.size(objects) > 0).select(
        "query_id", "query_start_time", "user_name", F.size(objects).alias("object_count"),
        F.get(objects, F.lit(0))["object_name"].alias("first_object"),
    )


@query("K9 C6 B5", q.query(
    f"""SELECT query_id, {q.stamp('query_start_time')} AS query_start_time, user_name,
        object_name AS accessed_object, columns AS accessed_columns FROM accessed
        WHERE query_start_time >= TIMESTAMP '{_AS_OF}' - INTERVAL 24 HOUR AND object_name ILIKE '%CUSTOMERS%'""",
    "accessed"))
def accesses_to_customers(spark, sf_dir):
    log = g.recent(bridge.access_log(spark, sf_dir), "query_start_time", _AS_OF, 24)
    found = g.object_accesses(log, "%CUSTOMERS%")
    return found.withColumn("accessed_columns", F.array_join("accessed_columns", ",")).orderBy(
        F.desc("query_start_time")
    )


@query("K10", q.query(
    f"""SELECT query_id, substr(query_text, 1, 100) AS query_text_preview, user_name, role_name, execution_status,
        {q.stamp('start_time')} AS start_time, total_elapsed_time FROM query_log
        WHERE start_time >= TIMESTAMP '{_AS_OF}' - INTERVAL 24 HOUR AND database_name = 'TRADE_DB'""", "query_log"))
def query_history(spark, sf_dir):
    log = g.recent(bridge.query_log(spark, sf_dir), "start_time", _AS_OF, 24)
    return g.query_history(log, "TRADE_DB").orderBy(F.desc("start_time"))
