"""Governed reads: tags on columns, masks bound to tags, row filters, PII detection.

A tag is column metadata, so it travels with the column through selects, joins and
views.  The order of a governed read is: row filter on the raw column, then masks, then
views and the user's query on top.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.functions import values as v

PII_TAG, AMOUNT_TAG = "pii_tag", "financial_amount_tag"
ALLOWED_TAG_VALUES = {PII_TAG: v.PII_TAG_VALUES, AMOUNT_TAG: v.AMOUNT_TAG_VALUES}
CLEAR_ROLES = ("ADMIN", "DATA_ENGINEER")
ALL_BRANCH_ROLES = ("ADMIN", "DATA_ENGINEER", "DEVELOPER", "ACCOUNT_ADMIN")
BRANCH_OF_ROLE = {"ANALYST": "Tokyo"}

# table -> column -> (tag, value)
COLUMN_TAGS = {
    "customers": {
        "customer_name": (PII_TAG, "NAME"),
        "contact_email": (PII_TAG, "EMAIL"),
        "contact_phone": (PII_TAG, "PHONE"),
    },
    "trades": {"amount": (AMOUNT_TAG, "TRADE_AMOUNT")},
    "sales": {"customer_name": (PII_TAG, "NAME"), "opportunity_amount": (AMOUNT_TAG, "DEAL_AMOUNT")},
}

Mask = Callable[[Column, str], Column]


def tag_columns(df: DataFrame, tags: dict[str, tuple[str, str]]) -> DataFrame:
    """Attach (tag, value) to columns as metadata."""
    for column, (tag, value) in tags.items():
        df = df.withMetadata(column, {**df.schema[column].metadata, "tags": {tag: value}})
    return df


def tags_of(df: DataFrame) -> list[tuple[str, str, str]]:
    """(column, tag, value) of every tagged column."""
    return [
        (f.name, tag, value) for f in df.schema for tag, value in f.metadata.get("tags", {}).items()
    ]


def mask_text(col: Column, role: str) -> Column:
    return F.when(F.lit(role.upper()).isin(*CLEAR_ROLES), col).otherwise(F.lit(v.MASKED_TEXT))


def mask_amount(above: int = v.MASK_AMOUNT_ABOVE) -> Mask:
    def mask(col: Column, role: str) -> Column:
        hidden = ~F.lit(role.upper()).isin(*CLEAR_ROLES) & (col > above)
        return F.when(hidden, None).otherwise(col)

    return mask


def mask_tagged(df: DataFrame, role: str, policies: dict[str, Mask]) -> DataFrame:
    """Apply to each tagged column the mask bound to its tag; the tags stay on."""
    columns = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        for tag in field.metadata.get("tags", {}):
            if tag in policies:
                col = policies[tag](col, role)
        columns.append(col.alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def default_policies(mask_above: int = v.MASK_AMOUNT_ABOVE) -> dict[str, Mask]:
    return {PII_TAG: mask_text, AMOUNT_TAG: mask_amount(mask_above)}


def branch_access(branch: Column, role: str) -> Column:
    """Row predicate: some roles see all branches, an analyst one, any other role none."""
    role = role.upper()
    if role in ALL_BRANCH_ROLES:
        return F.lit(True)
    return branch == BRANCH_OF_ROLE[role] if role in BRANCH_OF_ROLE else F.lit(False)


def rep_access(deals: DataFrame, entitlements: DataFrame, user: str, role: str) -> DataFrame:
    """Deals a user may see: all for clear roles, else those of the reps mapped to them."""
    if role.upper() in CLEAR_ROLES:
        return deals
    mine = entitlements.where(F.col("user_name") == user).select("sales_rep")
    return deals.join(mine, "sales_rep", "left_semi").select(*deals.columns)


# --- tag registry -----------------------------------------------------------------------

def allowed_values(spark: SparkSession) -> DataFrame:
    rows = [(tag, value) for tag, values in ALLOWED_TAG_VALUES.items() for value in values]
    return spark.createDataFrame(rows, "tag_name string, tag_value string")


def tag_assignments(spark: SparkSession, tags=COLUMN_TAGS) -> DataFrame:
    rows = [(t, c, tag, value) for t, columns in tags.items() for c, (tag, value) in columns.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, tag_name string, tag_value string")


def tag_violations(assignments: DataFrame, allowed: DataFrame) -> DataFrame:
    """Assignments whose value is not in the allowed set of their tag."""
    return assignments.join(F.broadcast(allowed), ["tag_name", "tag_value"], "left_anti").select(
        *assignments.columns
    )


def tag_coverage(df: DataFrame, table_name: str) -> DataFrame:
    """Tagged columns of a table with the rows and values they hold, in one pass."""
    tagged = tags_of(df)
    counts = df.agg(
        F.count("*").alias("n"), *[F.count(f"`{c}`").alias(f"v{i}") for i, (c, _, _) in enumerate(tagged)]
    )
    rows = F.array(
        *[F.struct(F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"),
                   F.lit(tag).alias("tag_name"), F.lit(value).alias("tag_value"),
                   F.col("n").alias("row_count"), F.col(f"v{i}").alias("value_count"))
          for i, (c, tag, value) in enumerate(tagged)]
    )
    return counts.select(F.inline(rows))


# --- PII detection ------------------------------------------------------------------------

@dataclass(frozen=True)
class PiiRule:
    """A category: the shape of its values, and names of columns that hold such shapes as something else."""

    category: str
    privacy: str
    pattern: str
    unless_column: str = "^$"


#: Names are told by shape, two or more capitalised words or Chinese signs and kana, so any name counts.
PII_RULES = (
    PiiRule("EMAIL", "IDENTIFIER", r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"),
    PiiRule("NAME", "IDENTIFIER",
            r"^\p{Lu}[\p{L}'’.-]*(?: \p{Lu}[\p{L}'’.-]*)+$|^[々一-鿿]{1,4} [々ぁ-ヿ一-鿿]{1,5}$",
            "(?i)region|country|city|place|town|branch|segment|type|status|stage|category|industry|product|rating|label"),
    PiiRule("PHONE_NUMBER", "IDENTIFIER", r"^[+]?[0-9][0-9()-]{7,}[0-9]$"),
)


def detect_pii(df: DataFrame, threshold: float = 0.8, rules: tuple[PiiRule, ...] = PII_RULES) -> DataFrame:
    """Text columns that hold names, e-mail addresses or phone numbers, with match rates.

    All columns and categories are rated in one pass over the data.  A table without text columns
    has none.
    """
    text_columns = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    rates, rows = [], []
    for i, name in enumerate(text_columns):
        for rule in rules:
            if re.search(rule.unless_column, name):
                continue
            alias = f"r{i}_{rule.category}"
            rates.append(F.avg(F.col(f"`{name}`").rlike(rule.pattern).cast("double")).alias(alias))
            rows.append(
                F.struct(F.lit(name).alias("column_name"), F.lit(rule.category).alias("semantic_category"),
                         F.lit(rule.privacy).alias("privacy_category"), F.col(alias).alias("match_rate"))
            )
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "column_name string, semantic_category string, privacy_category string, match_rate double")
    return df.agg(*rates).select(F.inline(F.array(*rows))).where(F.col("match_rate") >= threshold)


def dictionary_rates(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Share of each text column's values that hold a word of a dictionary (``word``, ``kind``).

    Returns ``column_name``, ``kind`` and ``match_rate``.  Words are told apart by white space, upper
    and lower case alike.  Equal values are counted first, so the join meets the words of distinct
    values; the dictionary may be of any size.  NULL values are no values.
    """
    columns = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, kind string, match_rate double")
    cells = df.select(F.inline(F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in columns])))
    counted = cells.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    words = dictionary.select(F.lower("word").alias("word"), "kind").distinct()
    held = counted.withColumn("word", F.explode(F.array_distinct(F.split(F.lower("value"), r"\s+")))).join(words, "word")
    found = held.groupBy("column_name", "kind", "value").agg(F.first("n").alias("n")).groupBy(
        "column_name", "kind").agg(F.sum("n").alias("found"))
    totals = counted.groupBy("column_name").agg(F.sum("n").alias("n"))  # one row per column
    return found.join(totals, "column_name").select("column_name", "kind", (F.col("found") / F.col("n")).alias("match_rate"))


def detect_pii_with_dictionary(
    df: DataFrame, dictionary: DataFrame, threshold: float = 0.8, rules: tuple[PiiRule, ...] = PII_RULES
) -> DataFrame:
    """``detect_pii`` with the evidence of a dictionary whose kinds are ``name`` and ``place``.

    A column of places is no column of names, whatever its values look like, unless as many of them
    hold a name; a column whose values hold names is one, whatever their shape.
    """
    shaped = detect_pii(df, threshold, rules)
    known = dictionary_rates(df, dictionary).where(F.col("match_rate") >= threshold)
    named = known.where("kind = 'name'").select("column_name", F.col("match_rate").alias("name_rate"))
    places = known.where("kind = 'place'").join(named, "column_name", "left_anti").select("column_name")
    is_name = F.col("semantic_category") == "NAME"
    kept = shaped.where(~is_name).unionByName(shaped.where(is_name).join(places, "column_name", "left_anti").select(
        *shaped.columns))
    more = named.join(shaped.where(is_name), "column_name", "left_anti").select(
        "column_name", F.lit("NAME").alias("semantic_category"), F.lit("IDENTIFIER").alias("privacy_category"),
        F.col("name_rate").alias("match_rate"))
    return kept.unionByName(more)


def detected_tags(detected: DataFrame, tag: str = PII_TAG) -> dict[str, tuple[str, str]]:
    """Tags for ``tag_columns`` out of detected categories; of several per column, the best rated.

    A category counts as the allowed value that it begins with; other categories set no tag.
    """
    found: dict[str, tuple[str, str]] = {}
    ranked = detected.orderBy(F.desc("match_rate"), "semantic_category")
    for row in ranked.collect():  # one row per column and category of a table at most
        value = next((v for v in ALLOWED_TAG_VALUES[tag] if row.semantic_category.startswith(v)), None)
        if value is not None:
            found.setdefault(row.column_name, (tag, value))
    return found


def compare_tags(assigned: DataFrame, detected: DataFrame) -> DataFrame:
    """Manual tags against detected categories, including columns only one side knows."""
    return assigned.select("column_name", F.col("tag_value").alias("manual_value")).join(
        detected.select("column_name", "semantic_category"), "column_name", "full"
    ).withColumn(
        "agrees",
        F.coalesce(F.startswith("semantic_category", "manual_value"), F.lit(False)),
    )


# --- audit ----------------------------------------------------------------------------------

def recent(log: DataFrame, time: str, as_of: str, hours: int) -> DataFrame:
    """Log rows of the last hours before a given time; the filter reaches the scan."""
    end = F.lit(as_of).cast("timestamp_ntz")
    return log.where(F.col(time) >= end - F.make_interval(hours=F.lit(hours)))


def object_accesses(log: DataFrame, pattern: str) -> DataFrame:
    """One row per accessed object whose name matches, upper and lower case alike."""
    return (
        log.select("query_id", "query_start_time", "user_name", F.inline("base_objects_accessed"))
        .where(F.col("object_name").ilike(pattern))
        .withColumnsRenamed({"object_name": "accessed_object", "columns": "accessed_columns"})
    )


def query_history(log: DataFrame, database: str) -> DataFrame:
    return log.where(F.col("database_name") == database).select(
        "query_id", F.substring("query_text", 1, 100).alias("query_text_preview"), "user_name", "role_name",
        "execution_status", "start_time", "total_elapsed_time",
    )
