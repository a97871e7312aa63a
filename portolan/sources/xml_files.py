"""XML message files: one document per row with its file, row number and type."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.sources import spanning

_BLANK = " \n\r\t﻿"


_NO_TEXT = r"(?s)<\?.*?\?>|<!--.*?-->"
_START_TAG = r"(?:[A-Za-z_][\w.-]*:)?Document[\s>]"


def records_of(units: DataFrame) -> DataFrame:
    """Text up to and with each end of a ``Document`` tag of any prefix, and what follows the last.

    Ends inside CDATA sections and comments are text.  Files split; see ``spanning.records``.
    """
    return spanning.records(units, spanning.xml_documents())


def read_units(reader, path: str, **options: str) -> DataFrame:
    return spanning.units(reader, path, spanning.xml_documents(), recursiveFileLookup="true", **options)


def _payload() -> Column:
    """The document of a closed record; text before its start tag that is neither prolog nor comment is no part of it."""
    body = F.concat("text", F.lit("Document>"))
    before = rf"(?s)^(?:{_NO_TEXT}|[^<]|<(?!{_START_TAG}))*"
    # most documents have a prolog at most before their start tag, which one look at their first signs tells
    plain = body.rlike(rf"\A[{_BLANK}]*+(?:<\?[^<>?]*+\?>[{_BLANK}]*+)?<{_START_TAG}")
    stray = F.btrim(F.regexp_replace(F.regexp_extract(body, before, 0), _NO_TEXT, ""), F.lit(_BLANK))
    # ends with the tag, so there is nothing to trim on the right
    return F.when(plain | (stray == ""), F.ltrim(body, F.lit(_BLANK))).otherwise(F.regexp_replace(body, before, ""))


def documents_of(records: DataFrame) -> DataFrame:
    """Documents among the records of whole files, with their row number in the file.

    A record that was not closed is no document; see ``leftovers_of``.
    """
    return records.where("closed").select(
        _payload().alias("payload"), "source_file", (F.col("number") + 1).alias("row_number"))


def leftovers_of(records: DataFrame) -> DataFrame:
    """Text after the last document, by file; comments and processing instructions are none."""
    return records.where("not closed").select("source_file", _leftover().alias("text")).where(F.col("text") != "")


def _leftover() -> Column:
    return F.btrim(F.regexp_replace("text", _NO_TEXT, ""), F.lit(_BLANK))


def rows_of(records: DataFrame, path: str) -> DataFrame:
    """Messages and, as rejects, what lies outside all documents, in one pass over the records.

    A reject has ``bad_columns`` and its text as ``raw_row``; the columns of a message are NULL.
    """
    closed = F.col("closed")
    rows = records.where(closed | (_leftover() != ""))
    return rows.select(
        F.when(closed, _message_id(path, F.col("number") + 1)).alias("message_id"),
        F.when(closed, message_type(F.col("source_file"))).alias("message_type"),
        F.when(closed, _payload()).alias("payload"),
        "source_file",
        F.when(~closed, F.array(F.lit("payload"))).alias("bad_columns"),
        F.when(~closed, _leftover()).alias("raw_row"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return documents_of(records_of(read_units(spark.read, path)))


def leftover_text(spark: SparkSession, path: str) -> DataFrame:
    return leftovers_of(records_of(read_units(spark.read, path)))


def message_type(path):
    """Message type guessed from the file path."""
    return (
        F.when(path.rlike("(?is)pacs.008"), "pacs.008")
        .when(path.rlike("(?is)camt.053"), "camt.053")
        .otherwise("unknown")
    )


def _message_id(path: str, row_number: Column) -> Column:
    folder = path.rstrip("/").split("://")[-1]
    at = F.locate(f"{folder}/", F.col("source_file"))
    cut = F.substr("source_file", at + len(folder))
    below = F.when(at > 0, F.ltrim(cut, F.lit("/"))).otherwise(F.col("source_file"))
    return F.concat(below, F.lit("-"), row_number.cast("string"))


def messages_of(documents: DataFrame, path: str) -> DataFrame:
    """Message table: id, receive time, type, payload, file.

    The id is the file's path below ``path`` and the row number in the file, so part files of
    two folders differ.
    """
    return documents.select(
        _message_id(path, F.col("row_number")).alias("message_id"),
        F.current_timestamp().alias("received_at"),
        message_type(F.col("source_file")).alias("message_type"),
        "payload",
        "source_file",
    )


def load_xml_messages(spark: SparkSession, path: str) -> DataFrame:
    return messages_of(read_documents(spark, path), path)
