"""Quality rules: counts within a text, and the frequency of lines across documents of a host.

Lines are normalised (case and white space) and hashed.  Per host the distinct documents of
each line are counted; a line of more than ``max(least_documents, share * documents of the
host)`` documents is boilerplate of that host and removed.  A document that keeps too small a
part of its words after that is depleted and rejected.

A text's own counts come from numpy passes over its bytes.  A document reports each distinct
line once, so a count of rows is a count of documents and combines before the shuffle; a hot
line joins back as many rows, which adaptive execution splits.  The common lines of each
distinct text of a host then meet its rows, and a second pass over the texts cuts them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.scratch import hot_join, kept
from portolan.llm.words import BASE, Powers, Slice, Words, mix, slices, spans_hash, windows, word_hashes, words

TEXT = ["host", "t1", "t2"]
PER_TEXT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = f"host string, t1 long, t2 long, {' long, '.join(PER_TEXT)} long, lines array<long>"
CUT = f"id long, {' long, '.join(PER_TEXT)} long, n_common_words long, left_text string"
STEP = np.uint64(0xA24BAED4963EE407)
RAW = Powers(np.uint64(0xC2B2AE3D27D4EB4F))
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[ord("\n")] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A"):ord("Z") + 1] += np.uint64(32)


@dataclass(frozen=True)
class Rules:
    least_words: int = 50
    most_repeated: int = 50  # percent of the words
    least_documents: int = 20
    share: float = 0.1
    least_left: float = 0.2


def _per_row(row: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, weight, n).astype(np.int64)


def _repeated(hashes: np.ndarray, bounds: np.ndarray, width: int = 3) -> np.ndarray:
    """Which words lie in a window of ``width`` words that its row holds twice or more."""
    hit = np.zeros(len(hashes) + 1, np.int64)
    start, row = windows(bounds, width)
    if len(start):
        total = row.astype(np.uint64) * BASE
        for j in range(width):
            total = total * STEP + hashes[start + j]
        _, which, often = np.unique(mix(total), return_inverse=True, return_counts=True)
        twice = start[often[which] > 1]
        np.add.at(hit, twice, 1)
        np.add.at(hit, twice + width, -1)
    return np.cumsum(hit[:-1]) > 0


def _lines(part: Slice, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row, number of words and normalised hash of each line that has a word."""
    lines = words(part, NEWLINE)  # runs without a line feed; empty lines have no word
    held = np.searchsorted(found.start, lines.start), np.searchsorted(found.start, lines.end)
    in_line = held[1] - held[0]
    some = in_line > 0
    # normalised: words in lower case (ASCII), joined by one blank
    plain = spans_hash(LOWER[part.data] + np.uint64(1), found.start, found.end)
    return (lines.start[some], lines.end[some], lines.row[some], in_line[some],
            spans_hash(plain, held[0][some], held[1][some]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column("text")):
            n, data = part.n_rows, part.data
            found = words(part)
            hashes = word_hashes(part, found)
            n_words = np.diff(found.bounds)
            starts = (data & 0xC0) != 0x80  # first bytes of characters
            chars = np.concatenate([[0], np.cumsum(starts)])
            word_chars = _per_row(found.row, n, chars[found.end] - chars[found.start])
            marks = np.concatenate([[0], np.cumsum(SYMBOL[data] if len(data) else [])]).astype(np.int64)
            n_symbols = marks[part.offsets[1:]] - marks[part.offsets[:-1]]
            repeated = _repeated(hashes, found.bounds)
            n_repeat = _per_row(found.row[repeated], n)

            start, end, row, _, line = _lines(part, found)
            raw = spans_hash(data.astype(np.uint64) + np.uint64(1), start, end, RAW) + row.astype(np.uint64) * BASE
            _, first = np.unique(raw, return_index=True)
            again = np.ones(len(raw), bool)
            again[first] = False
            n_dup = _per_row(row[again], n)

            _, one = np.unique(line + row.astype(np.uint64) * BASE, return_index=True)
            order = one[np.argsort(row[one], kind="stable")]
            ends = np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32)
            listed = pa.ListArray.from_arrays(ends, pa.array(line[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(part.first, n) for c in TEXT), pa.array(n_words), pa.array(word_chars),
                 pa.array(n_symbols), pa.array(n_dup), pa.array(n_repeat), listed], names=[*TEXT, *PER_TEXT, "lines"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without its common lines, the others joined as they were, and the words cut."""
    for batch in batches:
        for part in slices(batch.column("text")):
            n, rest = part.n_rows, batch.slice(part.first, part.n_rows)
            text, common = rest.column("text"), rest.column("common")
            n_cut = np.zeros(n, np.int64)
            if common.null_count < n:
                own = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(common), 0).to_numpy())
                gone = common.flatten().to_numpy().view(np.uint64) + own.astype(np.uint64) * BASE
                start, end, row, in_line, line = _lines(part, words(part))
                hit = np.isin(line + row.astype(np.uint64) * BASE, gone)
                start, end, row = start[hit], end[hit], row[hit]
                n_cut = _per_row(row, n, in_line[hit])
                # a line goes with the line feed before it; where the first line goes, with the one after it
                first = start == part.offsets[row]
                edge = np.zeros(len(part.data) + 1, np.int8)
                edge[start - ~first] += 1
                edge[end] -= 1
                keep = np.cumsum(edge[:-1], dtype=np.int8) == 0
                left = np.append(np.flatnonzero(keep), len(keep))
                head = left[np.searchsorted(left, part.offsets[row[first]])]
                keep[head[head < part.offsets[row[first] + 1]]] = False
                offsets = np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)[part.offsets]
                whole = pa.Array.from_buffers(
                    pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(part.data[keep])])
                text = pc.if_else(text.is_valid(), whole.cast(pa.string()), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [rest.column("id"), *(rest.column(c) for c in PER_TEXT), pa.array(n_cut), text.cast(pa.string())],
                names=["id", *PER_TEXT, "n_common_words", "left_text"])


def judged(documents: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
           host_col: str = "source") -> DataFrame:
    """Counts, verdict and the text without common lines per input row.

    Returns the id, ``n_words``, ``word_chars`` (code points in words), ``n_symbols``
    (characters of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word that equal an earlier
    line), ``n_repeat_words`` (words in three-word windows that the text holds twice or more),
    ``base_failed`` (too few words, or too many of them repeated), ``n_common_words`` (words in
    lines that the host repeats across documents), ``left_text`` (the text without these lines,
    the others unchanged and in order) and ``kept``: not failed, and at least ``least_left`` of
    the words lie in other lines.

    Null texts count as empty, fail and stay null.  A null host is a host of its own.  Repeated rows count
    as documents of their own.  Ids play no part and may be null.  An empty table gives an
    empty result; further columns are left out.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{host_col}`").cast("string")), F.lit(""))
    text = F.col(f"`{text_col}`").cast("string")
    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), key.alias("host"), F.xxhash64(text).alias("t1"),
                            F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))
    counted = kept(rows.select(*TEXT, "text").mapInArrow(_counted, COUNTS), "counted")
    hosts = counted.groupBy("host").agg(F.greatest(
        F.lit(float(rules.least_documents)), F.count("*") * F.lit(rules.share)).alias("limit"))
    lines = counted.select(*TEXT, F.explode("lines").alias("line"))
    often = lines.groupBy("host", "line").agg(F.count("*").alias("documents"))
    common = hot_join(often, hosts, ["host"]).filter("documents > limit").select("host", "line")
    lost = hot_join(lines, common, ["host", "line"]).groupBy(*TEXT).agg(F.collect_set("line").alias("common"))
    # counts and common lines are the same for all rows of a host with one text
    texts = counted.groupBy(*TEXT).agg(*(F.max(c).alias(c) for c in PER_TEXT)).join(lost, TEXT, "left")
    cut = hot_join(rows, texts, TEXT).select("id", *PER_TEXT, "common", "text").mapInArrow(_cut, CUT)
    n = F.col("n_words")
    failed = (n < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeated * n)
    return (cut.select(F.col("id").alias(id_col), *PER_TEXT, failed.alias("base_failed"), "n_common_words", "left_text")
            .withColumn("kept", ~F.col("base_failed") & (n - F.col("n_common_words") >= rules.least_left * n)))
