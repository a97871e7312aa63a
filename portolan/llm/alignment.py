"""Alignment of two tokenizers' tokens, scored by inverted pair bitmaps.

Each text is cut by both tokenizers; byte offsets at which tokens of both end cut it into
groups, and two tokens whose byte ranges overlap are linked.  How well a pair of token ids fits
is told by the number of documents that hold it linked.

*Bitmaps.*  Documents are numbered within blocks of ``BLOCK``.  For every pair and block there
is a compressed bitmap of the documents that hold it, the union of its documents' bits: sorted
16-bit places while they are few, plain bits from then on.  A document that links a pair ``m``
times sets the binary digits of ``m - 1`` in further bitmaps, the multiplicity planes, so the
link count of a pair is ``popcount(level 0) + sum of 2**(p-1) * popcount(level p)``.  Blocks do
not overlap, so their union over a table has the sum of their popcounts; these sums combine
before the shuffle, and a pair found in every document costs one bitmap per block, not one row
per document.

*Postings return scores.*  The bitmaps are joined with their pair's count and go back to their
block, where every set bit adds its weight times the count to its document.

*Tokens.*  Neither tokenizer merges across a plain space that follows a non-space (a table of
pieces that could is refused), so texts are cut there, and each distinct stretch of a slice of
texts is tokenized and aligned once, many of them laid end to end.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.scratch import hot_join, kept
from portolan.llm.words import Slice, mix, slices, spans_hash

BLOCK = 4096  # documents a block
DENSE = BLOCK // 16  # from this many places on, plain bits are no longer than places
PAIRS_HELD = 1 << 22  # document-pair entries of a block before it is closed early
TEXT_SLICE = 1 << 22  # bytes of text whose distinct stretches are found together
CHUNK = 1 << 12  # bytes of stretches tokenized in one go

FOLDER = "/opt/tokenizers"
BYTE_MODEL, PIECE_MODEL = f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model"

ROWS = ("block long, place int, a int, b int, level int, n int, bits binary, doc_id long, n_a long, n_b long, "
        "n_groups long, n_links long, groups_sha256 string")

#: Fixed value: how the byte tokenizer's pre-tokenizer parts a text.
BYTE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LATIN_LEAD = 0xC8  # signs whose bytes are no greater are classed alike by every version of Unicode

#: Last bytes of white-space signs beyond ASCII.
WIDE_SPACE_END = np.zeros(256, bool)
WIDE_SPACE_END[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


def byte_signs() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, others follow at 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Spelling:
    """Bytes of each entry of a vocabulary, as one array."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spread(self.start[ids], self.size[ids])]


def spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``start[k], start[k] + 1, ...``: ``n[k]`` places each, one after the other."""
    return np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)


@dataclass
class Cut:
    """Stretches of text cut by both tokenizers, laid end to end; those whose bytes differ have no tokens."""

    fits: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[bytes]  # ``a1,a2|b1;a3|b2;``
    n_links: np.ndarray
    pairs: np.ndarray  # one per link: a << 32 | b


class Aligner:
    """Both tokenizers and the spelling of their ids."""

    def __init__(self, byte_model: str, piece_model: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.byte = Tokenizer.from_file(byte_model)
        self.byte.encode_special_tokens = True
        signs = byte_signs()
        with open(byte_model, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        entries = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            entries[i] = bytes(signs[c] for c in entry if c in signs)
        self.quick = self._quick(model, entries)
        self.spelling_a = Spelling(entries)
        self.piece = SentencePieceProcessor(model_file=piece_model)
        pieces = [self.piece.id_to_piece(i) for i in range(self.piece.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces that reach across words cannot be aligned stretch by stretch")
        self.spelling_b = Spelling([bytes([int(p[3:5], 16)]) if self.piece.is_byte(i) else p.replace("▁", " ").encode()
                                    for i, p in enumerate(pieces)])
        self.space = self.piece.piece_to_id("▁")
        self.digits = Spelling([b"%d" % i for i in range(max(len(entries), len(pieces)))])

    def _quick(self, model: dict, entries: list[bytes]):
        """The byte tokenizer by ranks, where its file allows that: merges in the order of their ids, known pattern."""
        from tiktoken import Encoding

        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        made = [model["vocab"].get("".join(p)) for p in pairs]
        kind = json.loads(self.byte.pre_tokenizer.__getstate__()) if self.byte.pre_tokenizer else {}
        plain = (made == list(range(256, 256 + len(made))) and kind.get("type") == "ByteLevel"
                 and not kind.get("add_prefix_space") and kind.get("use_regex", True) and self.byte.normalizer is None)
        ranks = {e: i for i, e in enumerate(entries[:256 + len(made)]) if e}
        if not plain or len(ranks) != 256 + len(made):
            return None
        return Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _tokenized(self, raw: np.ndarray, bounds: np.ndarray, rare: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ids of consecutive stretches laid end to end, halved until those whose bytes differ are alone.

        Yields (first, last, ids of a, ids of b); a stretch without tokens does not fit.
        """
        waiting = [(0, len(bounds) - 1)]
        while waiting:
            lo, hi = waiting.pop()
            own = raw[bounds[lo]:bounds[hi]].tobytes()
            text = own.decode("utf-8", "replace")
            if rare or self.quick is None:
                a = self.byte.encode_batch_fast([text], add_special_tokens=False)[0].ids
            else:
                a = self.quick(text)
            ids_a = np.array(a, np.int64)
            # the piece tokenizer sets a space before a text, but none before an empty one
            ids_b = np.array(self.piece.encode(text[1:]) if text != " " else [self.space], np.int64)
            if self.spelling_a.spelled(ids_a).tobytes() == own == self.spelling_b.spelled(ids_b).tobytes():
                yield lo, hi, ids_a, ids_b
            elif hi - lo > 1:
                waiting += [((lo + hi) // 2, hi), (lo, (lo + hi) // 2)]

    def cut(self, raw: np.ndarray, size: np.ndarray, chunks: list[tuple[int, int, bool]]) -> Cut:
        """Cut stretches that lie end to end in ``raw``; ``chunks`` may each be tokenized in one go.

        A chunk is (first, last, rare): rare ones hold signs whose class may differ between
        libraries, so they always go through the tokenizer's own.
        """
        bounds = np.append(0, np.cumsum(size))
        fits = np.zeros(len(size), bool)
        parts_a, parts_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, last, rare in chunks:
            for lo, hi, a, b in self._tokenized(raw, bounds[first:last + 1], rare):
                fits[first + lo:first + hi] = True
                parts_a.append(a)
                parts_b.append(b)
        ids_a, ids_b = np.concatenate(parts_a), np.concatenate(parts_b)
        ends_a, ends_b = np.cumsum(self.spelling_a.size[ids_a]), np.cumsum(self.spelling_b.size[ids_b])
        upto = np.cumsum(np.where(fits, size, 0))
        n_a = np.diff(np.searchsorted(ends_a, upto, "right"), prepend=0)
        n_b = np.diff(np.searchsorted(ends_b, upto, "right"), prepend=0)
        # the tokens of b that overlap a token of a are consecutive
        first = np.searchsorted(ends_b, ends_a - self.spelling_a.size[ids_a], "right")
        n = np.searchsorted(ends_b - self.spelling_b.size[ids_b], ends_a, "left") - first
        pairs = np.repeat(ids_a, n) << 32 | ids_b[spread(first, n)]
        # stretches begin where tokens of both begin, so no group or link reaches across them
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        at_a, at_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        upto_a, upto_b = np.cumsum(np.bincount(at_a, minlength=len(cuts))), np.cumsum(np.bincount(at_b, minlength=len(cuts)))
        place_a = np.arange(len(ids_a)) + np.append(0, upto_b)[at_a]
        place_b = np.arange(len(ids_b)) + upto_a[at_b]
        ids, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.empty(len(ids_a) + len(ids_b), np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        mark[place_a] = np.where(ends_a == cuts[at_a], ord("|"), ord(","))
        mark[place_b] = np.where(ends_b == cuts[at_b], ord(";"), ord(","))
        width = self.digits.size[ids]
        stop = np.cumsum(width + 1)
        text = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
        text[stop - 1] = mark
        text[spread(stop - 1 - width, width)] = self.digits.spelled(ids)
        last = np.append(0, stop)[np.cumsum(n_a + n_b)].tolist()
        text = text.tobytes()
        groups = [text[lo:hi] for lo, hi in zip([0, *last[:-1]], last, strict=True)]
        n_groups = _per(ends_a == cuts[at_a], n_a)
        return Cut(fits, n_a, n_b, n_groups, groups, _per(n, n_a), pairs)


def _per(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``n[k]`` values."""
    upto = np.append(0, np.cumsum(values, dtype=np.int64))
    last = np.cumsum(n)
    return upto[last] - upto[last - n]


@lru_cache(maxsize=1)
def aligner(byte_model: str, piece_model: str) -> Aligner:
    return Aligner(byte_model, piece_model)


def spaced(part: Slice) -> Slice:
    """The rows of a slice with one space before each that is not empty."""
    sizes = np.diff(part.offsets)
    offsets = np.append(0, np.cumsum(sizes + (sizes > 0)))
    data = np.full(offsets[-1], 0x20, np.uint8)
    old = np.ones(offsets[-1], bool)
    old[offsets[:-1][sizes > 0]] = False
    data[old] = part.data
    return Slice(part.first, data, offsets)


def plain(data: np.ndarray) -> np.ndarray:
    """Bytes after which a space may be cut off: ends of signs that are surely no white space."""
    before = np.append(np.zeros(1, np.uint8), data[:-1])
    wide = WIDE_SPACE_END[data] & ((before == 0xC2) | (before == 0x80) | (before == 0x81) | (before == 0x9A))
    return (data > 0x20) & (data != 0x7F) & ~wide


def stretches(part: Slice, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the stretches: a row is cut before each space after a plain byte."""
    cut = np.zeros(len(part.data), bool)
    cut[1:] = (part.data[1:] == 0x20) & after[:-1]
    cut[part.offsets[:-1][np.diff(part.offsets) > 0]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(part.data))
    return start, end, np.searchsorted(part.offsets, start, "right") - 1


def chunked(size: np.ndarray, rare: np.ndarray, alone: np.ndarray) -> list[tuple[int, int, bool]]:
    """Runs of stretches of one kind and about ``CHUNK`` bytes; those that end in white space are alone."""
    if not len(size):
        return []
    piece = np.where(alone, np.arange(len(size)), -1 - np.cumsum(size) // CHUNK)
    new = np.flatnonzero((piece[1:] != piece[:-1]) | (rare[1:] != rare[:-1])) + 1
    edges = [0, *new.tolist(), len(size)]
    return [(lo, hi, bool(rare[lo])) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]


class Block:
    """Consecutive documents of a task, and the pairs they link."""

    def __init__(self, number: int):
        self.number, self.rows, self.held = number, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, place: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        self.parts.append((place.astype(np.int32), pair, times.astype(np.int32)))
        self.held += len(pair)

    def bitmaps(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        place, pair, times = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort(pair, kind="stable")  # places of one pair are in order already
        place, pair, times = place[order], pair[order], times[order]
        yield from self._level(pair, place, 0)
        more = times - 1
        for p in range(int(more.max()).bit_length()):
            held = (more >> p & 1).astype(bool)
            yield from self._level(pair[held], place[held], p + 1)

    def _level(self, pair: np.ndarray, place: np.ndarray, level: int) -> Iterator[pa.RecordBatch]:
        for lo, hi, bits in packed(pair, place):
            own = pair[lo]
            yield posting_batch(self.number, own, level, hi - lo, bits)


def packed(pair: np.ndarray, place: np.ndarray, rows: int = 1 << 14):
    """Runs of equal pairs as compressed bitmaps: (starts, ends, binary array) for up to ``rows`` runs."""
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(pair))
    for k in range(0, len(first), rows):
        lo, hi = first[k:k + rows], last[k:k + rows]
        n = hi - lo
        dense = n >= DENSE
        offsets = np.append(0, np.cumsum(np.where(dense, BLOCK // 8, 2 * n)))
        body = np.zeros(offsets[-1], np.uint8)
        places = place[lo[0]:hi[-1]]
        run = np.repeat(np.arange(len(n)), n)
        rank = np.arange(len(places)) - (lo - lo[0])[run]
        few = ~dense[run]
        at = offsets[:-1][run[few]] + 2 * rank[few]
        body[at], body[at + 1] = places[few] & 255, places[few] >> 8
        if dense.any():
            grid = np.zeros((int(dense.sum()), BLOCK), np.uint8)
            grid[(np.cumsum(dense) - 1)[run[~few]], places[~few]] = 1
            bits = np.packbits(grid, axis=1, bitorder="little")
            body[(offsets[:-1][dense][:, None] + np.arange(BLOCK // 8)).ravel()] = bits.ravel()
        yield lo, hi, pa.Array.from_buffers(pa.binary(), len(n), [
            None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())])


def unpacked(bits: pa.Array, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set places of compressed bitmaps, and the row each belongs to."""
    bounds = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset:bits.offset + len(bits) + 1].astype(np.int64)
    body = np.frombuffer(bits.buffers()[2], np.uint8) if bits.buffers()[2] is not None else np.zeros(0, np.uint8)
    dense = n >= DENSE
    few = np.flatnonzero(~dense)
    run = np.repeat(few, n[few])
    at = bounds[run] + 2 * (np.arange(len(run)) - np.repeat(np.cumsum(n[few]) - n[few], n[few]))
    place = body[at].astype(np.int64) | body[at + 1].astype(np.int64) << 8
    if not dense.any():
        return place, run
    many = np.flatnonzero(dense)
    grid = np.unpackbits(body[bounds[many][:, None] + np.arange(BLOCK // 8)], axis=1, bitorder="little")
    row, at = np.nonzero(grid)
    return np.append(place, at), np.append(run, many[row])


def _nulls(n: int, kind: pa.DataType) -> pa.Array:
    return pa.nulls(n, kind)


def posting_batch(block: int, pair: np.ndarray, level: int, n: np.ndarray, bits: pa.Array) -> pa.RecordBatch:
    k = len(pair)
    long, small = pa.int64(), pa.int32()
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(k, block, np.int64)), _nulls(k, small), pa.array((pair >> 32).astype(np.int32)),
        pa.array((pair & 0xFFFFFFFF).astype(np.int32)), pa.array(np.full(k, level, np.int32)),
        pa.array(n.astype(np.int32)), bits, _nulls(k, long), *[_nulls(k, long)] * 4, _nulls(k, pa.string())],
        names=[f.split()[0] for f in ROWS.split(", ")])


def document_batch(block: int, place: np.ndarray, ids: pa.Array, counts: list[np.ndarray],
                   digests: list[str]) -> pa.RecordBatch:
    k = len(place)
    small = pa.int32()
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(k, block, np.int64)), pa.array(place.astype(np.int32)), *[_nulls(k, small)] * 4,
        _nulls(k, pa.binary()), ids, *[pa.array(c.astype(np.int64)) for c in counts], pa.array(digests, pa.string())],
        names=[f.split()[0] for f in ROWS.split(", ")])


def align_slice(part: Slice, known: Aligner):
    """Per row the four counts and the digest of its groups; and (row, pair, times) of all links."""
    part = spaced(part)
    after = plain(part.data)
    start, end, row = stretches(part, after)
    n_rows = part.n_rows
    key = spans_hash(part.data.astype(np.uint64) + np.uint64(1), start, end) ^ mix((end - start).astype(np.uint64))
    _, first, unit = np.unique(key, return_index=True, return_inverse=True)
    size = (end - start)[first]
    if len(first):
        rare, alone = np.maximum.reduceat(part.data, start)[first] > LATIN_LEAD, ~after[end - 1][first]
    else:
        rare = alone = np.zeros(0, bool)
    order = np.lexsort((alone, rare))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    unit, size = place[unit], size[order]
    made = known.cut(part.data[spread(start[first[order]], size)], size, chunked(size, rare[order], alone[order]))
    fits = np.ones(n_rows, bool)
    fits[row[~made.fits[unit]]] = False
    own = fits[row]
    unit, row = unit[own], row[own]
    counts = [np.bincount(row, per[unit], n_rows).astype(np.int64)
              for per in (made.n_a, made.n_b, made.n_groups, made.n_links)]
    bounds = np.searchsorted(row, np.arange(n_rows + 1))
    texts = [made.groups[i] for i in unit.tolist()]
    digests = ["" if lo == hi else hashlib.sha256(memoryview(b"".join(texts[lo:hi]))[:-1]).hexdigest()
               for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    # links of a document: first its distinct stretches with their counts, then the pairs in these
    if not len(unit):
        nothing = np.zeros(0, np.int64)
        return counts, digests, (nothing, nothing, nothing)
    n_units = len(made.n_links)
    held, times = np.unique(row * n_units + unit, return_counts=True)
    row, unit = held // n_units, held % n_units
    n = made.n_links[unit]
    at = spread((np.cumsum(made.n_links) - made.n_links)[unit], n)
    row, times = np.repeat(row, n), np.repeat(times, n)
    pairs, code = np.unique(made.pairs, return_inverse=True)
    joint = row * len(pairs) + code[at]
    held, back = np.unique(joint, return_inverse=True)
    return counts, digests, (held // len(pairs), pairs[held % len(pairs)],
                             np.bincount(back, times, len(held)).astype(np.int64))


def _aligned(byte_model: str, piece_model: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(byte_model, piece_model)
        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            ids = batch.column("doc_id")
            for part in slices(batch.column("text"), TEXT_SLICE):
                counts, digests, (row, pair, times) = align_slice(part, known)
                done = 0
                while done < part.n_rows:
                    some = min(BLOCK - block.rows, part.n_rows - done)
                    lo, hi = np.searchsorted(row, [done, done + some])
                    block.add(row[lo:hi] - done + block.rows, pair[lo:hi], times[lo:hi])
                    yield document_batch(block.number, np.arange(some) + block.rows,
                                         ids.slice(part.first + done, some), [c[done:done + some] for c in counts],
                                         digests[done:done + some])
                    block.rows += some
                    done += some
                    if block.rows == BLOCK or block.held > PAIRS_HELD:
                        yield from block.bitmaps()
                        number += 1
                        block = Block(number)
        yield from block.bitmaps()

    return align


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of bitmaps sorted by block, each worth its level's weight times its pair's count."""
    now, score, best = None, np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)

    def report() -> pa.RecordBatch:
        place = np.flatnonzero(score)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(place), now, np.int64)), pa.array(place.astype(np.int32)), pa.array(score[place]),
             pa.array(best[place])], names=["block", "place", "count_sum", "n_best"])

    for batch in batches:
        block = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)] if len(block) else [0]
        n = batch.column("n").to_numpy().astype(np.int64)
        weight = 1 << np.maximum(batch.column("level").to_numpy().astype(np.int64) - 1, 0)
        worth = weight * batch.column("docs").to_numpy()
        top = weight * batch.column("top").to_numpy(zero_copy_only=False)
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if block[lo] != now:
                if now is not None:
                    yield report()
                now = block[lo]
                score[:], best[:] = 0, 0
            place, run = unpacked(batch.column("bits").slice(lo, hi - lo), n[lo:hi])
            np.add.at(score, place, worth[lo:hi][run])
            np.add.at(best, place, top[lo:hi][run])
    if now is not None:
        yield report()


def bitmaps(documents: DataFrame, id_col: str, text_col: str, byte_model: str, piece_model: str) -> DataFrame:
    """One row per document (``place``) and per pair, block and level (``level``, ``bits``); written."""
    texts = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                             F.col(f"`{text_col}`").alias("text"))
    return kept(texts.mapInArrow(_aligned(byte_model, piece_model), ROWS), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """Per pair of ids ``a, b``: ``docs`` that hold it linked, ``links`` in all, and whether it is ``a``'s ``top``."""
    pairs = rows.filter("level is not null").groupBy("a", "b").agg(
        F.sum(F.when(F.col("level") == 0, F.col("n")).otherwise(0)).alias("docs"),
        F.sum(F.col("n") * F.expr("shiftleft(1L, greatest(level - 1, 0))")).alias("links"))
    most = pairs.groupBy("a").agg(F.max("docs").alias("most"))
    return pairs.join(most, "a").select("a", "b", "docs", "links", (F.col("docs") == F.col("most")).alias("top"))


def aligned(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL,
            piece_model: str = PIECE_MODEL) -> DataFrame:
    """Both tokenizers' tokens of each text, their groups and links, and the pairs' scores.

    The byte-level tokenizer reads a space and the text, the piece tokenizer the text, before
    which it sets a space itself; both without special tokens, and strings that look like these
    are plain text.  Returns per row: the id, ``n_a`` and ``n_b`` tokens, ``n_groups``,
    ``n_links`` (overlapping occurrences), ``n_best`` (links whose pair is held by as many
    documents as any of its first id), ``count_sum`` (these document counts summed over the
    links) and ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``).

    A text that is null or empty, or whose tokens do not give its bytes back, has zeros and an
    empty digest and counts for no pair.  Every row is a document of its own, so repeated rows
    count as often as they occur; a null id is kept.  Long texts are read whole.  Further
    columns are left out.  An empty table gives an empty result.
    """
    rows = bitmaps(documents, id_col, text_col, byte_model, piece_model)
    scores = kept(pair_counts(rows), "pairs").select("a", "b", "docs", F.col("top").cast("long").alias("top"))
    postings = rows.filter("level is not null").select("a", "b", "block", "level", "n", "bits")
    parts = max(24, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    returned = (hot_join(postings, scores, ["a", "b"]).select("block", "level", "n", "bits", "docs", "top")
                .repartition(parts, "block").sortWithinPartitions("block")
                .mapInArrow(_scored, "block long, place int, count_sum long, n_best long"))
    texts = rows.filter("place is not null").select(
        "block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return texts.join(returned, ["block", "place"], "left").select(
        F.col("doc_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256")
