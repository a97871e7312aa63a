"""Alignment of two tokenizers against whole-text tokenizing and loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus_tables import docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from portolan.llm import alignment
from portolan.llm.alignment import BYTE_MODEL, PIECE_MODEL, aligned, bitmaps, packed, pair_counts, unpacked


@pytest.fixture(scope="module")
def models():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    byte = Tokenizer.from_file(BYTE_MODEL)
    byte.encode_special_tokens = True
    return byte, SentencePieceProcessor(model_file=PIECE_MODEL)


def spans(models, text):
    byte, piece = models
    signs = alignment.byte_signs()
    a = byte.encode(" " + text, add_special_tokens=False).ids
    b = piece.encode(text)
    bytes_a = [bytes(signs[c] for c in byte.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(piece.id_to_piece(i)[3:5], 16)]) if piece.is_byte(i)
               else piece.id_to_piece(i).replace("▁", " ").encode() for i in b]
    raw = (" " + text).encode()
    if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return [], [], [], []
    return a, b, np.cumsum([0, *map(len, bytes_a)]).tolist(), np.cumsum([0, *map(len, bytes_b)]).tolist()


def brute(models, rows):
    """Per row the contract's columns, by loops over whole texts."""
    links, shapes = [], []
    for _, text in rows:
        a, b, at_a, at_b = spans(models, text or "")
        own = []
        j0 = 0
        for i, x in enumerate(a):
            while j0 < len(b) and at_b[j0 + 1] <= at_a[i]:
                j0 += 1
            j = j0
            while j < len(b) and at_b[j] < at_a[i + 1]:
                own.append((x, b[j]))
                j += 1
        links.append(own)
        groups, ga, gb, i, j = [], [], [], 0, 0
        for cut in sorted(set(at_a) & set(at_b) - {0}):
            while i < len(a) and at_a[i + 1] <= cut:
                ga.append(str(a[i]))
                i += 1
            while j < len(b) and at_b[j + 1] <= cut:
                gb.append(str(b[j]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
            ga, gb = [], []
        shapes.append((len(a), len(b), groups))
    count = Counter(p for own in links for p in set(own))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (ident, _), own, (n_a, n_b, groups) in zip(rows, links, shapes, strict=True):
        out.append((ident, n_a, n_b, len(groups), len(own), sum(count[p] == most[p[0]] for p in own),
                    sum(count[p] for p in own),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return out, links, count


ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", "  two  spaces   three ", "tab\tline\n\n end   x", "   ",
       "don't we'll it's I'M 12345 3.14 !!! ...", "漢字かな交じり文 と 空白 한국어", "　wide   space x y", "x\x00y \x7f z",
       "naïve café à la é è à \u0085 z", "🙂 🙂🙃 é ﬁ ①", "  ogham   y", "aaaaaaaaaaaaaaaaaaaa" * 50, " ", "\n", "q"]


def random_texts():
    draw = random.Random(4)
    signs = list(" \t\n'.,aeé 　漢🙂1Z-_àж̀")
    return ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(300)]


def test_equals_whole_text_tokenizing(spark, docs, odd_rows, models):  # noqa: F811
    rows = [(r[0], r[1]) for r in odd_rows] + list(enumerate(ODD, 100)) + list(enumerate(random_texts(), 1000))
    rows += [(100, ODD[0]), (None, ODD[0])]
    table = docs([(i, t, "en", "s") for i, t in rows]).withColumn("block", F.lit(1)).withColumn("a", F.lit("x"))
    got = [tuple(r) for r in aligned(table.repartition(3)).collect()]
    expected, links, count = brute(models, rows)
    assert sorted(got, key=str) == sorted(expected, key=str)
    pairs = {(r.a, r.b): (r.docs, r.links)
             for r in pair_counts(bitmaps(table, "doc_id", "text", BYTE_MODEL, PIECE_MODEL)).collect()}
    total = Counter(p for own in links for p in own)
    assert pairs == {p: (count[p], total[p]) for p in count}


def test_many_documents_and_small_blocks(spark, docs, models, monkeypatch):  # noqa: F811
    rows = [(i, f"the same words w{i % 7} again again the") for i in range(900)]
    expected = brute(models, rows)[0]
    table = docs([(i, t, "en", "s") for i, t in rows])
    assert sorted(tuple(r) for r in aligned(table).collect()) == expected
    assert aligned(table.limit(0)).count() == 0


def test_bitmaps_round_trip():
    draw = np.random.default_rng(2)
    sizes = [1, 2, alignment.DENSE - 1, alignment.DENSE, alignment.DENSE + 1, alignment.BLOCK]
    pair = np.repeat(np.arange(len(sizes)), sizes)
    place = np.concatenate([np.sort(draw.choice(alignment.BLOCK, n, replace=False)) for n in sizes])
    got = []
    for lo, hi, bits in packed(pair, place, rows=4):
        assert isinstance(bits, pa.Array)
        at, run = unpacked(bits, hi - lo)
        got += [(int(pair[lo[r]]), int(p)) for p, r in zip(at, run, strict=True)]
    assert sorted(got) == sorted(zip(pair.tolist(), place.tolist(), strict=True))


def test_block_closes_early():
    block = alignment.Block(3)
    block.add(np.array([0, 0, 1]), np.array([5, 9, 5]), np.array([1, 6, 2]))
    rows = [r for b in block.bitmaps() for r in b.to_pylist()]
    weight = Counter()
    for r in rows:
        weight[r["b"]] += r["n"] << max(r["level"] - 1, 0)
    assert weight == {5: 3, 9: 6} and {r["block"] for r in rows} == {3}
