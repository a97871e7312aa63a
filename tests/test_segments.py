import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from portolan.functions.text import TOKEN, tokens
from portolan.operators import search
from portolan.streaming.segments import SegmentedIndex

WORDS = ["alpha", "beta", "Gamma", "delta", "x1", "決済", "ÜBER"]
QUERY = "alpha GAMMA 済 nothing"


def _docs(draw, keys):
    return [(k, draw.choice("pq"), " ".join(draw.choices(WORDS, k=draw.randint(0, 9))) if draw.random() > 0.1 else None)
            for k in keys]


def _rows(df):
    return [tuple(r) for r in df.select("id", "score").collect()]


def test_batches_rewrites_and_merges_equal_a_scan(spark, tmp_path):
    draw = random.Random(8)
    index = SegmentedIndex(spark, str(tmp_path / "index"), "id", "text", ("kind",), fanout=2)
    held = {}
    for batch, keys in enumerate([range(40), range(30, 60), range(0, 60, 7), range(60, 64), [1, 2]]):
        docs = _docs(draw, keys)
        held |= {d[0]: d for d in docs}
        frame = spark.createDataFrame(docs, "id bigint, kind string, text string")
        index.add(frame, batch)
        index.add(frame.limit(0), batch)  # a replay does nothing
        whole = spark.createDataFrame(list(held.values()), "id bigint, kind string, text string")
        assert _rows(index.search(QUERY, 12)) == _rows(search.scan_search(whole, "id", "text", QUERY, 12)), batch
        some = search.scan_search(whole.where("kind = 'p'"), "id", "text", QUERY, 12)
        assert _rows(index.search(QUERY, 12, F.col("kind") == "p")) == _rows(some)
    assert max(r.level for r in index.state()) == 2
    assert sum(r.documents for r in index.state()) == sum(d[2] is not None for d in held.values())
    assert index.search("???", 5).collect() == []


def test_a_search_reads_its_terms_only(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "index"), "id", "text")
    index.add(spark.createDataFrame([(1, "one two"), (2, "two")], "id bigint, text string"), 0)
    plan = plan_of(index.search("two", 5))
    assert "term" in plan and "EqualTo(term,two)" in plan
    assert "EqualTo(term,)" not in plan  # no posting per document


def test_empty_batches(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "index"), "id", "text")
    with pytest.raises(ValueError):
        index.search("one", 5)
    none = spark.createDataFrame([], "id bigint, text string")
    index.add(none, 0)
    index.add(spark.createDataFrame([(1, "one")], "id bigint, text string"), 1)
    index.add(none, 2)
    assert [r.id for r in index.search("one", 5).collect()] == [1]
    index.add(spark.createDataFrame([(1, None)], "id bigint, text string"), 3)
    assert index.search("one", 5).collect() == []


def test_short_texts_are_dealt_once(spark, tmp_path):
    """The same index by one shuffle; keys that repeat or are NULL count as they did."""
    docs = [(1, "p", "a b a"), (1, "p", "a b a"), (2, "q", "a"), (2, "q", "c c"), (None, None, "b"), (3, "p", None), (4, "p", "")]
    frame = spark.createDataFrame(docs, "id bigint, kind string, text string")
    short = search.postings(frame, "id", "text", "kind", by_range=True)
    assert plan_of(short, "simple").count("Exchange") == 1 and "rangepartitioning" in plan_of(short)
    assert sorted(map(str, short.collect())) == sorted(map(str, search.postings(frame, "id", "text", "kind").collect()))
    for name, flag in (("long", False), ("short", True)):
        search.write_index(frame, "id", "text", str(tmp_path / name), "b", "kind", short=flag)
    long, short = (sorted(map(str, spark.read.parquet(str(tmp_path / n)).collect())) for n in ("long", "short"))
    assert long == short


def test_long_texts_are_dealt_once(spark, tmp_path):
    """One shuffle whatever the texts' length; each file of the index holds its own range of terms."""
    docs = [(i, " ".join(f"w{(i * j) % 97} the" for j in range(i))) for i in range(60)]
    docs += [(7, docs[7][1]), (None, "the w1"), (60, "the " * 500), (61, None)]
    frame = spark.createDataFrame(docs, "id bigint, text string")
    rows = search.postings(frame, "id", "text")
    assert plan_of(rows, "simple").count("Exchange") == 1 and "rangepartitioning" in plan_of(rows)
    counted = Counter((term, key) for key, text in docs if text is not None for term in [*text.split(), ""])
    assert {(r.term, r.id): r.tf for r in rows.collect()} == counted
    search.write_index(frame, "id", "text", str(tmp_path / "index"), "b")
    index = spark.read.parquet(str(tmp_path / "index"))
    files = index.groupBy(F.input_file_name()).agg(F.min("term").alias("first"), F.max("term").alias("last")).orderBy("first", "last")
    spans = [(r.first, r.last) for r in files.select("first", "last").collect()]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_texts_are_cut_where_tokens_end(spark):
    """Cutting gives what matching gives, for every code point alone, in words, doubled and beside signs."""
    char = F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")
    chars = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343").select(char.alias("c"))
    shapes = F.array("c", F.concat(F.lit("A"), "c", F.lit("b 9")), F.concat("c", "c", F.lit(" x")), F.concat(F.lit("の"), "c", F.lit("済x")))
    texts = chars.select(F.explode(shapes).alias("text"))
    cut = texts.select("text", tokens(F.col("text")).alias("cut"))
    assert "split(" in plan_of(cut, "simple")
    matched = F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))
    assert cut.count() == 4 * (0x110000 - 2048) and cut.where(~F.col("cut").eqNullSafe(matched)).count() == 0
    odd = spark.createDataFrame([(None,), ("",), (" -",), ("-a-",), ("İ Σς",)], "text string")
    assert [r[0] for r in odd.select(tokens(F.col("text"))).collect()] == [r[0] for r in odd.select(matched).collect()]
