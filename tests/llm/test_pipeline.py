"""Oracles of the corpus queries, and the pipeline against brute force."""

from collections import Counter

import duckdb
import pytest
from corpus_tables import docs, odd_rows  # noqa: F401

import __spark_entry__ as entry_module
import corpus_pipeline
from portolan.llm.queries import ORACLES, QUERIES
from portolan.llm.shingle_join import near_texts

TABLES = "documents embeddings pages benchmark labels".split()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(name, spark, data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, data)
    assert sorted(df.columns) == sorted(names)
    expected = sorted(result.fetchall(), key=str)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=str) == expected


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_module.queries())
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mix", "packing"]


def test_stages_take_effect(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], data).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
        if name != "packing":
            assert kept[-1].columns == columns
    source, good, single, clean, mixed, packed = [d.collect() for d in kept]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    assert {r.doc_id for r in good} <= {r.doc_id for r in source}
    lost = {r.doc_id for r in source} - {r.doc_id for r in good}
    assert all(labels[i] == 0 for i in lost if i in labels)
    assert not any(labels.get(r.doc_id) == 0 for r in good)

    def grams(text):
        w = text.split()
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}

    sets = {r.doc_id: grams(r.text) for r in single}
    assert not any(a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) for a in sets for b in sets)
    before = {r.doc_id: r.text for r in single}
    windows = Counter(tuple(w[k:k + 35]) for w in (t.split() for t in before.values()) for k in range(len(w) - 34))
    for r in clean:
        w = before[r.doc_id].split()
        gone = {j for k in range(len(w) - 34) if windows[tuple(w[k:k + 35])] > 1 for j in range(k, k + 35)}
        assert r.text.split() == [x for j, x in enumerate(w) if j not in gone]
    text = {r.doc_id: r.text for r in clean}
    often = Counter(r.doc_id for r in mixed)
    assert max(often.values()) <= 3 and all(r.text == text[r.doc_id] for r in mixed)
    words = Counter()
    for r in packed:
        words[r.doc_id] += r.n_words
    assert words == Counter({i: n * len(text[i].split()) for i, n in often.items() if text[i].split()})
    result = corpus_pipeline.run(spark, data)
    assert sorted(map(str, result.drop("bin_id").collect())) == sorted(
        str(r) for r in kept[-1].drop("bin_id").collect())


def test_stages_on_odd_rows(spark, data, docs, odd_rows):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    now = docs(odd_rows).select(*columns)
    for name, stage in corpus_pipeline.STAGES[1:]:
        now = stage(spark, now, data)
        assert name == "packing" or now.columns == columns
        now.count()
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs([]).select(*columns), data).count() == 0


def test_near_duplicates_go_by_text_and_not_by_id(spark, data, docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(100)) for k in "abcd")
    near = lambda t: t + " more"
    rows = [(5, a), (5, b), (9, b), (12, near(b)), (20, near(a)), (5, a), (None, c), (None, c), (None, near(c)),
            (None, d), (30, near(d)), (5, ""), (None, None)]
    table = docs([(*r, "en", "s") for r in rows]).select(*columns)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, table, data).collect())
    of_c = [t for t in (c, near(c)) if (None, t) in got]
    assert len(of_c) == 1
    assert got == Counter([(5, a), (5, b), (None, of_c[0]), (30, near(d)), (5, ""), (None, None)])
    links = Counter((r.doc_id, r.n_links, r.class_id, r.kept) for r in near_texts(table).collect())
    assert links == Counter({
        (5, 2, 5, True): 3, (9, 2, 5, False): 1, (12, 2, 5, False): 1, (20, 2, 5, False): 1, (None, 2, None, False): 3,
        (None, 1, None, False): 1, (30, 1, 30, True): 1, (5, 0, 5, True): 1, (None, 0, None, False): 1})


def test_packing_query_keeps_near_copies_apart_and_full_bins_single(spark, docs, tmp_path):
    group = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    near = [(i, f"{group('g', 100)} end{i}", "en", f"s{i}") for i in range(6)]
    near += [(7, group("h", 90), "en", "s7"), (7, f"{group('g', 100)} more", "en", "s8"), (None, f"{group('g', 100)} also", "en", "s9")]
    full = [(None, group(f"f{k}x", 2048 + k % 2), "en", "s") for k in range(4)] + [(50, group(f"e{k}x", 4096), "en", "s") for k in range(2)]
    full += [(51, group("k", 2048), "en", "s"), (51, group("k", 2048) + " a", "en", "s"), (51, group("k", 2048), "en", None)]
    docs(near + full).write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op7_best_fit_packing"](spark, str(tmp_path)).collect()
    words, copies = Counter(), Counter()
    for r in out:
        words[r.bin_id] += r.n_words
        copies[r.bin_id] += r.n_words == 101  # the near copies, and no other piece
    assert sum(words.values()) == sum(len(t.split()) for _, t, _, _ in near + full)
    assert max(words.values()) <= 2048
    assert max(copies.values()) == 1 and sum(copies.values()) == 8
