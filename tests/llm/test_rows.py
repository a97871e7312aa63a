"""Operators on rows: URL rules, mixing, packing, line rules, passages."""

import hashlib
import random
from collections import Counter

import pytest
from corpus_tables import docs, odd_rows  # noqa: F401

from portolan.llm import line_rules, mixing, packing, passages, url_rules


def test_url_rules_equal_brute_force(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/"), ("block", "a.b.com/"), ("allow", "b.com/x"), ("block", "net/")]
    draw = random.Random(5)
    hosts = ["org", "example.org", "www.example.org", "xexample.org", "a.b.com", "b.com", "z.b.com", "EXAMPLE.Org", "net", "t.net."]
    paths = ["", "/", "/es/1", "/en/1", "/en/12", "/fr/", "/de/9?q=1", "/x#y", "?a=://b", "/xy/"]
    rows = [(i, f"http{draw.choice(['', 's'])}://{draw.choice(hosts)}{draw.choice(paths)}", "h") for i in range(400)]
    rows += [(900, None, ""), (901, "no scheme", ""), (902, "", ""), (None, "http://www.example.org/es/", "")]
    rows += [(903, "http://a.b.com/", "")] * 50
    table = spark.createDataFrame(rows, "page_id long, url string, key string")
    got = url_rules.url_verdicts(table, url_rules.rule_table(spark, rules), n_sample=50).collect()
    assert len(got) == len(rows)
    for r in got:
        best = None
        for verdict, text in rules:
            host, _, path = text.partition("/")
            if (r.host == host or r.host.endswith("." + host)) and r.path.startswith("/" + path):
                best = max(best or (0, ""), (len(text), text, verdict))
        assert (r.rule, r.verdict) == ((best[1], best[2]) if best else (None, "allow"))
    by = {r.id: r for r in got}
    assert (by[900].host, by[901].path, by[902].host) == ("", "", "")
    assert by[None].rule == "example.org/es/"
    empty = url_rules.url_verdicts(table.limit(0), url_rules.rule_table(spark, rules))
    assert empty.count() == 0
    none = url_rules.url_verdicts(table, url_rules.rule_table(spark, rules).limit(0), default="block")
    assert {r.verdict for r in none.collect()} == {"block"}


def test_mix_reaches_targets_with_limits(spark, docs):
    draw = random.Random(6)
    rows = [(i, " ".join(["w"] * draw.randint(1, 60)), "en", draw.choice(["a", "a", "a", "b", "c", None]))
            for i in range(1500)] + [(9999, "x " * 2, "en", "d"), (9998, None, "en", "e")]
    out = mixing.mixed(docs(rows)).collect()
    assert len(out) == len(rows)
    total = sum(r.size for r in out)
    targets = {r.source: (r.target, r.source_size) for r in out}
    assert abs(sum(t for t, _ in targets.values()) - total) < 1e-6 * total
    for source, (target, size) in targets.items():
        assert target <= 3 * size + 1e-9
        taken = sum(r.taken for r in out if r.source == source)
        assert abs(taken - target) <= 60
    assert targets["d"][0] == 3 * targets["d"][1] and targets["e"] == (0.0, 0)
    assert all(r.taken <= 3 * r.size for r in out)
    again = mixing.mixed(docs(random.Random(1).sample(rows, len(rows)))).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in out)
    corpus = mixing.repeated(docs(rows))
    assert corpus.columns == docs(rows).columns
    assert Counter(r.doc_id for r in corpus.collect()) == Counter({r.doc_id: r.copies for r in out if r.copies})


def test_mix_of_odd_and_empty_tables(docs, odd_rows):
    out = mixing.mixed(docs(odd_rows)).collect()
    assert len(out) == len(odd_rows) and sum(r.size for r in out if r.doc_id == 6) == 30_000
    repeated = mixing.repeated(docs(odd_rows))
    assert repeated.columns == docs(odd_rows).columns and repeated.count() > 0
    assert mixing.mixed(docs([])).count() == 0 and mixing.repeated(docs([])).count() == 0
    assert [r.taken for r in mixing.mixed(docs([(1, None, "en", None)])).collect()] == [0]


def brute_pack(items, capacity, same_source):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for size, source, cluster in items:
        fits = [b for b in range(len(bins)) if capacity - sum(x[0] for x in bins[b]) >= size
                and cluster not in [x[2] for x in bins[b]] and [x[1] for x in bins[b]].count(source) < same_source]
        best = min(fits, key=lambda b: (capacity - sum(x[0] for x in bins[b]), b), default=None)
        if best is None:
            bins.append([])
            best = len(bins) - 1
        bins[best].append((size, source, cluster))
        out.append(best)
    return out


@pytest.mark.parametrize("same_source", [1, 2])
def test_packer_equals_brute_force(same_source):
    draw = random.Random(7)
    items = sorted(((draw.randint(1, 99), draw.randrange(6), draw.randrange(40)) for _ in range(300)), reverse=True)
    packer = packing.Packer(100, same_source)
    source_bits = packing._bits([s for _, s, _ in items])
    cluster_bits = packing._bits([c for _, _, c in items])
    got = [packer.put(size, s, c)[0] for (size, _, _), s, c in zip(items, source_bits, cluster_bits, strict=True)]
    assert got == brute_pack(items, 100, same_source)


def test_packing_keeps_all_words_and_conflicts_apart(spark, docs, odd_rows):
    draw = random.Random(8)
    rows = [(100 + i, " ".join([f"t{i % 90}"] * draw.randint(1, 300)), "en", f"s{i % 4}") for i in range(400)] + odd_rows
    bins = packing.Bins(capacity=256, shard_rows=100)
    out = packing.packed(docs(rows), bins).collect()
    words = Counter()
    for i, text, _, _ in rows:
        words[i] += len((text or "").split())
    got = Counter()
    for r in out:
        got[r.doc_id] += r.n_words
    assert {k: v for k, v in words.items() if v} == got
    text_of = {i: t for i, t, _, _ in rows}
    held = {}
    for r in out:
        held.setdefault(r.bin_id, []).append(r)
    for own in held.values():
        own.sort(key=lambda r: r.place)
        assert sum(r.n_words for r in own) <= 256
        assert [r.place for r in own] == [sum(x.n_words for x in own[:k]) for k in range(len(own))]
        texts = [text_of[r.doc_id] for r in own if r.doc_id is not None]
        assert len(texts) == len(set(texts))
    pieces = {}
    for r in out:
        pieces.setdefault((r.doc_id, r.copy), []).append((r.first_word, r.n_words))
    for own in pieces.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
    named = spark.createDataFrame([(i, 1) for i in range(100, 110)], "doc_id long, cluster long")
    tied = [r for r in packing.packed(docs(rows), bins, named).collect() if r.doc_id in range(100, 110) and r.n_words < 256]
    assert len({r.bin_id for r in tied}) == len(tied)
    assert packing.packed(docs([])).count() == 0


def test_line_rules_count_and_reject(docs, odd_rows):
    common = "This line stands in many documents of the host"
    own = "\n".join(" ".join(f"u{k}x{j}" for j in range(12)) for k in range(6))
    rows = [(20 + i, f"{common}\n{own.replace('u', f'v{i}')}\n  {common.upper()} \n", "en", "big") for i in range(40)]
    rows += [(100 + i, "\n".join([common] * 1 + [f"only {i}"] * 2), "en", "big") for i in range(30)]
    boiler = "\n".join(" ".join(f"b{k}x{j}" for j in range(12)) for k in range(6))
    rows += [(200 + i, boiler, "en", "big") for i in range(25)] + [(300, boiler, "en", "small")]
    got = {r.doc_id: r for r in line_rules.judged(docs(rows + odd_rows)).collect()}
    assert all(got[20 + i].kept and got[20 + i].n_common_words == 18 for i in range(40))
    assert all(got[100 + i].base_failed and got[100 + i].n_dup_lines == 1 for i in range(30))
    assert all(not got[200 + i].kept and not got[200 + i].base_failed for i in range(25))
    assert got[300].kept  # the same lines are rare on another host
    assert (got[1].n_words, got[1].kept, got[3].n_words) == (0, False, 0)
    assert got[8].n_repeat_words == got[8].n_words and got[8].base_failed
    assert (got[9].word_chars, got[9].n_symbols) == (len("größestraße漢字かな!!!"), 0)
    assert got[6].n_words == 30_000 and got[6].kept
    assert len(line_rules.judged(docs(rows + odd_rows)).collect()) == len(rows + odd_rows)
    assert line_rules.judged(docs([])).count() == 0


def test_line_rules_cut_common_lines_from_the_text(docs, odd_rows):
    draw = random.Random(4)
    common = ["Home | About  us", "größe der straße", "All rights reserved"]
    rows = []
    for i in range(60):
        lines = [draw.choice([*common, common[0].upper(), "", "  "] + [f"own {i} line {k}" for k in range(4)])
                 for _ in range(draw.randint(1, 9))]
        rows.append((100 + i, "\n".join(lines), "en", "big"))
    rows += [(200 + i, "\n".join(common), "en", "big") for i in range(30)] + [(300, "\n".join(common), "en", "small")]
    rows += [(301, f"{common[0]}\n\nmine\n{common[1]}\n{common[2]}", "en", "big")] * 2
    plain = lambda line: " ".join(line.split()).lower()
    cut = {plain(c) for c in common}
    got = line_rules.judged(docs(rows + odd_rows)).collect()
    assert len(got) == len(rows + odd_rows)

    def left(text, host):
        return text and "\n".join(x for x in text.split("\n") if host != "big" or plain(x) not in cut)

    want = Counter((i, left(t, h), len((t or "").split()) - len((left(t, h) or "").split())) for i, t, _, h in rows + odd_rows)
    assert Counter((r.doc_id, r.left_text, r.n_common_words) for r in got) == want


def brute_passages(rows, width):
    split = [(t or "").split() for _, t in rows]
    count = Counter(tuple(w[k:k + width]) for w in split for k in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        keep = [True] * len(w)
        for k in range(len(w) - width + 1):
            if count[tuple(w[k:k + width])] > 1:
                keep[k:k + width] = [False] * width
        left = " ".join(x for x, f in zip(w, keep, strict=True) if f)
        out.append((i if i is not None else -1, len(w), keep.count(False), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("graph", [passages.Graph(), passages.Graph(width=8, seed=3)])
def test_passages_equal_brute_force(docs, odd_rows, graph):
    draw = random.Random(9)
    word = lambda n: [f"k{draw.randrange(n)}" for _ in range(draw.randint(5, 90))]
    shared = [word(50) for _ in range(6)]
    rows = []
    for i in range(150):
        text = []
        for _ in range(draw.randint(1, 5)):
            piece = draw.choice([word(10**6), draw.choice(shared), draw.choice(shared)[10:], ["la"] * draw.randint(1, 80),
                                 ["a", "b"] * draw.randint(1, 50), ["p", "q", "r"] * draw.randint(1, 30)])
            text += piece
        rows.append((i, " ".join(text)))
    rows += [(i, t) for i, t, _, _ in odd_rows]
    out = passages.without_repeats(docs([(*r, "en", "s") for r in rows]), graph)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect())
    assert got == brute_passages(rows, graph.width)


def test_passages_leave_clean_texts_alone(docs):
    text = "some  text\nwith its own\tspacing"
    rows = passages.without_repeats(docs([(1, text, "en", "a"), (2, None, "en", "a")])).collect()
    assert {r.doc_id: r.stripped for r in rows} == {1: text, 2: None}
    assert passages.without_repeats(docs([])).count() == 0


def test_repeated_rows_without_ids_share_their_spans_once(docs):
    text = " ".join(f"v{i}" for i in range(60))
    table = docs([(None, text, "en", "a")] * 40)
    assert passages.repeated_spans(table.selectExpr("xxhash64(doc_id, text) AS row", "text")).distinct().count() >= 1
    got = passages.without_repeats(table).collect()
    assert len(got) == 40 and all(r.n_removed == r.n_words == 60 for r in got)
