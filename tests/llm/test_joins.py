"""Both similarity joins against brute force, with groups, blocks, gaps and odd rows."""

import random

import numpy as np
import pytest
from corpus_tables import docs, odd_rows  # noqa: F401

from portolan.llm.links import components
from portolan.llm.near_vectors import Plan, near_vectors
from portolan.llm.shingle_join import Forest, near_texts, shared


def reach(n, links):
    label = {v: v for v in n}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 202), (202, 203), (203, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges + [(5, 5)], "a long, b long")).collect()}
    nodes = {v for e in edges for v in e}
    assert got == reach(nodes, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows):
    usable = {i: np.array(v, float) / np.abs(v).max() for i, v in rows
              if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a in usable for b in usable if a != b and len(usable[a]) == len(usable[b])
             and usable[a] @ usable[b] / np.linalg.norm(usable[a]) / np.linalg.norm(usable[b]) >= 0.95]
    label = reach([i for i, _ in rows], links)
    return {i: (sum(a == i for a, _ in links), label[i], label[i] == i) for i, _ in rows}


@pytest.mark.parametrize("plan", [Plan(), Plan(cell_rows=16, block_rows=16)])
def test_near_vectors_equal_brute_force(spark, plan):
    draw = np.random.default_rng(1)
    rows, i = [], 0
    for _ in range(12):
        centre = draw.standard_normal(24)
        for _ in range(int(draw.integers(1, 25))):
            rows.append((i, (centre + draw.uniform(0.02, 0.08) * draw.standard_normal(24)).tolist()))
            i += 1
    rows += [(1000, rows[0][1]), (1001, (2 * np.array(rows[0][1])).tolist()), (1002, None), (1003, [0.0] * 24),
             (1004, [None] + [1.0] * 23), (1005, [float("nan")] * 24), (1006, [float("inf")] + [1.0] * 23),
             (1007, [1.0, 0.0]), (1008, [1.0, 0.01]), (1009, []), (1010, [1e200] * 24), (1011, [1e-200] * 24)]
    random.Random(2).shuffle(rows)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                  "vec_id long, embedding array<double>, node int, v string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(table, plan=plan).collect()}
    expected = brute_vectors(rows)
    found, wanted = sum(x[0] for x in got.values()), sum(x[0] for x in expected.values())
    assert all(got[i][0] <= expected[i][0] for i in got)
    assert found >= 0.9 * wanted  # recall; no link below the threshold
    if found == wanted:
        assert got == expected
    for i in range(1002, 1007):
        assert got[i] == (0, i, True)


def test_vectors_without_rows_ids_or_partners(spark):
    schema = "vec_id long, embedding array<float>"
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = near_vectors(spark.createDataFrame([(None, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])], schema)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in rows) == [
        (-1, 0, None, False), (3, 1, 3, True), (3, 1, 3, True)]


def test_plan_follows_threshold_and_recall():
    assert 0 < Plan().needed < Plan().n_lines
    assert Plan(recall=0.9).needed >= Plan(recall=0.999).needed
    assert Plan().dealt_over(10**9).n_cuts > Plan().dealt_over(10**5).n_cuts > Plan().dealt_over(10).n_cuts == 0
    assert Plan().dealt_over(10**9).overlap >= Plan().dealt_over(10**5).overlap > 0


def brute_texts(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links = [(a, b) for a in sets for b in sets if a != b and sets[a] and sets[b]
             and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    label = reach(sets, links)
    return {i: (sum(a == i for a, _ in links), label[i], label[i] == i) for i in sets}


@pytest.mark.parametrize("forest", [Forest(), Forest(block_rows=8), Forest(block_shingles=300)])
def test_near_texts_equal_brute_force(spark, docs, forest):
    draw = random.Random(3)
    rows, i = [], 0
    for g in range(15):
        base = [f"g{g}x{k}" for k in range(draw.randint(6, 200))]
        for _ in range(draw.randint(1, 30)):
            text = list(base)
            for _ in range(draw.randint(0, 3)):
                text[draw.randrange(len(text))] = f"n{draw.randrange(10**6)}"
            rows.append((i, " ".join(text)))
            i += 1
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "a  b"), (905, "a b c"), (906, rows[0][1])]
    got = {r.doc_id: (r.n_links, r.class_id, r.kept) for r in near_texts(docs([(*r, "en", "s") for r in rows]), forest).collect()}
    assert got == brute_texts(rows)


def test_odd_texts(spark, docs, odd_rows):
    rows = near_texts(docs(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert got[5].class_id == 4 and not got[5].kept and got[4].n_links == 1
    assert got[7].n_links == 1 and got[1].n_links == 0 and got[1].kept
    assert all(r.class_id is None and not r.kept for r in rows if r.doc_id is None)
    assert near_texts(docs([])).count() == 0


def test_prefixes_are_shortened_until_the_recall_is_reached():
    f = Forest()
    assert 1 - (1 - 0.8**f.depth) ** f.trees >= f.recall > 1 - (1 - 0.8 ** (f.depth + 1)) ** f.trees
    assert Forest(trees=2).depth < f.depth


def test_shared_counts_all_pairs():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 60, draw.integers(0, 40))) for _ in range(9)]
    for cells in (20, 1 << 20):
        got = shared(sets, cells)
        for a in range(9):
            for b in range(9):
                if a != b:
                    assert got[a, b] == len(set(sets[a]) & set(sets[b]))
