"""Learned operators: held-out accuracy on the given tables, and odd rows."""

import numpy as np
import pytest
from corpus_tables import docs, odd_rows  # noqa: F401

from portolan.llm import language, quality, toxicity
from portolan.llm.queries import table

SMALL = "/root/testdata/sf0.01"


def test_quality_is_learned_and_held_out(spark, docs, odd_rows):
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    part = language.part_of("doc_id", 5)
    net = quality.train(documents, labels, part != 0)
    assert 0.5 <= net.temperature <= 8
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.scored(documents, net, part == 0).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) >= 0.95
    odd = quality.scored(docs(odd_rows), net, part == 0).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in odd)
    kept = quality.accepted(docs(odd_rows), net)
    assert kept.columns == docs(odd_rows).columns and kept.count() == sum(r.predicted for r in odd)
    assert quality.scored(docs([]), net, part == 0).count() == 0
    empty = quality.train(docs([]), labels.limit(0), part != 0)
    assert quality.scored(docs(odd_rows), empty, part == 0).count() == len(odd_rows)


def test_languages_are_learned_and_mixed(spark, docs, odd_rows):
    documents = table(spark, SMALL, "documents")
    part = language.part_of("doc_id", 4)
    model = language.train(documents.filter(part != 2))
    assert model.languages == ["de", "en", "es", "fr"]
    truth = {r.doc_id: r.lang for r in documents.collect()}
    rows = [r for r in language.languages_of(documents, model, part == 2).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) >= 0.95
    odd = {r.doc_id: r for r in language.languages_of(docs(odd_rows), model, part == 2).collect()}
    assert odd[1].lang_pred == odd[2].lang_pred == odd[3].lang_pred == "und" and odd[1].score == 0
    assert odd[4].lang_pred in model.languages and 0 <= odd[4].score <= 1
    signs = language.languages_of(docs([(1, "123 --- 45", "en", "a"), (2, "漢字", "en", "a")]), model, part == 2)
    assert {r.doc_id: r.lang_pred == "und" for r in signs.collect()} == {1: True, 2: False}
    nothing = language.train(docs([(1, None, "en", "a"), (2, "x", None, "a")]))
    assert {r.lang_pred for r in language.languages_of(docs(odd_rows), nothing, part == 2).collect()} == {"und"}
    assert language.languages_of(docs([]), model, part == 2).count() == 0


def test_mixture_inference_finds_the_proportions():
    # two languages with clear words, a third that explains nothing
    like = np.array([[1.0, 0.01, 0.02]] * 70 + [[0.01, 1.0, 0.02]] * 30 + [[1.0, 0.01, 0.02]] * 10, np.float32).T
    share = language.proportions(like, np.array([0, 100, 100, 110]), 8)
    assert share[0, 0] == pytest.approx(0.7, abs=0.05) and share[2, 0] == 0
    assert share[:, 2].tolist() == [1, 0, 0]


def test_toxicity_is_learned_and_held_out(spark, docs, odd_rows):
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    part = language.part_of("doc_id", 4)
    machine = toxicity.train(documents, labels, part != 2)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.scored(documents, machine, part == 2).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) >= 0.9
    odd = toxicity.scored(docs(odd_rows), machine, part == 2).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.scored(docs([]), machine, part == 2).count() == 0
    empty = toxicity.train(docs([]), labels.limit(0), part != 2)
    assert toxicity.scored(docs(odd_rows), empty, part == 2).count() == len(odd_rows)


def test_pairs_of_terms_can_outweigh_the_terms():
    # toxic only together: an additive model cannot separate this
    draw = np.random.default_rng(11)
    a, b = draw.random(2000) < 0.5, draw.random(2000) < 0.5
    y = (a & b).astype(float)
    row = np.concatenate([np.flatnonzero(a), np.flatnonzero(b)])
    bucket = np.concatenate([np.full(a.sum(), 1), np.full(b.sum(), 2)])
    machine = toxicity.fit_machine(row, bucket, y, toxicity.Settings())
    z = machine.logits(row, machine.place[bucket], 2000)
    assert ((z > 0) == (y > 0)).all()
    assert (machine.factors[machine.place[1]] @ machine.factors[machine.place[2]]) > 0


def test_any_number_of_languages_and_no_letters(spark, docs):
    rows = [(i, f"qx{i:03d}w zy{i:03d}v " .translate(str.maketrans("0123456789", "abcdefghij")) * 4, f"l{i}", "s")
            for i in range(600)]
    table = docs(rows)
    model = language.train(table)
    assert len(model.languages) == 600
    got = {r.doc_id: r.lang_pred for r in language.languages_of(table.limit(40), model, language.part_of("doc_id", 4) == 2)
           .collect()}
    assert sum(got[i] == f"l{i}" for i in got) >= 0.9 * len(got)
    odd = docs([(1, "²³ ½ ①", None, "s"), (2, "12 34 !", None, "s"), (3, "漢", None, "s")])
    told = {r.doc_id: (r.lang_pred, r.score) for r in language.languages_of(
        odd, model, language.part_of("doc_id", 4) == 2).collect()}
    assert told[1] == told[2] == ("und", 0.0) and told[3][0] != "und"
