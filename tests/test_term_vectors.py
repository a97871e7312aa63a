import math
import random

from portolan.functions.text import token_list
from portolan.operators import term_vectors

MARKS = {"Dispute": ["complaint", "amount"], "Sanctions": ["sanctions", "review"]}


def _label(spark, notes, **options):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(notes)], "id int, note string")
    out = term_vectors.label_by_related_terms(df, "note", MARKS, "Standard", **options)
    assert out.columns == ["id", "note", "classification"]
    return [r.classification for r in out.orderBy("id").collect()]


def _brute(notes, min_notes):
    """The same with dictionaries, from the definition."""
    sets = [set(token_list(n)) for n in {n for n in notes if n is not None}]
    total, words = len(sets), set().union(*sets)
    n = {w: sum(w in s for s in sets) for w in words}

    def related(t, w):
        both = sum(t in s and w in s for s in sets)
        if both < min_notes or both == total:
            return 0.0
        return max(0.0, math.log(both * total / (n[t] * n[w])) / -math.log(both / total))

    out = []
    for note in notes:
        if note is None:
            out.append(None)
            continue
        score = {label: round(sum(sum(related(t, w) for w in marks) / len(marks) for t in token_list(note)), 6)
                 for label, marks in MARKS.items()}
        out.append(max(score, key=score.get) if max(score.values()) > 0 else "Standard")
    return out


def test_a_note_without_a_described_word_gets_the_label(spark):
    notes = [f"complaint about invoice {i}, wrong amount" for i in range(6)]
    notes += [f"sanctions screening of vessel {i} under review" for i in range(6)]
    notes += [f"plain payment {i}" for i in range(6)]
    found = _label(spark, [*notes, "wrong invoice", "vessel screening", "plain payment", "", None, "zebra"])
    assert found[18:] == ["Dispute", "Sanctions", "Standard", "Standard", None, "Standard"]


def test_equals_the_definition_on_random_notes(spark):
    draw = random.Random(3)
    words = [*MARKS["Dispute"], *MARKS["Sanctions"], *"abcdefghijkl", "mm"]
    notes = [" ".join(draw.choice(words) for _ in range(draw.randrange(0, 7))) for _ in range(120)] + [None, "a", "a"]
    for min_notes in (1, 3):
        assert _label(spark, notes, min_notes=min_notes) == _brute(notes, min_notes)


def test_copies_of_a_note_count_once(spark):
    base = ["complaint invoice", "amount invoice", "sanctions vessel", "review vessel", "x y"]
    assert _label(spark, base + base[:1] * 50, min_notes=1)[:5] == _label(spark, base, min_notes=1)


def test_empty_table(spark):
    assert _label(spark, []) == []
