import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from portolan.llm import words as w

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é漢\t\n\r\x0b\x0c #!A1", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    got = []
    for part in w.slices(pa.array(texts, pa.string())):
        found = w.words(part)
        plain = w.strings(part.data, found.start, found.end)
        got += [plain[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True)]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_slices_keep_rows_whole_and_hashes_depend_on_content_alone(monkeypatch):
    monkeypatch.setattr(w, "SLICE", 16)
    texts = ["one two three", "two", "x" * 100, None, "", "three two one"]
    hashes = {}
    rows = 0
    for part in w.slices(pa.array(texts)):
        found = w.words(part)
        rows += part.n_rows
        for text, h in zip(w.strings(part.data, found.start, found.end), w.word_hashes(part, found), strict=True):
            assert hashes.setdefault(text, h) == h
    assert rows == len(texts)
    assert len(set(hashes.values())) == len(hashes) == 4


def test_windows_stay_within_rows():
    start, row = w.windows(np.array([0, 2, 2, 6]), 3)
    assert start.tolist() == [2, 3] and row.tolist() == [2, 2]
    assert w.windows(np.array([0]), 3)[0].tolist() == []
