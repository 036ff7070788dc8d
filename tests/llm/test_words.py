import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headwater.llm import words as W

LOWER = {c: c + 32 for c in range(65, 91)}
TEXTS = st.lists(st.none() | st.text(alphabet="aAzZ09 \t\n\x0b.,é日\x1c\x85", max_size=30), min_size=1, max_size=12)


@pytest.mark.parametrize(("classes", "pattern"), [(W.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
@settings(max_examples=60, deadline=None)
@given(texts=TEXTS, limit=st.integers(1, 60))
def test_words_are_those_of_the_pattern(classes, pattern, texts, limit):
    found, hashes = [], {}
    for first, _, data, offsets in W.text_chunks(pa.array(texts, pa.string()), limit):
        w = W.words_of(data, offsets, classes)
        for h, a, b, t in zip(w.hash, w.start, w.end, w.text, strict=True):
            word = W.LOWER[data[a:b]].tobytes().decode()
            found.append((int(t) + first, word))
            assert hashes.setdefault(word, h) == h
    assert found == [(i, x) for i, t in enumerate(texts) for x in re.findall(pattern, (t or "").translate(LOWER))]
    assert len(set(hashes.values())) == len(hashes)


def test_grams_of_short_texts_are_the_whole_sequence():
    column = pa.array(["a b", "", "a b c", "A B", None])
    (_, _, data, offsets), = W.text_chunks(column)
    grams, owner = W.grams(W.words_of(data, offsets), 3, whole_if_fewer=True)
    assert owner.tolist() == [0, 2, 3]
    assert grams[0] == grams[2] != grams[1]


def test_sliced_and_empty_columns():
    column = pa.array(["x", "y z", "w"]).slice(1, 2)
    assert [W.words_of(d, o).counts.tolist() for _, _, d, o in W.text_chunks(column)] == [[2, 1]]
    assert list(W.text_chunks(pa.array([], pa.string()))) == []
    assert np.array_equal(W.run_hashes(np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int)), np.zeros(0, np.uint64))
