import random
import re
from collections import Counter

import numpy as np
import pytest

from headwater.llm import substring as S
from headwater.llm import words as W
from headwater.llm.fm_index import FMIndex


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(texts, window):
    """Per text the places of the words to remove."""
    seen = Counter(tuple(w[i : i + window]) for w in map(words, texts) for i in range(len(w) - window + 1))
    out = []
    for w in map(words, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append(gone)
    return out


def check(rows, texts, window):
    assert len(rows) == len(texts)
    by_id = dict(zip((r.doc_id for r in rows), rows, strict=True))
    for i, (text, gone) in enumerate(zip(texts, brute(texts, window), strict=True)):
        r, w = by_id[i], words(text)
        assert (r.n_words, r.n_removed, r.kept) == (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)), i
        assert {p for a, b in zip(r.removed[::2], r.removed[1::2], strict=True) for p in range(a, b)} == gone


@pytest.mark.parametrize("window", [35, 12, 4])
@pytest.mark.parametrize("shard", [S.SHARD_BYTES, 20_000])
def test_removed_words_are_those_of_all_window_pairs(odd_docs, odd_texts, window, shard):
    check(S.remove_repeats(odd_docs, window, shard).collect(), odd_texts, window)


@pytest.fixture(scope="module")
def loops():
    """Texts that repeat themselves, with periods below and above a window, and one passage common to many texts."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcXYZ", k=4))
    line = " ".join(word() for _ in range(14))
    texts = ["a " * 90, "a b " * 50, "x " + "a b " * 17, " ".join([word() for _ in range(21)] * 4), " ".join([word() for _ in range(50)] * 2), "A a " * 40]
    texts += [" ".join([*(word() for _ in range(30)), line, *(word() for _ in range(30))]) for _ in range(150)]
    return texts


@pytest.mark.parametrize("common", [S.COMMON_LEAST, 10])
def test_periods_and_common_lines(spark, loops, monkeypatch, common):
    monkeypatch.setattr(S, "COMMON_LEAST", common)
    docs = spark.createDataFrame(list(enumerate(loops)), "doc_id long, text string").repartition(3)
    check(S.remove_repeats(docs).collect(), loops, 35)
    check(S.remove_repeats(docs, shard_bytes=4000).collect(), loops, 35)


def test_common_lines_are_no_anchors():
    """Of ten lines, each in 40 texts, some have the least gram of most windows around them, unless grams count as common."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcXYZ", k=4))
    texts = []
    for line in [" ".join(word() for _ in range(14)) for _ in range(10)]:
        texts += [" ".join([*(word() for _ in range(30)), line, *(word() for _ in range(30))]) for _ in range(40)]
    text = W.words_of(np.frombuffer("".join(texts).encode(), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))), lower=False)
    common = np.zeros(1 << S.BUCKET_BITS, bool)
    plain = Counter(S._segments(text, 35, 5, common)[2].tolist())
    grams, times = np.unique(S._gram_hashes(text, 5), return_counts=True)
    common[S._bucket(grams[times > 20])] = True
    _, windows, anchors = S._segments(text, 35, 5, common)
    assert max(Counter(anchors.tolist()).values()) < 10 < 30 < max(plain.values())
    assert windows.sum() == sum(len(words(t)) - 34 for t in texts)


def test_null_and_repeated_ids_and_empty_tables(spark, no_docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text), (5, "one " * 3), (5, None), (None, " ".join(f"v{i}" for i in range(40)))]
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.n_words, r.n_removed) for r in got) == [(False, 0, 0), (False, 3, 0), (True, 40, 0), (True, 40, 40), (True, 40, 40)]
    assert S.remove_repeats(no_docs).count() == 0
    assert S.remove_repeats(no_docs).columns == ["doc_id", "n_words", "n_removed", "kept", "removed"]


@pytest.mark.parametrize("size", [3, 9, 200])
def test_matching_statistics(size):
    rng = np.random.default_rng(size)
    text = rng.integers(1, size, 600)
    text[200:260] = text[20:80]
    text[[0, 150, 400, -1]] = 0
    plain = text.tolist()
    ends = np.flatnonzero(text)
    got = FMIndex(text, size, 32).matching(text, ends, 32)
    for e, n in zip(ends.tolist(), got.tolist(), strict=True):
        runs = [0]
        for k in range(1, 33):
            run = plain[e - k + 1 : e + 1]
            if e - k + 1 < 0 or 0 in run or sum(plain[i : i + k] == run for i in range(len(plain))) < 2:
                break
            runs.append(k)
        assert n == runs[-1]
