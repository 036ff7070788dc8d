import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_words import words
from pyspark.sql import functions as F

from headwater.llm import lm
from headwater.llm.trie import EliasFano, Trie


def brute(rows, train, rare=lm.RARE, weight=lm.WEIGHT):
    tokens = [(*words(t), None) for _, t in rows]
    single, pairs, texts = Counter(), Counter(), 0
    for (i, _), t in zip(rows, tokens, strict=True):
        if train(i):
            texts += 1
            single.update(t)
            pairs.update(zip(("<s>", *t[:-1]), t, strict=True))
    total, distinct = sum(single.values()), len(single)
    least = -(-total // rare)
    unigram = lambda x: (single[x] + 0.5) / (total + 0.5 * (distinct + 1))
    out = []
    for (i, _), t in zip(rows, tokens, strict=True):
        score = 0.0
        for c, x in zip(("<s>", *t[:-1]), t, strict=True):
            after = texts if c == "<s>" else single[c]
            used = after > 0 and (c == "<s>" or single[c] >= least)
            score += math.log10(weight * pairs[c, x] / after + (1 - weight) * unigram(x) if used else unigram(x))
        out.append((i, len(t), sum(single[x] > 0 for x in t), total, sum(math.log10(unigram(x)) for x in t), score))
    return out


@pytest.mark.parametrize("rare", [lm.RARE, 300])
def test_scores_are_those_of_plain_counts(odd_docs, monkeypatch, rare):
    monkeypatch.setattr(lm, "RARE", rare)
    train = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    flag = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    got = {r.doc_id: r for r in lm.score_documents(odd_docs.withColumn("train", flag)).collect()}
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert len(got) == len(rows)
    for i, n, known, total, base, score in brute(rows, train, rare):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.train) == (n, known, total, train(i))
        assert r.base_score == pytest.approx(base, abs=1e-9 * n)
        assert r.score == pytest.approx(score, abs=0.02 * n)


@pytest.mark.parametrize("frequent", [1, 30, 300])
def test_rare_words_are_contexts_too(odd_docs, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    train = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    flag = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    got = {r.doc_id: r for r in lm.score_documents(odd_docs.withColumn("train", flag)).collect()}
    for i, n, known, total, base, score in brute([(r.doc_id, r.text) for r in odd_docs.collect()], train, rare=1 << 62):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert got[i].base_score == pytest.approx(base, abs=1e-9 * n)
        assert got[i].score == pytest.approx(score, abs=0.02 * n)


def test_no_training_texts_empty_tables_and_null_ids(spark, odd_docs, no_docs):
    rows = lm.score_documents(odd_docs.withColumn("train", F.lit(None).cast("boolean"))).collect()
    assert {(r.base_score, r.score, r.n_known, r.train_tokens) for r in rows} == {(0.0, 0.0, 0, 0)}
    assert lm.score_documents(no_docs.withColumn("train", F.lit(True))).count() == 0
    twice = spark.createDataFrame([(None, "a b", True), (1, "a b", True), (1, "a b", True)], "doc_id long, text string, train boolean")
    got = lm.score_documents(twice).collect()
    assert len(got) == 3 and len({(r.score, r.base_score, r.train_tokens) for r in got}) == 1 and got[0].train_tokens == 9


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 1), (1, 1 << 40), (700, 5), (5000, 1 << 33), (512, 512)])
def test_elias_fano_gives_back_every_value(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top, n)).astype(np.uint64)
    coded = EliasFano(memoryview(EliasFano.build(values)))
    assert np.array_equal(coded[np.arange(n)], values)
    assert np.array_equal(coded.values(), values)


def test_trie_finds_its_pairs_and_no_others():
    rng = np.random.default_rng(4)
    pair = np.unique(rng.integers(0, 50, 3000) * 1000 + rng.integers(0, 900, 3000))
    p = -9 * rng.random(len(pair))
    trie = Trie(memoryview(Trie.build(pair // 1000, pair % 1000, p)))
    asked = np.arange(60_000)
    place = trie.find(asked // 1000, asked % 1000)
    assert np.array_equal(asked[place >= 0], pair)
    for few in (asked[::997], pair[::50], np.array([59_999_999])):
        assert np.array_equal(trie.find(few // 1000, few % 1000), np.where(np.isin(few, pair), np.searchsorted(pair, few), -1))
    assert np.abs(trie.log10(place[place >= 0]) - p).max() < 9 / 255
    assert (Trie(memoryview(Trie.build(pair[:0], pair[:0], p[:0]))).find(asked, asked) == -1).all()
