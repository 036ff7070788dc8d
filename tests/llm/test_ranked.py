import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from headwater.llm import ranked as R

LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top):
    """{item: [(doc_id, score)]} by scoring every document for every item."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = {}
    for i, ts in wanted.items():
        scores = []
        for d, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scores.append((-s, d is not None, d, s))
        out[i] = [(d, s) for _, _, d, s in sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top]]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


@pytest.fixture(scope="module")
def items(odd_texts):
    long = [t for t in odd_texts if t and 30 <= len(t.split()) < 1000]
    return [(1, long[0]), (2, long[1][:90].upper()), (3, "日本 é a"), (4, None), (5, "?!"), (None, "one b"), (None, "two"), (2, long[3]), (7, "nowhere"), (8, " ".join(long[:20]))]


@pytest.mark.parametrize(("top", "block", "shard"), [(10, R.BLOCK_CHARS, 1 << 16), (3, 400, 7), (1, R.BLOCK_CHARS, 1)])
def test_same_as_scoring_everything(spark, odd_docs, odd_texts, items, monkeypatch, top, block, shard):
    monkeypatch.setattr(R, "SHARD_DOCS", shard)
    monkeypatch.setattr(R, "STRETCH", 2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = found(R.search(odd_docs, benchmark, top, block).collect())
    assert got == {k: v for k, v in brute(list(enumerate(odd_texts)), items, top).items() if v}


def test_ties_nulls_and_repeated_ids(spark):
    docs = [(i % 40 if i % 7 else None, "red fox") for i in range(200)] + [(900 + i, "blue sea") for i in range(50)] + [(None, None), (3, "")]
    items = [("a", "Red"), ("b", "fox blue"), ("c", "")]
    rows = R.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert found(rows) == {k: v for k, v in brute(docs, items, 10).items() if v}


def test_empty_tables(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for docs, items in ((no_docs, one), (odd_docs, none), (no_docs, none)):
        rows = R.search(docs, items)
        assert rows.count() == 0
        assert rows.columns == ["item_id", "rank", "doc_id", "score"]


def test_stops_before_the_lists_end_and_only_strictly_below():
    rng = random.Random(1)
    docs, lists = 5000, 6
    doc, term, impact = [], [], []
    for d in range(docs):
        for t in rng.sample(range(lists), 2):
            doc.append(d)
            term.append(t)
            impact.append(rng.randint(1, 1000))
    for d in range(20):  # high in all lists
        for t in range(lists):
            doc.append(docs + d)
            term.append(t)
            impact.append(2000 + d // 4)
    order = np.argsort(doc, kind="stable")
    doc, term, impact = (np.array(x)[order] for x in (doc, term, impact))
    shard = R.ImpactLists(docs + 20, lists, doc, term, impact)
    score = np.bincount(doc, weights=impact).astype(int)
    for top in (1, 10, 20):
        got, scores, looked_up = shard.search(np.arange(lists), top, np.arange(docs + 20))
        want = sorted(range(docs + 20), key=lambda d: (-score[d], d))[:top]
        assert got.tolist() == want
        assert scores.tolist() == [score[d] for d in want]
        assert looked_up < 400
    # documents of one score throughout: the smallest come first, wherever the lists have them
    same = R.ImpactLists(300, 1, np.arange(300), np.zeros(300, int), np.full(300, 5))
    got, _, looked_up = same.search(np.array([0]), 10, np.arange(300)[::-1].copy())
    assert got.tolist() == list(range(299, 289, -1))
    assert looked_up == 300
