from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from conftest_words import words

from headwater.llm import jaccard
from headwater.llm.components import connected_components


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    holders, common, parent = defaultdict(list), Counter(), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for own in holders.values():
        common.update(combinations(sorted(own), 2))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("size", "percent", "cap"), [(5, 75, jaccard.CAP), (5, 75, 1), (2, 60, 2)])
def test_components_are_those_of_all_pairs(odd_docs, size, percent, cap):
    rows = jaccard.similar_components(odd_docs, size, percent, cap).collect()
    expected = brute([(r.doc_id, r.text) for r in odd_docs.collect()], size, percent)
    assert len(rows) == len(expected)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert len({c for _, c in expected.values()}) < len(expected)


def test_one_of_each_keeps_columns_and_repeated_rows_count_as_copies(spark, odd_docs, no_docs):
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    expected = brute([(r.doc_id, r.text) for r in odd_docs.collect()], 5, 75)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in expected.items() if i == c}
    assert jaccard.similar_components(no_docs).count() == 0
    twice = spark.createDataFrame([(3, "a b c"), (3, "a b c"), (None, "A b c"), (None, "q")], "doc_id long, text string")
    got = sorted(jaccard.similar_components(twice).collect(), key=str)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == [("3", 1, "3"), ("3", 1, "3"), ("None", 1, "3"), ("None", 1, "None")]


def test_one_of_each_keeps_one_row_of_null_and_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(40))
    near = long + " more"
    rows = [(3, "a b c"), (3, "a b c"), (None, "A b c"), (None, "q"), (3, "d e f"), (None, ""), (None, ""), (None, long), (None, near), (8, "x y"), (7, "X y")]
    twice = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(twice).collect()), key=str)
    assert [r for r in got if r[1] not in (long, near)] == sorted([(3, "a b c"), (3, "d e f"), (None, "q"), (None, ""), (None, ""), (7, "X y")], key=str)
    assert sum(r[1] in (long, near) for r in got) == 1


def test_links_of_sets_in_one_segment(spark):
    """Pairs of 11 words that share 6 of 8 shingles, all in one of three segments and no equal subset in one of four."""
    rng = np.random.default_rng(5)
    pairs = 60_000
    w = [[f"{x:x}" for x in row] for row in rng.integers(0, 1 << 40, (pairs, 12))]
    texts = [" ".join(x) for row in w for x in (row[:11], [*row[:10], row[11]])]
    data, ends = "".join(texts).encode(), np.cumsum([0, *map(len, texts)])
    element, _, size, _ = jaccard.shingle_sets(np.frombuffer(data, np.uint8), ends, 5)
    assert (size == 7).all()
    a, b = (element.reshape(pairs, 2, 7)[:, k] for k in (0, 1))
    segment = lambda m: [((x >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)) for x in (a, b)]
    in_both = np.stack([np.isin(x, y) for x, y in zip(a, b, strict=True)])
    (x, y), (u, v) = segment(3), segment(4)
    lost = []
    for i in np.flatnonzero((x == x[:, :1]).all(axis=1) & (y == x[:, :1]).all(axis=1)):
        ends_in = {int(u[i][~in_both[i]][0]), int(v[i][~np.isin(b[i], a[i])][0])}
        if set(u[i][in_both[i]].tolist()) <= ends_in:
            lost.append(i)
    assert len(lost) > 2
    rows = [(2 * int(i) + k, texts[2 * i + k]) for i in lost for k in (0, 1)]
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i // 2 * 2 for i, _ in rows}


def test_sketches_bound_the_difference_from_below():
    rng = np.random.default_rng(0)
    for a, b in ((0, 5), (40, 3), (300, 20), (300, 500)):
        common = rng.integers(0, 1 << 63, 200).astype(np.uint64)
        x, y = (np.unique(np.concatenate((common, rng.integers(0, 1 << 63, n).astype(np.uint64)))) for n in (a, b))
        marks = [np.frombuffer(jaccard.sketches(e, np.zeros(len(e), int), np.array([len(e)])), np.uint8) for e in (x, y)]
        least = jaccard.least_difference(*marks)
        assert (a + b) / 3 < least <= a + b


def test_connected_components_of_paths_stars_and_noise(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1100)] + [(int(a) + 5000, int(b) + 5000) for a, b in rng.integers(0, 80, (60, 2))] + [(None, 4)]
    parent = {x: x for e in edges for x in e if x is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert found == {x: root(x) for x in linked}


def test_common_elements_of_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (1, 5, 40, 90, 200)] + [np.arange(300, 310).astype(np.uint64)] * 2
    expected = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    assert jaccard._common(sets).tolist() == expected


def look_alikes(n, seed=2):
    """Texts of 60 words that differ from one text in a passage: near in most segments, and some of them linked."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for k in range(n):
        own, at = list(base), int(rng.integers(0, 50))
        own[at : at + 8] = [f"x{k}y{i}" for i in range(8)]
        texts.append(" ".join(own))
    return texts


def test_groups_of_look_alikes_leave_tasks_as_forests(spark, monkeypatch):
    n, seen = 240, []
    cut = jaccard.cut_lineage

    def counted(df, label):
        table = cut(df, label)
        if label in ("joined", "pairs"):
            seen.append((label, table.count()))
        return table

    monkeypatch.setattr(jaccard, "cut_lineage", counted)
    rows = list(enumerate(look_alikes(n)))
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 5, 75)
    assert sum(rows for label, rows in seen if label == "joined") < 20 * n
