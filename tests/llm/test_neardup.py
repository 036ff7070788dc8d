import numpy as np
import pytest

from headwater.llm import neardup as N


def brute(rows, cosine):
    unit = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, float)
            unit[k] = v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())
    links, parent = dict.fromkeys(range(len(rows)), 0), {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in unit:
        for b in unit:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                if None not in (rows[a][0], rows[b][0]):
                    x, y = sorted((root(rows[a][0]), root(rows[b][0])))
                    parent[y] = x
    return sorted((str(i), links[k], str(None if i is None else root(i)), i is not None and root(i) == i) for k, (i, _) in enumerate(rows))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for i in range(12):
        centre = rng.normal(size=16)
        out += [(centre + rng.normal(size=16) * 0.12).tolist() for _ in range(rng.integers(1, 40))]
    out += rng.normal(size=(60, 16)).tolist() + [[1.0, 0.0], [0.99, 0.01], [0.0, 0.0], [], None, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1e300, 1e300], [1e-300, 1e-300]]
    named = list(enumerate(out))
    return [*named, named[0], named[0], (None, out[1]), (None, None)]


@pytest.mark.parametrize("cosine", [0.95, 0.8])
@pytest.mark.parametrize("interval", [N.INTERVAL, 32])
def test_links_are_those_of_all_pairs(spark, monkeypatch, rows, cosine, interval):
    monkeypatch.setattr(N, "INTERVAL", interval)
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, kept string").repartition(3)
    got = N.near_duplicates(table, cosine, partners=2).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == brute(rows, cosine)


def test_empty_table_and_no_links(spark):
    assert N.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    got = N.near_duplicates(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_distant_halves_are_skipped_and_none_is_lost():
    rng = np.random.default_rng(6)
    rows = np.concatenate([c + 0.05 * rng.normal(size=(300, 8)) for c in np.eye(8)[:4]])
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    x = object.__new__(N._Interval)
    x.rows, x.single, x.boxes = rows, rows.astype(np.float32), {}
    x.turned = N.rotated(rows, {8: np.eye(8)})
    found = list(N._join(x, x, 0, 1200, 0, 1200, 0.95))
    i, j = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    exact = np.argwhere(np.triu(rows @ rows.T >= 0.95, 1))
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, exact.tolist()))
    assert len(found) < 30  # of 25 * 26 / 2 leaves


def test_forests_keep_components():
    rng = np.random.default_rng(7)
    u, v = rng.integers(0, 100, 80), rng.integers(0, 100, 80)
    node, label = N.forest(u, v)
    found = dict(zip(node.tolist(), label.tolist(), strict=True))
    parent = list(range(100))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(u, v, strict=True):
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    assert all(found.get(x, x) == root(x) for x in {*u.tolist(), *v.tolist()})
