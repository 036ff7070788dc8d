"""Properties of the geometry helpers and the layer operators."""

import json
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headwater.functions import geometry as G
from headwater.functions import projection
from headwater.operators import vector as V
from headwater.operators.noding import contract_chains


def ring(*points):
    return np.array([*points, points[0]], dtype=float)


def layer(spark, polygons, **columns):
    """DataFrame of (id, geom, extra columns)."""
    names = list(columns)
    rows = [(i, bytearray(G.polygon_wkb(p)) if p is not None else None, *[columns[n][i] for n in names]) for i, p in enumerate(polygons)]
    return spark.createDataFrame(rows, ", ".join(["id int", "geom binary", *[f"{n} {'int' if isinstance(columns[n][0], int) else 'string'}" for n in names]]))


def square(x, y, size=1.0):
    return [ring((x, y), (x + size, y), (x + size, y + size), (x, y + size))]


# --- helpers ----------------------------------------------------------------------------------


@pytest.mark.parametrize("src,dst,box", [(4326, 5070, (-124, -67, 25, 49)), (4326, 2193, (166, 179, -47, -34))])
def test_projection_round_trip(src, dst, box):
    lon, lat = (a.ravel() for a in np.meshgrid(np.linspace(*box[:2], 40), np.linspace(*box[2:], 40)))
    x, y = projection.transform(src, dst)(lon, lat)
    lon2, lat2 = projection.transform(dst, src)(x, y)
    assert max(np.abs(lon - lon2).max(), np.abs(lat - lat2).max()) < 1e-10
    x2, y2 = projection.transform(src, dst)(lon2, lat2)
    assert max(np.abs(x - x2).max(), np.abs(y - y2).max()) < 1e-5


def test_projection_origins_and_scale():
    assert np.allclose(projection.albers_forward(-96.0, 23.0), (0, 0), atol=1e-6)
    assert np.allclose(projection.nztm_forward(173.0, 0.0), (1_600_000, 10_000_000), atol=1e-6)
    # the projection is equal-area: a small cell keeps its ellipsoidal area
    d, lat = 1e-3, 40.0
    x, y = projection.albers_forward(np.array([-90, -90 + d, -90 + d, -90, -90]), np.array([lat, lat, lat + d, lat + d, lat]))
    phi = math.radians(lat + d / 2)
    w = 1 - projection.E2 * math.sin(phi) ** 2
    true = projection.A**2 * (1 - projection.E2) / w**2 * math.cos(phi) * math.radians(d) ** 2
    assert abs(abs(G.signed_area(np.column_stack([x, y]))) / true - 1) < 1e-6


def test_unknown_projection_raises():
    with pytest.raises(ValueError):
        projection.transform(4326, 3857)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=3, max_size=40, unique=True), st.floats(0.01, 500))
def test_simplified_lines_keep_ends_and_use_given_vertices(points, area):
    line = np.array(points, dtype=float)
    kept = G.simplify_line(line, area, False)
    assert (kept[0] == line[0]).all() and (kept[-1] == line[-1]).all()
    given_points = [tuple(p) for p in line.tolist()]
    positions = [given_points.index(tuple(p)) for p in kept.tolist()]
    assert positions == sorted(positions)


def test_flaws():
    assert G.flaw(G.polygon_wkb(square(0, 0))) is None
    assert G.flaw(G.polygon_wkb([])) == "empty"
    assert G.flaw(G.polygon_wkb([np.array([(0, 0), (1, 1), (0, 0)])])) == "too few points in ring"
    assert G.flaw(G.polygon_wkb([np.array([(0, 0), (1, 0), (1, 1), (0, 1)], dtype=float)])) == "ring is not closed"
    assert G.flaw(G.polygon_wkb([ring((0, 0), (2, 2), (2, 0), (0, 2))])) in ("ring crosses itself", "ring without area")
    assert G.flaw(G.polygon_wkb([ring((0, 0), (1, 1), (2, 2))])) == "ring without area"
    assert G.flaw(G.polygon_wkb([ring((0, 0), (np.inf, 0), (1, 1))])) == "non-finite coordinate"
    assert G.flaw(b"\x01\x03\x00\x00\x00\x01\x00\x00\x00\x09\x00\x00\x00") == "unreadable"


def test_text_forms():
    hole = ring((0.25, 0.25), (0.25, 0.5), (0.5, 0.5))
    wkb = G.polygon_wkb([*square(0, 0), hole])
    assert G.wkt(wkb) == "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0), (0.25 0.25, 0.25 0.5, 0.5 0.5, 0.25 0.25))"
    assert G.geojson(G.point_wkb(1, 2)) == {"type": "Point", "coordinates": [1.0, 2.0]}
    assert G.wkt(G.multipolygon_wkb([square(0, 0), square(3, 3)])).startswith("MULTIPOLYGON (((0 0")
    assert G.measures(wkb)["area"] == pytest.approx(1 - 0.03125)


# --- operators --------------------------------------------------------------------------------


def test_bad_geometries_give_null_measures(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray(b"\x01\x03")), (3, bytearray(G.point_wkb(4, 5)))], "id int, geom binary")
    got = {r.id: r for r in V.layer_measures(df).collect()}
    assert got[1].bbox is None and got[2].area is None
    assert (got[3].geometry_type, got[3].bbox.xmin, got[3].centroid_y, got[3].area) == ("Point", 4.0, 5.0, 0.0)


def parts_of(df):
    return [(r.part_count, round(r.area, 9), r.hole_count, G.measures(bytes(r.geom))["area"]) for r in df.orderBy("area").collect()]


def test_dissolve_with_holes_and_touching_corners(spark):
    # a 5 x 5 block with two corner-touching holes, one of them holding an island, and a square touching the block's corner
    block = [square(x, y) for x in range(7) for y in range(7) if (x, y) not in {(1, 1), (2, 2)} and not (3 <= x <= 5 and 3 <= y <= 5)]
    cells = [*block, square(4, 4), square(7, 7)]
    df = layer(spark, cells, key=[1] * len(cells))
    got = parts_of(V.dissolve(df, ["key"]))
    assert [(p[0], p[1], p[2]) for p in got] == [(3, 1.0, 0), (3, 1.0, 0), (3, 38.0, 3)]
    assert all(p[1] == pytest.approx(p[3]) for p in got)
    assert V.dissolve(df, ["key"], single_part=True).count() == 0
    assert tuple(V.dissolved_counts(df, ["key"]).first()) == (1, 0, 1, 0)


@settings(max_examples=4, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=1, max_size=50))
def test_dissolve_keeps_area(spark, chosen):
    cells = [square(x, y) for x, y in sorted(chosen)]
    out = V.dissolve(layer(spark, cells, key=[1] * len(cells)), ["key"]).collect()
    assert sum(G.measures(bytes(r.geom))["area"] for r in out) == pytest.approx(len(chosen))
    assert all(G.flaw(bytes(r.geom)) is None for r in out)
    # parts are the edge-connected groups of squares
    left, groups = set(chosen), 0
    while left:
        groups, stack = groups + 1, [left.pop()]
        while stack:
            x, y = stack.pop()
            near = {(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)} & left
            left -= near
            stack += near
    assert len(out) == groups == out[0].part_count


def test_overlapping_input_is_reported(spark):
    df = layer(spark, [square(0, 0), square(0, 0), square(1, 0), square(4, 4)], key=["a", "a", "a", "b"])
    out = {r.key: r for r in V.dissolve(df, ["key"]).collect()}
    assert out["a"].overlap and out["a"].geom is None
    assert not out["b"].overlap and out["b"].area == pytest.approx(1)


def box(x, y, w, h):
    return [ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))]


def test_borders_whose_vertices_do_not_line_up(spark):
    """A square with two half squares beside it; a row of thin boxes along a slanted long edge."""
    df = layer(spark, [box(0, 0, 2, 2), box(2, 0, 1, 1), box(2, 1, 1, 1)], key=["a"] * 3)
    out = V.dissolve(df, ["key"], single_part=True).collect()
    assert [(r.part_count, r.area, r.overlap) for r in out] == [(1, 6.0, False)]
    assert V.dissolve(layer(spark, [box(0, 0, 1, 2), box(1, 0, 1, 1), box(1, 1, 1, 1)], key=[1] * 3), ["key"]).first().area == 4
    cut = [k / 7 for k in range(8)]
    low, high = np.array([(30 * k, 10 * k) for k in cut]), np.array([(30 * k - 4, 10 * k + 9) for k in cut])
    thin = [[ring(tuple(low[i]), tuple(low[i + 1]), tuple(high[i + 1]), tuple(high[i]))] for i in range(7)]
    below = [ring((0, 0), (20, -10), (30, 10))]
    out = V.dissolve(layer(spark, [*thin, below], key=[1] * 8), ["key"]).collect()
    assert [(r.part_count, r.hole_count, r.overlap) for r in out] == [(1, 0, False)]
    assert out[0].area == pytest.approx(sum(abs(G.signed_area(p[0])) for p in [*thin, below]), abs=1e-4)


@settings(max_examples=3, deadline=None)
@given(st.integers(0, 10_000))
def test_any_tiling_dissolves_to_its_outline(spark, seed):
    """A rectangle cut into random rectangles, whose corners lie on the sides of others."""
    rng = np.random.default_rng(seed)
    tiles, work = [], [(0.0, 0.0, 64.0, 48.0)]
    while work:
        x, y, w, h = work.pop()
        if len(tiles) + len(work) > 40 or min(w, h) < 2:
            tiles.append((x, y, w, h))
            continue
        k = float(np.round(rng.uniform(0.2, 0.8), 3))
        work += [(x, y, w * k, h), (x + w * k, y, w - w * k, h)] if w > h else [(x, y, w, h * k), (x, y + h * k, w, h - h * k)]
    out = V.dissolve(layer(spark, [box(*t) for t in tiles], key=[1] * len(tiles)), ["key"]).collect()
    assert [(r.part_count, r.hole_count) for r in out] == [(1, 0)]
    assert out[0].area == pytest.approx(64 * 48, abs=1e-3)


OVERLAPS = {
    "corner": [box(0, 0, 2, 2), box(1, 1, 2, 2)],
    "inside": [box(0, 0, 9, 9), box(3, 3, 1, 1)],
    "inside, touching a side": [box(0, 0, 9, 9), box(3, 0, 1, 1)],
    "inside, one corner on a side": [box(0, 0, 9, 9), [ring((3, 0), (5, 2), (3, 4), (1, 2))]],
    "over an inner border": [box(0, 0, 4, 4), box(4, 0, 4, 4), box(3, 1, 2, 2)],
    "along a part of a side": [box(0, 0, 4, 4), box(2, 0, 4, 4)],
    "the same": [box(0, 0, 4, 4), box(0, 0, 4, 4)],
    "across": [box(0, 3, 9, 1), box(3, 0, 1, 9)],
    "in the middle of the smallest": [box(0, 0, 100, 100), box(10, 10, 0.01, 0.01)],
}


def test_overlaps_of_all_kinds_are_reported(spark):
    polygons = [(name, p) for name, ps in OVERLAPS.items() for p in ps] + [("apart", box(0, 0, 2, 2)), ("apart", box(2, 2, 2, 2)), ("apart", box(7, 0, 1, 1))]
    df = layer(spark, [p for _, p in polygons], key=[k for k, _ in polygons])
    out = V.dissolve(df, ["key"]).collect()
    assert {r.key for r in out if r.overlap} == set(OVERLAPS)
    assert all(r.geom is None for r in out if r.overlap)
    assert sorted(r.area for r in out if not r.overlap) == [1, 4, 4]
    assert tuple(V.dissolved_counts(df, ["key"]).first()) == (1, 0, 1, len(OVERLAPS))


def test_islands_in_holes_in_islands(spark):
    """Frames inside each other, with one more part in the middle: every hole goes to the frame around it."""
    frames = [[*box(k, k, 40 - 2 * k, 40 - 2 * k), box(k + 1, k + 1, 38 - 2 * k, 38 - 2 * k)[0][::-1]] for k in range(0, 18, 3)]
    out = V.dissolve(layer(spark, [*frames, box(19, 19, 1, 1)], key=[1] * 7), ["key"]).orderBy("area").collect()
    assert [(r.part_count, r.hole_count) for r in out] == [(7, 0)] + [(7, 1)] * 6
    assert [r.area for r in out] == [1.0] + sorted((40 - 2 * k) ** 2 - (38 - 2 * k) ** 2 for k in range(0, 18, 3))


def test_no_ring_is_joined_but_with_its_own_polygon(spark):
    """Windings come from numbers and edges alone."""
    loops = spark.createDataFrame([], "key int, loop long, rings array<struct<ring:binary,signed_area:double,px:double,py:double,xmin:double,ymin:double,xmax:double,ymax:double>>, area double")
    labeled = spark.createDataFrame([], "key int, id long, a struct<x:double,y:double>, b struct<x:double,y:double>, ring long")
    plan = V._windings(loops, labeled, ["key"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins
    assert all("binary" not in line for line in joins)


@pytest.mark.parametrize("batch", [3, 10_000])
def test_chains_are_runs_of_links(spark, batch):
    """Rings of many sizes in any order: chains cover all links, and following heads leads around each ring."""
    rng = np.random.default_rng(batch)
    links, at = {}, 0
    for size in (1, 2, 3, 10, 200, 1000):
        ids = at + rng.permutation(size)
        links |= dict(zip(ids.tolist(), np.roll(ids, -1).tolist()))
        at += size
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rows = contract_chains(spark.createDataFrame(list(links.items()), "id long, next long")).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.id for r in rows) == sorted(links)
    head, tail, least = {r.id: r.head for r in rows}, {r.id: r.next for r in rows if r.next is not None}, {r.head: r.least for r in rows}
    for r in rows:
        if head[r.id] != head[links[r.id]]:
            assert tail[head[r.id]] == links[r.id] == head[links[r.id]]
    for h in set(head.values()):
        own = [i for i, x in head.items() if x == h]
        assert least[h] == min(own)
    if batch > 1216:
        assert len(set(head.values())) <= 6 * 8


def wavy_coverage():
    """A row of four polygons with wavy shared borders."""
    ys = np.linspace(0, 10, 41)
    borders = [np.column_stack([10 * i + (0.3 * np.sin(ys * 7 + i) if 0 < i < 4 else 0 * ys), ys]) for i in range(5)]
    return [[ring(*map(tuple, np.vstack([left[::-1], right])))] for left, right in zip(borders[:-1], borders[1:])]


def test_shared_borders_stay_shared(spark):
    polygons = wavy_coverage()
    out = V.simplify_coverage(layer(spark, polygons, key=[1] * 4), "id", 0.6, ["key"]).orderBy("id").collect()
    new = [G.polygons_of(bytes(r.geom_simplified))[0][0] for r in out]
    old = [np.round(p[0], V.DIGITS) for p in polygons]
    for before, after in zip(old, new):
        assert {tuple(p) for p in after.tolist()} <= {tuple(p) for p in before.tolist()}
        assert len(after) < len(before) / 2
    edges = [{frozenset((tuple(a), tuple(b))) for a, b in zip(r[:-1].tolist(), r[1:].tolist())} for r in new]
    for i in range(3):
        assert edges[i] & edges[i + 1], "neighbours share their border"
    used = [e for group in edges for e in group]
    assert all(used.count(e) <= 2 for e in set(used))
    assert sum(abs(G.signed_area(r)) for r in new) == pytest.approx(400)  # no gaps, no overlaps


def test_islands_and_thin_polygons_survive(spark):
    thin = [ring((0, 0), (5, 0.1), (10, 0), (5, -0.1))]
    out = V.simplify_coverage(layer(spark, [thin]), "id", 1000.0).first()
    assert G.measures(bytes(out.geom_simplified))["area"] > 0
    assert bytes(out.geom) == G.polygon_wkb(thin)


def test_holes_are_simplified_with_their_filling(spark):
    theta = np.linspace(0, 2 * np.pi, 60, endpoint=False)
    disc = [(5 + 2 * math.cos(a), 5 + 2 * math.sin(a)) for a in theta]
    outer = [ring((0, 0), (10, 0), (10, 10), (0, 10)), ring(*disc[::-1])]
    out = V.simplify_coverage(layer(spark, [outer, [ring(*disc)]]), "id", 0.5).orderBy("id").collect()
    areas = [G.measures(bytes(r.geom_simplified))["area"] for r in out]
    assert sum(areas) == pytest.approx(100)
    assert len(G.polygons_of(bytes(out[1].geom_simplified))[0][0]) < 40


def test_zone_cells_against_brute_force(spark):
    head = spark.createDataFrame([(1, 0.0, 100.0, 1.0, -1.0, 100, 100)], "raster_id int, left_x double, top_y double, cell_width double, cell_height double, n_rows int, n_cols int")
    star = [(50 + (40 if i % 2 else 15) * math.cos(i * math.pi / 5 + 0.1), 50 + (40 if i % 2 else 15) * math.sin(i * math.pi / 5 + 0.1)) for i in range(10)]
    polygon = [ring(*star)]
    df = layer(spark, [polygon], raster_id=[1], kind=["z"])
    got = {(r.r, r.c) for r in V.zone_cells(df, head, "id", "kind").collect()}
    # dense points of the polygon and its border
    touched = set()
    for a, b in zip(polygon[0][:-1], polygon[0][1:]):
        for s in np.linspace(0, 1, 4001):
            x, y = a + (b - a) * s
            touched.add((int(math.floor(100 - y)), int(math.floor(x))))
    for r in range(100):
        for c in range(100):
            if G.contains(polygon[0], c + 0.5, 100 - r - 0.5):
                touched.add((r, c))
    assert touched <= got
    assert len(got - touched) <= 6  # corners grazed between the sample points


def test_zone_cells_of_holes_parts_repeats_and_odd_rows(spark):
    head = spark.createDataFrame([(1, 0.0, 10.0, 1.0, -1.0, 10, 10), (2, 0.0, 5.0, 0.5, -0.5, 4, 4)], "raster_id int, left_x double, top_y double, cell_width double, cell_height double, n_rows int, n_cols int")
    ringed = [ring((1, 1), (9, 1), (9, 9), (1, 9)), ring((3, 3), (3, 7), (7, 7), (7, 3))]
    block = [ring((-5, 2.5), (20, 2.5), (20, 3.5), (-5, 3.5))]
    over = [ring((0, 0), (99, 0), (99, 99), (0, 99))]
    df = layer(spark, [ringed, ringed, block, None, [], over, over], raster_id=[1, 1, 1, 1, 1, 2, 9])
    df = df.withColumn("id", F.when(F.col("id") < 2, F.lit(0).cast(df.schema["id"].dataType)).otherwise(F.col("id")))
    df = df.unionByName(spark.createDataFrame([(None, bytearray(G.polygon_wkb(ringed)), 1), (77, bytearray(G.point_wkb(1.0, 2.0)), 1), (78, bytearray(b"no geometry"), 1)], "id long, geom binary, raster_id long").select([F.col(f.name).cast(f.dataType) for f in df.schema]))
    got = {}
    for r in V.zone_cells(df, head, "id").collect():
        got.setdefault((r.raster_id, r.id), []).append((r.r, r.c))
    square_ring = sorted((9 - y, x) for x in range(1, 9) for y in range(1, 9) if not (3 <= x < 7 and 3 <= y < 7))
    want = {(1, 0): square_ring, (1, None): square_ring, (1, 2): sorted((r, c) for r in (6, 7) for c in range(10)), (2, 5): sorted((r, c) for r in range(4) for c in range(4))}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_zone_edges_cross_one_exchange_and_polygons_none(spark):
    head = spark.createDataFrame([(1, 0.0, 10.0, 1.0, -1.0, 10, 10)], "raster_id int, left_x double, top_y double, cell_width double, cell_height double, n_rows int, n_cols int").hint("broadcast")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    text = V.zone_cells(layer(spark, [square(0, 0)], raster_id=[1]), head, "id")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.adaptive.enabled")
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "geom" not in exchanges[0]


def test_profile_and_first_invalid(spark):
    bow = [ring((0, 0), (2, 2), (2, 0), (0, 1))]
    df = layer(spark, [square(0, 0), None, bow, []])
    got = V.geometry_profile(df).first()
    assert (got.n_rows, got.n_null, got.n_empty, got.n_invalid, got.xmax, got.non_finite, got.zero_area) == (4, 1, 1, 1, 2.0, False, False)
    assert [tuple(r) for r in V.invalid_geometries(df, "id").collect()] == [(2, "ring crosses itself")]


def test_reprojected_column_names_its_system(spark):
    out = V.reproject_layer(layer(spark, [square(-100, 40)]), 4326, 5070)
    assert out.schema["geom"].metadata == {"crs": "EPSG:5070"}
    assert 9e9 < V.layer_measures(out).first().area < 1e10


def test_rollup_outline_box_and_centroid(spark):
    df = layer(spark, [square(0, 0), square(1, 0), square(5, 5)], key=["a", "a", "a"])
    out = V.bounds_rollup(df, ["key"]).orderBy("area").collect()
    assert [r.area for r in out] == [1.0, 2.0]
    assert (out[0].xmin, out[0].ymax, round(out[0].centroid_x, 6)) == (0.0, 6.0, round((0.5 + 1.5 + 5.5) / 3, 6))


def test_feature_collections_are_whole(spark):
    df = layer(spark, [square(i, 0) for i in range(25)], huc=["h"] * 25)
    docs = [json.loads(r.document) for r in V.feature_collections(df, "huc", "id", chunk=10).collect()]
    assert sorted(f["properties"]["id"] for d in docs for f in d["features"]) == list(range(25))
    assert min(d["bbox"][0] for d in docs) == 0 and max(d["bbox"][2] for d in docs) == 25
