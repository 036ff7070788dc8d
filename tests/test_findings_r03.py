"""What the findings of round 3 name, on small rows of their own."""

import builtins
import re
import struct
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import headwater.plans  # noqa: F401
from headwater.functions import geometry as G
from headwater.functions.projection import transform
from headwater.llm import components, decontaminate, quality
from headwater.llm.tables import append_columns
from headwater.operators import stats
from headwater.plans import vectors
from headwater.plans.bindings import Tables
from headwater.plans.registry import REGISTRY
from headwater.sources import sinks


def tables(spark, folder, **frames):
    """A folder of tables, one Parquet each."""
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def orders(spark, n, key="id * 4 + 1"):
    return spark.range(n).selectExpr(
        f"{key} AS o_orderkey", "id AS o_custkey", "'P' AS o_orderstatus", "1.5D AS o_totalprice", "timestamp_ntz'1995-01-01 00:00:00' AS o_orderdate",
        "CASE id % 2 WHEN 0 THEN '1-URGENT' ELSE '5-LOW' END AS o_orderpriority",
    )


def test_a_load_that_rejects_every_watershed_is_reported(spark, tmp_path):
    """nothing was loaded, so there was no data folder to read."""
    part = spark.range(3).selectExpr("id AS p_partkey", "'Brand#3' AS p_brand", "1 AS p_size", "'t' AS p_type", "2.0D AS p_retailprice")
    folder = tables(spark, tmp_path, orders=orders(spark, 6), part=part, customer=spark.range(1).selectExpr("3L AS c_custkey"))
    # order 17 has no watershed
    bad, none = "bad level path", "no input"
    got = REGISTRY["incremental_driver"].run(spark, folder).collect()
    assert sorted((r.project_id, r.status, r.n) for r in got) == [("1", bad, 0), ("13", none, 0), ("21", none, 0), ("5", bad, 0), ("9", bad, 0)]
    # the square of customer 3 is in the third column
    got = REGISTRY["incremental_segments"].run(spark, folder).collect()
    assert sorted((r.project_id, r.status, r.n) for r in got) == [("1", none, 0), ("13", "third column", 0), ("21", none, 0), ("5", none, 0), ("9", none, 0)]


def test_tasks_of_all_definitions_are_priced(spark, tmp_path):
    """the query had been cut to the tasks of one definition."""
    line = spark.range(4).selectExpr("id * 4 + 2 AS l_orderkey", "1 AS l_linenumber", "id AS l_partkey", "10.0D AS l_quantity", "timestamp_ntz'1995-01-01 00:00:00' AS l_shipdate")
    folder = tables(spark, tmp_path, orders=orders(spark, 4, "id * 4 + 2"), lineitem=line)
    assert sorted(r.jid for r in REGISTRY["task_cost"].run(spark, folder).collect()) == [2, 6, 10, 14]
    t = Tables(spark, folder)
    assert sorted(r.jid for r in stats.task_cost(t.jobs, t.tasks, "valley", "5-LOW").collect()) == [6, 14]


def shapes():
    """Sound, odd and unreadable geometries, plain polygons of several lengths among them."""
    rng = np.random.default_rng(5)
    out = [None, b"", b"\x01", struct.pack("<BII", 1, 3, 0), struct.pack("<BIII", 1, 3, 1, 0), G.point_wkb(1.5, 2), G.point_wkb(float("nan"), 2)]
    for i in range(120):
        turn = np.sort(rng.random(int(rng.integers(3, 80)))) * 2 * np.pi
        ring = np.column_stack([np.cos(turn), np.sin(turn)]) * (rng.random((len(turn), 1)) + 0.2) - [100, -40]
        ring = np.vstack([ring, ring[:1]])
        if i % 10 == 1:
            ring = ring[::-1]
        if i % 10 == 2:
            ring[1] = (np.nan, np.inf, 0.0)[i // 10 % 3]
        if i % 10 == 3:
            ring = ring[: i // 10 % 4]
        if i % 10 == 4:
            ring = np.round(ring * 2) / 2
        if i % 10 == 9:
            ring = ring[:-1]
        wkb = G.polygon_wkb([ring, ring[::-1]] if i % 10 == 5 else [ring])
        if i % 10 == 6:
            wkb = G.multipolygon_wkb([[ring], [ring + 9]])
        if i % 10 == 7:
            wkb = struct.pack(">BIII", 0, 3, 1, len(ring)) + ring.astype(">f8").tobytes()
        out.append(wkb[:-1] if i % 10 == 8 else wkb)
    return out


def one(form, *args):
    try:
        return None if args[0] is None else form(*args)
    except G.Bad:
        return None


@pytest.fixture(params=[pa.binary(), pa.large_binary()], ids=str)
def column(request):
    return pa.array([b"before", *shapes()], request.param)[1:]


def test_a_batch_is_moved_and_measured_as_one_by_one(column):
    """every geometry had calls of its own."""
    for there in ((4326, 5070), (5070, 4326)):
        want = [one(G.map_points, g, transform(*there)) for g in column.to_pylist()]
        got = G.map_all_points(column, transform(*there)).to_pylist()
        for a, b in zip(want, got):
            assert (a is None) == (b is None) and (a is None or a == b or np.allclose(np.frombuffer(a[-16:]), np.frombuffer(b[-16:]), rtol=1e-12, equal_nan=True))
    kinds, numbers = G.measures_of(column)
    for g, kind, row in zip(column.to_pylist(), kinds, numbers):
        m = one(G.measures, g)
        assert kind == (m and m["geometry_type"])
        assert m is None or np.allclose(row, [m[c] for c in G.MEASURED], rtol=1e-12, equal_nan=True)


def test_boxes_are_built_as_one_by_one():
    sides = [pa.array(v) for v in ([1, None, 3], [1.5, 2, 3], [5.0, 6, 7], [8, 9, 10])]
    ring = lambda a, b, c, d: G.polygon_wkb([np.array([(a, b), (c, b), (c, d), (a, d), (a, b)], dtype=float)])
    assert G.boxes_wkb(*sides).to_pylist() == [ring(1, 1.5, 5, 8), None, ring(3, 3, 7, 10)]
    assert len(G.boxes_wkb(*[s[:0] for s in sides])) == 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reprojected_boxes_are_dealt_over_tasks(spark, tmp_path):
    folder = tables(spark, tmp_path, customer=spark.range(9).selectExpr("id AS c_custkey"))
    assert "hashpartitioning(c_custkey" in plan(REGISTRY["vec_reproject"].run(spark, folder))


def test_squares_are_dealt_over_tasks(spark, tmp_path):
    """polygons were built and taken apart by the one task that read the table."""
    t = Tables(spark, tables(spark, tmp_path, customer=spark.range(90).selectExpr("id AS c_custkey")))
    for layer in (vectors.squares(t), vectors.squares(t, t.tiles), vectors.uneven(t)):
        assert "hashpartitioning(feature_id" in plan(layer)


def test_points_of_a_batch_are_built_and_measured(column):
    """so were the points of places."""
    x, y = pa.array([1, None, 3]), pa.array([0.5, 1.5, None])
    points = G.points_wkb(x, y)
    assert points.to_pylist() == [G.point_wkb(1, 0.5), None, None]
    kinds, numbers = G.measures_of(points)
    assert list(kinds) == ["Point", None, None] and numbers[0].tolist() == [1, 0.5, 1, 0.5, 0, 1, 0.5]


def test_flaws_of_a_batch_are_those_of_one_by_one(column):
    """every ring was tried edge by edge in Python."""
    want = [G.flaw(g) for g in column.to_pylist()]
    assert list(G.flaws_of(column)) == want
    assert {"ring crosses itself", "ring is not closed", "non-finite coordinate", "unreadable", "empty", "too few points in ring", None} <= set(want)


@pytest.mark.parametrize("digits", [None, 2])
def test_edges_of_a_batch_are_those_of_one_by_one(column, digits):
    """so were the edges of polygons listed."""
    offsets, table = G.edges_of(column, digits)
    assert len(offsets) == len(column) + 1 and offsets[-1] == len(table)
    for i, g in enumerate(column.to_pylist()):
        want = one(G.directed_edges, g, digits)
        assert np.array_equal(table[offsets[i] : offsets[i + 1]], np.empty((0, 4)) if want is None else want, equal_nan=True)


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_named_files_hold_their_rows_bytes(spark, tmp_path, kind):
    """F8, F9: files are written from the batch itself."""
    texts = ["", "plain", "naïve \U0001f30a\n" * 1000]
    rows = spark.createDataFrame([(f"d{i}/f.txt", x) for i, x in enumerate(texts)], "name string, content string").withColumn("content", F.col("content").cast(kind))
    assert sinks.write_named_files(rows, str(tmp_path / "out")) == len(texts)
    assert [(tmp_path / "out" / f"d{i}" / "f.txt").read_bytes() for i in range(len(texts))] == [x.encode() for x in texts]


def test_lines_are_shuffled_in_parts_that_grow_in_number(spark, sf_dir):
    """seven tasks read the whole table between them, however large."""
    text = plan(REGISTRY["content_hash"].run(spark, sf_dir))
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "REPARTITION_BY_NUM" not in text


@pytest.mark.parametrize("held, most", [(1 << 20, 2), (8, 99)])
def test_few_links_are_joined_without_rounds(spark, monkeypatch, held, most):
    """op2: on many partitions a third of the time went into rounds over some thousand links."""
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1100)] + [(9, 9), (None, 4), (4, None), (3, 2), (2, 3)]
    written, cut = [], components.cut_lineage
    monkeypatch.setattr(components, "cut_lineage", lambda df, label: written.append(label) or cut(df, label))
    links = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = sorted(map(tuple, components.connected_components(links, held).collect()))
    assert got == sorted([(i, 100) for i in range(100, 161)] + [(7, 7)] + [(i, 7) for i in range(1000, 1100)] + [(2, 2), (3, 2)])
    assert len(written) <= most and (held > 8 or len(written) > 3)
    assert components.connected_components(links.where("u = 9"), held).count() == 0


def test_python_workers_return_what_a_task_has_freed(spark):
    """pipeline: idle workers kept 260 MB each of earlier tasks, besides the executor's heap."""

    def own_mb():
        return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    def compute(column):
        before, parts = own_mb(), [np.ones(8000) for _ in range(2500)]
        builtins.end_of_heap = parts[-1]  # outlives the task
        return [pa.array([before] * len(column)), pa.array([own_mb()] * len(column))]

    one = spark.range(0, 1, 1, 1).selectExpr("'' AS text")
    for _ in range(2):
        row = append_columns(one, "text", "before double, within double", compute).collect()[0]
        assert row.within > row.before + 100
    left = one.mapInArrow(lambda batches: (pa.record_batch({"mb": [own_mb()]}) for _ in batches), "mb double").collect()[0].mb
    assert left < row.within - 100


@pytest.mark.parametrize("step", ["quality", "decontamination"])
def test_steps_hold_little_besides_the_batch(step):
    """pipeline: a step's arrays took 130 MB of a worker for 2 MB of text at a time, two workers an executor."""
    column = pa.array([f"some words {i} of a text, " * 40 for i in range(4000)])
    model, index = quality.Model(), decontaminate.build_index([("one", "no such words " * 9)], 13)
    model.weights = np.zeros(quality.BUCKETS, np.float32)
    run = {"quality": lambda: quality.score_texts(column, model), "decontamination": lambda: decontaminate.find(column, index)}[step]
    tracemalloc.start()
    try:
        run()
        assert tracemalloc.get_traced_memory()[1] < 50e6
    finally:
        tracemalloc.stop()
