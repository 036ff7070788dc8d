"""Inputs that used to lose or change data."""

import math
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions import columns as C
from headwater.functions import geometry as G
from headwater.operators import joins as J
from headwater.operators import projects as P
from headwater.operators import ranking, reshape, sets
from headwater.operators import raster as R
from headwater.operators import vector as V
from headwater.sources import files as S
from headwater.sources import gpkg, sinks


def test_an_element_over_several_lines_fails_the_line_reader(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"id": "1",\n "name": "x"},\n{"id": "2"}\n]')
    with pytest.raises(Exception, match="not one whole element"):
        S.read_project_docs(spark, str(tmp_path / "a.json"), one_per_line=True).collect()
    (tmp_path / "b.json").write_text('[{"id": "1", "tags": ["x]"]},\n\n{"id": "2", "name": "a,"} ,\n{"id": "3"}]')
    assert [r.id for r in S.read_project_docs(spark, str(tmp_path / "b.json"), one_per_line=True).orderBy("id").collect()] == ["1", "2", "3"]


def make_gpkg(path, tables):
    connection = sqlite3.connect(path)
    for name, (columns, rows) in tables.items():
        connection.execute(f"CREATE TABLE {name} ({columns})")
        connection.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    connection.commit()
    connection.close()


def test_columns_and_tables_of_all_files_are_read(spark, tmp_path):
    make_gpkg(tmp_path / "a.gpkg", {"t": ("fid INTEGER, v INTEGER", [(1, 5)])})
    make_gpkg(tmp_path / "b.gpkg", {"t": ("fid INTEGER, V REAL, extra TEXT", [(2, 3.5, "e")]), "only_here": ("x INTEGER", [(7,)])})
    rows = gpkg.read_gpkg(spark, str(tmp_path / "*.gpkg"), "t").orderBy("fid").select("fid", "v", "extra").collect()
    assert [tuple(r) for r in rows] == [(1, 5.0, None), (2, 3.5, "e")]
    assert spark.read.parquet(gpkg.copy_tables(spark, str(tmp_path / "*.gpkg"), str(tmp_path / "copy"))["only_here"]).count() == 1


@pytest.mark.parametrize(("column", "value"), [("INTEGER", 3.5), ("REAL", "text"), ("INTEGER", float("inf"))])
def test_values_that_do_not_fit_their_column_are_an_error(spark, tmp_path, column, value):
    make_gpkg(tmp_path / "a.gpkg", {"t": (f"v {column}", [(value,)])})
    with pytest.raises(Exception, match="does not fit"):
        gpkg.read_gpkg(spark, str(tmp_path / "a.gpkg"), "t").collect()


def test_null_orders_keep_the_row(spark):
    df = spark.createDataFrame([(1, None, "only"), (2, 5, "later"), (2, None, "none"), (2, 3, "first")], "k int, o int, v string")
    assert sorted(tuple(r) for r in ranking.first_per_key(df, ["k"], "o").select("k", "v").collect()) == [(1, "only"), (2, "first")]
    assert sorted(tuple(r) for r in sets.insert_ignore(df.limit(0), df, ["k"], "o").select("k", "v").collect()) == [(1, "only"), (2, "first")]


def test_loads_number_on_and_drift_is_an_error(spark, tmp_path):
    schema, order = T.StructType().add("fid", T.LongType()).add("v", "string"), ["v"]
    load = lambda name, values, s=schema: sinks.append_conformed(spark.createDataFrame([(v,) for v in values], "v string"), "numbered", s, name, order, str(tmp_path / "t"))
    try:
        load("one", "ab")
        load("two", "cd")
        assert sorted((r.fid, r.v) for r in spark.table("numbered").collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
        load("two", "xyz")
        assert sorted((r.fid, r.v) for r in spark.table("numbered").collect()) == [(1, "a"), (2, "b"), (3, "x"), (4, "y"), (5, "z")]
        with pytest.raises(ValueError, match="another schema.*'w'"):
            load("three", "z", T.StructType().add("fid", T.LongType()).add("v", "string").add("w", T.IntegerType()))
        assert spark.table("numbered").count() == 5
    finally:
        spark.sql("DROP TABLE IF EXISTS numbered")


def test_tsv_fields_of_any_text_come_back(spark, tmp_path):
    texts = ["a\rb", "\x01", "\\", "\\t", "tab\t", "line\nfeed", "\\N", "\\\\n", None, ""]
    rows = [(str(i), t, [], "0101010101", 1, True, i, "d", "o", t, "USER", "x", "1") for i, t in enumerate(texts)]
    columns = [*S.TSV_COLUMNS, "project_type_id", "model_version"]
    df = spark.createDataFrame([(r[0], r[1], "a|b", *r[3:]) for r in rows], "project_id string, name string, tags string, huc10 string, model_version_int bigint, archived boolean, created_on bigint, created_on_date string, owned_by_id string, owned_by_name string, owned_by_type string, project_type_id string, model_version string")
    sinks.write_projects_tsv(df.select(*columns), str(tmp_path / "tsv"))
    got = {r.project_id: (r.name, r.owned_by_name) for r in S.read_projects_tsv(spark, str(tmp_path / "tsv")).collect()}
    assert got == {str(i): (t, t) for i, t in enumerate(texts)}


def test_padded_versions_are_versions(spark):
    df = spark.createDataFrame([(" 1.2.3 ",), ("01.02.03",), ("x",)], "v string")
    assert [r[0] for r in df.select(C.version_int(F.col("v"))).collect()] == [1002003, 1002003, None]


@pytest.mark.parametrize(("path", "huc"), [
    ("file:/data/1700000000123/1701020304/x.json", "1701020304"),
    ("file:/data/17010203041/x.json", ""),
    ("file:/1701020304/deep/er/x.json", ""),
    ("file:/a/metrics_170102030405.gpkg", "170102030405"),
])
def test_codes_are_10_or_12_digits_of_the_last_names(spark, path, huc):
    assert spark.range(1).select(S.huc_in_path(F.lit(path))).first()[0] == huc


def test_metrics_of_every_segment_of_a_location(spark):
    segments = spark.createDataFrame([(1, "a", 1.0, "F1"), (2, "a", 1.0, "F2"), (3, "b", 2.0, "F3"), (4, None, 3.0, "F4")], "dgoid int, level_path string, seg_distance double, fcode string")
    values = spark.createDataFrame([(1, 1, 5.0), (2, 2, 7.0), (2, 1, None), (4, 1, 9.0)], "dgo_id int, metric_id int, metric_value double")
    metrics = [(1, "m1", "FLOAT", True), (2, "m2", "FLOAT", True), (3, "m3", "FLOAT", False)]
    got = reshape.location_metrics(segments, values, metrics).select("dgoid", "fcode", "m1", "m2").orderBy("dgoid").collect()
    assert [tuple(r) for r in got] == [(1, "F1", 5.0, 7.0), (3, "F3", None, None), (4, "F4", 9.0, None)]


def test_nan_is_no_value_and_fill_values_are_an_error(spark):
    cells = spark.createDataFrame([(1, 5.0), (1, float("nan")), (1, 120.0), (2, float("nan"))], "raster_id int, value double")
    assert [(r.raster_id, r.max, r.value_count, r.cell_count) for r in R.bin_continuous(cells).orderBy("bin").collect()] == [(1, 120.0, 2, 1), (1, 120.0, 2, 1)]
    assert [(r.category, r.cell_count) for r in R.bin_categorical(cells).orderBy("category").collect()] == [(5, 1), (120, 1)]
    with pytest.raises(Exception, match="too many bins"):
        R.bin_continuous(spark.createDataFrame([(1, 0.0), (1, -3.4e38)], "raster_id int, value double")).collect()


def test_a_mosaic_needs_one_grid(spark):
    cells = spark.createDataFrame([(1, 0, 0, 5.0), (2, 0, 0, 6.0)], "raster_id int, r int, c int, value double")
    header = "raster_id int, dataset string, priority int, left_x double, top_y double, cell_width double, cell_height double"
    good = spark.createDataFrame([(1, "d", 1, 0.0, 0.0, 10.0, -10.0), (2, "d", 2, 20.0, 0.0, 10.0, -10.0)], header)
    assert R.mosaic(cells, good).count() == 2
    for bad in ((2, "d", 2, 20.0, 0.0, 5.0, -5.0), (2, "d", 2, 23.0, 0.0, 10.0, -10.0)):
        with pytest.raises(Exception, match="not on the grid"):
            R.mosaic(cells, spark.createDataFrame([(1, "d", 1, 0.0, 0.0, 10.0, -10.0), bad], header)).collect()


def square(x, y, size=2.0):
    return G.polygon_wkb([np.array([(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)])])


def test_null_keys_are_dissolved_and_simplified(spark):
    df = spark.createDataFrame([(1, None, square(0, 0)), (2, None, square(2, 0)), (3, "k", square(9, 9))], "id int, k string, geom binary")
    assert sorted((str(r.k), r.part_count, r.area) for r in V.dissolve(df, ["k"]).collect()) == [("None", 1, 8.0), ("k", 1, 4.0)]
    simple = V.simplify_coverage(df, "id", 0.1, ["k"])
    assert simple.columns == [*df.columns, "geom_simplified"]
    assert simple.where("geom_simplified IS NULL").count() == 0


def test_doubled_polygons_do_not_end_the_job(spark):
    df = spark.createDataFrame([(1, square(0, 0)), (2, square(0, 0)), (3, square(0, 0)), (4, square(50, 50))], "id int, geom binary")
    got = {r.id: r.geom_simplified for r in V.simplify_coverage(df, "id", 0.1).collect()}
    assert len(got) == 4 and got[4] is not None


def test_lines_and_points_are_written_as_what_they_are(spark):
    line = lambda *p: struct.pack("<BII", 1, 2, len(p)) + b"".join(struct.pack("<dd", *q) for q in p)
    lines = struct.pack("<BII", 1, 5, 2) + line((0, 0), (1, 1)) + line((2, 2), (3, 3))
    points = struct.pack("<BII", 1, 4, 2) + G.point_wkb(1, 2) + G.point_wkb(3, 4)
    bad = [lines[:20], struct.pack("<BII", 1, 7, 0), b""]
    df = spark.createDataFrame([(i, w) for i, w in enumerate([lines, points, line((0, 0), (1, 0)), G.point_wkb(5, 6), *bad])], "id int, geom binary")
    assert [r.geom for r in V.wkt_table(df).orderBy("id").collect()] == ["MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", "MULTIPOINT ((1 2), (3 4))", "LINESTRING (0 0, 1 0)", "POINT (5 6)", None, None, None]
    assert G.geojson(lines)["coordinates"] == [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]
    assert G.geojson(points) == {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}
    assert V.feature_collections(df.withColumn("g", F.lit(1)), "g", "id").first().n_features == 7


def test_large_boxes_have_few_cells(spark):
    rng = np.random.default_rng(0)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-50, 1500, (400, 2)))]
    boxes = [(i, float(x), float(y), float(x + s), float(y + s * 0.3)) for i, (x, y, s) in enumerate(zip(rng.uniform(-50, 900, 40), rng.uniform(-50, 900, 40), 10 ** rng.uniform(-1, 3, 40), strict=True))]
    got = J.within_bounds(spark.createDataFrame(points, "p int, x double, y double"), spark.createDataFrame(boxes, "b int, xmin double, ymin double, xmax double, ymax double"), 1.0)
    expected = {(p, b) for p, x, y in points for b, x1, y1, x2, y2 in boxes if x1 < x < x2 and y1 < y < y2}
    assert expected and sorted((r.p, r.b) for r in got.collect()) == sorted(expected)
    assert math.isfinite(len(expected))


def test_blank_details_are_unknown(spark):
    source = spark.createDataFrame([("p", "n", "", " ", "", "t", 1, 2)], "project_id string, name string, owner_name string, project_type_id string, huc10 string, tags string, created_on int, updated_on int")
    r = J.unmatched(source, source.limit(0)).first()
    assert (r.owner, r.project_type, r.huc, r.tags) == ("UNKNOWN_OWNER", "UNKNOWN_TYPE", "UNKNOWN_HUC", "t")


def test_all_faults_of_a_search_are_told_at_once():
    with pytest.raises(ValueError, match="no field 'x'.*bbox takes.*tags takes"):
        P.check_search({"x": 1, "bbox": [1, 2, 0, 3], "tags": "a"})
    assert P.check_search({"createdOn": {"from": "1970-01-01", "to": "1970-01-02T00:00:00+00:00"}}) == {"createdOn": {"from": 0, "to": 86_400_000}}
