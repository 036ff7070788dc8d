"""Sources, sinks, incremental loads and streams on small files."""

import json
import sqlite3

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions import geometry as G
from headwater.operators import sets
from headwater.operators.quality import list_files, schema_diff
from headwater.session import scratch_dir
from headwater.sources import files as S
from headwater.sources import gpkg, sinks
from headwater.streaming import feeds
from headwater.streaming.incremental import Paths, load_segments, query, run_incremental


def database(path, rows, extra=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    db = sqlite3.connect(path)
    db.execute(f"CREATE TABLE dgos (fid INTEGER PRIMARY KEY, geom POLYGON, width REAL, n MEDIUMINT, label TEXT{extra})")
    db.execute("CREATE TABLE gpkg_contents (table_name TEXT)")
    db.executemany("INSERT INTO dgos (fid, geom, width, n, label) VALUES (?, ?, ?, ?, ?)", rows)
    db.commit()
    db.close()


def test_gpkg_scan(spark, tmp_path):
    blob = gpkg.add_header(G.point_wkb(1, 2), 4326)
    with_envelope = b"GP\x00\x03" + (4326).to_bytes(4, "little") + b"\x00" * 32 + G.point_wkb(3, 4)
    database(tmp_path / "1706030412" / "a.gpkg", [(i, blob, i / 2, i, "x") for i in range(1, 3001)])
    database(tmp_path / "1706030413" / "b.gpkg", [(7, with_envelope, None, None, None)], ", more TEXT")
    df = gpkg.read_gpkg(spark, f"{tmp_path}/*/*.gpkg", "dgos", split_bytes=20_000)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("fid", "bigint"), ("geom", "binary"), ("width", "double"), ("n", "bigint"), ("label", "string"), ("more", "string"), ("source_path", "string"), ("huc", "string")]
    assert df.rdd.getNumPartitions() > 3
    assert {(r.huc, r.n) for r in df.groupBy("huc").agg(F.count("*").alias("n")).collect()} == {("1706030412", 3000), ("1706030413", 1)}
    assert df.select("fid", "huc").distinct().count() == 3001
    other = df.filter("huc = '1706030413'").first()
    assert bytes(other.geom) == G.point_wkb(3, 4) and other.n is None
    pruned = gpkg.read_gpkg(spark, str(tmp_path), "dgos", columns=["width"])
    assert pruned.columns == ["width", "source_path", "huc"] and pruned.agg(F.sum("width")).first()[0] == sum(i / 2 for i in range(1, 3001))
    assert pruned.rdd.getNumPartitions() == 1  # two small files share a task


def watersheds(folder, n):
    """Files of n watersheds, and a file that is no database for every other code asked for."""
    for i in range(n):
        database(folder / f"17060304{i:02d}" / f"m{i}.gpkg", [(k, None, k / 2, k, "Ab" if k % 2 else "ab") for k in range(1, 51)])


def test_gpkg_opens_only_the_watersheds_wanted(spark, tmp_path):
    watersheds(tmp_path, 8)
    wanted = ["1706030401", "1706030403", "1706030406"]
    # the other files cannot be opened, so reading any of them fails
    for i in range(8):
        if f"17060304{i:02d}" not in wanted:
            (tmp_path / f"17060304{i:02d}" / f"m{i}.gpkg").write_bytes(b"no database at all, but long enough to be looked at" * 100)
    df = gpkg.read_gpkg(spark, str(tmp_path), "dgos", hucs=wanted)
    assert {(r.huc, r["count"]) for r in df.groupBy("huc").count().collect()} == {(h, 50) for h in wanted}
    one, other = (gpkg.read_gpkg(spark, str(tmp_path), "dgos", schema=df.schema, hucs=[h]) for h in wanted[:2])
    assert one.unionByName(other).filter("fid < 11").count() == 20
    assert gpkg.read_gpkg(spark, str(tmp_path), "dgos", schema=df.schema, hucs=["1"]).count() == 0
    with pytest.raises(PySparkException):
        gpkg.read_gpkg(spark, str(tmp_path), "dgos", schema=df.schema).count()
    with pytest.raises(ValueError, match="watersheds"):
        gpkg.read_gpkg(spark, str(tmp_path), "dgos", hucs=["1"])


def test_gpkg_tests_become_conditions(spark, tmp_path):
    watersheds(tmp_path, 2)
    everything = gpkg.read_gpkg(spark, str(tmp_path), "dgos")
    tests = {"fid > 40": ("fid", ">", 40), "width <= 3": ("width", "<=", 3), "label = 'ab'": ("label", "=", "ab"), "label > 'Zz'": ("label", ">", "Zz"), "label IN ('Ab', 'x')": ("label", "in", ["Ab", "x"]), "FID IN (3, 4)": ("FID", "in", [3, 4])}
    for text, test in tests.items():
        got = gpkg.read_gpkg(spark, str(tmp_path), "dgos", schema=everything.schema, where=[test, ("n", "<", 48)])
        assert sorted(map(str, got.collect())) == sorted(map(str, everything.filter(text).filter("n < 48").collect())), text
    declared = {"fid": T.LongType(), "label": T.StringType()}
    assert gpkg.row_condition(("FID", ">", 3), declared) == ('"FID" > ?', [3])
    assert gpkg.row_condition(("label", "in", ["a", "b"]), declared) == ('"label" COLLATE BINARY IN (?, ?)', ["a", "b"])
    # a number that a file holds as text compares by other rules
    assert gpkg.row_condition(("label", "=", 3), declared) is None
    assert gpkg.row_condition(("other", "=", 3), declared) is None


def test_gpkg_load_wants_a_schema_for_many_files(spark, tmp_path):
    for i in range(gpkg.LOOKED_AT + 2):
        database(tmp_path / f"{i}.gpkg", [(i, None, 1.0, 1, "a")], ", late TEXT" if i > gpkg.LOOKED_AT else "")
    gpkg.register(spark)
    with pytest.raises((PySparkException, ValueError), match="schema"):
        spark.read.format("gpkg").option("table", "dgos").load(str(tmp_path)).count()
    df = gpkg.read_gpkg(spark, str(tmp_path), "dgos")
    assert "late" in df.columns
    assert df.count() == gpkg.LOOKED_AT + 2
    assert spark.read.format("gpkg").option("table", "dgos").schema("late string, huc string").load(str(tmp_path)).count() == gpkg.LOOKED_AT + 2


def test_all_layers_of_all_files_in_one_scan(spark, tmp_path):
    watersheds(tmp_path, 3)
    db = sqlite3.connect(tmp_path / "1706030401" / "m1.gpkg")
    db.execute("CREATE TABLE extra (a INTEGER, b TEXT)")
    db.execute("INSERT INTO extra VALUES (1, 'x')")
    db.execute("ALTER TABLE dgos ADD COLUMN more REAL")
    db.commit()
    db.close()
    files = gpkg.list_files(spark, str(tmp_path))
    layers = sets.layer_append(files)
    assert set(layers) == {"dgos", "extra"}
    assert [tuple(r) for r in layers["extra"].drop("source_path").collect()] == [(1, "x", "1706030401")]
    assert layers["dgos"].columns == ["fid", "geom", "width", "n", "label", "more", "source_path", "huc"]
    assert layers["dgos"].groupBy("huc").count().count() == 3
    inventory = spark.createDataFrame([("extra",), (None,), ("extra",), ("unknown",)], "layer string")
    assert set(sets.layer_append(files, inventory)) == {"extra"}
    rows = sets.union_huc_tables(files, "dgos", drop=["geom", "more"])
    assert rows.columns == ["fid", "width", "n", "label", "huc10"]
    assert rows.count() == 150
    with pytest.raises(ValueError):
        sets.union_huc_tables(files, "nothing")


def test_gpkg_unknown_table_raises(spark, tmp_path):
    database(tmp_path / "a.gpkg", [])
    with pytest.raises((PySparkException, ValueError)):
        gpkg.read_gpkg(spark, str(tmp_path), "nothing").count()


def test_copy_all_tables(spark, tmp_path):
    database(tmp_path / "in" / "a.gpkg", [(1, None, 1.0, 1, "a")])
    folders = gpkg.copy_tables(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert list(folders) == ["dgos"] and spark.read.parquet(folders["dgos"]).count() == 1


def test_project_documents_as_array_and_by_line(spark, tmp_path):
    docs = [{"id": str(i), "name": "a, [b]", "meta": [{"key": "HUC", "value": "1"}], "tags": ["t"]} for i in range(3)]
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "a.json").write_text(json.dumps(docs, indent=2))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("[\n" + ",\n".join(json.dumps(d) for d in docs) + "\n]\n")
    a = S.read_project_docs(spark, str(tmp_path / "array"))
    b = S.read_project_docs(spark, str(tmp_path / "lines"), one_per_line=True)
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 3 and a.schema == b.schema


def test_context_metrics_unreadable_and_missing(spark, tmp_path):
    for huc, text in {"1706030412": '{"rs_context": {"n": 5}}', "1706030413": "{oops", "1706030414": '{"other": 1}'}.items():
        (tmp_path / huc).mkdir()
        (tmp_path / huc / "metrics.json").write_text(text)
    hucs = spark.createDataFrame([(h,) for h in ("1706030412", "1706030413", "1706030414", "1706030415")], "huc string")
    got = S.read_rs_context(spark, f"{tmp_path}/*/metrics.json", "n bigint", hucs).orderBy("huc").collect()
    assert [(r.rs_context.n, r.readable) for r in got] == [(5, True), (None, False), (None, True), (None, False)]
    assert all(r.rs_context is not None for r in got)


def test_project_xml_and_inventory(spark, tmp_path):
    text = (
        '<Project><ProjectType>t</ProjectType><Warehouse id="w"/><MetaData><Meta name="HUC"> 1 </Meta></MetaData><ProjectBounds><Centroid><Lat>1.5</Lat><Lng>x</Lng></Centroid><Path>b.geojson</Path></ProjectBounds>'
        '<Realizations><A><Inputs><DEM id="D"><Name>dem</Name><Path>in/dem.tif</Path></DEM><Vector id="V"><Name>v</Name><Path>in/v.shp</Path></Vector></Inputs>'
        '<Geopackage id="G"><Name>g</Name><Path>out/g.gpkg</Path><Layers><Vector lyrName="l1"><Name>L1</Name></Vector><Vector lyrName="l2"><Name>L2</Name></Vector></Layers></Geopackage></A></Realizations></Project>'
    )
    for huc, body in {"1706030412": text, "1706030413": text.replace("dem.tif", "other.tif"), "1706030414": "<Project>"}.items():
        (tmp_path / huc).mkdir()
        (tmp_path / huc / "project.rs.xml").write_text(body)
    df = S.read_project_xml(spark, str(tmp_path))
    got = {r.huc: r for r in df.collect()}
    assert not got["1706030414"].readable
    one = got["1706030412"]
    assert (one.project_id, one.has_bounds, one.bounds_path, one.lat, one.lng, one.meta[0].value) == ("w", True, "b.geojson", 1.5, None, "1")
    found = {(r.kind, r.id, r.layer): (r.occurrences, r.path) for r in S.dataset_inventory(df, ["IN/.*", "out/"]).collect()}
    assert found == {("raster", "D", None): (2, "in/dem.tif"), ("shapefile", "V", None): (2, "in/v.shp"), ("geopackage", "G", "l1"): (2, "out/g.gpkg"), ("geopackage", "G", "l2"): (2, "out/g.gpkg")}
    assert S.dataset_inventory(df, ["dem"]).count() == 0  # patterns are anchored at the start
    assert S.dataset_occurrences(df, ["in/"]).filter("full_path like '%/1706030412/in/dem.tif'").count() == 1


def test_geojson_ids_come_from_the_file_name(spark, tmp_path):
    feature = {"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}}
    (tmp_path / "Project_ID_Couse Creek - 642.geojson").write_text(json.dumps({"type": "FeatureCollection", "name": "n", "crs": {}, "features": [feature, feature]}, indent=1))
    got = S.read_geojson(spark, str(tmp_path)).orderBy("feature_no").collect()
    assert [(r.id, r.feature_no, r.geometry.type, json.loads(r.geometry.coordinates)) for r in got] == [("642", 0, "Point", [1.5, 2]), ("642", 1, "Point", [1.5, 2])]


PROJECT = "project_id string, name string, tags string, huc10 string, model_version string, model_version_int bigint, archived boolean, created_on bigint, created_on_date string, owned_by_id string, owned_by_name string, owned_by_type string, project_type_id string"


def test_tsv_round_trip_keeps_every_version_in_its_own_folder(spark):
    path = scratch_dir(spark, "tsv")
    rows = [("1", 'a\t"b"\\t\nc\\\\', "x|y", "h", "1.0.0", 1, True, 5, "d", "o", "n", "USER", "t"), ("2", None, None, "h", "2.0.0", None, False, 6, "d", "o", "\\N", "USER", "t")]
    sinks.write_projects_tsv(spark.createDataFrame(rows, PROJECT), path)
    got = {r.project_id: r for r in S.read_projects_tsv(spark, path).collect()}
    assert got["1"].name == rows[0][1] and got["1"].tags == ["x", "y"] and got["1"].archived is True and got["1"].model_version == "1.0.0"
    assert got["2"].name is None and got["2"].tags is None and got["2"].model_version_int is None and got["2"].owned_by_name == "\\N"
    assert got["2"].model_version == "2.0.0"


def test_replacing_one_watershed_leaves_the_others(spark):
    path = scratch_dir(spark, "huc")
    sinks.write_by_huc(spark.createDataFrame([("1", 1), ("2", 2)], "huc string, v int"), path)
    sinks.write_by_huc(spark.createDataFrame([("2", 3)], "huc string, v int"), path)
    assert {tuple(r) for r in spark.read.schema("v int, huc string").parquet(path).collect()} == {(1, "1"), (3, "2")}


def test_append_contract(spark):
    schema = T.StructType([T.StructField("fid", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    location = scratch_dir(spark, "contract")
    first = spark.createDataFrame([(5,), (4,)], "A int")
    for _ in range(2):  # repeating a load changes nothing
        sinks.append_conformed(first, "contract", schema, "one", ["a"], location, "EPSG:4326")
    sinks.append_conformed(spark.createDataFrame([(9, "x")], "a bigint, B string"), "contract", schema, "two", ["a"], location, next_fid=3)
    assert sorted(tuple(r) for r in spark.table("contract").select("fid", "a", "b").collect()) == [(1, 4, None), (2, 5, None), (3, 9, "x")]
    with pytest.raises(ValueError, match="not in the table"):
        sinks.append_conformed(spark.createDataFrame([(1, 2)], "a int, zzz int"), "contract", schema, "three", ["a"], location)
    with pytest.raises(PySparkException):
        sinks.append_conformed(spark.createDataFrame([("t",)], "a string"), "contract", schema, "four", ["a"], location)
    assert spark.table("contract").count() == 3


def test_schema_diff_finds_uneven_columns(spark):
    path = scratch_dir(spark, "schemas")
    spark.range(2).selectExpr("id", "id as v").coalesce(1).write.parquet(f"{path}/a")
    spark.range(2).selectExpr("cast(id as string) id").coalesce(1).write.parquet(f"{path}/b")
    got = {(r.column_name, r.column_type): (r.n_files, r.n_total) for r in schema_diff(list_files(spark, path)).collect()}
    assert got == {("id", "int64"): (1, 2), ("id", "string"): (1, 2), ("v", "int64"): (1, 2)}


def test_segment_load_opens_only_what_is_missing(spark, tmp_path):
    watersheds(tmp_path / "in", 4)
    root = scratch_dir(spark, "load")
    paths = Paths(f"{root}/data", f"{root}/ledger", f"{root}/rejects")
    files = gpkg.list_files(spark, str(tmp_path / "in"))
    dictionary = [{"name": "fid", "dtype": "INTEGER"}, {"name": "Width", "dtype": "REAL"}, {"name": "gone", "dtype": "STRING"}]
    load = lambda hucs, created: load_segments(spark.createDataFrame([(f"p{h}", h, created) for h in hucs], "project_id string, huc string, created_on long"), files, "dgos", ["none"], "fid", dictionary, {"wide": F.col("width") < 30}, paths)
    assert load(["1706030400", "1706030401", "1799999999"], 5000) == {"loaded": 2, "rejected": 1}
    rows = spark.read.schema("project_id string, fid bigint, Width double, gone string, geom binary, huc string").parquet(paths.data)
    assert rows.groupBy("huc", "project_id").count().orderBy("huc").collect() == [("1706030400", "p1706030400", 50), ("1706030401", "p1706030401", 50)]
    assert rows.agg(F.sum("Width")).first()[0] == 2 * sum(k / 2 for k in range(1, 51))
    # what is loaded, or not in the catalogue, is not opened: it could not be
    for i in (0, 1, 3):
        (tmp_path / "in" / f"17060304{i:02d}" / f"m{i}.gpkg").write_bytes(b"no database at all, but long enough to be looked at" * 100)
    assert load(["1706030400", "1706030401"], 5000) == {"loaded": 0, "rejected": 0}
    assert load(["1706030400", "1706030402"], 5000) == {"loaded": 1, "rejected": 0}
    with pytest.raises(PySparkException):
        load(["1706030400"], 9000)


# --- incremental ------------------------------------------------------------------------------


def test_incremental_load_rejects_and_repeats(spark):
    root = scratch_dir(spark, "inc")
    paths = Paths(f"{root}/data", f"{root}/ledger", f"{root}/rejects")
    catalogue = spark.createDataFrame([("p1", "1", 1000), ("p2", "2", 1000), ("p3", "3", 1000), ("p0", "1", 10)], "project_id string, huc string, created_on bigint")
    inputs = spark.createDataFrame([("1", 1.0), ("1", 2.0), ("2", -1.0), ("2", 1.0)], "huc string, v double")
    run = lambda c, i: run_incremental(c, i, {"negative": F.col("v") > 0}, lambda d: d.select("huc", "v", "project_id"), paths)
    assert run(catalogue, inputs) == {"loaded": 1, "rejected": 2}
    assert {(r.huc, r.reason) for r in spark.read.parquet(paths.rejects).collect()} == {("2", "negative"), ("3", "no input")}
    loaded = lambda: sorted((r.huc, r.v, r.project_id) for r in spark.read.schema("v double, project_id string, huc string").parquet(paths.data).collect())
    assert loaded() == [("1", 1.0, "p1"), ("1", 2.0, "p1")]
    # the good one is done, the rejected ones are tried again
    fixed = spark.createDataFrame([("1", 9.0), ("2", 5.0), ("3", 6.0)], "huc string, v double")
    assert run(catalogue, fixed) == {"loaded": 2, "rejected": 0}
    assert loaded() == [("1", 1.0, "p1"), ("1", 2.0, "p1"), ("2", 5.0, "p2"), ("3", 6.0, "p3")]
    assert run(catalogue, fixed) == {"loaded": 0, "rejected": 0}
    newer = catalogue.union(spark.createDataFrame([("p9", "1", 5000)], catalogue.schema))
    assert run(newer, fixed) == {"loaded": 1, "rejected": 0}
    assert loaded() == [("1", 9.0, "p9"), ("2", 5.0, "p2"), ("3", 6.0, "p3")]


FEED = "project_id string, ts timestamp, project_type_id string"


def feed(spark, path, *batches):
    for batch in batches:
        spark.createDataFrame(batch, "project_id string, t string, project_type_id string").selectExpr("project_id", "to_timestamp(t) ts", "project_type_id").coalesce(1).write.mode("append").parquet(path)


def test_stream_index_equals_batch_over_restarts(spark):
    source, target, checkpoint = (scratch_dir(spark, n) for n in ("src", "dst", "cp"))
    run = lambda: feeds.stream_index(feeds.project_stream(spark, source, FEED, 1), target, checkpoint, lambda d: d, order="ts").awaitTermination()
    feed(spark, source, [("a", "2024-01-01", "t"), ("b", "2024-01-02", "t"), ("b", "2024-01-01", "u")], [("a", "2024-01-05", "t"), ("c", "2024-01-05", "t")])
    run()
    feed(spark, source, [("c", "2024-01-06", "t"), ("d", "2024-01-06", "t")])
    run()
    run()
    got = sorted((r.project_id, str(r.ts)[:10], r.project_type_id) for r in spark.read.schema(FEED).parquet(target).collect())
    assert got == [("a", "2024-01-01", "t"), ("b", "2024-01-01", "u"), ("c", "2024-01-05", "t"), ("d", "2024-01-06", "t")]


def test_stream_index_knows_keys_without_reading_the_index(spark):
    source, target, elsewhere, checkpoint = (scratch_dir(spark, n) for n in ("src", "dst", "else", "cp"))
    run = lambda where, cp: feeds.stream_index(feeds.project_stream(spark, source, FEED, 1), where, cp, lambda d: d, order="ts").awaitTermination()
    got = lambda where: sorted((r.project_id or "", str(r.ts)[:10]) for r in spark.read.schema(FEED).parquet(where).collect())
    feed(spark, source, [("a", "2024-01-03", "t"), (None, "2024-01-01", "t")], [("b", "2024-01-02", "t"), ("b", None, "t")])
    run(target, checkpoint)
    assert got(target) == [("", "2024-01-01"), ("a", "2024-01-03"), ("b", "2024-01-02")]
    # the index is out of sight, its keys are still known: also to a row with a smaller order
    feed(spark, source, [("a", "2024-01-01", "t"), (None, "2024-01-01", "t"), ("c", "2024-01-04", "t")])
    run(elsewhere, checkpoint)
    assert got(elsewhere) == [("c", "2024-01-04")]


def test_stream_index_survives_a_lost_checkpoint(spark):
    source, target = scratch_dir(spark, "src"), scratch_dir(spark, "dst")
    run = lambda cp: feeds.stream_index(feeds.project_stream(spark, source, FEED, 1), target, cp, lambda d: d, order="ts").awaitTermination()
    got = lambda: sorted((r.project_id, str(r.ts)[:10]) for r in spark.read.schema(FEED).parquet(target).collect())
    feed(spark, source, [("a", "2024-01-01", "t")], [("b", "2024-01-02", "t")])
    run(scratch_dir(spark, "cp"))
    feed(spark, source, [("a", "2024-01-05", "t"), ("c", "2024-01-05", "t")])
    again = scratch_dir(spark, "cp")
    run(again)
    assert got() == [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-05")]
    feed(spark, source, [("b", "2024-01-07", "t"), ("d", "2024-01-07", "t")])
    run(again)
    assert got() == [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-05"), ("d", "2024-01-07")]


def test_stream_dedup_over_batches(spark):
    source, target, checkpoint = (scratch_dir(spark, n) for n in ("src", "dst", "cp"))
    feed(spark, source, [("a", "2024-01-01 10:00:00", "t"), ("a", "2024-01-01 11:00:00", "t")], [("a", "2024-01-01 12:00:00", "t"), ("b", "2024-01-01 12:00:00", "t")])
    stream = feeds.stream_dedup(feeds.project_stream(spark, source, FEED, 1))
    feeds.to_parquet(stream, target, checkpoint).awaitTermination()
    assert sorted(r.project_id for r in spark.read.schema(FEED).parquet(target).collect()) == ["a", "b"]


def test_daily_counts_come_when_the_day_is_closed(spark):
    source, target, checkpoint = (scratch_dir(spark, n) for n in ("src", "dst", "cp"))
    feed(spark, source, [("a", "2024-01-01 10:00:00", "t"), ("b", "2024-01-01 23:00:00", "t")], [("c", "2024-01-02 01:00:00", "t")], [("d", "2024-01-03 00:00:00", "u")])
    feeds.to_parquet(feeds.stream_daily(feeds.project_stream(spark, source, FEED, 1)), target, checkpoint).awaitTermination()
    got = [(str(r.day_start)[:10], r.project_type_id, r.n) for r in spark.read.schema("day_start timestamp, project_type_id string, n bigint").parquet(target).collect()]
    assert got == [("2024-01-01", "t", 2)]


def test_sql_takes_arguments_and_tables(spark):
    df = query(spark, "SELECT id + :more AS v FROM {t} WHERE id > :least", {"more": 10, "least": 1}, "a label", t=spark.range(4))
    assert sorted(r.v for r in df.collect()) == [12, 13]
