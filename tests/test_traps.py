"""Exact semantics on hand-made rows, one group per known trap."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions import columns as C
from headwater.operators import joins as J
from headwater.operators import projects as P
from headwater.operators import quality as Q
from headwater.operators import ranking, reshape, sets, stats, tags
from headwater.operators import raster as R
from headwater.streaming.incremental import query

META = "id string, meta array<struct<key:string,value:string>>"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def docs(spark, *metas):
    return spark.createDataFrame([(str(i), [(k, v) for k, v in m]) for i, m in enumerate(metas)], META)


# T1
def test_last_entry_wins_in_maps_first_in_scans(spark):
    df = docs(spark, [("HUC", "a"), ("HUC", "b")])
    got = df.select(C.meta_map(F.col("meta"))["HUC"], C.huc_of(F.col("meta"), "scan"), C.huc_of(F.col("meta"), "normal")).first()
    assert tuple(got) == ("b", "a", "b")


def test_null_meta_is_an_empty_map(spark):
    df = spark.createDataFrame([("1", None)], META)
    assert df.select(C.meta_map(F.col("meta")).alias("m")).first().m == {}


# T2
@pytest.mark.parametrize(
    "text,clean,number",
    [("03.01.05", "3.1.5", 3001005), ("3.1.5-rc1", "3.1.5-rc1", 3001005), ("x", "x", None), (None, None, None), ("1.1000.0", "1.1000.0", 2000000), ("1.2", "1.2", None)],
)
def test_versions(spark, text, clean, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert tuple(df.select(C.version_clean(F.col("v")), C.version_int(F.col("v"))).first()) == (clean, number)


# T3
def test_watershed_code_rules_differ(spark):
    meta = F.col("meta")
    df = docs(spark, [("HUC10", "12345678"), ("HUC", "1706030412"), ("HUV", " 1706-0304-12 ")])
    got = df.select(C.huc_of(meta, "ordered"), C.huc_of(meta, "length"), C.huc_of(meta, "scan"), C.huc_of(meta, "normal"), C.huc_of(meta, "digits")).first()
    assert tuple(got) == ("12345678", "1706030412", "1706030412", "1706030412", "1706030412")
    only = docs(spark, [("HUV", " 1706-0304-12 ")])
    assert tuple(only.select(C.huc_of(meta, "scan"), C.huc_of(meta, "digits"), C.huc_of(meta, "ordered")).first()) == (" 1706-0304-12 ", "1706030412", None)


def test_unknown_rule_raises():
    with pytest.raises(ValueError):
        C.huc_of(None, "no such rule")


# T4
def test_page_ties_are_not_lost(spark):
    df = spark.createDataFrame([(str(i), 100 if i < 5 else 50) for i in range(7)], "project_id string, created_on bigint")
    seen, after = [], None
    while True:
        page = P.search_page(df, "DATE_CREATED_DESC", after, 2).collect()
        if not page:
            break
        seen += [r.project_id for r in page]
        after = (page[-1].created_on, page[-1].project_id)
    assert seen == ["0", "1", "2", "3", "4", "5", "6"]


def test_every_sort_order(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "n2", 7, "me", 0.0, 0.0, 2.0, 2.0), ("b", 2, None, "n1", None, "you", 0.0, 0.0, 1.0, 1.0)],
        "project_id string, created_on bigint, updated_on bigint, name string, model_version_int bigint, owner_id string, xmin double, ymin double, xmax double, ymax double",
    )
    first = {s: P.search_page(df, s, limit=1, me="you").first().project_id for s in P.SORTS}
    assert first == {
        "AREA_DESC": "a", "DATE_CREATED_ASC": "a", "DATE_CREATED_DESC": "b", "DATE_UPDATED_ASC": "a", "DATE_UPDATED_DESC": "a",
        "MINE": "b", "MODEL_VERSION_ASC": "a", "MODEL_VERSION_DESC": "a", "NAME_ASC": "b", "NAME_DESC": "a",
    }


# T5, T13
def test_huc4_is_four_digits_and_percent_whole(spark):
    hucs = spark.createDataFrame([("1706030412",), ("1706030413",), ("1706030414",), ("1801000000",)], "huc10 string")
    projects = spark.createDataFrame([("p", "1706030412", "t", "1.0.0")], "project_id string, huc10 string, project_type_id string, model_version string")
    assert rows(stats.huc4_status(projects, hucs).select("huc4", "huc10_count", "project_count", "project_pc")) == [("1706", 3, 1, 33.0), ("1801", 1, None, 0.0)]


# T6
def test_staleness_is_to_the_second_and_any_older_row_counts(spark):
    cat = spark.createDataFrame([("p", "h1", 1000999), ("q", "h2", 1000999), ("r", "h3", 5), ("s", "h4", 1000999)], "project_id string, huc string, created_on bigint")
    loaded = spark.createDataFrame([("h1", 1000000), ("h2", 999999), ("h4", 2000000), ("h4", 999999)], "huc string, loaded_ts bigint")
    assert rows(J.missing_or_stale(cat, loaded).select("project_id")) == [("q",), ("r",), ("s",)]
    assert rows(J.missing_or_stale(cat, loaded, since_ms=1000).select("project_id")) == [("q",), ("s",)]


# T7
def test_latest_match_drops_unmatched_unless_asked(spark):
    kind = "project_id string, huc10 string, created_on bigint, updated_on bigint"
    source = spark.createDataFrame([("s1", "17-1", 0, None), ("s2", "99", 0, None)], kind)
    target = spark.createDataFrame([("a", "171", 5, None), ("b", "171", 1, 9), ("c", "171", 7, None)], kind)
    assert rows(J.match_latest(source, target).select("project_id", "match_id")) == [("s1", "b")]
    assert rows(J.match_latest(source, target, how="left").select("project_id", "match_id")) == [("s1", "b"), ("s2", None)]


# T8
def test_remote_only_is_an_anti_join(spark):
    kind = "k string, name string, meta map<string,string>"
    local = spark.createDataFrame([("a", "x", {"p": "1", "q": "2"}), ("b", None, {}), ("c", "y", {})], kind)
    remote = spark.createDataFrame([("a", "x", {"q": "2", "p": "1"}), ("b", None, {"z": "1"}), ("d", "y", {})], kind)
    assert rows(J.sync_compare(local, remote, "k", ["name"]).select("k", "status", "first_change"), "k") == [("a", "same", None), ("b", "update", "meta"), ("c", "create", None), ("d", "remote_only", None)]


def stats_tables(spark, values):
    dgos = spark.createDataFrame([(1, "F1", 1.0, 10.0, "h"), (2, "F1", 3.0, 20.0, "h")], "dgoid bigint, fcode string, centerline_length double, segment_area double, huc10 string")
    look = "name string, id int, where_clause string"
    states = spark.createDataFrame([("S", 1, "1"), ("T", 2, "1,2")], look)
    flows = spark.createDataFrame([("F", 1, "F1"), ("G", 2, "F1,F2")], look)
    owners = spark.createDataFrame([("O", 1, "7")], look)
    base = [(1, 2, 1.0), (2, 2, 1.0), (1, 1, 7.0)]
    return dgos, spark.createDataFrame(base + values, "dgo_id bigint, metric_id int, metric_value double"), states, flows, owners


# T10
def test_weights_of_null_values_count(spark):
    out = stats.huc_statistics(*stats_tables(spark, [(1, 4, 2.0), (2, 4, None)]))
    got = out.filter("state_id = 1 AND flow_id = 1 AND owner_id IS NULL").first()
    assert (got.dgo_count, got.total_length, got.channel_gradient) == (2, 4.0, 0.5)
    summary = stats.metric_summary(*stats_tables(spark, [(1, 4, 2.0), (2, 4, None)])[:2], 4, ["huc10"]).first()
    assert (summary.length_weighted, summary.zero_area) == (0.5, 0.0)


# T11, T26, T27
def test_codes_in_several_groups_count_in_each(spark):
    out = stats.huc_statistics(*stats_tables(spark, [(1, 16, 5.0), (1, 16, 5.0)]))
    got = {(r.state_id, r.flow_id, r.owner_id): (r.dgo_count, r.channel_length) for r in out.collect()}
    assert set(got) == {(s, f, o) for s in (1, 2) for f in (1, 2) for o in (None, 1)}
    assert got[1, 1, None] == (2, 10.0) and got[2, 2, 1] == (1, 10.0)
    names = {n for _, _, n in stats.HUC_METRICS}
    assert len(stats.HUC_METRICS) == 16 and names < set(out.columns)
    assert {"huc10", "state_id", "flow_id", "owner_id", "dgo_count"} < set(out.columns)


def test_a_doubled_state_row_doubles_the_segment(spark):
    out = stats.huc_statistics(*stats_tables(spark, [(1, 2, 1.0), (1, 37, 0.0)]))
    got = out.filter("state_id = 1 AND flow_id = 1 AND owner_id IS NULL").first()
    assert (got.dgo_count, got.total_length, got.lui_zero_area, got.land_use_intensity) == (3, 5.0, 20.0, 0.0)


# T12
def test_zero_divisors_give_null(spark):
    names = ["riparian_area", "riparian_departure", "channel_length", "total_length", "total_area", "road_length", "rail_length", "riparian_ag_conv_area", "riparian_developed_area"]
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 1.0, 1.0, 1.0)], ", ".join(f"{n} double" for n in names))
    got = stats.secondary_metrics(df).first().asDict()
    assert all(got[n] is None for n in set(got) - set(names))


# T14, T15
def test_newest_is_kept(spark):
    kind = "project_id string, owner_name string, project_type_id string, huc10 string, created_on bigint, model_version_int bigint"
    df = spark.createDataFrame([("a", "o", "t", "h", 1, 5), ("b", "o", "t", "h", 2, 3), ("c", "o", "t", "h", 2, None), ("d", "o", "t", "i", 1, 1)], kind)
    meta = spark.createDataFrame([(p, k, v) for p in "abcd" for k, v in (("HUC", "1"), ("V", "1"))], "project_id string, key string, value string")
    assert rows(ranking.keep_delete(df, meta, "HUC", "V").select("project_id", "status")) == [("a", "DELETE"), ("b", "DELETE"), ("c", "KEEP"), ("d", "DELETE")]
    assert rows(ranking.latest_by_version(df).select("project_id", "deletable")) == [("a", False), ("b", True), ("c", True)]
    assert rows(ranking.older_duplicates(df).select("project_id")) == [("a",), ("b",)]


# T16
def test_all_null_epochs_are_dropped_and_repeats_averaged(spark):
    df = spark.createDataFrame([(1, 2.0, None, None), (1, 4.0, 1.0, None), (2, None, None, None)], "fid int, wet_5yr_1989_1993_68pc_area double, wet_5yr_1989_1993_68pc_width double, other double")
    assert rows(reshape.epoch_table(df).select("dgo_id", "landcover", "epoch_length", "epoch_name", "confidence", "area", "width")) == [(1, "wet", "5", "1989_1993", "68", 3.0, 1.0)]
    assert reshape.epoch_long(df).count() == 6


# T17
def test_content_hash_ignores_row_and_column_order_but_not_repeats(spark):
    a = spark.createDataFrame([(1, "x", b"\x01"), (2, None, None), (2, None, None)], "i int, s string, b binary")
    same = lambda x, y: Q.same_content(x, y).first().equal
    assert same(a, a.select("s", "b", "i").orderBy(F.desc("i")))
    assert not same(a, a.dropDuplicates())
    assert not same(a, a.withColumn("s", F.coalesce("s", F.lit(""))))
    assert rows(Q.content_difference(a, a.dropDuplicates()).select("i", "only_in")) == [(2, "a")]


# T18
def test_visit_padding_never_cuts(spark):
    df = spark.createDataFrame([("7",), ("12345",)], "v string")
    assert [r[0] for r in df.select(tags.pad4(F.col("v"))).collect()] == ["0007", "12345"]


# T19
def test_four_decimals_round_the_binary_value(spark):
    df = spark.createDataFrame([(2.00005,), (-1.23455,), (1234567.0,)], "v double")
    assert [r[0] for r in df.select(C.fixed4(F.col("v"))).collect()] == ["2.0000", "-1.2346", "1234567.0000"]


CELLS = "raster_id int, r int, c int, value double"


# T20
def test_bins(spark):
    cells = spark.createDataFrame([(1, 0, 0, 100.0), (2, 0, 0, 150.0), (2, 0, 1, 200.0), (2, 0, 2, 300.0), (4, 0, 0, 50.0), (4, 0, 1, 350.0)], CELLS)
    got = rows(R.bin_continuous(cells, 100).select("raster_id", "bin", "cell_count", "value_count"), "raster_id", "bin")
    assert got == [(1, None, None, 1), (2, 100, 1, 3), (2, 200, 2, 3), (4, 0, 1, 2), (4, 100, 0, 2), (4, 200, 0, 2), (4, 300, 1, 2)]


def test_float32_bins(spark):
    cells = spark.createDataFrame([(1, 0, 0, 99.999999999), (1, 0, 1, 150.0)], CELLS)
    assert [r.bin for r in R.bin_continuous(cells, 100).orderBy("bin").collect()] == [0, 100]
    assert [r.bin for r in R.bin_continuous(cells, 100, float32=True).orderBy("bin").collect()] == [100]


# T21
def test_categories_cut_to_the_same_number_are_added(spark):
    cells = spark.createDataFrame([(1, 0, 0, 1.2), (1, 0, 1, 1.9), (1, 0, 2, -0.5)], CELLS)
    assert rows(R.bin_categorical(cells).select("category", "cell_count", "min", "max", "value_count")) == [(0, 1, -0.5, 1.9, 3), (1, 2, -0.5, 1.9, 3)]


# T22
def test_points_outside_and_on_nodata_are_null(spark):
    head = spark.createDataFrame([(1, 0.0, 20.0, 10.0, -10.0, 2, 2, -9.0)], "raster_id int, left_x double, top_y double, cell_width double, cell_height double, n_rows int, n_cols int, nodata double")
    cells = spark.createDataFrame([(1, 0, 0, 5.0), (1, 1, 1, -9.0)], CELLS)
    points = spark.createDataFrame([("in", 1, 5.0, 15.0), ("left", 1, -5.0, 15.0), ("above", 1, 5.0, 25.0), ("nodata", 1, 15.0, 5.0), ("gap", 1, 15.0, 15.0)], "p string, raster_id int, x double, y double")
    assert {r.p: r.value for r in R.sample(cells, head, points).collect()} == {"in": 5.0, "left": None, "above": None, "nodata": None, "gap": None}


def test_minimum_near_nodata_is_nodata(spark):
    head = spark.createDataFrame([(1, -9999.0), (2, -9999.0), (3, None)], "raster_id int, nodata double")
    cells = spark.createDataFrame([(1, 0, 0, -9998.5), (1, 0, 1, 3.0), (2, 0, 0, -9000.0), (2, 0, 1, float("nan")), (3, 0, 0, 1.0)], CELLS)
    assert rows(R.mask_nodata(cells, head).select("raster_id", "value")) == [(1, 3.0), (2, -9000.0), (3, 1.0)]


def test_overview_levels():
    assert R.overview_levels(2048, 4096, 512) == [2]
    assert R.overview_levels(512, 512, 512) == []
    assert R.overview_levels(5000, 5000, 512) == [2, 4, 8]


# T24
def test_bad_sql_raises_instead_of_giving_nothing(spark):
    with pytest.raises(Exception, match="no_such_table"):
        query(spark, "SELECT * FROM no_such_table").count()


# T25
def test_no_search_parameters_is_no_filter_but_archived(spark):
    df = spark.createDataFrame([("a", True), ("b", False)], "project_id string, archived boolean")
    assert rows(P.search_projects(df, {}).select("project_id")) == [("b",)]
    assert P.search_projects(df, {"excludeArchived": False}).count() == 2


def test_editable_only_needs_the_user(spark):
    df = spark.createDataFrame([("a", False, "me"), ("b", False, "you")], "project_id string, archived boolean, owner_id string")
    assert rows(P.search_projects(df, {"editableOnly": True}, me="me").select("project_id")) == [("a",)]
    with pytest.raises(ValueError):
        P.search_projects(df, {"editableOnly": True})


@pytest.mark.parametrize(
    "bad",
    [
        {"color": "red"}, {"keywords": 3}, {"editableOnly": 1}, {"excludeArchived": "yes"}, {"createdOn": {"from": "soon"}}, {"createdOn": {"from": "2024-02-01", "to": "2024-01-01"}}, {"createdOn": {}},
        {"createdOn": {"from": "2024-01-01"}, "createdWithin": "ONE_DAY"}, {"createdWithin": "A_YEAR"}, {"collection": "no"}, {"tags": "a"}, {"meta": {"a": 1}},
        {"ownedBy": {"id": "x", "type": "USER"}}, {"ownedBy": {"id": "0" * 36, "type": "GROUP"}}, {"bbox": [1, 2, 3]}, {"bbox": [3, 0, 1, 1]}, {"visibility": "OPEN"},
    ],
)
def test_search_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        P.check_search(bad)


# lists, tags and attributions
ATTRIBUTION = "project_id string, attribution array<struct<organizationId:string,roles:array<string>>>"


def test_attribution_equality_ignores_role_order(spark):
    df = spark.createDataFrame([("a", [("o", ["X", "Y"])]), ("b", [("p", ["X"]), ("o", ["Y"])]), ("c", None), ("d", [(None, ["X"]), ("o", ["Y", "X", "X"])])], ATTRIBUTION)
    run = lambda mode: {r.project_id: [(x.organizationId, sorted(x.roles)) for x in r.new_attribution] for r in tags.attribution_resolve(df, "o", ["Y", "X"], mode).collect()}
    assert run("ADD") == {"b": [("p", ["X"]), ("o", ["X", "Y"])], "c": [("o", ["X", "Y"])]}
    assert run("REPLACE") == {"b": [("o", ["X", "Y"])], "c": [("o", ["X", "Y"])]}
    assert run("REMOVE") == {"a": [], "b": [("p", ["X"])], "d": []}


def test_tag_modes(spark):
    df = spark.createDataFrame([("a", ["y", "x"]), ("b", None), ("c", ["x", "x"])], "project_id string, tags array<string>")
    run = lambda mode: {r.project_id: r.new_tags for r in tags.tags_add(df, ["x", "y"], mode).collect()}
    assert run("add") == {"b": ["x", "y"], "c": ["x", "x", "y"]}
    assert run("replace") == {"b": ["x", "y"], "c": ["x", "y"]}
    assert {r.project_id for r in tags.tags_missing_any(df, ["x", "y"]).collect()} == {"b", "c"}
    assert {r.project_id: r.new_tags for r in tags.tags_remove(df, "x").collect()} == {"a": ["y"], "c": []}


def test_canonical_tags_replace_own_and_keep_foreign(spark):
    df = spark.createDataFrame(
        [("a", "topo", ["CHaMP_old", "mine", "CHAMP_Year_2011"], {"Watershed": "JohnDay", "Site": "S 1", "Year": "2011", "VisitID": "12"}), ("b", "fhm", [], {"Watershed": "Entiat (Lower)", "Site": "", "SiteName": "T"}), ("c", "topo", [], {"Watershed": "W", "Site": "S", "Year": "0", "Visit": "1"})],
        "project_id string, project_type_id string, tags array<string>, meta_map map<string,string>",
    )
    out = {r.project_id: r for r in tags.tags_canonical(df).collect()}
    assert set(out) == {"a", "b"}
    assert out["a"].new_tags == ["mine", "CHAMP_Watershed_John_Day", "CHAMP_Site_S_1", "CHAMP_Year_2011", "CHAMP_Visit_0012"]
    assert (out["a"].added_year, out["a"].added_visit, out["a"].changed) == (0, 1, True)
    assert out["b"].new_tags == ["CHAMP_Watershed_Entiat_Lower", "CHAMP_Site_T"]
    assert {r.project_id: r.missing for r in tags.required_meta(df).collect()}["c"] == ["year"]
    assert tuple(tags.tag_additions(tags.tags_canonical(df)).first()) == (2, 2, 2, 0, 1)


# reshaping and sets
def test_conform_matches_names_without_case_and_reports(spark):
    df = spark.createDataFrame([("1", "x", 2.5)], "A string, b string, extra double")
    dictionary = [{"name": "a", "dtype": "INTEGER"}, {"name": "B", "dtype": "FLOAT"}, {"name": "g", "dtype": "GEOMETRY", "is_required": True}]
    out = reshape.conform(df, dictionary)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [("a", T.LongType()), ("B", T.DoubleType()), ("g", T.BinaryType())]
    assert tuple(out.first()) == (1, None, None)
    assert rows(reshape.conform_report(df, dictionary)) == [("missing_required", "g"), ("undefined", "extra")]
    assert rows(reshape.value_report(df, dictionary)) == [("B", 0, 1), ("a", 0, 0)]


def test_measurement_documents(spark):
    import json

    table = lambda n: spark.createDataFrame([(1, i, i * 1.5) for i in range(n)], "visit_id int, row_id int, v double")
    names = ["Invertebrate Sample", "Solar Exposure"]
    out = reshape.measurement_docs({"InverterbrateSample": table(7), "SolarExposure": table(1)}, names, chunk=3).collect()
    assert {r.file_name for r in out} == {"Invertebrate_Sample", "Solar_Exposure"}
    entries = [e for r in out if r.file_name == "Invertebrate_Sample" for e in json.loads(r.document)["value"]]
    assert sorted(e["value"]["v"] for e in entries) == [i * 1.5 for i in range(7)]
    assert entries[0]["MeasurementType"] == "Invertebrate Sample" and set(entries[0]) == {"note", "MeasurementType", "qaDecision", "value", "objectType"}
    with pytest.raises(ValueError, match="not a known"):
        reshape.measurement_docs({"Nope": table(1)}, names)
    with pytest.raises(ValueError, match="same file"):
        reshape.measurement_docs({"InverterbrateSample": table(1), "InvertebrateSample": table(1)}, names)


def test_insert_ignore_keeps_the_first_of_a_key(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 5), ("b", 3)], "k string, v int")
    assert rows(sets.insert_ignore(old, new, ["k"], "v")) == [("b", 3)]
    assert sets.insert_ignore(old, new, ["k"]).count() == 1


def test_chunked_lists_hold_every_row_once(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("u"))
    out = J.chunked_lists(df, ["k"], "u", [], "items", chunk=100)
    found = out.select("part", "part_count", F.explode("items").alias("x")).collect()
    assert sorted(r.x.u for r in found) == list(range(1000))
    assert out.count() == 10 and {r.part_count for r in found} == {10}


def test_row_numbers_have_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    assert [r.row_id for r in ranking.with_row_number(df, ["v"]).orderBy("v").collect()] == list(range(1, 1001))


def test_merge_gives_new_keys_and_moves_children(spark):
    parents = spark.createDataFrame([("h1", 1, "a"), ("h1", 2, "b"), ("h2", 1, "c")], "huc10 string, dgoid bigint, name string")
    child = spark.createDataFrame([("h2", 1, 5), ("h1", 2, 6), ("h3", 1, 7)], "huc10 string, dgoid bigint, v int")
    renewed, moved = J.merge_remap(parents, {"c": child}, "dgoid")
    assert rows(renewed.select("dgoid", "name")) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(moved["c"].select("dgoid", "v")) == [(2, 6), (3, 5)]


def test_boxes_are_open(spark):
    points = spark.createDataFrame([(1, 0.0, 0.5), (2, 0.5, 0.5), (3, 2.5, 0.2)], "p int, x double, y double")
    boxes = spark.createDataFrame([("b", 0.0, 0.0, 1.0, 1.0), ("big", -10.0, -10.0, 10.0, 10.0)], "box string, xmin double, ymin double, xmax double, ymax double")
    assert rows(J.within_bounds(points, boxes, 1.0).select("p", "box")) == [(1, "big"), (2, "b"), (2, "big"), (3, "big")]


def test_artifact_states(spark):
    kind = "huc10 string, has_bounds boolean, has_meta boolean"
    context = spark.createDataFrame([("0000000001", True, True), ("0000000002", False, True), ("0000000003", True, True), ("0000000004", True, True), ("0000000005", True, True), ("12", True, True)], kind)
    target = spark.createDataFrame([("0000000002", True, True), ("0000000003", True, True), ("0000000004", False, True), ("0000000005", True, False), ("0000000006", True, True)], kind)
    assert [r.status for r in Q.artifact_status(context, target).orderBy("huc10").collect()] == ["missing_target", "no_bounds", "replaced", "inserted", "inserted_no_meta", "missing_context"]


def test_small_text_helpers(spark):
    df = spark.createDataFrame([(512.0, "s3:\\\\bucket\\a", "1,2", "a" * 36), (3 * 1024.0**2, "s3:/bucket/a", None, "G" * 36)], "n double, uri string, t string, g string")
    got = rows(df.select(C.human_size(F.col("n")).alias("a"), C.object_uri(F.col("uri")).alias("b"), C.tsv_safe(F.col("t")).alias("c"), C.is_guid(F.col("g")).alias("d")))
    assert got == [("3.0 MB", "s3://bucket/a", "", False), ("512.0 B", "s3://bucket/a", "1|2", True)]


def test_watermark_is_the_midnight_before(spark):
    df = spark.createDataFrame([(86400000 * 3 + 5,), (7,)], "created_on bigint")
    assert tuple(ranking.watermark(df).first()) == (86400000 * 3 + 5, 86400000 * 3)


def test_map_clusters_count_everything(spark):
    df = spark.createDataFrame([(-120.0 + i % 7, 45.0, -119.9 + i % 7, 45.1) for i in range(50)], "xmin double, ymin double, xmax double, ymax double")
    got = P.map_clusters(df, 4, 3).collect()
    assert sum(r.n for r in got) == 50 and len(got) == 4


def test_geohash_of_a_known_place(spark):
    # 57.64911 N 10.40744 E is the published example u4pruydqqvj
    df = spark.createDataFrame([(10.40744, 57.64911, 10.40744, 57.64911)], "xmin double, ymin double, xmax double, ymax double")
    assert P.map_clusters(df, 11, 1).first().geohash == "u4pruydqqvj"
