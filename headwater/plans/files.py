"""Source and sink queries: each writes files derived from the tables and reads them back."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions.columns import version_int
from headwater.operators import projects as P
from headwater.operators import quality, sets
from headwater.operators.vector import as_wkt, feature_collections
from headwater.plans.bindings import huc_from
from headwater.plans.catalogue import _INDEX_SQL
from headwater.plans.registry import query
from headwater.plans.reshaping import context_docs
from headwater.plans.vectors import squares
from headwater.session import scratch_dir
from headwater.sources import files as S
from headwater.sources import gpkg, sinks

# --- GeoPackages ------------------------------------------------------------------------------


def geopackages(t, orphans: bool = False) -> str:
    """Folder of GeoPackages with the squares and a metrics table, one per watershed and Arrow batch.

    ``orphans``: every tenth square has a second metrics row, for a square that is not there.
    """
    folder = scratch_dir(t.spark, "gpkg")
    rows = squares(t).select(huc_from(F.col("feature_id")).alias("huc"), "feature_id", "gx", "geom").hint("rebalance", "huc")

    def databases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            by_huc: dict[str, list] = {}
            for row in batch.to_pylist():
                by_huc.setdefault(row["huc"], []).append(row)
            names, contents = [], []
            for huc, members in by_huc.items():
                db = sqlite3.connect(":memory:")
                db.execute("CREATE TABLE gpkg_contents (table_name TEXT)")
                db.execute("CREATE TABLE dgos (fid INTEGER PRIMARY KEY, geom POLYGON, level_path TEXT)")
                db.execute("CREATE TABLE dgo_desc (fid INTEGER PRIMARY KEY, width DOUBLE, unused TEXT)")
                db.executemany("INSERT INTO dgos VALUES (?, ?, ?)", [(m["feature_id"], gpkg.add_header(m["geom"], 5070), f"L{m['gx']}") for m in members])
                db.executemany("INSERT INTO dgo_desc VALUES (?, ?, ?)", [(m["feature_id"], m["gx"] / 4, "x") for m in members])
                if orphans:
                    db.executemany("INSERT INTO dgo_desc VALUES (?, ?, ?)", [(-1 - m["feature_id"], 0, "x") for m in members if m["feature_id"] % 10 == 0])
                db.commit()
                names.append(f"{huc}/metrics-t{task}-b{number}.gpkg")
                contents.append(db.serialize())
                db.close()
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(contents, type=pa.binary())], names=["name", "content"])

    sinks.write_named_files(rows.mapInArrow(databases, "name string, content binary"), folder)
    return folder


_WKT = "'POLYGON ((' || CAST(xmin AS BIGINT) || ' ' || CAST(ymin AS BIGINT) || ', ' || CAST(xmax AS BIGINT) || ' ' || CAST(ymin AS BIGINT) || ', ' || CAST(xmax AS BIGINT) || ' ' || CAST(ymax AS BIGINT) || ', ' || CAST(xmin AS BIGINT) || ' ' || CAST(ymax AS BIGINT) || ', ' || CAST(xmin AS BIGINT) || ' ' || CAST(ymin AS BIGINT) || '))'"
_SQUARE_HUC = "CAST(1700000000 + (feature_id % 300) * 1000003 AS VARCHAR)"


@query("src_gpkg", "v_boxes", f"SELECT feature_id AS fid, 'L' || gx AS level_path, {_WKT} AS geom, {_SQUARE_HUC} AS huc, gx / 4e0 AS width FROM v_boxes")
def src_gpkg(t):
    folder = geopackages(t)
    dgos = gpkg.read_gpkg(t.spark, f"{folder}/*/*.gpkg", "dgos").drop("source_path")
    desc = gpkg.read_gpkg(t.spark, folder, "dgo_desc", columns=["fid", "width"]).drop("source_path", "huc")
    return dgos.join(desc, "fid").withColumn("geom", as_wkt(F.col("geom")))


@query("table_copy_all", "v_boxes", "SELECT 'dgos' AS table_name, count(*) AS n, CAST(sum(feature_id) AS BIGINT) AS fid_sum FROM v_boxes UNION ALL SELECT 'dgo_desc', count(*), CAST(sum(feature_id) AS BIGINT) FROM v_boxes")
def table_copy_all(t):
    copied = gpkg.copy_tables(t.spark, geopackages(t), scratch_dir(t.spark, "copied"))
    counts = [t.spark.read.parquet(folder).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.sum("fid").alias("fid_sum")) for name, folder in copied.items()]
    return counts[0].unionByName(counts[1])


@query("union_huc_tables", "v_boxes", f"SELECT feature_id AS fid, 'L' || gx AS level_path, {_SQUARE_HUC} AS huc10 FROM v_boxes")
def union_huc_tables(t):
    return sets.union_huc_tables(gpkg.list_files(t.spark, geopackages(t)), "dgos", drop=["geom"])


@query(
    "layer_append",
    "v_boxes",
    f"""SELECT 'dgos' AS layer, feature_id AS fid, 'L' || gx AS level_path, CAST(NULL AS DOUBLE) AS width, {_SQUARE_HUC} AS huc FROM v_boxes
    UNION ALL SELECT 'dgo_desc', feature_id, NULL, gx / 4e0, {_SQUARE_HUC} FROM v_boxes""",
)
def layer_append(t):
    merged = sets.layer_append(gpkg.list_files(t.spark, geopackages(t)))
    rows = [df.drop("geom", "unused", "source_path").withColumn("layer", F.lit(name)) for name, df in merged.items()]
    return rows[0].unionByName(rows[1], allowMissingColumns=True)


@query(
    "merge_databases",
    "v_boxes",
    f"""WITH b AS (SELECT feature_id, gx, {_SQUARE_HUC} AS huc FROM v_boxes)
    SELECT 'row' AS kind, row_number() OVER (ORDER BY huc, feature_id) AS fid, huc, gx / 4e0 AS width, CAST(NULL AS BIGINT) AS orphans FROM b
    UNION ALL SELECT 'dgo_desc', NULL, huc, NULL, count(*) FROM b WHERE feature_id % 10 = 0 GROUP BY huc""",
)
def merge_databases(t):
    _, children, orphans = sets.merge_databases(gpkg.list_files(t.spark, geopackages(t, orphans=True)), "dgos", "dgo_.*", "fid")
    rows = children["dgo_desc"].select(F.lit("row").alias("kind"), "fid", "huc", "width")
    return rows.unionByName(orphans.withColumnRenamed("child", "kind"), allowMissingColumns=True)


# --- documents --------------------------------------------------------------------------------


@query("src_json_docs", "v_projects v_meta_last v_version_int", _INDEX_SQL)
def src_json_docs(t):
    folder = scratch_dir(t.spark, "docs")
    # as many files as it takes for each to hold about five thousand projects
    n_files = F.ceil(t.docs.agg(F.count(F.lit(1)) / 5000).scalar())
    text = t.docs.select(F.to_json(F.struct(*t.docs.columns)).alias("j"), F.pmod(F.xxhash64("id"), n_files).alias("file_no"))
    arrays = text.groupBy("file_no").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("j"), ",\n"), F.lit("\n]")).alias("content"))
    sinks.write_named_files(arrays.select(F.concat(F.lit("projects_"), F.col("file_no").cast("string"), F.lit(".json")).alias("name"), "content"), folder)
    return P.index_projects(S.read_project_docs(t.spark, folder))


@query("src_json_docs_by_line", "v_projects v_meta_last v_version_int", _INDEX_SQL)
def src_json_docs_by_line(t):
    folder = scratch_dir(t.spark, "doc-lines")
    t.docs.select(F.concat(F.to_json(F.struct(*t.docs.columns)), F.lit(",")).alias("value")).write.text(folder)
    return P.index_projects(S.read_project_docs(t.spark, folder, one_per_line=True))


@query(
    "src_metrics_json",
    "v_hucs v_dgos",
    """WITH d AS (SELECT huc10, count(*) AS n FROM v_dgos GROUP BY 1)
    SELECT h.huc10 AS huc, CASE WHEN substr(h.huc10, 4, 1) <> '5' THEN d.n END AS value_count, coalesce(d.n IS NOT NULL AND substr(h.huc10, 4, 1) <> '5', false) AS readable
    FROM (SELECT huc10 FROM v_hucs UNION SELECT '1234567890') h LEFT JOIN d ON h.huc10 = d.huc10""",
)
def src_metrics_json(t):
    folder = scratch_dir(t.spark, "metrics")
    body = F.to_json(F.struct(F.struct(F.col("dem_bins.value_count").alias("value_count"), F.col("ownership")).alias("rs_context")))
    broken = F.when(F.substring("huc", 4, 1) == "5", F.lit('{"rs_context": {')).otherwise(body)
    sinks.write_named_files(context_docs(t).select(F.concat("huc", F.lit("/metrics.json")).alias("name"), broken.alias("content")), folder)
    hucs = t.hucs.select(F.col("huc10").alias("huc")).union(t.hucs.agg(F.lit("1234567890").alias("huc")))
    docs = S.read_rs_context(t.spark, f"{folder}/*/metrics.json", "value_count bigint, ownership map<string,double>", hucs)
    return docs.select("huc", "rs_context.value_count", "readable")


def project_files(t) -> str:
    """Folder with one project file per watershed, of its newest project; some are not XML."""
    folder = scratch_dir(t.spark, "xml")
    newest = t.projects.filter("huc10 IS NOT NULL").groupBy("huc10").agg(F.max_by(F.struct("project_id", "project_type_id", "archived", "xmin", "ymin", "xmax", "ymax"), F.struct("created_on", "project_id")).alias("p")).select("huc10", "p.*")
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))
    box = F.concat(*[tag(n, F.col(c)) for n, c in (("MinLat", "ymin"), ("MinLng", "xmin"), ("MaxLat", "ymax"), ("MaxLng", "xmax"))])
    centre = F.concat(tag("Lat", (F.col("ymin") + F.col("ymax")) / 2), tag("Lng", (F.col("xmin") + F.col("xmax")) / 2))
    bounds = F.when(F.col("archived"), "").otherwise(F.concat(F.lit("<ProjectBounds><Centroid>"), centre, F.lit("</Centroid><BoundingBox>"), box, F.lit("</BoundingBox><Path>bounds.geojson</Path></ProjectBounds>")))
    datasets = F.concat(
        F.lit('<Realizations><R><Raster id="DEM"><Name>Elevation</Name><Path>inputs/dem_'), F.col("project_type_id"), F.lit('.tif</Path></Raster><Raster id="TMP"><Name>T</Name><Path>scratch/t.tif</Path></Raster>'),
        F.lit('<Geopackage id="OUT"><Name>Out</Name><Path>outputs/out.gpkg</Path><Layers><Vector lyrName="'), F.col("project_type_id"), F.lit('"><Name>Lines</Name></Vector></Layers></Geopackage>'),
        F.lit('<Vector id="SHP"><Name>Shape</Name><Path>outputs/shape.shp</Path></Vector></R></Realizations>'),
    )
    meta = F.concat(F.lit('<MetaData><Meta name="HUC">'), F.col("huc10"), F.lit("</Meta></MetaData>"))
    whole = F.concat(F.lit("<Project>"), tag("ProjectType", F.col("project_type_id")), F.lit('<Warehouse id="'), F.col("project_id"), F.lit('"/>'), meta, bounds, datasets, F.lit("</Project>"))
    content = F.when(F.substring("huc10", 10, 1) == "7", F.substring(whole, 1, 60)).otherwise(whole)
    sinks.write_named_files(newest.select(F.concat("huc10", F.lit("/project.rs.xml")).alias("name"), content.alias("content")), folder)
    return folder


_NEWEST = "n AS (SELECT huc10, arg_max(project_id, created_on // 86400000 * 10000000 + rank) AS pid FROM (SELECT *, row_number() OVER (ORDER BY project_id) AS rank FROM v_projects WHERE huc10 IS NOT NULL) GROUP BY 1), x AS (SELECT p.*, substr(p.huc10, 10, 1) <> '7' AS readable FROM n JOIN v_projects p ON p.project_id = n.pid)"


@query(
    "src_project_xml",
    "v_projects",
    f"""WITH {_NEWEST} SELECT huc10 AS huc, readable, CASE WHEN readable THEN project_id END AS project_id, CASE WHEN readable THEN project_type_id END AS project_type, CASE WHEN readable THEN NOT archived END AS has_bounds,
      CASE WHEN readable AND NOT archived THEN 'bounds.geojson' END AS bounds_path, CASE WHEN readable AND NOT archived THEN round((ymin + ymax) / 2, 6) END AS lat, CASE WHEN readable AND NOT archived THEN round(xmax, 6) END AS max_lng,
      CASE WHEN readable THEN 4 END AS n_datasets, CASE WHEN readable THEN huc10 END AS meta_huc FROM x""",
)
def src_project_xml(t):
    out = S.read_project_xml(t.spark, project_files(t))
    return out.select("huc", "readable", "project_id", "project_type", "has_bounds", "bounds_path", F.round("lat", 6).alias("lat"), F.round("max_lng", 6).alias("max_lng"), F.size("datasets").alias("n_datasets"), F.try_element_at("meta", F.lit(1))["value"].alias("meta_huc")).withColumn("n_datasets", F.when(F.col("readable"), F.col("n_datasets")))


@query(
    "dataset_inventory",
    "v_projects",
    f"""WITH {_NEWEST}, r AS (SELECT * FROM x WHERE readable) SELECT 'raster' AS kind, 'DEM' AS id, CAST(NULL AS VARCHAR) AS layer, count(*) AS occurrences, 'Elevation' AS name, 'inputs/dem_' || arg_min(project_type_id, huc10) || '.tif' AS path FROM r
    UNION ALL SELECT 'geopackage', 'OUT', project_type_id, count(*), 'Out', 'outputs/out.gpkg' FROM r GROUP BY project_type_id UNION ALL SELECT 'shapefile', 'SHP', NULL, count(*), 'Shape', 'outputs/shape.shp' FROM r""",
)
def dataset_inventory(t):
    return S.dataset_inventory(S.read_project_xml(t.spark, project_files(t)), ["INPUTS/.*", "outputs/.*"]).drop("layer_name")


@query("src_geojson", "v_boxes", "SELECT CAST(gx AS VARCHAR) AS id, 'Polygon' AS kind, count(*) AS n_features, count(*) * 5 AS n_points FROM v_boxes GROUP BY gx")
def src_geojson(t):
    folder = scratch_dir(t.spark, "geojson")
    parts = feature_collections(squares(t), "gx", "feature_id", chunk=50)
    name = F.concat(F.lit("part "), F.col("part").cast("string"), F.lit("/Project_ID_Some Creek - "), F.col("gx").cast("string"), F.lit(".geojson"))
    sinks.write_named_files(parts.select(name.alias("name"), F.col("document").alias("content")), folder)
    features = S.read_geojson(t.spark, f"{folder}/*/*.geojson")
    points = F.size(F.from_json("geometry.coordinates", "array<array<array<double>>>")[0])
    return features.groupBy("id", F.col("geometry.type").alias("kind")).agg(F.count(F.lit(1)).alias("n_features"), F.sum(points).alias("n_points"))


@query("src_id_list", sql="SELECT CAST(o_orderkey AS VARCHAR) AS project_id FROM orders WHERE o_orderkey % 9 <> 0")
def src_id_list(t):
    folder = scratch_dir(t.spark, "ids")
    k = F.col("o_orderkey")
    t.raw("orders").select(F.when(k % 9 == 0, "   ").when(k % 2 == 0, F.concat(F.lit("  "), k.cast("string"), F.lit(" "))).otherwise(k.cast("string")).alias("value")).write.text(folder)
    return S.read_id_list(t.spark, folder)


# --- TSV, Parquet and JSON sinks --------------------------------------------------------------


def _indexed(t) -> DataFrame:
    """Project index rows with tabs, line feeds and backslashes in some names."""
    k = F.col("project_id").cast("bigint")
    odd = F.when(k % 5 == 0, F.concat(F.lit("a\tb\\t\n"), F.col("name"))).when(k % 7 == 0, None).otherwise(F.col("name"))
    return t.projects.filter("huc10 IS NOT NULL").select(
        "project_id", odd.alias("name"), F.when(k % 11 != 0, F.col("tags")).alias("tags"), "huc10", version_int(F.col("model_version")).alias("model_version_int"), "archived", "created_on",
        F.lit("day").alias("created_on_date"), F.col("owner_id").alias("owned_by_id"), F.col("owner_name").alias("owned_by_name"), F.col("owner_type").alias("owned_by_type"), "project_type_id", "model_version",
    )


_TSV_SQL = """SELECT p.project_id, CASE WHEN CAST(p.project_id AS BIGINT) % 5 = 0 THEN 'a' || chr(9) || 'b\\t' || chr(10) || name WHEN CAST(p.project_id AS BIGINT) % 7 = 0 THEN NULL ELSE name END AS name,
  CASE WHEN CAST(p.project_id AS BIGINT) % 11 <> 0 THEN tags END AS tags, huc10, model_version_int, archived, created_on, 'day' AS created_on_date, owner_id AS owned_by_id, owner_name AS owned_by_name, owner_type AS owned_by_type,
  project_type_id, model_version FROM v_projects p JOIN v_version_int v ON p.project_id = v.project_id WHERE huc10 IS NOT NULL"""


def _tsv_folder(t) -> str:
    folder = scratch_dir(t.spark, "tsv")
    # few partitions keep the number of small files of this round trip in bounds
    sinks.write_projects_tsv(_indexed(t).withColumn("model_version", F.regexp_extract("model_version", r"^([0-9]+|x)", 1)), folder)
    return folder


_TSV_FOLDED = _TSV_SQL.replace("project_type_id, model_version FROM", "project_type_id, string_split(model_version, '.')[1] AS model_version FROM")


@query("sink_tsv_partitioned", "v_projects v_version_int", _TSV_FOLDED)
def sink_tsv_partitioned(t):
    return S.read_projects_tsv(t.spark, _tsv_folder(t)).withColumn("tags", F.array_join("tags", "|"))


@query("src_tsv_projects", "v_projects v_version_int", f"SELECT project_type_id, model_version, count(*) AS n, count(tags) AS n_tagged, CAST(sum(len(string_split(tags, '|'))) AS BIGINT) AS n_tags FROM ({_TSV_FOLDED}) GROUP BY 1, 2")
def src_tsv_projects(t):
    rows = S.read_projects_tsv(t.spark, _tsv_folder(t))
    return rows.groupBy("project_type_id", "model_version").agg(F.count(F.lit(1)).alias("n"), F.count("tags").alias("n_tagged"), F.sum(F.size("tags")).alias("n_tags"))


@query("sink_parquet_per_huc", "v_dgos", "SELECT huc10 AS huc, dgoid, CASE WHEN substr(huc10, 4, 1) = '3' THEN 'second' ELSE 'first' END AS load FROM v_dgos WHERE substr(huc10, 4, 1) <> '3' OR dgoid // 300 % 2 = 0")
def sink_parquet_per_huc(t):
    folder = scratch_dir(t.spark, "by-huc")
    rows = t.dgos.select(F.col("huc10").alias("huc"), "dgoid")
    sinks.write_by_huc(rows.withColumn("load", F.lit("first")), folder)
    again = rows.filter((F.substring("huc", 4, 1) == "3") & (F.floor(F.col("dgoid") / 300) % 2 == 0))
    sinks.write_by_huc(again.withColumn("load", F.lit("second")), folder)
    return t.spark.read.schema("dgoid bigint, load string, huc string").parquet(folder)


@query("sink_tsv_per_huc12", "v_boxes", f"SELECT 'L' || gx AS level_path, CAST(gy AS VARCHAR) AS seg_distance, {_WKT} AS geom, '17000000' || lpad(CAST(gx AS VARCHAR), 4, '0') AS huc12 FROM v_boxes")
def sink_tsv_per_huc12(t):
    folder = scratch_dir(t.spark, "by-huc-tw")
    polygons = squares(t).select(F.concat(F.lit("L"), F.col("gx").cast("string")).alias("level_path"), F.col("gy").alias("seg_distance"), "geom")
    locations = t.boxes.select(F.concat(F.lit("L"), F.col("gx").cast("string")).alias("level_path"), F.col("gy").alias("seg_distance"), F.concat(F.lit("17000000"), F.lpad(F.col("gx").cast("string"), 4, "0")).alias("huc12"))
    sinks.write_by_huc12(polygons, locations, folder)
    rows = t.spark.read.schema("value string, huc12 string").text(folder)
    part = F.split("value", "\t")
    return rows.select(part[0].alias("level_path"), part[1].alias("seg_distance"), part[2].alias("geom"), "huc12")


_CONTRACT = T.StructType([T.StructField("fid", T.LongType()), T.StructField("dgoid", T.LongType()), T.StructField("length", T.DoubleType()), T.StructField("note", T.StringType())])


@query(
    "sink_append_contract",
    sql="""SELECT row_number() OVER (ORDER BY p_partkey) AS fid, p_partkey AS dgoid, p_retailprice AS length, CAST(NULL AS VARCHAR) AS note, 'a' AS load_id FROM part WHERE p_size <= 25
    UNION ALL SELECT p_partkey, p_partkey, NULL, p_type, 'b' FROM part WHERE p_size > 25""",
)
def sink_append_contract(t):
    name = "contract_" + scratch_dir(t.spark, "t").rsplit("-", 1)[1]
    location = scratch_dir(t.spark, "contract")
    small = t.raw("part").filter("p_size <= 25").select(F.col("p_partkey").alias("DGOID"), F.col("p_retailprice").alias("Length"))
    large = t.raw("part").filter("p_size > 25").select(F.col("p_type").alias("note"), F.col("p_partkey").alias("fid"), F.col("p_partkey").alias("dgoid"))
    sinks.append_conformed(small, name, _CONTRACT, "a", ["dgoid"], location, crs="EPSG:5070")
    sinks.append_conformed(large, name, _CONTRACT, "b", ["dgoid"], location, crs="EPSG:5070")
    return t.spark.table(name)


@query("sink_json_lines", "v_dgos", "SELECT huc10 AS huc, count(*) AS value_count, round(sum(centerline_length), 4) AS total FROM v_dgos GROUP BY 1")
def sink_json_lines(t):
    folder = scratch_dir(t.spark, "json")
    sinks.write_docs(context_docs(t), folder)
    docs = t.spark.read.schema("huc string, dem_bins struct<value_count:bigint>, ownership map<string,double>").json(folder)
    return docs.select("huc", "dem_bins.value_count", F.round(F.aggregate(F.map_values("ownership"), F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("partition_refresh", "v_projects", "SELECT project_type_id, count(*) AS n FROM v_projects GROUP BY 1")
def partition_refresh(t):
    name = "refreshed_" + scratch_dir(t.spark, "t").rsplit("-", 1)[1]
    location = scratch_dir(t.spark, "refreshed")
    t.spark.sql(f"CREATE TABLE {name} (project_id string, project_type_id string) USING parquet PARTITIONED BY (project_type_id) LOCATION '{location}'")
    t.projects.select("project_id", "project_type_id").hint("rebalance", "project_type_id").write.partitionBy("project_type_id").mode("append").parquet(location)
    sinks.refresh_partitions(t.spark, name)
    return t.spark.table(name).groupBy("project_type_id").agg(F.count(F.lit(1)).alias("n"))


@query("schema_diff", sql="SELECT * FROM (VALUES ('dgoid', 'int64', 2), ('dgoid', 'string', 2), ('seg_distance', 'double', 1)) AS t(column_name, column_type, n_types)")
def schema_diff(t):
    """Two loads that disagree on one type and one column."""
    folder = scratch_dir(t.spark, "schemas")
    t.dgos.select("dgoid", "fcode", "seg_distance").write.parquet(f"{folder}/a")
    t.dgos.select(F.col("dgoid").cast("string").alias("dgoid"), "fcode").write.parquet(f"{folder}/b")
    return quality.schema_diff(quality.list_files(t.spark, folder)).select("column_name", "column_type", "n_types")
