"""The benchmark tables seen as watershed tables, once for Spark and once as SQL views.

``CTES`` maps a view name to (views it needs, SELECT text); ``Tables`` has the Spark side under
the same name without the ``v_``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.functions.columns import meta_map, to_ms, version_int

PROJECT_TYPES = ["context", "metrics", "valley", "riparian"]
METRIC_IDS = [4, 5, 16, 19, 20, 21, 23, 35, 36, 37, 38, 39, 40, 41, 42]
WATERSHEDS = ["JohnDay", "SouthForkSalmon", "Entiat (Lower)", "YankeeFork"]
MEASUREMENTS = ["Woody Debris Jam", "Solar Exposure", "Inverterbrate Sample"]

CTES: dict[str, tuple[str, str]] = {}


def _pick(values: list[str], index: str) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


CTES["v_projects"] = ("", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS project_id,
       'Project, ' || o_orderkey || ' ' || o_orderpriority AS name,
       {_pick(PROJECT_TYPES, 'o_orderkey % 4')} AS project_type_id,
       CASE WHEN o_orderkey % 17 <> 0 THEN CAST(1700000000 + (o_custkey % 300) * 1000003 AS VARCHAR) END AS huc10,
       CASE WHEN o_orderkey % 31 = 0 THEN 'x'
            WHEN o_orderkey % 7 = 0 THEN (o_orderkey % 4) || '.0' || (o_orderkey % 11) || '.' || (o_orderkey % 29)
            WHEN o_orderkey % 37 = 0 THEN (o_orderkey % 4) || '.' || (o_orderkey % 11) || '.' || (o_orderkey % 29) || '-rc1'
            ELSE (o_orderkey % 4) || '.' || (o_orderkey % 11) || '.' || (o_orderkey % 29) END AS model_version,
       epoch_ms(o_orderdate) AS created_on,
       CASE WHEN o_orderkey % 3 <> 0 THEN epoch_ms(o_orderdate) + (o_orderkey % 10) * 86400000 END AS updated_on,
       CAST(o_custkey % 20 AS VARCHAR) AS owner_id,
       'Owner, ' || (o_custkey % 20) AS owner_name,
       CASE WHEN o_custkey % 3 = 0 THEN 'USER' ELSE 'ORGANIZATION' END AS owner_type,
       {_pick(['PUBLIC', 'PRIVATE', 'SECRET'], 'o_orderkey % 5 % 3')} AS visibility,
       o_orderstatus = 'O' AS archived,
       CAST(floor(o_totalprice * 1000) AS BIGINT) AS total_size,
       CASE WHEN o_orderstatus = 'P' THEN '2024CONUS' ELSE '2025CONUS' END || '|' || o_orderpriority AS tags,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 13 = 1 THEN ' ' ELSE 'b' || (o_custkey % 500) END AS bounds_id,
       -125 + (o_custkey % 600) * 0.1e0 AS xmin, 25 + (o_custkey % 240) * 0.1e0 AS ymin,
       -125 + (o_custkey % 600) * 0.1e0 + 0.25e0 AS xmax, 25 + (o_custkey % 240) * 0.1e0 + 0.25e0 AS ymax,
       CASE WHEN o_orderkey % 6 = 0 THEN 'c' || (o_custkey % 10) END AS collection_id,
       'org' || (o_custkey % 7) AS attributed_org_id
FROM orders""")

CTES["v_meta"] = ("v_projects", f"""
SELECT project_id, pos, key, value FROM (
  SELECT project_id, 1 AS pos, {_pick(['HUC10', 'huc10', 'HUC', 'Hydrologic Unit Code'], 'CAST(project_id AS BIGINT) % 4')} AS key, huc10 AS value FROM v_projects
  UNION ALL SELECT project_id, 2, {_pick(['modelVersion', 'model_version', 'Model Version'], 'CAST(project_id AS BIGINT) % 3')},
         CASE WHEN CAST(project_id AS BIGINT) % 19 <> 0 THEN model_version END FROM v_projects
  UNION ALL SELECT project_id, 3, 'ProcTimeS', CASE WHEN CAST(project_id AS BIGINT) % 50 = 0 THEN 'n/a' ELSE CAST(CAST(project_id AS BIGINT) % 977 AS VARCHAR) END FROM v_projects
  UNION ALL SELECT project_id, 4, 'HUC', CASE WHEN CAST(project_id AS BIGINT) % 23 = 0 THEN '1600-0000 01' END FROM v_projects
  UNION ALL SELECT project_id, 5, 'HUV', CASE WHEN CAST(project_id AS BIGINT) % 29 = 0 THEN '12345678' END FROM v_projects
  UNION ALL SELECT project_id, 6, 'Watershed', {_pick(WATERSHEDS, "CAST(owner_id AS BIGINT) % 5")} FROM v_projects
  UNION ALL SELECT project_id, 7, CASE WHEN CAST(project_id AS BIGINT) % 2 = 0 THEN 'Site' ELSE 'SiteName' END,
         CASE WHEN CAST(project_id AS BIGINT) % 12 <> 0 THEN 'Site ' || (CAST(project_id AS BIGINT) % 50) END FROM v_projects
  UNION ALL SELECT project_id, 8, CASE WHEN CAST(project_id AS BIGINT) % 3 = 0 THEN 'Year' ELSE 'FieldSeason' END,
         CASE WHEN CAST(project_id AS BIGINT) % 14 <> 0 THEN CAST(year(epoch_ms(created_on)) AS VARCHAR) END FROM v_projects
  UNION ALL SELECT project_id, 9, {_pick(['Visit', 'VisitNumber', 'VisitID'], 'CAST(project_id AS BIGINT) % 3')},
         CASE WHEN CAST(project_id AS BIGINT) % 15 <> 0 THEN CAST(CAST(project_id AS BIGINT) % 20000 AS VARCHAR) END FROM v_projects
) WHERE value IS NOT NULL""")

CTES["v_tags"] = ("v_projects", "SELECT project_id, unnest(string_split(tags, '|')) AS tag FROM v_projects")

# projects of the newer campaign, to be matched with older ones by watershed
CTES["v_newer"] = ("v_projects", "SELECT * FROM v_projects WHERE tags LIKE '2025CONUS%'")
CTES["v_older"] = ("v_projects", "SELECT * FROM v_projects WHERE tags LIKE '2024CONUS%'")

CTES["v_loaded"] = ("", """
SELECT CAST(1700000000 + (c_custkey % 300) * 1000003 AS VARCHAR) AS huc,
       800000000000 + (c_custkey * 7919 % 200000) * 1000000 AS loaded_ts,
       CAST(c_custkey * 4 AS VARCHAR) AS project_id
FROM customer WHERE c_custkey % 3 <> 0""")

CTES["v_hucs"] = ("", """
SELECT DISTINCT CAST(1700000000 + (c_custkey % 300) * 1000003 AS VARCHAR) AS huc10, 'Basin ' || (c_custkey % 300) AS huc_name,
       'S' || (c_custkey % 300 % 7) AS states FROM customer""")

CTES["v_dgos"] = ("", """
SELECT p_partkey AS dgoid, p_brand AS level_path, CAST(p_size AS DOUBLE) AS seg_distance, p_type AS fcode,
       p_retailprice AS centerline_length, p_retailprice * p_size AS segment_area,
       CAST(1700000000 + (p_partkey % 300) * 1000003 AS VARCHAR) AS huc10 FROM part""")

_METRIC_LIST = "[" + ",".join(map(str, METRIC_IDS)) + "]"
CTES["v_values"] = ("", f"""
SELECT l_partkey AS dgo_id, {_METRIC_LIST}[CAST((l_linenumber * 7 + l_suppkey) % 15 AS INTEGER) + 1] AS metric_id,
       CASE WHEN max(l_discount) < 0.03e0 THEN 0 WHEN min(l_tax) >= 0.06e0 THEN NULL ELSE sum(l_quantity) END AS metric_value
FROM lineitem GROUP BY 1, 2
UNION ALL SELECT p_partkey, 1, CAST(p_partkey % 5 + 1 AS DOUBLE) FROM part
UNION ALL SELECT p_partkey, 2, CAST(p_partkey % 7 + 1 AS DOUBLE) FROM part
UNION ALL SELECT p_partkey, 2, CAST((p_partkey + 3) % 7 + 1 AS DOUBLE) FROM part WHERE p_partkey % 9 = 0""")

LOOKUPS = {
    "states": [("Idaho", 1, "1,2"), ("Oregon", 2, "3,4"), ("Utah", 3, "5,6,7"), ("Border", 4, "2,3")],
    "flows": [("Perennial", 1, "SMALL,MEDIUM"), ("Intermittent", 2, "MEDIUM,LARGE"), ("Ephemeral", 3, "PROMO"), ("Canal", 4, "ECONOMY,STANDARD")],
    "owners": [("Federal", 1, "1,2"), ("State", 2, "3"), ("Private", 3, "4,5")],
}
for _name, _rows in LOOKUPS.items():
    CTES[f"v_{_name}"] = ("", f"SELECT * FROM (VALUES {', '.join(map(str, _rows))}) AS t(name, id, where_clause)")
    CTES[f"v_{_name}_codes"] = (f"v_{_name}", f"SELECT id, unnest(string_split(where_clause, ',')) AS code FROM v_{_name}")

CTES["v_cells"] = ("", """
SELECT l_suppkey % 8 AS raster_id, l_orderkey % 512 AS r, l_partkey % 512 AS c,
       max(CASE WHEN l_discount = 0 THEN -9999 ELSE l_extendedprice END) AS value
FROM lineitem GROUP BY 1, 2, 3""")
CTES["v_headers"] = ("", """
SELECT DISTINCT s_suppkey % 8 AS raster_id, 0e0 AS left_x, 51200e0 AS top_y, 100e0 AS cell_width, -100e0 AS cell_height,
       512 AS n_rows, 512 AS n_cols, -9999.5e0 AS nodata FROM supplier""")
CTES["v_valid"] = ("v_cells", "SELECT * FROM v_cells WHERE value <> -9999")

CTES["v_boxes"] = ("", """
SELECT c_custkey AS feature_id, c_custkey % 40 // 8 AS dissolve_key, c_custkey % 40 AS gx, c_custkey // 40 AS gy,
       (c_custkey % 40) * 100e0 AS xmin, (c_custkey // 40) * 100e0 AS ymin,
       (c_custkey % 40) * 100e0 + 100e0 AS xmax, (c_custkey // 40) * 100e0 + 100e0 AS ymax
FROM customer""")
# the squares with gaps, for outlines with holes and several parts
CTES["v_tiles"] = ("v_boxes", "SELECT * FROM v_boxes WHERE feature_id % 11 <> 5")

_FILES = "(SELECT 'outputs/metrics.gpkg' AS f, 0 AS k UNION ALL SELECT 'Project.rs.xml', 1 UNION ALL SELECT NULL, 2)"
CTES["v_manifest_new"] = ("", f"""
SELECT CAST(page_id % 40 AS VARCHAR) AS huc, CASE WHEN f IS NOT NULL THEN page_id || '/' || f END AS local_path,
       CASE WHEN page_id % 7 = 1 THEN md5(html || 'v2') ELSE md5(html) END AS etag, length(html) + k AS size
FROM pages CROSS JOIN {_FILES} AS kinds""")
CTES["v_manifest_old"] = ("", f"""
SELECT CAST(page_id % 40 AS VARCHAR) AS huc, CASE WHEN f IS NOT NULL THEN (CASE WHEN page_id % 23 = 2 THEN 'gone/' ELSE '' END) || page_id || '/' || f END AS local_path,
       md5(html) AS etag, length(html) + k AS size
FROM pages CROSS JOIN {_FILES} AS kinds WHERE page_id % 10 <> 0""")

CTES["v_epoch"] = ("", """
SELECT l_partkey AS fid,
       sum(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS active_5yr_1989_1993_68pc_area,
       sum(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS active_5yr_1989_1993_68pc_width,
       sum(CASE WHEN l_linenumber = 3 THEN l_quantity END) AS wet_30yr_1989_2018_95pc_area,
       sum(CASE WHEN l_linenumber = 4 THEN l_quantity END) AS wet_30yr_1989_2018_95pc_areapc,
       count(*) AS other_count
FROM lineitem GROUP BY l_partkey""")

CTES["v_visits"] = ("", """
SELECT o_orderkey AS visit_id, o_custkey AS site_id, year(o_orderdate) AS visit_year, o_orderkey % 2 AS program_id,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS aux_uploaded FROM orders""")
CTES["v_sites"] = ("", "SELECT c_custkey AS site_id, c_name AS site_name, c_nationkey AS watershed_id FROM customer")
CTES["v_watersheds"] = ("", "SELECT n_nationkey AS watershed_id, n_name AS watershed_name FROM nation")
CTES["v_visit_projects"] = ("", """
SELECT o_orderkey AS visit_id, o_orderkey % 3 AS project_type, CASE WHEN o_orderkey % 5 <> 0 THEN 'g' || o_orderkey END AS guid FROM orders""")

CTES["v_jobs"] = ("", "SELECT o_orderkey AS jid, 'job ' || o_orderkey AS job_name, CASE WHEN o_orderkey % 4 = 2 THEN 'valley' ELSE 'other' END AS script_id, o_orderpriority AS task_def_id FROM orders")
CTES["v_tasks"] = ("", """
SELECT l_orderkey AS jid, l_linenumber AS task_no, l_partkey AS task_ref, CAST(l_quantity * 64 AS BIGINT) AS cpu, l_partkey % 30 * 512 AS memory,
       epoch_ms(l_shipdate) AS started_on, epoch_ms(l_shipdate) + CAST(l_quantity * 60250 AS BIGINT) AS ended_on FROM lineitem""")

CTES["v_feed"] = ("", """
SELECT event_id AS project_id, ts, epoch_us(ts) // 1000 AS created_on, user_id AS owner_id, event_type AS project_type_id, props FROM events""")

_SIDES = {
    "desc": "count(*) AS n_obs, min(l_shipdate) AS first_obs",
    "geomorph": "sum(l_quantity) AS width_sum",
    "veg": "max(l_extendedprice) AS veg_max",
    "hydro": "min(l_extendedprice) AS flow_min",
    "impacts": "max(l_discount) AS impact_max",
    "beaver": "min(l_tax) AS dam_min",
}
SIDES = list(_SIDES)
for _name, _agg in _SIDES.items():
    CTES[f"v_dgo_{_name}"] = ("", f"SELECT l_partkey AS dgoid, {_agg} FROM lineitem GROUP BY l_partkey")
CTES["v_igos"] = ("v_dgos", """
SELECT min(dgoid) AS igoid, huc10, level_path, seg_distance, min(dgoid) * 0.01e0 AS lon, max(dgoid) * 0.02e0 AS lat
FROM v_dgos GROUP BY huc10, level_path, seg_distance""")


def one_of(values: list[str], index: Column) -> Column:
    """Constant picked by an integer column, NULL beyond the list."""
    expr = F.lit(None).cast("string")
    for i, value in enumerate(values):
        expr = F.when(index == i, F.lit(value)).otherwise(expr)
    return expr


def _text(col: Column) -> Column:
    return col.cast("string")


def huc_from(key: Column) -> Column:
    return _text(F.lit(1700000000).cast("bigint") + (key % 300) * 1000003)


class Tables:
    """Spark side of the views, built lazily from one folder of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def projects(self) -> DataFrame:
        k, cust = F.col("o_orderkey"), F.col("o_custkey")
        plain = F.concat(_text(k % 4), F.lit("."), _text(k % 11), F.lit("."), _text(k % 29))
        padded = F.concat(_text(k % 4), F.lit(".0"), _text(k % 11), F.lit("."), _text(k % 29))
        created = to_ms(F.col("o_orderdate"))
        xmin, ymin = -125 + (cust % 600) * 0.1, 25 + (cust % 240) * 0.1
        return self.raw("orders").select(
            _text(k).alias("project_id"),
            F.concat(F.lit("Project, "), _text(k), F.lit(" "), F.col("o_orderpriority")).alias("name"),
            one_of(PROJECT_TYPES, k % 4).alias("project_type_id"),
            F.when(k % 17 != 0, huc_from(cust)).alias("huc10"),
            F.when(k % 31 == 0, "x").when(k % 7 == 0, padded).when(k % 37 == 0, F.concat(plain, F.lit("-rc1"))).otherwise(plain).alias("model_version"),
            created.alias("created_on"),
            F.when(k % 3 != 0, created + (k % 10) * 86400000).alias("updated_on"),
            _text(cust % 20).alias("owner_id"),
            F.concat(F.lit("Owner, "), _text(cust % 20)).alias("owner_name"),
            F.when(cust % 3 == 0, "USER").otherwise("ORGANIZATION").alias("owner_type"),
            one_of(["PUBLIC", "PRIVATE", "SECRET"], k % 5 % 3).alias("visibility"),
            (F.col("o_orderstatus") == "O").alias("archived"),
            F.floor(F.col("o_totalprice") * 1000).cast("bigint").alias("total_size"),
            F.concat(F.when(F.col("o_orderstatus") == "P", "2024CONUS").otherwise("2025CONUS"), F.lit("|"), F.col("o_orderpriority")).alias("tags"),
            F.when(k % 13 == 0, None).when(k % 13 == 1, " ").otherwise(F.concat(F.lit("b"), _text(cust % 500))).alias("bounds_id"),
            xmin.alias("xmin"), ymin.alias("ymin"), (xmin + 0.25).alias("xmax"), (ymin + 0.25).alias("ymax"),
            F.when(k % 6 == 0, F.concat(F.lit("c"), _text(cust % 10))).alias("collection_id"),
            F.concat(F.lit("org"), _text(cust % 7)).alias("attributed_org_id"),
        )

    @cached_property
    def meta_array(self) -> DataFrame:
        """Projects with their metadata list, in list order and with repeated keys."""
        p = self.projects
        k, owner = F.col("project_id").cast("bigint"), F.col("owner_id").cast("bigint")
        entries = [
            (one_of(["HUC10", "huc10", "HUC", "Hydrologic Unit Code"], k % 4), F.col("huc10")),
            (one_of(["modelVersion", "model_version", "Model Version"], k % 3), F.when(k % 19 != 0, F.col("model_version"))),
            (F.lit("ProcTimeS"), F.when(k % 50 == 0, "n/a").otherwise(_text(k % 977))),
            (F.lit("HUC"), F.when(k % 23 == 0, "1600-0000 01")),
            (F.lit("HUV"), F.when(k % 29 == 0, "12345678")),
            (F.lit("Watershed"), one_of(WATERSHEDS, owner % 5)),
            (F.when(k % 2 == 0, "Site").otherwise("SiteName"), F.when(k % 12 != 0, F.concat(F.lit("Site "), _text(k % 50)))),
            (F.when(k % 3 == 0, "Year").otherwise("FieldSeason"), F.when(k % 14 != 0, _text(F.year(F.timestamp_millis("created_on"))))),
            (one_of(["Visit", "VisitNumber", "VisitID"], k % 3), F.when(k % 15 != 0, _text(k % 20000))),
        ]
        listed = F.array(*[F.struct(key.alias("key"), value.alias("value")) for key, value in entries])
        return p.withColumn("meta", F.filter(listed, lambda x: x["value"].isNotNull()))

    @cached_property
    def docs(self) -> DataFrame:
        """Project documents as a catalogue service returns them."""
        iso = lambda c: F.date_format(F.timestamp_millis(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        return self.meta_array.select(
            F.col("project_id").alias("id"),
            "name",
            iso("created_on").alias("createdOn"),
            iso("updated_on").alias("updatedOn"),
            "visibility",
            "archived",
            F.struct(F.col("owner_id").alias("id"), F.col("owner_name").alias("name"), F.col("owner_type").alias("__typename")).alias("ownedBy"),
            "meta",
            F.split("tags", r"\|").alias("tags"),
            F.struct(F.col("project_type_id").alias("id")).alias("projectType"),
            F.col("total_size").alias("totalSize"),
            F.struct(F.col("bounds_id").alias("id")).alias("bounds"),
        )

    @cached_property
    def newer(self) -> DataFrame:
        return self.projects.filter(F.col("tags").startswith("2025CONUS"))

    @cached_property
    def older(self) -> DataFrame:
        return self.projects.filter(F.col("tags").startswith("2024CONUS"))

    @cached_property
    def loaded(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.raw("customer").filter(c % 3 != 0).select(
            huc_from(c).alias("huc"),
            (F.lit(800000000000) + (c * 7919 % 200000) * 1000000).alias("loaded_ts"),
            _text(c * 4).alias("project_id"),
        )

    @cached_property
    def hucs(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.raw("customer").select(
            huc_from(c).alias("huc10"),
            F.concat(F.lit("Basin "), _text(c % 300)).alias("huc_name"),
            F.concat(F.lit("S"), _text(c % 300 % 7)).alias("states"),
        ).distinct()

    @cached_property
    def dgos(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("dgoid"),
            F.col("p_brand").alias("level_path"),
            F.col("p_size").cast("double").alias("seg_distance"),
            F.col("p_type").alias("fcode"),
            F.col("p_retailprice").alias("centerline_length"),
            (F.col("p_retailprice") * F.col("p_size")).alias("segment_area"),
            huc_from(F.col("p_partkey")).alias("huc10"),
        )

    @cached_property
    def values(self) -> DataFrame:
        ids = F.array(*[F.lit(i) for i in METRIC_IDS])
        slot = ((F.col("l_linenumber") * 7 + F.col("l_suppkey")) % 15).cast("int")
        metrics = (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("dgo_id"), F.element_at(ids, slot + 1).alias("metric_id"))
            .agg(
                F.when(F.max("l_discount") < 0.03, F.lit(0.0)).when(F.min("l_tax") >= 0.06, F.lit(None)).otherwise(F.sum("l_quantity")).alias("metric_value")
            )
        )
        p = F.col("p_partkey")
        part = self.raw("part")
        code = lambda df, metric, value: df.select(p.alias("dgo_id"), F.lit(metric).alias("metric_id"), value.cast("double").alias("metric_value"))
        return (
            metrics.unionByName(code(part, 1, p % 5 + 1))
            .unionByName(code(part, 2, p % 7 + 1))
            .unionByName(code(part.filter(p % 9 == 0), 2, (p + 3) % 7 + 1))
        )

    def lookup(self, name: str) -> DataFrame:
        rows = ", ".join(map(str, LOOKUPS[name]))
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, id, where_clause)")

    @cached_property
    def cells(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy((F.col("l_suppkey") % 8).alias("raster_id"), (F.col("l_orderkey") % 512).alias("r"), (F.col("l_partkey") % 512).alias("c"))
            .agg(F.max(F.when(F.col("l_discount") == 0, F.lit(-9999.0)).otherwise(F.col("l_extendedprice"))).alias("value"))
        )

    @cached_property
    def headers(self) -> DataFrame:
        return self.raw("supplier").select((F.col("s_suppkey") % 8).alias("raster_id")).distinct().select(
            "raster_id",
            F.lit(0.0).alias("left_x"), F.lit(51200.0).alias("top_y"),
            F.lit(100.0).alias("cell_width"), F.lit(-100.0).alias("cell_height"),
            F.lit(512).alias("n_rows"), F.lit(512).alias("n_cols"),
            F.lit(-9999.5).alias("nodata"),
        )

    @cached_property
    def boxes(self) -> DataFrame:
        c = F.col("c_custkey")
        gx, gy = c % 40, F.floor(c / 40).cast("bigint")
        return self.raw("customer").select(
            c.alias("feature_id"), F.floor(gx / 8).cast("bigint").alias("dissolve_key"), gx.alias("gx"), gy.alias("gy"),
            (gx * 100.0).alias("xmin"), (gy * 100.0).alias("ymin"),
            (gx * 100.0 + 100.0).alias("xmax"), (gy * 100.0 + 100.0).alias("ymax"),
        )

    @cached_property
    def tiles(self) -> DataFrame:
        return self.boxes.filter("feature_id % 11 <> 5")

    def _manifest(self, moved: bool, changed: bool) -> DataFrame:
        page = F.col("page_id")
        prefix = F.when(page % 23 == 2, "gone/").otherwise("") if moved else F.lit("")
        kinds = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(k).alias("k")) for f, k in [("outputs/metrics.gpkg", 0), ("Project.rs.xml", 1), (None, 2)]])
        body = F.when(page % 7 == 1, F.concat(F.col("html"), F.lit("v2"))).otherwise(F.col("html")) if changed else F.col("html")
        return (
            self.raw("pages")
            .select("page_id", F.md5(body).alias("etag"), F.length("html").alias("n"), prefix.alias("prefix"), F.explode(kinds).alias("kind"))
            .select(
                "page_id",
                _text(page % 40).alias("huc"),
                F.when(F.col("kind.f").isNotNull(), F.concat(F.col("prefix"), _text(page), F.lit("/"), F.col("kind.f"))).alias("local_path"),
                "etag",
                (F.col("n") + F.col("kind.k")).alias("size"),
            )
        )

    @cached_property
    def manifest_new(self) -> DataFrame:
        return self._manifest(False, True).drop("page_id")

    @cached_property
    def manifest_old(self) -> DataFrame:
        return self._manifest(True, False).filter(F.col("page_id") % 10 != 0).drop("page_id")

    @cached_property
    def epoch(self) -> DataFrame:
        def part(line: int, name: str) -> Column:
            return F.sum(F.when(F.col("l_linenumber") == line, F.col("l_quantity"))).alias(name)

        return self.raw("lineitem").groupBy(F.col("l_partkey").alias("fid")).agg(
            part(1, "active_5yr_1989_1993_68pc_area"),
            part(2, "active_5yr_1989_1993_68pc_width"),
            part(3, "wet_30yr_1989_2018_95pc_area"),
            part(4, "wet_30yr_1989_2018_95pc_areapc"),
            F.count(F.lit(1)).alias("other_count"),
        )

    @cached_property
    def visits(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").select(
            k.alias("visit_id"), F.col("o_custkey").alias("site_id"), F.year("o_orderdate").alias("visit_year"),
            (k % 2).alias("program_id"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("aux_uploaded"),
        )

    @cached_property
    def sites(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("site_id"), F.col("c_name").alias("site_name"), F.col("c_nationkey").alias("watershed_id"))

    @cached_property
    def watersheds(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").alias("watershed_id"), F.col("n_name").alias("watershed_name"))

    @cached_property
    def visit_projects(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").select(
            k.alias("visit_id"), (k % 3).alias("project_type"), F.when(k % 5 != 0, F.concat(F.lit("g"), _text(k))).alias("guid")
        )

    @cached_property
    def jobs(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").select(
            k.alias("jid"), F.concat(F.lit("job "), _text(k)).alias("job_name"), F.when(k % 4 == 2, "valley").otherwise("other").alias("script_id"),
            F.col("o_orderpriority").alias("task_def_id"),
        )

    @cached_property
    def tasks(self) -> DataFrame:
        start = to_ms(F.col("l_shipdate"))
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("jid"), F.col("l_linenumber").alias("task_no"), F.col("l_partkey").alias("task_ref"),
            (F.col("l_quantity") * 64).cast("bigint").alias("cpu"), (F.col("l_partkey") % 30 * 512).alias("memory"),
            start.alias("started_on"), (start + (F.col("l_quantity") * 60250).cast("bigint")).alias("ended_on"),
        )

    @cached_property
    def feed(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("project_id"), F.col("ts").cast("timestamp").alias("ts"), to_ms(F.col("ts")).alias("created_on"),
            F.col("user_id").alias("owner_id"), F.col("event_type").alias("project_type_id"), "props",
        )

    def side(self, name: str) -> DataFrame:
        aggs = {
            "desc": [F.count(F.lit(1)).alias("n_obs"), F.min("l_shipdate").alias("first_obs")],
            "geomorph": [F.sum("l_quantity").alias("width_sum")],
            "veg": [F.max("l_extendedprice").alias("veg_max")],
            "hydro": [F.min("l_extendedprice").alias("flow_min")],
            "impacts": [F.max("l_discount").alias("impact_max")],
            "beaver": [F.min("l_tax").alias("dam_min")],
        }
        return self.raw("lineitem").groupBy(F.col("l_partkey").alias("dgoid")).agg(*aggs[name])

    @cached_property
    def igos(self) -> DataFrame:
        return self.dgos.groupBy("huc10", "level_path", "seg_distance").agg(
            F.min("dgoid").alias("igoid"), (F.min("dgoid") * 0.01).alias("lon"), (F.max("dgoid") * 0.02).alias("lat")
        )

    @cached_property
    def meta_long(self) -> DataFrame:
        """Every metadata entry, repeated keys included."""
        return self.meta_array.select("project_id", F.posexplode("meta").alias("pos", "e")).select("project_id", "pos", "e.key", "e.value")

    @cached_property
    def search_index(self) -> DataFrame:
        """Projects as a search index holds them: tag list, metadata map, GUID owner and collection ids."""
        p = self.meta_array
        zeros = "00000000-0000-0000-0000-"
        return p.select(
            "project_id", "name", "project_type_id", "created_on", "updated_on", "owner_type", "visibility", "archived",
            "bounds_id", "xmin", "ymin", "xmax", "ymax", "attributed_org_id",
            F.concat(F.lit(zeros), F.lpad("owner_id", 12, "0")).alias("owner_id"),
            F.when(F.col("collection_id").isNotNull(), F.concat(F.lit(zeros + "00000000000"), F.substring("collection_id", 2, 1))).alias("collection_id"),
            F.split("tags", r"\|").alias("tags"),
            meta_map(F.col("meta")).alias("meta_map"),
            version_int(F.col("model_version")).alias("model_version_int"),
        )


CTES["v_meta_last"] = ("v_meta", "SELECT project_id, key, arg_max(value, pos) AS value FROM v_meta GROUP BY project_id, key")
CTES["v_version_int"] = ("v_projects", """
SELECT project_id, CASE WHEN regexp_matches(model_version, '^[0-9]+[.][0-9]+[.][0-9]+(-.*)?$') THEN
  CAST(regexp_extract(model_version, '^([0-9]+)[.]([0-9]+)[.]([0-9]+)', 1) AS BIGINT) * 1000000
  + CAST(regexp_extract(model_version, '^([0-9]+)[.]([0-9]+)[.]([0-9]+)', 2) AS BIGINT) * 1000
  + CAST(regexp_extract(model_version, '^([0-9]+)[.]([0-9]+)[.]([0-9]+)', 3) AS BIGINT) END AS model_version_int FROM v_projects""")
CTES["v_search"] = ("v_projects v_version_int", """
SELECT p.* EXCLUDE (owner_id, collection_id), '00000000-0000-0000-0000-' || lpad(owner_id, 12, '0') AS owner_id,
  '00000000-0000-0000-0000-00000000000' || substr(collection_id, 2, 1) AS collection_id, v.model_version_int
FROM v_projects p JOIN v_version_int v ON p.project_id = v.project_id""")
