"""Join queries: wide tables, missing loads, matching, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.operators import joins as J
from headwater.plans.bindings import SIDES, huc_from
from headwater.plans.registry import query

_SIDE_COLS = ["n_obs", "first_obs", "width_sum", "veg_max", "flow_min", "impact_max", "dam_min"]
_SIDE_VIEWS = " ".join(f"v_dgo_{s}" for s in SIDES)
_SIDE_JOINS = " ".join(f"JOIN v_dgo_{s} USING (dgoid)" for s in SIDES)


def _catalogue(t):
    """Current projects of one type with their watershed, as a loader sees them."""
    p = t.projects.filter((F.col("project_type_id") == "metrics") & F.col("huc10").isNotNull())
    return p.select("project_id", F.col("huc10").alias("huc"), (F.col("created_on") + F.col("project_id").cast("bigint") % 1000).alias("created_on"))


_CATALOGUE = """cat AS (SELECT project_id, huc10 AS huc, created_on + CAST(project_id AS BIGINT) % 1000 AS created_on
  FROM v_projects WHERE project_type_id = 'metrics' AND huc10 IS NOT NULL)"""


@query(
    "rme_wide",
    f"v_dgos {_SIDE_VIEWS}",
    f"""SELECT dgoid, level_path, seg_distance, fcode, centerline_length, segment_area, huc10, {', '.join(_SIDE_COLS[2:])}, n_obs,
      strftime(first_obs, '%Y-%m-%d') AS first_obs, 'p' || huc10 AS project_id FROM v_dgos {_SIDE_JOINS}""",
)
def rme_wide(t):
    sides = [t.side(s) for s in SIDES]
    sides[1] = sides[1].withColumnRenamed("dgoid", "DGOID")
    wide = J.rme_wide(t.dgos, sides, constants={"project_id": F.concat(F.lit("p"), "huc10")})
    return wide.withColumn("first_obs", F.date_format("first_obs", "yyyy-MM-dd"))


@query(
    "dgo_igo_view",
    "v_dgos v_igos v_dgo_veg",
    """SELECT veg_max, huc10, level_path, seg_distance, fcode, centerline_length, segment_area, igoid, round(lon, 6) AS lon, round(lat, 6) AS lat
    FROM v_dgo_veg JOIN v_dgos USING (dgoid) JOIN v_igos USING (huc10, level_path, seg_distance)""",
)
def dgo_igo_view(t):
    return J.dgo_igo_view(t.dgos, t.igos, t.side("veg")).withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


@query(
    "projects_with_huc",
    "v_projects v_hucs",
    "SELECT project_id, project_type_id, huc10, huc_name, states, model_version, created_on, tags, strftime(epoch_ms(created_on), '%Y-%m-%d %H:%M:%S') AS created_on_dt, owner_id FROM v_projects JOIN v_hucs USING (huc10)",
)
def projects_with_huc(t):
    return J.projects_with_huc(t.projects, t.hucs).select("project_id", "project_type_id", "huc10", "huc_name", "states", "model_version", "created_on", "tags", "created_on_dt", "owner_id")


_STALE = """SELECT DISTINCT cat.project_id, cat.huc, cat.created_on, l.loaded_ts FROM cat LEFT JOIN old l ON cat.huc = l.huc
  WHERE l.huc IS NULL OR l.loaded_ts < cat.created_on // 1000 * 1000"""


@query("missing_or_stale", "v_projects v_loaded", f"WITH {_CATALOGUE}, old AS (SELECT huc, min(loaded_ts) AS loaded_ts FROM v_loaded GROUP BY huc) {_STALE}")
def missing_or_stale(t):
    return J.missing_or_stale(_catalogue(t), t.loaded)


@query(
    "missing_or_stale_semi",
    "v_projects v_loaded",
    f"""WITH {_CATALOGUE}, old AS (SELECT huc, min(loaded_ts) AS loaded_ts FROM v_loaded l WHERE EXISTS (SELECT 1 FROM lineitem i WHERE CAST(i.l_orderkey AS VARCHAR) = l.project_id AND i.l_quantity > 45) GROUP BY huc) {_STALE}""",
)
def missing_or_stale_semi(t):
    metrics = t.raw("lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").cast("string").alias("project_id"))
    return J.missing_or_stale_semi(_catalogue(t), t.loaded, metrics)


@query(
    "missing_or_newer_self",
    "v_projects v_loaded",
    """WITH one AS (SELECT huc, min(project_id) AS project_id FROM v_loaded GROUP BY huc), p AS (SELECT project_id, huc10 AS huc, created_on, project_type_id FROM v_projects WHERE huc10 IS NOT NULL)
    SELECT p.project_id, p.huc, p.created_on, s.huc AS loaded_huc, s.project_id AS loaded_project_id, sp.created_on AS loaded_created_on
    FROM p LEFT JOIN one s ON p.huc = s.huc LEFT JOIN v_projects sp ON s.project_id = sp.project_id
    WHERE p.project_type_id = 'context' AND (s.huc IS NULL OR sp.created_on < p.created_on)""",
)
def missing_or_newer_self(t):
    projects = t.projects.select("project_id", F.col("huc10").alias("huc"), "created_on", "project_type_id")
    one = t.loaded.groupBy("huc").agg(F.min("project_id").alias("project_id"))
    return J.missing_or_newer(projects, one, "context")


@query(
    "skip_loaded_hucs",
    "v_projects v_loaded",
    """SELECT project_id, huc10 FROM v_projects WHERE huc10 IS NOT NULL AND huc10 NOT IN (SELECT huc FROM v_loaded)
    UNION ALL SELECT DISTINCT 'ledger', huc10 FROM v_projects WHERE huc10 IS NOT NULL AND huc10 NOT IN (SELECT huc FROM v_loaded)""",
)
def skip_loaded_hucs(t):
    fresh, entries = J.skip_loaded(t.projects.select("project_id", "huc10"), t.loaded.select(F.col("huc").alias("huc10")))
    return fresh.select("project_id", "huc10").union(entries.select(F.lit("ledger"), "huc10"))


@query(
    "skip_existing_outputs",
    "v_manifest_old",
    "SELECT page_id FROM pages WHERE page_id || '/outputs/metrics.gpkg' NOT IN (SELECT local_path FROM v_manifest_old WHERE local_path IS NOT NULL)",
)
def skip_existing_outputs(t):
    return J.skip_existing(t.raw("pages").select("page_id"), t.manifest_old, F.concat(F.col("page_id").cast("string"), F.lit("/outputs/metrics.gpkg")))


_MATCH = """m AS (SELECT s.project_id, s.huc10, s.bounds_id, s.project_type_id, s.owner_name, count(t.project_id) AS match_count, min(t.project_id) AS first_match_id,
    arg_min(coalesce(t.bounds_id, '~null~'), t.project_id) AS fb
  FROM v_newer s LEFT JOIN v_older t ON s.huc10 = t.huc10 GROUP BY ALL)"""


def _matches(t):
    return J.match_by_huc(t.newer, t.older)


@query(
    "match_collect",
    "v_newer v_older",
    f"WITH {_MATCH} SELECT project_id, huc10, bounds_id, project_type_id, owner_name, match_count, first_match_id, nullif(fb, '~null~') AS first_match_bounds FROM m",
)
def match_collect(t):
    return _matches(t)


@query(
    "match_lists",
    "v_older",
    """SELECT huc10, project_id, name, bounds_id, created_on, updated_on, count(*) OVER (PARTITION BY huc10) AS in_huc FROM v_older WHERE huc10 IS NOT NULL""",
)
def match_lists(t):
    lists = J.match_lists(t.older, chunk=5)
    sizes = lists.groupBy("huc10").agg(F.sum(F.size("matches")).alias("in_huc"))
    return lists.select("huc10", F.inline("matches")).join(sizes, "huc10")


@query(
    "match_summary",
    "v_newer v_older",
    f"""WITH {_MATCH} SELECT count(*) AS sources, count(*) FILTER (huc10 IS NULL) AS without_huc, count(*) FILTER (match_count > 0) AS matched, count(*) FILTER (match_count = 0) AS unmatched,
      count(*) FILTER (match_count > 1) AS multiple, CAST(sum(match_count) AS BIGINT) AS pairs, max(match_count) AS max_matches, count(DISTINCT huc10) AS unique_hucs,
      (SELECT count(*) FROM v_older) AS targets_scanned, (SELECT count(*) FROM v_older WHERE huc10 IN (SELECT huc10 FROM v_newer)) AS targets_matched FROM m""",
)
def match_summary(t):
    return J.match_summary(_matches(t), t.older)


@query("match_nonempty", "v_newer v_older", f"WITH {_MATCH} SELECT project_id, match_count FROM m WHERE match_count > 0")
def match_nonempty(t):
    return J.with_matches(_matches(t)).select("project_id", "match_count")


@query(
    "match_most_recent",
    "v_newer v_older",
    """WITH r AS (SELECT huc10, project_id, coalesce(updated_on, created_on) AS moment, row_number() OVER (PARTITION BY huc10 ORDER BY coalesce(updated_on, created_on) DESC, project_id DESC) AS rn FROM v_older WHERE huc10 IS NOT NULL)
    SELECT s.project_id, s.huc10 AS huc, r.project_id AS match_id, r.moment AS match_moment FROM v_newer s JOIN r ON s.huc10 = r.huc10 AND r.rn = 1""",
)
def match_most_recent(t):
    return J.match_latest(t.newer, t.older).select("project_id", "huc", "match_id", "match_moment")


@query(
    "mismatch_bounds",
    "v_newer v_older",
    f"""WITH {_MATCH} SELECT project_id, bounds_id, first_match_id, nullif(fb, '~null~') AS first_match_bounds, match_count > 1 AS several FROM m
    WHERE match_count > 0 AND bounds_id IS DISTINCT FROM nullif(fb, '~null~')""",
)
def mismatch_bounds(t):
    return J.bounds_mismatch(_matches(t)).select("project_id", "bounds_id", "first_match_id", "first_match_bounds", "several")


@query(
    "unmatched_report",
    "v_newer v_older",
    """SELECT project_id, name, CASE WHEN trim(owner_name) <> '' THEN owner_name ELSE 'UNKNOWN_OWNER' END AS owner, CASE WHEN trim(project_type_id) <> '' THEN project_type_id ELSE 'UNKNOWN_TYPE' END AS project_type,
      CASE WHEN trim(huc10) <> '' THEN huc10 ELSE 'UNKNOWN_HUC' END AS huc, tags, created_on, updated_on FROM v_newer s
    WHERE NOT EXISTS (SELECT 1 FROM v_older t WHERE t.huc10 = s.huc10)""",
)
def unmatched_report(t):
    return J.unmatched(t.newer, J.match_latest(t.newer, t.older))


@query(
    "pair_required_types",
    "v_projects",
    """SELECT huc10, min(CASE WHEN project_type_id = 'metrics' THEN project_id END) AS first_id, min(CASE WHEN project_type_id = 'riparian' THEN project_id END) AS second_id
    FROM v_projects WHERE tags LIKE '2024CONUS%' AND huc10 LIKE '17%' GROUP BY huc10
    HAVING count(*) FILTER (project_type_id = 'metrics') > 0 AND count(*) FILTER (project_type_id = 'riparian') > 0""",
)
def pair_required_types(t):
    return J.hucs_with_types(t.projects, "metrics", "riparian", tag="2024CONUS", like="17%")


def _batches(t):
    k = F.col("c_custkey")
    hucs = t.raw("customer").select((k % 3).alias("batch_id"), huc_from(k).alias("huc10")).distinct()
    batches = t.raw("region").filter("r_regionkey < 3").select(F.col("r_regionkey").alias("batch_id"), F.col("r_name").alias("name"))
    return batches, hucs


_BATCH_HUCS = "bh AS (SELECT DISTINCT c_custkey % 3 AS batch_id, CAST(1700000000 + (c_custkey % 300) * 1000003 AS VARCHAR) AS huc10 FROM customer)"


@query(
    "batch_projects",
    "v_projects",
    f"""WITH {_BATCH_HUCS}, sizes AS (SELECT batch_id, count(*) AS hucs FROM bh GROUP BY 1)
    SELECT p.project_id, p.huc10, r.r_name AS batch_name, sizes.hucs AS batch_hucs FROM bh JOIN v_projects p ON bh.huc10 = p.huc10 JOIN sizes ON sizes.batch_id = bh.batch_id JOIN region r ON r.r_regionkey = bh.batch_id
    WHERE p.project_type_id = 'valley' AND bh.batch_id = 1 AND p.tags LIKE '%2025%' AND p.tags LIKE '%URGENT%'
    UNION ALL SELECT project_id, huc10, NULL, NULL FROM v_projects WHERE project_type_id = 'valley' AND huc10 IN ('1700000000', '1705000015')""",
)
def batch_projects(t):
    batches, batch_hucs = _batches(t)
    found = J.batch_projects(t.projects, "valley", batch_hucs, 1, ["2025", "URGENT"])
    sized = found.join(J.batch_sizes(batches, batch_hucs), "batch_id")
    listed = J.batch_projects(t.projects, "valley", hucs=["1700000000", "1705000015"]).select("project_id", "huc10")
    return sized.select("project_id", "huc10", batches["name"].alias("batch_name"), F.col("hucs").alias("batch_hucs")).unionByName(listed, allowMissingColumns=True)


@query(
    "huc_has_project",
    "v_hucs v_meta v_projects",
    """SELECT h.huc10, m.key, p.project_type_id, p.project_id, p.owner_name, CASE WHEN m.key IS NOT NULL THEN 1 ELSE 0 END AS has_project
    FROM v_hucs h LEFT JOIN (SELECT * FROM v_meta WHERE key = 'HUC10') m ON m.value = h.huc10 LEFT JOIN v_projects p ON m.project_id = p.project_id""",
)
def huc_has_project(t):
    return J.huc_has_project(t.hucs, t.meta_long, t.projects, key="HUC10")


@query(
    "lookup_labels",
    "v_dgos v_values",
    """SELECT d.dgoid, d.fcode, d.huc10, CAST(v.metric_value AS BIGINT) AS owner_code, n.n_name AS fcode_label, r.r_name AS owner_code_label
    FROM v_dgos d JOIN v_values v ON v.dgo_id = d.dgoid AND v.metric_id = 1
    LEFT JOIN (SELECT CASE n_nationkey WHEN 0 THEN 'SMALL' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'LARGE' WHEN 3 THEN 'PROMO' END AS code, n_name FROM nation) n ON d.fcode = n.code
    LEFT JOIN region r ON r.r_regionkey = CAST(v.metric_value AS BIGINT)""",
)
def lookup_labels(t):
    owner = t.values.filter("metric_id = 1").select(F.col("dgo_id").alias("dgoid"), F.col("metric_value").cast("bigint").alias("owner_code"))
    rows = t.dgos.join(owner, "dgoid").select("dgoid", "fcode", "huc10", "owner_code")
    key = F.col("n_nationkey")
    codes = F.when(key == 0, "SMALL").when(key == 1, "MEDIUM").when(key == 2, "LARGE").when(key == 3, "PROMO")
    flows = t.raw("nation").select(codes.alias("code"), F.col("n_name").alias("label")).filter(F.col("code").isNotNull())
    owners = t.raw("region").select(F.col("r_regionkey").cast("bigint").alias("code"), F.col("r_name").alias("label"))
    return J.lookup_labels(rows, {"fcode": flows, "owner_code": owners})


_VISITS = """SELECT v.visit_id, s.site_name, w.watershed_name, v.visit_year, p.guid FROM v_visits v JOIN v_sites s USING (site_id) JOIN v_watersheds w USING (watershed_id)
    JOIN v_visit_projects p ON v.visit_id = p.visit_id WHERE v.program_id = 1 AND p.project_type = 1 AND p.guid IS NOT NULL AND v.aux_uploaded IS NULL"""


@query("visit_join_optional", "v_visits v_sites v_watersheds v_visit_projects", f"{_VISITS} AND v.visit_year = 1998 AND w.watershed_name = 'NATION_11' ORDER BY ALL")
def visit_join_optional(t):
    return J.visits_to_load(t.visits, t.sites, t.watersheds, t.visit_projects, year=1998, watershed="NATION_11")


@query("visit_join_all", "v_visits v_sites v_watersheds v_visit_projects", f"{_VISITS} ORDER BY ALL")
def visit_join_all(t):
    return J.visits_to_load(t.visits, t.sites, t.watersheds, t.visit_projects)


@query(
    "points_in_bbox",
    "v_boxes",
    """WITH pts AS (SELECT p_partkey AS point_id, (p_partkey * 37 % 4100) * 1e0 AS x, (p_partkey * 91 % 3900) * 1e0 AS y FROM part)
    SELECT point_id, feature_id FROM pts JOIN v_boxes ON x > xmin AND x < xmax AND y > ymin AND y < ymax""",
)
def points_in_bbox(t):
    k = F.col("p_partkey")
    points = t.raw("part").select(k.alias("point_id"), (k * 37 % 4100).cast("double").alias("x"), (k * 91 % 3900).cast("double").alias("y"))
    return J.within_bounds(points, t.boxes, 100.0).select("point_id", "feature_id")


@query(
    "merge_remap_keys",
    "v_dgos",
    """WITH n AS (SELECT huc10, dgoid, row_number() OVER (ORDER BY huc10, dgoid) AS new_id FROM v_dgos)
    SELECT n.new_id AS dgoid, n.huc10, l.l_linenumber AS line, count(*) AS n_rows, round(sum(l.l_quantity), 2) AS quantity FROM lineitem l JOIN n ON l.l_partkey = n.dgoid GROUP BY ALL""",
)
def merge_remap_keys(t):
    child = t.raw("lineitem").select(
        F.col("l_partkey").alias("dgoid"), (F.lit(1700000000).cast("bigint") + (F.col("l_partkey") % 300) * 1000003).cast("string").alias("huc10"),
        F.col("l_linenumber").alias("line"), "l_quantity",
    )
    _, moved = J.merge_remap(t.dgos.select("dgoid", "huc10"), {"lines": child}, "dgoid")
    return moved["lines"].groupBy("dgoid", "huc10", "line").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query(
    "sync_compare",
    "v_projects",
    """WITH l AS (SELECT project_id AS k, name, owner_name, visibility, model_version, project_type_id, bounds_id AS m FROM v_projects WHERE CAST(project_id AS BIGINT) % 10 <> 1),
    r AS (SELECT project_id AS k, CASE WHEN CAST(project_id AS BIGINT) % 6 = 0 THEN upper(name) ELSE name END AS name, owner_name, CASE WHEN CAST(project_id AS BIGINT) % 8 = 0 THEN NULL ELSE visibility END AS visibility, model_version, project_type_id,
       CASE WHEN CAST(project_id AS BIGINT) % 9 = 0 THEN 'other' ELSE bounds_id END AS m FROM v_projects WHERE CAST(project_id AS BIGINT) % 10 <> 2),
    c AS (SELECT coalesce(l.k, r.k) AS project_id, l.k AS lk, r.k AS rk, CASE WHEN l.name IS DISTINCT FROM r.name THEN 'name' WHEN l.visibility IS DISTINCT FROM r.visibility THEN 'visibility' WHEN l.m IS DISTINCT FROM r.m THEN 'meta' END AS f FROM l FULL JOIN r ON l.k = r.k)
    SELECT project_id, CASE WHEN lk IS NULL THEN 'remote_only' WHEN rk IS NULL THEN 'create' WHEN f IS NOT NULL THEN 'update' ELSE 'same' END AS status,
      CASE WHEN lk IS NOT NULL AND rk IS NOT NULL THEN f END AS first_change FROM c""",
)
def sync_compare(t):
    k = F.col("project_id").cast("bigint")
    base = t.projects.select("project_id", "name", "owner_name", "visibility", "model_version", "project_type_id", "bounds_id")
    meta = lambda v: F.create_map(F.lit("bounds"), v, F.lit("a"), F.lit("1"))
    local = base.filter(k % 10 != 1).withColumn("meta", meta(F.col("bounds_id")))
    remote = base.filter(k % 10 != 2).select(
        "project_id", F.when(k % 6 == 0, F.upper("name")).otherwise(F.col("name")).alias("name"), "owner_name",
        F.when(k % 8 == 0, None).otherwise(F.col("visibility")).alias("visibility"), "model_version", "project_type_id",
        F.create_map(F.lit("a"), F.lit("1"), F.lit("bounds"), F.when(k % 9 == 0, "other").otherwise(F.col("bounds_id"))).alias("meta"),
    )
    return J.sync_compare(local, remote, "project_id", ["name", "owner_name", "visibility", "model_version", "project_type_id"])
