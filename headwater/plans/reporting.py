"""Statistics, counts and ranking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.functions.columns import version_int
from headwater.operators import ranking, stats
from headwater.operators.joins import match_by_huc
from headwater.plans.registry import query


def rounded(df, digits: int, *names: str):
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def rounded_up(df, digits: int, *names: str):
    """Rounded after a nudge of a thousandth of the last digit, so that a sum's order of additions
    does not decide on which side of a tie it ends."""
    return df.withColumns({n: F.round(F.col(n) + 10.0 ** -(digits + 3), digits) for n in names})


_NAMES = [name for _, _, name in stats.HUC_METRICS]
_METHOD_SQL = {
    "length_weighted": "sum(CASE WHEN m.metric_id = {i} THEN m.metric_value * d.centerline_length END) / nullif(sum(CASE WHEN m.metric_id = {i} THEN d.centerline_length END), 0)",
    "area_weighted": "sum(CASE WHEN m.metric_id = {i} THEN m.metric_value * d.segment_area END) / nullif(sum(CASE WHEN m.metric_id = {i} THEN d.segment_area END), 0)",
    "sum": "sum(CASE WHEN m.metric_id = {i} THEN m.metric_value END)",
    "times_length": "sum(CASE WHEN m.metric_id = {i} THEN m.metric_value * d.centerline_length END)",
    "times_area": "sum(CASE WHEN m.metric_id = {i} THEN m.metric_value * d.segment_area END)",
    "zero_area": "coalesce(sum(CASE WHEN m.metric_id = {i} AND m.metric_value = 0 THEN d.segment_area END), 0)",
}
_METRIC_SQL = ",\n".join(f"{_METHOD_SQL[how].format(i=i)} AS {name}" for i, how, name in stats.HUC_METRICS)
# the base rows and the metric rows of every group, as the separate queries they are by definition
_STATS_CTE = f"""
WITH picked AS (
  SELECT d.dgoid, d.huc10, d.centerline_length, d.segment_area, s.id AS state_id, f.id AS flow_id, CAST(NULL AS INTEGER) AS owner_id
  FROM v_dgos d JOIN v_values dms ON d.dgoid = dms.dgo_id AND dms.metric_id = 2
  JOIN v_states_codes s ON dms.metric_value = CAST(s.code AS DOUBLE) JOIN v_flows_codes f ON d.fcode = f.code
  UNION ALL
  SELECT d.dgoid, d.huc10, d.centerline_length, d.segment_area, s.id, f.id, o.id
  FROM v_dgos d JOIN v_values dms ON d.dgoid = dms.dgo_id AND dms.metric_id = 2
  JOIN v_states_codes s ON dms.metric_value = CAST(s.code AS DOUBLE) JOIN v_flows_codes f ON d.fcode = f.code
  JOIN v_values dmo ON d.dgoid = dmo.dgo_id AND dmo.metric_id = 1 JOIN v_owners_codes o ON dmo.metric_value = CAST(o.code AS DOUBLE)),
base AS (SELECT huc10, state_id, flow_id, owner_id, count(*) AS dgo_count, coalesce(sum(centerline_length), 0) AS total_length,
  coalesce(sum(segment_area), 0) AS total_area FROM picked GROUP BY ALL),
mets AS (SELECT d.huc10, d.state_id, d.flow_id, d.owner_id, {_METRIC_SQL}
  FROM picked d JOIN v_values m ON d.dgoid = m.dgo_id GROUP BY ALL),
stats AS (SELECT base.*, {', '.join('mets.' + n for n in _NAMES)} FROM base LEFT JOIN mets
  ON base.huc10 = mets.huc10 AND base.state_id = mets.state_id AND base.flow_id = mets.flow_id AND base.owner_id IS NOT DISTINCT FROM mets.owner_id)
"""
_STATS_USES = "v_dgos v_values v_states_codes v_flows_codes v_owners_codes"
_ROUNDED = ", ".join(f"round({n} + 1e-7, 4) AS {n}" for n in ["total_length", "total_area", *_NAMES])


def _huc_statistics(t):
    return stats.huc_statistics(t.dgos, t.values, t.lookup("states"), t.lookup("flows"), t.lookup("owners"))


@query("huc_statistics", _STATS_USES, f"{_STATS_CTE} SELECT huc10, state_id, flow_id, owner_id, dgo_count, {_ROUNDED} FROM stats")
def huc_statistics(t):
    return rounded_up(_huc_statistics(t), 4, "total_length", "total_area", *_NAMES)


@query(
    "secondary_metrics",
    _STATS_USES,
    f"""{_STATS_CTE} SELECT huc10, state_id, flow_id, owner_id,
    round(riparian_area / nullif(1 - riparian_departure, 0) + 1e-7, 4) AS hist_riparian_area,
    round(channel_length / nullif(total_length, 0) + 1e-9, 6) AS relative_flow_length,
    round((total_area * 0.000247105e0) / nullif(total_length * 0.000621371e0, 0) + 1e-9, 6) AS acres_vb_per_mile,
    round(road_length / nullif(total_length, 0) + 1e-9, 6) AS road_density, round(rail_length / nullif(total_length, 0) + 1e-9, 6) AS rail_density,
    round(riparian_ag_conv_area / nullif(total_area, 0) + 1e-9, 6) AS riparian_ag_conversion_proportion,
    round(riparian_developed_area / nullif(total_area, 0) + 1e-9, 6) AS riparian_developed_proportion FROM stats""",
)
def secondary_metrics(t):
    out = stats.secondary_metrics(_huc_statistics(t))
    out = rounded_up(out, 6, "relative_flow_length", "acres_vb_per_mile", "road_density", "rail_density", "riparian_ag_conversion_proportion", "riparian_developed_proportion")
    out = rounded_up(out, 4, "hist_riparian_area")
    return out.select("huc10", "state_id", "flow_id", "owner_id", "hist_riparian_area", "relative_flow_length", "acres_vb_per_mile", "road_density", "rail_density", "riparian_ag_conversion_proportion", "riparian_developed_proportion")


@query(
    "metric_summary",
    "v_dgos v_values",
    """SELECT huc10, round(sum(metric_value * centerline_length) / nullif(sum(centerline_length), 0) + 1e-9, 6) AS length_weighted,
    round(sum(metric_value * segment_area) / nullif(sum(segment_area), 0) + 1e-9, 6) AS area_weighted, round(sum(metric_value) + 1e-7, 4) AS sum,
    round(sum(metric_value * centerline_length) + 1e-7, 4) AS times_length, round(sum(metric_value * segment_area) + 1e-7, 4) AS times_area,
    round(coalesce(sum(CASE WHEN metric_value = 0 THEN segment_area END), 0) + 1e-7, 4) AS zero_area
    FROM v_dgos JOIN v_values ON dgoid = dgo_id WHERE metric_id = 37 GROUP BY huc10""",
)
def metric_summary(t):
    out = stats.metric_summary(t.dgos, t.values, 37, ["huc10"])
    return rounded_up(rounded_up(out, 6, "length_weighted", "area_weighted"), 4, "sum", "times_length", "times_area", "zero_area")


@query(
    "huc4_status",
    "v_projects v_hucs",
    """WITH h AS (SELECT substr(huc10, 1, 4) AS huc4, count(*) AS huc10_count FROM v_hucs GROUP BY 1),
    p AS (SELECT substr(huc10, 1, 4) AS huc4, project_type_id, model_version, count(*) AS project_count FROM v_projects JOIN v_hucs USING (huc10) GROUP BY 1, 2, 3)
    SELECT h.huc4, h.huc10_count, p.project_type_id, p.model_version, p.project_count, CAST((100 * coalesce(p.project_count, 0)) // h.huc10_count AS DOUBLE) AS project_pc FROM h LEFT JOIN p ON h.huc4 = p.huc4""",
)
def huc4_status(t):
    return stats.huc4_status(t.projects, t.hucs)


@query(
    "percent_complete",
    "v_projects v_hucs",
    """SELECT project_type_id, count(DISTINCT huc10) AS huc_count, (SELECT count(DISTINCT huc10) FROM v_hucs) AS huc_total,
      round(count(DISTINCT huc10) * 100.0e0 / (SELECT count(DISTINCT huc10) FROM v_hucs), 4) AS percent FROM v_projects WHERE tags LIKE '2024CONUS%' GROUP BY 1""",
)
def percent_complete(t):
    return rounded(stats.percent_complete(t.projects, t.hucs, tag="2024CONUS"), 4, "percent")


@query(
    "proc_time_stats",
    "v_projects v_meta",
    """SELECT owner_name, project_type_id, round(max(v), 1) AS max_minutes, round(min(v), 1) AS min_minutes, round(avg(v), 1) AS avg_minutes
    FROM v_projects JOIN (SELECT project_id, TRY_CAST(value AS DOUBLE) / 60 AS v FROM v_meta WHERE key = 'ProcTimeS') m USING (project_id) GROUP BY 1, 2""",
)
def proc_time_stats(t):
    return stats.meta_stats(t.projects, t.meta_long, "ProcTimeS")


@query(
    "task_cost",
    "v_jobs v_tasks",
    """SELECT jid, task_no, task_ref, job_name, cpu, memory, round((ended_on - started_on) / 1000.0e0, 0) AS duration_s,
      round((cpu / 1024.0e0 * 0.04048e0 + memory / 1000.0e0 * 0.004445e0) * ((ended_on - started_on) / 3600000.0e0), 2) AS estimated_cost
    FROM v_tasks JOIN v_jobs USING (jid) WHERE script_id = 'valley'""",
)
def task_cost(t):
    return stats.task_cost(t.jobs, t.tasks, "valley").select("jid", "task_no", "task_ref", "job_name", "cpu", "memory", "duration_s", "estimated_cost")


@query(
    "size_stats",
    "v_projects",
    """SELECT owner_id, CAST(grouping(owner_id) AS BIGINT) AS all_owners, CAST(sum(total_size) AS BIGINT) AS bytes, count(*) AS n, max(total_size) AS largest, min(nullif(total_size, 0)) AS smallest,
      round(avg(total_size), 2) AS mean_bytes FROM v_projects GROUP BY ROLLUP (owner_id)""",
)
def size_stats(t):
    return rounded(stats.size_stats(t.projects), 2, "mean_bytes")


@query(
    "group_counts_topk",
    "v_projects",
    """WITH m AS (SELECT CASE WHEN trim(coalesce(owner_name, '')) = '' THEN 'UNKNOWN_OWNER' ELSE owner_name END AS owner_name, coalesce(project_type_id, 'UNKNOWN_TYPE') AS project_type_id, coalesce(huc10, 'UNKNOWN_HUC') AS huc10
      FROM v_projects WHERE bounds_id IS NULL OR trim(bounds_id) = ''),
    c AS (SELECT 'owner_name' AS dim, owner_name AS value, count(*) AS n FROM m GROUP BY 2 UNION ALL SELECT 'project_type_id', project_type_id, count(*) FROM m GROUP BY 2
      UNION ALL SELECT 'huc10', huc10, count(*) FROM m GROUP BY 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY dim ORDER BY n DESC, value NULLS FIRST) AS rn FROM c)
    SELECT dim, value, n FROM r WHERE rn <= CASE dim WHEN 'owner_name' THEN 20 WHEN 'huc10' THEN 30 ELSE 1000000 END""",
)
def group_counts_topk(t):
    missing = t.projects.filter("bounds_id IS NULL OR trim(bounds_id) = ''")
    unknown = {"owner_name": "UNKNOWN_OWNER", "project_type_id": "UNKNOWN_TYPE", "huc10": "UNKNOWN_HUC"}
    return stats.group_counts(missing, {"owner_name": 20, "project_type_id": None, "huc10": 30}, unknown)


@query(
    "missing_totals",
    "v_projects",
    "SELECT count(*) AS total, count(*) FILTER (bounds_id IS NULL) AS missing, round(count(*) FILTER (bounds_id IS NULL) * 100.0e0 / count(*), 4) AS missing_pc FROM v_projects",
)
def missing_totals(t):
    return rounded(stats.missing_totals(t.projects, F.col("bounds_id").isNull()), 4, "missing_pc")


def uploads(t):
    k = F.col("project_id").cast("bigint")
    sent = F.when(k % 3 == 0, F.date_format(F.timestamp_millis("created_on"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t.projects.select(
        (k % 11 != 0).alias("has_match"), ((k % 3 == 0) & (k % 11 != 0)).alias("uploaded"), F.when(k % 33 == 3, "unknown").otherwise(sent).alias("uploaded_at"),
        (k % 4 != 0).alias("has_xml"), (k % 5 != 0).alias("has_bounds"),
        F.when(k % 4 != 0, F.col("total_size") % 10007).alias("xml_size"), F.when(k % 5 != 0, F.col("total_size") % 100003).alias("bounds_size"),
    )


@query(
    "upload_status",
    "v_projects",
    """WITH k AS (SELECT CAST(project_id AS BIGINT) AS k, created_on, total_size FROM v_projects),
    u AS (SELECT k % 11 <> 0 AS has_match, k % 3 = 0 AND k % 11 <> 0 AS uploaded, CASE WHEN k % 33 <> 3 AND k % 3 = 0 THEN created_on END AS ms, k % 4 <> 0 AS x, k % 5 <> 0 AS b,
      CASE WHEN k % 4 <> 0 THEN total_size % 10007 END AS xs, CASE WHEN k % 5 <> 0 THEN total_size % 100003 END AS bs FROM k)
    SELECT count(*) AS total, count(*) FILTER (has_match) AS with_match, count(*) FILTER (NOT has_match) AS missing_match, count(*) FILTER (uploaded) AS uploaded,
      round(count(*) FILTER (uploaded) * 100.0e0 / count(*), 4) AS uploaded_pc, count(*) FILTER (NOT uploaded) AS not_uploaded, count(*) FILTER (NOT uploaded AND x AND b) AS ready,
      count(*) FILTER (NOT uploaded AND NOT x AND b) AS missing_xml, count(*) FILTER (NOT uploaded AND x AND NOT b) AS missing_bounds, count(*) FILTER (NOT uploaded AND NOT x AND NOT b) AS missing_both,
      CAST(sum(xs) FILTER (NOT uploaded AND x AND b) AS BIGINT) AS xml_bytes, round(avg(xs) FILTER (NOT uploaded AND x AND b), 4) AS xml_mean,
      CAST(sum(bs) FILTER (NOT uploaded AND x AND b) AS BIGINT) AS bounds_bytes, round(avg(bs) FILTER (NOT uploaded AND x AND b), 4) AS bounds_mean,
      strftime(epoch_ms(min(ms)), '%Y-%m-%d %H:%M:%S') AS earliest, strftime(epoch_ms(max(ms)), '%Y-%m-%d %H:%M:%S') AS latest FROM u""",
)
def upload_status(t):
    out = rounded(stats.upload_status(uploads(t)), 4, "uploaded_pc", "xml_mean", "bounds_mean")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("earliest", "latest")})


@query(
    "table_cardinality",
    "v_dgos v_igos",
    """WITH c AS (SELECT huc10, count(*) AS dgos, 0 AS igos, 0 AS metrics FROM v_dgos GROUP BY 1 UNION ALL SELECT huc10, 0, count(*), 0 FROM v_igos GROUP BY 1
      UNION ALL SELECT d.huc10, 0, 0, count(*) FROM (SELECT DISTINCT l_partkey FROM lineitem) l JOIN v_dgos d ON d.dgoid = l.l_partkey GROUP BY 1)
    SELECT huc10, CAST(sum(dgos) AS BIGINT) AS dgos, CAST(sum(igos) AS BIGINT) AS igos, CAST(sum(metrics) AS BIGINT) AS metrics, sum(dgos) = sum(igos) AND sum(dgos) = sum(metrics) AS all_equal FROM c GROUP BY 1""",
)
def table_cardinality(t):
    metrics = t.side("desc").join(t.dgos.select("dgoid", "huc10"), "dgoid")
    return stats.table_cardinality({"dgos": t.dgos, "igos": t.igos, "metrics": metrics}, "huc10")


@query(
    "duplicate_keys",
    "v_dgos",
    """SELECT count(*) AS duplicate_groups, count(*) > 0 AS has_duplicates FROM (SELECT level_path, seg_distance FROM v_dgos WHERE level_path IS NOT NULL AND seg_distance IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)""",
)
def duplicate_keys(t):
    return stats.duplicate_keys(t.dgos, ["level_path", "seg_distance"])


@query(
    "distinct_days",
    "v_projects",
    """SELECT DISTINCT project_type_id, model_version, created_on // 86400000 * 86400000 AS day_ms, strftime(epoch_ms(created_on), '%Y-%m-%d') AS day FROM v_projects""",
)
def distinct_days(t):
    return stats.load_units(t.projects)


@query(
    "match_histogram",
    "v_newer v_older",
    """SELECT match_count, count(*) AS rows FROM (SELECT s.project_id, count(t.project_id) AS match_count FROM v_newer s LEFT JOIN v_older t ON s.huc10 = t.huc10 GROUP BY 1) GROUP BY 1""",
)
def match_histogram(t):
    return stats.count_histogram(match_by_huc(t.newer, t.older), "match_count")


@query(
    "visit_multirow",
    sql="""SELECT 'm' || l_linenumber AS table_name, max(n) AS max_rows, max(n) > 1 AS multirow FROM (SELECT l_linenumber, l_orderkey, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
)
def visit_multirow(t):
    lines = t.raw("lineitem")
    return stats.multirow({f"m{i}": lines.filter(F.col("l_linenumber") == i).select(F.col("l_orderkey").alias("visit_id")) for i in range(1, 8)})


@query(
    "synthesis_summary",
    "v_projects",
    """SELECT count(*) AS row_count, count(DISTINCT huc10) AS huc_count, count(DISTINCT project_id) AS project_count, round(min(xmin), 6) AS xmin, round(min(ymin), 6) AS ymin,
      round(max(xmax), 6) AS xmax, round(max(ymax), 6) AS ymax, round((min(xmin) + max(xmax)) / 2, 6) AS center_x, round((min(ymin) + max(ymax)) / 2, 6) AS center_y,
      'POLYGON ((' || min(xmin) || ' ' || min(ymin) || ', ' || max(xmax) || ' ' || min(ymin) || ', ' || max(xmax) || ' ' || max(ymax) || ', ' || min(xmin) || ' ' || max(ymax) || ', ' || min(xmin) || ' ' || min(ymin) || '))' AS outline
    FROM v_projects""",
)
def synthesis_summary(t):
    return rounded(stats.synthesis_summary(t.projects), 6, "xmin", "ymin", "xmax", "ymax", "center_x", "center_y")


# --- ranking ----------------------------------------------------------------------------------

_RANK = "row_number() OVER (PARTITION BY {by} ORDER BY {order} DESC, project_id DESC) AS rn"


@query("older_duplicates", "v_projects", f"SELECT project_id, project_type_id, huc10, created_on FROM (SELECT *, {_RANK.format(by='project_type_id, huc10', order='created_on')} FROM v_projects) WHERE rn > 1")
def older_duplicates(t):
    return ranking.older_duplicates(t.projects).select("project_id", "project_type_id", "huc10", "created_on")


@query(
    "keep_delete_status",
    "v_projects v_meta",
    f"""WITH j AS (SELECT p.*, m.value AS huc, n.value AS version FROM v_projects p JOIN v_meta m ON p.project_id = m.project_id AND m.key = 'HUC10' JOIN v_meta n ON p.project_id = n.project_id AND n.key = 'Model Version')
    SELECT project_id, owner_name, project_type_id, huc, version, CASE WHEN rn = 1 THEN 'KEEP' ELSE 'DELETE' END AS status FROM (SELECT *, {_RANK.format(by='owner_name, project_type_id, huc, version', order='created_on')} FROM j)""",
)
def keep_delete_status(t):
    return ranking.keep_delete(t.projects, t.meta_long, "HUC10", "Model Version").select("project_id", "owner_name", "project_type_id", "huc", "version", "status")


@query(
    "latest_by_version",
    "v_projects v_version_int",
    f"""WITH p AS (SELECT p.*, coalesce(v.model_version_int, -1) AS vi FROM v_projects p JOIN v_version_int v USING (project_id)),
    r AS (SELECT *, {_RANK.format(by='project_type_id, huc10', order='vi DESC, created_on')}, count(*) OVER (PARTITION BY project_type_id, huc10) AS group_size FROM p)
    SELECT project_id, project_type_id, huc10, group_size, rn > 1 AS deletable FROM r WHERE group_size > 1""",
)
def latest_by_version(t):
    versioned = t.projects.withColumn("model_version_int", version_int(F.col("model_version")))
    return ranking.latest_by_version(versioned).select("project_id", "project_type_id", "huc10", "group_size", "deletable")


@query("row_numbering", "v_projects", "SELECT project_id, row_number() OVER (ORDER BY project_type_id, project_id) AS row_id FROM v_projects")
def row_numbering(t):
    return ranking.with_row_number(t.projects.select("project_type_id", "project_id"), ["project_type_id", "project_id"]).select("project_id", "row_id")


@query("max_watermark", "v_feed", "SELECT max(created_on) AS max_ms, max(created_on) // 86400000 * 86400000 AS from_ms FROM v_feed")
def max_watermark(t):
    return ranking.watermark(t.feed)


@query(
    "first_dgo_attrs",
    "v_dgos",
    """SELECT level_path, seg_distance, min(dgoid) AS dgoid, arg_min(fcode, dgoid) AS fcode, arg_min(segment_area, dgoid) AS segment_area, arg_min(centerline_length, dgoid) AS centerline_length FROM v_dgos GROUP BY 1, 2""",
)
def first_dgo_attrs(t):
    return ranking.first_per_key(t.dgos.drop("huc10"), ["level_path", "seg_distance"], "dgoid")
