"""Pivot, tag, quality and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.operators import quality, reshape, sets, tags
from headwater.operators.ranking import first_per_key
from headwater.plans.bindings import METRIC_IDS
from headwater.plans.registry import query

_EPOCH = [
    ("active", "5", "1989_1993", "68", "area", "active_5yr_1989_1993_68pc_area"),
    ("active", "5", "1989_1993", "68", "width", "active_5yr_1989_1993_68pc_width"),
    ("wet", "30", "1989_2018", "95", "area", "wet_30yr_1989_2018_95pc_area"),
    ("wet", "30", "1989_2018", "95", "areapc", "wet_30yr_1989_2018_95pc_areapc"),
]
_LONG = " UNION ALL ".join(
    f"SELECT fid AS dgo_id, '{a}' AS landcover, '{b}' AS epoch_length, '{c}' AS epoch_name, '{d}' AS confidence, '{m}' AS metric_name, {col} AS measurement FROM v_epoch" for a, b, c, d, m, col in _EPOCH
)


@query("epoch_metrics_long", "v_epoch", _LONG)
def epoch_metrics_long(t):
    return reshape.epoch_long(t.epoch)


@query(
    "epoch_metrics_table",
    "v_epoch",
    f"""WITH l AS ({_LONG}) SELECT dgo_id, landcover, epoch_length, epoch_name, confidence, avg(measurement) FILTER (metric_name = 'area') AS area,
      avg(measurement) FILTER (metric_name = 'width') AS width, avg(measurement) FILTER (metric_name = 'areapc') AS areapc,
      CAST(1700000000 + (dgo_id % 300) * 1000003 AS VARCHAR) AS huc FROM l WHERE measurement IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
)
def epoch_metrics_table(t):
    huc = (F.lit(1700000000).cast("bigint") + (F.col("dgo_id") % 300) * 1000003).cast("string")
    return reshape.epoch_table(t.epoch, constants={"huc": huc})


_DICT = [(i, f"metric_{i}", ["INTEGER", "FLOAT", "STRING"][n % 3], i != 42) for n, i in enumerate(METRIC_IDS)]
_CAST = {"INTEGER": "CAST(floor({v}) AS BIGINT)", "FLOAT": "{v}", "STRING": "CAST({v} AS VARCHAR)"}
_EAV = ", ".join(f"{_CAST[dt].format(v=f'max(CASE WHEN metric_id = {i} THEN metric_value END)')} AS {name}" for i, name, dt, on in _DICT if on)


@query(
    "metrics_eav_to_wide",
    "v_values v_dgos",
    f"""WITH w AS (SELECT level_path, seg_distance, {_EAV} FROM v_dgos JOIN v_values ON dgoid = dgo_id
      WHERE metric_value IS NOT NULL AND metric_id IN ({', '.join(str(d[0]) for d in _DICT if d[3])}) GROUP BY 1, 2),
    f AS (SELECT level_path, seg_distance, min(dgoid) AS dgo_id, arg_min(fcode, dgoid) AS fcode, arg_min(segment_area, dgoid) AS segment_area, arg_min(centerline_length, dgoid) AS centerline_length FROM v_dgos GROUP BY 1, 2)
    SELECT f.*, w.* EXCLUDE (level_path, seg_distance) FROM f LEFT JOIN w
    ON f.level_path IS NOT DISTINCT FROM w.level_path AND f.seg_distance IS NOT DISTINCT FROM w.seg_distance""",
)
def metrics_eav_to_wide(t):
    return reshape.location_metrics(t.dgos.drop("huc10"), t.values, _DICT).withColumnRenamed("dgoid", "dgo_id")


def _measurements(t):
    lines = t.raw("lineitem").select(
        F.col("l_orderkey").alias("visit_id"), "l_partkey", "l_suppkey", "l_quantity", "l_linenumber",
        F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate").alias("row_id"),
    )
    names = ["WoodyDebrisJam", "SolarExposure", "InverterbrateSample"]
    return {n: lines.filter(F.col("l_linenumber") % 3 == i).drop("l_linenumber") for i, n in enumerate(names)}


@query(
    "measurement_docs",
    sql="""SELECT l_orderkey AS visit_id, CASE l_linenumber % 3 WHEN 0 THEN 'Woody_Debris_Jam' WHEN 1 THEN 'Solar_Exposure' ELSE 'Invertebrate_Sample' END AS file_name,
      count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1, 2""",
)
def measurement_docs(t):
    docs = reshape.measurement_docs(_measurements(t), ["Woody Debris Jam", "Solar Exposure", "Invertebrate Sample"], chunk=3)
    entries = F.from_json("document", "struct<value:array<struct<MeasurementType:string,value:struct<l_quantity:double>>>>")["value"]
    read = docs.withColumn("e", entries)
    quantity = F.aggregate("e", F.lit(0.0), lambda a, x: a + x["value"]["l_quantity"])
    return read.groupBy("visit_id", "file_name").agg(F.sum(F.size("e")).alias("n"), F.round(F.sum(quantity), 2).alias("quantity"))


def context_docs(t):
    """Context documents per watershed: histogram of segment areas and the share of each flow code."""
    areas = t.dgos.groupBy("huc10", F.floor(F.col("segment_area") / 10000).alias("b")).agg(
        F.count(F.lit(1)).alias("cells"), F.min("segment_area").alias("lo"), F.max("segment_area").alias("hi")
    )
    bins = areas.groupBy("huc10").agg(
        F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("cells").alias("value_count"),
        F.array_sort(F.collect_list(F.struct((F.col("b") * 10000).alias("bin"), F.col("cells").alias("cell_count")))).alias("bins"),
    )
    shares = t.dgos.groupBy("huc10", "fcode").agg(F.sum("centerline_length").alias("v")).groupBy("huc10").agg(
        F.map_from_entries(F.collect_list(F.struct("fcode", "v"))).alias("ownership")
    )
    return bins.join(shares, "huc10").select(
        F.col("huc10").alias("huc"), F.struct("min", "max", "value_count", F.lit("continuous").alias("hist_type"), "bins").alias("dem_bins"), "ownership"
    )


@query(
    "rs_context_flatten",
    "v_dgos",
    """WITH b AS (SELECT huc10, floor(segment_area / 10000) * 10000 AS bin, count(*) AS n FROM v_dgos GROUP BY 1, 2)
    SELECT huc10 AS huc, 'scalar' AS part, 'dem_bins.value_count' AS name, CAST(count(*) AS DOUBLE) AS value FROM v_dgos GROUP BY 1
    UNION ALL SELECT huc10, 'scalar', 'dem_bins.min', min(segment_area) FROM v_dgos GROUP BY 1 UNION ALL SELECT huc10, 'scalar', 'dem_bins.max', max(segment_area) FROM v_dgos GROUP BY 1
    UNION ALL SELECT huc10, 'bin', CAST(CAST(bin AS BIGINT) AS VARCHAR), CAST(n AS DOUBLE) FROM b UNION ALL SELECT huc10, 'ownership', fcode, round(sum(centerline_length), 4) FROM v_dgos GROUP BY 1, 3""",
)
def rs_context_flatten(t):
    docs = context_docs(t)
    flat = reshape.context_scalars(docs)
    names = ["dem_bins.value_count", "dem_bins.min", "dem_bins.max"]
    scalars = flat.select("huc", F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value")) for n in names]))).withColumn("part", F.lit("scalar"))
    bins = reshape.context_bins(docs, "dem_bins").select("huc", F.col("bin").cast("bigint").cast("string").alias("name"), F.col("cell_count").cast("double").alias("value"), F.lit("bin").alias("part"))
    owners = reshape.context_map(docs, "ownership").select("huc", F.col("key").alias("name"), F.round("value", 4).alias("value"), F.lit("ownership").alias("part"))
    return scalars.unionByName(bins).unionByName(owners)


def _dictionaries(t):
    """Layer dictionaries: one per block of 50 parts and version, a layer per type, a column per part."""
    p = F.col("p_partkey")
    column = F.struct(
        F.concat(F.lit("c"), p.cast("string")).alias("name"),
        F.when(p % 2 == 0, "INTEGER").otherwise("STRING").alias("dtype"),
        (p % 5 == 0).alias("is_required"),
    )
    layers = t.raw("part").select(F.floor(p / 50).alias("tool"), F.col("p_type").alias("layer_id"), column.alias("c"))
    layers = layers.withColumn("minor", F.explode(F.array(F.lit(2), F.lit(10))))
    return (
        layers.groupBy("tool", "minor", "layer_id").agg(F.array_sort(F.collect_list("c")).alias("columns"))
        .groupBy("tool", "minor").agg(F.array_sort(F.collect_list(F.struct("layer_id", "columns"))).alias("layers"))
        .select(
            F.lit("tools").alias("authority"), F.concat(F.lit("t"), F.col("tool").cast("string")).alias("tool_schema_name"),
            F.concat(F.lit("1."), F.col("minor").cast("string"), F.lit(".0")).alias("tool_schema_version"), F.md5(F.col("tool").cast("string")).alias("commit"), "layers",
        )
    )


@query(
    "layer_catalog",
    sql="""SELECT 'tools' AS authority, 't' || p_partkey // 50 AS tool_schema_name, v AS tool_schema_version, md5(CAST(p_partkey // 50 AS VARCHAR)) AS commit, p_type AS layer_id,
      'c' || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN 'INTEGER' ELSE 'STRING' END AS dtype, p_partkey % 5 = 0 AS is_required FROM part CROSS JOIN (VALUES ('1.2.0'), ('1.10.0')) AS x(v)""",
)
def layer_catalog(t):
    return reshape.layer_catalog(_dictionaries(t))


@query(
    "layer_catalog_latest",
    sql="""SELECT 'tools' AS authority, 't' || p_partkey // 50 AS tool_schema_name, '1.10.0' AS tool_schema_version, md5(CAST(p_partkey // 50 AS VARCHAR)) AS commit, p_type AS layer_id,
      'c' || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN 'INTEGER' ELSE 'STRING' END AS dtype, p_partkey % 5 = 0 AS is_required FROM part""",
)
def layer_catalog_latest(t):
    return reshape.layer_catalog_latest(reshape.layer_catalog(_dictionaries(t)))


PROJECT_DICTIONARY = [
    {"name": "PROJECT_ID", "dtype": "INTEGER", "is_required": True},
    {"name": "model_version", "dtype": "FLOAT", "is_required": False},
    {"name": "total_size", "dtype": "STRING", "is_required": False},
    {"name": "geom", "dtype": "STRING", "is_required": True},
]


@query(
    "conform_to_dictionary",
    "v_projects",
    "SELECT CAST(project_id AS BIGINT) AS PROJECT_ID, TRY_CAST(model_version AS DOUBLE) AS model_version, CAST(total_size AS VARCHAR) AS total_size, CAST(NULL AS VARCHAR) AS geom FROM v_projects",
)
def conform_to_dictionary(t):
    return reshape.conform(t.projects, PROJECT_DICTIONARY)


@query(
    "dictionary_value_report",
    "v_projects",
    """SELECT 'PROJECT_ID' AS column_name, 0 AS nulls, 0 AS misfits UNION ALL SELECT 'model_version', 0, count(*) FILTER (TRY_CAST(model_version AS DOUBLE) IS NULL) FROM v_projects
    UNION ALL SELECT 'total_size', 0, 0""",
)
def dictionary_value_report(t):
    return reshape.value_report(t.projects, PROJECT_DICTIONARY)


# --- tags -------------------------------------------------------------------------------------


@query("tags_missing_any", "v_projects", "SELECT project_id, tags FROM v_projects WHERE NOT (tags LIKE '2024CONUS%' AND tags LIKE '%2-HIGH')")
def tags_missing_any(t):
    return tags.tags_missing_any(t.search_index, ["2024CONUS", "2-HIGH"]).select("project_id", F.array_join("tags", "|").alias("tags"))


@query(
    "tags_add",
    "v_projects",
    """WITH n AS (SELECT project_id, tags, string_split(tags, '|') AS o FROM v_projects)
    SELECT project_id, 'add' AS mode, array_to_string(o || list_filter(['2024CONUS', 'x'], lambda g: NOT list_contains(o, g)), '|') AS new_tags FROM n
    UNION ALL SELECT project_id, 'merge', array_to_string(list_sort(list_distinct(o || ['2024CONUS', '5-LOW'])), '|') FROM n WHERE tags <> '2024CONUS|5-LOW'
    UNION ALL SELECT project_id, 'replace', '2024CONUS|5-LOW' FROM n WHERE tags <> '2024CONUS|5-LOW'""",
)
def tags_add(t):
    index = t.search_index

    def run(given, mode, listed=F.col("new_tags")):
        return tags.tags_add(index, given, mode).select("project_id", F.lit(mode).alias("mode"), F.array_join(listed, "|").alias("new_tags"))

    low = ["2024CONUS", "5-LOW"]
    return run(["2024CONUS", "x"], "add").union(run(low, "merge", F.array_sort("new_tags"))).union(run(low, "replace"))


@query("tags_remove", "v_projects", "SELECT project_id, substr(tags, 11) AS new_tags FROM v_projects WHERE tags LIKE '2024CONUS%'")
def tags_remove(t):
    return tags.tags_remove(t.search_index, "2024CONUS").select("project_id", F.array_join("new_tags", "|").alias("new_tags"))


TAG_RULES = {"context": ["year", "watershed"], "metrics": ["site", "visit", "year", "watershed"], "valley": ["site", "watershed"]}
_FACTS = """facts AS (SELECT p.project_id, p.project_type_id, p.tags,
    max(CASE WHEN key = 'Watershed' THEN CASE value WHEN 'JohnDay' THEN 'John Day' WHEN 'SouthForkSalmon' THEN 'South Fork Salmon' WHEN 'YankeeFork' THEN 'Yankee Fork' ELSE value END END) AS watershed,
    coalesce(max(CASE WHEN key = 'Site' THEN value END), max(CASE WHEN key = 'SiteName' THEN value END)) AS site,
    nullif(coalesce(max(CASE WHEN key = 'Year' THEN value END), max(CASE WHEN key = 'FieldSeason' THEN value END)), '0') AS year,
    nullif(coalesce(max(CASE WHEN key = 'Visit' THEN value END), max(CASE WHEN key = 'VisitNumber' THEN value END), max(CASE WHEN key = 'VisitID' THEN value END)), '0') AS visit
  FROM v_projects p LEFT JOIN v_meta_last m USING (project_id) WHERE project_type_id <> 'riparian' GROUP BY 1, 2, 3),
  lacking AS (SELECT *, concat_ws('|', CASE WHEN watershed IS NULL THEN 'watershed' END, CASE WHEN project_type_id IN ('metrics', 'valley') AND site IS NULL THEN 'site' END,
    CASE WHEN project_type_id IN ('context', 'metrics') AND year IS NULL THEN 'year' END, CASE WHEN project_type_id = 'metrics' AND visit IS NULL THEN 'visit' END) AS missing FROM facts)"""


@query("required_meta_check", "v_projects v_meta_last", f"WITH {_FACTS} SELECT project_id, project_type_id, missing FROM lacking WHERE missing <> ''")
def required_meta_check(t):
    checked = tags.required_meta(t.search_index, TAG_RULES)
    return checked.filter(F.size("missing") > 0).select("project_id", "project_type_id", F.array_join("missing", "|").alias("missing"))


@query(
    "tags_canonical",
    "v_projects v_meta_last",
    f"""WITH {_FACTS} SELECT project_id, concat_ws('|', tags, 'CHAMP_Watershed_' || replace(replace(replace(watershed, ' ', '_'), '(', ''), ')', ''),
      CASE WHEN project_type_id IN ('metrics', 'valley') THEN 'CHAMP_Site_' || replace(site, ' ', '_') END, CASE WHEN project_type_id IN ('context', 'metrics') THEN 'CHAMP_Year_' || year END,
      CASE WHEN project_type_id = 'metrics' THEN 'CHAMP_Visit_' || CASE WHEN length(visit) < 4 THEN lpad(visit, 4, '0') ELSE visit END END) AS new_tags,
      1 AS added_watershed, CAST(project_type_id IN ('metrics', 'valley') AS INTEGER) AS added_site, CAST(project_type_id IN ('context', 'metrics') AS INTEGER) AS added_year,
      CAST(project_type_id = 'metrics' AS INTEGER) AS added_visit, true AS changed FROM lacking WHERE missing = ''""",
)
def tags_canonical(t):
    out = tags.tags_canonical(t.search_index, TAG_RULES)
    return out.select("project_id", F.array_join("new_tags", "|").alias("new_tags"), "added_watershed", "added_site", "added_year", "added_visit", "changed")


def _attributed(t):
    """Projects with zero to three attributions, some without an organisation."""
    k = F.col("project_id").cast("bigint")
    entry = lambda org, *roles: F.struct(org.cast("string").alias("organizationId"), F.array(*[F.lit(r) for r in roles]).alias("roles"))
    listed = F.array(
        F.when(k % 2 == 0, entry(F.concat(F.lit("org"), (k % 3).cast("string")), "OWNER")),
        F.when(k % 3 == 0, entry(F.when(k % 5 == 0, None).otherwise(F.lit("org1")), "ANALYST", "DESIGNER")),
        F.when(k % 4 == 0, entry(F.lit("org2"), "FUNDER")),
    )
    return t.projects.select("project_id", F.array_compact(listed).alias("attribution"))


_ATTR = """a AS (SELECT project_id, CAST(project_id AS BIGINT) AS k FROM v_projects),
  e AS (SELECT project_id, 1 AS pos, 'org' || (k % 3) AS org, 'OWNER' AS roles FROM a WHERE k % 2 = 0
    UNION ALL SELECT project_id, 2, 'org1', 'ANALYST+DESIGNER' FROM a WHERE k % 3 = 0 AND k % 5 <> 0 UNION ALL SELECT project_id, 3, 'org2', 'FUNDER' FROM a WHERE k % 4 = 0),
  cur AS (SELECT a.project_id, coalesce(string_agg(org || ':' || roles, '|' ORDER BY pos), '') AS old, min(pos) FILTER (org = 'org1') AS at FROM a LEFT JOIN e USING (project_id) GROUP BY 1),
  added AS (SELECT c.project_id, c.old, CASE WHEN c.at IS NULL THEN (CASE WHEN c.old = '' THEN '' ELSE c.old || '|' END) || 'org1:ANALYST+DESIGNER'
     ELSE (SELECT string_agg(org || ':' || CASE WHEN pos = c.at AND roles = 'OWNER' THEN 'ANALYST+DESIGNER+OWNER' ELSE roles END, '|' ORDER BY pos) FROM e WHERE e.project_id = c.project_id) END AS new FROM cur c),
  removed AS (SELECT c.project_id, c.old, coalesce((SELECT string_agg(org || ':' || roles, '|' ORDER BY pos) FROM e WHERE e.project_id = c.project_id AND org <> 'org1'), '') AS new FROM cur c)"""


@query(
    "attribution_resolve",
    "v_projects",
    f"""WITH {_ATTR} SELECT project_id, 'ADD' AS mode, new AS attribution FROM added WHERE new <> old UNION ALL SELECT project_id, 'REMOVE', new FROM removed WHERE new <> old
    UNION ALL SELECT project_id, 'REPLACE', 'org1:ANALYST+DESIGNER' FROM cur WHERE old <> 'org1:ANALYST+DESIGNER'""",
)
def attribution_resolve(t):
    given = _attributed(t)
    shown = F.array_join(F.transform("new_attribution", lambda x: F.concat(x["organizationId"], F.lit(":"), F.array_join(F.array_sort(x["roles"]), "+"))), "|")
    parts = [tags.attribution_resolve(given, "org1", ["DESIGNER", "ANALYST"], mode).select("project_id", F.lit(mode).alias("mode"), shown.alias("attribution")) for mode in ("ADD", "REMOVE", "REPLACE")]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "set_field_changes",
    "v_projects",
    "SELECT project_id, visibility AS old_value, 'PUBLIC' AS new_value FROM v_projects WHERE visibility <> 'PUBLIC' UNION ALL SELECT project_id, owner_id, '3' FROM v_projects WHERE owner_id <> '3'",
)
def set_field_changes(t):
    show = lambda df, c: df.select("project_id", F.col(c).alias("old_value"), "new_value")
    return show(tags.field_changes(t.projects, "visibility", "PUBLIC"), "visibility").union(show(tags.field_changes(t.projects, "owner_id", "3"), "owner_id"))


# --- quality ----------------------------------------------------------------------------------


@query("content_hash", sql="SELECT count(*) AS rows_a, count(*) - 1 AS rows_b, false AS equal FROM lineitem UNION ALL SELECT count(*), count(*), true FROM lineitem")
def content_hash(t):
    lines = t.raw("lineitem")
    shuffled = lines.select(*reversed(lines.columns)).hint("rebalance", "l_shipdate")
    smallest = lines.agg(F.min(F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")).alias("r")).select("r.*")
    return quality.same_content(lines, lines.exceptAll(smallest)).unionByName(quality.same_content(lines, shuffled))


@query(
    "artifact_status",
    "v_projects",
    """WITH c AS (SELECT CAST(CAST(huc10 AS BIGINT) + CAST(owner_id AS BIGINT) * 100000000 AS VARCHAR) AS huc10, bool_or(bounds_id IS NOT NULL) AS b FROM v_projects WHERE project_type_id = 'context' AND huc10 IS NOT NULL GROUP BY 1),
    g AS (SELECT CAST(CAST(huc10 AS BIGINT) + CAST(owner_id AS BIGINT) * 100000000 AS VARCHAR) AS huc10, bool_or(bounds_id IS NOT NULL AND CAST(project_id AS BIGINT) % 3 = 0) AS b, bool_or(archived) AS m FROM v_projects WHERE project_type_id = 'metrics' AND huc10 IS NOT NULL GROUP BY 1)
    SELECT coalesce(c.huc10, g.huc10) AS huc10, CASE WHEN c.huc10 IS NULL THEN 'missing_context' WHEN g.huc10 IS NULL THEN 'missing_target' WHEN NOT c.b THEN 'no_bounds' WHEN NOT g.m THEN 'inserted_no_meta' WHEN g.b THEN 'replaced' ELSE 'inserted' END AS status
    FROM c FULL JOIN g ON c.huc10 = g.huc10""",
)
def artifact_status(t):
    k = F.col("project_id").cast("bigint")
    # a code for the projects of one owner in one watershed
    code = (F.col("huc10").cast("bigint") + F.col("owner_id").cast("bigint") * 100000000).cast("string")
    p = t.projects.withColumn("huc10", F.coalesce(code, F.lit("n/a")))
    context = p.filter(F.col("project_type_id") == "context").groupBy("huc10").agg(F.bool_or(F.col("bounds_id").isNotNull()).alias("has_bounds"), F.lit(True).alias("has_meta"))
    target = p.filter(F.col("project_type_id") == "metrics").groupBy("huc10").agg(F.bool_or(F.col("bounds_id").isNotNull() & (k % 3 == 0)).alias("has_bounds"), F.bool_or("archived").alias("has_meta"))
    return quality.artifact_status(context, target)


# --- sets -------------------------------------------------------------------------------------


@query(
    "insert_ignore",
    "v_projects",
    """WITH n AS (SELECT owner_id || '-' || (CAST(project_id AS BIGINT) % 5000) AS k, project_id, created_on FROM v_projects WHERE project_type_id <> 'context'),
    o AS (SELECT owner_id || '-' || (CAST(project_id AS BIGINT) % 5000) AS k FROM v_projects WHERE project_type_id = 'context')
    SELECT k, min(project_id) AS project_id, arg_min(created_on, project_id) AS created_on FROM n WHERE k NOT IN (SELECT k FROM o) GROUP BY k""",
)
def insert_ignore(t):
    key = F.concat_ws("-", "owner_id", (F.col("project_id").cast("bigint") % 5000).cast("string"))
    keyed = t.projects.select(key.alias("k"), "project_id", "created_on", "project_type_id")
    old, new = keyed.filter("project_type_id = 'context'"), keyed.filter("project_type_id <> 'context'")
    return sets.insert_ignore(old.select("k"), new.select("k", "project_id", "created_on"), ["k"], order="project_id")


