"""Project catalogue queries: normalise, index, search, filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.functions import columns as C
from headwater.operators import projects as P
from headwater.plans.registry import query
from headwater.plans.reporting import rounded



@query(
    "normalize_projects",
    "v_projects v_meta",
    r"""WITH norm AS (SELECT project_id, replace(replace(replace(lower(key), ' ', ''), '-', ''), '_', '') AS k, arg_max(value, pos) AS v FROM v_meta GROUP BY 1, 2),
    hucs AS (SELECT project_id, v AS huc FROM norm WHERE k = 'huc'),
    vers AS (SELECT project_id, regexp_replace(v, '\b0+([0-9])', '\1', 'g') AS ver FROM norm WHERE k = 'modelversion'),
    parsed AS (SELECT project_id, ver, regexp_matches(ver, '^[0-9]+[.][0-9]+[.][0-9]+(-.*)?$') AS ok, string_split(string_split(ver, '-')[1], '.') AS parts FROM vers),
    sizes AS (SELECT project_id, count(*) AS meta_keys FROM norm GROUP BY project_id)
    SELECT p.project_id, p.name, strftime(epoch_ms(p.created_on), '%Y-%m-%d %H:%M:%S') AS created_at, strftime(epoch_ms(p.updated_on), '%Y-%m-%d %H:%M:%S') AS updated_at,
      p.archived, p.owner_id, p.owner_name, p.owner_type, p.project_type_id, p.total_size, p.bounds_id, h.huc, d.ver AS model_version,
      CASE WHEN d.ok THEN CAST(d.parts[1] AS INTEGER) END AS major, CASE WHEN d.ok THEN CAST(d.parts[2] AS INTEGER) END AS minor,
      CASE WHEN d.ok THEN CAST(d.parts[3] AS INTEGER) END AS patch,
      CASE WHEN d.ok THEN CAST(d.parts[1] AS BIGINT) * 1000000 + CAST(d.parts[2] AS BIGINT) * 1000 + CAST(d.parts[3] AS BIGINT) END AS model_version_int,
      coalesce(s.meta_keys, 0) AS meta_keys
    FROM v_projects p LEFT JOIN hucs h ON p.project_id = h.project_id LEFT JOIN parsed d ON p.project_id = d.project_id LEFT JOIN sizes s ON p.project_id = s.project_id""",
)
def normalize_projects(t):
    out = P.normalize_projects(t.docs)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return out.select(
        "project_id", "name", text("created_at"), text("updated_at"), "archived", "owner_id", "owner_name", "owner_type", "project_type_id",
        "total_size", "bounds_id", "huc", "model_version", "major", "minor", "patch", "model_version_int", F.size("meta_normal").cast("bigint").alias("meta_keys"),
    )


_INDEX_SQL = r"""
WITH picked AS (SELECT project_id,
    coalesce(max(CASE WHEN key = 'HUC10' THEN value END), max(CASE WHEN key = 'huc10' THEN value END), max(CASE WHEN key = 'HUC' THEN value END), max(CASE WHEN key = 'huc' THEN value END)) AS huc10,
    coalesce(max(CASE WHEN key = 'modelVersion' THEN value END), max(CASE WHEN key = 'model_version' THEN value END), max(CASE WHEN key = 'Model Version' THEN value END)) AS model_version
  FROM v_meta_last GROUP BY project_id)
SELECT p.project_id, replace(p.name, ',', ' ') AS name, p.tags, k.huc10, k.model_version, p.archived, p.created_on,
  strftime(epoch_ms(p.created_on), '%Y-%m-%d %H:%M:%S') AS created_on_date, p.owner_id AS owned_by_id, replace(p.owner_name, ',', '') AS owned_by_name,
  p.owner_type AS owned_by_type, p.project_type_id, v.model_version_int
FROM v_projects p JOIN picked k ON p.project_id = k.project_id JOIN v_version_int v ON p.project_id = v.project_id
WHERE k.huc10 IS NOT NULL AND k.model_version IS NOT NULL"""


@query("index_projects", "v_projects v_meta_last v_version_int", _INDEX_SQL)
def index_projects(t):
    return P.index_projects(t.docs)


@query("project_meta_long", "v_meta_last", "SELECT project_id, key, value FROM v_meta_last")
def project_meta_long(t):
    return P.project_meta_long(P.normalize_projects(t.docs))


@query(
    "meta_first_key",
    "v_projects v_meta_last v_meta",
    """WITH scan AS (SELECT project_id, arg_min(value, pos) AS v FROM v_meta WHERE key IN ('HUC', 'Hydrologic Unit Code', 'HUV') GROUP BY project_id),
    w AS (SELECT project_id, max(CASE WHEN key = 'HUV' THEN value END) AS a, max(CASE WHEN key = 'HUC10' THEN value END) AS b, max(CASE WHEN key = 'HUC' THEN value END) AS c FROM v_meta_last GROUP BY project_id)
    SELECT p.project_id, coalesce(a, b, c) AS ordered, coalesce(CASE WHEN length(a) = 10 THEN a END, CASE WHEN length(b) = 10 THEN b END, CASE WHEN length(c) = 10 THEN c END) AS with_length,
      s.v AS scanned, nullif(regexp_replace(s.v, '[^0-9]', '', 'g'), '') AS digits
    FROM v_projects p LEFT JOIN w ON p.project_id = w.project_id LEFT JOIN scan s ON p.project_id = s.project_id""",
)
def meta_first_key(t):
    keys = ["HUV", "HUC10", "HUC"]
    out = P.meta_first(P.meta_first(t.meta_array, keys, name="ordered"), keys, 10, "with_length")
    meta = F.col("meta")
    return out.select("project_id", "ordered", "with_length", C.huc_of(meta, "scan").alias("scanned"), C.huc_of(meta, "digits").alias("digits"))


@query(
    "meta_extract",
    "v_meta_last v_tags",
    """SELECT m.project_id, max(CASE WHEN key = 'Watershed' THEN value END) AS watershed, max(CASE WHEN key = 'Visit' THEN value END) AS visit, max(CASE WHEN key = 'Site' THEN value END) AS site
    FROM v_meta_last m WHERE m.project_id IN (SELECT project_id FROM v_tags WHERE tag = '2024CONUS') GROUP BY m.project_id
    HAVING max(CASE WHEN key = 'Visit' THEN value END) IS NOT NULL""",
)
def meta_extract(t):
    return P.meta_extract(t.search_index, {"Watershed": "watershed", "Visit": "visit", "Site": "site"}, "Visit", tag="2024CONUS")


SEARCH_NOW = 946684800000  # 2000-01-01
SEARCH = {
    "projectTypeId": "METRICS",
    "tags": ["2025CONUS"],
    "meta": {"Watershed": "JohnDay"},
    "createdOn": {"from": "1996-01-01", "to": "2000-12-31"},
    "updatedOn": {"from": "1996-02-01"},
    "bbox": [-120.0, 26.0, -70.0, 47.0],
    "visibility": "PUBLIC",
    "name": "project",
    "keywords": "project johnday",
}


@query(
    "search_projects",
    "v_search v_tags v_meta_last",
    """SELECT project_id, name, project_type_id, created_on, owner_id FROM v_search s WHERE NOT archived AND lower(project_type_id) = 'metrics'
    AND EXISTS (SELECT 1 FROM v_tags t WHERE t.project_id = s.project_id AND tag = '2025CONUS')
    AND EXISTS (SELECT 1 FROM v_meta_last m WHERE m.project_id = s.project_id AND key = 'Watershed' AND value = 'JohnDay')
    AND created_on BETWEEN epoch_ms(timestamp '1996-01-01') AND epoch_ms(timestamp '2000-12-31')
    AND updated_on >= epoch_ms(timestamp '1996-02-01') AND xmin <= -70 AND xmax >= -120 AND ymin <= 47 AND ymax >= 26 AND visibility = 'PUBLIC' AND lower(name) LIKE '%project%'""",
)
def search_projects(t):
    return P.search_projects(t.search_index, SEARCH).select("project_id", "name", "project_type_id", "created_on", "owner_id")


@query(
    "search_owner",
    "v_search",
    """SELECT project_id, archived FROM v_search WHERE owner_id = '00000000-0000-0000-0000-000000000003' AND owner_type = 'USER'
    AND collection_id = '00000000-0000-0000-0000-000000000003'
    AND created_on >= epoch_ms(timestamp '2000-01-01') - 15724800000""",
)
def search_owner(t):
    zeros = "00000000-0000-0000-0000-00000000000"
    params = {
        "ownedBy": {"id": zeros + "3", "type": "USER"},
        "collection": zeros + "3",
        "excludeArchived": False,
        "createdWithin": "SIX_MONTHS",
    }
    return P.search_projects(t.search_index, params, now_ms=SEARCH_NOW).select("project_id", "archived")


@query(
    "search_sort_page",
    "v_search",
    """SELECT project_id, created_on FROM v_search WHERE NOT archived AND (created_on < 946684800000 OR (created_on = 946684800000 AND project_id > '5'))
    ORDER BY created_on DESC, project_id LIMIT 500""",
)
def search_sort_page(t):
    found = P.search_projects(t.search_index, {})
    return P.search_page(found, "DATE_CREATED_DESC", after=(946684800000, "5"), limit=500).select("project_id", "created_on")


@query(
    "search_facets",
    "v_search v_meta_last",
    """WITH hit AS (SELECT * FROM v_search WHERE NOT archived AND created_on >= epoch_ms(timestamp '1997-01-01')),
    f AS (SELECT 'total' AS facet, NULL AS key, NULL AS value, hit.* FROM hit
      UNION ALL SELECT 'type', 'project_type_id', project_type_id, hit.* FROM hit
      UNION ALL SELECT 'meta', m.key, m.value, hit.* FROM hit JOIN v_meta_last m ON hit.project_id = m.project_id)
    SELECT facet, key, value, count(*) AS n, round(min(xmin), 4) AS xmin, round(min(ymin), 4) AS ymin, round(max(xmax), 4) AS xmax, round(max(ymax), 4) AS ymax,
      round(sum((xmax - xmin) * (ymax - ymin)), 4) AS area FROM f GROUP BY 1, 2, 3""",
)
def search_facets(t):
    out = P.search_facets(t.search_index, {"createdOn": {"from": "1997-01-01"}})
    return rounded(out, 4, "xmin", "ymin", "xmax", "ymax", "area")


def _geohash_sql(precision: int) -> str:
    bits = 5 * precision
    x_bits, y_bits = (bits + 1) // 2, bits // 2
    digits = []
    for start in range(0, bits, 5):
        terms = []
        for b in range(start, start + 5):
            source, width = ("ix", x_bits) if b % 2 == 0 else ("iy", y_bits)
            terms.append(f"(({source} >> {width - 1 - b // 2}) & 1) * {2 ** (4 - (b - start))}")
        digits.append(f"substr('{P.GEOHASH_DIGITS}', CAST(1 + {' + '.join(terms)} AS INTEGER), 1)")
    return " || ".join(digits)


@query(
    "map_clusters",
    "v_search",
    f"""WITH g AS (SELECT CAST(floor(((xmin + xmax) / 2 + 180) / 360e0 * 256) AS BIGINT) AS ix, CAST(floor(((ymin + ymax) / 2 + 90) / 180e0 * 128) AS BIGINT) AS iy FROM v_search),
    c AS (SELECT ix, iy, {_geohash_sql(3)} AS geohash, count(*) AS n FROM g GROUP BY ix, iy),
    r AS (SELECT *, row_number() OVER (ORDER BY n DESC, geohash) AS rn FROM c)
    SELECT geohash, -180 + (ix + 0.5e0) * (360e0 / 256) AS lon, -90 + (iy + 0.5e0) * (180e0 / 128) AS lat, n FROM r WHERE rn <= 25
    UNION ALL SELECT NULL, NULL, NULL, coalesce(CAST(sum(n) AS BIGINT), 0) FROM r WHERE rn > 25""",
)
def map_clusters(t):
    return P.map_clusters(t.search_index, 3, 25)


@query("filter_doc_type", "v_projects", "SELECT project_id AS id, project_type_id AS type_id FROM v_projects WHERE project_type_id = 'context'")
def filter_doc_type(t):
    return P.filter_type(t.docs, " Context ").select("id", F.col("projectType.id").alias("type_id"))


@query("filter_missing_bounds", "v_projects", "SELECT project_id AS id, bounds_id FROM v_projects WHERE bounds_id IS NULL OR trim(bounds_id) = ''")
def filter_missing_bounds(t):
    return P.missing_bounds(t.docs).select("id", F.col("bounds.id").alias("bounds_id"))


@query("filter_regex_any", "v_manifest_new", r"SELECT local_path, etag, size FROM v_manifest_new WHERE regexp_matches(local_path, '^([0-9]+/outputs/.*\.gpkg|1[0-9]*/project\.rs\.xml)', 'i')")
def filter_regex_any(t):
    return P.match_files(t.manifest_new, [r"[0-9]+/OUTPUTS/.*\.gpkg", r"1[0-9]*/project\.rs\.xml"]).select("local_path", "etag", "size")


@query("first_matching_file", "v_manifest_new", r"SELECT huc, min(local_path) AS local_path FROM v_manifest_new WHERE regexp_matches(local_path, '^.*\.gpkg', 'i') GROUP BY huc")
def first_matching_file(t):
    return P.first_match(t.manifest_new, r".*\.gpkg")


@query(
    "manifest_diff",
    "v_manifest_old v_manifest_new",
    """SELECT coalesce(o.local_path, n.local_path) AS local_path, CASE WHEN o.local_path IS NULL THEN 'create' WHEN n.local_path IS NULL THEN 'delete'
      WHEN o.etag = n.etag THEN 'unchanged' ELSE 'update' END AS action, o.etag AS old_etag, n.etag AS new_etag, n.size AS size
    FROM (SELECT * FROM v_manifest_old WHERE local_path IS NOT NULL) o FULL JOIN (SELECT * FROM v_manifest_new WHERE local_path IS NOT NULL) n ON o.local_path = n.local_path""",
)
def manifest_diff(t):
    return P.manifest_diff(t.manifest_old, t.manifest_new)


@query(
    "huc_hierarchy",
    "v_projects",
    "SELECT project_id, huc10, substr(huc10, 1, 2) AS huc2, substr(huc10, 1, 4) AS huc4, substr(huc10, 1, 6) AS huc6, substr(huc10, 1, 8) AS huc8 FROM v_projects",
)
def huc_hierarchy(t):
    return P.with_huc_levels(t.projects.select("project_id", "huc10"))


