"""Raster cell queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.operators import raster as R
from headwater.plans.registry import query


def valid_cells(t):
    return R.mask_nodata(t.cells, t.headers)


@query("ras_mask_nodata", "v_valid", "SELECT raster_id, r, c, value FROM v_valid")
def ras_mask_nodata(t):
    return valid_cells(t)


_BINS = """b AS (SELECT raster_id, min(value) AS lo, max(value) AS hi, count(*) AS n FROM v_valid GROUP BY 1),
  e AS (SELECT raster_id, lo, hi, n, unnest(generate_series(CAST(floor(lo / 1000) AS BIGINT), CAST(ceil(hi / 1000) AS BIGINT) - 1)) AS i FROM b),
  h AS (SELECT v.raster_id, least(CAST(floor(value / 1000) AS BIGINT), CAST(ceil(b.hi / 1000) AS BIGINT) - 1) AS i, count(*) AS cell_count FROM v_valid v JOIN b ON v.raster_id = b.raster_id GROUP BY 1, 2)"""


@query(
    "ras_bin_continuous",
    "v_valid",
    f"""WITH {_BINS} SELECT e.raster_id, lo AS min, hi AS max, n AS value_count, 1000 AS bin_size, 'continuous' AS hist_type, e.i * 1000 AS bin, coalesce(cell_count, 0) AS cell_count
    FROM e LEFT JOIN h ON e.raster_id = h.raster_id AND e.i = h.i""",
)
def ras_bin_continuous(t):
    return R.bin_continuous(valid_cells(t), 1000)


def categories(t):
    return valid_cells(t).withColumn("value", F.col("value") % 97)


_CATS = "cat AS (SELECT raster_id, value % 97 AS v FROM v_valid), head AS (SELECT raster_id, min(v) AS min, max(v) AS max, count(*) AS value_count FROM cat GROUP BY 1), cnt AS (SELECT raster_id, CAST(trunc(v) AS BIGINT) AS category, count(*) AS cell_count FROM cat GROUP BY 1, 2)"


@query(
    "ras_bin_categorical",
    "v_valid",
    f"""WITH {_CATS} SELECT raster_id, round(min, 4) AS min, round(max, 4) AS max, value_count, 'categorical' AS hist_type, category, cell_count FROM cnt JOIN head USING (raster_id)""",
)
def ras_bin_categorical(t):
    return R.bin_categorical(categories(t)).withColumns({"min": F.round("min", 4), "max": F.round("max", 4)})


@query(
    "ras_context_summary",
    "v_valid v_headers v_projects",
    f"""WITH {_BINS}, {_CATS}, pr AS (SELECT CAST(owner_id AS BIGINT) % 8 AS raster_id, max(project_id) AS project_id, arg_max(model_version, project_id) AS model_version FROM v_projects WHERE project_type_id = 'context' GROUP BY 1)
    SELECT hd.raster_id, 'h' || hd.raster_id AS huc, pr.project_id, pr.model_version, b.lo AS dem_min, b.n AS dem_count,
      (SELECT string_agg(e.i * 1000 || ':' || coalesce(cell_count, 0), ',' ORDER BY e.i) FROM e LEFT JOIN h ON e.raster_id = h.raster_id AND e.i = h.i WHERE e.raster_id = hd.raster_id) AS dem,
      (SELECT string_agg(category || ':' || cell_count, ',' ORDER BY category) FROM cnt WHERE cnt.raster_id = hd.raster_id) AS veg FROM v_headers hd JOIN b ON b.raster_id = hd.raster_id LEFT JOIN pr ON pr.raster_id = hd.raster_id""",
)
def ras_context_summary(t):
    p = t.projects.filter("project_type_id = 'context'").groupBy((F.col("owner_id").cast("bigint") % 8).alias("raster_id"))
    source = p.agg(F.max("project_id").alias("project_id"), F.max_by("model_version", "project_id").alias("model_version"))
    docs = t.headers.join(source, "raster_id", "left").select("project_id", "model_version", "raster_id", F.concat(F.lit("h"), F.col("raster_id").cast("string")).alias("huc"))
    out = R.context_summary(docs, R.bin_continuous(valid_cells(t), 1000), R.bin_categorical(categories(t)))
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["bin"].cast("bigint").cast("string"), x["cell_count"].cast("string"))), ",")
    return out.select("raster_id", "huc", "project_id", "model_version", F.col("dem_bins.min").alias("dem_min"), F.col("dem_bins.value_count").alias("dem_count"), shown("dem_bins.bins").alias("dem"), shown("existing_veg_bins.bins").alias("veg"))


@query(
    "ras_point_lookup",
    "v_cells",
    """WITH pts AS (SELECT c_custkey AS point_id, c_custkey % 8 AS raster_id, (c_custkey * 37 % 52000) * 1e0 - 300 AS x, (c_custkey * 53 % 52000) * 1e0 - 300 AS y FROM customer),
    k AS (SELECT *, CAST(floor(x / 100) AS BIGINT) AS c, CAST(floor((y - 51200) / -100) AS BIGINT) AS r FROM pts)
    SELECT point_id, k.raster_id, x, y, nullif(v.value, -9999) AS value FROM k LEFT JOIN v_cells v ON v.raster_id = k.raster_id AND v.r = k.r AND v.c = k.c AND k.c BETWEEN 0 AND 511 AND k.r BETWEEN 0 AND 511""",
)
def ras_point_lookup(t):
    k = F.col("c_custkey")
    points = t.raw("customer").select(
        k.alias("point_id"), (k % 8).alias("raster_id"), ((k * 37 % 52000).cast("double") - 300).alias("x"), ((k * 53 % 52000).cast("double") - 300).alias("y")
    )
    return R.sample(t.cells, t.headers.withColumn("nodata", F.lit(-9999.0)), points).select("point_id", "raster_id", "x", "y", "value")


@query(
    "ras_extent",
    "v_headers",
    """SELECT raster_id, 51200e0 AS right_x, 0e0 AS bottom_y, 51200e0 AS width, 51200e0 AS height, '0 51200,51200 51200,51200 0,0 0,0 51200' AS ring FROM v_headers""",
)
def ras_extent(t):
    out = R.extent(t.headers)
    corner = F.transform("ring", lambda p: F.concat_ws(" ", p["x"].cast("bigint").cast("string"), p["y"].cast("bigint").cast("string")))
    return out.select("raster_id", "right_x", "bottom_y", "width", "height", F.array_join(corner, ",").alias("ring"))


@query(
    "ras_mosaic",
    "v_valid",
    """SELECT raster_id % 2 AS dataset, r - 512 + raster_id // 2 * 100 AS gr, c + raster_id // 2 * 200 AS gc, arg_max(value, raster_id) AS value FROM v_valid GROUP BY 1, 2, 3""",
)
def ras_mosaic(t):
    rid = F.col("raster_id")
    step = F.floor(rid / 2)
    headers = t.headers.withColumns({"dataset": rid % 2, "priority": rid, "left_x": step * 20000.0, "top_y": F.lit(51200.0) - step * 10000.0})
    return R.mosaic(valid_cells(t), headers)


@query(
    "ras_overviews",
    "v_valid",
    """SELECT 'AVERAGE' AS how, raster_id, f AS factor, r // f AS r, c // f AS c, round(avg(value) + 1e-7, 4) AS value FROM v_valid CROSS JOIN (VALUES (2), (4)) AS x(f) GROUP BY ALL
    UNION ALL SELECT 'NEAREST', raster_id, f, r // f, c // f, value FROM v_valid CROSS JOIN (VALUES (2), (4)) AS x(f) WHERE r % f = 0 AND c % f = 0""",
)
def ras_overviews(t):
    cells = valid_cells(t)
    level = lambda how: R.overviews(cells, t.headers, 64, how).withColumn("how", F.lit(how))
    return level("AVERAGE").withColumn("value", F.round(F.col("value") + 1e-7, 4)).unionByName(level("NEAREST"))


@query(
    "ras_attr_table",
    "v_valid",
    f"""WITH {_CATS} SELECT cnt.raster_id, cnt.category, cnt.cell_count, CAST(c.c_acctbal AS DOUBLE) AS weight, c.c_mktsegment AS label, c.c_nationkey AS code FROM cnt LEFT JOIN customer c ON c.c_custkey = cnt.category * 2""",
)
def ras_attr_table(t):
    rat = t.raw("customer").filter("c_custkey % 2 = 0").select(
        F.floor(F.col("c_custkey") / 2).cast("string").alias("VALUE"), F.col("c_acctbal").cast("string").alias("weight"), F.col("c_mktsegment").alias("label"), F.col("c_nationkey").cast("string").alias("code")
    )
    binned = R.bin_categorical(categories(t)).select("raster_id", "category", "cell_count")
    return R.attr_join(binned, rat, {"weight": "REAL", "label": "STRING", "code": "INTEGER"})
