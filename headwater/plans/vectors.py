"""Polygon layer queries on the grid squares."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.operators import segments
from headwater.operators import vector as V
from headwater.plans.bindings import SIDES
from headwater.plans.registry import query
from headwater.plans.reporting import rounded


def squares(t, layer=None):
    """The boxes as polygons, dealt over the tasks: the table may be one row group, and geometry work is by the row."""
    box = V.box_polygon(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    return (t.boxes if layer is None else layer).repartition("feature_id").select("feature_id", "dissolve_key", "gx", "gy", box.alias("geom"))


def uneven(t):
    """The tiles, a third of them as two halves, so that corners lie on the sides of neighbours."""
    halved = F.col("feature_id") % 3 == 0
    middle = (F.col("ymin") + F.col("ymax")) / 2
    halves = F.when(halved, F.array(F.struct(F.col("ymin").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("ymax").alias("b"))))
    rows = t.tiles.withColumn("half", F.explode(F.coalesce(halves, F.array(F.struct(F.col("ymin").alias("a"), F.col("ymax").alias("b"))))))
    return squares(t, rows.withColumns({"ymin": F.col("half.a"), "ymax": F.col("half.b")}))


def near_squares(t):
    """The squares with a tenth of them empty, broken or missing."""
    k = F.col("feature_id")
    broken = F.when(k % 50 == 0, None).when(k % 50 == 1, F.unhex(F.lit("010300000000000000"))).when(k % 50 == 2, F.substring(F.col("geom"), 1, 40)).otherwise(F.col("geom"))
    return squares(t).withColumn("geom", broken)


@query(
    "vec_measures",
    "v_boxes",
    """SELECT feature_id, 'Polygon' AS geometry_type, xmin, ymin, xmax, ymax, 10000e0 AS area, xmin + 50 AS centroid_x, ymin + 50 AS centroid_y FROM v_boxes""",
)
def vec_measures(t):
    out = V.layer_measures(squares(t))
    return out.select("feature_id", "geometry_type", "bbox.*", F.round("area", 6).alias("area"), F.round("centroid_x", 6).alias("centroid_x"), F.round("centroid_y", 6).alias("centroid_y"))


@query(
    "vec_measures_by",
    "v_boxes",
    """SELECT dissolve_key, count(*) AS n_features, count(*) * 10000e0 AS area, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax,
      round(avg(xmin + 50), 4) AS centroid_x, round(avg(ymin + 50), 4) AS centroid_y FROM v_boxes GROUP BY 1""",
)
def vec_measures_by(t):
    return rounded(V.measures_by(squares(t), ["dissolve_key"]), 4, "area", "centroid_x", "centroid_y")


@query(
    "geometry_profile",
    "v_boxes",
    """SELECT count(*) AS n_rows, count(*) FILTER (feature_id % 50 = 0) AS n_null, count(*) FILTER (feature_id % 50 = 1) AS n_empty, count(*) FILTER (feature_id % 50 = 2) AS n_invalid,
      min(xmin) FILTER (feature_id % 50 > 2) AS xmin, min(ymin) FILTER (feature_id % 50 > 2) AS ymin, max(xmax) FILTER (feature_id % 50 > 2) AS xmax, max(ymax) FILTER (feature_id % 50 > 2) AS ymax,
      false AS non_finite, false AS zero_area FROM v_boxes""",
)
def geometry_profile(t):
    return V.geometry_profile(near_squares(t))


@query("geometry_invalid", "v_boxes", "SELECT feature_id, 'unreadable' AS flaw FROM v_boxes WHERE feature_id % 50 = 2 ORDER BY feature_id LIMIT 5")
def geometry_invalid(t):
    return V.invalid_geometries(near_squares(t), "feature_id")


# Albers forward for one corner, written out: e is the eccentricity, q the authalic function
_ALBERS = """
WITH k AS (SELECT 6378137e0 AS a, 1 / 298.257222101e0 AS f),
el AS (SELECT a, f * (2 - f) AS e2, sqrt(f * (2 - f)) AS e FROM k),
par AS (SELECT a, e2, e, radians(29.5e0) AS p1, radians(45.5e0) AS p2, radians(23e0) AS p0 FROM el),
con AS (SELECT a, e2, e,
    (1 - e2) * (sin(p1) / (1 - e2 * sin(p1) ** 2) - ln((1 - e * sin(p1)) / (1 + e * sin(p1))) / (2 * e)) AS q1,
    (1 - e2) * (sin(p2) / (1 - e2 * sin(p2) ** 2) - ln((1 - e * sin(p2)) / (1 + e * sin(p2))) / (2 * e)) AS q2,
    (1 - e2) * (sin(p0) / (1 - e2 * sin(p0) ** 2) - ln((1 - e * sin(p0)) / (1 + e * sin(p0))) / (2 * e)) AS q0,
    cos(p1) ** 2 / (1 - e2 * sin(p1) ** 2) AS m1, cos(p2) ** 2 / (1 - e2 * sin(p2) ** 2) AS m2 FROM par),
cone AS (SELECT *, (m1 - m2) / (q2 - q1) AS n, m1 + (m1 - m2) / (q2 - q1) * q1 AS c FROM con),
corners AS (SELECT c_custkey AS feature_id, -125 + (c_custkey % 600) * 0.1e0 + dx AS lon, 25 + (c_custkey % 240) * 0.1e0 + dy AS lat
    FROM customer CROSS JOIN (VALUES (0e0, 0e0), (0.05e0, 0e0), (0.05e0, 0.05e0), (0e0, 0.05e0)) AS d(dx, dy)),
polar AS (SELECT feature_id, a, n, c, q0, n * radians(lon + 96) AS theta,
    (1 - e2) * (sin(radians(lat)) / (1 - e2 * sin(radians(lat)) ** 2) - ln((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat)))) / (2 * e)) AS q FROM corners, cone),
xy AS (SELECT feature_id, a * sqrt(c - n * q) / n * sin(theta) AS x, a * sqrt(c - n * q0) / n - a * sqrt(c - n * q) / n * cos(theta) AS y FROM polar)
SELECT feature_id, round(min(x) + 1e-6, 3) AS xmin, round(min(y) + 1e-6, 3) AS ymin, round(max(x) + 1e-6, 3) AS xmax, round(max(y) + 1e-6, 3) AS ymax, true AS comes_back FROM xy GROUP BY feature_id"""


@query("vec_reproject", sql=_ALBERS)
def vec_reproject(t):
    """Small geographic boxes as Albers polygons, and whether they come back within 1e-9 degrees."""
    k = F.col("c_custkey")
    lon, lat = -125 + (k % 600) * 0.1, 25 + (k % 240) * 0.1
    boxes = t.raw("customer").repartition("c_custkey").select(k.alias("feature_id"), lon.alias("lon"), lat.alias("lat"), V.box_polygon(lon, lat, lon + 0.05, lat + 0.05).alias("geom"))
    there = V.layer_measures(V.reproject_layer(boxes, 4326, 5070)).withColumnRenamed("bbox", "there")
    back = V.layer_measures(V.reproject_layer(there.select("feature_id", "lon", "lat", "there", "geom"), 5070, 4326))
    comes_back = (F.abs(F.col("bbox.xmin") - F.col("lon")) < 1e-9) & (F.abs(F.col("bbox.ymin") - F.col("lat")) < 1e-9)
    sides = [F.round(F.col(f"there.{c}") + 1e-6, 3).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]
    return back.select("feature_id", *sides, comes_back.alias("comes_back"))


#: Parts are the squares of one key that sides connect; of a part, squares + corners - sides count 1 less its holes.
_PARTS = """WITH RECURSIVE near AS (SELECT a.feature_id AS u, b.feature_id AS v FROM v_tiles a JOIN v_tiles b ON a.dissolve_key = b.dissolve_key AND abs(a.gx - b.gx) + abs(a.gy - b.gy) <= 1),
reach(u, v) AS (SELECT u, v FROM near UNION SELECT r.u, n.v FROM reach r JOIN near n ON r.v = n.u),
part AS (SELECT t.*, p.part FROM v_tiles t JOIN (SELECT u, min(v) AS part FROM reach GROUP BY u) p ON p.u = t.feature_id),
corners AS (SELECT part, count(*) AS n FROM (SELECT DISTINCT part, gx + dx AS x, gy + dy AS y FROM part, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS d(dx, dy)) GROUP BY 1),
sides AS (SELECT part, count(*) AS n, count(*) FILTER (times = 1) AS outer_sides FROM (SELECT part, x, y, d, count(*) AS times FROM (SELECT part, gx AS x, gy AS y, 'h' AS d FROM part UNION ALL SELECT part, gx, gy + 1, 'h' FROM part
      UNION ALL SELECT part, gx, gy, 'v' FROM part UNION ALL SELECT part, gx + 1, gy, 'v' FROM part) GROUP BY ALL) GROUP BY 1),
parts AS (SELECT dissolve_key, part, count(*) AS squares, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM part GROUP BY 1, 2)"""


@query(
    "vec_dissolve",
    "v_tiles",
    f"""{_PARTS} SELECT dissolve_key, count(*) OVER (PARTITION BY dissolve_key) AS part_count, CAST(1 - (squares + corners.n - sides.n) AS INTEGER) AS hole_count, squares * 10000e0 AS area, outer_sides * 100e0 AS perimeter,
      xmin, ymin, xmax, ymax, false AS overlap FROM parts JOIN corners USING (part) JOIN sides USING (part)""",
)
def vec_dissolve(t):
    parts = V.dissolve(uneven(t), ["dissolve_key"])
    # what the geometry itself has, not what dissolve says of it
    edges = V.explode_edges(parts.withColumn("part", F.xxhash64("geom")), ["part"])
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    around = edges.groupBy("part").agg(F.round(F.sum(length), 4).alias("perimeter"))
    measured = V.layer_measures(parts.drop("area").withColumn("part", F.xxhash64("geom"))).join(around, "part")
    return measured.select("dissolve_key", "part_count", "hole_count", F.round("area", 4).alias("area"), "perimeter", "bbox.*", "overlap")


@query(
    "vec_outline_edges",
    "v_tiles",
    """WITH e AS (SELECT dissolve_key, gx AS a, gy AS b, 'h' AS side FROM v_tiles UNION ALL SELECT dissolve_key, gx, gy + 1, 'h' FROM v_tiles
      UNION ALL SELECT dissolve_key, gx, gy, 'v' FROM v_tiles UNION ALL SELECT dissolve_key, gx + 1, gy, 'v' FROM v_tiles),
    o AS (SELECT dissolve_key, a, b, side FROM e GROUP BY ALL HAVING count(*) = 1) SELECT dissolve_key, count(*) AS n_edges, count(*) * 100e0 AS perimeter FROM o GROUP BY 1""",
)
def vec_outline_edges(t):
    a, b = F.col("a"), F.col("b")
    length = F.abs(b["x"] - a["x"]) + F.abs(b["y"] - a["y"])
    return V.outline_edges(squares(t, t.tiles), ["dissolve_key"]).groupBy("dissolve_key").agg(F.count(F.lit(1)).alias("n_edges"), F.sum(length).alias("perimeter"))


@query(
    "vec_simplify_coverage",
    "v_boxes",
    "SELECT feature_id, 10000e0 AS area, 10000e0 AS simplified_area FROM v_boxes",
)
def vec_simplify_coverage(t):
    """Squares have no vertex to lose at this tolerance, so areas stay; other shapes are in the tests."""
    out = V.simplify_coverage(squares(t), "feature_id", 11.0, ["dissolve_key"])
    area = lambda df, g, name: V.layer_measures(df, g).withColumn(name, F.round("area", 4)).drop("geometry_type", "bbox", "centroid_x", "centroid_y")
    both = area(area(out, "geom", "before"), "geom_simplified", "simplified_area")
    return both.select("feature_id", F.col("before").alias("area"), "simplified_area")


@query(
    "vec_bounds_rollup",
    "v_tiles",
    """SELECT dissolve_key, count(*) * 10000e0 AS area, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, round(avg(xmin + 50), 4) AS centroid_x, round(avg(ymin + 50), 4) AS centroid_y FROM v_tiles GROUP BY 1""",
)
def vec_bounds_rollup(t):
    out = V.bounds_rollup(squares(t, t.tiles), ["dissolve_key"])
    totals = ["xmin", "ymin", "xmax", "ymax", "centroid_x", "centroid_y"]
    return rounded(out.groupBy("dissolve_key", *totals).agg(F.sum("area").alias("area")), 4, "area", "centroid_x", "centroid_y")


@query(
    "rme_wide_dissolved",
    f"v_tiles {' '.join(f'v_dgo_{s}' for s in SIDES)}",
    f"""WITH g AS (SELECT gx // 2 AS level_path, gy // 2 AS seg_distance, count(*) AS n, count(*) FILTER ((gx + gy) % 2 = 0) AS diag, min(feature_id) AS dgoid, arg_min(dissolve_key, feature_id) AS fcode FROM v_tiles GROUP BY 1, 2)
    SELECT level_path, seg_distance, dgoid, fcode, level_path * 200e0 + 100 AS longitude, seg_distance * 200e0 + 100 AS latitude, n * 10000e0 AS area, '1.2.3' AS rme_version,
      n_obs, strftime(first_obs, '%Y-%m-%d') AS first_obs, width_sum, veg_max, flow_min, impact_max, dam_min
    FROM g {' '.join(f'JOIN v_dgo_{s} USING (dgoid)' for s in SIDES)} WHERE NOT (n = 2 AND diag IN (0, 2))""",
)
def rme_wide_dissolved(t):
    """Two by two blocks of squares as segments of one place; blocks left with two diagonal squares are multi-part."""
    half = lambda c: F.floor(F.col(c) / 2).cast("bigint")
    dgos = uneven(t).select(F.col("feature_id").alias("dgoid"), half("gx").alias("level_path"), half("gy").alias("seg_distance"), F.col("dissolve_key").alias("fcode"), "geom")
    places = t.tiles.select(half("gx").alias("level_path"), half("gy").alias("seg_distance")).distinct()
    igos = places.withColumn("geom", V.point(F.col("level_path") * 200.0 + 100, F.col("seg_distance") * 200.0 + 100))
    wide = segments.rme_wide_dissolved(dgos, [t.side(s) for s in SIDES], igos, {"rme_version": F.lit("1.2.3")})
    # the area is that of the text
    pairs = F.expr(r"transform(split(regexp_extract(dgo_geom, '[(][(](.*)[)][)]', 1), ', '), p -> transform(split(p, ' '), x -> CAST(x AS DOUBLE)))")
    shoelace = F.expr("aggregate(sequence(1, size(ps) - 1), 0e0, (s, i) -> s + ps[i - 1][0] * ps[i][1] - ps[i][0] * ps[i - 1][1])")
    wide = wide.withColumn("ps", pairs).withColumn("area", F.round(shoelace / 2, 4)).drop("ps", "dgo_geom")
    return wide.withColumn("first_obs", F.date_format("first_obs", "yyyy-MM-dd"))


@query(
    "ras_zone_mask",
    "v_cells v_boxes",
    """SELECT c.raster_id, c.r, c.c, c.value, b.feature_id, b.dissolve_key FROM v_cells c JOIN v_boxes b ON c.raster_id = b.feature_id % 8
    AND b.xmin < c.c * 100e0 + 100 AND b.xmax > c.c * 100e0 AND b.ymin < 51200 - c.r * 100e0 AND b.ymax > 51100 - c.r * 100e0""",
)
def ras_zone_mask(t):
    zones = squares(t).withColumn("raster_id", F.col("feature_id") % 8)
    return V.zone_mask(t.cells, zones, t.headers, "feature_id", "dissolve_key")


@query(
    "vec_export",
    "v_boxes",
    """SELECT dissolve_key, count(*) AS n_features, min(xmin) AS xmin, max(ymax) AS ymax, 'POLYGON' AS first_kind FROM v_boxes GROUP BY 1""",
)
def vec_export(t):
    parts = V.feature_collections(squares(t), "dissolve_key", "feature_id", chunk=100)
    box = F.from_json("document", "struct<bbox:array<double>,features:array<struct<geometry:struct<type:string>>>>")
    read = parts.withColumn("d", box)
    out = read.groupBy("dissolve_key").agg(F.sum(F.size("d.features")).alias("n_features"), F.min(F.col("d.bbox")[0]).alias("xmin"), F.max(F.col("d.bbox")[3]).alias("ymax"))
    first = V.wkt_table(squares(t)).groupBy("dissolve_key").agg(F.min(F.regexp_extract("geom", "^([A-Z]+)", 1)).alias("first_kind"))
    return out.join(first, "dissolve_key")


