"""Streaming and incremental queries over the whole event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.functions.columns import to_ms
from headwater.operators.vector import layer_measures
from headwater.plans.files import _SQUARE_HUC, geopackages
from headwater.plans.registry import query
from headwater.session import scratch_dir
from headwater.sources import gpkg
from headwater.streaming import feeds
from headwater.streaming.incremental import Paths, load_segments, read_or_empty, run_incremental
from headwater.streaming.incremental import query as run_sql

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(t):
    stream = feeds.project_stream(t.spark, t.sf_dir, EVENTS, pattern="events.parquet")
    return stream.select(
        F.col("event_id").alias("project_id"), F.col("ts").cast("timestamp").alias("ts"), to_ms(F.col("ts")).alias("created_on"),
        F.col("user_id").alias("owner_id"), F.col("event_type").alias("project_type_id"),
    )


@query(
    "stream_index_projects",
    "v_feed",
    "SELECT owner_id || '-' || project_type_id AS k, min(project_id) AS project_id, arg_min(created_on, project_id) AS created_on FROM v_feed GROUP BY 1",
)
def stream_index_projects(t):
    target = scratch_dir(t.spark, "index")
    rows = lambda df: df.select(F.concat_ws("-", F.col("owner_id").cast("string"), "project_type_id").alias("k"), "project_id", "created_on")
    feeds.stream_index(event_stream(t), target, scratch_dir(t.spark, "checkpoint"), rows, "k", "project_id").awaitTermination()
    return t.spark.read.schema("k string, project_id bigint, created_on bigint").parquet(target).select("k", "project_id", "created_on")


@query("stream_dedup", "v_feed", "SELECT project_id, owner_id, created_on FROM v_feed")
def stream_dedup(t):
    target = scratch_dir(t.spark, "dedup")
    twice = event_stream(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    feeds.to_parquet(feeds.stream_dedup(twice).select("project_id", "owner_id", "created_on"), target, scratch_dir(t.spark, "checkpoint")).awaitTermination()
    return t.spark.read.schema("project_id bigint, owner_id bigint, created_on bigint").parquet(target)


@query(
    "stream_daily_counts",
    "v_feed",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, project_type_id, count(*) AS n FROM v_feed
    WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM v_feed) GROUP BY 1, 2""",
)
def stream_daily_counts(t):
    target = scratch_dir(t.spark, "daily")
    feeds.to_parquet(feeds.stream_daily(event_stream(t)), target, scratch_dir(t.spark, "checkpoint")).awaitTermination()
    daily = t.spark.read.schema("day_start timestamp, project_type_id string, n bigint").parquet(target)
    return daily.select(F.date_format("day_start", "yyyy-MM-dd").alias("day"), "project_type_id", "n")


def incremental(t, paths: Paths) -> dict[str, int]:
    catalogue = t.projects.filter("project_type_id = 'metrics' AND huc10 IS NOT NULL").select("project_id", F.col("huc10").alias("huc"), "created_on")
    inputs = t.dgos.withColumnRenamed("huc10", "huc")
    checks = {"no length": F.col("centerline_length") > 0, "bad level path": F.col("level_path") != "Brand#3"}
    return run_incremental(catalogue, inputs, checks, lambda df: df.select("huc", "project_id", "dgoid", "segment_area"), paths)


@query(
    "incremental_driver",
    "v_projects v_dgos",
    """WITH c AS (SELECT huc10, arg_max(project_id, created_on // 86400000 * 10000000 + rk) AS project_id FROM (SELECT *, row_number() OVER (ORDER BY project_id) AS rk FROM v_projects WHERE project_type_id = 'metrics' AND huc10 IS NOT NULL) GROUP BY 1),
    bad AS (SELECT DISTINCT huc10 FROM v_dgos WHERE level_path = 'Brand#3')
    SELECT c.huc10 AS huc, c.project_id, CASE WHEN d.huc10 IS NULL THEN 'no input' WHEN bad.huc10 IS NOT NULL THEN 'bad level path' ELSE 'loaded' END AS status, coalesce(CASE WHEN bad.huc10 IS NULL THEN d.n END, 0) AS n
    FROM c LEFT JOIN (SELECT huc10, count(*) AS n FROM v_dgos GROUP BY 1) d ON c.huc10 = d.huc10 LEFT JOIN bad ON c.huc10 = bad.huc10""",
)
def incremental_driver(t):
    root = scratch_dir(t.spark, "incremental")
    paths = Paths(f"{root}/data", f"{root}/ledger", f"{root}/rejects")
    incremental(t, paths)
    loaded = read_or_empty(t.spark, paths.data, "project_id string, dgoid bigint, segment_area double, huc string")
    good = loaded.groupBy("huc", "project_id").agg(F.lit("loaded").alias("status"), F.count(F.lit(1)).alias("n"))
    bad = t.spark.read.parquet(paths.rejects).select("huc", "project_id", F.col("reason").alias("status"), F.lit(0).alias("n"))
    return good.unionByName(bad)


@query(
    "incremental_segments",
    "v_projects v_boxes",
    f"""WITH c AS (SELECT huc10, arg_max(project_id, created_on // 86400000 * 10000000 + rk) AS project_id FROM (SELECT *, row_number() OVER (ORDER BY project_id) AS rk FROM v_projects WHERE project_type_id = 'metrics' AND huc10 IS NOT NULL) GROUP BY 1),
    s AS (SELECT {_SQUARE_HUC} AS huc, count(*) AS n, CAST(sum(feature_id) AS BIGINT) AS fids, sum(gx / 4e0) AS width, min('L' || gx) AS first_path, bool_or(gx = 3) AS bad FROM v_boxes GROUP BY 1)
    SELECT c.huc10 AS huc, c.project_id, CASE WHEN s.huc IS NULL THEN 'no input' WHEN bad THEN 'third column' ELSE 'loaded' END AS status,
      coalesce(CASE WHEN NOT bad THEN n END, 0) AS n, CASE WHEN NOT bad THEN fids END AS fids, CASE WHEN NOT bad THEN width END AS width, CASE WHEN NOT bad THEN first_path END AS first_path, CASE WHEN NOT bad THEN n * 10000e0 END AS area, true AS again_nothing
    FROM c LEFT JOIN s ON s.huc = c.huc10""",
)
def incremental_segments(t):
    """The segment load over GeoPackages, run twice; rejected watersheds are tried again, loaded ones are not opened."""
    root = scratch_dir(t.spark, "segments")
    paths = Paths(f"{root}/data", f"{root}/ledger", f"{root}/rejects")
    catalogue = t.projects.filter("project_type_id = 'metrics' AND huc10 IS NOT NULL").select("project_id", F.col("huc10").alias("huc"), "created_on")
    files = gpkg.list_files(t.spark, geopackages(t))
    dictionary = [{"name": "fid", "dtype": "INTEGER"}, {"name": "WIDTH", "dtype": "REAL"}, {"name": "level_path", "dtype": "STRING"}, {"name": "not_there", "dtype": "STRING"}]
    checks = {"third column": F.col("level_path") != "L3"}
    run = lambda: load_segments(catalogue, files, "dgos", ["dgo_desc"], "fid", dictionary, checks, paths, tolerance=11.0)
    run()
    again = run()["loaded"] == 0
    loaded = read_or_empty(t.spark, paths.data, "project_id string, fid bigint, WIDTH double, level_path string, not_there string, geom binary, huc string")
    area = layer_measures(loaded).filter("not_there IS NULL").groupBy("huc", "project_id")
    good = area.agg(F.lit("loaded").alias("status"), F.count(F.lit(1)).alias("n"), F.sum("fid").alias("fids"), F.sum("WIDTH").alias("width"), F.min("level_path").alias("first_path"), F.round(F.sum("area"), 4).alias("area"))
    bad = t.spark.read.parquet(paths.rejects).select("huc", "project_id", F.col("reason").alias("status"), F.lit(0).alias("n"))
    return good.unionByName(bad, allowMissingColumns=True).withColumn("again_nothing", F.lit(again))


@query("sql_entry", "v_projects", "SELECT project_type_id, count(*) AS n, max(total_size) AS largest FROM v_projects WHERE owner_id = '3' AND created_on >= 900000000000 GROUP BY 1")
def sql_entry(t):
    text = "SELECT project_type_id, count(*) AS n, max(total_size) AS largest FROM {projects} WHERE owner_id = :owner AND created_on >= :since GROUP BY 1"
    return run_sql(t.spark, text, {"owner": "3", "since": 900000000000}, "projects of an owner", projects=t.projects)
