"""Incremental batch load: what is missing, transform, write, ledger."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.operators.joins import missing_or_stale, rme_wide
from headwater.operators.reshape import conform
from headwater.operators.vector import simplify_coverage
from headwater.session import cut_lineage
from headwater.sources.files import huc_in_path
from headwater.sources.gpkg import read_layers
from headwater.sources.sinks import write_by_huc

LEDGER = "huc string, project_id string, loaded_ts bigint"


@dataclass
class Paths:
    """Folders of one incremental table."""

    data: str
    ledger: str
    rejects: str


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or no rows while it does not exist."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def watersheds_to_load(catalogue: DataFrame, paths: Paths) -> DataFrame:
    """(huc, project_id, created_on) of the newest project of every watershed that is missing or older in the ledger."""
    ledger = read_or_empty(catalogue.sparkSession, paths.ledger, LEDGER)
    newest = catalogue.groupBy("huc").agg(F.max(F.struct("created_on", "project_id")).alias("p")).select("huc", "p.created_on", "p.project_id")
    # the ledger keeps every load of a watershed, only its latest counts
    last = ledger.groupBy("huc").agg(F.max("loaded_ts").alias("loaded_ts"))
    return cut_lineage(missing_or_stale(newest, last).drop("loaded_ts"), "todo")


def run_incremental(catalogue: DataFrame, inputs: DataFrame, checks: dict[str, Column], transform: Callable[[DataFrame], DataFrame], paths: Paths) -> dict[str, int]:
    """Load every watershed that is missing or older than its project, all in one job.

    ``inputs`` carry ``huc``; ``checks`` are conditions a watershed breaks if any of its rows does
    (or it has none): such a watershed is left out, written to the rejects with the check's name
    and tried again next time. Good ones replace their folder and enter the ledger with the
    project's time cut to the second, so a repeated run has nothing to do.
    """
    return _load(watersheds_to_load(catalogue, paths), inputs, checks, transform, paths)


def load_segments(
    catalogue: DataFrame, files: DataFrame, main: str, sides: Sequence[str], key: str, dictionary: Sequence[dict], checks: dict[str, Column], paths: Paths,
    geom: str = "geom", tolerance: float | None = None,
) -> dict[str, int]:
    """The load of segment GeoPackages: which watersheds are missing or stale, their files, wide rows, the dictionary's columns,
    simplified borders, one folder a watershed.

    ``files`` (path) are all there are; only those of watersheds to load are opened, each once, and a run with nothing to do opens
    none. The ``main`` table and its ``sides`` meet by ``key`` within a file. Written are ``project_id``, the columns of
    ``dictionary`` in its types (NULL where a file lacks one), and the geometry, with ``tolerance`` simplified
    together with that of the same watershed. Checks and the ledger are those of :func:`run_incremental`.
    """
    todo = watersheds_to_load(catalogue, paths)
    wanted = files.join(todo.select(F.col("huc").alias("__huc")), huc_in_path(F.col("path")) == F.col("__huc"), "left_semi")
    layers = read_layers(wanted, [main, *sides])
    if main not in layers:
        return _load(todo, files.sparkSession.createDataFrame([], "huc string"), {}, lambda df: df, paths)
    # keys count per file
    named = {name: df.withColumn("__id", F.struct("source_path", key)) for name, df in layers.items()}
    others = [named[s].drop("source_path", "huc", key) for s in sides if s in named]
    wide = rme_wide(named[main], others, "__id").drop("__id")

    def shape(rows: DataFrame) -> DataFrame:
        feature = F.struct("source_path", key)
        if tolerance is not None:
            rows = simplify_coverage(rows.withColumn("__feature", feature), "__feature", tolerance, ["huc"], geom)
            rows = rows.withColumn(geom, F.coalesce(f"{geom}_simplified", geom))
        # the dictionary may name the same columns, so these travel in one that it does not
        beside = rows.select(F.struct("huc", "project_id", geom).alias("__beside"), *rows.columns)
        return conform(beside, [*dictionary, {"name": "__beside", "dtype": "STRUCT"}]).select("__beside.huc", "__beside.project_id", *[e["name"] for e in dictionary], F.col(f"__beside.{geom}").alias(geom))

    return _load(todo, wide, checks, shape, paths)


def _load(todo: DataFrame, inputs: DataFrame, checks: dict[str, Column], transform: Callable[[DataFrame], DataFrame], paths: Paths) -> dict[str, int]:
    breaches = [F.when(~F.coalesce(condition, F.lit(False)), F.lit(name)) for name, condition in checks.items()]
    rows = inputs.join(todo.select("huc", "project_id"), "huc")
    verdicts = rows.groupBy("huc").agg(F.min(F.coalesce(*breaches, F.lit(None).cast("string"))).alias("reason"))
    judged = todo.join(verdicts.withColumn("seen", F.lit(True)), "huc", "left")
    judged = cut_lineage(judged.withColumn("reason", F.when(F.col("seen").isNull(), "no input").otherwise(F.col("reason"))).drop("seen"), "judged")
    good, bad = judged.filter("reason IS NULL"), judged.filter("reason IS NOT NULL")
    counts = judged.agg(F.count_if(F.col("reason").isNull()).alias("loaded"), F.count_if(F.col("reason").isNotNull()).alias("rejected")).first().asDict()

    if counts["loaded"]:
        write_by_huc(transform(rows.join(good.select("huc"), "huc", "left_semi")), paths.data)
    bad.select("huc", "project_id", "reason").write.mode("overwrite").parquet(paths.rejects)
    entries = good.select("huc", "project_id", (F.floor(F.col("created_on") / 1000) * 1000).cast("bigint").alias("loaded_ts"))
    entries.write.mode("append").parquet(paths.ledger)
    return counts


def query(spark: SparkSession, text: str, args: dict | None = None, label: str = "", **tables: DataFrame) -> DataFrame:
    """Run SQL text over the session's views and the given tables; failures raise.

    ``args`` fill ``:name`` markers, ``tables`` fill ``{name}``.
    """
    if label:
        spark.sparkContext.setJobDescription(label)
    return spark.sql(text, args=args or {}, **tables)
