"""Structured Streaming jobs over a folder of project files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headwater.operators.sets import insert_ignore
from headwater.streaming.incremental import read_or_empty


def project_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000, pattern: str = "*.parquet") -> DataFrame:
    """New project files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern).parquet(path)


def stream_index(stream: DataFrame, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], key: str = "project_id", order: str | None = None, every: str | None = None) -> StreamingQuery:
    """Keep an index of projects: rows with a new key are added, known keys ignored. Without ``every`` the query handles what is
    there and stops.

    Which keys are known is state of the query, so a micro-batch reads its own rows and their keys' state, however large the index
    is. ``transform`` works row by row. Of rows with one key in a batch, that with the smallest ``order`` is added (NULL last; any
    without ``order``); a NULL key is a key.

    Every micro-batch writes a ``load`` folder of its own, named by query and batch, and overwrites it only when that batch is
    repeated after a failure. A query with a lost checkpoint is another query: it overwrites nothing, and as long as it runs it
    leaves out the keys in the loads of others, which it then has to read.
    """
    rows = transform(stream)
    rest = [f"`{c}`" for c in rows.columns if c != key]
    # the time of the batch; clocks can step back, so a key is new if all of its rows have one
    time = F.col("__time")
    rank = [] if order is None else [F.col(order).isNull(), F.col(order)]
    newest = rows.withColumn("__time", F.current_timestamp()).groupBy(key).agg(
        F.min_by(F.struct(F.lit(True).alias("__row"), *rest), F.struct(time, *rank)).alias("__first"),
        F.min(time).alias("__from"), F.max(time).alias("__to"),
    )
    fresh = newest.filter("__from = __to").select(*[key if c == key else F.col(f"__first.`{c}`") for c in rows.columns])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    others: dict[str, DataFrame | None] = {}

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        this = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if this not in others:
            loads = read_or_empty(spark, target, f"{ddl}, load string").filter(~F.col("load").startswith(f"{this}_"))
            others[this] = None if loads.isEmpty() else loads
        known = others[this]
        added = batch if known is None else insert_ignore(known, batch, [key])
        added.write.mode("overwrite").parquet(f"{target}/load={this}_{batch_id}")

    writer = fresh.writeStream.outputMode("update").foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def stream_dedup(stream: DataFrame, key: str = "project_id", ts: str = "ts", horizon: str = "1 day") -> DataFrame:
    """Rows without repeats of a key within the horizon.

    State is kept for the horizon only. Rows later than that are dropped: reconcile them in batch.
    """
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def stream_daily(stream: DataFrame, by: str = "project_type_id", ts: str = "ts", horizon: str = "1 day") -> DataFrame:
    """Project counts per day and type, given out once the day is closed by the horizon."""
    counts = stream.withWatermark(ts, horizon).groupBy(F.window(ts, "1 day"), by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("day_start"), by, "n")


def to_parquet(stream: DataFrame, target: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
