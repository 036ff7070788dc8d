"""Newest-of-group, numbering and watermark operators.

A window over (type, watershed) would sort one whole group in one task. Where only the first row
matters it is found by a combinable aggregate and joined back instead, which a hot group survives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.functions.columns import day_floor
from headwater.session import cut_lineage


def _with_newest(df: DataFrame, keys: Sequence[str], rank: Column) -> DataFrame:
    """Add the group size and whether the row has the largest ``rank`` of its group (NULL keys group)."""
    ranked = df.withColumn("__rank", rank)
    top = ranked.groupBy(*keys).agg(F.max("__rank").alias("__top"), F.count(F.lit(1)).alias("group_size"))
    top = top.select(*[F.col(k).alias(f"__{k}") for k in keys], "__top", "group_size")
    same_group = F.lit(True)
    for k in keys:
        same_group = same_group & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return (
        ranked.join(top, same_group)
        .withColumn("is_newest", F.col("__rank") == F.col("__top"))
        .drop("__rank", "__top", *[f"__{k}" for k in keys])
    )


def older_duplicates(projects: DataFrame, keys: Sequence[str] = ("project_type_id", "huc10"), order: str = "created_on", tag: str | None = None) -> DataFrame:
    """All rows but the newest of each group; among equally new ones the largest id is kept."""
    if tag is not None:
        projects = projects.filter(F.col("tags") == tag)
    newest = F.struct(F.col(order), F.col("project_id"))
    return _with_newest(projects, keys, newest).filter(~F.col("is_newest")).drop("is_newest", "group_size")


def keep_delete(projects: DataFrame, meta: DataFrame, huc_key: str, version_key: str) -> DataFrame:
    """KEEP the newest project of each owner, type, watershed and version, DELETE the others."""

    def values(key: str, name: str) -> DataFrame:
        return meta.filter(F.col("key") == key).select("project_id", F.col("value").alias(name))

    joined = projects.join(values(huc_key, "huc"), "project_id").join(values(version_key, "version"), "project_id")
    newest = F.struct(F.col("created_on"), F.col("project_id"))
    ranked = _with_newest(joined, ["owner_name", "project_type_id", "huc", "version"], newest)
    return ranked.withColumn("status", F.when(F.col("is_newest"), "KEEP").otherwise("DELETE")).drop("is_newest", "group_size")


def latest_by_version(projects: DataFrame, keys: Sequence[str] = ("project_type_id", "huc10")) -> DataFrame:
    """Groups with several projects: the one of the highest version, then newest, is kept."""
    rank = F.struct(F.coalesce(F.col("model_version_int"), F.lit(-1)), F.col("created_on"), F.col("project_id"))
    ranked = _with_newest(projects, keys, rank).filter(F.col("group_size") > 1)
    return ranked.withColumn("deletable", ~F.col("is_newest")).drop("is_newest")


def with_row_number(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Number all rows 1, 2, 3 … in a total order without gathering them in one task.

    Rows are range partitioned and sorted, written once with their place in the partition, and
    offset by the counts of the partitions before. Only the partition counts meet in one task.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    numbered = ranged.withColumn("__part", F.shiftright(place, 33)).withColumn("__place", place.bitwiseAND(F.lit((1 << 33) - 1)))
    stored = cut_lineage(numbered, "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    # one row per shuffle partition
    return stored.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__offset") + F.col("__place") + 1).drop("__part", "__place", "__offset")


def watermark(df: DataFrame, column: str = "created_on") -> DataFrame:
    """Newest loaded moment and the UTC midnight to re-read from."""
    return df.agg(F.max(column).alias("max_ms")).withColumn("from_ms", day_floor(F.col("max_ms")))


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The attributes of the row with the smallest ``order`` value per key; NULL comes last."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(F.col(order).isNull(), F.col(order))).alias("__row"))
    return picked.select(*keys, "__row.*")
