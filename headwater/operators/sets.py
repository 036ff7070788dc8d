"""Unions, merged databases and insert-if-absent."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.operators.joins import merge_remap, orphan_counts
from headwater.sources.gpkg import read_layers


def union_huc_tables(files: DataFrame, table: str, huc: str = "huc10", drop: Sequence[str] = ()) -> DataFrame:
    """The same-named table of many GeoPackages (path) under one another, each row with the watershed code in its file's path.

    Columns a file lacks are NULL; ``drop`` leaves columns out (a geometry, say). Raises if no file has the table.
    """
    layers = read_layers(files, [table])
    if table not in layers:
        raise ValueError(f"no file has the table {table}")
    return layers[table].drop("source_path", *drop, huc).withColumnRenamed("huc", huc)


def layer_append(files: DataFrame, inventory: DataFrame | None = None) -> dict[str, DataFrame]:
    """Per layer its rows in all GeoPackages (path), with the union of their columns.

    ``inventory`` (``layer``), as :func:`~headwater.sources.files.dataset_inventory` lists it, says which layers; by default all
    there are. The list of different layer names comes to the driver, rows do not.
    """
    wanted = None if inventory is None else [r[0] for r in inventory.select("layer").filter("layer IS NOT NULL").distinct().collect()]
    return read_layers(files, wanted)


def merge_databases(files: DataFrame, parent: str, child_pattern: str, key: str) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """Many GeoPackages (path) as one: parents under new ids, child tables that point at these, and the counts of orphans.

    Child tables are those whose whole name matches ``child_pattern``, ignoring case, and that have the key; they are found in the
    files. Each file is opened once, and its watershed code is ``huc``.
    """
    layers = read_layers(files)
    if parent not in layers:
        raise ValueError(f"no file has the table {parent}")
    rows = {name: df.drop("source_path") for name, df in layers.items()}
    found = {n: df for n, df in rows.items() if n != parent and re.fullmatch(child_pattern, n, re.IGNORECASE) and key.lower() in map(str.lower, df.columns)}
    children = {n: df.withColumnsRenamed({c: key for c in df.columns if c.lower() == key.lower()}) for n, df in found.items()}
    renewed, moved = merge_remap(rows[parent], children, key, "huc")
    none = files.sparkSession.createDataFrame([], "child string, huc string, orphans long")
    return renewed, moved, orphan_counts(rows[parent], children, key, "huc") if children else none


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """The rows of ``new`` to append: key not in ``target``, first of its key within ``new``.

    With ``order`` the row with the smallest value is the first (NULL last), which makes re-runs agree.
    """
    fresh = new.join(target.select(*keys), list(keys), "left_anti")
    if order is None:
        return fresh.dropDuplicates(list(keys))
    rest = [c for c in new.columns if c not in keys]
    first = fresh.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(F.col(order).isNull(), F.col(order))).alias("__row"))
    return first.select(*keys, "__row.*").select(*new.columns)
