"""Writers: partitioned TSV and Parquet, JSON lines, contract appends, partition registration."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.operators.vector import wkt_table
from headwater.session import qualified
from headwater.sources.files import TSV_COLUMNS, TSV_ESCAPES

ROWS_PER_FILE = 4_000_000


def _rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of one output folder together in few tasks; AQE splits a folder that is too big for one."""
    return df.hint("rebalance", *columns)


def _escaped(column: Column) -> Column:
    """Text for a TSV field: backslash, tab, line feed and carriage return escaped, NULL as \\N; nothing is quoted."""
    text = reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), TSV_ESCAPES, column.cast("string"))
    return F.coalesce(text, F.lit("\\N"))


def write_projects_tsv(projects: DataFrame, path: str, mode: str = "append") -> None:
    """Indexed projects as TSV below project_type_id=…/model_version=…, every row under its own version."""
    parts = ["project_type_id", "model_version"]
    fields = [_escaped(F.col(c).cast("int") if c == "archived" else F.col(c)) for c in TSV_COLUMNS]
    lines = projects.select(F.array_join(F.array(*fields), "\t").alias("value"), *parts)
    _rebalanced(lines, parts).write.mode(mode).partitionBy(*parts).text(path)


def write_by_huc(df: DataFrame, path: str, huc: str = "huc") -> None:
    """Parquet below ``huc=…``; the watersheds in ``df`` are replaced, all others stay."""
    writer = _rebalanced(df, [huc]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(huc).parquet(path)


def write_by_huc12(dgos: DataFrame, locations: DataFrame, path: str, keys: Sequence[str] = ("level_path", "seg_distance")) -> None:
    """TSV of level_path, seg_distance and WKT below ``huc12=…``; ``locations`` gives each key's huc12."""
    rows = wkt_table(dgos.join(locations.select(*keys, "huc12"), list(keys)))
    line = F.array_join(F.array(*[_escaped(F.col(c)) for c in (*keys, "geom")]), "\t").alias("value")
    _rebalanced(rows.select(line, "huc12"), ["huc12"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("huc12").text(path)


def conform_to_schema(df: DataFrame, schema: T.StructType, order: Sequence[str], next_fid: int = 1) -> DataFrame:
    """Rows in the table's schema: lower-case names, ``fid`` numbered if absent, missing columns NULL.

    Columns the table does not have, and values of a type that does not widen to the table's, raise.
    """
    from headwater.operators.ranking import with_row_number

    lowered = df.toDF(*[c.lower() for c in df.columns])
    names = {f.name for f in schema.fields}
    if "fid" in names and "fid" not in lowered.columns:
        lowered = with_row_number(lowered, order, "fid").withColumn("fid", F.col("fid") + (next_fid - 1))
    unknown = [c for c in lowered.columns if c not in names]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    return lowered.to(schema)


def append_conformed(df: DataFrame, table: str, schema: T.StructType, load_id: str, order: Sequence[str], location: str, crs: str | None = None, next_fid: int | None = None) -> None:
    """Append one load to a Parquet table partitioned by ``load_id``.

    The load's files go to a new folder and become visible together, when the partition is pointed
    to it; a failed load changes nothing visible, and a load can be repeated under its id. Numbers of
    ``fid`` continue after the largest of the other loads, unless ``next_fid`` is given. An existing
    table with another schema is an error.
    """
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    properties = f"TBLPROPERTIES ('crs' = '{crs}')" if crs else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, load_id string) USING parquet PARTITIONED BY (load_id) LOCATION '{location}' {properties}")
    stored = spark.table(table)
    there = {f.name.lower(): f.dataType for f in stored.schema.fields if f.name != "load_id"}
    given = {f.name.lower(): f.dataType for f in schema.fields}
    if there != given:
        differing = sorted(n for n in {*there, *given} if there.get(n) != given.get(n))
        raise ValueError(f"{table} has another schema; differing columns: {differing}")
    if next_fid is None:
        next_fid = 1
        if "fid" in given and "fid" not in {c.lower() for c in df.columns}:
            next_fid += stored.filter(F.col("load_id") != load_id).agg(F.max("fid")).first()[0] or 0
    # an underscore hides the folders from partition discovery
    folder = f"{location.rstrip('/')}/_loads/{load_id}/{uuid.uuid4().hex}"
    conform_to_schema(df, schema, order, next_fid).write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(folder)
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION (load_id = '{load_id}')").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD PARTITION (load_id = '{load_id}') LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} PARTITION (load_id = '{load_id}') SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Register partition folders that were written past the catalogue."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def write_docs(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """One JSON document per row and line, optionally in folders."""
    body = F.to_json(F.struct(*[c for c in df.columns if c not in by])).alias("value")
    rows = df.select(body, *by)
    if by:
        _rebalanced(rows, by).write.mode("overwrite").partitionBy(*by).text(path)
    else:
        rows.write.mode("overwrite").text(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A small summary table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_named_files(files: DataFrame, folder: str) -> int:
    """Write every row's ``content`` (text or binary) to ``folder/name``; returns how many.

    For small per-watershed files whose names matter. The tasks write them; a retried task writes
    the same files again.
    """

    target_uri = qualified(files.sparkSession, folder)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        filesystem, root = pafs.FileSystem.from_uri(target_uri)
        for batch in batches:
            # straight from the batch, which may be files of many MB: no copy of them all
            for name, content in zip(batch.column("name"), batch.column("content")):
                path = f"{root.rstrip('/')}/{name.as_py()}"
                filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with filesystem.open_output_stream(path) as target:
                    target.write(content.as_buffer())
            done = pa.RecordBatch.from_arrays([pa.array([batch.num_rows], type=pa.int64())], names=["n"])
            # not held while the next one comes
            batch = content = None
            yield done

    written = files.select("name", "content").mapInArrow(put, "n bigint")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
