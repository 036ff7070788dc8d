"""Comparisons and checks of tables and documents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_text(name: str, dtype: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(dtype, T.BinaryType):
        return F.hex(column)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(column.alias("v")))
    return column.cast("string")


def row_hash(df: DataFrame) -> Column:
    """Hash of a row that depends on column names but not on their order; NULL differs from ''."""
    parts = [F.lit(len(df.columns))]
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        text = _as_text(field.name, field.dataType)
        parts += [F.lit(field.name), text.isNull(), text]
    return F.xxhash64(*parts)


def content_hash(df: DataFrame) -> DataFrame:
    """Row count, sum and xor of the row hashes: equal tables give equal values in any row order."""
    hashed = df.select(row_hash(df).alias("h"))
    return hashed.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
    )


def same_content(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: both counts and whether the contents are equal as multisets of rows."""
    both = content_hash(a).withColumn("side", F.lit("a")).unionByName(content_hash(b).withColumn("side", F.lit("b")))
    distinct = F.count_distinct("n", "hash_sum", "hash_xor")
    rows = lambda side: F.max(F.when(F.col("side") == side, F.col("n")))
    return both.agg(rows("a").alias("rows_a"), rows("b").alias("rows_b"), (distinct == 1).alias("equal"))


def content_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows only one side has, with repetition, marked ``only_in``."""
    names = sorted(a.columns)
    left, right = a.select(*names), b.select(*names)
    return left.exceptAll(right).withColumn("only_in", F.lit("a")).unionByName(right.exceptAll(left).withColumn("only_in", F.lit("b")))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for path in batch.column("path").to_pylist():
            if "://" in path or path.startswith("file:"):
                filesystem, inner = pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
            else:
                filesystem, inner = pafs.LocalFileSystem(), path
            with filesystem.open_input_file(inner) as source:
                schema = pq.read_schema(source)
            rows += [{"path": path, "column_name": f.name, "column_type": str(f.type)} for f in schema]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("column_name", pa.string()), ("column_type", pa.string())]))


def file_schemas(files: DataFrame) -> DataFrame:
    """(path, column, type) of Parquet files, footers read by the tasks. ``files`` has ``path``."""
    return files.select("path").mapInArrow(_footers, "path string, column_name string, column_type string")


def schema_diff(files: DataFrame) -> DataFrame:
    """Columns that not all files have with one type: file count per type, and an example file."""
    found = file_schemas(files)
    per_type = found.groupBy("column_name", "column_type").agg(F.count(F.lit(1)).alias("n_files"), F.min("path").alias("example"))
    per_column = per_type.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_types"), F.sum("n_files").alias("n_with"))
    total = files.agg(F.count(F.lit(1))).scalar()
    uneven = per_column.withColumn("n_total", total).filter((F.col("n_types") > 1) | (F.col("n_with") < F.col("n_total")))
    return per_type.join(uneven.select("column_name", "n_types", "n_total"), "column_name")


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Paths below a folder, listed by Spark without reading the contents."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return listing.select("path")


def artifact_status(context: DataFrame, target: DataFrame, huc: str = "huc10") -> DataFrame:
    """Per watershed what copying the context bounds to the target project amounts to.

    Inputs have one row per watershed: ``huc10, has_bounds, has_meta``. Only ten-digit codes count.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        valid = df.filter(F.col(huc).rlike(r"^\d{10}$"))
        return valid.select(huc, F.lit(True).alias(f"in_{name}"), F.col("has_bounds").alias(f"{name}_bounds"), F.col("has_meta").alias(f"{name}_meta"))

    both = side(context, "context").join(side(target, "target"), huc, "full")
    status = (
        F.when(F.col("in_context").isNull(), "missing_context")
        .when(F.col("in_target").isNull(), "missing_target")
        .when(~F.col("context_bounds"), "no_bounds")
        .when(~F.col("target_meta"), "inserted_no_meta")
        .when(F.col("target_bounds"), "replaced")
        .otherwise("inserted")
    )
    return both.select(huc, status.alias("status"))


def status_counts(df: DataFrame, columns: Sequence[str] = ("status",)) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
