"""Pivot, unpivot, nesting and dictionary-driven typing."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions import columns as C

# How epoch columns are named, and the parts the name is made of.
EPOCH_PATTERN = r"^(active|wet)_(5|30)yr_(\d{4}_\d{4})_(68|95)pc_(.*)"
EPOCH_PARTS = ["landcover", "epoch_length", "epoch_name", "confidence"]


def _epoch_columns(names: Sequence[str], pattern: str) -> list[tuple[str, tuple[str, ...]]]:
    found = [(name, m.groups()) for name in names if (m := re.match(pattern, name))]
    if not found:
        raise ValueError("no column matches the epoch pattern")
    return found


def epoch_long(df: DataFrame, key: str = "fid", pattern: str = EPOCH_PATTERN) -> DataFrame:
    """One row per key and epoch column. The name parts are constants of the plan, not parsed per row."""
    rows = [
        F.struct(*[F.lit(v).alias(p) for p, v in zip([*EPOCH_PARTS, "metric_name"], parts)], F.col(name).cast("double").alias("measurement"))
        for name, parts in _epoch_columns(df.columns, pattern)
    ]
    return df.select(F.col(key).alias("dgo_id"), F.inline(F.array(*rows)))


def epoch_table(df: DataFrame, key: str = "fid", pattern: str = EPOCH_PATTERN, constants: dict[str, Column] | None = None, unique: bool = False) -> DataFrame:
    """One row per key and epoch with a column per metric; rows without any value are dropped.

    Repeated keys are averaged. The wide columns go straight to one struct per epoch, so melting
    and pivoting back needs no shuffle when keys are ``unique`` and one otherwise.
    """
    found = _epoch_columns(df.columns, pattern)
    metrics = list(dict.fromkeys(parts[-1] for _, parts in found))
    cells = {parts: name for name, parts in found}
    epochs = list(dict.fromkeys(parts[:-1] for _, parts in found))

    def cell(epoch: tuple, metric: str) -> Column:
        name = cells.get((*epoch, metric))
        return (F.col(name) if name else F.lit(None)).cast("double").alias(metric)

    rows = [F.struct(*[F.lit(v).alias(p) for p, v in zip(EPOCH_PARTS, epoch)], *[cell(epoch, m) for m in metrics]) for epoch in epochs]
    table = df.select(F.col(key).alias("dgo_id"), F.inline(F.array(*rows)))
    table = table.filter(F.coalesce(*[F.col(m) for m in metrics]).isNotNull())
    if not unique:
        table = table.groupBy("dgo_id", *EPOCH_PARTS).agg(*[F.avg(m).alias(m) for m in metrics])
    return table.withColumns(constants) if constants else table


# Dictionary types and their Spark types. Geometry is WKB.
DICTIONARY_TYPES = {"STRING": "string", "INTEGER": "bigint", "FLOAT": "double", "GEOMETRY": "binary"}


def typed(column: Column, dtype: str) -> Column:
    """Cast to a dictionary type; text that does not fit becomes NULL, structured columns are kept."""
    target = DICTIONARY_TYPES.get(dtype.upper())
    if target in ("bigint", "double"):
        return column.try_cast(target)
    return column.cast(target) if target else column


def eav_to_wide(values: DataFrame, metrics: Sequence[tuple[int, str, str, bool]], *keys: str) -> DataFrame:
    """Entity-attribute-value rows as one row per key (``dgo_id``), one typed column per *active* metric.

    ``metrics`` are (metric_id, field_name, dtype, is_active). Of repeated values the largest counts.
    """
    active = [(i, name, dtype) for i, name, dtype, on in metrics if on]
    picked = values.filter(F.col("metric_id").isin([i for i, _, _ in active]))
    return picked.groupBy(*(keys or ["dgo_id"])).agg(*[typed(F.max(F.when(F.col("metric_id") == i, F.col("metric_value"))), dtype).alias(name) for i, name, dtype in active])


def location_metrics(segments: DataFrame, values: DataFrame, metrics: Sequence[tuple[int, str, str, bool]], location: Sequence[str] = ("level_path", "seg_distance"), segment: str = "dgoid") -> DataFrame:
    """One row per location with the metrics of *all* its segments and the attributes of its first.

    Locations without metrics stay, with NULLs; NULL values are ignored, of repeated ones the largest counts.
    """
    from headwater.operators.ranking import first_per_key

    placed = segments.select(F.col(segment).alias("dgo_id"), *location)
    known = values.filter(F.col("metric_value").isNotNull()).join(placed, "dgo_id")
    wide = eav_to_wide(known, metrics, *location)
    wide = wide.select(*[F.col(c).alias(f"__{c}") for c in location], *[c for c in wide.columns if c not in location])
    first = first_per_key(segments, location, segment)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in location])
    return first.join(wide, same, "left").drop(*[f"__{c}" for c in location])


def measurement_docs(tables: dict[str, DataFrame], names: Sequence[str], visit: str = "visit_id", unique: str = "row_id", chunk: int = 1000) -> DataFrame:
    """JSON documents ``{"value": [{"MeasurementType": …, "value": row}, …]}`` per visit and table.

    File names come from the spaced measurement names. A visit with more than about ``chunk`` rows
    in one table gets several numbered parts. Unknown tables, and two tables giving the same file
    name, raise.
    """
    spelling = {n.replace(" ", "").replace("_", ""): n for n in names}
    files: dict[str, str] = {}
    envelopes = []
    for table, df in tables.items():
        # one source table name is misspelled
        known = spelling.get(table.replace("Inverterbrate", "Invertebrate"))
        if known is None:
            raise ValueError(f"{table} is not a known measurement")
        file_name = known.replace(" ", "_")
        if file_name in files:
            raise ValueError(f"{table} and {files[file_name]} give the same file {file_name}")
        files[file_name] = table
        body = F.struct(
            F.lit("").alias("note"),
            F.lit(known).alias("MeasurementType"),
            F.lit("None").alias("qaDecision"),
            F.struct(*[c for c in df.columns if c != unique]).alias("value"),
            F.lit("Measurement").alias("objectType"),
        )
        envelopes.append(df.select(F.col(visit).alias("visit_id"), F.lit(file_name).alias("file_name"), F.col(unique).alias("row_id"), F.to_json(body).alias("entry")))
    rows = reduce(DataFrame.unionByName, envelopes)
    keys = ["visit_id", "file_name"]
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / chunk).alias("part_count"))
    parts = rows.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64("row_id"), F.col("part_count")))
    entries = F.transform(F.array_sort(F.collect_list(F.struct("row_id", "entry"))), lambda x: x["entry"])
    return parts.groupBy(*keys, "part", "part_count").agg(
        F.count(F.lit(1)).alias("n"), F.concat(F.lit('{"value":['), F.array_join(entries, ","), F.lit("]}")).alias("document")
    )


def flatten(schema: T.StructType, prefix: str = "") -> list[Column]:
    """Nested struct fields as columns named with dots; arrays and maps stay as they are."""
    out: list[Column] = []
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += flatten(field.dataType, f"{path}.")
        else:
            out.append(F.col(path).alias(path))
    return out


def context_scalars(docs: DataFrame) -> DataFrame:
    """Context documents with every nested scalar as a dotted column."""
    columns = flatten(docs.schema)
    flat = docs.select(*columns)
    keep = [f.name for f in flat.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType))]
    return flat.select(*[F.col(f"`{c}`") for c in keep])


def context_bins(docs: DataFrame, histogram: str, key: str = "huc") -> DataFrame:
    """One row per histogram bin."""
    return docs.select(key, F.inline(f"{histogram}.bins"))


def context_map(docs: DataFrame, name: str, key: str = "huc") -> DataFrame:
    """One row per entry of a map such as the ownership shares."""
    return docs.select(key, F.explode(name).alias("key", "value"))


def layer_catalog(docs: DataFrame) -> DataFrame:
    """Layer dictionaries as one row per column.

    ``docs`` has authority, tool_schema_name, tool_schema_version, commit and
    ``layers: array<struct<layer_id, columns: array<struct<…>>>>``.
    """
    head = ["authority", "tool_schema_name", "tool_schema_version", "commit"]
    return docs.select(*head, F.inline("layers")).select(*head, "layer_id", F.inline("columns"))


def layer_catalog_latest(catalog: DataFrame) -> DataFrame:
    """Only the rows of the highest version of each authority and tool."""
    tool = ["authority", "tool_schema_name"]
    versioned = catalog.withColumn("version_int", C.version_int(F.col("tool_schema_version")))
    newest = versioned.groupBy(*tool).agg(F.max("version_int").alias("version_int"))
    return versioned.join(newest, [*tool, "version_int"]).drop("version_int")


def conform(df: DataFrame, dictionary: Sequence[dict]) -> DataFrame:
    """The dictionary's columns in its order and types; columns not in the data are NULL.

    ``dictionary`` entries have ``name`` and ``dtype``. Names are matched ignoring case.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for entry in dictionary:
        name, source = entry["name"], have.get(entry["name"].lower())
        column = F.col(f"`{source}`") if source else F.lit(None)
        out.append(typed(column, entry["dtype"]).alias(name))
    return df.select(*out)


def conform_report(df: DataFrame, dictionary: Sequence[dict]) -> DataFrame:
    """Schema findings: undefined, missing and missing-required columns and the column counts.

    Built from the schema alone; one row per finding, so no data is read.
    """
    defined = {e["name"].lower(): e for e in dictionary}
    have = {c.lower() for c in df.columns}
    rows = [("undefined", c) for c in sorted(have - set(defined))]
    rows += [("missing_required" if defined[c].get("is_required") else "missing", c) for c in sorted(set(defined) - have)]
    if len(have) != len(defined):
        rows.append(("column_count", f"{len(have)} of {len(defined)}"))
    return df.sparkSession.createDataFrame(rows, "finding string, column_name string")


def value_report(df: DataFrame, dictionary: Sequence[dict]) -> DataFrame:
    """Per defined column how many values are NULL and how many do not fit the declared type."""
    have = {c.lower(): c for c in df.columns}
    checked = [(e["name"], have[e["name"].lower()], e["dtype"]) for e in dictionary if e["name"].lower() in have]
    counts = []
    for name, source, dtype in checked:
        column = F.col(f"`{source}`")
        bad = F.count_if(column.isNotNull() & typed(column, dtype).isNull())
        counts.append(F.struct(F.lit(name).alias("column_name"), F.count_if(column.isNull()).alias("nulls"), bad.alias("misfits")))
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


