"""Readers for project documents, context metrics, project XML, GeoJSON, id lists and TSV exports."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions.columns import any_of

PROJECT_SCHEMA = """
id string, name string, createdOn string, updatedOn string, visibility string, archived boolean,
ownedBy struct<id:string,name:string,__typename:string>, meta array<struct<key:string,value:string>>, tags array<string>,
projectType struct<id:string>, totalSize bigint, bounds struct<id:string>
"""
HUC_IN_NAME = r"(?:^|[^0-9])([0-9]{10}(?:[0-9]{2})?)(?:[^0-9]|$)"


def _file() -> Column:
    return F.col("_metadata.file_path")


def huc_in_path(path: Column, pattern: str = HUC_IN_NAME) -> Column:
    """The first run of just 10 or 12 digits in the last folder or the file name, else the empty string."""
    return F.regexp_extract(F.regexp_extract(path, "([^/]*/)?[^/]*$", 0), pattern, 1)


def read_project_docs(spark: SparkSession, path: str, schema: str = PROJECT_SCHEMA, one_per_line: bool = False) -> DataFrame:
    """Projects from files that each hold one JSON array.

    A pretty-printed array has to be parsed by one task per file. If every element is on a line of
    its own, ``one_per_line`` reads splittable text instead, whatever the file size; a line that holds
    anything but one whole element fails the read.
    """
    if not one_per_line:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    element = F.regexp_replace(F.regexp_replace(F.trim("value"), r"^\[\s*", ""), r"\s*(?:,|\]\s*)$", "")
    rows = spark.read.text(path).select(F.trim(element).alias("value")).filter("value <> ''")
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    whole = F.col("value").startswith("{") & F.col("p._corrupt").isNull()
    checked = F.when(whole, F.col("p")).otherwise(F.raise_error(F.concat(F.lit("not one whole element on a line: "), F.left("value", F.lit(200)))))
    return rows.select("value", parsed.alias("p")).select(checked.alias("p")).select("p.*").drop("_corrupt")


def read_rs_context(spark: SparkSession, path: str, schema: str, hucs: DataFrame | None = None) -> DataFrame:
    """Context metrics (huc, rs_context, readable) of one JSON file per watershed.

    The code is taken from the path. Unreadable files, and watersheds of ``hucs`` without a file,
    give an empty document.
    """
    files = spark.read.option("wholetext", True).text(path).select(huc_in_path(_file()).alias("huc"), "value")
    parsed = F.from_json("value", f"rs_context struct<{schema}>, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    docs = files.select("huc", parsed.alias("d")).select("huc", F.col("d.rs_context").alias("rs_context"), (F.col("d._corrupt").isNull() & F.col("d").isNotNull()).alias("readable"))
    if hucs is not None:
        docs = hucs.select("huc").distinct().join(docs, "huc", "left")
    return docs.select("huc", F.coalesce("rs_context", F.from_json(F.lit("{}"), schema)).alias("rs_context"), F.coalesce("readable", F.lit(False)).alias("readable"))


_DATASET = T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "id", "name", "path", "layer", "layer_name")])
_NUMBERS = ("lat", "lng", "min_lat", "min_lng", "max_lat", "max_lng")
_NUMBER_PATHS = ("Centroid/Lat", "Centroid/Lng", "BoundingBox/MinLat", "BoundingBox/MinLng", "BoundingBox/MaxLat", "BoundingBox/MaxLng")
_PROJECT = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("project_type", T.StringType()),
    T.StructField("has_bounds", T.BooleanType()),
    T.StructField("has_meta", T.BooleanType()),
    T.StructField("bounds_path", T.StringType()),
    *[T.StructField(n, T.DoubleType()) for n in _NUMBERS],
    T.StructField("meta", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))),
    T.StructField("datasets", T.ArrayType(_DATASET)),
])
_DATASET_ARROW = pa.struct([(n, pa.string()) for n in ("kind", "id", "name", "path", "layer", "layer_name")])
_PROJECT_ARROW = pa.struct([
    ("project_id", pa.string()), ("project_type", pa.string()), ("has_bounds", pa.bool_()), ("has_meta", pa.bool_()), ("bounds_path", pa.string()),
    *[(n, pa.float64()) for n in _NUMBERS],
    ("meta", pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))),
    ("datasets", pa.list_(_DATASET_ARROW)),
])


def _parse_project(text: str) -> dict | None:
    """The parts of a project document that jobs use; None when it is not XML."""
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        return None

    def number(node, path):
        try:
            return float(node.findtext(path))
        except (TypeError, ValueError):
            return None

    bounds, meta = root.find(".//ProjectBounds"), root.find("MetaData")
    datasets = []

    def add(kind, node, layer=None):
        datasets.append({
            "kind": kind, "id": node.get("id"), "name": node.findtext("Name"), "path": node.findtext("Path"),
            "layer": None if layer is None else layer.get("lyrName"), "layer_name": None if layer is None else layer.findtext("Name"),
        })

    for node in [*root.iter("Raster"), *root.iter("DEM")]:
        add("raster", node)
    inside = set()
    for package in root.iter("Geopackage"):
        for layer in package.iter("Vector"):
            inside.add(layer)
            add("geopackage", package, layer)
    for node in root.iter("Vector"):
        if node not in inside:
            add("shapefile", node)
    warehouse = root.find("Warehouse")
    return {
        "project_id": warehouse.get("id") if warehouse is not None else None,
        "project_type": root.findtext("ProjectType"),
        "has_bounds": bounds is not None,
        "has_meta": meta is not None,
        "bounds_path": None if bounds is None else bounds.findtext("Path"),
        **{n: None if bounds is None else number(bounds, p) for n, p in zip(_NUMBERS, _NUMBER_PATHS)},
        "meta": [] if meta is None else [{"key": m.get("name"), "value": (m.text or "").strip()} for m in meta.iter("Meta")],
        "datasets": datasets,
    }


@F.arrow_udf(_PROJECT)
def _project(xml: pa.Array) -> pa.Array:
    return pa.array([None if x is None else _parse_project(x) for x in xml.to_pylist()], type=_PROJECT_ARROW)


def read_project_xml(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """One row per project file: path, watershed code in the path, bounds, metadata and datasets.

    Files that are not XML keep their row with ``readable`` false.
    """
    files = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(path)
    parsed = files.select(_file().alias("file"), F.nullif(huc_in_path(_file()), F.lit("")).alias("huc"), _project(F.col("value")).alias("p"))
    return parsed.select("file", "huc", F.col("p").isNotNull().alias("readable"), "p.*")


def dataset_inventory(projects: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Datasets across projects by id (and layer): name and path of the first, and how many there are.

    Only paths matching a pattern from their start count. 'First' is in file order. The occurrences
    themselves are :func:`dataset_occurrences`.
    """
    found = dataset_occurrences(projects, patterns)
    first = F.min(F.struct("file", "path", "name", "layer_name"))
    grouped = found.groupBy("kind", "id", "layer").agg(F.count(F.lit(1)).alias("occurrences"), first.alias("f"))
    return grouped.select("kind", "id", "layer", "occurrences", F.col("f.name").alias("name"), F.col("f.path").alias("path"), F.col("f.layer_name").alias("layer_name"))


def dataset_occurrences(projects: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """One row per dataset and project with the file's folder joined to the dataset path."""
    rows = projects.select("file", F.inline("datasets")).filter(F.col("path").rlike(any_of(patterns)))
    return rows.withColumn("full_path", F.concat(F.regexp_extract("file", r"^(.*)/[^/]*$", 1), F.lit("/"), F.col("path")))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: id (file name after the last `` - ``), feature number, geometry.

    Collection names, reference systems and feature properties are dropped. Coordinates stay JSON text.
    """
    schema = "features array<struct<type:string,geometry:struct<type:string,coordinates:string>>>"
    files = spark.read.schema(schema).option("multiLine", True).json(path)
    name = F.regexp_extract(F.url_decode(_file()), r"([^/]*)\.[^./]*$", 1)
    ident = F.element_at(F.split(name, " - "), -1)
    return files.select(ident.alias("id"), F.posexplode("features").alias("feature_no", "f")).select("id", "feature_no", F.col("f.geometry").alias("geometry"))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a header-less one-column file, trimmed, blanks dropped."""
    return spark.read.text(path).select(F.trim("value").alias("project_id")).filter("project_id <> ''")


TSV_COLUMNS = [
    "project_id", "name", "tags", "huc10", "model_version_int", "archived", "created_on", "created_on_date",
    "owned_by_id", "owned_by_name", "owned_by_type",
]
#: Characters of a field and how they are written, the backslash first.
TSV_ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]
TSV_TYPES = {"model_version_int": "bigint", "created_on": "bigint"}


def read_projects_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Projects written by :func:`headwater.sources.sinks.write_projects_tsv`, partition columns included."""
    fields = F.split("value", "\t", -1)

    def plain(i: int) -> Column:
        raw = F.get(fields, F.lit(i))
        # between pairs of backslashes, which stand for one, every other sequence is read alone
        pieces = F.transform(F.split(raw, r"\\\\", -1), lambda x: reduce(lambda y, e: F.replace(y, F.lit(e[1]), F.lit(e[0])), TSV_ESCAPES[1:], x))
        return F.when(raw != "\\N", F.array_join(pieces, "\\"))

    typed = [plain(i).cast(TSV_TYPES[c]).alias(c) if c in TSV_TYPES else plain(i).alias(c) for i, c in enumerate(TSV_COLUMNS)]
    rows = spark.read.schema("value string, project_type_id string, model_version string").text(path)
    return (
        rows.select(*typed, "project_type_id", "model_version")
        .withColumn("archived", F.col("archived") == "1")
        .withColumn("tags", F.split("tags", r"\|"))
    )
