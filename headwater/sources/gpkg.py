"""GeoPackage scan: a Python data source over many SQLite files.

    register(spark)
    spark.read.format("gpkg").option("table", "dgos").load("/data/*/metrics.gpkg")

Files above ``splitBytes`` are read in several row-id ranges, small files share an input partition.
``columns`` (comma separated) prunes the SELECT. Geometry blobs lose their header and come as WKB.
``source_path`` says which file a row is from and ``huc`` which watershed code its path has.

``read_gpkg`` takes the watersheds wanted and tests of columns: the first prune files before any is opened (or its size asked
for), the others become conditions of the SELECT, where the file declares the column in the type that the test
has. They are options of the read, not Spark's ``pushFilters``: Spark 4.1 keeps one reader for all uses of a Python source's
DataFrame, so the filters of one branch of a union would reach the other.
"""

from __future__ import annotations

import json
import re
import sqlite3
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from glob import glob
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from headwater.session import scratch_dir
from headwater.sources.files import HUC_IN_NAME

BATCH_ROWS = 10_000
# files that the data source opens on the driver for its schema; of more files it wants to be given one, and :func:`read_gpkg`
# has tasks look into all of them
LOOKED_AT = 20
SPLIT_BYTES = 128 * 1024 * 1024
OPEN_COST = 4 * 1024 * 1024  # bytes a file open counts as, as for Spark's own file sources
ENVELOPE_BYTES = (0, 32, 48, 48, 64)


def strip_header(blob: bytes | None) -> bytes | None:
    """WKB of a GeoPackage geometry blob; plain WKB passes through."""
    if blob is None or blob[:2] != b"GP":
        return blob
    kind = (blob[3] >> 1) & 7
    return blob[8 + ENVELOPE_BYTES[kind] :] if kind < len(ENVELOPE_BYTES) else None


def add_header(wkb: bytes, srid: int) -> bytes:
    """A GeoPackage geometry blob without envelope."""
    return b"GP\x00\x01" + srid.to_bytes(4, "little", signed=True) + wkb


def _filesystem(path: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path)


def _is_remote(path: str) -> bool:
    return "://" in path and not path.startswith("file:")


def _plain(path: str) -> str:
    if path.startswith("file:"):
        path = path[5:]
        return "/" + path.lstrip("/")
    return path


def huc_of(path: str) -> str | None:
    """The watershed code in the last folder or the file name: the first run of just 10 or 12 digits."""
    found = re.search(HUC_IN_NAME, "/".join(path.split("/")[-2:]))
    return found.group(1) if found else None


def list_paths(path: str, keep: Callable[[str], bool] = lambda p: True) -> list[tuple[str, int]]:
    """(path, size) of the files a comma separated list of globs, folders or files names, and that ``keep`` wants."""
    import os
    from fnmatch import fnmatch

    found: list[tuple[str, int]] = []
    for part in path.split(","):
        part = part.strip()
        if _is_remote(part):
            import pyarrow.fs as pafs

            scheme = part.split("://")[0]
            base = part.split("*")[0].rsplit("/", 1)[0]
            filesystem, root = _filesystem(base)
            wanted = part.split("://", 1)[1]
            for info in filesystem.get_file_info(pafs.FileSelector(root, recursive=True)):
                full = f"{scheme}://{info.path.lstrip('/')}" if scheme != "hdfs" else f"{base.split(root)[0]}{info.path}"
                if info.is_file and keep(full) and (fnmatch(info.path, "*" + wanted.lstrip("/").split("/", 1)[-1]) or "*" not in part):
                    found.append((full, info.size))
            continue
        local = _plain(part)
        if os.path.isdir(local):
            local = os.path.join(local, "**", "*.gpkg")
        found += [(p, os.path.getsize(p)) for p in glob(local, recursive=True) if keep(p)]
    return sorted(found)


def open_database(path: str) -> sqlite3.Connection:
    """Read-only connection; a file on remote storage is read into memory."""
    if not _is_remote(path):
        return sqlite3.connect(f"file:{quote(_plain(path))}?mode=ro&immutable=1", uri=True)
    filesystem, inner = _filesystem(path)
    connection = sqlite3.connect(":memory:")
    with filesystem.open_input_stream(inner) as source:
        connection.deserialize(source.read())
    return connection


def _name(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


def _spark_type(declared: str) -> T.DataType:
    declared = declared.upper()
    if "INT" in declared or declared == "BOOLEAN":
        return T.LongType()
    if any(word in declared for word in ("REAL", "DOUBLE", "FLOAT", "NUMERIC")):
        return T.DoubleType()
    if declared == "BLOB" or any(word in declared for word in ("GEOMETRY", "POINT", "POLYGON", "LINESTRING", "CURVE", "SURFACE")):
        return T.BinaryType()
    return T.StringType()


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both: whole numbers fit doubles, anything else meets as text."""
    if a == b:
        return a
    return T.DoubleType() if {a, b} == {T.LongType(), T.DoubleType()} else T.StringType()


def table_schema(path: str, table: str) -> T.StructType:
    """Columns of a table in one file; none if the file does not have it."""
    connection = open_database(path)
    try:
        rows = connection.execute(f"PRAGMA table_info({_name(table)})").fetchall()
    finally:
        connection.close()
    return T.StructType([T.StructField(row[1], _spark_type(row[2])) for row in rows])


def union_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns of the schemas, in order of appearance, by name ignoring case and in the widest type."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            held = found.setdefault(field.name.lower(), field)
            found[field.name.lower()] = T.StructField(held.name, _wider(held.dataType, field.dataType))
    return T.StructType(list(found.values()))


def table_names(path: str) -> list[str]:
    """User tables of a database, without GeoPackage and SQLite bookkeeping."""
    connection = open_database(path)
    try:
        rows = connection.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name").fetchall()
    finally:
        connection.close()
    return [r[0] for r in rows if not r[0].startswith(("gpkg_", "sqlite_", "rtree_"))]


@dataclass
class Slices(InputPartition):
    """(path, part, parts) pieces one task reads."""

    pieces: list[tuple[str, int, int]]


#: Columns that the path of a file tells.
PATH_COLUMNS: dict[str, Callable[[str], str | None]] = {"source_path": lambda p: p, "huc": huc_of}
#: A test of a column: name, one of these, and a value or, for ``in``, a list of values.
Test = tuple[str, str, object]
_COMPARED = ("=", ">", ">=", "<", "<=")


def row_condition(test: Test, declared: dict[str, T.DataType]) -> tuple[str, list] | None:
    """The condition on the rows of one file for a test, with its values; None if there is none.

    ``declared``: the file's columns, in lower case, with the types that it declares. A test counts only if its values are of that
    type, as values of others compare by other rules.
    """
    name, op, value = test
    kinds = {T.LongType(): (int, float), T.DoubleType(): (int, float), T.StringType(): (str,)}.get(declared.get(name.lower()), ())
    values = list(value) if op == "in" else [value]
    if not kinds or any(isinstance(v, bool) or not isinstance(v, kinds) for v in values):
        return None
    exact = " COLLATE BINARY" if kinds == (str,) else ""
    if op == "in":
        return f"{_name(name)}{exact} IN ({', '.join('?' * len(values))})", values
    return f"{_name(name)}{exact} {op} ?", values


def _spark_test(test: Test) -> Column:
    name, op, value = test
    if op == "in":
        return F.col(name).isin(list(value))
    if op not in _COMPARED:
        raise ValueError(f"unknown comparison {op!r}")
    column, value = F.col(name), F.lit(value)
    return {"=": column == value, ">": column > value, ">=": column >= value, "<": column < value, "<=": column <= value}[op]


class GpkgReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.table = options["table"]
        self.path = options["path"]
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.hucs = json.loads(options["hucs"]) if "hucs" in options else None
        self.where = json.loads(options.get("where", "[]"))

    def partitions(self) -> list[Slices]:
        pieces = []
        for path, size in list_paths(self.path, lambda p: self.hucs is None or huc_of(p) in self.hucs):
            # a remote file is read whole, so all of it is one task's
            parts = 1 if _is_remote(path) else max(1, -(-size // self.split_bytes))
            pieces += [(size // parts, (path, i, parts)) for i in range(parts)]
        packed, room = [], 0
        for size, piece in pieces:
            cost = size + min(OPEN_COST, self.split_bytes)
            if not packed or cost > room:
                packed.append(Slices([]))
                room = self.split_bytes
            packed[-1].pieces.append(piece)
            room -= cost
        return packed or [Slices([])]

    def read(self, partition: Slices) -> Iterator[pa.RecordBatch]:
        for path, part, parts in partition.pieces:
            yield from self._rows(path, part, parts)

    def _rows(self, path: str, part: int, parts: int) -> Iterator[pa.RecordBatch]:
        connection = open_database(path)
        try:
            yield from table_batches(connection, path, self.table, self.schema, part, parts, self.where)
        finally:
            connection.close()


_ARROW = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.BinaryType(): pa.binary(), T.StringType(): pa.string()}


def table_batches(connection: sqlite3.Connection, path: str, table: str, schema: T.StructType, part: int = 0, parts: int = 1, tests: Iterable[Test] = ()) -> Iterator[pa.RecordBatch]:
    """Rows of one table in the columns of ``schema``; no batch if the file has no such table."""
    fields = [(f.name, _ARROW[f.dataType]) for f in schema.fields]
    data = [(n, t) for n, t in fields if n not in PATH_COLUMNS]
    declared = {r[1].lower(): _spark_type(r[2]) for r in connection.execute(f"PRAGMA table_info({_name(table)})")}
    if not declared:
        return
    columns = ", ".join(_name(n) if n.lower() in declared else f"NULL AS {_name(n)}" for n, _ in data) or "1"
    conditions, values = [], []
    if parts > 1:
        low, high = connection.execute(f"SELECT min(rowid), max(rowid) FROM {_name(table)}").fetchone()
        if low is None:
            return
        step = -(-(high - low + 1) // parts)
        conditions.append(f"rowid >= {low + step * part} AND rowid < {low + step * (part + 1)}")
    for test in tests:
        found = row_condition(test, declared)
        if found is not None:
            conditions.append(found[0])
            values += found[1]
    where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
    cursor = connection.execute(f"SELECT {columns} FROM {_name(table)}{where}", values)
    while rows := cursor.fetchmany(BATCH_ROWS):
        columns_out = []
        held = dict(zip([n for n, _ in data], zip(*rows)))
        for name, dtype in fields:
            if name in PATH_COLUMNS:
                columns_out.append(pa.array([PATH_COLUMNS[name](path)] * len(rows), type=dtype))
            elif pa.types.is_binary(dtype):
                columns_out.append(pa.array([strip_header(v) for v in held[name]], type=dtype))
            elif pa.types.is_string(dtype):
                columns_out.append(pa.array([None if v is None else str(v) for v in held[name]], type=dtype))
            else:
                columns_out.append(pa.array([_fitting(v, pa.types.is_float64(dtype), path, table, name) for v in held[name]], type=dtype))
        yield pa.RecordBatch.from_arrays(columns_out, names=[n for n, _ in fields])


def _fitting(value: object, real: bool, path: str, table: str, column: str) -> float | int | None:
    """A value of a number column. SQLite types values one by one: what does not fit the column is an error."""
    if value is None:
        return None
    if isinstance(value, (int, float)):
        if real:
            return float(value)
        if value == value and abs(value) < 2**63 and value == int(value):
            return int(value)
    raise ValueError(f"{value!r} in {path}, table {table}, does not fit the number column {column}; give a schema with a wider type")


_PATH_FIELDS = [T.StructField(n, T.StringType()) for n in PATH_COLUMNS]


class GpkgSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> T.StructType:
        files = list_paths(self.options["path"])
        if not files:
            raise ValueError(f"no files at {self.options['path']}")
        if len(files) > LOOKED_AT:
            raise ValueError(f"{len(files)} files at {self.options['path']} may differ in their columns: give a schema, or use read_gpkg, which looks into all of them")
        found = union_schema([table_schema(p, self.options["table"]) for p, _ in files])
        if not found.fields:
            raise ValueError(f"no table {self.options['table']} in {files[0][0]} and the files after it")
        wanted = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        if wanted:
            by_name = {f.name.lower(): f for f in found.fields}
            found = T.StructType([by_name[c.lower()] for c in wanted])
        return T.StructType([*found.fields, *_PATH_FIELDS])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return GpkgReader(schema, {k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GpkgSource)


def read_gpkg(spark: SparkSession, path: str, table: str, columns: list[str] | None = None, schema: T.StructType | None = None, split_bytes: int | None = None, hucs: Iterable[str] | None = None, where: Iterable[Test] = ()) -> DataFrame:
    """Rows of one table in many files, with ``source_path`` and the watershed code in it, ``huc``.

    Only files of the watersheds ``hucs`` are opened, and only rows that pass all tests of ``where`` leave SQLite.

    Without a ``schema`` (with ``source_path``) tasks look into every file first: the columns are
    those of all files, and a column is of the type that holds the values declared in each.
    """
    register(spark)
    hucs, where = None if hucs is None else sorted(set(hucs)), [list(t) for t in where]
    if schema is None:
        found = survey_layers(_file_table(spark, path, hucs), [table])
        if table not in found:
            raise ValueError(f"no table {table} in the files at {path}")
        by_name = {f.name.lower(): f for f in found[table].fields}
        schema = T.StructType([by_name[c.lower()] for c in columns] if columns else found[table].fields)
    schema = T.StructType([*(f for f in schema.fields if f.name not in PATH_COLUMNS), *_PATH_FIELDS])
    reader = spark.read.format("gpkg").option("table", table).schema(schema)
    if columns:
        reader = reader.option("columns", ",".join(columns))
    if split_bytes:
        reader = reader.option("splitBytes", str(split_bytes))
    if hucs is not None:
        reader = reader.option("hucs", json.dumps(hucs))
    # Spark tests again: a file may hold a column in another type
    rows = reader.option("where", json.dumps(where)).load(path)
    for test in where:
        rows = rows.filter(_spark_test(test))
    return rows


# --- many tables of many files --------------------------------------------------------------------


def _file_table(spark: SparkSession, path: str, hucs: list[str] | None = None) -> DataFrame:
    paths = [(p,) for p, _ in list_paths(path, lambda p: hucs is None or huc_of(p) in hucs)]
    if not paths:
        raise ValueError(f"no files at {path}" + ("" if hucs is None else " of the watersheds wanted"))
    return spark.createDataFrame(paths, "path string")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the GeoPackages below a folder or of a glob, listed by Spark; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gpkg").load(path).select("path")


def _spread(files: DataFrame) -> DataFrame:
    """File paths dealt over all tasks."""
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.select("path").repartition(tasks, "path")


def survey_layers(files: DataFrame, layers: Iterable[str] | None = None) -> dict[str, T.StructType]:
    """The tables of the files (path), or those ``layers`` that they have, with the columns of all files.

    Tasks look into the files; what comes back is each different table definition once.
    """
    wanted = None if layers is None else list(layers)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for name in table_names(path) if wanted is None else wanted:
                    schema = table_schema(path, name)
                    if schema.fields:
                        seen.add((name, schema.json()))
        names, schemas = zip(*sorted(seen)) if seen else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(schemas, pa.string())], ["name", "schema"])

    found: dict[str, list[T.StructType]] = {}
    rows = _spread(files).mapInArrow(look, "name string, schema string").distinct().collect()
    for name, schema in sorted(map(tuple, rows), key=lambda r: (r[0], len(r[1]), r[1])):
        found.setdefault(name, []).append(T.StructType.fromJson(json.loads(schema)))
    return {name: union_schema(schemas) for name, schemas in found.items()}


def read_layers(files: DataFrame, layers: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Layer -> its rows in all files (path), with ``source_path`` and ``huc``.

    Files are rows of the plan's input: tasks open each once and read all its tables, however many files and watersheds there are. The
    scan is written to the shared folder, by layer, so that every layer reads its own part only.
    """
    schemas = survey_layers(files, layers)
    spark = files.sparkSession
    full = {name: T.StructType([*(f for f in s.fields if f.name not in PATH_COLUMNS), *_PATH_FIELDS]) for name, s in schemas.items()}
    # one struct column a layer; a row has that of its own
    places = {name: f"l{i}" for i, name in enumerate(full)}
    out = T.StructType([T.StructField("layer", T.StringType()), *(T.StructField(places[n], s) for n, s in full.items())])
    kinds = {n: pa.struct([(f.name, _ARROW[f.dataType]) for f in s.fields]) for n, s in full.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                connection = open_database(path)
                try:
                    for name, schema in full.items():
                        for rows in table_batches(connection, path, name, schema):
                            n = rows.num_rows
                            own = pa.StructArray.from_arrays(rows.columns, fields=list(kinds[name]))
                            columns = [own if other == name else pa.nulls(n, kinds[other]) for other in full]
                            yield pa.RecordBatch.from_arrays([pa.array([places[name]] * n), *columns], ["layer", *places.values()])
                finally:
                    connection.close()

    folder = scratch_dir(spark, "layers")
    if not full:
        return {}
    _spread(files).mapInArrow(scan, out).write.partitionBy("layer").parquet(folder)
    read = lambda name: spark.read.schema(out).parquet(folder).filter(F.col("layer") == places[name]).select(f"{places[name]}.*")
    return {name: read(name) for name in full}


def copy_tables(spark: SparkSession, source: str, target: str, tables: list[str] | None = None) -> dict[str, str]:
    """Every table of the source files as Parquet below ``target``; returns table -> folder. Each file is opened once."""
    folders = {}
    for table, rows in read_layers(_file_table(spark, source), tables).items():
        folders[table] = f"{target.rstrip('/')}/{table}"
        rows.drop("huc").write.mode("overwrite").parquet(folders[table])
    return folders
