"""Embedding near-duplicates by an epsilon grid order join.

Vectors are scaled to length one, where a cosine of c is a distance of sqrt(2 - 2c) = eps. They are rotated
to the principal directions of a bounded sample (any rotation gives right results) and sorted by the grid
cells of width eps that their leading coordinates fall into: the epsilon grid order. The sorted sequence
is cut into intervals, written to the shared folder. Two intervals are joined unless their bounding boxes
lie further apart than eps; joining halves the intervals and skips distant halves, and compares what is
left by products in single precision with a margin, then in double precision.

Tasks hold two intervals at a time, whatever the size of a group of near copies: they return counts and a
spanning forest of the links, never all pairs. On data without structure few intervals are far apart, and
the work grows with the square of the rows; the grid order cannot help that.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing: no links,
their own component. Vectors of different lengths do not link. Repeated rows are vectors of their own for
``n_links`` and one node, the id, for components. A null id gets no component and is not kept. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm.components import connected_components, forest
from headwater.llm.files import attempt_name, new_folder, open_folder
from headwater.llm.tables import fit_in_one_task, table
from headwater.session import cut_lineage

INTERVAL = 1024
LEAF = 256
#: Rotated coordinates kept for boxes, and those that make the grid order.
BOX, GRID = 16, 6
SAMPLE = 20_000
_MARGIN = 1e-4


def unit_rows(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector at length one, or None."""
    out: list[np.ndarray | None] = []
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    at = 0
    for present, size in zip(column.is_valid().to_pylist(), column.value_lengths().to_pylist(), strict=True):
        if not present:
            out.append(None)
            continue
        v = flat[at : at + size]
        at += size
        top = np.abs(v).max() if size else 0.0
        if not np.isfinite(top) or top == 0 or np.isnan(v).any():
            out.append(None)
            continue
        v = v / top
        out.append(v / np.sqrt(v @ v))
    return out


def principal(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    """For each vector length, the leading principal directions of the given vectors as columns."""
    moments: dict[int, np.ndarray] = {}
    for batch in batches:
        for v in unit_rows(batch.column("embedding")):
            if v is not None:
                moments.setdefault(len(v), np.zeros((len(v), len(v))))
                moments[len(v)] += np.outer(v, v)
    return {d: np.ascontiguousarray(np.linalg.eigh(m)[1][:, ::-1][:, :BOX]) for d, m in moments.items()}


def rotated(rows: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Leading rotated coordinates, padded with zeros to ``BOX``."""
    d = rows.shape[1]
    out = np.zeros((len(rows), BOX))
    if d in axes:
        out[:, : axes[d].shape[1]] = rows @ axes[d]
    else:
        out[:, : min(d, BOX)] = rows[:, :BOX]
    return out


def _prepare(batches: Iterator[pa.RecordBatch], axes: Broadcast, eps: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = unit_rows(batch.column("embedding"))
        cells = [None if v is None else np.floor(rotated(v[None], axes.value)[0, :GRID] / eps).astype(np.int32).tolist() for v in units]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"),
                pa.array([None if v is None else len(v) for v in units], pa.int32()),
                pa.array(cells, pa.list_(pa.int32())),
                pa.array([None if v is None else v.tobytes() for v in units], pa.binary()),
            ],
            ["vec_id", "dim", "cells", "unit"],
        )


_WRITTEN = pa.schema(
    [("kind", pa.int32()), ("vec_id", pa.int64()), ("interval", pa.int64()), ("place", pa.int32()), ("dim", pa.int32()), ("path", pa.string())]
    + [("at", pa.int64()), ("count", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]
)
_WRITTEN_DDL = "kind int, vec_id long, interval long, place int, dim int, path string, at long, count int, low array<double>, high array<double>"


def _write(batches: Iterator[pa.RecordBatch], folder: str, axes: Broadcast) -> Iterator[pa.RecordBatch]:
    """Writes the sorted vectors of a partition as intervals: kind 0 is an interval, kind 1 a vector's place."""
    part = TaskContext.get().partitionId()
    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    path = f"{root}/{attempt_name(f'part-{part:06d}', 'ego')}"
    held: list[tuple[int | None, np.ndarray]] = []
    number = at = 0

    def flush(stream) -> pa.RecordBatch:
        nonlocal at, number
        n, dim = len(held), len(held[0][1])
        rows = np.stack([v for _, v in held])
        ids = np.array([i or 0 for i, _ in held], "<i8")
        known = np.array([i is not None for i, _ in held], "u1")
        data = rows.tobytes() + ids.tobytes() + known.tobytes()
        stream.write(data)
        turned = rotated(rows, axes.value)
        interval = (part << 32) + number
        top = [0, None, interval, None, dim, path, at, n, turned.min(axis=0).tolist(), turned.max(axis=0).tolist()]
        places = [[1, i, interval, k, None, None, None, None, None, None] for k, (i, _) in enumerate(held)]
        at += len(data)
        number += 1
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(top, *places, strict=True), _WRITTEN, strict=True)], schema=_WRITTEN)

    with system.open_output_stream(path) as stream:
        for batch in batches:
            for vec, unit in zip(batch.column("vec_id").to_pylist(), batch.column("unit").to_pylist(), strict=True):
                v = np.frombuffer(unit, np.float64)
                if held and (len(held) == INTERVAL or len(held[0][1]) != len(v)):
                    yield flush(stream)
                held.append((vec, v))
        if held:
            yield flush(stream)


class _Interval:
    def __init__(self, folder: str, d: dict, axes: dict[int, np.ndarray]) -> None:
        system, _ = open_folder(folder)
        n, dim = d["count"], d["dim"]
        with system.open_input_file(d["path"]) as source:
            data = source.read_at(n * (8 * dim + 9), d["at"])
        self.name = d["interval"]
        self.rows = np.frombuffer(data, np.float64, n * dim).reshape(n, dim)
        self.ids = np.frombuffer(data, "<i8", n, 8 * n * dim)
        self.known = np.frombuffer(data, "u1", n, 8 * n * (dim + 1)).astype(bool)
        self.single = self.rows.astype(np.float32)
        self.turned = rotated(self.rows, axes)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        if (a, b) not in self.boxes:
            self.boxes[a, b] = self.turned[a:b].min(axis=0), self.turned[a:b].max(axis=0)
        return self.boxes[a, b]


def _join(x: _Interval, y: _Interval, a: int, b: int, c: int, d: int, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked vectors in x[a:b] and y[c:d]; within one interval, each pair once."""
    if x is y and a >= d:
        return
    (low, high), (low2, high2) = x.box(a, b), y.box(c, d)
    gap = np.maximum(0, np.maximum(low - high2, low2 - high))
    if gap @ gap > 2 - 2 * cosine + _MARGIN:
        return
    if max(b - a, d - c) > LEAF:
        if b - a >= d - c:
            m = (a + b) // 2
            yield from _join(x, y, a, m, c, d, cosine)
            yield from _join(x, y, m, b, c, d, cosine)
        else:
            m = (c + d) // 2
            yield from _join(x, y, a, b, c, m, cosine)
            yield from _join(x, y, a, b, m, d, cosine)
        return
    i, j = np.nonzero(x.single[a:b] @ y.single[c:d].T >= cosine - _MARGIN)
    i, j = i + a, j + c
    if x is y:
        i, j = i[i < j], j[i < j]
    if len(i):
        exact = np.concatenate([np.einsum("ij,ij->i", x.rows[i[k : k + 65536]], y.rows[j[k : k + 65536]]) for k in range(0, len(i), 65536)]) >= cosine
        yield i[exact], j[exact]


def _join_strips(batches: Iterator[pa.RecordBatch], folder: str, axes: Broadcast, cosine: float) -> Iterator[pa.RecordBatch]:
    """For an interval and some partners: (interval, place, n) counts and (u, v) links of a forest."""
    schema = pa.schema([("interval", pa.int64()), ("place", pa.int32()), ("n", pa.int64()), ("u", pa.int64()), ("v", pa.int64())])
    for batch in batches:
        for strip in batch.to_pylist():
            x = _Interval(folder, strip["own"], axes.value)
            mine, us, vs = np.zeros(len(x.ids), np.int64), [], []
            for partner in strip["partners"]:
                y = x if partner["interval"] == x.name else _Interval(folder, partner, axes.value)
                theirs = mine if y is x else np.zeros(len(y.ids), np.int64)
                for i, j in _join(x, y, 0, len(x.ids), 0, len(y.ids), cosine):
                    mine += np.bincount(i, minlength=len(mine))
                    theirs += np.bincount(j, minlength=len(theirs))
                    both = x.known[i] & y.known[j]
                    u, v = forest(x.ids[i[both]], y.ids[j[both]])
                    us.append(u)
                    vs.append(v)
                if y is not x and theirs.any():
                    yield _counts(schema, y.name, theirs)
            if mine.any():
                yield _counts(schema, x.name, mine)
            if us:
                u, v = forest(np.concatenate(us), np.concatenate(vs))
                none = [pa.nulls(len(u), f.type) for f in list(schema)[:3]]
                yield pa.RecordBatch.from_arrays([*none, pa.array(u), pa.array(v)], schema=schema)


def _counts(schema: pa.Schema, interval: int, counts: np.ndarray) -> pa.RecordBatch:
    place = np.flatnonzero(counts)
    n = len(place)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, interval)), pa.array(place.astype(np.int32)), pa.array(counts[place]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=schema)


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, partners: int = 8) -> DataFrame:
    """One row for each row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    eps = float(np.sqrt(2 - 2 * cosine))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    total = rows.count()
    share = min(1 << 32, int(SAMPLE / max(total, 1) * (1 << 32)))
    sample = rows.where(F.shiftrightunsigned(F.xxhash64("vec_id"), 32) < share).select("embedding")
    axes = spark.sparkContext.broadcast(fit_in_one_task(sample, principal))
    folder = new_folder(spark, "intervals")
    ready = rows.mapInArrow(lambda b: _prepare(b, axes, eps), "vec_id long, dim int, cells array<int>, unit binary")
    ready = cut_lineage(ready, "units")
    parts = max(1, rows.rdd.getNumPartitions())
    order = ["dim", "cells", F.xxhash64("vec_id")]
    dealt = ready.where("dim IS NOT NULL").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    written = cut_lineage(dealt.mapInArrow(lambda b: _write(b, folder, axes), _WRITTEN_DDL), "places")
    own = written.where("kind = 0").select(F.struct("interval", "dim", "path", "at", "count").alias("own"), "low", "high")
    cell = lambda side: F.floor(F.col(side)[0] / eps)
    near = own.withColumn("cell", F.explode(F.sequence(cell("low") - 1, cell("high") + 1))).withColumn("dim", F.col("own.dim"))
    other = own.select(F.col("own").alias("partner"), F.col("low").alias("low2"), F.col("high").alias("high2")).withColumn("cell", F.explode(F.sequence(cell("low2"), cell("high2")))).withColumn("dim", F.col("partner.dim"))
    gap = F.expr("aggregate(zip_with(arrays_zip(low, high), arrays_zip(low2, high2), (p, q) -> greatest(0D, p.low - q.high2, q.low2 - p.high)), 0D, (s, g) -> s + g * g)")
    pairs = near.join(other, ["dim", "cell"]).where("own.interval <= partner.interval").where(gap <= 2 - 2 * cosine + _MARGIN).select("own", "partner").distinct()
    slot = F.pmod(F.xxhash64("partner.interval"), F.ceil(F.count("*").over(_by_own()) / partners))
    strips = pairs.withColumn("slot", slot).groupBy("own", "slot").agg(F.collect_list("partner").alias("partners"))
    # rows are small but their work is not, so they are dealt out and not gathered into few tasks
    spread = strips.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "own.interval", "slot").select("own", "partners")
    joined = cut_lineage(spread.mapInArrow(lambda b: _join_strips(b, folder, axes, cosine), "interval long, place int, n long, u long, v long"), "joined")
    counts = joined.where("n IS NOT NULL").groupBy("interval", "place").agg(F.sum("n").alias("n_links"))
    component = connected_components(joined.where("u IS NOT NULL").select("u", "v")).withColumnRenamed("node", "vec_id")
    placed = written.where("kind = 1").select("vec_id", "interval", "place").join(counts, ["interval", "place"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    every = placed.unionAll(ready.where("dim IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links")))
    named = every.join(component, "vec_id", "left").select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"))
    return named.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _by_own():
    from pyspark.sql import Window

    return Window.partitionBy("own.interval")


def op8_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND NOT list_bool_or(list_transform(e, lambda x: x IS NULL OR NOT isfinite(x))) AND list_bool_or(list_transform(e, lambda x: x <> 0))),
link AS (SELECT a.vec_id AS u, b.vec_id AS w FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(u, w) AS (SELECT u, w FROM link UNION SELECT r.u, l.w FROM reach r JOIN link l ON r.w = l.u),
least AS (SELECT u, min(w) AS w FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM link GROUP BY u)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, CAST(least(vec_id, coalesce(w, vec_id)) AS BIGINT) AS component_id,
       vec_id <= coalesce(w, vec_id) AS kept
FROM v LEFT JOIN n ON n.u = vec_id LEFT JOIN least ON least.u = vec_id
"""
