"""Connected components of links, by forests inside the tasks and alternating stars over DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm.tables import tidy
from headwater.session import cut_lineage

#: Links that a task holds at once.
HELD = 1 << 20

_LINK = "u long, v long"


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for every other node of the links."""
    nodes, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            other = label != np.arange(len(nodes))
            return nodes[other], nodes[label[other]]
        label = new


def _contracted(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.RecordBatch]:
    """Forests of the links of a task, one of each ``held`` links or a batch more."""
    us, vs, n = [], [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(np.concatenate(us), np.concatenate(vs))], ["u", "v"])

    for batch in batches:
        us.append(batch.column("u").to_numpy())
        vs.append(batch.column("v").to_numpy())
        n += batch.num_rows
        if n > held:
            yield made()
            us, vs, n = [], [], 0
    if n:
        yield made()


def _with_roots(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.RecordBatch]:
    """(node, component) of all nodes of at most ``held`` links, which one task reads."""
    for batch in _contracted(batches, held):
        node, root = (batch.column(c).to_numpy() for c in "uv")
        roots = np.unique(root)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ((node, roots), (root, roots))], ["node", "component"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, held: int = HELD) -> DataFrame:
    """(node, component) for every node of the links (u, v), which are longs; a component is named by its smallest node.

    Tasks first reduce the links they read to forests. If these have no more than ``held`` links, which a task holds at
    once, one task ends the job, with no exchange. Else each round every node hands its larger neighbours, then its smaller ones, to the smallest node it
    sees; rounds grow with the logarithm of the longest path. A node with very many links is a combinable
    ``min`` and a join whose skew Spark can split. Rounds are cut by written tables. Links to null or to
    the node itself are ignored.
    """
    edges = links.where("u <> v").select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    edges = cut_lineage(edges.mapInArrow(tidy(lambda b: _contracted(b, held)), _LINK), "links")
    if edges.count() <= held:
        return cut_lineage(edges.coalesce(1).mapInArrow(tidy(lambda b: _with_roots(b, held)), "node long, component long"), "components")
    edges = cut_lineage(edges.distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(least.select("u", F.col("m").alias("v")))
        edges = cut_lineage(small.distinct(), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    ends = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return ends.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
