"""Noding and crossing checks of polygon outlines, as joins of edges on grid cells by size class.

Edges are rows (keys, ``lo``, ``hi``) with ends that are structs (x, y). An edge is listed under the few cells, of its own
size, that its box reaches; a point or a shorter edge looks in its cells of every size that its key has. So an edge
meets what is near it by its own measure, however unlike the sizes of a layer are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.session import cut_lineage


def _level(near: float) -> Column:
    """The edge's size class: cells of ``2 ** level`` are no smaller than its box."""
    extent = F.greatest(F.abs(F.col("hi.x") - F.col("lo.x")), F.abs(F.col("hi.y") - F.col("lo.y")))
    return F.ceil(F.log2(extent + 2 * near)).cast("int")


def _cells(df: DataFrame, near: float) -> DataFrame:
    """One row for each cell of size class ``level`` that the edge's box reaches."""
    size = F.pow(F.lit(2.0), F.col("level"))
    span = lambda c: F.sequence(
        F.floor((F.least(F.col(f"lo.{c}"), F.col(f"hi.{c}")) - near) / size).cast("bigint"), F.floor((F.greatest(F.col(f"lo.{c}"), F.col(f"hi.{c}")) + near) / size).cast("bigint")
    )
    return df.withColumn("cx", F.explode(span("x"))).withColumn("cy", F.explode(span("y")))


def _levels(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The size classes of each key, some tens at most."""
    return edges.groupBy(*keys).agg(F.collect_set("level").alias("levels"))


def split_at_vertices(edges: DataFrame, keys: Sequence[str], near: float) -> DataFrame:
    """The edges cut at all vertices of their key that lie on them, at most ``near`` off; other columns are kept by each piece.

    A vertex that cuts an edge becomes an end of both pieces, so borders that two polygons run with
    different vertices become the same edges.
    """
    edges = cut_lineage(edges.withColumn("level", _level(near)).withColumn("edge", F.monotonically_increasing_id()), "nodes")
    kept = [c for c in edges.columns if c not in ("lo", "hi", "level", "edge")]
    vertices = edges.select(*keys, F.explode(F.array("lo", "hi")).alias("p")).distinct().select(*keys, "p.x", "p.y")
    size = F.pow(F.lit(2.0), F.col("level"))
    looking = vertices.join(_levels(edges, keys), list(keys)).withColumn("level", F.explode("levels")).drop("levels")
    looking = looking.withColumn("cx", F.floor(F.col("x") / size).cast("bigint")).withColumn("cy", F.floor(F.col("y") / size).cast("bigint"))
    met = looking.join(_cells(edges.select(*keys, "edge", "level", "lo", "hi"), near), [*keys, "level", "cx", "cy"])
    dx, dy = F.col("hi.x") - F.col("lo.x"), F.col("hi.y") - F.col("lo.y")
    px, py = F.col("x") - F.col("lo.x"), F.col("y") - F.col("lo.y")
    length = F.sqrt(dx * dx + dy * dy)
    along, off = (px * dx + py * dy) / length, F.abs(px * dy - py * dx) / length
    cuts = met.filter((off <= near) & (along > near) & (along < length - near)).select("edge", along.alias("along"), F.struct("x", "y").alias("p"))
    cuts = cut_lineage(cuts, "cuts")
    touched = edges.join(cuts.select("edge").distinct(), "edge", "left_semi")
    ends = touched.select("edge", F.explode(F.array(F.struct(F.lit(-1.0).alias("along"), F.col("lo").alias("p")), F.struct((length + 1).alias("along"), F.col("hi").alias("p")))).alias("s"))
    points = cuts.unionByName(ends.select("edge", "s.along", "s.p"))
    # cuts run from lo to hi, so pieces keep the direction of their edge
    pieces = points.withColumn("to", F.lead("p").over(Window.partitionBy("edge").orderBy("along"))).filter("to IS NOT NULL").select("edge", F.col("p").alias("lo"), F.col("to").alias("hi"))
    whole = edges.join(cuts.select("edge").distinct(), "edge", "left_anti").select(*kept, "lo", "hi")
    return whole.unionByName(touched.select("edge", *kept).join(pieces, "edge").select(*kept, "lo", "hi"))


def crossing_keys(edges: DataFrame, keys: Sequence[str], near: float) -> DataFrame:
    """The keys with two edges that cross, each with both ends more than ``near`` beside the other."""
    edges = edges.select(*keys, "lo", "hi").withColumn("level", _level(near))
    longer = _cells(edges, near).select(*keys, "level", "cx", "cy", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    looking = edges.join(_levels(edges, keys), list(keys)).withColumn("level", F.explode(F.filter("levels", lambda x: x >= F.col("level")))).drop("levels")
    pairs = _cells(looking, near).join(longer, [*keys, "level", "cx", "cy"])

    def beside(p: Column, a: Column, b: Column) -> Column:
        """The signed distance of p from the line through a and b."""
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        return ((p["x"] - a["x"]) * dy - (p["y"] - a["y"]) * dx) / F.sqrt(dx * dx + dy * dy)

    def apart(a: Column, b: Column, p: Column, q: Column) -> Column:
        one, other = beside(p, a, b), beside(q, a, b)
        return (one * other < 0) & (F.least(F.abs(one), F.abs(other)) > near)

    lo, hi, lo2, hi2 = (F.col(c) for c in ("lo", "hi", "lo2", "hi2"))
    return pairs.filter(apart(lo, hi, lo2, hi2) & apart(lo2, hi2, lo, hi)).select(*keys).distinct()


# --- chains -----------------------------------------------------------------------------------------------

_LINK = "id long, head long, least long, next long"


def contract_chains(links: DataFrame) -> DataFrame:
    """Of links (id, next), each id with the ``head`` of its chain: (id, head, least, next).

    Chains are runs of links that one batch of rows holds, so links near each other should come together. ``least`` is the smallest
    id of the chain; ``next``, on the head's row only, is the id after the chain's end, which is the head of another
    chain, or NULL if the chain is a whole ring.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ident, after = (batch.column(c).to_numpy() for c in ("id", "next"))
            n = len(ident)
            order = np.argsort(ident)
            at = np.minimum(np.searchsorted(ident[order], after), n - 1)
            there = order[at]  # where the next link is, if it is here
            here = ident[there] == after
            before = np.full(n, -1)
            before[there[here]] = np.flatnonzero(here)
            # each link looks twice as far back a round; only those of rings are still on the way after log2(n) rounds
            back, least = before.copy(), ident.copy()
            for _ in range(int(n).bit_length()):
                step = np.flatnonzero(back >= 0)
                least[step] = np.minimum(least[step], least[back[step]])
                back[step] = back[back[step]]
            ring = back >= 0
            first = _heads(before, ring & (least == ident))
            total = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(total, first, ident)
            last = np.full(n, -1, np.int64)
            ends = np.flatnonzero(~here & ~ring)
            last[first[ends]] = after[ends]
            is_head = first == np.arange(n)
            out = pa.array(last, mask=~is_head | ring)
            yield pa.RecordBatch.from_arrays([pa.array(ident), pa.array(ident[first]), pa.array(total[first]), out], ["id", "head", "least", "next"])

    return links.select("id", "next").mapInArrow(run, _LINK)


def _heads(before: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The place of each link's head: the first of its chain, or of its ring the link told by ``cut``."""
    place = np.arange(len(before))
    jump = np.where((before >= 0) & ~cut, before, place)
    while (jump[jump] != jump).any():
        jump = jump[jump]
    return jump
