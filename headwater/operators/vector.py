"""Vector layers: rows with a WKB column ``geom``.

Single geometries are handled in Arrow UDFs. Whole-layer work (dissolve, coverage simplification,
zone masks) turns polygons into edge rows and is done by Spark group-bys and joins on edges and
nodes, so one key or one watershed holding most of the layer is spread over all tasks. Only what
ends up in one output value (a ring, a polygon, an arc between two polygons) meets in one row.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions import geometry as G
from headwater.functions.projection import transform
from headwater.operators.noding import contract_chains, crossing_keys, split_at_vertices
from headwater.session import cut_lineage

DIGITS = 6  # coordinates are compared after rounding to this many decimals



def _doubles(*names: str) -> tuple[T.StructType, pa.DataType]:
    """A struct of doubles as Spark and as Arrow type."""
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names]), pa.struct([(n, pa.float64()) for n in names])


_EDGE_FIELDS = ("x1", "y1", "x2", "y2")
_EDGE, _EDGE_ARROW = _doubles(*_EDGE_FIELDS)
_NUMBERS, _NUMBERS_ARROW = _doubles("xmin", "ymin", "xmax", "ymax", "area", "centroid_x", "centroid_y")
_MEASURES = T.StructType([T.StructField("geometry_type", T.StringType()), *_NUMBERS.fields])
_MEASURES_ARROW = pa.struct([pa.field("geometry_type", pa.string()), *_NUMBERS_ARROW])


@F.arrow_udf(_MEASURES)
def _measures(geom: pa.Array) -> pa.Array:
    kinds, numbers = G.measures_of(geom)
    fields = [pa.array(kinds, type=pa.string()), *(pa.array(numbers[:, i]) for i in range(len(G.MEASURED)))]
    return pa.StructArray.from_arrays(fields, fields=list(_MEASURES_ARROW), mask=pa.array(np.equal(kinds, None)))


@F.arrow_udf(T.StringType())
def _flaw(geom: pa.Array) -> pa.Array:
    return pa.array(G.flaws_of(geom), type=pa.string())


def _or_none(form, wkb: bytes | None):
    """The geometry in another form; None if it cannot be read or has none there."""
    try:
        return None if wkb is None else form(wkb)
    except (G.Bad, struct.error, IndexError, ValueError):
        return None


@F.arrow_udf(T.StringType())
def _wkt(geom: pa.Array) -> pa.Array:
    return pa.array([_or_none(G.wkt, g) for g in geom.to_pylist()], type=pa.string())


@F.arrow_udf(T.StringType())
def _geojson(geom: pa.Array) -> pa.Array:
    return pa.array([None if (d := _or_none(G.geojson, g)) is None else json.dumps(d) for g in geom.to_pylist()], type=pa.string())


def box_polygon(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """WKB of a rectangle."""

    @F.arrow_udf(T.BinaryType())
    def build(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        return G.boxes_wkb(a, b, c, d)

    return build(xmin, ymin, xmax, ymax)


def point(x: Column, y: Column) -> Column:
    """WKB of a point."""

    @F.arrow_udf(T.BinaryType())
    def build(a: pa.Array, b: pa.Array) -> pa.Array:
        return G.points_wkb(a, b)

    return build(x, y)


def as_wkt(geom: Column) -> Column:
    return _wkt(geom)


# --- measures and checks ----------------------------------------------------------------------

def layer_measures(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Add geometry type, ``bbox`` struct, area and centroid; unreadable geometries get NULL."""
    out = df.withColumn("__m", _measures(F.col(geom)))
    box = F.struct(*[F.col(f"__m.{c}").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    return out.withColumns({
        "geometry_type": F.col("__m.geometry_type"),
        "bbox": F.when(F.col("__m").isNotNull(), box),
        "area": F.col("__m.area"),
        "centroid_x": F.col("__m.centroid_x"),
        "centroid_y": F.col("__m.centroid_y"),
    }).drop("__m")


def measures_by(df: DataFrame, by: Sequence[str], geom: str = "geom") -> DataFrame:
    """Measures rolled up per key: features, area, bbox and the area-weighted centroid."""
    m = layer_measures(df, geom)
    return m.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum("area").alias("area"),
        F.min("bbox.xmin").alias("xmin"),
        F.min("bbox.ymin").alias("ymin"),
        F.max("bbox.xmax").alias("xmax"),
        F.max("bbox.ymax").alias("ymax"),
        F.try_divide(F.sum(F.col("area") * F.col("centroid_x")), F.sum("area")).alias("centroid_x"),
        F.try_divide(F.sum(F.col("area") * F.col("centroid_y")), F.sum("area")).alias("centroid_y"),
    )


def geometry_profile(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row: NULL, empty and invalid counts, total bounds, and warnings about the bounds."""
    m = df.select(F.col(geom).alias("g"), _flaw(F.col(geom)).alias("flaw"), _measures(F.col(geom)).alias("m"))
    return m.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("g").isNull()).alias("n_null"),
        F.count_if(F.col("flaw") == "empty").alias("n_empty"),
        F.count_if(F.col("flaw").isNotNull() & (F.col("flaw") != "empty")).alias("n_invalid"),
        F.min("m.xmin").alias("xmin"),
        F.min("m.ymin").alias("ymin"),
        F.max("m.xmax").alias("xmax"),
        F.max("m.ymax").alias("ymax"),
    ).withColumns({
        "non_finite": F.coalesce(F.isnan("xmin") | F.isnan("ymin") | F.isnan("xmax") | F.isnan("ymax"), F.lit(False)),
        "zero_area": F.coalesce((F.col("xmin") == F.col("xmax")) | (F.col("ymin") == F.col("ymax")), F.lit(False)),
    })


def invalid_geometries(df: DataFrame, key: str, geom: str = "geom", limit: int = 5) -> DataFrame:
    """The first invalid features with the reason."""
    return df.select(key, _flaw(F.col(geom)).alias("flaw")).filter(F.col("flaw").isNotNull() & (F.col("flaw") != "empty")).orderBy(key).limit(limit)


def reproject_layer(df: DataFrame, src: int, dst: int, geom: str = "geom") -> DataFrame:
    """The layer in another coordinate system (EPSG codes), which is recorded in the column metadata."""
    project = transform(src, dst)

    @F.arrow_udf(T.BinaryType())
    def move(column: pa.Array) -> pa.Array:
        return G.map_all_points(column, project)

    return df.withColumn(geom, move(F.col(geom)).alias(geom, metadata={"crs": f"EPSG:{dst}"}))


# --- edges ------------------------------------------------------------------------------------

def _edge_arrays(digits: int | None):
    @F.arrow_udf(T.ArrayType(_EDGE))
    def split(geom: pa.Array) -> pa.Array:
        offsets, table = G.edges_of(geom, digits)
        edges = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(4)], names=list(_EDGE_FIELDS))
        return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), edges)

    return split


def _lists(column: pa.ListArray, names: Sequence[str]) -> Iterator[np.ndarray]:
    """The number fields of each list of structs as a table."""
    offsets = column.offsets.to_numpy()
    values = column.values
    table = np.column_stack([values.field(n).to_numpy(zero_copy_only=False) for n in names])
    for start, stop in zip(offsets[:-1], offsets[1:]):
        yield table[start:stop]


def _pack(points: np.ndarray) -> bytes:
    """A line or ring as plain bytes: little-endian coordinate pairs."""
    return np.ascontiguousarray(points, dtype="<f8").tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<f8").reshape(-1, 2)


def explode_edges(df: DataFrame, columns: Sequence[str], geom: str = "geom", digits: int = DIGITS) -> DataFrame:
    """One row per polygon edge, interior on the left."""
    return df.select(*columns, _edge_arrays(digits)(F.col(geom)).alias("e")).select(*columns, F.inline("e"))


def _undirected(edges: DataFrame) -> DataFrame:
    """Add the edge's smaller end ``lo``, larger end ``hi`` and its direction between them."""
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    return edges.select(*[c for c in edges.columns if c not in ("x1", "y1", "x2", "y2")], F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), F.when(a < b, 1).otherwise(-1).alias("dir"))


def outline_edges(df: DataFrame, keys: Sequence[str], geom: str = "geom", digits: int = DIGITS) -> DataFrame:
    """Edges on the outline of each key's union: those not run both ways by polygons of the key.

    Borders that two polygons run with different vertices are cut at the vertices of both first; only edges that are still open after the
    first count take part, so inner borders that match are gone by then. ``overlap`` marks edges that several polygons run
    the same way.
    """
    ways = F.count_if(F.col("dir") > 0).alias("forward"), F.count_if(F.col("dir") < 0).alias("back")
    sides = _undirected(explode_edges(df, keys, geom, digits)).groupBy(*keys, "lo", "hi").agg(*ways)
    pieces = split_at_vertices(sides.filter("forward <> back OR forward > 1"), keys, _near(digits))
    # a vertex a little beside an edge can turn the order of a piece's ends
    turned = F.col("lo") > F.col("hi")
    swap = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x))
    pieces = pieces.select(*keys, *(swap(x, y).alias(x) for x, y in (("lo", "hi"), ("hi", "lo"), ("forward", "back"), ("back", "forward"))))
    net = pieces.groupBy(*keys, "lo", "hi").agg(F.sum("forward").alias("forward"), F.sum("back").alias("back"))
    forward = F.col("forward") > F.col("back")
    a, b = F.when(forward, F.col("lo")).otherwise(F.col("hi")), F.when(forward, F.col("hi")).otherwise(F.col("lo"))
    overlap = F.greatest("forward", "back") > 1
    return net.filter((F.col("forward") != F.col("back")) | overlap).select(*keys, a.alias("a"), b.alias("b"), overlap.alias("overlap"))


def _near(digits: int) -> float:
    """How far a vertex may lie beside an edge that it cuts: rounding moves it by no more."""
    return 10.0**-digits


#: Edges of mean length that a cell of the chain contraction is wide.
CHAIN_CELL = 512


def _ring_labels(outline: DataFrame, keys: Sequence[str], digits: int) -> tuple[DataFrame, DataFrame]:
    """Number the loops of the outline edges: adds ``id`` and the loop's smallest edge id, ``ring``.

    Also returns the keys with overlapping polygons, whose edges are left out: some polygons run an edge the same way, or
    edges cross.

    Every edge first finds the next edge of its loop: of the edges leaving its end the first one
    met when turning clockwise from the way back, which keeps areas that touch in a point apart.
    Runs of edges that are near each other are contracted to chains inside the tasks. Then each chain looks twice as far
    along its loop per round, so the rounds grow with the logarithm of the most chains of a loop; only
    chains are written to the shared folder.
    """
    edges = cut_lineage(outline.withColumn("id", F.monotonically_increasing_id()), "edges")
    crossing = crossing_keys(edges.select(*keys, F.col("a").alias("lo"), F.col("b").alias("hi")), keys, 2 * _near(digits))
    overlapping = cut_lineage(edges.filter("overlap").select(*keys).unionByName(crossing).distinct(), "overlapping")
    edges = edges.join(overlapping, list(keys), "left_anti")
    angle = lambda p, q: F.atan2(q["y"] - p["y"], q["x"] - p["x"])
    a, b = F.col("a"), F.col("b")
    leaving = edges.groupBy(*keys, a.alias("node")).agg(F.collect_list(F.struct(angle(a, b).alias("angle"), "id")).alias("leaving"))
    arriving = edges.select(*keys, b.alias("node"), "id", angle(b, a).alias("back"))
    two_pi = 2 * np.pi

    def turn(option: Column) -> Column:
        clockwise = F.pmod(F.col("back") - option["angle"], F.lit(two_pi))
        return F.struct(F.when(clockwise < 1e-12, two_pi).otherwise(clockwise).alias("turn"), option["id"].alias("id"))

    size = edges.agg(F.avg(F.hypot(b["x"] - a["x"], b["y"] - a["y"]))).first()[0] or 1.0
    place = lambda c: F.floor(F.col(f"node.{c}") / (size * CHAIN_CELL)).cast("bigint")
    links = arriving.join(leaving, [*keys, "node"]).select("id", F.array_min(F.transform("leaving", turn))["id"].alias("next"), place("x").alias("cx"), place("y").alias("cy"))
    chained = cut_lineage(contract_chains(links.repartition("cx", "cy").sortWithinPartitions("cx", "cy", "id")), "chains")
    state = chained.filter("next IS NOT NULL").select("id", "next", F.col("least").alias("ring"))
    moved = 1
    while moved:
        # the count of changed labels rides along with the write
        seen = Observation()
        ahead = state.select(F.col("id").alias("next"), F.col("next").alias("after"), F.col("ring").alias("ring_ahead"))
        looked = state.join(ahead, "next").observe(seen, F.count_if(F.col("ring_ahead") < F.col("ring")).alias("n"))
        state = cut_lineage(looked.select("id", F.col("after").alias("next"), F.least("ring", "ring_ahead").alias("ring")), "rings")
        moved = seen.get["n"]
    found = chained.join(state.select(F.col("id").alias("head"), "ring"), "head", "left").select("id", F.coalesce("ring", "least").alias("ring"))
    return edges.join(found, "id").drop("overlap"), overlapping


_RING_NUMBERS, _RING_NUMBERS_ARROW = _doubles("signed_area", "px", "py", "xmin", "ymin", "xmax", "ymax")
_RING = T.StructType([T.StructField("ring", T.BinaryType()), *_RING_NUMBERS.fields])
_RING_ARROW = pa.struct([pa.field("ring", pa.binary()), *_RING_NUMBERS_ARROW])


@F.arrow_udf(T.ArrayType(_RING))
def _assemble(edges: pa.Array) -> pa.Array:
    """The simple rings of each loop; ``px``, ``py`` is the middle of an edge."""
    out = []
    for table in _lists(edges, _EDGE_FIELDS):
        rings = []
        try:
            walked = G.walk_rings(table)
        except G.Bad:
            walked = []
        for ring in walked:
            px, py = (ring[0] + ring[1]) / 2
            (xmin, ymin), (xmax, ymax) = ring.min(axis=0), ring.max(axis=0)
            rings.append({"ring": _pack(ring), "signed_area": G.signed_area(ring), "px": px, "py": py, "xmin": xmin, "ymin": ymin, "xmax": xmax, "ymax": ymax})
        out.append(rings)
    return pa.array(out, type=pa.list_(_RING_ARROW))


def _loops(df: DataFrame, keys: Sequence[str], geom: str, digits: int) -> tuple[DataFrame, DataFrame]:
    """Loops of each key's outline (keys, ``loop``, ``rings``, ``area``, ``home``), and the keys whose polygons overlap.

    A loop with positive area is the border of a part: its one shell and the holes that touch it. Any other loop is holes, and ``home``
    is the loop they lie in: the smallest around them. Keys overlap too if a loop has several shells, a part lies inside another or
    a hole outside of all.
    """
    labeled, overlapping = _ring_labels(outline_edges(df, keys, geom, digits), keys, digits)
    edge = F.struct(F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))
    rings = labeled.groupBy(*keys, F.col("ring").alias("loop")).agg(F.collect_list(edge).alias("edges")).select(*keys, "loop", _assemble("edges").alias("rings"))
    total = F.aggregate("rings", F.lit(0.0), lambda s, r: s + r["signed_area"])
    loops = cut_lineage(rings.withColumn("area", total), "loops")
    around = _windings(loops, labeled, keys)
    shells = F.size(F.filter("rings", lambda r: r["signed_area"] > 0))
    placed = loops.join(around, [*keys, "loop"], "left").withColumn("inside", F.coalesce("inside", F.lit(0)))
    right = F.when(F.col("area") > 0, (F.col("inside") == 0) & (shells == 1)).otherwise((F.col("inside") == 1) & (shells == 0) & (F.size("rings") > 0))
    placed = cut_lineage(placed.withColumn("right", right).drop("inside"), "placed")
    flawed = overlapping.unionByName(placed.filter("NOT right").select(*keys)).distinct()
    return placed.join(flawed, list(keys), "left_anti").drop("right"), flawed


def _windings(loops: DataFrame, labeled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each loop inside others: how many parts less holes are around it (``inside``), and the smallest part (``home``).

    A point of the loop is tried against the loops whose box holds it, found in grid cells by size class. Edges that a ray from the point to
    the right crosses upwards count 1, downwards -1, summed per pair of loops; points meet edges in bands of each loop's
    height, as high as its edges are on average. No ring is moved.
    """
    box = {c: f(f"rings.{c}") for c, f in (("xmin", F.array_min), ("ymin", F.array_min), ("xmax", F.array_max), ("ymax", F.array_max))}
    shapes = loops.filter(F.size("rings") > 0).select(*keys, "loop", "area", F.col("rings")[0]["px"].alias("px"), F.col("rings")[0]["py"].alias("py"), *(c.alias(n) for n, c in box.items()))
    rise = F.abs(F.col("b.y") - F.col("a.y"))
    bands = labeled.groupBy(*keys, F.col("ring").alias("outer")).agg((2 * F.avg(rise)).alias("high"))
    level = F.ceil(F.log2(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")))).cast("int")
    boxes = shapes.select(*keys, F.col("loop").alias("outer"), F.col("area").alias("outer_area"), "xmin", "ymin", "xmax", "ymax").withColumn("level", level)
    cell = lambda c: F.floor(c / F.pow(F.lit(2.0), F.col("level"))).cast("bigint")
    listed = boxes.withColumn("cx", F.explode(F.sequence(cell(F.col("xmin")), cell(F.col("xmax")))))
    listed = listed.withColumn("cy", F.explode(F.sequence(cell(F.col("ymin")), cell(F.col("ymax")))))
    # one row per size class, some tens in all
    levels = boxes.groupBy(*keys).agg(F.collect_set("level").alias("levels"))
    looking = shapes.select(*keys, "loop", "px", "py").join(levels, list(keys)).withColumn("level", F.explode("levels")).drop("levels")
    looking = looking.withColumn("cx", cell(F.col("px"))).withColumn("cy", cell(F.col("py")))
    boxed = F.col("px").between(F.col("xmin"), F.col("xmax")) & F.col("py").between(F.col("ymin"), F.col("ymax")) & (F.col("loop") != F.col("outer"))
    pairs = looking.join(listed, [*keys, "level", "cx", "cy"]).filter(boxed).select(*keys, "loop", "px", "py", "outer", "outer_area")
    band = lambda y: F.floor(y / F.col("high")).cast("bigint")
    pairs = pairs.join(bands, [*keys, "outer"]).withColumn("band", band(F.col("py"))).drop("high")
    low, top = F.least("a.y", "b.y"), F.greatest("a.y", "b.y")
    edges = labeled.withColumnRenamed("ring", "outer").join(bands, [*keys, "outer"]).filter(low < top)
    edges = edges.select(*keys, "outer", "a", "b", F.explode(F.sequence(band(low), band(top))).alias("band"))
    a, b = F.col("a"), F.col("b")
    crossed = (a["y"] <= F.col("py")) != (b["y"] <= F.col("py"))
    right = F.col("px") < a["x"] + (F.col("py") - a["y"]) / (b["y"] - a["y"]) * (b["x"] - a["x"])
    hits = pairs.join(edges, [*keys, "outer", "band"]).filter(crossed & right)
    each = hits.groupBy(*keys, "loop", "outer", "outer_area").agg(F.sum(F.when(b["y"] > a["y"], 1).otherwise(-1)).alias("turns"))
    home = F.when((F.col("turns") > 0) & (F.col("outer_area") > 0), F.struct("outer_area", "outer"))
    return each.groupBy(*keys, "loop").agg(F.sum("turns").alias("inside"), F.min(home)["outer"].alias("home"))


@F.arrow_udf(T.BinaryType())
def _polygon(shell: pa.Array, holes: pa.Array) -> pa.Array:
    rows = zip(shell.to_pylist(), holes.to_pylist())
    return pa.array([G.polygon_wkb([_unpack(s), *sorted(map(_unpack, h or []), key=lambda r: tuple(r[0]))]) for s, h in rows], type=pa.binary())


def dissolve(df: DataFrame, keys: Sequence[str], single_part: bool = False, geom: str = "geom", digits: int = DIGITS) -> DataFrame:
    """Union of the polygons of each key, for coverages: one row per connected part.

    Borders may have different vertices on both sides. ``part_count`` says how many parts the key has; ``single_part`` keeps
    keys with one part only. NULL is a key like others. Keys with polygons that overlap, whether they share edges, cross or lie inside
    each other, are reported as one row with ``overlap`` and no geometry.
    """
    parts = _dissolve(df.select(F.struct(*keys).alias("__key"), geom), ["__key"], single_part, geom, digits)
    return parts.select("__key.*", *[c for c in parts.columns if c != "__key"])


def _dissolve(df: DataFrame, keys: Sequence[str], single_part: bool, geom: str, digits: int) -> DataFrame:
    """:func:`dissolve` by one struct, whose fields may be NULL and still join."""
    loops, flawed = _loops(df, keys, geom, digits)
    negative = F.transform(F.filter("rings", lambda r: r["signed_area"] < 0), lambda r: r["ring"])
    shell = F.filter("rings", lambda r: r["signed_area"] > 0)[0]["ring"]
    shells = loops.filter("area > 0").select(*keys, "loop", shell.alias("shell"), negative.alias("own"), "area")
    held = loops.filter("area <= 0").select(*keys, F.col("home").alias("loop"), negative.alias("holes"), F.col("area").alias("hole_area"))
    held = held.groupBy(*keys, "loop").agg(F.flatten(F.collect_list("holes")).alias("holes"), F.sum("hole_area").alias("hole_area"))
    counts = shells.groupBy(*keys).agg(F.count(F.lit(1)).alias("part_count"))
    parts = shells.join(held, [*keys, "loop"], "left").join(counts, list(keys))
    if single_part:
        parts = parts.filter("part_count = 1")
    every = F.concat("own", F.coalesce("holes", F.array().cast("array<binary>")))
    whole = parts.select(
        *keys,
        "part_count",
        F.lit(False).alias("overlap"),
        (F.col("area") + F.coalesce("hole_area", F.lit(0.0))).alias("area"),
        F.size(every).alias("hole_count"),
        _polygon(F.col("shell"), every).alias(geom),
    )
    return whole.unionByName(flawed.withColumn("overlap", F.lit(True)), allowMissingColumns=True)


def dissolved_counts(df: DataFrame, keys: Sequence[str], geom: str = "geom") -> DataFrame:
    """How many keys dissolve to one part and how many to several; keys with overlaps are ``n_overlapping``."""
    loops, flawed = _loops(df.select(F.struct(*keys).alias("__key"), geom), ["__key"], geom, DIGITS)
    per_key = loops.filter("area > 0").groupBy("__key").agg(F.count(F.lit(1)).alias("parts"))
    per_key = per_key.unionByName(flawed.withColumn("parts", F.lit(0).cast("long")))
    return per_key.agg(
        F.count_if(F.col("parts") > 0).alias("n_keys"), F.count_if(F.col("parts") == 1).alias("n_single"),
        F.count_if(F.col("parts") > 1).alias("n_multi"), F.count_if(F.col("parts") == 0).alias("n_overlapping"),
    )


def bounds_rollup(df: DataFrame, keys: Sequence[str], geom: str = "geom", tolerance: float | None = None, feature: str | None = None) -> DataFrame:
    """Outline parts of each key's polygons with the key's bounding box and area-weighted centroid.

    With a ``tolerance`` the coverage is simplified first; ``feature`` is its unique id then.
    """
    layer = df
    if tolerance is not None:
        if feature is None:
            raise ValueError("simplifying needs the feature id column")
        layer = simplify_coverage(df, feature, tolerance, keys, geom).withColumn(geom, F.col(f"{geom}_simplified"))
    totals = measures_by(df, keys, geom).drop("area", "n_features")
    return dissolve(layer, keys, geom=geom).join(totals, list(keys))


# --- coverage simplification ------------------------------------------------------------------

def _arc_udf(min_area: float):
    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def arcs(edges: pa.Array) -> pa.Array:
        out = []
        for table in _lists(edges, (*_EDGE_FIELDS, "ja", "jb")):
            after: dict[tuple, list[tuple]] = {}
            stops = set()
            for x1, y1, x2, y2, ja, jb in table.tolist():
                after.setdefault((x1, y1), []).append((x2, y2))
                if ja:
                    stops.add((x1, y1))
                if jb:
                    stops.add((x2, y2))
            lines = []
            # open arcs start at junctions, what then is left are closed lines without one
            for start in [*sorted(p for p in after if p in stops), *sorted(p for p in after if p not in stops)]:
                while after[start]:
                    line = [start]
                    while True:
                        line.append(after[line[-1]].pop())
                        if line[-1] in stops or line[-1] == start:
                            break
                    # both neighbours run an arc in opposite directions but must see the same one
                    flip = line[0] > line[-1]
                    points = np.array(line[::-1] if flip else line)
                    kept = G.simplify_line(points, min_area, line[0] == line[-1])
                    lines.append(_pack(kept[::-1] if flip else kept))
            out.append(lines)
        return pa.array(out, type=pa.list_(pa.binary()))

    return arcs


@F.arrow_udf(T.BinaryType())
def _rebuild(arcs: pa.Array) -> pa.Array:
    out = []
    for listed in arcs.to_pylist():
        lines = [_unpack(item["arc"])[:: -1 if item["back"] else 1] for item in listed]
        try:
            walked = G.walk_rings(np.concatenate([np.hstack([line[:-1], line[1:]]) for line in lines]))
        except G.Bad:
            out.append(None)
            continue
        # rings that simplification has folded flat have no area
        rings = [r for r in walked if len(r) > 3]
        shells = sorted((r for r in rings if G.signed_area(r) > 0), key=G.signed_area)
        parts: list[list[np.ndarray]] = [[s] for s in shells]
        for hole in (r for r in rings if G.signed_area(r) <= 0):
            x, y = G.inner_point(hole)
            home = next((p for p in parts if G.contains(p[0], x, y)), None)
            if home is not None:
                home.append(hole)
        parts.sort(key=lambda p: tuple(p[0][0]))
        out.append(G.multipolygon_wkb(parts) if parts else None)
    return pa.array(out, type=pa.binary())


def coverage_arcs(df: DataFrame, key: str, tolerance: float, within: Sequence[str] = (), geom: str = "geom", digits: int = DIGITS) -> DataFrame:
    """Simplified arcs of a polygon coverage, each shared border once: (within, owner, other, arc).

    Arcs are packed coordinate pairs. ``owner`` runs the arc with its interior on the left; ``other`` is the polygon across, or NULL.
    """
    sides = _undirected(explode_edges(df, [*within, key], geom, digits))
    feature = F.col(key)
    borders = sides.groupBy(*within, "lo", "hi").agg(
        F.min(F.struct(feature.alias("id"), "dir")).alias("first"), F.max(feature).alias("last"), F.count(F.lit(1)).alias("n")
    )
    # a node where other than two borders meet ends arcs
    ends = borders.select(*within, F.explode(F.array("lo", "hi")).alias("node"))
    junctions = ends.groupBy(*within, "node").agg(F.count(F.lit(1)).alias("degree")).filter("degree <> 2")
    at = lambda end: junctions.select(*within, F.col("node").alias(end), F.lit(True).alias(f"j_{end}"))
    flagged = borders.join(at("lo"), [*within, "lo"], "left").join(at("hi"), [*within, "hi"], "left")
    forward = F.col("first.dir") > 0
    pick = lambda x, y: F.when(forward, x).otherwise(y)
    j_lo, j_hi = F.coalesce("j_lo", F.lit(False)), F.coalesce("j_hi", F.lit(False))
    lo, hi = F.col("lo"), F.col("hi")
    ends_of = {"x1": pick(lo["x"], hi["x"]), "y1": pick(lo["y"], hi["y"]), "x2": pick(hi["x"], lo["x"]), "y2": pick(hi["y"], lo["y"])}
    edge = F.struct(*[c.alias(n) for n, c in ends_of.items()], pick(j_lo, j_hi).cast("double").alias("ja"), pick(j_hi, j_lo).cast("double").alias("jb"))
    owner, other = F.col("first.id"), F.when(F.col("n") > 1, F.col("last"))
    # the edges two polygons share: no more than one polygon has
    pairs = flagged.groupBy(*within, owner.alias("owner"), other.alias("other")).agg(F.collect_list(edge).alias("edges"))
    return pairs.select(*within, "owner", "other", F.explode(_arc_udf(tolerance * tolerance)(F.col("edges"))).alias("arc"))


def simplify_coverage(df: DataFrame, key: str, tolerance: float, within: Sequence[str] = (), geom: str = "geom", digits: int = DIGITS) -> DataFrame:
    """The layer with ``<geom>_simplified``, shared borders staying shared.

    Borders are cut at the nodes where other than two meet and each piece is simplified once, by
    Visvalingam–Whyatt with triangles below ``tolerance`` squared removed; cut nodes stay. Features
    that overlap others along borders, so that their arcs do not close, get no simplified geometry.
    NULL groups are groups like others.
    """
    # one struct, so that NULL groups join like others; the single field keeps an empty list a struct
    group = F.struct(F.lit(0).alias("__"), *within)
    df = df.withColumn("__group", group)
    arcs = coverage_arcs(df, key, tolerance, ["__group"], geom, digits)
    within = ["__group"]
    side = lambda who, back: F.struct(F.col(who).alias("who"), F.lit(back).alias("back"))
    sides = arcs.select(*within, "arc", F.explode(F.array(side("owner", False), side("other", True))).alias("s")).filter("s.who IS NOT NULL")
    rebuilt = sides.groupBy(*within, F.col("s.who").alias(key)).agg(F.collect_list(F.struct("arc", "s.back")).alias("arcs")).select(*within, key, _rebuild(F.col("arcs")).alias(f"{geom}_simplified"))
    return df.join(rebuilt, [*within, key], "left").drop("__group")


# --- zones ------------------------------------------------------------------------------------

def zone_cells(polygons: DataFrame, headers: DataFrame, key: str, attribute: str | None = None, geom: str = "geom") -> DataFrame:
    """Raster cells each polygon touches: (raster_id, key, [attribute], r, c).

    Polygons carry ``raster_id``. Their edges are dealt by raster row, so one polygon over a whole raster is worked on by many
    tasks and is not copied to any. An edge marks the cells it passes through; where edges cross the middle of a row, the cells
    whose middle lies between an odd crossing and the next are inside. Overlapping polygons each give their cells, a repeated row
    gives them once; unreadable geometries, other types than polygons and edges without finite ends give none.
    """
    fields = list(dict.fromkeys(["raster_id", key, *([attribute] if attribute else [])]))
    head = ["left_x", "top_y", "cell_width", "cell_height", "n_rows", "n_cols"]
    shapes = polygons.select(*fields, F.xxhash64(geom).alias("__shape"), _edge_arrays(None)(F.col(geom)).alias("__edges")).join(headers.select("raster_id", *head), "raster_id")
    sides = shapes.select(*fields, "__shape", *head, F.posexplode("__edges").alias("__side", "e"))
    place = lambda at, origin, size: (F.col(f"e.{at}") - F.col(origin)) / F.col(size)
    sides = sides.select(
        *fields, "__shape", "__side", "n_rows", "n_cols",
        place("x1", "left_x", "cell_width").alias("c1"), place("y1", "top_y", "cell_height").alias("r1"),
        place("x2", "left_x", "cell_width").alias("c2"), place("y2", "top_y", "cell_height").alias("r2"),
    )
    # NaN is above every number
    for end in ("c1", "r1", "c2", "r2"):
        sides = sides.filter(F.abs(end) < 1e15)
    top, bottom = F.greatest(F.floor(F.least("r1", "r2")), F.lit(0)), F.least(F.ceil(F.greatest("r1", "r2")), F.col("n_rows")) - 1
    rows = sides.filter(top <= bottom).withColumn("r", F.explode(F.sequence(top.cast("int"), bottom.cast("int"))))

    slope = F.coalesce(F.try_divide(F.col("c2") - F.col("c1"), F.col("r2") - F.col("r1")), F.lit(0.0))
    within = lambda at: F.least(F.greatest(F.col(at), F.col("r")), F.col("r") + 1)
    at_row = lambda y, level: F.when(F.col("r1") == F.col("r2"), level).otherwise(F.col("c1") + (y - F.col("r1")) * F.col("slope"))
    middle = F.col("r") + 0.5
    rows = rows.withColumn("slope", slope)
    rows = rows.withColumns({"a": at_row(within("r1"), F.col("c1")), "b": at_row(within("r2"), F.col("c2"))})
    left, right = F.least("a", "b"), F.greatest("a", "b")
    # an upright edge on a column line touches neither neighbour by itself
    passed = ~((left == right) & (left == F.floor(left)))
    run = lambda first, last: F.struct(first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))
    rows = rows.select(
        *fields, "__shape", "__side", "r", "n_cols",
        F.when(passed, run(F.floor(left), F.greatest(F.ceil(right) - 1, F.floor(left)))).alias("touched"),
        F.when((F.col("r1") > middle) != (F.col("r2") > middle), at_row(middle, F.lit(None))).alias("cut"),
    )
    one_row = [*fields, "__shape", "r"]
    dealt = rows.repartition(*one_row).distinct()

    along = Window.partitionBy(*one_row).orderBy("cut", "__side")
    numbered = dealt.withColumns({"nth": F.count("cut").over(along.rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("cut").over(along)})
    inside = F.when(F.col("cut").isNotNull() & (F.col("nth") % 2 == 1), run(F.ceil(F.col("cut") - 0.5), F.floor(F.col("next") - 0.5)))
    runs = numbered.select(*one_row, "n_cols", F.explode(F.array("touched", inside)).alias("x")).select(*one_row, F.greatest("x.first", F.lit(0)).alias("first"), F.least(F.col("x.last"), F.col("n_cols") - 1).alias("last"), "x")
    runs = runs.filter(F.col("x").isNotNull() & (F.col("first") <= F.col("last"))).drop("x")
    # of runs that overlap, each gives the cells past those before it
    before = F.max("last").over(Window.partitionBy(*one_row).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("from", F.greatest("first", before + 1)).filter("from <= last")
    return runs.select(*fields, "r", F.explode(F.sequence(F.col("from").cast("int"), F.col("last").cast("int"))).alias("c"))


def zone_mask(cells: DataFrame, polygons: DataFrame, headers: DataFrame, key: str, attribute: str | None = None, geom: str = "geom") -> DataFrame:
    """Cells with the polygons touching them (and the polygon's attribute)."""
    return cells.join(zone_cells(polygons, headers, key, attribute, geom), ["raster_id", "r", "c"])


# --- export -----------------------------------------------------------------------------------

def feature_collections(df: DataFrame, by: str, key: str, geom: str = "geom", properties: Sequence[str] = (), chunk: int = 1000) -> DataFrame:
    """GeoJSON FeatureCollections with bbox per group, in numbered parts of about ``chunk`` features."""
    sizes = df.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / chunk).alias("part_count"))
    props = F.to_json(F.struct(F.col(key), *[F.col(p) for p in properties]))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), F.coalesce(_geojson(F.col(geom)), F.lit("null")), F.lit("}"))
    rows = df.select(by, key, feature.alias("feature"), _measures(F.col(geom)).alias("m")).join(sizes, by).withColumn("part", F.pmod(F.xxhash64(key), F.col("part_count")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct(key, "feature"))), lambda x: x["feature"])
    box = F.array(F.min("m.xmin"), F.min("m.ymin"), F.max("m.xmax"), F.max("m.ymax"))
    document = F.concat(F.lit('{"type":"FeatureCollection","bbox":'), F.to_json(box), F.lit(',"features":['), F.array_join(listed, ","), F.lit("]}"))
    return rows.groupBy(by, "part", "part_count").agg(F.count(F.lit(1)).alias("n_features"), document.alias("document"))


def wkt_table(df: DataFrame, geom: str = "geom") -> DataFrame:
    """The layer with text geometries; NULL for what cannot be read or is a mixed collection."""
    return df.withColumn(geom, _wkt(F.col(geom)))
