"""NumPy helpers for geometries: WKB in and out, rings, simplification.

They run inside Arrow UDFs; everything that spans features is done by Spark joins and group-bys. The functions at the end take a
batch of geometries: plain polygons go through NumPy together, others one by one through the functions before.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

NAMES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}


class Bad(ValueError):
    """Not a readable geometry."""


def scan(wkb: bytes) -> list[tuple[int, int, int, int, str]]:
    """Coordinate runs of a WKB as (geometry type, ring number, offset, points, numpy dtype).

    Polygon shells have ring number 0, their holes 1, 2 …
    """
    runs: list[tuple[int, int, int, int, str]] = []

    def read(at: int) -> int:
        order = "<" if wkb[at] == 1 else ">"
        (kind,) = struct.unpack_from(order + "I", wkb, at + 1)
        at += 5
        if kind & 0x20000000:  # EWKB with SRID
            at += 4
        has_z = bool(kind & 0x80000000) or (kind & 0xFFFF) // 1000 in (1, 3)
        has_m = bool(kind & 0x40000000) or (kind & 0xFFFF) // 1000 in (2, 3)
        base, dims = (kind & 0xFFFF) % 1000, 2 + has_z + has_m
        dtype = f"{order}f8:{dims}"

        def run(at: int, ring: int, n: int) -> int:
            end = at + 8 * dims * n
            if end > len(wkb):
                raise Bad("geometry is cut short")
            runs.append((base, ring, at, n, dtype))
            return end

        if base == 1:
            return run(at, 0, 1)
        (n,) = struct.unpack_from(order + "I", wkb, at)
        at += 4
        if base == 2:
            return run(at, 0, n)
        if base == 3:
            for ring in range(n):
                (m,) = struct.unpack_from(order + "I", wkb, at)
                at = run(at + 4, ring, m)
            return at
        if base in (4, 5, 6, 7):
            for _ in range(n):
                at = read(at)
            return at
        raise Bad(f"geometry type {kind} is not supported")

    try:
        read(0)
    except (struct.error, IndexError) as exc:
        raise Bad("geometry is cut short") from exc
    return runs


def kind_of(wkb: bytes) -> str:
    order = "<" if wkb[0] == 1 else ">"
    (kind,) = struct.unpack_from(order + "I", wkb, 1)
    return NAMES.get((kind & 0xFFFF) % 1000, "Unknown")


def points_of(wkb: bytes, offset: int, n: int, dtype: str) -> np.ndarray:
    code, dims = dtype.split(":")
    return np.frombuffer(wkb, dtype=code, count=n * int(dims), offset=offset).reshape(n, int(dims))[:, :2].astype("f8")


def polygons_of(wkb: bytes) -> list[list[np.ndarray]]:
    """Polygons as lists of closed rings, shell first; other geometry types give none."""
    out: list[list[np.ndarray]] = []
    for kind, ring, offset, n, dtype in scan(wkb):
        if kind == 3:
            points = points_of(wkb, offset, n, dtype)
            if ring == 0:
                out.append([])
            if n:
                out[-1].append(points)
    return [rings for rings in out if rings]


def map_points(wkb: bytes, project: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> bytes:
    """The same geometry with every coordinate pair projected."""
    out = bytearray(wkb)
    for _, _, offset, n, dtype in scan(wkb):
        code, dims = dtype.split(":")
        flat = np.frombuffer(out, dtype=code, count=n * int(dims), offset=offset).reshape(n, int(dims)).copy()
        x, y = project(flat[:, 0].astype("f8"), flat[:, 1].astype("f8"))
        flat[:, 0], flat[:, 1] = x, y
        out[offset : offset + flat.nbytes] = flat.tobytes()
    return bytes(out)


def polygon_wkb(rings: list[np.ndarray]) -> bytes:
    parts = [struct.pack("<BII", 1, 3, len(rings))]
    for ring in rings:
        parts += [struct.pack("<I", len(ring)), np.ascontiguousarray(ring, dtype="<f8").tobytes()]
    return b"".join(parts)


def multipolygon_wkb(polygons: list[list[np.ndarray]]) -> bytes:
    if len(polygons) == 1:
        return polygon_wkb(polygons[0])
    return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(polygon_wkb(p) for p in polygons)


def point_wkb(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, 1, x, y)


def _number(v: float) -> str:
    return str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(float(v))


def wkt(wkb: bytes) -> str:
    """Text form of points, lines and polygons, single or several; anything else is :class:`Bad`."""
    pair = lambda p: f"{_number(p[0])} {_number(p[1])}"
    ring = lambda r: "(" + ", ".join(pair(p) for p in r) + ")"
    kind = kind_of(wkb)
    if kind in ("Polygon", "MultiPolygon"):
        bodies = ["(" + ", ".join(ring(r) for r in rings) + ")" for rings in polygons_of(wkb)]
        if not bodies:
            return f"{kind.upper()} EMPTY"
        return "POLYGON " + bodies[0] if kind == "Polygon" else "MULTIPOLYGON (" + ", ".join(bodies) + ")"
    if kind not in ("Point", "LineString", "MultiPoint", "MultiLineString"):
        raise Bad(f"no text form for {kind}")
    parts = [ring(points_of(wkb, o, n, d)) for _, _, o, n, d in scan(wkb) if n]
    if not parts:
        return f"{kind.upper()} EMPTY"
    return f"{kind.upper()} " + (f"({', '.join(parts)})" if kind.startswith("Multi") else parts[0])


def geojson(wkb: bytes) -> dict:
    kind = kind_of(wkb)
    if kind == "Polygon":
        return {"type": kind, "coordinates": [r.tolist() for r in (polygons_of(wkb) or [[]])[0]]}
    if kind == "MultiPolygon":
        return {"type": kind, "coordinates": [[r.tolist() for r in rings] for rings in polygons_of(wkb)]}
    parts = [points_of(wkb, o, n, d).tolist() for _, _, o, n, d in scan(wkb)]
    if kind == "MultiLineString":
        return {"type": kind, "coordinates": parts}
    if kind not in ("Point", "LineString", "MultiPoint"):
        raise Bad(f"no document form for {kind}")
    points = [p for part in parts for p in part]
    return {"type": kind, "coordinates": (points or [[]])[0] if kind == "Point" else points}


def signed_area(ring: np.ndarray) -> float:
    """Shoelace area of a closed ring, positive when counter-clockwise."""
    base = ring - ring[0]
    x, y = base[:, 0], base[:, 1]
    return float(np.sum(x[:-1] * y[1:] - x[1:] * y[:-1]) / 2)


def ring_moment(ring: np.ndarray) -> tuple[float, float, float]:
    """Signed area and the area-weighted coordinate sums."""
    origin = ring[0]
    x, y = (ring - origin).T
    cross = x[:-1] * y[1:] - x[1:] * y[:-1]
    area = float(cross.sum() / 2)
    mx = float(((x[:-1] + x[1:]) * cross).sum() / 6) + area * origin[0]
    my = float(((y[:-1] + y[1:]) * cross).sum() / 6) + area * origin[1]
    return area, mx, my


def measures(wkb: bytes) -> dict | None:
    """Type, bbox, area and centroid; None when the geometry cannot be read or has no points."""
    try:
        runs = scan(wkb)
        points = np.concatenate([points_of(wkb, o, n, d) for _, _, o, n, d in runs]) if runs else np.empty((0, 2))
        if not len(points):
            return None
        area = mx = my = 0.0
        for rings in polygons_of(wkb):
            for i, ring in enumerate(rings):
                a, x, y = ring_moment(ring)
                sign = 1.0 if (a > 0) == (i == 0) else -1.0
                area, mx, my = area + sign * a, mx + sign * x, my + sign * y
    except (Bad, ValueError, IndexError):
        return None
    low, high = points.min(axis=0), points.max(axis=0)
    if area > 0:
        cx, cy = mx / area, my / area
    else:
        cx, cy = points.mean(axis=0)
    return {
        "geometry_type": kind_of(wkb), "xmin": float(low[0]), "ymin": float(low[1]), "xmax": float(high[0]), "ymax": float(high[1]),
        "area": area, "centroid_x": float(cx), "centroid_y": float(cy),
    }


def _crosses_itself(ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    n = len(a)
    low, high = np.minimum(a[:, 0], b[:, 0]), np.maximum(a[:, 0], b[:, 0])
    order = np.argsort(low, kind="stable")
    starts = low[order]

    def side(p, q, r):
        return np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))

    for rank, i in enumerate(order):
        stop = np.searchsorted(starts, high[i], side="right")
        j = order[rank + 1 : stop]
        j = j[(np.abs(j - i) > 1) & (np.abs(j - i) < n - 1)]
        if len(j):
            proper = (side(a[i], b[i], a[j]) * side(a[i], b[i], b[j]) < 0) & (side(a[j], b[j], a[i]) * side(a[j], b[j], b[i]) < 0)
            if proper.any():
                return True
    return False


def flaw(wkb: bytes | None) -> str | None:
    """Why a geometry is not usable: empty, or the first rule a polygon breaks. None when sound."""
    if wkb is None:
        return None
    try:
        runs = scan(wkb)
        if not sum(n for _, _, _, n, _ in runs):
            return "empty"
        for kind, _, offset, n, dtype in runs:
            points = points_of(wkb, offset, n, dtype)
            if not np.isfinite(points).all():
                return "non-finite coordinate"
            if kind == 3:
                if n < 4:
                    return "too few points in ring"
                if (points[0] != points[-1]).any():
                    return "ring is not closed"
                if signed_area(points) == 0:
                    return "ring without area"
                if _crosses_itself(points):
                    return "ring crosses itself"
    except Bad:
        return "unreadable"
    return None


def directed_edges(wkb: bytes, digits: int | None) -> np.ndarray:
    """Edges (x1, y1, x2, y2) with the interior on their left, coordinates rounded to ``digits`` if given; zero-length ones dropped."""
    out = []
    for rings in polygons_of(wkb):
        for i, ring in enumerate(rings):
            if digits is not None:
                ring = np.round(ring, digits) + 0.0
            if (signed_area(ring) > 0) != (i == 0):
                ring = ring[::-1]
            pairs = np.hstack([ring[:-1], ring[1:]])
            out.append(pairs[(pairs[:, :2] != pairs[:, 2:]).any(axis=1)])
    return np.concatenate(out) if out else np.empty((0, 4))


def walk_rings(edges: np.ndarray) -> list[np.ndarray]:
    """Closed rings of directed edges that form one or more loops, cut where a vertex repeats.

    Each ring starts at its smallest vertex; rings keep the direction of their edges.
    """
    after: dict[tuple, list[tuple]] = {}
    for x1, y1, x2, y2 in sorted(map(tuple, edges.tolist())):
        after.setdefault((x1, y1), []).append((x2, y2))
    rings = []
    for start in sorted(after):
        while after[start]:
            path, place = [start], {start: 0}
            here = start
            while True:
                if not after.get(here):
                    raise Bad("edges do not close")
                here = after[here].pop(0)
                if here in place:
                    loop = path[place[here] :]
                    rings.append(loop)
                    for gone in loop[1:]:
                        del place[gone]
                    path = path[: place[here] + 1]
                    if here == start:
                        break
                else:
                    place[here] = len(path)
                    path.append(here)
    out = []
    for loop in rings:
        first = loop.index(min(loop))
        loop = loop[first:] + loop[:first]
        out.append(np.array([*loop, loop[0]]))
    return out


def contains(ring: np.ndarray, x: float, y: float) -> bool:
    """Even-odd test of a point against a closed ring."""
    (x1, y1), (x2, y2) = ring[:-1].T, ring[1:].T
    spans = (y1 > y) != (y2 > y)
    at = x1[spans] + (y - y1[spans]) * (x2[spans] - x1[spans]) / (y2[spans] - y1[spans])
    return bool(np.count_nonzero(at > x) % 2)


def inner_point(ring: np.ndarray) -> tuple[float, float]:
    """A point strictly inside a ring."""
    ys = np.unique(ring[:, 1])
    y = float((ys[0] + ys[1]) / 2)
    (x1, y1), (x2, y2) = ring[:-1].T, ring[1:].T
    spans = (y1 > y) != (y2 > y)
    at = np.sort(x1[spans] + (y - y1[spans]) * (x2[spans] - x1[spans]) / (y2[spans] - y1[spans]))
    return float((at[0] + at[1]) / 2), y


def simplify_line(line: np.ndarray, min_area: float, closed: bool) -> np.ndarray:
    """Visvalingam–Whyatt: drop the vertex of the smallest triangle while that is below ``min_area``.

    End points stay. A closed line keeps two interior vertices and an open one its most prominent
    interior vertex unless that is on the straight line, so that no polygon collapses.
    """
    n = len(line)
    keep_at_least = 2 if closed else 1
    if n - 2 <= keep_at_least - (0 if closed else 1) or n < 3:
        return line
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    points = line.tolist()

    def triangle(i: int) -> float:
        (ax, ay), (bx, by), (cx, cy) = points[before[i]], points[i], points[after[i]]
        return abs((bx - ax) * (cy - ay) - (cx - ax) * (by - ay)) / 2

    area = {i: triangle(i) for i in range(1, n - 1)}
    heap = [(a, i) for i, a in area.items()]
    heapq.heapify(heap)
    left = n - 2
    while heap:
        a, i = heapq.heappop(heap)
        if not alive[i] or area[i] != a:
            continue
        if a >= min_area or (left <= keep_at_least and (closed or a > 0)):
            break
        alive[i] = False
        left -= 1
        p, q = before[i], after[i]
        after[p], before[q] = q, p
        for j in (p, q):
            if 0 < j < n - 1:
                area[j] = triangle(j)
                heapq.heappush(heap, (area[j], j))
    return line[np.array(alive)]


# --- many geometries at once -------------------------------------------------------------------

#: Geometries of more bytes are worked on one by one: their points outweigh the cost of a call.
BULK_BYTES = 4096
#: Bytes of geometries that are worked on together.
TOGETHER = 2_000_000


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary array, which may be a slice."""
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return starts, np.empty(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)


def plain_rings(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The little-endian polygons of one ring in two dimensions, those with as many points together: (rows, places, rings).

    ``rings`` has the points of each, ``places`` where in the array's bytes they begin. Any other row comes in none.
    """
    if not len(column):
        return
    starts, data = _bytes_of(column)
    sizes = np.diff(starts)
    sizes[np.asarray(column.is_null())] = -1
    usable = np.flatnonzero((sizes >= 29) & (sizes <= BULK_BYTES) & (sizes % 16 == 13))
    usable = usable[np.argsort(sizes[usable], kind="stable")]
    for same in np.split(usable, np.flatnonzero(np.diff(sizes[usable])) + 1):
        if not len(same):
            continue
        n = int(sizes[same[0]] - 13) // 16
        head = np.frombuffer(struct.pack("<BIII", 1, 3, 1, n), dtype=np.uint8)
        step = TOGETHER // (13 + 16 * n)
        for rows in (same[i : i + step] for i in range(0, len(same), step)):
            table = data[starts[rows][:, None] + np.arange(13 + 16 * n)]
            plain = (table[:, :13] == head).all(axis=1)
            if plain.any():
                yield rows[plain], starts[rows[plain]] + 13, np.ascontiguousarray(table[plain, 13:]).view("<f8").reshape(-1, n, 2)


def ring_areas(rings: np.ndarray) -> np.ndarray:
    """:func:`signed_area` of each."""
    x, y = np.moveaxis(rings - rings[:, :1], 2, 0)
    return (x[:, :-1] * y[:, 1:] - x[:, 1:] * y[:, :-1]).sum(axis=1) / 2


MEASURED = ("xmin", "ymin", "xmax", "ymax", "area", "centroid_x", "centroid_y")


def measures_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """:func:`measures` of each geometry: the types, None where there are none, and a table of the numbers."""
    kinds, numbers = np.full(len(column), None, dtype=object), np.full((len(column), len(MEASURED)), np.nan)
    left = np.ones(len(column), dtype=bool)
    for rows, _, rings in plain_rings(column):
        origin = rings[:, 0]
        x, y = np.moveaxis(rings - origin[:, None], 2, 0)
        cross = x[:, :-1] * y[:, 1:] - x[:, 1:] * y[:, :-1]
        area = cross.sum(axis=1) / 2
        mx = ((x[:, :-1] + x[:, 1:]) * cross).sum(axis=1) / 6 + area * origin[:, 0]
        my = ((y[:, :-1] + y[:, 1:]) * cross).sum(axis=1) / 6 + area * origin[:, 1]
        # without area the centroid is another
        found = np.flatnonzero(np.abs(area) > 0)
        rows, area, mx, my, rings = rows[found], area[found], mx[found], my[found], rings[found]
        kinds[rows] = "Polygon"
        numbers[rows] = np.column_stack([rings.min(axis=1), rings.max(axis=1), np.abs(area), mx / area, my / area])
        left[rows] = False
    points = _plain_points(column)
    kinds[points[0]], left[points[0]] = "Point", False
    numbers[points[0]] = np.column_stack([points[1], points[1], np.zeros(len(points[0])), points[1]])
    for row in np.flatnonzero(left):
        wkb = column[row].as_py()
        found = None if wkb is None else measures(wkb)
        if found is not None:
            kinds[row], numbers[row] = found["geometry_type"], [found[c] for c in MEASURED]
    return kinds, numbers


def _plain_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The little-endian points in two dimensions: (rows, points)."""
    if not len(column):
        return np.empty(0, int), np.empty((0, 2))
    starts, data = _bytes_of(column)
    rows = np.flatnonzero((np.diff(starts) == 21) & ~np.asarray(column.is_null()))
    table = data[starts[rows][:, None] + np.arange(21)]
    plain = (table[:, :5] == np.frombuffer(struct.pack("<BI", 1, 1), dtype=np.uint8)).all(axis=1)
    return rows[plain], np.ascontiguousarray(table[plain, 5:]).view("<f8").reshape(-1, 2)


#: Edge pairs that are compared at once.
PAIRS = 1_000_000


def _cross_themselves(rings: np.ndarray) -> np.ndarray:
    """:func:`_crosses_itself` of each ring."""
    a, b = rings[:, :-1], rings[:, 1:]
    n = a.shape[1]
    i, j = np.triu_indices(n, 2)
    i, j = i[j - i < n - 1], j[j - i < n - 1]
    out = np.zeros(len(rings), dtype=bool)
    if not len(i):
        return out

    def side(p, q, r):
        return np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))

    step = max(1, PAIRS // len(i))
    for start in range(0, len(rings), step):
        ai, bi, aj, bj = (end[start : start + step][:, k] for end, k in ((a, i), (b, i), (a, j), (b, j)))
        meet = (np.minimum(ai, bi)[..., 0] <= np.maximum(aj, bj)[..., 0]) & (np.minimum(aj, bj)[..., 0] <= np.maximum(ai, bi)[..., 0])
        proper = (side(ai, bi, aj) * side(ai, bi, bj) < 0) & (side(aj, bj, ai) * side(aj, bj, bi) < 0)
        out[start : start + step] = (meet & proper).any(axis=1)
    return out


def flaws_of(column: pa.Array) -> np.ndarray:
    """:func:`flaw` of each geometry."""
    out = np.full(len(column), None, dtype=object)
    left = np.ones(len(column), dtype=bool)
    for rows, _, rings in plain_rings(column):
        # the edges of longer rings are compared in order of place, one ring at a time
        if rings.shape[1] > 65:
            continue
        left[rows] = False
        finite = np.isfinite(rings).all(axis=(1, 2))
        out[rows[~finite]] = "non-finite coordinate"
        rows, rings = rows[finite], rings[finite]
        if rings.shape[1] < 4:
            out[rows] = "too few points in ring"
            continue
        closed = (rings[:, 0] == rings[:, -1]).all(axis=1)
        out[rows[~closed]] = "ring is not closed"
        rows, rings = rows[closed], rings[closed]
        flat = ring_areas(rings) == 0
        out[rows[flat]] = "ring without area"
        rows, rings = rows[~flat], rings[~flat]
        out[rows[_cross_themselves(rings)]] = "ring crosses itself"
    for row in np.flatnonzero(left):
        out[row] = flaw(column[row].as_py())
    return out


def edges_of(column: pa.Array, digits: int | None) -> tuple[np.ndarray, np.ndarray]:
    """:func:`directed_edges` of each geometry, none of what cannot be read: where each one's begin in the table, and the table."""
    counts = np.zeros(len(column), dtype=np.int64)
    left = np.ones(len(column), dtype=bool)
    groups = []
    for rows, _, rings in plain_rings(column):
        if digits is not None:
            rings = np.round(rings, digits) + 0.0
        turned = ~(ring_areas(rings) > 0)
        rings[turned] = rings[turned, ::-1]
        pairs = np.concatenate([rings[:, :-1], rings[:, 1:]], axis=2)
        kept = (pairs[..., :2] != pairs[..., 2:]).any(axis=2)
        counts[rows], left[rows] = kept.sum(axis=1), False
        groups.append((rows, kept, pairs))
    single = {}
    for row in np.flatnonzero(left):
        wkb = column[row].as_py()
        try:
            single[row] = np.empty((0, 4)) if wkb is None else directed_edges(wkb, digits)
        except Bad:
            single[row] = np.empty((0, 4))
        counts[row] = len(single[row])
    offsets = np.concatenate([[0], np.cumsum(counts)])
    table = np.empty((offsets[-1], 4))
    for rows, kept, pairs in groups:
        table[(offsets[rows][:, None] + np.cumsum(kept, axis=1) - 1)[kept]] = pairs[kept]
    for row, edges in single.items():
        table[offsets[row] : offsets[row + 1]] = edges
    return offsets, table


def _binary(size: int, nulls: np.ndarray, data: np.ndarray) -> pa.Array:
    """Values of ``size`` bytes each as a binary array."""
    offsets = np.arange(len(nulls) + 1, dtype=np.int64) * size
    return pa.Array.from_buffers(pa.large_binary(), len(nulls), [_valid(nulls), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _valid(nulls: np.ndarray) -> pa.Buffer:
    return pa.py_buffer(np.packbits(~nulls, bitorder="little"))


def _numbers_of(columns: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """The columns as a table of doubles, and the rows where one is NULL."""
    table = np.column_stack([c.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False) for c in columns])
    return table, np.logical_or.reduce([np.asarray(c.is_null()) for c in columns])


def boxes_wkb(*sides: pa.Array) -> pa.Array:
    """Rectangles by xmin, ymin, xmax, ymax; NULL where one is."""
    table, nulls = _numbers_of(sides)
    out = np.empty((len(table), 93), dtype=np.uint8)
    out[:, :13] = np.frombuffer(struct.pack("<BIII", 1, 3, 1, 5), dtype=np.uint8)
    out[:, 13:] = np.ascontiguousarray(table[:, [0, 1, 2, 1, 2, 3, 0, 3, 0, 1]], dtype="<f8").view(np.uint8)
    return _binary(93, nulls, out)


def points_wkb(x: pa.Array, y: pa.Array) -> pa.Array:
    """Points; NULL where a coordinate is."""
    table, nulls = _numbers_of((x, y))
    out = np.empty((len(table), 21), dtype=np.uint8)
    out[:, :5] = np.frombuffer(struct.pack("<BI", 1, 1), dtype=np.uint8)
    out[:, 5:] = np.ascontiguousarray(table, dtype="<f8").view(np.uint8)
    return _binary(21, nulls, out)


def map_all_points(column: pa.Array, project: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """:func:`map_points` of each geometry, NULL of what cannot be read."""
    if not len(column):
        return column
    starts, data = _bytes_of(column)
    first = starts[0]
    moved = data[first : starts[-1]].copy()
    nulls = np.asarray(column.is_null()).copy()
    left = ~nulls
    for rows, places, rings in plain_rings(column):
        flat = np.empty(rings.shape, dtype="<f8")
        x, y = project(np.ascontiguousarray(rings[..., 0]).ravel(), np.ascontiguousarray(rings[..., 1]).ravel())
        flat[..., 0], flat[..., 1] = x.reshape(rings.shape[:2]), y.reshape(rings.shape[:2])
        flat = flat.reshape(len(rows), -1).view(np.uint8)
        moved[(places - first)[:, None] + np.arange(flat.shape[1])] = flat
        left[rows] = False
    for row in np.flatnonzero(left):
        try:
            moved[starts[row] - first : starts[row + 1] - first] = np.frombuffer(map_points(column[row].as_py(), project), dtype=np.uint8)
        except Bad:
            nulls[row] = True
    offsets = (starts - first).astype(np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    return pa.Array.from_buffers(column.type, len(column), [_valid(nulls), pa.py_buffer(offsets), pa.py_buffer(moved)])
