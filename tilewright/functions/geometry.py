"""Query geometries and the closed intersects test.

A geometry is an array of chains ``struct<area:boolean,points:array<struct<lon,lat>>>``: the
rings of polygons have ``area`` true (holes included, inside is by even-odd count), lines
and points have it false. An item's ring is one area chain.

The polygon test runs as an Arrow UDF: every edge of one geometry against every edge of the
other, whole batches at a time. Always put :func:`boxes_overlap` in front of it, which
reaches the parquet scan and leaves few rows.
"""

from __future__ import annotations

import json
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.schemas import BBOX, BOOLEAN, CHAINS, STRING

PAIRS_AT_ONCE = 2_000_000
_POINT_TYPE = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])
CHAINS_TYPE = pa.list_(pa.struct([("area", pa.bool_()), ("points", pa.list_(_POINT_TYPE))]))
BBOX_TYPE = pa.struct([(n, pa.float64()) for n in ("xmin", "ymin", "xmax", "ymax")])
SHAPE = T.StructType(
    [T.StructField("chains", CHAINS), T.StructField("bbox", BBOX), T.StructField("problem", STRING)]
)


def boxes_overlap(a: Column, xmin, ymin, xmax, ymax) -> Column:
    """Closed overlap of a ``struct<xmin,ymin,xmax,ymax>`` column with a box."""
    lo_x, lo_y, hi_x, hi_y = (
        v if isinstance(v, Column) else F.lit(float(v)) for v in (xmin, ymin, xmax, ymax)
    )
    return (a["xmin"] <= hi_x) & (a["xmax"] >= lo_x) & (a["ymin"] <= hi_y) & (a["ymax"] >= lo_y)


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Closed five-point ring of a box."""
    path = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in path])


def ring_box(ring: Column) -> Column:
    """Bounding box of a ring."""
    lon, lat = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
    return F.struct(
        F.array_min(lon).alias("xmin"),
        F.array_min(lat).alias("ymin"),
        F.array_max(lon).alias("xmax"),
        F.array_max(lat).alias("ymax"),
    )


def area(ring: Column) -> Column:
    """A ring as a geometry."""
    return F.array(F.struct(F.lit(True).alias("area"), ring.alias("points")))


def _over_meridian(ring: Column) -> tuple[Column, Column]:
    """Whether a ring with wrapped longitudes crosses 180 degrees, and the ring with them from 0 to 360."""
    lon = F.transform(ring, lambda p: p["lon"])
    whole = F.transform(
        ring,
        lambda p: F.struct(F.when(p["lon"] < 0, p["lon"] + 360.0).otherwise(p["lon"]).alias("lon"), p["lat"].alias("lat")),
    )
    return F.array_max(lon) - F.array_min(lon) > 180, whole


def item_area(ring: Column) -> Column:
    """An item's ring as a geometry; one over the 180th meridian lies on both sides of the map.

    Such a ring is the same ring twice, 360 degrees apart, each in one piece. What lies beyond the
    map's edge meets nothing, so it need not be cut off.
    """
    crosses, whole = _over_meridian(ring)
    west = F.transform(whole, lambda p: F.struct((p["lon"] - 360.0).alias("lon"), p["lat"].alias("lat")))
    chains = [F.struct(F.lit(True).alias("area"), points.alias("points")) for points in (whole, west)]
    return F.when(crosses, F.array(*chains)).otherwise(area(ring))


def item_boxes(ring: Column, bbox: Column) -> Column:
    """The boxes an item's ring fills: its own, or one on either side of the 180th meridian."""
    crosses, whole = _over_meridian(ring)
    lon = F.transform(whole, lambda p: p["lon"])

    def box(xmin: Column, xmax: Column) -> Column:
        return F.struct(xmin.alias("xmin"), bbox["ymin"].alias("ymin"), xmax.alias("xmax"), bbox["ymax"].alias("ymax"))

    edge = F.lit(180.0).cast("double")
    halves = F.array(box(F.array_min(lon), edge), box(-edge, F.array_max(lon) - 360.0))
    own = F.array(box(bbox["xmin"], bbox["xmax"]))
    return F.when(crosses, halves).otherwise(own)


def both_sides(geometry: dict) -> dict:
    """A query geometry that reaches over 180 or -180 degrees, with a copy on the other side."""
    x0, _, x1, _ = geometry_box(geometry)
    shift = -360.0 if x1 > 180 else 360.0 if x0 < -180 else 0.0
    if not shift:
        return geometry
    moved = [(is_area, [(x + shift, y) for x, y in points]) for is_area, points in chains_of(geometry)]
    # rings of one polygon stay together: inside is by even-odd count over all of them
    rings = [p for is_area, p in moved if is_area]
    parts = [{"type": "Polygon", "coordinates": rings}] if rings else []
    parts += [{"type": "LineString", "coordinates": p} for is_area, p in moved if not is_area]
    return {"type": "GeometryCollection", "geometries": [geometry, *parts]}


def boxes_on_map(geometry: dict) -> list[tuple[float, float, float, float]]:
    """The box of a query geometry, or the two it has on the map if it reaches over 180 degrees."""
    x0, y0, x1, y1 = geometry_box(geometry)
    if x0 >= -180 and x1 <= 180:
        return [(x0, y0, x1, y1)]
    if x1 - x0 >= 360:
        return [(-180.0, y0, 180.0, y1)]
    return [(x0, y0, 180.0, y1), (-180.0, y0, x1 - 360, y1)] if x1 > 180 else [(x0 + 360, y0, 180.0, y1), (-180.0, y0, x1, y1)]


def overlaps_any(a: Column, boxes: list[tuple[float, float, float, float]]) -> Column:
    return reduce(or_, [boxes_overlap(a, *box) for box in boxes])


def chains_of(geometry: dict) -> list[tuple[bool, list[tuple[float, float]]]]:
    """Chains of a GeoJSON geometry of any type, of a Feature, or of a collection of them.

    Raises ValueError on unknown types, empty geometries and rings that are not closed.
    """
    kind = geometry.get("type")
    if kind == "Feature":
        return chains_of(geometry["geometry"])
    if kind == "FeatureCollection":
        return [c for f in geometry["features"] for c in chains_of(f)]
    if kind == "GeometryCollection":
        return [c for g in geometry["geometries"] for c in chains_of(g)]
    coordinates = geometry["coordinates"]
    by_kind = {
        "Point": lambda c: [(False, [c])],
        "MultiPoint": lambda c: [(False, [p]) for p in c],
        "LineString": lambda c: [(False, c)],
        "MultiLineString": lambda c: [(False, part) for part in c],
        "Polygon": lambda c: [(True, ring) for ring in c],
        "MultiPolygon": lambda c: [(True, ring) for part in c for ring in part],
    }
    if kind not in by_kind:
        raise ValueError(f"unknown geometry type {kind!r}")
    chains = [
        (is_area, [(float(p[0]), float(p[1])) for p in points])
        for is_area, points in by_kind[kind](coordinates)
    ]
    if not any(points for _, points in chains):
        raise ValueError("geometry has no coordinates")
    if any(is_area and (len(p) < 4 or p[0] != p[-1]) for is_area, p in chains):
        raise ValueError("a ring of a polygon has four points or more and ends where it begins")
    return chains


def box_geometry(box) -> dict:
    """GeoJSON polygon of ``xmin,ymin,xmax,ymax`` given as four numbers or as text."""
    values = [float(v) for v in (box.split(",") if isinstance(box, str) else box)]
    if len(values) != 4:
        raise ValueError("a bounding box has exactly four values")
    x0, y0, x1, y1 = values
    return {"type": "Polygon", "coordinates": [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]}


def geometry_box(geometry: dict) -> tuple[float, float, float, float]:
    """Bounding box of a GeoJSON geometry."""
    points = [p for _, chain in chains_of(geometry) for p in chain]
    lon, lat = [p[0] for p in points], [p[1] for p in points]
    return min(lon), min(lat), max(lon), max(lat)


@F.arrow_udf(SHAPE)
def _geojson_shape(texts: pa.Array) -> pa.Array:
    shapes = []
    for text in texts.to_pylist():
        try:
            chains = chains_of(json.loads(text))
            x, y = (np.array(c) for c in zip(*[p for _, points in chains for p in points]))
            box = dict(zip(("xmin", "ymin", "xmax", "ymax"), map(float, (x.min(), y.min(), x.max(), y.max()))))
            shapes.append({"chains": chain_dicts(chains), "bbox": box, "problem": None})
        except (ValueError, TypeError, KeyError, IndexError, AttributeError) as problem:
            shapes.append({"chains": None, "bbox": None, "problem": str(problem) or "no geometry"})
    kind = pa.struct([("chains", CHAINS_TYPE), ("bbox", BBOX_TYPE), ("problem", pa.string())])
    return pa.array(shapes, type=kind)


def geojson_shape(text: Column) -> Column:
    """``struct<chains,bbox,problem>`` of GeoJSON texts of any type, holes and parts included.

    A text that holds no geometry has its reason in ``problem`` and nothing else.
    """
    return _geojson_shape(text)


class _Edges:
    """Flat edge arrays of one geometry per row, rows in order."""

    def __init__(self, row, x1, y1, x2, y2, is_area, rows, first_row, first_x, first_y):
        self.row, self.x1, self.y1, self.x2, self.y2, self.area = row, x1, y1, x2, y2, is_area
        self.count = np.bincount(row, minlength=rows)
        self.start = np.concatenate([[0], np.cumsum(self.count)[:-1]])
        self.first_count = np.bincount(first_row, minlength=rows)
        self.first_start = np.concatenate([[0], np.cumsum(self.first_count)[:-1]])
        self.first_x, self.first_y = first_x, first_y

    @classmethod
    def of(cls, column: pa.Array) -> _Edges:
        """Edges of an Arrow column of chains; a null geometry has none."""
        rows = len(column)
        chain_row = np.repeat(np.arange(rows), _lengths(column))
        chains = column.flatten()
        area_flags, points = chains.flatten()
        sizes = _lengths(points)
        flat = points.flatten()
        x, y = (c.to_numpy(zero_copy_only=False) for c in flat.flatten())
        is_area = area_flags.to_numpy(zero_copy_only=False).astype(bool)
        chain = np.repeat(np.arange(len(sizes)), sizes)
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[sizes > 0].astype(np.int64)
        # a chain of one point becomes an edge of length zero
        last = np.ones(len(x), dtype=bool)
        if len(x):
            last[:-1] = chain[1:] != chain[:-1]
        single = sizes[chain] == 1 if len(x) else np.zeros(0, dtype=bool)
        begin = np.flatnonzero(~last | single)
        end = np.where(single[begin], begin, begin + 1)
        return cls(
            chain_row[chain[begin]], x[begin], y[begin], x[end], y[end], is_area[chain[begin]],
            rows, chain_row[chain[firsts]], x[firsts], y[firsts],
        )


    def boxes(self) -> list[np.ndarray]:
        """Lowest x and y, highest x and y per row; an empty row touches nothing."""
        filled = np.flatnonzero(self.count > 0)
        out = []
        for pick, empty, a, b in (
            (np.minimum, np.inf, self.x1, self.x2),
            (np.minimum, np.inf, self.y1, self.y2),
            (np.maximum, -np.inf, self.x1, self.x2),
            (np.maximum, -np.inf, self.y1, self.y2),
        ):
            ends = np.full(len(self.count), empty)
            if len(filled):
                ends[filled] = pick.reduceat(pick(a, b), self.start[filled])
            out.append(ends)
        return out

    def near(self, rows: np.ndarray, boxes: list[np.ndarray]) -> _Edges:
        """Edges of the wanted rows that touch the row's box; others cannot meet what is in it."""
        xmin, ymin, xmax, ymax = (b[self.row] for b in boxes)
        keep = np.flatnonzero(
            rows[self.row]
            & (np.minimum(self.x1, self.x2) <= xmax) & (np.maximum(self.x1, self.x2) >= xmin)
            & (np.minimum(self.y1, self.y2) <= ymax) & (np.maximum(self.y1, self.y2) >= ymin)
        )
        none = np.zeros(0, dtype=np.int64)
        return _Edges(
            self.row[keep], self.x1[keep], self.y1[keep], self.x2[keep], self.y2[keep],
            self.area[keep], len(self.count), none, none, none,
        )


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(pair_counts: np.ndarray):
    """Runs of rows whose pairs fit in memory together; a larger row runs alone."""
    ends, begin, done = np.cumsum(pair_counts), 0, 0
    while begin < len(pair_counts):
        end = int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right"))
        end = max(end, begin + 1)
        if ends[end - 1] > done:
            yield begin, end
        begin, done = end, ends[end - 1]


def _pairs(count_a, start_a, count_b, start_b):
    """Row, left index and right index of every pair within the rows given."""
    counts = count_a * count_b
    row = np.repeat(np.arange(len(counts)), counts)
    local = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    width = count_b[row]
    return row, start_a[row] + local // width, start_b[row] + local % width


def _any_by_row(row, flags, rows):
    return np.bincount(row[flags], minlength=rows) > 0


def _touch(a: _Edges, i, b: _Edges, j):
    ax, ay, bx, by = a.x1[i], a.y1[i], a.x2[i], a.y2[i]
    cx, cy, dx, dy = b.x1[j], b.y1[j], b.x2[j], b.y2[j]

    def side(px, py, qx, qy, rx, ry):
        return (qx - px) * (ry - py) - (qy - py) * (rx - px)

    def within(px, py, qx, qy, rx, ry):
        return (
            (np.minimum(px, qx) <= rx) & (rx <= np.maximum(px, qx))
            & (np.minimum(py, qy) <= ry) & (ry <= np.maximum(py, qy))
        )

    d1, d2 = side(cx, cy, dx, dy, ax, ay), side(cx, cy, dx, dy, bx, by)
    d3, d4 = side(ax, ay, bx, by, cx, cy), side(ax, ay, bx, by, dx, dy)
    cross = ((d1 > 0) & (d2 < 0) | (d1 < 0) & (d2 > 0)) & (
        (d3 > 0) & (d4 < 0) | (d3 < 0) & (d4 > 0)
    )
    return (
        cross
        | (d1 == 0) & within(cx, cy, dx, dy, ax, ay)
        | (d2 == 0) & within(cx, cy, dx, dy, bx, by)
        | (d3 == 0) & within(ax, ay, bx, by, cx, cy)
        | (d4 == 0) & within(ax, ay, bx, by, dx, dy)
    )


def _first_inside(a: _Edges, b: _Edges, begin, end):
    """Rows where the first point of a chain of ``a`` lies inside the area of ``b``."""
    rows = end - begin
    row, i, j = _pairs(
        a.first_count[begin:end], a.first_start[begin:end], b.count[begin:end], b.start[begin:end]
    )
    x, y = a.first_x[i], a.first_y[i]
    x1, y1, x2, y2 = b.x1[j], b.y1[j], b.x2[j], b.y2[j]
    spans = b.area[j] & ((y1 > y) != (y2 > y))
    k = np.flatnonzero(spans)
    left = x[k] < (x2[k] - x1[k]) * (y[k] - y1[k]) / (y2[k] - y1[k]) + x1[k]
    crossings = np.bincount(i[k][left], minlength=len(a.first_x))
    odd = np.flatnonzero(crossings % 2 == 1)
    owner = np.repeat(np.arange(rows), a.first_count[begin:end])
    hit = np.zeros(rows, dtype=bool)
    inside = odd - a.first_start[begin] if rows else odd
    hit[owner[inside]] = True
    return hit


def meets(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Row-wise closed intersects of two Arrow columns of chains.

    A point of one inside the other is looked for first, which is cheap. Where there is none,
    edges near the other geometry's box are tested pair by pair.
    """
    left, right = _Edges.of(a), _Edges.of(b)
    hits = np.zeros(len(a), dtype=bool)
    firsts = left.first_count * right.count + right.first_count * left.count
    for begin, end in _blocks(firsts):
        hits[begin:end] = _first_inside(left, right, begin, end)
        hits[begin:end] |= _first_inside(right, left, begin, end)
    left, right = left.near(~hits, right.boxes()), right.near(~hits, left.boxes())
    for begin, end in _blocks(left.count * right.count):
        row, i, j = _pairs(
            left.count[begin:end], left.start[begin:end],
            right.count[begin:end], right.start[begin:end],
        )
        hits[begin:end] |= _any_by_row(row, _touch(left, i, right, j), end - begin)
    return hits


@F.arrow_udf(BOOLEAN)
def _meets(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(meets(a, b))


def intersects(a: Column, b: Column) -> Column:
    """Closed intersects of two geometry columns; touching counts, null is false."""
    return _meets(a, b)


def chain_dicts(chains) -> list[dict]:
    return [
        {"area": is_area, "points": [{"lon": x, "lat": y} for x, y in points]}
        for is_area, points in chains
    ]


def chains_array(chains, rows: int = 1) -> pa.Array:
    """An Arrow column with one geometry on every row."""
    return pa.array([chain_dicts(chains)] * rows, type=CHAINS_TYPE)


class _Bands:
    """Edges of one geometry by bands of latitude, to find those at a height without the rest."""

    def __init__(self, edges: _Edges):
        self.edges = edges
        low, high = np.minimum(edges.y1, edges.y2), np.maximum(edges.y1, edges.y2)
        self.low, self.high = low.min(initial=np.inf), high.max(initial=-np.inf)
        self.bands = max(1, min(4096, len(low)))
        while True:  # fewer bands when edges are so tall that they would be in many
            self.width = max((self.high - self.low) / self.bands, 1e-300) if len(low) else 1.0
            first, last = self.of(low), self.of(high)
            if self.bands == 1 or (last - first + 1).sum() <= 8 * len(low):
                break
            self.bands //= 2
        count = last - first + 1
        edge = np.repeat(np.arange(len(low)), count)
        band = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)
        order = np.argsort(band, kind="stable")
        self.edge, self.start = edge[order], np.searchsorted(band[order], np.arange(self.bands + 1))

    def of(self, y: np.ndarray) -> np.ndarray:
        return np.clip(((y - self.low) / self.width), 0, self.bands - 1).astype(np.int64)

    def pairs(self, low: np.ndarray, high: np.ndarray):
        """In blocks: places of the intervals, and edges in the bands they touch, pair by pair."""
        begin, end = self.start[self.of(low)], self.start[self.of(high) + 1]
        count = np.where((high >= self.low) & (low <= self.high), end - begin, 0)
        for a, b in _blocks(count):
            n = count[a:b]
            which = np.repeat(np.arange(a, b), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[which]
            yield which, self.edge[place]


def meets_one(a: pa.Array, bands: _Bands) -> np.ndarray:
    """Closed intersects of every row with one geometry, which is held once.

    Rows are paired only with those of its edges that touch the row's box, in blocks of
    PAIRS_AT_ONCE, whatever the number of its vertices.
    """
    left, one, rows = _Edges.of(a), bands.edges, len(a)
    hits = np.zeros(rows, dtype=bool)
    owner = np.repeat(np.arange(rows), left.first_count)
    crossings = np.zeros(len(owner), dtype=np.int64)
    for i, j in bands.pairs(left.first_y, left.first_y):  # points of the rows inside the geometry
        cross = _crosses(left.first_x[i], left.first_y[i], one, j)
        crossings += np.bincount(i[cross], minlength=len(owner))
    hits[owner[crossings % 2 == 1]] = True
    step = max(1, PAIRS_AT_ONCE // max(len(left.x1), 1))
    for begin in range(0, len(one.first_x), step):  # points of the geometry inside the rows
        x, y = (v[begin : begin + step, None] for v in (one.first_x, one.first_y))
        which, edge = np.nonzero(_crosses(x, y, left, slice(None)))
        inside, times = np.unique(which * rows + left.row[edge], return_counts=True)
        hits[inside[times % 2 == 1] % max(rows, 1)] = True
    xmin, ymin, xmax, ymax = left.boxes()
    todo = np.flatnonzero(~hits & (left.count > 0))
    for i, j in bands.pairs(ymin[todo], ymax[todo]):
        row = todo[i]
        near = (np.minimum(one.x1[j], one.x2[j]) <= xmax[row]) & (np.maximum(one.x1[j], one.x2[j]) >= xmin[row])
        near &= (np.minimum(one.y1[j], one.y2[j]) <= ymax[row]) & (np.maximum(one.y1[j], one.y2[j]) >= ymin[row])
        row, j = row[near], j[near]
        for begin, end in _blocks(left.count[row]):
            some, edge = row[begin:end], j[begin:end]
            ones, place = np.ones(len(some), dtype=np.int64), np.arange(len(some))
            pair, mine, at = _pairs(left.count[some], left.start[some], ones, place)
            touch = _touch(left, mine, one, edge[at])
            hits[some[pair[touch]]] = True
    return hits


def _crosses(x, y, b: _Edges, j):
    """Whether the ray to the right of a point crosses an edge of an area."""
    x1, y1, x2, y2 = b.x1[j], b.y1[j], b.x2[j], b.y2[j]
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return b.area[j] & ((y1 > y) != (y2 > y)) & (x < at)


def intersects_geometry(chains_column: Column, geometry: dict) -> Column:
    """Closed intersects of a geometry column with one GeoJSON geometry."""
    text = json.dumps(chains_of(geometry))

    @F.arrow_udf(BOOLEAN)
    def hit(a: pa.Array) -> pa.Array:
        return pa.array(meets_one(a, _one(text)))

    return hit(chains_column)


@lru_cache(maxsize=4)
def _one(text: str) -> _Bands:
    """A query geometry, made once per worker."""
    return _Bands(_Edges.of(chains_array(json.loads(text))))


def geometries_meet(a: dict, b: dict) -> bool:
    """Closed intersects of two GeoJSON geometries on the driver, for query arguments."""
    return bool(meets(chains_array(chains_of(a)), chains_array(chains_of(b)))[0])


@F.arrow_udf(STRING)
def _ring_problem(rings: pa.Array) -> pa.Array:
    out = []
    for ring in rings.to_pylist():
        points = [(p["lon"], p["lat"]) for p in ring or []]
        if len(points) < 4:
            out.append("too few points")
        elif points[0] != points[-1]:
            out.append("not closed")
        else:
            out.append("self-intersecting" if _self_touches(points) else None)
    return pa.array(out, type=pa.string())


def _self_touches(points) -> bool:
    """Whether edges of a closed ring meet anywhere but in the point neighbours share."""
    path = [p for i, p in enumerate(points) if i == 0 or p != points[i - 1]]
    x, y = np.array(path).T
    n = len(path) - 1
    if n < 3:
        return True
    none = np.zeros(0, dtype=np.int64)
    edges = _Edges(
        np.zeros(n, dtype=np.int64), x[:-1], y[:-1], x[1:], y[1:], np.ones(n, dtype=bool),
        1, none, none, none,
    )
    for i in range(n - 1):  # one edge against all later ones: memory stays linear
        j = np.arange(i + 2, n - 1 if i == 0 else n)
        if len(j) and _touch(edges, np.full(len(j), i), edges, j).any():
            return True
    ux, uy = np.diff(x), np.diff(y)
    vx, vy = np.roll(ux, -1), np.roll(uy, -1)
    back = (ux * vy - uy * vx == 0) & (ux * vx + uy * vy < 0)
    return bool(back.any())


def ring_problem(ring: Column) -> Column:
    """Why a ring is no valid polygon: too few points, not closed, self-intersecting; else null."""
    return _ring_problem(ring)
