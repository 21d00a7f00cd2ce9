"""Many query geometries held once by a worker, and the items of a batch that meet them.

Items are compared with the boxes of the geometries in small groups of neighbours, and pairs whose boxes
overlap get the exact test of :func:`geometry.meets` in blocks: corner by corner over arrays of pairs, so that
neither a ring nor a geometry is copied for a pair. Geometries of very many edges are asked one by one
(:func:`geometry.meets_one`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tilewright.functions.geometry import _Bands, _Edges, _lengths, _touch, meets, meets_one

#: Items that are neighbours, boxes they are compared with at once, pairs that are tested at once and
#: handed on at once; edges of a geometry, and points of a ring, beyond which it is tested by other means.
GROUP, MATRIX, BLOCK, HANDED, MANY = 64, 1 << 22, 1 << 15, 1 << 18, 64
_BOX = ("xmin", "ymin", "xmax", "ymax")


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64)


def _box(column: pa.Array) -> np.ndarray:
    """Rows of xmin, ymin, xmax, ymax; a null box overlaps nothing."""
    fields = column.flatten()  # a null of the struct is one in its fields
    return np.stack([_numbers(fields[column.type.get_field_index(n)]) for n in _BOX])


class Rings:
    """The rings and boxes of a batch of items; those over 180 degrees lie on both sides of the map."""

    def __init__(self, rings: pa.ListArray, boxes: pa.Array):
        self.size = _lengths(rings)
        flat = rings.flatten()
        lon, lat = (_numbers(flat.flatten()[flat.type.get_field_index(n)]) for n in ("lon", "lat"))
        self.first = np.cumsum(self.size) - self.size
        rows = len(rings)
        owner = np.repeat(np.arange(rows), self.size)
        low, high = np.full(rows, np.inf), np.full(rows, -np.inf)
        np.fmin.at(low, owner, lon)
        np.fmax.at(high, owner, lon)
        self.crosses = high - low > 180
        whole = np.where(lon < 0, lon + 360.0, lon)
        over = self.crosses[owner]
        shifted = np.where(over, whole, lon)
        self.x, self.y, self.owner = shifted, lat, owner
        box = _box(boxes)
        self.box, self.other = box, np.full_like(box, np.nan)
        at = np.flatnonzero(self.crosses)
        if len(at):
            west, east = np.full(rows, np.inf), np.full(rows, -np.inf)
            np.fmin.at(west, owner, whole)
            np.fmax.at(east, owner, whole)
            self.other[:, at] = box[:, at]
            self.box = box.copy()
            self.box[0, at], self.box[2, at] = west[at], 180.0
            self.other[0, at], self.other[2, at] = -180.0, east[at] - 360.0

    def chains(self, at: np.ndarray) -> pa.ListArray:
        """Geometries of the rows ``at``, as :func:`geometry.item_area` makes them."""
        size, twice = self.size[at], self.crosses[at]
        copies = np.where(twice, 2, 1)
        row = np.repeat(np.arange(len(at)), copies)
        second = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
        length = size[row]
        offsets = np.concatenate([[0], np.cumsum(length)])
        place = np.repeat(self.first[at][row] - offsets[:-1], length) + np.arange(offsets[-1])
        x = self.x[place] - np.repeat(360.0 * second, length)
        points = pa.StructArray.from_arrays([pa.array(x), pa.array(self.y[place])], ["lon", "lat"])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), points)
        chain = pa.StructArray.from_arrays([pa.array(np.ones(len(row), bool)), lists], ["area", "points"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(copies)]), pa.int32()), chain)

    def neighbours(self) -> np.ndarray:
        """Rows in the order of a curve through the middles of their boxes."""
        x, y = (np.nan_to_num(np.clip((self.box[a] + self.box[a + 2]) / 2 + s, 0, 4 * s)) for a, s in ((0, 180), (1, 90)))
        code = np.zeros(len(x), np.uint64)
        for values, shift, scale in ((x, 0, 45), (y, 1, 90)):
            bits = (values * scale).astype(np.uint64)  # less than 16 bits for what is on the map
            for k in range(16):
                code |= ((bits >> np.uint64(k)) & np.uint64(1)) << np.uint64(2 * k + shift)
        return np.argsort(code, kind="stable")


class Held:
    """Query geometries by number, with their boxes."""

    def __init__(self, chains: pa.Array, boxes: pa.Array):
        edges = _Edges.of(chains)
        self.chains, self.box, self.count = chains, _box(boxes), edges.count
        self.box[:, edges.count == 0] = np.nan  # a geometry without points meets nothing
        self.bands: dict[int, _Bands] = {}
        few = edges.count <= MANY
        widest = int(edges.count[few].max(initial=0))
        place = np.arange(len(edges.row)) - edges.start[edges.row]
        take = few[edges.row]
        slot = (place[take], edges.row[take])
        self.edge = np.full((4, widest, len(edges.count)), np.nan)
        for k, values in enumerate((edges.x1, edges.y1, edges.x2, edges.y2)):
            self.edge[k][slot] = values[take]
        self.area = np.zeros((widest, len(edges.count)), bool)
        self.area[slot] = edges.area[take]
        self.firsts, self.first_start = edges.first_count, edges.first_start
        self.first_x, self.first_y = edges.first_x, edges.first_y
        ends = [np.abs(v[np.isfinite(v)]).max(initial=0.0) for v in (edges.x1, edges.y1, edges.x2, edges.y2)]
        self.reach = max(ends)

    def met(self, rings: Rings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of ``rings`` and the numbers of the geometries they meet, pair by pair, in bounded pieces."""
        order = rings.neighbours()
        far = np.abs(np.concatenate([rings.x, rings.y]))
        reach = max(self.reach, far[np.isfinite(far)].max(initial=0.0))
        grids = {}
        for n in np.unique(rings.size[~rings.crosses]):
            if 2 <= n <= MANY:
                rows = np.flatnonzero((rings.size == n) & ~rings.crosses)
                at = rings.first[rows] + np.arange(n)[:, None]
                where = np.zeros(len(rings.size), np.int64)
                where[rows] = np.arange(len(rows))
                grids[n] = (where, rings.x[at], rings.y[at])
        waiting, held = [], 0
        for i, r in self._overlaps(rings, order):
            waiting.append((i, r))
            held += len(i)
            if held >= HANDED:
                yield self._tested(rings, grids, reach, *map(np.concatenate, zip(*waiting)))
                waiting, held = [], 0
        if held:
            yield self._tested(rings, grids, reach, *map(np.concatenate, zip(*waiting)))

    def _overlaps(self, rings: Rings, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs whose boxes overlap, borders included."""

        def overlap(a, b):
            return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])

        whole = self._near(rings, order, np.arange(len(self.count)))
        begin = 0
        while begin < len(order):
            some = order[begin : begin + GROUP]
            near = self._near(rings, some, whole)
            some = some[: max(1, MATRIX // max(len(near), 1))]
            begin += len(some)
            if not len(near):
                continue
            b = self.box[:, None, near]
            hit = overlap(rings.box[:, some, None], b)
            if rings.crosses[some].any():
                hit |= overlap(rings.other[:, some, None], b)
            i, r = np.nonzero(hit)
            if len(i):
                yield some[i], near[r]

    def _near(self, rings: Rings, rows: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Geometries that may overlap any of the rows."""
        if not len(rows):
            return among[:0]
        b, keep = self.box[:, among], np.zeros(len(among), bool)
        for box in (rings.box[:, rows], rings.other[:, rows]):
            with np.errstate(invalid="ignore"):
                low, high = np.fmin.reduce(box[:2], axis=1), np.fmax.reduce(box[2:], axis=1)
            keep |= (low[0] <= b[2]) & (high[0] >= b[0]) & (low[1] <= b[3]) & (high[1] >= b[1])
        return among[keep]

    def _tested(self, rings, grids, reach, i, r) -> tuple[np.ndarray, np.ndarray]:
        hits = np.zeros(len(i), bool)
        large = self.count[r] > MANY
        for g in np.unique(r[large]):
            if g not in self.bands:
                self.bands[g] = _Bands(_Edges.of(self.chains.slice(g, 1)))
            at = np.flatnonzero(large & (r == g))
            hits[at] = meets_one(rings.chains(i[at]), self.bands[g])
        plain = ~large & ~rings.crosses[i] & (rings.size[i] >= 2) & (rings.size[i] <= MANY)
        for n, (where, x, y) in grids.items():
            at = np.flatnonzero(plain & (rings.size[i] == n))
            for begin in range(0, len(at), BLOCK):
                some = at[begin : begin + BLOCK]
                # the geometries of most edges come first: their further edges are those of a first part
                some = some[np.argsort((MANY - self.count[r[some]]).astype(np.uint8), kind="stable")]
                hits[some] = self._block(where[i[some]], r[some], rings.box[:, i[some]], x, y, reach)
        odd = np.flatnonzero(~large & ~plain)
        for begin in range(0, len(odd), BLOCK):
            some = odd[begin : begin + BLOCK]
            hits[some] = meets(rings.chains(i[some]), self.chains.take(pa.array(r[some])))
        return i[hits], r[hits]

    def _block(self, i, r, box, x, y, reach) -> np.ndarray:
        """Pairs of rings with equally many points and geometries of few edges, by falling number of edges."""
        count = self.count[r]
        upto = [int(np.searchsorted(-count, -e, side="left")) for e in range(int(count[0]))]  # pairs with more than e edges
        edges = [[np.take(v[e], r[:m], mode="clip") for v in self.edge] for e, m in enumerate(upto)]
        hits = self._holds(np.take(x[0], i), np.take(y[0], i), r, edges)
        left = np.flatnonzero(~hits)
        held = self._held_in(i[left], r[left], x, y)
        hits[left[held]] = True
        left = left[~held]
        if len(left):
            edges = [[np.take(v, left[: np.searchsorted(left, m)], mode="clip") for v in e] for e, m in zip(edges, upto)]
            hits[left] = self._crossed(i[left], np.take(box, left, axis=1), x, y, edges, reach)
        return hits

    def _holds(self, px, py, r, edges) -> np.ndarray:
        """Whether a geometry's area holds a point."""
        odd = np.zeros(len(r), bool)
        with np.errstate(divide="ignore", invalid="ignore"):
            for e, (x1, y1, x2, y2) in enumerate(edges):
                m = len(x1)
                up = self.area[e, r[:m]] & ((y1 > py[:m]) != (y2 > py[:m]))
                odd[:m] ^= up & (px[:m] < (x2 - x1) * (py[:m] - y1) / (y2 - y1) + x1)
        return odd

    def _held_in(self, i, r, x, y) -> np.ndarray:
        """Whether a ring holds the first point of a chain of the geometry."""
        found, firsts = np.zeros(len(i), bool), self.firsts[r]
        for k in range(int(firsts.max(initial=0))):
            at = np.flatnonzero((firsts > k) & ~found)
            px, py = self.first_x[self.first_start[r[at]] + k], self.first_y[self.first_start[r[at]] + k]
            own = i[at]
            above = np.take(y, own, axis=1) > py
            edge, pair = np.nonzero(above[1:] != above[:-1])
            mine = own[pair]
            x1, y1, x2, y2 = x[edge, mine], y[edge, mine], x[edge + 1, mine], y[edge + 1, mine]
            ahead = px[pair] < (x2 - x1) * (py[pair] - y1) / (y2 - y1) + x1
            found[at] |= np.bincount(pair[ahead], minlength=len(at)) % 2 == 1
        return found

    def _crossed(self, i, box, x, y, edges, reach) -> np.ndarray:
        """Whether edges touch.

        Edges of a ring whose ends lie on one side of the other edge for certain do not. That is seen in short
        numbers, counted from a point nearby; all that is closer than their error is worked out in full.
        """
        found = np.zeros(len(i), bool)
        ox, oy = (np.nan_to_num(box[a : a + 3 : 2].mean()) for a in (0, 1))
        px, py = (np.take((v - o).astype(np.float32), i, axis=1) for v, o in ((x, ox), (y, oy)))
        own = max(np.abs(px).max(initial=0.0), np.abs(py).max(initial=0.0))
        for x1, y1, x2, y2 in edges:
            m = len(x1)
            near = ~found[:m] & (np.minimum(x1, x2) <= box[2, :m]) & (np.maximum(x1, x2) >= box[0, :m])
            near &= (np.minimum(y1, y2) <= box[3, :m]) & (np.maximum(y1, y2) >= box[1, :m])
            at = np.flatnonzero(near)
            if not len(at):
                continue
            if 2 * len(at) > m:
                at, cx, cy = np.arange(m), px[:, :m], py[:, :m]
            else:
                cx, cy = np.take(px, at, axis=1), np.take(py, at, axis=1)
                x1, y1, x2, y2 = x1[at], y1[at], x2[at], y2[at]
            dx, dy = x2 - x1, y2 - y1
            level = dx * (y1 - oy) - dy * (x1 - ox)
            size = np.abs(dx) + np.abs(dy)
            error = 1e-6 * size * (own + np.abs(x1 - ox) + np.abs(y1 - oy)) + 8e-15 * reach * size
            side = cy * dx.astype(np.float32)
            side -= cx * dy.astype(np.float32)
            left, right = side > (level + error).astype(np.float32), side < (level - error).astype(np.float32)
            edge, pair = np.nonzero(~(left[1:] & left[:-1] | right[1:] & right[:-1]))
            mine = i[at[pair]]
            ends = [v[edge + k, mine] for k in (0, 1) for v in (x, y)]
            other = [v[pair] for v in (x1, y1, x2, y2)]
            close = (np.minimum(ends[0], ends[2]) <= np.maximum(other[0], other[2]))
            close &= np.maximum(ends[0], ends[2]) >= np.minimum(other[0], other[2])
            close &= np.minimum(ends[1], ends[3]) <= np.maximum(other[1], other[3])
            close &= np.maximum(ends[1], ends[3]) >= np.minimum(other[1], other[3])
            close = np.flatnonzero(close)
            if len(close):
                touch = _touch(_Ends(*[v[close] for v in ends]), slice(None), _Ends(*[v[close] for v in other]), slice(None))
                found[at[pair[close[touch]]]] = True
        return found


class _Ends:
    def __init__(self, x1, y1, x2, y2):
        self.x1, self.y1, self.x2, self.y2 = x1, y1, x2, y2
