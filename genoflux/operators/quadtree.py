"""Points in polygons by an adaptive quadtree, and nearest edges by a packed tree of boxes.

``cells`` turns every polygon (a row) to leaves of a quadtree over the plane: boxes of the sides
SIDE / 2^lx and SIDE / 2^ly, divided while more than ``leaf`` edges touch them. Boxes of one depth are
halved on both sides, or on one alone where halving the other would cut far more edges: narrow
teeth of a jagged coast lie in narrow boxes, so that leaves have few times the edges of the rings.
A leaf has the edges that touch it
(its own, no others), a reference point, and whether that point is inside. A leaf
without edges lies wholly inside; leaves wholly outside are left out. So a point needs a
test only against the edges of its own leaf: it is inside if its reference point is,
turned by each edge between the two. Points and leaves meet by an equi-join on the sides and the box,
and the test is an expression of the JVM. A polygon's tree is built where its row
stands, all boxes of a depth together and AT_ONCE edges at a time, and put out in blocks,
so no polygon goes to the driver and no pair carries a whole ring.

The result is that of the even-odd rule over all rings (holes included); points on an edge are outside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.storage import materialize

#: Side of the boxes of level 0, edges of a leaf, and the deepest level (some 40 m).
SIDE, LEAF, DEEPEST = 512.0, 32, 20
#: Edges of boxes that are divided together.
AT_ONCE = 1 << 19
#: Where in a box its reference point lies; tried in turn until no vertex is level with it.
_SPOTS = [0.3819660112501051, 0.4142135623730951, 0.2360679774997896, 0.6180339887498949]
EDGE = "array<struct<ax double, ay double, bx double, by double>>"
LEAVES = f"lx int, ly int, cx bigint, cy bigint, rx double, ry double, inside boolean, edges {EDGE}"


def flat(polygons: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` with the rings as three plain arrays: vertices of each ring, x and y of all."""
    axis = lambda c: F.flatten(F.transform("rings", lambda r: F.transform(r, lambda v: v[c]))).cast("array<double>")
    return polygons.select(*keep, F.transform("rings", lambda r: F.size(r)).alias("sizes"), axis("x").alias("xs"), axis("y").alias("ys"))


def edges_of(sizes, xs, ys) -> np.ndarray:
    """Rows ax, ay, bx, by of all rings, closed."""
    if sizes is None or not len(sizes):
        return np.zeros((0, 4))
    sizes = np.asarray(sizes, dtype=np.int64)
    last = np.cumsum(sizes)[sizes > 0] - 1
    after = np.arange(1, len(xs) + 1)
    after[last] = last + 1 - sizes[sizes > 0]
    out = np.empty((len(xs), 4))
    out[:, 0], out[:, 1] = xs, ys
    out[:, 2], out[:, 3] = out[after, 0], out[after, 1]
    return out


def _turned(e: np.ndarray, x0, y0, x1, y1) -> np.ndarray:
    """The edges by which the even-odd state differs between two points: along y0 to x1, then along x1 to y1."""
    ax, ay, bx, by = e.T
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (bx - ax) * (y0 - ay) / (by - ay) + ax
        up = (by - ay) * (x1 - ax) / (bx - ax) + ay
    level = ((ay > y0) != (by > y0)) & ((x0 < at) != (x1 < at))
    upright = ((ax > x1) != (bx > x1)) & ((y0 < up) != (y1 < up))
    return level != upright


def _on(e: np.ndarray, x, y) -> np.ndarray:
    ax, ay, bx, by = e.T
    within = (np.minimum(ax, bx) <= x) & (x <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= y) & (y <= np.maximum(ay, by))
    return within & ((bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0)


def _touch(e: np.ndarray, x, y, wide, high) -> np.ndarray:
    """Edges that meet a box, by the separating axes of a box and a segment; in doubt they do."""
    ax, ay, bx, by = e.T
    ex, ey = wide * 1e-9, high * 1e-9
    lo_x, hi_x, lo_y, hi_y = x - ex, x + wide + ex, y - ey, y + high + ey
    box = (np.minimum(ax, bx) <= hi_x) & (np.maximum(ax, bx) >= lo_x) & (np.minimum(ay, by) <= hi_y) & (np.maximum(ay, by) >= lo_y)
    dx, dy = bx - ax, by - ay
    corners = [dx * (cy - ay) - dy * (cx - ax) for cx in (lo_x, hi_x) for cy in (lo_y, hi_y)]
    slack = ey * np.abs(dx) + ex * np.abs(dy)
    return box & ~(np.all([c > slack for c in corners], axis=0) | np.all([c < -slack for c in corners], axis=0))


@dataclass
class _Boxes:
    """Boxes of one depth, and the edges that touch them as pairs (box, edge), by box."""

    lx: int
    ly: int
    cx: np.ndarray
    cy: np.ndarray
    rx: np.ndarray
    ry: np.ndarray
    inside: np.ndarray
    box: np.ndarray
    edge: np.ndarray

    @property
    def sides(self) -> tuple[float, float]:
        return SIDE / 2.0**self.lx, SIDE / 2.0**self.ly

    def counts(self) -> np.ndarray:
        return np.bincount(self.box, minlength=len(self.cx))

    def where(self, keep: np.ndarray) -> "_Boxes":
        pairs = keep[self.box]
        number = np.cumsum(keep) - 1
        return _Boxes(self.lx, self.ly, *(v[keep] for v in (self.cx, self.cy, self.rx, self.ry, self.inside)), number[self.box[pairs]], self.edge[pairs])


def _runs(n: int) -> Iterator[slice]:
    for at in range(0, n, AT_ONCE):
        yield slice(at, at + AT_ONCE)


def _refer(e: np.ndarray, b: _Boxes) -> None:
    """Points of the boxes through which no vertex's upright or level line goes, if there are some among the spots."""
    (wide, high), todo = b.sides, np.ones(len(b.cx), bool)
    for spot in _SPOTS:
        b.rx = np.where(todo, (b.cx + spot) * wide, b.rx)
        b.ry = np.where(todo, (b.cy + spot) * high, b.ry)
        todo = np.zeros(len(b.cx), bool)
        for part in _runs(len(b.box)):
            own, at = e[b.edge[part]], b.box[part]
            level = (own[:, 0] == b.rx[at]) | (own[:, 2] == b.rx[at]) | (own[:, 1] == b.ry[at]) | (own[:, 3] == b.ry[at])
            todo[at[level]] = True
        if not todo.any():
            break


def _divided(e: np.ndarray, b: _Boxes, deepest: int) -> _Boxes:
    """The boxes' halves on both sides, or on the one that cuts far fewer edges."""
    (wide, high), m, cut = b.sides, len(b.cx), np.zeros(2)
    for part in _runs(len(b.box)):
        own, at = e[b.edge[part]], b.box[part]
        for axis, middle in enumerate(((b.cx[at] + 0.5) * wide, (b.cy[at] + 0.5) * high)):
            cut[axis] += ((own[:, axis] > middle) != (own[:, axis + 2] > middle)).sum()
    share = cut / max(len(b.box), 1)
    x_too, y_too = b.lx < deepest, b.ly < deepest
    if x_too and y_too:
        x_too, y_too = share[0] <= 2 * share[1] + 0.25, share[1] <= 2 * share[0] + 0.25
    parts = [(i, j) for i in range(1 + x_too) for j in range(1 + y_too)]
    lx, ly = b.lx + x_too, b.ly + y_too
    cx, cy = np.concatenate([b.cx * (1 + x_too) + i for i, _ in parts]), np.concatenate([b.cy * (1 + y_too) + j for _, j in parts])
    new = _Boxes(lx, ly, cx, cy, np.zeros(len(cx)), np.zeros(len(cx)), np.tile(b.inside, len(parts)), np.zeros(0, int), np.zeros(0, int))
    wide, high = new.sides
    boxes, edges = [], []
    for k in range(len(parts)):
        for part in _runs(len(b.box)):
            at = b.box[part] + k * m
            met = _touch(e[b.edge[part]], cx[at] * wide, cy[at] * high, wide, high)
            boxes.append(at[met])
            edges.append(b.edge[part][met])
    new.box, new.edge = np.concatenate(boxes), np.concatenate(edges)
    _refer(e, new)
    for k in range(len(parts)):
        turns = np.zeros(m, int)
        for part in _runs(len(b.box)):
            old = b.box[part]
            turned = _turned(e[b.edge[part]], b.rx[old], b.ry[old], new.rx[old + k * m], new.ry[old + k * m])
            turns += np.bincount(old[turned], minlength=m)
        new.inside[k * m : (k + 1) * m] ^= turns % 2 == 1
    return new


def leaves(e: np.ndarray, leaf: int = LEAF, deepest: int = DEEPEST) -> Iterator[_Boxes]:
    """The leaves of one polygon with the edges ``e``, in blocks."""
    if not len(e):
        return
    first = int(np.floor(np.log2(SIDE / max(np.ptp(e[:, ::2]), np.ptp(e[:, 1::2]), SIDE / (1 << deepest)))))
    side = SIDE / 2.0**first
    cx, cy = (v.ravel() for v in np.meshgrid(*(np.arange(int(e[:, k::2].min() // side), int(e[:, k::2].max() // side) + 1) for k in (0, 1))))
    top = _Boxes(first, first, cx, cy, np.zeros(len(cx)), np.zeros(len(cx)), np.zeros(len(cx), bool), np.zeros(0, int), np.zeros(0, int))
    met = [np.concatenate([np.flatnonzero(_touch(e[part], x * side, y * side, side, side)) + part.start for part in _runs(len(e))]) for x, y in zip(cx, cy, strict=True)]
    top.box, top.edge = np.repeat(np.arange(len(cx)), [len(k) for k in met]), np.concatenate(met)
    _refer(e, top)
    # Far to the left everything is outside.
    left = e[:, ::2].min() - 1.0
    for k in range(len(cx)):
        top.inside[k] = sum(_turned(e[part], left, top.ry[k], top.rx[k], top.ry[k]).sum() for part in _runs(len(e))) % 2 == 1
    stack = [top]
    while stack:
        boxes = stack.pop()
        count = boxes.counts()
        done = count <= leaf
        if boxes.lx >= deepest and boxes.ly >= deepest:
            done[:] = True
        ready = done & ((count > 0) | boxes.inside)
        if ready.any():
            yield boxes.where(ready)
        if not done.all():
            boxes = boxes.where(~done)
            before = np.cumsum(boxes.counts())
            middle = int(np.searchsorted(before, before[-1] // 2)) + 1
            if before[-1] > AT_ONCE and middle < len(before):
                half = np.arange(len(before)) < middle
                stack += [boxes.where(half), boxes.where(~half)]
            else:
                stack.append(_divided(e, boxes, deepest))


def cells(polygons: DataFrame, keep: list[str], leaf: int = LEAF) -> DataFrame:
    """The columns ``keep`` and LEAVES of polygons with ``rings``."""
    given = flat(polygons, *keep)
    schema = T.StructType([*(given.schema[c] for c in keep), *T._parse_datatype_string(LEAVES).fields])
    names = ["ax", "ay", "bx", "by"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rings = [batch.column(c)[i].values for c in ("sizes", "xs", "ys")]
                if any(v is None for v in rings):
                    continue
                e = edges_of(*(v.to_numpy(zero_copy_only=False) for v in rings))
                for b in leaves(e, leaf):
                    n, own = len(b.cx), e[b.edge]
                    ends = np.concatenate([[0], np.cumsum(b.counts())])
                    edges = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(own[:, k]) for k in range(4)], names))
                    levels = [pa.array(np.full(n, v), pa.int32()) for v in (b.lx, b.ly)]
                    mine = [batch.column(c).take(pa.array(np.full(n, i))) for c in keep]
                    yield pa.RecordBatch.from_arrays([*mine, *levels, *(pa.array(v) for v in (b.cx, b.cy, b.rx, b.ry, b.inside)), edges], names=schema.names)

    return given.mapInArrow(run, schema)


def inside(e: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points lie strictly inside by the edges ``e``: the test of ``holds`` on arrays."""
    out = np.zeros(len(x), bool)
    key = lambda cx, cy: cx.astype(np.int64) * (1 << 32) + cy.astype(np.int64)
    for b in leaves(e):
        (wide, high), count = b.sides, b.counts()
        order, start = np.argsort(key(b.cx, b.cy)), np.cumsum(count) - count
        have, want = key(b.cx, b.cy)[order], key(np.floor(x / wide), np.floor(y / high))
        at = np.minimum(np.searchsorted(have, want), len(have) - 1)
        point = np.flatnonzero(have[at] == want)
        for s in range(0, len(point), 1 << 14):
            p = point[s : s + (1 << 14)]
            own = order[at[p]]
            pair = np.repeat(np.arange(len(p)), count[own])
            edge = b.edge[np.arange(len(pair)) - np.repeat(np.cumsum(count[own]) - count[own], count[own]) + start[own][pair]]
            turned = _turned(e[edge], x[p][pair], y[p][pair], b.rx[own][pair], b.ry[own][pair])
            odd = np.bincount(pair[turned], minlength=len(p)) % 2 == 1
            edged = np.bincount(pair[_on(e[edge], x[p][pair], y[p][pair])], minlength=len(p)) > 0
            out[p] = (b.inside[own] != odd) & ~edged
    return out


def holds(px: Column, py: Column) -> Column:
    """Whether a leaf's row holds the point: the same arithmetic as ``_turned``."""

    def turned(n: Column, e: Column) -> Column:
        ax, ay, bx, by = e["ax"], e["ay"], e["bx"], e["by"]
        rx, ry = F.col("rx"), F.col("ry")
        at, up = F.try_divide((bx - ax) * (py - ay), by - ay) + ax, F.try_divide((by - ay) * (rx - ax), bx - ax) + ay
        level = ((ay > py) != (by > py)) & ((px < at) != (rx < at))
        upright = ((ax > rx) != (bx > rx)) & ((py < up) != (ry < up))
        return n + F.coalesce(level, F.lit(False)).cast("int") + F.coalesce(upright, F.lit(False)).cast("int")

    def on(e: Column) -> Column:
        ax, ay, bx, by = e["ax"], e["ay"], e["bx"], e["by"]
        within = (F.least(ax, bx) <= px) & (px <= F.greatest(ax, bx)) & (F.least(ay, by) <= py) & (py <= F.greatest(ay, by))
        return within & ((bx - ax) * (py - ay) - (by - ay) * (px - ax) == 0)

    odd = F.aggregate("edges", F.lit(0), turned) % 2 == 1
    return F.when(F.size("edges") == 0, F.col("inside")).otherwise((F.col("inside") != odd) & ~F.exists("edges", on))


def hits(spots: DataFrame, leafs: DataFrame, keep: list[str]) -> DataFrame:
    """point_lat, point_lon and ``keep`` of each polygon that holds the point.

    ``leafs``: written rows of ``cells``. The pairs of sides that occur are few (one for each depth of a
    polygon, alike for polygons alike); a point is looked up once on each.
    """
    levels = sorted(tuple(r) for r in leafs.select("lx", "ly").distinct().collect())
    if not levels:
        return spots.join(leafs.select(*keep).limit(0), F.lit(True), "cross").select("point_lat", "point_lon", *keep)
    side = lambda level: F.lit(SIDE) / F.pow(F.lit(2.0), level)
    place = spots.select("*", F.inline(F.array(*[F.struct(F.lit(x).alias("lx"), F.lit(y).alias("ly")) for x, y in levels])))
    place = place.withColumns({"cx": F.floor(F.col("point_lon") / side("lx")).cast("bigint"), "cy": F.floor(F.col("point_lat") / side("ly")).cast("bigint")})
    met = place.join(leafs, ["lx", "ly", "cx", "cy"])
    return met.where(holds(F.col("point_lon"), F.col("point_lat"))).select("point_lat", "point_lon", *keep)


def nearest_coast(pairs: DataFrame, polygons: DataFrame, key: str, rows: int = 50_000) -> DataFrame:
    """Adds x, y (the nearest point of the polygon's edges) and d (its squared distance, in
    degrees) to pairs of a point and the ``key`` of its polygon. The points of a polygon are dealt
    to parts of some ``rows``, of more where the polygon has over four times as many vertices, so that what the
    parts get of polygons grows as the tables; each part gets the polygon once and builds its tree."""
    vertices = polygons.select(key, F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r)).alias("vertices"))
    counted = pairs.groupBy(key).agg(F.count("*").alias("n")).join(vertices, key)
    parts = materialize(counted.select(key, F.ceil(F.col("n") / F.greatest(F.lit(rows), F.col("vertices") / 4)).cast("int").alias("parts")), "parts")
    dealt = pairs.join(F.broadcast(parts), key).withColumn("part", F.pmod(F.xxhash64("point_lat", "point_lon"), F.col("parts")).cast("int"))
    shapes = flat(polygons, key).join(parts, key).select(key, "sizes", "xs", "ys", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def run(points: pd.DataFrame, shape: pd.DataFrame) -> pd.DataFrame:
        x, y = points["point_lon"].to_numpy(float), points["point_lat"].to_numpy(float)
        nx, ny = EdgeTree(edges_of(*shape[["sizes", "xs", "ys"]].iloc[0]) if len(shape) else np.zeros((0, 4))).nearest(x, y)
        return pd.DataFrame({"point_lat": y, "point_lon": x, key: points[key], "x": nx, "y": ny, "d": (nx - x) ** 2 + (ny - y) ** 2})

    kind = dict(pairs.dtypes)[key]
    return dealt.groupBy(key, "part").cogroup(shapes.groupBy(key, "part")).applyInPandas(run, f"point_lat double, point_lon double, `{key}` {kind}, x double, y double, d double")


class EdgeTree:
    """Boxes of consecutive edges, FANOUT to a node, level on level; nearest edges by branch and bound.

    A node holds the vertices that lie farthest to each side: the nearest of them bounds the distance, also where
    boxes are long and hold thin teeth.
    """

    FANOUT, AT_ONCE, MOST = 8, 4096, 1 << 20

    def __init__(self, edges: np.ndarray):
        self.edges = edges
        #: Of each level above the edges: bounds (least x, y, greatest x, y) and the x, y of the vertices there.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n, low = len(edges), None
        while n > 1 or (n and low is None):
            at = np.arange(0, n, self.FANOUT)
            group = np.minimum(at[:, None] + np.arange(self.FANOUT), n - 1)
            vx, vy = np.empty((len(at), 4)), np.empty((len(at), 4))
            for k in range(4):
                if low is None:
                    x, y = edges[group][:, :, ::2].reshape(len(at), -1), edges[group][:, :, 1::2].reshape(len(at), -1)
                else:
                    x, y = low[0][group, k], low[1][group, k]
                best = [x.argmin, y.argmin, x.argmax, y.argmax][k](axis=1)
                vx[:, k], vy[:, k] = x[np.arange(len(at)), best], y[np.arange(len(at)), best]
            low, n = (vx, vy), len(at)
            self.levels.append((np.column_stack([vx[:, 0], vy[:, 1], vx[:, 2], vy[:, 3]]), vx, vy))

    def _exact(self, x: np.ndarray, y: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = self.edges[k]
        dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
        length = dx**2 + dy**2
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(length > 0, ((x - e[:, 0]) * dx + (y - e[:, 1]) * dy) / length, 0.0)
        t = np.clip(t, 0, 1)
        ex, ey = e[:, 0] + t * dx, e[:, 1] + t * dy
        return ex, ey, (ex - x) ** 2 + (ey - y) ** 2

    def nearest(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest point of the edges for each point; of equally near ones on the first edge."""
        nx, ny = x.astype(float), y.astype(float)
        work = [(s, min(s + self.AT_ONCE, len(x))) for s in range(0, len(x) if len(self.edges) else 0, self.AT_ONCE)]
        while work:
            s, end = work.pop()
            found = self._some(x[s:end].astype(float), y[s:end].astype(float))
            if found is None:  # too many candidates at once
                work += [(s, (s + end) // 2), ((s + end) // 2, end)]
            else:
                nx[s:end], ny[s:end] = found
        return nx, ny

    def _some(self, px: np.ndarray, py: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        point, node = np.arange(len(px)), np.zeros(len(px), int)
        most = np.full(len(px), np.inf)
        for level in range(len(self.levels), -1, -1):
            x_, y_ = px[point], py[point]
            if level:
                box, vx, vy = (v[node] for v in self.levels[level - 1])
            else:
                e = self.edges[node]
                vx, vy = e[:, ::2], e[:, 1::2]
                box = np.column_stack([vx.min(1), vy.min(1), vx.max(1), vy.max(1)])
            near = np.maximum(np.maximum(box[:, 0] - x_, x_ - box[:, 2]), 0) ** 2 + np.maximum(np.maximum(box[:, 1] - y_, y_ - box[:, 3]), 0) ** 2
            # A vertex lies on an edge, so it bounds the nearest distance.
            np.minimum.at(most, point, ((vx - x_[:, None]) ** 2 + (vy - y_[:, None]) ** 2).min(axis=1))
            good = near <= most[point] * (1 + 1e-12)
            point, node = point[good], node[good]
            if level:
                if len(point) * self.FANOUT > self.MOST and len(px) > 1:
                    return None
                node = (node[:, None] * self.FANOUT + np.arange(self.FANOUT)).ravel()
                point = np.repeat(point, self.FANOUT)
                real = node < (len(self.levels[level - 2][0]) if level > 1 else len(self.edges))
                point, node = point[real], node[real]
        ex, ey, d = self._exact(px[point], py[point], node)
        order = np.lexsort((node, d, point))
        first = order[np.concatenate([[True], np.diff(point[order]) > 0])]
        nx, ny = px.copy(), py.copy()
        nx[point[first]], ny[point[first]] = ex[first], ey[first]
        return nx, ny
