"""K5: leaves of a quadtree and the tree of edge boxes against every edge of every ring."""

import numpy as np
import pytest

from genoflux.operators import geo, quadtree


def star(r, n, x, y, radius, jag):
    a = np.sort(r.random(n)) * 2 * np.pi
    far = radius * (1 + jag * (r.random(n) - 0.5))
    return [(float(x + f * np.cos(t)), float(y + f * np.sin(t))) for f, t in zip(far, a, strict=True)]


def shapes(seed):
    """A long coast with a hole, an island in the hole, and a square whose edges lie on whole numbers."""
    r = np.random.default_rng(seed)
    return [[star(r, 1500, 10, 20, 50, 0.3), star(r, 300, 10, 20, 25, 0.4), star(r, 40, 10, 20, 6, 0.2)], [[(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]], [], [[(3.0, 3.0)]]]


def spots(seed):
    r = np.random.default_rng(seed)
    xs = np.concatenate([r.uniform(-70, 90, 1500), r.integers(-2, 10, 150)]).astype(float)
    ys = np.concatenate([r.uniform(-50, 90, 1500), r.integers(-2, 10, 150)]).astype(float)
    return sorted({(float(y), float(x)) for x, y in zip(xs, ys, strict=True)})


def table(spark, polygons):
    rows = [("abcdefgh"[i], i, [[{"x": x, "y": y} for x, y in ring] for ring in p]) for i, p in enumerate(polygons)]
    return spark.createDataFrame(rows, "basin_name string, poly_ord int, rings array<array<struct<x double, y double>>>")


@pytest.mark.parametrize("leaf", [4, 32])
def test_leaves_hold_what_the_rings_hold(spark, leaf):
    polygons, points = shapes(leaf), spots(leaf)
    leafs = quadtree.materialize(quadtree.cells(table(spark, polygons), ["basin_name", "poly_ord"], leaf), "leaves")
    got = {tuple(r) for r in quadtree.hits(spark.createDataFrame(points, "point_lat double, point_lon double"), leafs, ["poly_ord"]).collect()}
    y, x = np.array(points).T
    want = set()
    for i, p in enumerate(polygons):
        inside = geo.rings_contain(x, y, [np.array(ring) for ring in p])
        want |= {(la, lo, i) for (la, lo), k in zip(points, inside, strict=True) if k}
    assert got == want and len(want) > 300
    edges = leafs.selectExpr("max(size(edges))", "sum(size(edges))", "count_if(size(edges) = 0)").first()
    # A leaf ships its own edges only, some squares none, and the edges in all are few times those of the rings.
    assert edges[0] <= leaf and edges[2] > 0 and edges[1] < (12 if leaf == 4 else 6) * 1850


def test_no_polygons(spark):
    empty = table(spark, []).where("poly_ord < 0")
    assert quadtree.hits(spark.createDataFrame([(1.0, 2.0)], "point_lat double, point_lon double"), quadtree.cells(empty, ["poly_ord"]), ["poly_ord"]).count() == 0
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, None)], "id string, lat double, lon double")
    assert {r["ocean_basin"] for r in geo.assign_basins(df, empty).collect()} == {"Unknown"}


def test_nearest_edges_equal_all_edges():
    r = np.random.default_rng(3)
    for rings in shapes(5)[:2]:
        x, y = r.uniform(-70, 90, 700), r.uniform(-50, 90, 700)
        nx, ny = geo.nearest_edges(x, y, [np.array(ring) for ring in rings])
        best = np.full(len(x), np.inf)
        for ring in rings:
            a = np.array(ring)
            d = np.roll(a, -1, axis=0) - a
            t = np.clip(((x[:, None] - a[:, 0]) * d[:, 0] + (y[:, None] - a[:, 1]) * d[:, 1]) / (d**2).sum(1), 0, 1)
            best = np.minimum(best, ((a[:, 0] + t * d[:, 0] - x[:, None]) ** 2 + (a[:, 1] + t * d[:, 1] - y[:, None]) ** 2).min(1))
        assert np.array_equal((nx - x) ** 2 + (ny - y) ** 2, best)


def test_parts_of_one_feature_snap_to_their_own_coast(spark):
    """Two parts share a poly_ord; points go to the coast of the part they lie in, in many parts of work."""
    square = lambda x: [[(x, 0.0), (x + 4, 0.0), (x + 4, 4.0), (x, 4.0)]]
    land = table(spark, [square(0.0), square(10.0)]).selectExpr("basin_name", "0 AS poly_ord", "rings")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 13.5), (2.0, 7.0), (None, 1.0)], "latitude double, longitude double")
    got = {(r["latitude"], r["longitude"], r["location_type"]) for r in geo.classify_coordinates(df, land, "snap").collect()}
    assert got == {(0.0, 2.0, "snapped_to_coast"), (2.0, 14.0, "snapped_to_coast"), (2.0, 7.0, "precise"), (None, 1.0, "precise")}
    marked = {(r["longitude"], r["location_type"]) for r in geo.classify_coordinates(df, land).collect()}
    assert marked == {(2.0, "country_centroid"), (13.5, "country_centroid"), (7.0, "precise"), (1.0, "precise")}
    assert geo.classify_coordinates(df, land, "drop").count() == 2


def teeth(n):
    """A band with narrow teeth north and south, as long whatever their number, and a hole alike."""
    k = np.arange(n)
    row = lambda x, y: list(zip(x.tolist(), y.tolist(), strict=True))
    outer = row(-170 + 340 * k / n, 9 + (k * 7919 % 1000) / 100) + row(-170 + 340 * k[::-1] / n, -9 - (k[::-1] * 6007 % 1000) / 100)
    return [outer, row(-120 + 240 * k / n, 1 + (k * 613 % 500) / 100) + row(-120 + 240 * k[::-1] / n, -1 - (k[::-1] * 419 % 500) / 100)]


def test_narrow_teeth_lie_in_few_leaves(spark):
    """Edges in leaves grow as those of the rings, not as their square; points are found as by all edges."""
    for n in (1000, 8000):
        rings = teeth(n)
        leafs = quadtree.materialize(quadtree.cells(table(spark, [rings]), ["poly_ord"]), "leaves")
        assert leafs.selectExpr("sum(size(edges))").first()[0] < 2 * 4 * n
    r = np.random.default_rng(4)
    points = sorted({(float(y), float(x)) for x, y in zip(r.uniform(-175, 175, 800), r.uniform(-22, 22, 800), strict=True)})
    y, x = np.array(points).T
    got = {tuple(p) for p in quadtree.hits(spark.createDataFrame(points, "point_lat double, point_lon double"), leafs, ["poly_ord"]).drop("poly_ord").collect()}
    arrays = [np.array(ring) for ring in rings]
    want = geo.rings_contain(x, y, arrays)
    assert got == {p for p, k in zip(points, want, strict=True) if k} and 100 < len(got) < 700
    flat = np.concatenate(arrays)
    assert np.array_equal(quadtree.inside(quadtree.edges_of([len(a) for a in arrays], *flat.T), x, y), want)


def test_nearest_of_narrow_teeth_takes_few_candidates():
    """Boxes of teeth are all as near; the vertices in them tell which to search."""
    a = np.array(teeth(20_000)[0])
    tree = quadtree.EdgeTree(quadtree.edges_of([len(a)], *a.T))
    seen, exact = [], tree._exact
    tree._exact = lambda x, y, k: (seen.append(len(k)), exact(x, y, k))[1]
    r = np.random.default_rng(6)
    x, y = r.uniform(-160, 160, 300), r.uniform(-8, 8, 300)
    nx, ny = tree.nearest(x, y)
    assert sum(seen) < 300 * 100
    for k in range(0, 300, 10):
        d = exact(np.full(len(a), x[k]), np.full(len(a), y[k]), np.arange(len(a)))[2]
        assert (nx[k] - x[k]) ** 2 + (ny[k] - y[k]) ** 2 == d.min()
