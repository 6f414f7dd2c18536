"""Shapefiles made byte by byte, ranges, holes, writing; projections against published numbers."""

import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoflux.functions import projection
from genoflux.sources import shapefile
from genoflux.sources.shapefile import polygons_of

CLARKE = {"a": 6378206.4, "f": 1 / 294.978698214}
#: Worked examples of a published manual of projections: lon, lat, x, y.
KNOWN = [
    (projection.Projection("transverse", **CLARKE, lon0=-75.0, scale=0.9996), -73.5, 40.5, 127106.5, 4484124.4),
    (projection.Projection("mercator", **CLARKE, lon0=-180.0), -75.0, 35.0, 11688673.7, 4139145.6),
    (projection.Projection("lambert", **CLARKE, lon0=-96.0, lat0=23.0, parallels=(33.0, 45.0)), -75.0, 35.0, 1894410.9, 1564649.5),
]
LAEA_FREE = 'PROJCS["x",GEOGCS["g",DATUM["d",SPHEROID["Clarke 1866",6378206.4,294.978698214]],UNIT["Degree",0.0174532925199433]],PROJECTION["Lambert_Conformal_Conic"],PARAMETER["False_Easting",100.0],PARAMETER["False_Northing",-50.0],PARAMETER["Central_Meridian",-96.0],PARAMETER["Standard_Parallel_1",33.0],PARAMETER["Standard_Parallel_2",45.0],PARAMETER["Latitude_Of_Origin",23.0],UNIT["Kilometer",1000.0]]'


def ring(x, y, size, clockwise=True):
    square = [(x, y), (x, y + size), (x + size, y + size), (x + size, y), (x, y)]
    return square if clockwise else square[::-1]


def polygon(rings, kind=5):
    points = [p for r in rings for p in r]
    starts = np.cumsum([0, *(len(r) for r in rings[:-1])])
    box = (min(p[0] for p in points), min(p[1] for p in points), max(p[0] for p in points), max(p[1] for p in points))
    body = struct.pack("<i4d2i", kind, *box, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
    return body + (struct.pack(f"<{2 + len(points)}d", *[0.0] * (2 + len(points))) if kind == 15 else b"")


def write(path, shapes, rows, fields, prj=None):
    at, index, body = 50, b"", b""
    for k, s in enumerate(shapes):
        index += struct.pack(">2i", at, len(s) // 2)
        body += struct.pack(">2i", k + 1, len(s) // 2) + s
        at += 4 + len(s) // 2
    head = lambda words: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    (path.with_suffix(".shp")).write_bytes(head(at) + body)
    (path.with_suffix(".shx")).write_bytes(head(50 + 4 * len(shapes)) + index)
    table = struct.pack("<4BI2H20x", 3, 100, 1, 1, len(rows), 33 + 32 * len(fields), 1 + sum(w for _, w in fields))
    table += b"".join(struct.pack("<11sc4x2B14x", n.encode(), b"C", w, 0) for n, w in fields) + b"\r"
    table += b"".join(b" " + b"".join(v.encode().ljust(w) for v, (_, w) in zip(r, fields, strict=True)) for r in rows)
    (path.with_suffix(".dbf")).write_bytes(table)
    if prj:
        path.with_suffix(".prj").write_text(prj)


def test_parts_holes_and_ranges(spark, tmp_path):
    shapes = [
        polygon([ring(0, 0, 10), ring(2, 2, 6, False), ring(4, 4, 1), ring(20, 0, 5)]), struct.pack("<i", 0), polygon([ring(50, 50, 4)], 15), polygon([ring(60, 0, 3, False)]),
        *[polygon([ring(-k, -k, 0.5)]) for k in range(1, 30)],
    ]
    rows = [["r0", "Alpha é"], ["r1", "Beta"], ["r2", ""], ["r3", "Delta"], *[[f"r{k}", f"n{k}"] for k in range(4, 33)]]
    write(tmp_path / "seas", shapes, rows, [("ID", 6), ("NAME", 12)])
    spark.dataSource.register(shapefile.ShapefileSource)
    path = str(tmp_path / "seas.shp")
    raw = spark.read.format("shapefile").option("rangeRecords", 5).load(path).collect()
    got = {(r["ord"], r["part"]): [len(x) for x in r["rings"]] for r in raw}
    # The ring in the hole is an outer one of its own; the null shape has no row; a lone ring turned the other way stays.
    assert {k: v for k, v in got.items() if k[0] < 4} == {(0, 0): [4, 4], (0, 1): [4], (0, 2): [4], (2, 0): [4], (3, 0): [4]}
    assert len(raw) == 5 + 29
    read = shapefile.read_shapefile(spark, path)
    names = {(r["poly_ord"], r["part"]): r["basin_name"] for r in read.collect()}
    assert names[(0, 2)] == "Alpha é" and names[(2, 0)] is None and names[(32, 0)] == "n32"
    box = read.where("poly_ord = 0 AND part = 0").first()
    assert (box["xmin"], box["ymin"], box["xmax"], box["ymax"]) == (0, 0, 10, 10)


def test_holes_belong_to_the_smallest_ring_around():
    a = [np.array(r, float) for r in (ring(0, 0, 100), ring(10, 10, 50, False), ring(20, 20, 30), ring(25, 25, 5, False))]
    assert [[len(r) for r in p] for p in polygons_of(a)] == [[4, 4], [4, 4]]
    assert polygons_of(a)[1][1][0].tolist() in ([25, 25], [30, 25])


def test_written_and_read_back(spark, tmp_path):
    rows = [(k, f"é{k}", [[{"x": float(k), "y": 0.0}, {"x": k + 1.0, "y": 0.0}, {"x": k + 1.0, "y": 1.0}], [{"x": k + 0.5, "y": 0.1}, {"x": k + 0.9, "y": 0.1}, {"x": k + 0.9, "y": 0.2}]]) for k in range(40)]
    df = spark.createDataFrame([*rows, (40, None, None)], "id int, name string, rings array<array<struct<x double, y double>>>")
    path = str(tmp_path / "out")
    shapefile.write_shapefile(df.repartition(3), path)
    names = os.listdir(path)
    assert len(names) == 12 and not any(n.startswith(".") for n in names)
    got = {r["attributes"]["id"]: r for r in shapefile.read_shapefile(spark, path).collect()}
    assert len(got) == 40
    for k, name, rings in rows:
        assert got[str(k)]["basin_name"] == name
        assert [{(v["x"], v["y"]) for v in r} for r in got[str(k)]["rings"]] == [{(v["x"], v["y"]) for v in r} for r in rings]


def test_failed_write_leaves_nothing(spark, tmp_path):
    df = spark.range(20).repartition(2).select(F.col("id"), F.when(F.col("id") == 19, F.raise_error(F.lit("no"))).otherwise(F.lit("a")).cast("string").alias("name"), F.expr("array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D), named_struct('x', 1D, 'y', 1D)))").alias("rings"))
    with pytest.raises(Exception):
        shapefile.write_shapefile(df, str(tmp_path / "out"))
    left = os.listdir(tmp_path / "out") if (tmp_path / "out").exists() else []
    assert not [n for n in left if not n.startswith(".")]


@pytest.mark.parametrize("known", KNOWN, ids=lambda k: k[0].kind)
def test_published_numbers(spark, known):
    p, lon, lat, x, y = known
    e, n = projection.from_degrees(F.lit(lon), F.lit(lat), p)
    back = projection.to_degrees(F.lit(x), F.lit(y), p)
    r = spark.range(1).select(e.alias("x"), n.alias("y"), back[0].alias("lon"), back[1].alias("lat")).first()
    assert abs(r["x"] - x) < 0.1 and abs(r["y"] - y) < 0.1
    assert abs(r["lon"] - lon) < 1e-6 and abs(r["lat"] - lat) < 1e-6


def test_projection_text_beside_a_file(spark, tmp_path):
    p = projection.parse(LAEA_FREE)
    assert p == projection.Projection("lambert", **CLARKE, lon0=-96.0, lat0=23.0, parallels=(33.0, 45.0), east=100000.0, north=-50000.0, unit=1000.0)
    x, y = 1894.4109 + 100, 1564.6495 - 50
    write(tmp_path / "sea", [polygon([[(x, y), (x, y + 1), (x + 1, y), (x, y)]])], [["s"]], [("NAME", 5)], LAEA_FREE)
    got = shapefile.read_shapefile(spark, str(tmp_path / "sea.shp")).first()["rings"][0][0]
    assert abs(got["x"] + 75) < 1e-5 and abs(got["y"] - 35) < 1e-5
    assert projection.parse('GEOGCS["WGS 84"]').kind == "degrees"
    with pytest.raises(ValueError):
        projection.parse('PROJECTION["Robinson"]')


def test_long_hole_finds_its_ring_by_leaves(monkeypatch):
    """A hole of thousands of vertices meets few edges of each ring: all vertices by all edges never meet."""
    from genoflux.operators import geo

    met, plain = [], geo.rings_contain
    monkeypatch.setattr(geo, "rings_contain", lambda x, y, rings: (met.append(len(x) * sum(map(len, rings))), plain(x, y, rings))[1])

    def jagged(n, x0, x1, y, high):
        k = np.arange(n)
        up = np.column_stack([x0 + (x1 - x0) * k / n, y + high + (k * 7919 % 1000) / 500 * high])
        return np.vstack([up, np.column_stack([up[:, 0], y - high - (k * 6007 % 1000) / 500 * high])[::-1]])

    rings = [jagged(8000, -170, 170, -30, 4), jagged(8000, -170, 170, 30, 4), jagged(4000, -100, 100, 30, 1)[::-1], jagged(4000, -100, 100, -30, 1)[::-1], jagged(4000, -100, 100, 0, 1)[::-1]]
    got = shapefile.polygons_of(rings)
    assert [len(p) for p in got] == [2, 2, 1] and got[0][1] is not None
    assert (got[0][1] == rings[3]).all() and (got[1][1] == rings[2]).all()
    assert sum(met) < 8000 * 16000 / 10
