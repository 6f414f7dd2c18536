"""K5 and basin statistics: points in polygons, marine filters, snapping, summaries.

Polygons with rings meet points by leaves of a quadtree (``quadtree``): strict interior, even-odd,
holes; each leaf has its own edges only. Boxes are compared directly; they are broadcast up to
a checked number, else both meet on grid cells. The nearest coast is found by a tree of edge boxes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coords
from ..plans.storage import materialize
from ..schemas import struct
from . import quadtree

BROADCAST_VERTICES = 2_000_000
CELL = 5.0
#: Points times vertices in one array.
AT_ONCE = 1 << 20
#: The labels of the basins in the order of the charts.
BASIN_ORDER = [
    "North Atlantic Ocean",
    "South Atlantic Ocean",
    "Indian Ocean",
    "South China and Easter Archipelagic Seas",
    "South Pacific Ocean",
    "North Pacific Ocean",
]


def points(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """P10: coordinates out of range become null; rows stay."""
    missing = [c for c in (lat, lon) if c not in df.columns]
    if missing:
        raise ValueError(f"missing coordinate columns: {missing}")
    good = coords.in_range(F.col(lat), F.col(lon))
    return df.withColumns({"point_lat": F.when(good, F.col(lat)), "point_lon": F.when(good, F.col(lon))})


def as_rings(rings) -> list[np.ndarray]:
    return [np.array([(v["x"], v["y"]) for v in ring], dtype=float).reshape(-1, 2) for ring in (() if rings is None else rings)]


def _pieces(n: int, ring: np.ndarray) -> Iterator[slice]:
    """Points in runs, so that points times vertices stay within AT_ONCE."""
    step = max(1, AT_ONCE // max(len(ring), 1))
    for at in range(0, n, step):
        yield slice(at, at + step)


def rings_contain(x: np.ndarray, y: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Which points lie strictly inside an even-odd polygon; a point on an edge is outside."""
    inside, on_edge = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for a in rings:
        b = np.roll(a, -1, axis=0)
        ax, ay, bx, by = a[:, 0], a[:, 1], b[:, 0], b[:, 1]
        for part in _pieces(len(x), a):
            px, py = x[part, None], y[part, None]
            cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
            within = (np.minimum(ax, bx) <= px) & (px <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= py) & (py <= np.maximum(ay, by))
            on_edge[part] |= ((cross == 0) & within).any(axis=1)
            straddles = (ay > py) != (by > py)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = (bx - ax) * (py - ay) / (by - ay) + ax
            inside[part] ^= (straddles & (px < at)).sum(axis=1) % 2 == 1
    return inside & ~on_edge


def ring_contains(x: float, y: float, rings: list) -> bool:
    return bool(rings_contain(np.array([x], float), np.array([y], float), as_rings(rings))[0])


def nearest_edges(x: np.ndarray, y: np.ndarray, rings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest point of the rings' edges for each point, in plain degrees."""
    closed = [np.hstack([a, np.roll(a, -1, axis=0)]) for a in rings if len(a)]
    return quadtree.EdgeTree(np.concatenate(closed) if closed else np.zeros((0, 4))).nearest(x, y)


def nearest_edge(x: float, y: float, rings: list) -> tuple[float, float]:
    nx, ny = nearest_edges(np.array([x], float), np.array([y], float), as_rings(rings))
    return float(nx[0]), float(ny[0])


def _by_polygon(rings: pd.Series, held: Broadcast | None) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Rows of a batch and their polygon: all of one together where the rings are held."""
    if held is None:
        for k, r in enumerate(rings):
            yield np.array([k]), as_rings(r)
    else:
        for polygon, where in rings.groupby(rings).indices.items():
            yield where, held.value[polygon]


def contains(held: Broadcast | None) -> Column:
    @F.pandas_udf(T.BooleanType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ys, rings in batches:
            x, y, out = xs.to_numpy(float), ys.to_numpy(float), np.zeros(len(xs), bool)
            for where, polygon in _by_polygon(rings, held):
                out[where] = rings_contain(x[where], y[where], polygon)
            yield pd.Series(out)

    return run("point_lon", "point_lat", "rings")


def snapped(held: Broadcast | None) -> Column:
    """x, y of the nearest edge and d, the square of the distance."""

    @F.pandas_udf(struct("x double, y double, d double"))
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for xs, ys, rings in batches:
            x, y = xs.to_numpy(float), ys.to_numpy(float)
            nx, ny = x.copy(), y.copy()
            for where, polygon in _by_polygon(rings, held):
                nx[where], ny[where] = nearest_edges(x[where], y[where], polygon)
            yield pd.DataFrame({"x": nx, "y": ny, "d": (nx - x) ** 2 + (ny - y) ** 2})

    return run("point_lon", "point_lat", "rings")


def _in_box() -> Column:
    return (F.col("point_lon") > F.col("xmin")) & (F.col("point_lon") < F.col("xmax")) & (F.col("point_lat") > F.col("ymin")) & (F.col("point_lat") < F.col("ymax"))


def _hold(polygons: DataFrame) -> tuple[DataFrame, Broadcast]:
    """The polygons with a number in place of their rings, and the rings by that
    number as arrays, broadcast to the Python workers once."""
    axis = lambda c: F.transform("rings", lambda r: F.transform(r, lambda v: v[c]))
    spark = polygons.sparkSession
    found = polygons.withColumns({"__x": axis("x"), "__y": axis("y")}).drop("rings").toArrow()
    rings = [[np.column_stack([a, b]).astype(float) for a, b in zip(x.as_py() or (), y.as_py() or (), strict=True)] for x, y in zip(found["__x"], found["__y"], strict=True)]
    numbered = found.drop_columns(["__x", "__y"]).append_column("rings", pa.array(range(len(rings)), pa.int32()))
    return spark.createDataFrame(numbered), spark.sparkContext.broadcast(rings)


def boxed_pairs(spots: DataFrame, polygons: DataFrame, within: Column | None = None, margin: float = 0.0) -> tuple[DataFrame, Broadcast | None]:
    """Distinct points with the polygons whose box (widened by ``margin``) holds them.

    Polygons are broadcast up to BROADCAST_VERTICES (counted first): pairs then carry a
    polygon's number, not its rings, which the second result holds. Else both meet on
    grid cells and pairs carry the rings.
    """
    boxes = "rings" not in polygons.columns
    inside = _in_box() if within is None else within
    size = polygons.count() * 4 if boxes else polygons.agg(F.sum(F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r)))).first()[0] or 0
    if size <= BROADCAST_VERTICES:
        polygons, held = (polygons, None) if boxes else _hold(polygons)
        return spots.join(F.broadcast(polygons), inside), held
    cell = lambda c: F.floor(c / CELL).cast("int")
    spread = lambda lo, hi: F.sequence(cell(F.col(lo) - margin), cell(F.col(hi) + margin))
    cells = polygons.withColumn("cx", F.explode(spread("xmin", "xmax"))).withColumn("cy", F.explode(spread("ymin", "ymax")))
    pairs = spots.withColumns({"cx": cell(F.col("point_lon")), "cy": cell(F.col("point_lat"))}).join(cells, ["cx", "cy"])
    return pairs.where(inside).drop("cx", "cy"), None


def first_basin(spots: DataFrame, polygons: DataFrame) -> DataFrame:
    """point_lat, point_lon -> basin_name of the polygon with the lowest poly_ord that holds the point.

    ``spots`` are distinct points. Without a ``rings`` column polygons are boxes.
    """
    keep = ["basin_name", "poly_ord"]
    if "rings" in polygons.columns:
        found = quadtree.hits(spots, materialize(quadtree.cells(polygons, keep), "leaves"), keep)
    else:
        found = boxed_pairs(spots, polygons)[0]
    return found.groupBy("point_lat", "point_lon").agg(F.min_by("basin_name", "poly_ord").alias("basin_name"))


def assign_basins(
    df: DataFrame, polygons: DataFrame, lat: str = "lat", lon: str = "lon", coord: str | None = None, country_ocean: str | None = None,
    basin: str = "ocean_basin", fallback: bool = True,
) -> DataFrame:
    """Adds lat, lon and the basin; without a match the country/ocean text (if
    that column is named and ``fallback`` is set), else 'Unknown'."""
    if lat not in df.columns or lon not in df.columns:
        if not coord:
            raise ValueError("neither coordinate columns nor a coordinate text are given")
        pair = coords.embedded_pair(F.col(coord))
        df = df.withColumns({lat: pair["lat"], lon: pair["lon"]})
    located = points(df, lat, lon)
    spots = located.where("point_lat IS NOT NULL").select("point_lat", "point_lon").distinct()
    found = located.join(first_basin(spots, polygons), ["point_lat", "point_lon"], "left")
    named = F.coalesce("basin_name", F.nullif(F.trim(country_ocean), F.lit(""))) if country_ocean and fallback else F.col("basin_name")
    return found.withColumn(basin, F.coalesce(named, F.lit("Unknown"))).drop("point_lat", "point_lon", "basin_name")


def marine(df: DataFrame, polygons: DataFrame, lat: str = "lat", lon: str = "lon", remove: bool = True) -> DataFrame:
    """Rows within any polygon, or all rows with the flag is_marine."""
    located = points(df, lat, lon)
    spots = located.where("point_lat IS NOT NULL").select("point_lat", "point_lon").distinct()
    found = first_basin(spots, polygons).select("point_lat", "point_lon", F.lit(True).alias("is_marine"))
    out = located.join(found, ["point_lat", "point_lon"], "left").withColumn("is_marine", F.coalesce("is_marine", F.lit(False))).drop("point_lat", "point_lon")
    return out.where("is_marine").drop("is_marine") if remove else out


def valid_marine(df: DataFrame, polygons: DataFrame, buffer: float = 0.0, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Adds is_marine: the point lies in a polygon or within ``buffer`` degrees of one; null out of range.

    ``polygons`` have rings.
    """
    located = points(df, lat, lon)
    spots = located.where("point_lat IS NOT NULL").select("point_lat", "point_lon").distinct()
    x, y, m = F.col("point_lon"), F.col("point_lat"), F.lit(buffer)
    near = (x >= F.col("xmin") - m) & (x <= F.col("xmax") + m) & (y >= F.col("ymin") - m) & (y <= F.col("ymax") + m)
    pairs, held = boxed_pairs(spots, polygons, near, buffer)
    good = contains(held)
    if buffer > 0:
        good = good | (F.sqrt(snapped(held)["d"]) <= buffer)
    found = pairs.where(good).select("point_lat", "point_lon", F.lit(True).alias("is_marine")).distinct()
    out = located.join(found, ["point_lat", "point_lon"], "left")
    return out.withColumn("is_marine", F.when(F.col("point_lat").isNotNull(), F.coalesce("is_marine", F.lit(False)))).drop("point_lat", "point_lon")


def classify_coordinates(df: DataFrame, land: DataFrame, policy: str = "mark", lat: str = "latitude", lon: str = "longitude", column: str = "location_type") -> DataFrame:
    """Points on land are country centroids: marked, dropped or moved to the coast.

    A point within a land polygon is 'country_centroid' (policy 'snap': moved to
    the nearest coast of that polygon and 'snapped_to_coast'); others 'precise'.
    """
    if policy not in ("mark", "drop", "snap"):
        raise ValueError(f"unknown policy {policy!r}")
    located = points(df, lat, lon)
    spots = located.where("point_lat IS NOT NULL").select("point_lat", "point_lon").distinct()
    land = materialize(land.select("poly_ord", "rings").withColumn("polygon", F.monotonically_increasing_id()), "land")
    keep = ["polygon", "poly_ord"]
    found = quadtree.hits(spots, materialize(quadtree.cells(land, keep), "leaves"), keep)
    if policy == "snap":
        found = materialize(found, "found")
        near = quadtree.nearest_coast(found.drop("poly_ord"), land, "polygon").join(land.select("polygon", "poly_ord"), "polygon")
        s = F.struct("x", "y", "d")
        hit = near.groupBy("point_lat", "point_lon").agg(F.min_by(s, F.struct("d", "poly_ord", "polygon")).alias("s"))
    else:
        hit = found.groupBy("point_lat", "point_lon").agg(F.min(F.struct(F.lit(0.0).alias("d"))).alias("s"))
    out = located.join(hit, ["point_lat", "point_lon"], "left")
    on_land = F.col("s").isNotNull()
    if policy == "drop":
        return out.where(~on_land).withColumn(column, F.lit("precise")).drop("s", "point_lat", "point_lon")
    if policy == "snap":
        out = out.withColumns({lat: F.coalesce("s.y", lat), lon: F.coalesce("s.x", lon)})
    name = "snapped_to_coast" if policy == "snap" else "country_centroid"
    return out.withColumn(column, F.when(on_land, name).otherwise("precise")).drop("s", "point_lat", "point_lon")


def basin_counts(df: DataFrame, basin: str = "ocean_basin", sort_by: str | None = "count") -> DataFrame:
    out = df.groupBy(F.col(basin).alias("basin")).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), "basin") if sort_by == "count" else out.orderBy("basin") if sort_by == "name" else out


def basin_summary(df: DataFrame, basin: str = "ocean_basin", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """All rows count; the statistics take rows with both coordinates."""
    both = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    stats = [f(F.when(both, F.col(c))).alias(f"{n}_{k}") for n, c in (("lat", lat), ("lon", lon)) for k, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    return df.groupBy(F.col(basin).alias("basin")).agg(F.count("*").alias("n_samples"), *stats)
