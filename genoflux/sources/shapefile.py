"""Shapefiles of polygons as a Spark data source, read in ranges of their index, and written.

A file is three: shapes (.shp), the index of their places (.shx), attributes (.dbf). A task reads
a range of the index and so finds its records of both others without reading what lies before. The parts of a
record are rings: clockwise ones are outer, the others holes, each of the smallest outer ring
around it; every outer ring with its holes is a row. Records without a shape give no row.

Writing puts one file for each task into a folder under names that start with a dot; when all
tasks have ended they get their names, and a failed job removes them.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..functions import projection
from .fasta import _store
from .tables import NAME_COLUMNS, with_bounds

RING = "array<struct<x double, y double>>"
SCHEMA = f"ord bigint, part int, rings array<{RING}>, attributes map<string,string>"
#: Fixed values of the format: polygons plain, with heights, with measures.
POLYGONS, FILE_CODE, VERSION = (5, 15, 25), 9994, 1000
#: Vertices of a hole times those of a ring that are compared with each other.
PLAIN = 1 << 20
#: Vertices of the rows that a task hands to Spark at once.
BATCH = 1 << 16


def area(ring: np.ndarray) -> float:
    """Signed area, positive if counter-clockwise."""
    x, y = ring[:, 0], ring[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def _around(ring: np.ndarray, hole: np.ndarray) -> bool:
    """Whether a hole's vertices lie in a ring, by those that are on neither edge."""
    from ..operators import geo, quadtree

    low, high = ring.min(axis=0), ring.max(axis=0)
    x, y = hole[((hole > low) & (hole < high)).all(axis=1)].T
    if len(x) * len(ring) <= PLAIN:
        return bool(geo.rings_contain(x, y, [ring]).any())
    # Most holes show by their first vertices; for the others each vertex meets a leaf's edges only.
    return bool(geo.rings_contain(x[:4], y[:4], [ring]).any()) or bool(quadtree.inside(quadtree.edges_of([len(ring)], *ring.T), x, y).any())


def polygons_of(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Outer rings with their holes. A hole without a ring around it, as in files that turn rings the other way, stands for itself."""
    rings = [r[:-1] if len(r) > 1 and (r[0] == r[-1]).all() else r for r in rings]
    rings = [r for r in rings if len(r) > 2]
    areas = [area(r) for r in rings]
    outer = [[r] for r, a in zip(rings, areas, strict=True) if a <= 0]
    sizes = [-a for a in areas if a <= 0]
    boxes = np.array([(*r[0].min(axis=0), *r[0].max(axis=0)) for r in outer]).reshape(-1, 4)
    for hole, a in zip(rings, areas, strict=True):
        if a > 0:
            low, high = hole.min(axis=0), hole.max(axis=0)
            near = np.flatnonzero((boxes[:, :2] < high).all(axis=1) & (boxes[:, 2:] > low).all(axis=1))
            home = [k for k in near.tolist() if sizes[k] >= a and _around(outer[k][0], hole)]
            if home:
                outer[min(home, key=lambda k: sizes[k])].append(hole)
            else:
                outer.append([hole])
                sizes.append(0.0)
                boxes = np.vstack([boxes, [(*low, *high)]])
    return outer


def _shape(content: bytes) -> list[np.ndarray]:
    kind = struct.unpack("<i", content[:4])[0]
    if kind == 0:
        return []
    if kind not in POLYGONS:
        raise ValueError(f"shape type {kind} is no polygon")
    n_parts, n_points = struct.unpack("<2i", content[36:44])
    starts = [*struct.unpack(f"<{n_parts}i", content[44 : 44 + 4 * n_parts]), n_points]
    at = 44 + 4 * n_parts
    points = np.frombuffer(content, "<f8", 2 * n_points, at).reshape(-1, 2)
    return [points[s:e] for s, e in zip(starts[:-1], starts[1:], strict=True)]


@dataclass
class _Range(InputPartition):
    path: str
    file: int
    first: int
    count: int

    def __post_init__(self):
        super().__init__(None)


def _sidecar(path: str, kind: str) -> str:
    return path[:-4] + kind


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of SCHEMA; vertices go to Arrow as they are, not as objects."""
    every = [r for row in rows for r in row[2]]
    points = np.concatenate(every) if every else np.zeros((0, 2))
    ends = lambda sizes: pa.array(np.cumsum([0, *sizes]), pa.int32())
    ring = pa.ListArray.from_arrays(ends(map(len, every)), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(points[:, k]), pa.float64()) for k in (0, 1)], ["x", "y"]))
    rings = pa.ListArray.from_arrays(ends(len(row[2]) for row in rows), ring)
    texts = pa.array([list(row[3].items()) for row in rows], pa.map_(pa.string(), pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([row[0] for row in rows], pa.int64()), pa.array([row[1] for row in rows], pa.int32()), rings, texts], names=["ord", "part", "rings", "attributes"])


class _Reader(DataSourceReader):
    def __init__(self, path: str, records: int):
        self.path, self.records = path, records

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = _store(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        base = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        files = [self.path]
        if info.type == fs.FileType.Directory:
            files = sorted(base + f.path for f in store.get_file_info(fs.FileSelector(path)) if f.base_name.endswith(".shp") and f.base_name[:1] not in "._")
        out: list[InputPartition] = []
        for k, file in enumerate(files):
            store, index = _store(_sidecar(file, ".shx"))
            n = (store.get_file_info(index).size - 100) // 8
            out += [_Range(file, k, a, min(self.records, n - a)) for a in range(0, n, self.records)]
        return out or [_Range("", 0, 0, 0)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        rows, vertices = [], 0
        for row in self._records(part):
            rows.append(row)
            vertices += sum(map(len, row[2]))
            if vertices > BATCH:
                yield _batch(rows)
                rows, vertices = [], 0
        if rows:
            yield _batch(rows)

    def _records(self, part: _Range) -> Iterator[tuple]:
        """ord, part, rings as arrays, attributes."""
        if not part.count:
            return
        store, path = _store(part.path)
        with store.open_input_file(_sidecar(path, ".shx")) as f:
            f.seek(100 + 8 * part.first)
            index = struct.unpack(f">{2 * part.count}i", f.read(8 * part.count))
        try:
            with store.open_input_file(_sidecar(path, ".cpg")) as f:
                encoding = f.read().decode().strip() or "utf-8"
        except FileNotFoundError:
            encoding = "utf-8"
        with store.open_input_file(path) as shapes, store.open_input_file(_sidecar(path, ".dbf")) as table:
            head, width = struct.unpack("<2H", table.read(12)[8:12])
            table.seek(32)
            fields = [(d[:11].split(b"\0")[0].decode(), d[16]) for d in (table.read(32) for _ in range((head - 33) // 32))]
            table.seek(head + width * part.first)
            rows = table.read(width * part.count)
            for k in range(part.count):
                shapes.seek(2 * index[2 * k] + 8)
                found = polygons_of(_shape(shapes.read(2 * index[2 * k + 1])))
                at, values = k * width + 1, {}
                for name, size in fields:
                    text = rows[at : at + size].decode(encoding, "replace").strip(" \0")
                    values[name] = text or None
                    at += size
                for number, rings in enumerate(found):
                    yield (part.file << 40) + part.first + k, number, rings, values


@dataclass
class _Written(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


def _record(rings: list[np.ndarray]) -> bytes:
    closed = [np.vstack([r, r[:1]]) for r in rings]
    points = np.concatenate(closed)
    starts = np.cumsum([0, *(len(r) for r in closed[:-1])])
    box = (*points.min(0), *points.max(0))
    return struct.pack("<i4d2i", 5, *box, len(closed), len(points)) + struct.pack(f"<{len(closed)}i", *starts) + points.astype("<f8").tobytes()


def _header(words: int, box: tuple) -> bytes:
    return struct.pack(">7i", FILE_CODE, 0, 0, 0, 0, 0, words) + struct.pack("<2i4d4d", VERSION, 5, *box, 0.0, 0.0, 0.0, 0.0)


class _Writer(DataSourceArrowWriter):
    """Rows (rings and further columns, which become text attributes)."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def _given(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], list]]:
        """Rings as arrays and the other columns of each row."""
        for batch in batches:
            others = [batch.column(c).to_pylist() for c in self.columns]
            for k, shape in enumerate(batch.column("rings")):
                rings = [ring.values for ring in shape.values or () if ring.values is not None] if shape.is_valid else []
                yield [np.column_stack([r.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y")]).astype(float) for r in rings], [o[k] for o in others]

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        places, shapes, values = [], [], []
        box = [np.inf, np.inf, -np.inf, -np.inf]
        for rings, others in self._given(batches):
            rings = [r for r in rings if len(r) > 2]
            # The first ring is the outer one, clockwise; the others are its holes.
            rings = [r if (area(r) <= 0) == (k == 0) else r[::-1] for k, r in enumerate(rings)]
            shapes.append(_record(rings) if rings else struct.pack("<i", 0))
            if rings:
                every = np.concatenate(rings)
                box = [*np.minimum(box[:2], every.min(0)), *np.maximum(box[2:], every.max(0))]
            values.append(["" if v is None else str(v) for v in others])
        if not shapes:
            return _Written()
        box = tuple(map(float, box)) if np.isfinite(box).all() else (0.0,) * 4
        at = 50
        for s in shapes:
            places.append((at, len(s) // 2))
            at += 4 + len(s) // 2
        index = _header(50 + 4 * len(shapes), box) + b"".join(struct.pack(">2i", *p) for p in places)
        body = _header(at, box) + b"".join(struct.pack(">2i", k + 1, len(s) // 2) + s for k, s in enumerate(shapes))
        coded = [[v.encode()[:254] for v in row] for row in values]
        widths = [max([1, *(len(row[k]) for row in coded)]) for k in range(len(self.columns))]
        head = struct.pack("<4BI2H20x", 3, 100, 1, 1, len(shapes), 33 + 32 * len(widths), 1 + sum(widths))
        head += b"".join(struct.pack("<11sc4x2B14x", c.encode()[:10], b"C", w, 0) for c, w in zip(self.columns, widths, strict=True)) + b"\r"
        table = head + b"".join(b" " + b"".join(v.ljust(w) for v, w in zip(row, widths, strict=True)) for row in coded) + b"\x1a"
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
        for kind, content in ((".shp", body), (".shx", index), (".dbf", table), (".cpg", b"UTF-8")):
            with store.open_output_stream(f"{folder}/.{name}{kind}") as f:
                f.write(content)
        return _Written([name + kind for kind in (".dbf", ".shx", ".cpg", ".shp")])

    def commit(self, messages: list) -> None:
        store, folder = _store(self.path)
        for m in messages:
            for name in m.names if m else ():
                store.move(f"{folder}/.{name}", f"{folder}/{name}")

    def abort(self, messages: list) -> None:
        store, folder = _store(self.path)
        for m in messages:
            for name in m.names if m else ():
                store.delete_file(f"{folder}/.{name}")


class ShapefileSource(DataSource):
    """``spark.read.format("shapefile")``: ord (file and record), part, rings, attributes."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("rangeRecords", 1000)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], [f.name for f in schema.fields if f.name != "rings"])


def write_shapefile(df: DataFrame, path: str) -> None:
    """Polygons with ``rings`` (the outer one first) to a folder, a file for each partition, in its order."""
    df.sparkSession.dataSource.register(ShapefileSource)
    df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) if kind == "timestamp" else F.col(f"`{c}`") for c, kind in df.dtypes])
    df.write.format("shapefile").mode("append").save(path)


def read_shapefile(spark: SparkSession, path: str, projected: projection.Projection | None = None) -> DataFrame:
    """basin_name, poly_ord, rings in degrees and their bounds, attributes.

    The name is the first known attribute that the file has, else its first. A projection text beside the
    file (.prj) or ``projected`` tells how coordinates become degrees.
    """
    spark.dataSource.register(ShapefileSource)
    raw = spark.read.format("shapefile").load(path)
    if projected is None and path.endswith(".shp"):
        try:
            text = spark.read.text(_sidecar(path, ".prj"), wholetext=True).first()
            projected = projection.parse(text["value"]) if text else None
        except Exception as error:  # a file without a projection text is in degrees
            if "PATH_NOT_FOUND" not in str(error):
                raise
    named = F.get(F.map_values("attributes"), 0)
    for n in reversed(NAME_COLUMNS):
        named = F.when(F.map_contains_key("attributes", n), F.col("attributes")[n]).otherwise(named)
    rings = F.col("rings")
    if projected is not None and projected.kind != "degrees":

        def degrees(v):
            lon, lat = projection.to_degrees(v["x"], v["y"], projected)
            return F.struct(lon.alias("x"), lat.alias("y"))

        rings = F.transform("rings", lambda r: F.transform(r, degrees))
    return with_bounds(raw.select(named.alias("basin_name"), F.col("ord").alias("poly_ord"), "part", rings.alias("rings"), "attributes"))
