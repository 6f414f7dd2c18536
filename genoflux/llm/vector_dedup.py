"""Near duplicates among vectors by sorted projection passes.

Equal vectors of a label become one class first. In each pass the classes are ordered
by label and the concatenated bits of random projections, and every class is compared
with its next ``window`` neighbours in that order: the rows are range-partitioned and
compared inside each partition; the ends of partitions meet their neighbours in a small
second step. Pairs with a cosine of at least the limit are united across the passes to
components.

The number of passes follows from the rows of the commonest label: two vectors at the
limit share a bit with the chance s = 1 - acos(limit) / pi, so they share the t bits that
leave ``window`` rows together with s^t, and the passes are as many as leave a chance of
``miss`` for such a pair to be overlooked. Labels of at most ``window`` classes are exact.

A window bounds the partners that a pass finds, not the result: inside each component all
pairs are compared again, dealt in pairs of blocks, and the links are counted there (no
pair is put out). So a group of many near copies has all its links; what can be
lost is only a pair whose two ends no pass has joined, directly or through others. The work
inside a component is quadratic in its different vectors, which is the price of an
exact count.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows with a null label or id, link with nothing (their own component; a null id has a
null component and is not kept). Only vectors of equal length are compared. Every row is
a vector of its own, so repeated rows are copies; ids should be unique (rows that share an
id are told apart by label and vector when links are counted, and are one node of the
components). Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialize, release, scratch, table
from .jaccard_join import _grouped, blocks_of, components

COSINE, WINDOW, BITS = 0.98, 64, 128
#: The chance that a pair at the limit is overlooked by all passes.
MISS = 0.002
#: Rows of a range partition, of a step inside it, and of a block of a component.
PARTITION_ROWS, STEP, BLOCK = 20_000, 512, 2048
#: Parts to which the rows of a class are dealt when they look up its result.
SALTS = 64


def passes_for(rows: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes for a label of ``rows`` different vectors."""
    if rows <= window:
        return 1
    together = (1 - math.acos(cosine) / math.pi) ** math.log2(rows / window)
    return max(1, math.ceil(math.log(miss) / math.log1p(-together))) if together < 1 else 1


def projections(dim: int, number: int, bits: int = BITS) -> np.ndarray:
    """The random directions of one pass."""
    return np.random.default_rng([20_11, number, dim]).standard_normal((dim, bits))


def unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Packed vectors of one length, scaled to length one in double precision."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _packer(kind: str):
    """The last column, arrays of numbers, becomes their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            flat, at = lists.flatten().to_numpy(zero_copy_only=False).astype(kind), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            raw = [flat[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw, pa.binary())], names=[*batch.schema.names[:-1], "raw"])

    return run


def _signer(kind: str, number: int):
    """Adds ``sig`` to rows whose last column is ``raw``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            raw = batch.column(batch.num_columns - 1).to_pylist()
            sig: list[bytes] = [b""] * len(raw)
            sizes = np.array([len(r) for r in raw])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = unit([raw[i] for i in at], kind)
                if size not in held:
                    held[size] = projections(x.shape[1], number)
                bits = np.packbits(x @ held[size] > 0, axis=1)
                for i, b in zip(at, bits, strict=True):
                    sig[i] = b.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sig, pa.binary())], names=[*batch.schema.names, "sig"])

    return run


def stars(x: np.ndarray, near: np.ndarray, ids: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): each row of a linked group with the group's first row. ``near`` tells which rows may meet."""
    linked = (x @ x.T >= cosine) & near
    if not linked.any():
        return ids[:0], ids[:0]
    linked |= linked.T
    label = np.arange(len(ids))
    np.fill_diagonal(linked, True)
    while True:
        least = np.where(linked, label[None, :], len(ids)).min(1)
        if (least == label).all():
            break
        label = least
    far = np.flatnonzero(label != np.arange(len(ids)))
    return ids[far], ids[label[far]]


EDGE = "a bigint, b bigint, part int, side int, seg string, raw binary"


def _windows(kind: str, cosine: float, window: int):
    """Sorted rows (seg, sig, cid, raw) of one partition in; found links out, and the
    first and last ``window`` rows (with ``part`` and ``side``), which meet other partitions."""
    names = [x.split()[0] for x in EDGE.split(", ")]
    none = lambda n, t: pa.nulls(n, t)

    def links(seg: np.ndarray, ids: np.ndarray, raw: list[bytes]) -> pa.RecordBatch | None:
        a, b = [], []
        code = np.concatenate([[0], np.cumsum(seg[1:] != seg[:-1])])
        for s in np.unique(code):
            at = np.flatnonzero(code == s)
            if len(at) > 1:
                place = np.arange(len(at))
                gap = place[:, None] - place[None, :]
                x, y = stars(unit([raw[i] for i in at], kind), (gap > 0) & (gap <= window), ids[at], cosine)
                a.append(x)
                b.append(y)
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), none(n, pa.int32()), none(n, pa.int32()), none(n, pa.string()), none(n, pa.binary())], names=names) if n else None

    def ends(rows: tuple, part: int, side: int) -> pa.RecordBatch:
        seg, ids, raw = rows
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.arange(n), pa.int64()), pa.array(np.full(n, part + side - 1), pa.int32()), pa.array(np.full(n, side), pa.int32()), pa.array(seg, pa.string()), pa.array(raw, pa.binary())],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), (np.zeros(0, object), np.zeros(0, np.int64), [])
        head = None
        for batch in batches:
            seg, ids, raw = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(), batch.column(3).to_pylist()
            for s in range(0, len(ids), STEP):
                rows = np.concatenate([held[0], seg[s : s + STEP]]), np.concatenate([held[1], ids[s : s + STEP]]), held[2] + raw[s : s + STEP]
                found = links(*rows)
                if found:
                    yield found
                if head is None or len(head[1]) < window:
                    head = tuple(r[:window] for r in rows)
                held = tuple(r[-window:] for r in rows)
        if head is not None:
            # The group of side 0 is the end of the partition before.
            yield ends(head, part, 0)
            yield ends(held, part, 1)

    return run


def _joined_ends(kind: str, cosine: float, window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # The last rows of a partition (side 1) stand before the first of the next (side 0).
        pdf = pdf.sort_values(["side", "b"], ascending=[False, True])
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, rows in pdf.groupby("seg", sort=False):
            side, place = rows["side"].to_numpy(), np.arange(len(rows))
            gap = place[:, None] - place[None, :]
            near = (gap > 0) & (gap <= window) & (side[:, None] != side[None, :])
            if near.any():
                x, y = stars(unit(rows["raw"].tolist(), kind), near, rows["a"].to_numpy(), cosine)
                a.append(x)
                b.append(y)
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return run


def one_pass(classes: DataFrame, kind: str, number: int, partitions: int, cosine: float = COSINE, window: int = WINDOW) -> DataFrame:
    """(a, b): links between neighbours in the order of one pass, as stars; written."""
    rows = classes.select("seg", "cid", "raw")
    signed = rows.mapInArrow(_signer(kind, number), "seg string, cid bigint, raw binary, sig binary").select("seg", "sig", "cid", "raw")
    placed = signed.repartitionByRange(partitions, "seg", "sig", "cid").sortWithinPartitions("seg", "sig", "cid")
    found = materialize(placed.mapInArrow(_windows(kind, cosine, window), EDGE), "windows", "zstd")
    ends = found.where("part IS NOT NULL").groupBy("part").applyInPandas(_joined_ends(kind, cosine, window), "a bigint, b bigint")
    out = materialize(found.where("part IS NULL").select("a", "b").union(ends), "links")
    discard(found)
    return out


def _count(kind: str, cosine: float):
    """Sorted rows (root, p, q, side, k1, k2, n, seg, raw) in; (k1, k2, links) out, one row for each pair of blocks."""
    names = ["root", "p", "q", "side", "k1", "k2", "n", "seg", "raw"]

    def flush(held: dict[str, np.ndarray], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(held["n"]), np.int64)
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            seg, same = held["seg"][s:e], held["p"][s] == held["q"][s]
            for kept in np.unique(seg):
                at = s + np.flatnonzero(seg == kept)
                side = held["side"][at]
                left, right = (at, at) if same else (at[side == 0], at[side == 1])
                if not len(left) or not len(right):
                    continue
                y, weight = unit(held["raw"][right].tolist(), kind), held["n"][right]
                for i in range(0, len(left), STEP):
                    rows = left[i : i + STEP]
                    linked = unit(held["raw"][rows].tolist(), kind) @ y.T >= cosine
                    if same:
                        linked[np.arange(len(rows)), i + np.arange(len(rows))] = False
                    total[rows] += linked @ weight
                    if not same:
                        total[right] += linked.T @ held["n"][rows]
        good = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held["k1"][good], pa.int64()), pa.array(held["k2"][good], pa.int64()), pa.array(total[good], pa.int64())], names=["k1", "k2", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _grouped(batches, names, 3, flush)

    return run


def _found(keyed: DataFrame, kind: str, cosine: float, window: int, miss: float) -> DataFrame:
    """(k1, k2, root, links) of the classes with more than one row or with links; written."""
    spark = keyed.sparkSession
    merged = keyed.where("sound").groupBy("k1", "k2", "seg").agg(F.min("vec_id").alias("cid"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = materialize(merged.mapInArrow(_packer(kind), "k1 bigint, k2 bigint, seg string, cid bigint, n bigint, raw binary"), "classes", "zstd")
    most, count = classes.groupBy("seg").count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    # Enough partitions for the session's tasks, none much smaller than a few windows.
    partitions = max(-(-count // PARTITION_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // (8 * window))), 1)
    edges = one_pass(classes, kind, 0, partitions, cosine, window)
    for i in range(1, passes_for(most, cosine, window, miss)):
        edges = edges.union(one_pass(classes, kind, i, partitions, cosine, window))
    roots = components(edges)
    release(spark)
    nodes = roots.union(roots.select(F.col("root").alias("id"), "root").distinct())
    # Components of several blocks are few; each is known in all parts, to which their rows are dealt.
    large = roots.groupBy("root").agg((F.count("*") + 1).alias("size")).where(F.col("size") > BLOCK)
    large = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sized = nodes.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(large, ["root", "salt"], "left").select("id", "root", F.coalesce("size", F.lit(1)).alias("size"))
    held = blocks_of(sized.join(classes.withColumnRenamed("cid", "id"), "id"), "size", BLOCK).select("root", "p", "q", "side", "k1", "k2", "n", "seg", "raw")
    counted = held.repartition("root", "p", "q").sortWithinPartitions("root", "p", "q").mapInArrow(_count(kind, cosine), "k1 bigint, k2 bigint, links bigint")
    links = counted.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    found = classes.select("k1", "k2", "cid", "n").join(links, ["k1", "k2"], "left").join(roots.withColumnRenamed("id", "cid"), "cid", "left")
    return materialize(found.where("n > 1 OR links IS NOT NULL").select("k1", "k2", F.coalesce("root", "cid").alias("root"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "found")


def find(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    kind, number = ("<f4", "float") if single else ("<f8", "double")
    v = F.col(vec_col).cast(f"array<{number}>")
    sound = F.size(v) > 0
    sound &= ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.concat_ws("|", F.size(v).cast("string"), F.col(label_col).cast("string")).alias("seg"), v.alias("v"),
        F.coalesce(v.isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & sound, F.lit(False)).alias("sound"),
    )
    keyed = rows.withColumns({"k1": F.xxhash64("seg", "v"), "k2": F.xxhash64("v", "seg")})
    with scratch(spark) as keep:
        found = keep(_found(keyed, kind, cosine, window, miss))
    # Rows of one class are dealt to parts before they look up its result.
    ours = keyed.select("vec_id", "sound", "k1", "k2", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("salt"))
    parts = ours.where("sound").select("k1", "k2", "salt").distinct().join(found, ["k1", "k2"])
    out = ours.join(parts.withColumn("sound", F.lit(True)), ["k1", "k2", "salt", "sound"], "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "embeddings"))


#: All pairs of a label: the query may only lack pairs that every pass overlooks.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
n AS (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b USING (label) WHERE a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {COSINE}),
r(id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT id, min(other) AS component_id FROM r GROUP BY id), k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(k.n, 0)::BIGINT AS n_links, component_id::BIGINT AS component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN k ON k.a = vec_id
"""

QUERIES = {"op11_vector_dedup": op11_vector_dedup}
ORACLE_SQL = {"op11_vector_dedup": ORACLE}
