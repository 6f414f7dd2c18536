"""Hard negatives by a Voronoi-partitioned distributed join.

Vectors become whole numbers, floor(scale * x), so that inner products are exact. Each
row is augmented to the norm of the largest (a further component takes up what lacks),
an anchor by nought; then a larger inner product with an anchor is a smaller distance:
d(a, x)^2 = |a|^2 + R^2 - 2 a.x. A bounded number of anchors, by hash, are the pivots.
Anchors belong to the cell of their nearest pivot, which is their group; rows belong to
the cell of theirs.

1. Home round: the rows of a cell meet the anchors of the same cell, which gives every
   anchor a first lower bound of its last positive's score.
2. Bounded round: from the radius of a group (largest distance of an anchor from the
   pivot) and the largest distance that may still matter to one of its anchors, a row x goes to
   a group only if d(x, pivot) <= radius + that distance (triangle inequality). These rows
   and the first ones give the exact positives.
3. The same bound with the range that the positives' scores leave for negatives decides
   to which groups rows go for the negatives, and a local exact join takes the first ones.

Groups are dealt to blocks of anchors and rows to blocks of candidates, so a task holds at
most some ANCHOR_BLOCK anchors and CANDIDATE_BLOCK rows, whatever the cells hold; each task
gives at most ``k`` rows for each anchor or positive, which are ranked together. What the
driver sees are the pivots and four numbers of each group, of at most PIVOTS groups. In high
dimensions the bounds of unstructured vectors leave nearly all rows to all groups: then
the work is that of all anchors against all rows, in blocks, and still exact.

Defined cases: rows with a null label, id or vector, an empty one, or one with null or
non-finite components take no part, nor do rows with a component beyond 32 bits. Vectors of other lengths than
the commonest (ties: the longest) take no part either. Of rows that share an id, that
with the smallest label (after the change), then the smallest vector, counts. Ties go to the smaller id. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, release, scratch, table

SCALE = 256
#: Positives of an anchor, and negatives of each positive.
POSITIVES, NEGATIVES = 5, 5
#: A negative has at least so many hundredths of the positive's score.
PERCENT = 80
#: Groups: one for each ANCHORS_PER_PIVOT anchors, within these bounds.
FEWEST, PIVOTS, ANCHORS_PER_PIVOT = 8, 1024, 512
ANCHOR_BLOCK, CANDIDATE_BLOCK = 2048, 16_384
CHUNK = 256
ROW = "vec_id bigint, label bigint, raw binary"


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, array of whole numbers) to (vec_id, label, bytes, norm squared)."""
    for batch in batches:
        lists = batch.column(2)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4")
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        parts = [flat[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]
        norms = [float((x.astype(float) ** 2).sum()) for x in parts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in parts], pa.binary()), pa.array(norms, pa.float64())], names=["vec_id", "label", "raw", "norm2"])


def whole(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while they hold every sum, else in whole numbers."""
    largest = float(np.abs(a, dtype=float).max(initial=0)) * float(np.abs(b, dtype=float).max(initial=0)) * max(a.shape[1], 1)
    if largest < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Pivots:
    """Distances of augmented rows and anchors to the pivots (anchors, so augmented by nought)."""

    def __init__(self, raw: list[bytes], norm2: float):
        self.p, self.norm2 = whole(raw).astype(float), norm2
        self.square = (self.p * self.p).sum(1)

    def of_rows(self, raw: list[bytes]) -> np.ndarray:
        """A row's augmented square is that of the largest norm."""
        return np.sqrt(np.maximum(self.norm2 + self.square - 2 * (whole(raw).astype(float) @ self.p.T), 0))

    def of_anchors(self, raw: list[bytes]) -> np.ndarray:
        x = whole(raw).astype(float)
        return np.sqrt(np.maximum((x * x).sum(1)[:, None] + self.square - 2 * (x @ self.p.T), 0))


#: What rounding of doubles may take from a bound.
SLACK = 1e-6


def _located(pivots: Pivots, of: str):
    """Adds the nearest pivot (``cell``) and the distance (``far``) to rows whose third column is ``raw``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = getattr(pivots, of)(batch.column(2).to_pylist()) if batch.num_rows else np.zeros((0, 1))
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell], pa.float64())], names=[*batch.schema.names, "cell", "far"])

    return run


def _router(pivots: Pivots, low: np.ndarray, high: np.ndarray):
    """Adds to rows whose third column is ``raw`` the groups to which they may matter:
    those whose pivot is at ``low`` to ``high`` from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = pivots.of_rows(batch.column(2).to_pylist()) if batch.num_rows else np.zeros((0, len(low)))
            good = (d <= high) & (d >= low)
            groups = [np.flatnonzero(g).tolist() for g in good]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(groups, pa.list_(pa.int32()))], names=[*batch.schema.names, "groups"])

    return run


def _first(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Of places grouped by ``rows``, the first ``k`` of each by falling score, then id."""
    order = np.lexsort((ids, -score, rows))
    r = rows[order]
    start = np.concatenate([[True], r[1:] != r[:-1]])
    at = np.arange(len(r))
    return order[at - np.maximum.accumulate(np.where(start, at, 0)) < k] if len(r) else order


def _positives(k: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"anchor_id": pd.Series(dtype="int64"), "positive_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        if anchors.empty or rows.empty:
            return none
        out = []
        # Only rows of an anchor's label can be its positives.
        for label, some in anchors.groupby("label"):
            own = rows[rows["label"] == label]
            if own.empty:
                continue
            x, ids = whole(own["raw"].tolist()), own["vec_id"].to_numpy()
            for s in range(0, len(some), CHUNK):
                part = some.iloc[s : s + CHUNK]
                a = part["vec_id"].to_numpy()
                score = products(whole(part["raw"].tolist()), x)
                other = a[:, None] != ids[None, :]
                # At least k others reach the k-th largest score of all but one.
                nth = min(k + 1, score.shape[1])
                floor = np.partition(score, score.shape[1] - nth, axis=1)[:, score.shape[1] - nth]
                r, c = np.nonzero(other & (score >= floor[:, None]))
                best = _first(score[r, c], ids[c], r, k)
                out.append(pd.DataFrame({"anchor_id": a[r[best]], "positive_id": ids[c[best]], "score": score[r[best], c[best]]}))
        return pd.concat(out) if out else none

    return run


def _negatives(k: int, percent: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")})
        if anchors.empty or rows.empty:
            return none
        x, ids, labels = whole(rows["raw"].tolist()), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        order = np.argsort(ids, kind="stable")
        x, ids, labels = x[order], ids[order], labels[order]
        out = []
        for s in range(0, len(anchors), CHUNK):
            part = anchors.iloc[s : s + CHUNK]
            score = products(whole(part["raw"].tolist()), x)
            usable = labels[None, :] != part["label"].to_numpy()[:, None]
            for i, (a, found) in enumerate(zip(part["vec_id"], part["positives"], strict=True)):
                mine, able = score[i], usable[i]
                for one in found:
                    top = int(one["score"])
                    c = np.flatnonzero(able & (mine <= top) & (mine >= -(-percent * top // 100)))
                    if len(c) > k:
                        floor = np.partition(mine[c], len(c) - k)[len(c) - k]
                        c = c[mine[c] >= floor]
                    # Rows stand by id, so a stable order by score settles ties.
                    c = c[np.argsort(-mine[c], kind="stable")[:k]]
                    if len(c):
                        out.append((np.full(len(c), a), np.full(len(c), one["positive_id"]), ids[c], np.full(len(c), top), mine[c]))
        return pd.DataFrame(dict(zip(none.columns, map(np.concatenate, zip(*out, strict=True)), strict=True))) if out else none

    return run


def _dealt(anchors: DataFrame, routed: DataFrame, blocks: dict[int, int], rows_in: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """Anchors (``cell`` is their group) and routed rows (``group``) with the block pair (group, x, y) they meet in."""
    of = lambda m: F.element_at(F.array(*[F.lit(m.get(g, 1)) for g in range(max(m) + 1)]), F.col("group") + 1)
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    tall, wide = of(blocks), of({g: max(1, -(-n // CANDIDATE_BLOCK)) for g, n in rows_in.items()})
    have = F.col("group").isin(sorted(set(blocks) & set(rows_in)))
    left = anchors.withColumn("group", F.col("cell")).where(have).withColumn("x", place(tall)).withColumn("y", each(wide))
    right = routed.where(have).withColumn("y", place(wide)).withColumn("x", each(tall))
    return left, right


def _ranked(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def prepared(vectors: DataFrame, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, raw, norm2) of the rows that take part; written."""
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.floor(x * scale))
    d = F.col(vec_col).cast("array<double>")
    sound = (F.size(d) > 0) & ~F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) >= 2.0**31 - 1))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), F.when(sound, v).alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    packed = materialize(one.mapInArrow(_packer, f"{ROW}, norm2 double"), "vectors", "zstd")
    sizes = packed.groupBy(F.length("raw").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return packed.where(F.length("raw") == F.lit(sizes[0]["size"] if sizes else 0))


EMPTY = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT) -> DataFrame:
    """Negatives of every anchor and positive; ``rows`` as ``prepared`` gives them, ``is_anchor`` of vec_id."""
    spark = rows.sparkSession
    with scratch(spark) as keep:
        return keep(_mined(rows, is_anchor, positives, negatives, percent))


def _mined(rows: DataFrame, is_anchor: Column, positives: int, negatives: int, percent: int) -> DataFrame:
    spark = rows.sparkSession
    total, largest2, n_anchors = rows.agg(F.count("*"), F.max("norm2"), F.count_if(is_anchor)).first()
    if not n_anchors:
        return materialize(spark.createDataFrame([], EMPTY), "negatives")
    number = min(PIVOTS, max(FEWEST, -(-n_anchors // ANCHORS_PER_PIVOT)))
    chosen = rows.where(is_anchor).select("vec_id", "raw").orderBy(F.xxhash64("vec_id"), "vec_id").limit(number).collect()
    pivots = Pivots([bytes(r["raw"]) for r in chosen], largest2)
    place = f"{ROW}, norm2 double, cell int, far double"
    anchors = materialize(rows.where(is_anchor).mapInArrow(_located(pivots, "of_anchors"), place), "anchors")
    located = materialize(rows.mapInArrow(_located(pivots, "of_rows"), place).select("vec_id", "label", "raw", "cell"), "located", "zstd")
    held = {r["cell"]: r for r in anchors.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}
    blocks = {g: -(-r["n"] // ANCHOR_BLOCK) for g, r in held.items()}

    def met(routed: DataFrame, with_what: DataFrame, how, schema: str) -> DataFrame:
        """The local joins of the block pairs."""
        rows_in = {r["group"]: r["count"] for r in routed.groupBy("group").count().collect()}
        if not set(rows_in) & set(blocks):
            return spark.createDataFrame([], schema)
        left, right = _dealt(with_what, routed, blocks, rows_in)
        keys = ["group", "x", "y"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(how, schema)

    def routed_by(low: dict[int, float], high: dict[int, float], but_home: bool) -> DataFrame:
        lows, highs = (np.array([m.get(g, none) for g in range(len(chosen))]) for m, none in ((low, 0.0), (high, -1.0)))
        out = located.mapInArrow(_router(pivots, lows, highs), f"{ROW}, cell int, groups array<int>").withColumn("group", F.explode("groups"))
        return (out.where("group <> cell") if but_home else out).select("vec_id", "label", "raw", "group")

    kind = "anchor_id bigint, positive_id bigint, score bigint"
    order = [F.desc("score"), F.asc("positive_id")]
    home = located.withColumn("group", F.col("cell")).select("vec_id", "label", "raw", "group")
    some = _ranked(met(home, anchors, _positives(positives), kind), ["anchor_id"], order, positives).drop("rank")
    some = materialize(some, "home")
    bound = some.groupBy("anchor_id").agg(F.when(F.count("*") >= positives, F.min("score")).alias("least"))
    known = anchors.join(bound.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left").select("cell", "norm2", "least")
    # Without a bound an anchor may need any row: the distance of opposite vectors.
    span = F.lit(largest2) + F.col("norm2") - 2 * F.coalesce(F.col("least").cast("double"), -F.sqrt(F.col("norm2") * F.lit(largest2)))
    far = {r["cell"]: r["far"] for r in known.groupBy("cell").agg(F.max(F.sqrt(F.greatest(span, F.lit(0.0)))).alias("far")).collect()}
    high = {g: held[g]["radius"] + far[g] + SLACK * (1 + largest2**0.5) for g in held}
    away = routed_by({}, high, True)
    every = some.union(met(away, anchors, _positives(positives), kind))
    best = materialize(_ranked(every, ["anchor_id"], order, positives).drop("rank"), "positives")
    release(spark)

    listed = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"), F.min("score").alias("least"), F.max("score").alias("most"))
    asked = materialize(anchors.join(listed.withColumnRenamed("anchor_id", "vec_id"), "vec_id").where("most >= 0"), "asked")
    apart = lambda score: F.sqrt(F.greatest(F.lit(largest2) + F.col("norm2") - 2 * score, F.lit(0.0)))
    # Positives below nought have no negatives, so nought is the least score that counts.
    reached = asked.groupBy("cell").agg(F.max(apart(F.greatest(F.col("least"), F.lit(0)) * (percent / 100))).alias("far"), F.min(apart(F.col("most").cast("double"))).alias("near")).collect()
    slack = SLACK * (1 + largest2**0.5)
    high = {r["cell"]: held[r["cell"]]["radius"] + r["far"] + slack for r in reached}
    low = {r["cell"]: max(0.0, r["near"] - held[r["cell"]]["radius"] - slack) for r in reached}
    kind = "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"
    found = met(routed_by(low, high, False), asked.select("vec_id", "label", "raw", "cell", "positives"), _negatives(negatives, percent), kind)
    out = _ranked(found, ["anchor_id", "positive_id"], [F.desc("negative_score"), F.asc("negative_id")], negatives)
    return materialize(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "negatives")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    with scratch(spark) as keep:
        return keep(mine(prepared(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0))


ORACLE = f"""
WITH r AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES}),
n AS (SELECT p.a AS anchor_id, p.b AS positive_id, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND {PERCENT} * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLE_SQL = {"op13_hard_negatives": ORACLE}
