"""Quality classifier: Bradley-Terry ranking from preference pairs.

Each document gets a fixed list of features of its whole text. Among labelled
training rows every rejected document is paired with accepted ones; the strength
``w . x`` is fitted by logistic loss on the feature differences of the pairs
(the accepted one should win). The decision cut is a quantile of the training
scores, and the reported score is a logistic curve through that cut, so that
``score >= 0.3`` means "at or above the quantile".

Features are computed once for every document and written. The labelled rows to learn
from, at most ``max_labelled`` of them (taken by hash of the id, so alike at every
size), are chosen first and broadcast to that narrow table, so its rows move nowhere;
only theirs reach the driver, where the pairs are summed a chunk at a time.

Labels, language, source and id are no inputs of a score. Defined cases: a null
text is scored as the empty text; a null id counts as training side by the
checksum of the empty text; repeated document rows are scored each for itself;
conflicting or null labels of an id are left out of training; without both
classes in training every score is 0.5; an empty table gives an empty result; ids are
cast to long; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, materialize, small_batches, table

#: Labelled rows used for fitting at most.
MAX_LABELLED = 50_000
#: Accepted partners of each rejected document (and the other way round).
PARTNERS = 24
FOLDS, HELD_OUT, CUT_AT = 5, 0, 0.3

_CLASS = np.zeros(256, dtype=np.int64)  # class of each byte
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[list(b" \t\r\x0b\x0c")] = 4
_CLASS[ord("\n")] = 5
_CLASS[list(b".,;:'\"-()?")] = 6
_CLASS[list(b"#*$%&")] = 7
_CLASS[list(b"|<>")] = 8
_CLASS[ord("!")] = 9
_CLASS[128:] = 10
FEATURES = 24


def features_of(text: str | None) -> np.ndarray:
    """The whole text's features; all finite, zeros for an empty text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    x = np.zeros(FEATURES)
    words = raw.split()
    if not words:
        return x
    shares = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=11) / len(raw)
    x[:11] = np.sqrt(shares)
    n = len(words)
    kinds = set(words)
    lines = [y for y in raw.split(b"\n") if y.strip()]
    pairs = set(zip(words, words[1:]))
    triples = set(zip(words, words[1:], words[2:]))
    capital = shares[2] / max(shares[1] + shares[2], 1e-9)
    repeated = 1 - len(triples) / (n - 2) if n > 2 else 0.0
    x[11:] = (
        np.log1p(n),
        np.log(len(raw) / n),
        len(kinds) / n,
        1 - len(pairs) / (n - 1) if n > 1 else 0.0,
        repeated,
        1 - len(set(lines)) / len(lines),
        np.log1p(len(raw) / len(lines)),
        capital,
        1.0 if capital > 0.5 else 0.0,
        1.0 if repeated > 0.3 else 0.0,
        1.0 if shares[7] + shares[8] > 0.05 else 0.0,
        1.0 if n < 20 else 0.0,
        min(n, 60) / 60,
    )
    return x


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features_of(t.as_py()).tolist() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "features"])


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    small_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(_featured, "doc_id bigint, features array<double>")


def fit(x: np.ndarray, y: np.ndarray, partners: int = PARTNERS, ridge: float = 1e-3) -> dict:
    """Weights, centre and cut. Pairs: each row of the rarer class meets
    ``partners`` of the other in turn, so all rows of both are used alike."""
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return {"w": np.zeros(x.shape[1]), "cut": 0.0, "slope": 0.0}
    scale = x.std(axis=0) + 1e-9
    pairs = max(len(good), len(bad)) * max(1, min(partners, len(good), len(bad)))
    i, k = np.arange(pairs) % len(good), np.arange(pairs)
    j = (k + k // np.lcm(len(good), len(bad))) % len(bad)
    good, bad = good / scale, bad / scale
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps on the pairwise logistic loss
        gradient, hessian = ridge * w, ridge * np.eye(len(w))
        for at in range(0, pairs, 50_000):
            d = good[i[at : at + 50_000]] - bad[j[at : at + 50_000]]
            lose = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            gradient = gradient - lose @ d / pairs
            hessian = hessian + (d * (lose * (1 - lose))[:, None]).T @ d / pairs
        move = np.linalg.solve(hessian, gradient)
        w = w - move
        if np.abs(move).max() < 1e-6:
            break
    w = w / scale
    s = x @ w
    # The quantile of training scores at which both classes together are judged best.
    cuts = np.quantile(s, np.linspace(0.005, 0.995, 199))
    balanced = [((s[y == 1] >= c).mean() + (s[y == 0] < c).mean()) for c in cuts]
    return {"w": w, "cut": float(cuts[int(np.argmax(balanced))]), "slope": 1.0}


def scored(feats: DataFrame, model: dict, at: float = CUT_AT) -> DataFrame:
    """Adds score and predicted, in built-in functions."""
    w = F.array(*[F.lit(float(v)) for v in model["w"]])
    strength = F.aggregate(F.zip_with("features", w, lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    shift = float(np.log(at / (1 - at))) if model["slope"] else 0.0
    raw = (strength - F.lit(model["cut"])) * F.lit(model["slope"]) + F.lit(shift)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(raw, F.lit(30.0)), F.lit(-30.0))))
    return feats.withColumn("score", score).withColumn("predicted", (F.col("score") >= F.lit(at)).cast("int"))


def training_rows(feats: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """Features and label of the training side; conflicts left out."""
    given = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_of_id() % folds != held_out))
        .groupBy("doc_id")
        .agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
        .where("lo = hi")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lo").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # At most ``most`` pairs of numbers are broadcast.
    return feats.join(F.broadcast(given), "doc_id")


def train(feats: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT, most: int = MAX_LABELLED) -> dict:
    rows = training_rows(feats, labels, label, folds, held_out, most).orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(most).select("features", "y").toPandas()
    x = np.array(rows["features"].tolist(), dtype=float).reshape(len(rows), -1) if len(rows) else np.zeros((0, FEATURES))
    return fit(x, rows["y"].to_numpy())


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = materialize(features(table(spark, sf_dir, "documents")), "features")
    model = train(feats, table(spark, sf_dir, "labels"))
    return scored(feats, model).select("doc_id", (crc_of_id() % FOLDS == HELD_OUT).alias("held_out"), "score", "predicted")


QUERIES = {"op4_quality": op4_quality}
ORACLE_SQL: dict[str, str] = {}
