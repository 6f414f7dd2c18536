"""K2: clusters at a distance cut.

For average, complete and weighted linkage every cluster at cut t lies within a
connected component of the graph of pairs at distance <= t. So: close pairs,
components by alternating star contraction, then the linkage inside each
component. Single linkage is the component itself. Ward has no such guarantee on
distances that are not Euclidean and takes all sequences as one group.
``cluster_alignment`` keeps only close pairs and computes the distances inside a
component from its sequences; ``clusters`` takes a table of all pairs. A component of
more than GROUP_ROWS rows is dealt over many tasks (``agglomerate``), with the same result.
Labels are numbered by the smallest ``ord`` of a cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import discard, materialize, numbered
from . import distance
from .agglomerate import UNIT, agglomerate, units

#: Components of up to so many rows are linked in one task; larger ones by rounds.
GROUP_ROWS = 2_000
METHODS = ("single", "complete", "average", "weighted", "ward")


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(ord, root): nodes is one column ``ord``; edges (i, j). Minima are combined
    before every shuffle, and each round is written, so lineage stays short."""
    e = materialize(edges.select(F.greatest("i", "j").alias("i"), F.least("i", "j").alias("j")).where("i <> j").distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("j").alias("i"), F.col("i").alias("j")))
        least = both.groupBy("i").agg(F.min("j").alias("m")).select("i", F.least("i", "m").alias("m"))
        large = both.join(least, "i").where("j > i").select(F.col("j").alias("i"), F.col("m").alias("j")).distinct()
        root = large.groupBy("i").agg(F.min("j").alias("m"))
        small = large.join(root, "i").select(F.col("j").alias("i"), F.col("m").alias("j")).union(root.select("i", F.col("m").alias("j")))
        last, e = e, materialize(small.where("i <> j").distinct(), "edges")
        discard(last)
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("i", "j").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            return nodes.join(e.select(F.col("i").alias("ord"), F.col("j").alias("root")), "ord", "left").select("ord", F.coalesce("root", "ord").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def linkage(d: np.ndarray, method: str) -> list[tuple[int, int, float, int]]:
    """Merges (a, b, height, size) in SciPy's numbering, by a chain of nearest neighbours.

    All the methods are reducible, so merging any two that are each other's nearest
    gives the same tree as merging the nearest of all; that takes quadratic time. The
    merges are then sorted by height and numbered. Distances are whole multiples of
    2^-30 (but for Ward), a cluster is known by its first member, and of equally
    near pairs the one with the smaller first member is the nearer, then the one with the
    smaller second: so the merges are those of ``agglomerate``.
    """
    n = len(d)
    # Of average linkage the sums of distances are kept, which are exact.
    d = d.astype(float).copy() if method == "ward" else np.round(d.astype(float) * UNIT)
    np.fill_diagonal(d, np.inf)
    size, alive, chain = np.ones(n), np.ones(n, bool), []
    merges: list[tuple[int, int, float]] = []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.argmax(alive)))
        while True:
            x = chain[-1]
            row = d[x] / (size[x] * size) if method == "average" else d[x]
            y = int(np.argmin(row))
            # The first of equally near ones; rounding of Ward's heights may ask for the one it came from.
            if method == "ward" and len(chain) > 1 and row[chain[-2]] <= row[y]:
                y = chain[-2]
            if len(chain) > 1 and y == chain[-2]:
                break
            chain.append(y)
        del chain[-2:]
        i, j = sorted((x, y))
        h, a, b = float(row[y]), d[i], d[j]
        if method == "single":
            new = np.minimum(a, b)
        elif method == "complete":
            new = np.maximum(a, b)
        elif method == "weighted":
            new = (a + b) / 2
        elif method == "ward":
            with np.errstate(invalid="ignore"):
                new = np.sqrt(((size[i] + size) * a**2 + (size[j] + size) * b**2 - size * h**2) / (size[i] + size[j] + size))
        else:
            new = a + b
        alive[j] = False
        new[~alive] = np.inf
        new[i] = np.inf
        d[i], d[:, i] = new, new
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        merges.append((i, j, h if method == "ward" else h / UNIT))
    merges.sort(key=lambda m: m[2])
    number, held, out = list(range(n)), [1] * n, []
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for step, (i, j, h) in enumerate(merges):
        i, j = root(i), root(j)
        held[i] += held[j]
        out.append((*sorted((number[i], number[j])), h, held[i]))
        parent[j], number[i] = i, n + step
    return out


def masked_distances(alns: list[str]) -> np.ndarray:
    """The distances of ``distance.pairwise`` between the sequences of one group."""
    letters = np.array([np.frombuffer(a.upper().encode("ascii", "replace"), dtype=np.uint8) for a in alns])
    planes = [(letters == ord(b)).astype(np.float32) for b in "ACGT"]
    both = sum(planes) @ sum(planes).T
    same = sum(x @ x.T for x in planes)
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(both > 0, 1.0 - same.astype(float) / both.astype(float), 1.0)
    np.fill_diagonal(d, 0.0)
    return d


def cut_labels(d: np.ndarray, threshold: float, method: str = "average") -> np.ndarray:
    """0-based labels by first member; clusters whose merges are at heights <= threshold."""
    n = len(d)
    parent = list(range(2 * n - 1))
    limit = threshold if method == "ward" else round(threshold * UNIT) / UNIT
    for step, (a, b, h, _) in enumerate(linkage(d, method)):
        if h <= limit:
            parent[a] = parent[b] = n + step
    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x
    seen: dict[int, int] = {}
    return np.array([seen.setdefault(root(i), len(seen)) for i in range(n)], dtype=np.int64)


def _checked(threshold: float, method: str) -> None:
    if not 0 <= threshold <= 1:
        raise ValueError(f"threshold must be in [0, 1], got {threshold}")
    if method not in METHODS:
        raise ValueError(f"unknown linkage method {method!r}")


def _labelled(nodes: DataFrame, cutted: DataFrame) -> DataFrame:
    found = nodes.join(cutted, "ord", "left").select("ord", F.coalesce("head", "ord").alias("head"))
    # One row per cluster is numbered; the members only look it up.
    heads = numbered(found.select("head").distinct(), ["head"], "cluster_id")
    return found.join(heads, "head").select("ord", "cluster_id")


def _inside(roots: DataFrame, inside_small, small_rows: DataFrame, close: DataFrame, between, threshold: float, method: str, most: int) -> DataFrame:
    """(ord, head) of the members of components of several rows: one task for each of up to
    ``most`` rows, rounds over the table of neighbours for the larger ones."""
    sizes = roots.groupBy("root").count().where("count > 1")
    local = small_rows.join(roots.join(sizes.where(F.col("count") <= most).select("root"), "root"), "ord")
    out = local.groupBy("root").applyInPandas(inside_small, "ord bigint, head bigint")
    large = materialize(roots.join(F.broadcast(sizes.where(F.col("count") > most).select("root")), "root").select("ord"), "large")
    if large.isEmpty():
        return out
    near = close.join(large.withColumnRenamed("ord", "i"), "i", "left_semi").select("i", "j", "dist")
    return out.union(agglomerate(large, near, between, threshold, method))


def clusters(nodes: DataFrame, pairs: DataFrame, threshold: float = 0.01, method: str = "average", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(ord, cluster_id): nodes has ``ord``; pairs (i, j, dist) holds all pairs."""
    _checked(threshold, method)
    nodes = nodes.select("ord")
    pairs = pairs.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "dist")

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.unique(np.concatenate([pdf["i"], pdf["j"]]))
        d = np.zeros((len(ids), len(ids)))
        a, b = np.searchsorted(ids, pdf["i"]), np.searchsorted(ids, pdf["j"])
        d[a, b] = d[b, a] = pdf["dist"]
        return pd.DataFrame({"ord": ids, "head": pd.Series(ids).groupby(cut_labels(d, threshold, method)).transform("min")})

    if method == "ward":
        return _labelled(nodes, pairs.withColumn("root", F.lit(0)).groupBy("root").applyInPandas(cut, "ord bigint, head bigint"))
    close = pairs.where(units(F.col("dist")) <= round(threshold * UNIT))
    roots = components(nodes, close.select("i", "j"))
    if method == "single":
        return _labelled(nodes, roots.withColumnRenamed("root", "head"))
    roots = materialize(roots, "roots")
    # A component's pairs, each once, stand at its first member.
    of = roots.withColumnsRenamed({"ord": "i"})
    inside = pairs.join(of, "i").join(roots.withColumnsRenamed({"ord": "j", "root": "other"}), "j").where("root = other")
    small = inside.select(F.col("i").alias("ord"), "i", "j", "dist")
    return _labelled(nodes, _inside(roots, cut, small, close, lambda asked: asked_of(asked, pairs), threshold, method, group_rows))


def asked_of(asked: DataFrame, pairs: DataFrame) -> DataFrame:
    """(i, j, dist) of asked pairs, in their own order, from a table that holds each pair once."""
    ordered = asked.distinct().select("i", "j", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"))
    return ordered.join(pairs.withColumnsRenamed({"i": "x", "j": "y"}), ["x", "y"]).select("i", "j", "dist")


def cluster_alignment(alignment: DataFrame, threshold: float = 0.01, method: str = "average", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(ord, cluster_id) of aligned sequences (ord, aln), as ``clusters`` over all pairs gives.

    Only pairs up to the cut are kept. The sequences of a component of up to ``group_rows``
    go to one task, once each, and their distances are computed there; a larger component
    is linked by many tasks (``agglomerate``). Both give the same clusters.
    """
    _checked(threshold, method)
    rows = alignment.select("ord", "aln", F.lit(None).cast("string").alias("seq_id"))
    nodes = rows.select("ord")

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        labels = cut_labels(masked_distances(pdf["aln"].tolist()), threshold, method)
        return pd.DataFrame({"ord": pdf["ord"].to_numpy(), "head": pd.Series(pdf["ord"].to_numpy()).groupby(labels).transform("min")})

    if method == "ward":
        return _labelled(nodes, rows.select("ord", "aln", F.lit(0).alias("root")).groupBy("root").applyInPandas(cut, "ord bigint, head bigint"))
    limit = round(threshold * UNIT)
    close = materialize(distance.pairwise(rows).where(units(F.col("dist")) <= limit).select("i", "j", "dist"), "close")
    roots = components(nodes, close.select("i", "j"))
    if method == "single":
        return _labelled(nodes, roots.withColumnRenamed("root", "head"))
    planes: list[DataFrame] = []

    def between(asked: DataFrame) -> DataFrame:
        if not planes:
            planes.append(materialize(distance.encoded(rows), "planes"))
        return distance.of_pairs(asked, planes[0])

    return _labelled(nodes, _inside(materialize(roots, "roots"), cut, rows.select("ord", "aln"), close, between, threshold, method, group_rows))


def dendrogram(rows: DataFrame, method: str = "average") -> DataFrame:
    """V9: the merges of a few aligned sequences (name, ord, aln), one row each.

    step, the two merged nodes (below the number of sequences these are sequences by
    ``ord``, beyond it earlier steps), their names if they are sequences, height, size.
    A drawing has one leaf per genotype, so the genotypes come to the driver.
    """
    laid = [(r["name"], r["aln"]) for r in rows.orderBy("ord").select("name", "aln").collect()]
    name_of = lambda k: laid[k][0] if k < len(laid) else None
    merges = linkage(masked_distances([a for _, a in laid]), method) if len(laid) > 1 else []
    out = [(k, a, b, name_of(a), name_of(b), float(h), int(n)) for k, (a, b, h, n) in enumerate(merges)]
    return rows.sparkSession.createDataFrame([(k, int(a), int(b), x, y, h, n) for k, a, b, x, y, h, n in out], "step int, a int, b int, name_a string, name_b string, height double, size int")
