"""Linkage of one large component by many tasks: rounds of reciprocal nearest neighbours.

All of average, complete and weighted linkage are reducible: merging two clusters that
are each other's nearest never changes what the sequential algorithm, which
always merges the nearest pair of all, would do later. So in each round all such pairs merge at once.

The table of neighbours is sparse. It holds the pairs of clusters with at least one pair of
members up to the cut; no other pair can be at or below the cut (the mean of distances above it
is above it), now or later. When two clusters merge, their rows for a third one are
combined; if one of them is absent, its members' distances are asked for: for average
and weighted linkage only these pairs are computed, for complete linkage the pair is gone.

Distances are whole multiples of 2^-30, so sums do not depend on their order and ties are
exact. Of equally near pairs the one with the smaller first member counts, then the one
with the smaller second. Weighted distances are exact to 22 levels of merging.

A round writes its tables to the shared folder and deletes those before. Its work follows
the rows of the table, which shrinks; the number of rounds is not bounded but each
merges the nearest pair at least. No task holds a component.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.storage import discard, materialize

UNIT = 1 << 30


def units(dist: Column) -> Column:
    return F.round(dist * F.lit(float(UNIT))).cast("bigint")


def _nearest(edges: DataFrame, height: Column, cut: int) -> DataFrame:
    """(old, new, n): the pairs of clusters that are each other's nearest, at the cut at most."""
    near = edges.where(height <= F.lit(float(cut))).select(F.struct(height.alias("d"), "a", "b", "na", "nb").alias("key"))
    both = near.select(F.col("key.a").alias("node"), "key").union(near.select(F.col("key.b").alias("node"), "key"))
    best = both.groupBy("node").agg(F.min("key").alias("key"))
    return best.groupBy("key").count().where("count = 2").select(F.col("key.b").alias("old"), F.col("key.a").alias("new"), (F.col("key.na") + F.col("key.nb")).alias("n"))


def _relabelled(edges: DataFrame, merges: DataFrame) -> DataFrame:
    """Rows of pairs under the clusters' new names: lo, hi, their parts x and y, nx and ny (sizes of
    the new clusters), px and py (the other parts, null if the cluster did not merge)."""
    out = edges
    for end, size in (("a", "na"), ("b", "nb")):
        gone = merges.select(F.col("old").alias(end), F.col("new").alias("__to"), F.col("n").alias("__n"), F.col("new").alias("__other"))
        stays = merges.select(F.col("new").alias(end), F.col("new").alias("__to"), F.col("n").alias("__n"), F.col("old").alias("__other"))
        out = out.join(gone.union(stays), end, "left")
        out = out.withColumns({f"{end}2": F.coalesce("__to", end), f"{size}2": F.coalesce("__n", size), f"{end}3": F.col("__other")}).drop("__to", "__n", "__other")
    out = out.where("a2 <> b2")
    first = F.col("a2") < F.col("b2")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return out.select(
        pick("a2", "b2").alias("lo"), pick("b2", "a2").alias("hi"), pick("a", "b").alias("x"), pick("b", "a").alias("y"), "s",
        pick("na2", "nb2").alias("nx"), pick("nb2", "na2").alias("ny"), pick("a3", "b3").alias("px"), pick("b3", "a3").alias("py"),
    )


def agglomerate(members: DataFrame, close: DataFrame, between: Callable[[DataFrame], DataFrame], threshold: float, method: str = "average") -> DataFrame:
    """(ord, head): the cluster of every member, named by its smallest ``ord``.

    ``members``: one column ``ord``. ``close``: (i, j, dist), each pair up to the cut once.
    ``between`` gives (i, j, dist) for a table of other pairs (i, j).
    """
    cut = round(threshold * UNIT)
    one = F.lit(1).cast("bigint")
    value = units(F.col("dist"))
    edges = materialize(
        close.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), (value.cast("double") if method == "weighted" else value).alias("s"), one.alias("na"), one.alias("nb")), "linkage"
    )
    held = materialize(members.select("ord", F.col("ord").alias("head"), F.lit(1.0).alias("w")), "members")
    height = (F.col("s").cast("double") / (F.col("na") * F.col("nb")).cast("double")) if method == "average" else F.col("s").cast("double")
    while True:
        merges = materialize(_nearest(edges, height, cut), "merges")
        if merges.isEmpty():
            for old in (merges, edges):
                discard(old)
            return held.select("ord", "head")
        rows = _relabelled(edges, merges)
        parts = lambda own, other: F.when(F.col(other).isNull(), F.array(own)).otherwise(F.array(own, other))
        total = F.max("s") if method == "complete" else F.sum("s")
        # Two clusters have four parts at most, so four rows at most meet here.
        merged = rows.groupBy("lo", "hi").agg(
            total.alias("s"), F.max("nx").alias("na"), F.max("ny").alias("nb"), F.collect_list(F.struct("x", "y")).alias("have"), F.first(parts("x", "px")).alias("xs"), F.first(parts("y", "py")).alias("ys")
        )
        wanted = F.size("xs") * F.size("ys")
        if method == "complete":
            now = merged.where(F.size("have") == wanted).select(F.col("lo").alias("a"), F.col("hi").alias("b"), "s", "na", "nb")
        else:
            merged = materialize(merged.withColumn("of", wanted), "pairs")
            every = F.flatten(F.transform("xs", lambda x: F.transform(F.col("ys"), lambda y: F.struct(x.alias("x"), y.alias("y")))))
            lack = merged.where(F.size("have") < F.col("of")).select("lo", "hi", F.explode(F.array_except(every, F.col("have"))).alias("p")).select("lo", "hi", "p.x", "p.y")
            ours = lambda side, i: held.select(F.col("head").alias(side), F.col("ord").alias(i), F.col("w").alias(f"w{i}"))
            asked = materialize(lack.join(ours("x", "i"), "x").join(ours("y", "j"), "y").select("lo", "hi", "i", "j", "wi", "wj"), "asked")
            if not asked.isEmpty():
                worth = units(F.col("dist")) if method == "average" else F.col("wi") * F.col("wj") * units(F.col("dist"))
                added = asked.join(between(asked.select("i", "j")), ["i", "j"]).groupBy("lo", "hi").agg(F.sum(worth).alias("more"))
                merged_all = merged.join(added, ["lo", "hi"], "left").withColumn("s", F.col("s") + F.coalesce(F.col("more"), F.lit(0)))
            else:
                merged_all = merged
            now = merged_all.select(F.col("lo").alias("a"), F.col("hi").alias("b"), (F.col("s") if method == "average" else F.col("s") / F.col("of")).alias("s"), "na", "nb")
        last, edges = edges, materialize(now, "linkage")
        moved = merges.select(F.col("old").alias("head"), "new").union(merges.select(F.col("new").alias("head"), "new"))
        before, held = held, materialize(
            held.join(moved, "head", "left").select("ord", F.coalesce("new", "head").alias("head"), F.when(F.col("new").isNotNull(), F.col("w") / 2).otherwise(F.col("w")).alias("w")), "members"
        )
        for old in (last, before, merges, *(() if method == "complete" else (merged, asked))):
            discard(old)
