"""The pairs of a sequence and a consensus that can be the sequence's first or second.

Instead of every sequence with every consensus:

1. A seed index: the SEEDS smallest hashes of a sequence's q-grams; each seed leads to the
   first consensus that has it, and the consensus with most seeds is the anchor. An edit
   touches at most GRAM q-grams, so close sequences share most of them; a poor or absent
   anchor costs time, never a result.
2. The anchors' edit distances to every consensus are computed once, not once a sequence.
3. A sequence's distances to its anchor and to the consensus nearest to that one give
   a floor for its second best identity. By the triangle inequality another consensus is
   at least d(anchor, it) - d(anchor, sequence) edits away, and at least the difference of
   the lengths; where the identity that this allows is below the floor, it is out.
4. The pairs left are scored exactly, within the number of edits that the floor allows.

Rows that share an anchor or a seed (a common genotype may hold a third of all) are dealt to
SALTS parts at each of these joins. Sequences are short and an edit distance is much work, so
sequences and pairs are dealt to tasks by their number, not by their bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.storage import materialize

GRAM, SEEDS, SALTS = 11, 8, 16
#: Rows of a block where all rows of one table meet all of another.
BLOCK_ROWS = 2_000
#: Sequences with their two guides, and pairs, of one task.
TASK_ROWS, TASK_PAIRS = 2_000, 50_000


def bounds(q: Column, t: Column, d: Column, identity_method: str, path: bool) -> tuple[Column, Column]:
    """Lowest and highest identity of a pair of q and t letters at an edit distance ``d``.

    The classic identity and the one without a path follow from d. A path of d edits with k
    deletions matches q - d + k letters, where t - q <= k and 2k <= d + t - q.
    """
    if identity_method == "classic":
        one = F.when(F.greatest(q, t) > 0, F.lit(1.0) - d / F.greatest(q, t)).otherwise(F.lit(1.0))
        return one, one
    share = lambda k: F.when(t > 0, (q - d + k) / t.cast("double")).otherwise(F.lit(0.0))
    low = share(F.greatest(t - q, F.lit(0)))
    return low, share(F.floor((d + t - q) / 2)) if path else low


def most_edits(q: Column, t: Column, floor: Column, identity_method: str, path: bool) -> Column:
    """No pair of q and t letters with more edits reaches the identity ``floor``."""
    longest = F.greatest(q, t)
    if identity_method == "classic":
        most = (1 - floor) * longest
    else:
        most = q + t - 2 * floor * t if path else longest - floor * t
    return F.least(F.greatest(F.ceil(most + 1e-6), F.lit(0)), longest).cast("int")


def seeds(s: Column) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.length(s) - (GRAM - 1)), lambda i: F.xxhash64(F.substring(s, i, F.lit(GRAM))))
    return F.when(F.length(s) >= GRAM, F.slice(F.array_sort(F.array_distinct(grams)), 1, SEEDS))


def dealt(left: DataFrame, right: DataFrame, left_key: str, right_key: str, n_left: int, n_right: int) -> DataFrame:
    """Every row of one table with every row of the other, dealt to pairs of blocks by an equi-join."""
    a, b = max(8, -(-n_left // BLOCK_ROWS)), max(1, -(-n_right // BLOCK_ROWS))
    x = left.withColumn("__x", F.pmod(F.xxhash64(left_key), F.lit(a)).cast("int")).withColumn("__y", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
    y = right.withColumn("__y", F.pmod(F.xxhash64(right_key), F.lit(b)).cast("int")).withColumn("__x", F.explode(F.sequence(F.lit(0), F.lit(a - 1))))
    return x.join(y, ["__x", "__y"]).drop("__x", "__y")


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def anchored(sequences: DataFrame, c: DataFrame) -> DataFrame:
    """nuc, sid, salt, anchor (the c_ord of the consensus with most seeds; null without any)."""
    own = sequences.withColumn("sid", F.xxhash64("nuc")).withColumn("salt", F.pmod("sid", F.lit(SALTS)).cast("int"))
    index = c.select(F.explode(seeds(F.col("target"))).alias("seed"), "c_ord").groupBy("seed").agg(F.min("c_ord").alias("c_ord"))
    votes = own.select("sid", "salt", F.explode(seeds(F.col("nuc"))).alias("seed")).join(_salted(index), ["seed", "salt"]).groupBy("sid", "c_ord").count()
    best = votes.groupBy("sid").agg(F.min_by("c_ord", F.struct(-F.col("count"), "c_ord")).alias("anchor"))
    return own.join(best, "sid", "left")


def candidates(sequences: DataFrame, consensus: DataFrame, identity_method: str, path: bool = False) -> DataFrame:
    """nuc, consensus_group, target, c_ord, d (edit distance) of the pairs that can be first or second.

    ``sequences``: one column of distinct, non-empty nuc; ``consensus``: consensus_group, target, c_ord (distinct).
    """
    c = materialize(consensus, "consensus")
    n, first = c.agg(F.count("*"), F.min("c_ord")).first()
    sequences = materialize(sequences, "sequences")
    tasks = max(8, -(-sequences.count() // TASK_ROWS))
    own = materialize(anchored(sequences.repartition(tasks, "nuc"), c).withColumn("anchor", F.coalesce("anchor", F.lit(first))), "anchored")
    used = own.select("anchor").distinct().join(c.select(F.col("c_ord").alias("anchor"), F.col("target").alias("anchor_seq")), "anchor")
    apart = dealt(used, c.select("c_ord", "target"), "anchor", "c_ord", n, n)
    apart = materialize(apart.select("anchor", "c_ord", F.length("target").alias("t"), F.levenshtein("anchor_seq", "target").alias("apart")), "apart")
    # The consensus nearest to an anchor is the first guess of the second best.
    beside = apart.where("c_ord <> anchor").groupBy("anchor").agg(F.min_by("c_ord", F.struct("apart", "c_ord")).alias("beside"))
    text = lambda key, name: c.select(F.col("c_ord").alias(key), F.col("target").alias(name))
    guides = text("anchor", "one").join(beside, "anchor", "left").join(text("beside", "two"), "beside", "left")
    q = F.length("nuc")
    known = own.join(_salted(guides.select("anchor", "one", "two")), ["anchor", "salt"]).repartition(tasks, "nuc").withColumns({"d1": F.levenshtein("nuc", "one"), "d2": F.levenshtein("nuc", "two")})
    lows = [bounds(q, F.length(name), F.col(d), identity_method, path)[0] for name, d in (("one", "d1"), ("two", "d2"))]
    # With one consensus only there is no second best to fall behind.
    floor = F.when(F.col("two").isNotNull(), F.least(*lows)).otherwise(F.lit(float("-inf")))
    known = materialize(known.select("nuc", "sid", "salt", "anchor", "d1", q.alias("q"), floor.alias("floor")), "known")
    least = F.greatest(F.col("apart") - F.col("d1"), F.abs(F.col("q") - F.col("t")))
    reached = bounds(F.col("q"), F.col("t"), least, identity_method, path)[1] >= F.col("floor") - 1e-9
    pairs = materialize(known.join(_salted(apart), ["anchor", "salt"]).where(reached).select("nuc", "salt", "c_ord", "q", "floor"), "pairs")
    spread = pairs.repartition(max(8, -(-pairs.count() // TASK_PAIRS)), "nuc")
    full = spread.join(_salted(c.select("c_ord", "consensus_group", "target")), ["c_ord", "salt"])
    edits = most_edits(F.col("q"), F.length("target"), F.greatest("floor", F.lit(-2.0)), identity_method, path)
    # The distance is computed once: a condition on a plain column would be moved before it, and compute it again.
    found = F.filter(F.array(F.expr("levenshtein(nuc, target, edits)")), lambda d: d >= 0)
    return full.withColumn("edits", edits).select("nuc", "consensus_group", "target", "c_ord", F.explode(found).alias("d"))
