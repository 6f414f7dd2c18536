"""K1: masked pairwise distances of aligned sequences.

Each distinct aligned sequence becomes four bit planes (A, C, G, T) of 64-bit
words. Positions where both are one of ACGT are the AND of the planes' ORs,
matches the sum of the planes' ANDs; ``bit_count`` does the rest in the JVM.

All pairs are the result, so the work is quadratic by nature. The pairs are
dealt to block pairs by an equi-join: every sequence goes to the ``blocks``
block pairs of its block, so no side is broadcast and no task sees all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASES = "ACGT"
BLOCK_ROWS = 2_000


def planes(aln: Column) -> Column:
    """array<array<bigint>>: for each base, its positions as words of 64 bits."""
    s = F.upper(aln)
    # 64 characters to one number: '1' where the base stands, read by halves to stay in range.
    def word(base: str):
        others = "".join(chr(c) for c in range(33, 127) if chr(c) != base)
        bits = F.translate(s, base + others, "1" + "0" * len(others))
        chunk = lambda i: F.rpad(F.substring(bits, i * 64 + 1, F.lit(64)), 64, "0")
        high = lambda c: F.conv(F.substring(c, 1, 32), 2, 10).cast("bigint")
        low = lambda c: F.conv(F.substring(c, 33, 32), 2, 10).cast("bigint")
        return F.transform(F.sequence(F.lit(0), F.ceil(F.length(s) / 64).cast("int") - 1), lambda i: F.shiftleft(high(chunk(i)), 32).bitwiseOR(low(chunk(i))))

    return F.when(F.length(s) > 0, F.array(*[word(b) for b in BASES]))


def encoded(alignment: DataFrame, seq_id: str = "seq_id", aln: str = "aln", order: str = "ord") -> DataFrame:
    """One row per sequence: id, ord, length, planes pa..pt and pv (any of ACGT)."""
    p = alignment.select(F.col(seq_id).alias("seq_id"), F.col(order).alias("ord"), F.length(aln).alias("length"), planes(F.col(aln)).alias("__p"))
    wide = p.select("seq_id", "ord", "length", *[F.col("__p")[i].alias(f"p{b.lower()}") for i, b in enumerate(BASES)])
    either = lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseOR(y))
    return wide.withColumn("pv", either(either(F.col("pa"), F.col("pc")), either(F.col("pg"), F.col("pt"))))


def _common(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, n: s + n)


def pair_distance(left: str = "a", right: str = "b") -> Column:
    valid = _common(F.col(f"{left}.pv"), F.col(f"{right}.pv"))
    matches = sum((_common(F.col(f"{left}.p{b.lower()}"), F.col(f"{right}.p{b.lower()}")) for b in BASES[1:]), _common(F.col(f"{left}.pa"), F.col(f"{right}.pa")))
    return F.when(valid == 0, F.lit(1.0)).otherwise(F.lit(1.0) - matches / valid)


def check_alignment(alignment: DataFrame, aln: str = "aln") -> None:
    found = alignment.agg(F.count("*").alias("n"), F.min(F.length(aln)).alias("lo"), F.max(F.length(aln)).alias("hi")).first()
    if found["n"] < 2 or not found["hi"]:
        raise ValueError("distances need at least two sequences")
    if found["lo"] != found["hi"]:
        raise ValueError(f"aligned sequences differ in length: {found['lo']} to {found['hi']}")


def pairwise(alignment: DataFrame, blocks: int | None = None, max_distance: float | None = None, seq_id: str = "seq_id", aln: str = "aln", order: str = "ord") -> DataFrame:
    """(i, j, id_i, id_j, dist) for every pair with ord_i < ord_j, of one block pair a task.

    ``max_distance`` keeps only the close pairs (before any further shuffle). Blocks
    hold some BLOCK_ROWS sequences, so a task's pairs do not grow with the table.
    """
    blocks = blocks or max(8, -(-alignment.count() // BLOCK_ROWS))
    e = encoded(alignment, seq_id, aln, order).withColumn("own", F.pmod(F.xxhash64("ord"), F.lit(blocks)).cast("int"))
    # Of a pair of blocks p <= q the rows of p stand left, those of q right; a block meets itself once.
    a = e.withColumn("p", F.col("own")).withColumn("q", F.explode(F.sequence(F.col("own"), F.lit(blocks - 1)))).alias("a")
    b = e.withColumn("q", F.col("own")).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("own")))).alias("b")
    once = (F.col("a.p") != F.col("a.q")) | (F.col("a.ord") < F.col("b.ord"))
    pairs = a.join(b, (F.col("a.p") == F.col("b.p")) & (F.col("a.q") == F.col("b.q")) & once)
    i_first = F.col("a.ord") < F.col("b.ord")
    pick = lambda x, y, c: F.when(i_first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}"))
    out = pairs.select(pick("a", "b", "ord").alias("i"), pick("b", "a", "ord").alias("j"), pick("a", "b", "seq_id").alias("id_i"), pick("b", "a", "seq_id").alias("id_j"), pair_distance().alias("dist"))
    return out if max_distance is None else out.where(F.col("dist") <= F.lit(max_distance))


def of_pairs(asked: DataFrame, e: DataFrame) -> DataFrame:
    """(i, j, dist) of the asked pairs (i, j) of sequences; ``e`` as ``encoded`` gives them."""
    e = e.drop("seq_id", "length")
    both = asked.distinct().join(e.alias("a"), F.col("i") == F.col("a.ord")).join(e.alias("b"), F.col("j") == F.col("b.ord"))
    return both.select("i", "j", pair_distance().alias("dist"))
