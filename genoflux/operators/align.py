"""A star alignment and column trimming.

Plain substitutes for external aligners, and named so: results are not those of
any of them. The centre is the most frequent sequence; each distinct sequence is
aligned to it (Arrow function), the widest insertion at every place opens that
many columns, and all are laid out over the same columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.storage import discard, materialize
from . import paths

#: Distinct sequences that one task aligns. Their few bytes would all go to one task.
TASK_ROWS = 200
PIECES = T.StructType([T.StructField("pieces", T.ArrayType(T.StringType())), T.StructField("inserts", T.ArrayType(T.IntegerType()))])


@F.pandas_udf(PIECES)
def to_centre(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """pieces[k]: letters put in before centre letter k, then the letter at k ('-' if none)."""
    import re

    for qs, cs in batches:
        rows = []
        for q, (*_, cigar) in zip(qs, paths.align(qs.tolist(), cs.tolist()), strict=True):
            pieces, i, held = [], 0, ""
            for run, op in re.findall(r"(\d+)([=XID])", cigar):
                for _ in range(int(run)):
                    if op == "I":
                        held += q[i]
                        i += 1
                    else:
                        pieces.append(held + (q[i] if op in "=X" else "-"))
                        i += op in "=X"
                        held = ""
            pieces.append(held)
            rows.append((pieces, [len(p) - 1 for p in pieces[:-1]] + [len(pieces[-1])]))
        yield pd.DataFrame(rows, columns=["pieces", "inserts"])


def star_align(df: DataFrame, seq: str = "seq", weight: str | None = None) -> DataFrame:
    """Adds ``aln``; all aligned sequences are of one length. ``weight``: a column that tells
    for how many rows a row stands."""
    some = df.where(F.coalesce(seq, F.lit("")) != "")
    distinct = materialize(some.groupBy(F.col(seq).alias("q")).agg(_rows(weight).alias("n")), "distinct")
    centre = distinct.agg(F.min_by("q", F.struct((-F.col("n")).alias("k"), F.col("q"))).alias("c"))
    spread = distinct.repartition(max(8, -(-distinct.count() // TASK_ROWS)), "q")
    aligned = materialize(spread.join(F.broadcast(centre)).withColumn("a", to_centre("q", "c")).select("q", "a.*"), "pieces")
    discard(distinct)
    widths = aligned.select(F.posexplode("inserts").alias("k", "w")).groupBy("k").agg(F.max("w").alias("w"))
    wide = widths.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "w"))), lambda s: s["w"]).alias("widths"))
    last = F.size("pieces") - 1
    laid = F.zip_with(F.sequence(F.lit(0), last), F.arrays_zip("pieces", "widths"), lambda k, p: F.when(k < last, F.lpad(p["pieces"], p["widths"] + 1, "-")).otherwise(F.lpad(p["pieces"], p["widths"], "-")))
    rows = aligned.join(F.broadcast(wide)).select("q", F.array_join(laid, "").alias("aln"))
    return df.join(rows, F.col(seq) == F.col("q"), "left").drop("q")


def _rows(weight: str | None) -> Column:
    return F.sum(weight) if weight else F.count("*")


def _kept(df: DataFrame, columns: DataFrame, aln: str) -> DataFrame:
    """The alignment with the columns where ``keep`` is true alone. ``columns`` has every place ``k``;
    its list has an entry a column, not a row. Letters and flags go in step, so a row is split once."""
    keep = columns.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "keep"))), lambda s: s["keep"]).alias("__keep"))
    letters = F.zip_with(F.split(aln, ""), "__keep", lambda c, stays: F.when(stays, c))
    return df.join(F.broadcast(keep)).withColumn(aln, F.coalesce(F.array_join(letters, ""), F.lit(""))).drop("__keep")


def _letters(df: DataFrame, text: Column, weight: str | None) -> DataFrame:
    """k, c, n: the letters of each distinct text and the rows it stands for."""
    return df.groupBy(text.alias("text")).agg(_rows(weight).alias("n")).select("n", F.posexplode(F.split("text", "")).alias("k", "c"))


def trim_columns(df: DataFrame, max_gap: float = 0.5, aln: str = "aln", weight: str | None = None) -> DataFrame:
    """Drops alignment columns whose share of gaps exceeds ``max_gap``."""
    gaps = F.sum(F.when(F.col("c") == "-", F.col("n")).otherwise(0)) / F.sum("n")
    cols = _letters(df, F.col(aln), weight).groupBy("k").agg(gaps.alias("gap"))
    return _kept(df, cols.withColumn("keep", F.col("gap") <= F.lit(max_gap)), aln)


#: Scores are put in so many bins; a cut is sought in the lower half.
BINS = 100


def column_scores(df: DataFrame, aln: str = "aln", weight: str | None = None) -> DataFrame:
    """k, gap (share of gaps), similarity (share of pairs of rows with the same letter, gaps never the
    same), score (similarity times the share without gap), bin of each alignment column."""
    letters = _letters(df, F.upper(aln), weight).groupBy("k", "c").agg(F.sum("n").alias("m"))
    some = F.col("c") != "-"
    n = F.sum("m").cast("double")
    same = F.coalesce(F.sum(F.when(some, F.col("m").cast("double") * (F.col("m") - 1))), F.lit(0.0))
    filled = F.coalesce(F.sum(F.when(some, F.col("m"))), F.lit(0)).cast("double")
    similarity = F.when(n > 1, same / (n * (n - 1))).otherwise(F.lit(1.0))
    cols = letters.groupBy("k").agg((1 - filled / n).alias("gap"), similarity.alias("similarity"), (filled / n).alias("__filled"))
    cols = cols.withColumn("score", F.col("similarity") * F.col("__filled")).drop("__filled")
    return cols.withColumn("bin", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int"))


def trim_similar(df: DataFrame, aln: str = "aln", weight: str | None = None) -> DataFrame:
    """Drops the columns under a cut that the distribution of the scores decides.

    The cut parts the columns to two classes with the largest variance between them (Otsu), and is
    sought in the lower half alone: an alignment whose columns all score over one half stays whole.
    Columns without a gap always stay, however their letters differ: they tell groups apart.
    """
    cols = column_scores(df, aln, weight)
    return _kept(df, cols.join(F.broadcast(score_cut(cols))).withColumn("keep", F.expr("bin >= cut OR gap = 0")), aln)


def score_cut(cols: DataFrame) -> DataFrame:
    """One row: the lowest bin that is kept."""
    # A row for each bin, so the window sees BINS rows at most.
    by_bin = cols.groupBy("bin").agg(F.count("*").cast("double").alias("n"), F.sum("bin").cast("double").alias("s"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parted = by_bin.select("bin", F.max("bin").over(below).alias("last"), F.sum("n").over(below).alias("n0"), F.sum("s").over(below).alias("s0"), F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("s"))
    n1, apart = F.col("n") - F.col("n0"), F.col("s0") * (F.col("n") - F.col("n0")) - (F.col("s") - F.col("s0")) * F.col("n0")
    between = parted.where(F.col("n0").isNotNull()).select("bin", "last", (apart * apart / (F.col("n0") * n1)).alias("v"))
    # Only columns that score under one half can go.
    good = between.where((F.col("last") < BINS // 2) & (F.col("v") > 0))
    return good.agg(F.coalesce(F.max_by("bin", F.struct("v", -F.col("bin"))), F.lit(0)).alias("cut"))
