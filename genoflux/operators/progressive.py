"""Progressive alignment, profile with profile, a level of the guide tree in each stage.

The guide tree is balanced: distinct sequences stand in the order of their smallest q-gram
hashes, in which like sequences are neighbours, and the nodes 2i and 2i + 1 of a level merge to
node i of the next. Each merge aligns two profiles (letter counts by column) in an Arrow function, by
the rule below, and records where the columns of both went. The levels are
then walked back: a child's columns go where its parent's went, down to each sequence, which is
laid out over the columns of the root. A level is one stage whose rows are its nodes,
so work is spread over the tasks but for the last few merges, and no task sees all sequences.

Two columns score the mean of +1 for equal and -1 for different letters over the pairs of their
rows (N and gaps count nothing); a column without a partner costs GAP times its share of letters.
Of equally good ways the columns are paired, then the left one stands alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import discard, materialize, numbered
from . import nearest

LETTERS, GAP = "ACGTN-", 1.5
NODE = "node bigint, profile array<float>, a array<int>, b array<int>"


def profile_of(seq: str) -> np.ndarray:
    """Columns by letters: a row for each letter of the sequence."""
    codes = np.array([min(LETTERS.find(c), 5) if c in LETTERS else 4 for c in seq.upper()], int)
    out = np.zeros((len(seq), len(LETTERS)), np.float32)
    out[np.arange(len(seq)), codes] = 1
    return out


def merge(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merged profile and the places of the columns of both in it."""
    n, m = len(x), len(y)
    rows_x, rows_y = max(x.sum(1).max(initial=0), 1), max(y.sum(1).max(initial=0), 1)
    fx, fy = x[:, :4] / rows_x, y[:, :4] / rows_y
    same = fx @ fy.T
    pair = 2 * same - fx.sum(1)[:, None] * fy.sum(1)[None, :]
    cost_x, cost_y = GAP * x[:, :5].sum(1) / rows_x, GAP * y[:, :5].sum(1) / rows_y
    along = np.concatenate([[0.0], np.cumsum(cost_y)])
    best = np.empty((n + 1, m + 1), np.float64)
    best[0] = -along
    for i in range(1, n + 1):
        row = np.empty(m + 1)
        row[0] = best[i - 1, 0] - cost_x[i - 1]
        np.maximum(best[i - 1, :-1] + pair[i - 1], best[i - 1, 1:] - cost_x[i - 1], out=row[1:])
        # Columns of y alone run along the row: a prefix maximum of score plus cost so far.
        best[i] = np.maximum.accumulate(row + along) - along
    i, j, steps = n, m, []
    while i or j:
        if i and j and best[i, j] <= best[i - 1, j - 1] + pair[i - 1, j - 1] + 1e-9:
            steps.append(0)
            i, j = i - 1, j - 1
        elif i and best[i, j] <= best[i - 1, j] - cost_x[i - 1] + 1e-9:
            steps.append(1)
            i -= 1
        else:
            steps.append(2)
            j -= 1
    steps = np.array(steps[::-1], int)
    a, b = np.flatnonzero(steps != 2), np.flatnonzero(steps != 1)
    out = np.zeros((len(steps), len(LETTERS)), np.float32)
    out[a] += x
    out[b] += y
    # Rows that have no letter in a column have a gap there.
    out[steps == 2, 5] += x.sum(1).max(initial=0)
    out[steps == 1, 5] += y.sum(1).max(initial=0)
    return out, a, b


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for node, left, right in pdf.itertuples(index=False):
            x = np.asarray(left, np.float32).reshape(-1, len(LETTERS))
            if right is None:
                rows.append((node, x.ravel(), np.arange(len(x)), None))
            else:
                out, a, b = merge(x, np.asarray(right, np.float32).reshape(-1, len(LETTERS)))
                rows.append((node, out.ravel(), a, b))
        yield pd.DataFrame(rows, columns=["node", "profile", "a", "b"])


def _profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"node": pdf["node"], "profile": [profile_of(s).ravel() for s in pdf["q"]]})


def align(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Adds ``aln``; all aligned sequences are of one length. Rows without a sequence have none."""
    distinct = df.where(F.coalesce(seq, F.lit("")) != "").select(F.col(seq).alias("q")).distinct()
    sketch = F.coalesce(F.array_join(F.transform(nearest.seeds(F.upper("q")), lambda h: F.lpad(F.hex(h), 16, "0")), ""), F.lit(""))
    leaves = materialize(numbered(distinct.withColumn("sketch", sketch), ["sketch", "q"], "place").select((F.col("place") - 1).cast("bigint").alias("node"), "q"), "leaves")
    count = leaves.count()
    level = materialize(leaves.mapInPandas(_profiles, "node bigint, profile array<float>"), "level")
    steps: list[DataFrame] = []
    while count > 1:
        even, odd = (level.where(F.col("node") % 2 == k).select(F.floor(F.col("node") / 2).alias("node"), F.col("profile").alias(n)) for k, n in ((0, "x"), (1, "y")))
        pairs = even.join(odd, "node", "left")
        merged = materialize(pairs.mapInPandas(_merged, NODE), "merged")
        discard(level)
        level = merged.select("node", "profile")
        level._stored_at = merged._stored_at
        # The places are kept apart from the profiles, which go when the next level is written.
        places = merged.select((F.col("node") * 2).alias("node"), F.col("node").alias("parent"), F.col("a").alias("at")).union(merged.where("b IS NOT NULL").select(F.col("node") * 2 + 1, "node", "b"))
        steps.append(materialize(places, "places"))
        count = -(-count // 2)
    # From the root down: where each node's columns stand in the whole.
    size = level.select((F.size("profile") / len(LETTERS)).cast("int").alias("n")).first()
    whole = size["n"] if size else 0
    at = level.select("node", F.when(F.lit(whole) > 0, F.sequence(F.lit(0), F.lit(max(whole - 1, 0)))).alias("where"))
    for places in reversed(steps):
        above = at.withColumnRenamed("node", "parent")
        at = materialize(places.join(above, "parent").select("node", F.transform("at", lambda k: F.get("where", k)).alias("where")), "columns")
    letters = F.map_from_arrays("where", F.split("q", ""))
    laid = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(max(whole - 1, 0))), lambda k: F.coalesce(F.try_element_at(letters, k), F.lit("-"))), "")
    rows = leaves.join(at, "node").select("q", laid.alias("aln"))
    return df.join(rows, F.col(seq) == F.col("q"), "left").drop("q")
