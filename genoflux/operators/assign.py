"""K4: best and runner-up genotype of every specimen.

Each distinct sequence is scored once and joined back, since barcode data repeat. It
meets only the consensus sequences that can be its best or runner-up (``nearest``: a seed
index and falling bounds), exactly. Scoring stays in the JVM (``levenshtein``); a
path-based metric runs as an Arrow function on the distinct pairs that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence
from ..schemas import struct
from . import nearest, paths

METHODS = ("target_based", "classic")


def align_path(q: str, t: str) -> tuple[int, int, int, int, str]:
    """Global unit-cost alignment: matches, mismatches, insertions, deletions, CIGAR."""
    return paths.align([q], [t])[0]


PATH = struct("matches int, mismatches int, insertions int, deletions int, cigar string")


@F.pandas_udf(PATH)
def path_identity(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for qs, ts in pairs:
        yield pd.DataFrame(paths.align([q or "" for q in qs], [t or "" for t in ts]), columns=["matches", "mismatches", "insertions", "deletions", "cigar"])


def contenders(pairs: DataFrame, identity_method: str) -> DataFrame:
    """Pairs (with d) that can be a sequence's best or runner-up by paths; no other is aligned.

    Two pairs with higher lower bounds (``nearest.bounds``) rule a pair out.
    """
    low, high = nearest.bounds(F.length("nuc"), F.length("target"), F.col("d"), identity_method, True)
    each = Window.partitionBy("nuc")
    placed = pairs.withColumns({"__low": low, "__high": high})
    placed = placed.withColumn("__place", F.row_number().over(each.orderBy(F.desc("__low"))))
    second = F.max(F.when(F.col("__place") == 2, F.col("__low"))).over(each)
    return placed.withColumn("__second", second).where(F.coalesce(F.col("__high") >= F.col("__second"), F.lit(True))).select(*pairs.columns)


def scored(sequences: DataFrame, consensus: DataFrame, path: bool = False, top_by: str | None = None) -> DataFrame:
    """(nuc, consensus) with distances and identities. ``sequences``: one column of distinct,
    non-empty nuc; ``consensus``: consensus_group, consensus_seq, ord. With ``top_by`` (an identity
    method) only pairs that can be first or second by it (``nearest``), else every pair."""
    c = consensus.select("consensus_group", F.col("consensus_seq").alias("target"), F.col("ord").alias("c_ord"))
    if top_by:
        pairs = nearest.candidates(sequences, c, top_by, path)
    else:
        pairs = nearest.dealt(sequences, c, "nuc", "c_ord", sequences.count(), c.count()).withColumn("d", F.levenshtein("nuc", "target"))
    if path:
        if top_by:
            pairs = contenders(pairs, top_by)
        pairs = pairs.withColumn("__p", path_identity("nuc", "target"))
        q, t = F.length("nuc"), F.length("target")
        d = F.col("__p.mismatches") + F.col("__p.insertions") + F.col("__p.deletions")
        return pairs.select(
            "nuc", "consensus_group", "target", "c_ord", d.alias("edit_distance"), F.col("__p.matches").alias("matches"),
            (F.col("__p.matches") / t.cast("double")).alias("target_identity"), sequence.classic_identity(d, q, t).alias("classic_identity"),
            F.lit("path").alias("method"), F.col("__p.mismatches").alias("mismatches"), F.col("__p.insertions").alias("insertions"), F.col("__p.deletions").alias("deletions"),
        )
    found = pairs.withColumn("__i", sequence.path_free_identity(F.col("nuc"), F.col("target"), F.col("d")))
    none = F.lit(None).cast("int")
    return found.select("nuc", "consensus_group", "target", "c_ord", "__i.*", none.alias("mismatches"), none.alias("insertions"), none.alias("deletions"))


def assign(
    specimens: DataFrame,
    consensus: DataFrame,
    min_identity: float = 0.90,
    identity_method: str = "target_based",
    tie_margin: float = 0.003,
    tie_min_identity: float = 0.95,
    path: bool = False,
) -> DataFrame:
    """Diagnostics: one row per specimen (processid, nuc)."""
    if identity_method not in METHODS:
        raise ValueError(f"identity_method must be one of {METHODS}, got {identity_method!r}")
    some = F.coalesce("nuc", F.lit("")) != ""
    distinct = specimens.where(some).select("nuc").distinct()
    metric = F.col("target_identity" if identity_method == "target_based" else "classic_identity")
    order = Window.partitionBy("nuc").orderBy(F.desc("identity"), "c_ord")
    ranked = scored(distinct, consensus, path, identity_method).withColumn("identity", metric).withColumn("place", F.row_number().over(order)).where("place <= 2")
    keep = ["consensus_group", "target", "identity", "target_identity", "classic_identity", "matches", "mismatches", "insertions", "deletions", "edit_distance"]
    at = lambda place, c: F.max(F.when(F.col("place") == place, F.col(c)))
    top = ranked.groupBy("nuc").agg(
        *[at(1, c).alias(c) for c in keep], at(2, "consensus_group").alias("runner_up_group"), F.coalesce(at(2, "identity"), F.lit(-1.0)).alias("runner_up_identity")
    )
    joined = specimens.select("processid", "nuc").join(top, "nuc", "left")
    best, second = F.col("identity"), F.col("runner_up_identity")
    assigned = F.coalesce(best >= F.lit(min_identity), F.lit(False))
    tie = assigned & (second > 0) & (best >= F.lit(tie_min_identity)) & (best - second < F.lit(tie_margin))
    low = assigned & (best < F.lit(min_identity) + F.lit(0.03))
    status = F.when(~some, "no_sequence").when(~assigned, "below_threshold").when(tie, "tie").when(low, "low_confidence").otherwise("assigned")
    zero = lambda c, v: F.when(some, F.col(c)).otherwise(F.lit(v)).alias(c)
    return joined.select(
        "processid",
        F.when(assigned, F.col("consensus_group")).alias("consensus_group"),
        zero("identity", 0.0), zero("target_identity", 0.0), zero("classic_identity", 0.0),
        F.lit(identity_method).alias("identity_method"),
        zero("matches", 0), "mismatches", "insertions", "deletions", zero("edit_distance", 0),
        F.coalesce(F.abs(F.length("nuc") - F.length("target")), F.lit(0)).alias("length_discrepancy"),
        "runner_up_group", zero("runner_up_identity", 0.0),
        F.coalesce(tie, F.lit(False)).alias("is_tie"), F.coalesce(low, F.lit(False)).alias("is_low_confidence"), status.alias("status"),
    )


def assign_legacy(specimens: DataFrame, consensus: DataFrame, min_identity: float = 0.90) -> DataFrame:
    """The older form: classic metric on upper-cased sequences, no ties and no status."""
    upper = consensus.withColumn("consensus_seq", F.upper("consensus_seq"))
    found = assign(specimens.withColumn("nuc", F.upper("nuc")), upper, min_identity, "classic")
    return found.select("processid", "consensus_group", F.col("identity").alias("identity_score"), "runner_up_group", F.col("runner_up_identity").alias("runner_up_score"))


def with_metadata(metadata: DataFrame, fasta: DataFrame) -> DataFrame:
    """The sequence of each specimen by the process id in its FASTA header (first record wins)."""
    from .qc import keep_first

    known = keep_first(fasta.select(sequence.processid_of(F.col("header")).alias("processid"), F.col("seq").alias("nuc"), "ord").where("processid IS NOT NULL"), "processid").drop("ord")
    return metadata.drop("nuc").join(known, "processid", "left")


def renamed_counts(diagnostics: DataFrame) -> DataFrame:
    """A7: 'group' becomes 'group_n<assigned>' for best and runner-up; unseen groups keep their name."""
    counts = diagnostics.where("consensus_group IS NOT NULL").groupBy("consensus_group").agg(F.count("*").alias("n"))
    named = counts.select(F.col("consensus_group").alias("g"), F.concat("consensus_group", F.lit("_n"), F.col("n").cast("string")).alias("new"))
    out = diagnostics
    for c in ("consensus_group", "runner_up_group"):
        out = out.join(named.withColumnsRenamed({"g": c, "new": f"__{c}"}), c, "left").withColumn(c, F.coalesce(f"__{c}", c)).drop(f"__{c}")
    return out


def summary_stats(diagnostics: DataFrame) -> DataFrame:
    """One row of counts."""
    status = lambda s: F.count_if(F.col("status") == s)
    return diagnostics.agg(
        F.count("*").alias("total"),
        F.count("consensus_group").alias("assigned"),
        F.count_if(F.col("consensus_group").isNull()).alias("unassigned"),
        status("no_sequence").alias("no_sequence"), status("below_threshold").alias("below_threshold"),
        F.count_if("is_tie").alias("ties"), F.count_if("is_low_confidence").alias("low_confidence"),
    )


def ambiguity(diagnostics: DataFrame, margin: float = 0.01) -> DataFrame:
    """How many specimens have a runner-up within ``margin``."""
    close: Column = (F.col("identity") - F.col("runner_up_identity")) < F.lit(margin)
    return diagnostics.where("consensus_group IS NOT NULL AND runner_up_group IS NOT NULL").agg(F.count_if(close).alias("n_ambiguous"))
