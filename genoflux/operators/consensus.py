"""K3: column-wise consensus vote per cluster, in built-in functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def consensus(members: DataFrame, cutoff: float = 0.7, cluster: str = "cluster_id", aln: str = "aln", order: str = "ord") -> DataFrame:
    """cluster_id, consensus_group, consensus_seq, n_reference.

    A column's most frequent base (ties: met first by ``ord``) is kept if its
    share of the column's ACGT reaches ``cutoff``; other columns fall away. Equal
    sequences of a cluster vote together, and counts are combined before the shuffle,
    so a large cluster is no single task.
    """
    m = members.groupBy(F.col(cluster).alias("cluster_id"), F.upper(aln).alias("aln")).agg(F.count("*").alias("rows"), F.min(order).alias("ord"))
    bases = m.select("cluster_id", "rows", "ord", F.posexplode(F.split("aln", "")).alias("pos", "base")).where(F.col("base").isin(*"ACGT"))
    votes = bases.groupBy("cluster_id", "pos", "base").agg(F.sum("rows").alias("n"), F.min("ord").alias("first"))
    column = Window.partitionBy("cluster_id", "pos")
    top = (
        votes.withColumn("valid", F.sum("n").over(column))
        .withColumn("place", F.row_number().over(column.orderBy(F.desc("n"), "first")))
        .where((F.col("place") == 1) & (F.col("n") / F.col("valid") >= F.lit(cutoff)))
    )
    built = top.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("cols"))
    sizes = m.groupBy("cluster_id").agg(F.sum("rows").cast("int").alias("n_reference"))
    seq = F.coalesce(F.array_join(F.transform("cols", lambda c: c["base"]), ""), F.lit(""))
    return sizes.join(built, "cluster_id", "left").select(
        "cluster_id", F.concat(F.lit("consensus_c"), F.col("cluster_id").cast("string")).alias("consensus_group"), seq.alias("consensus_seq"), "n_reference"
    )
