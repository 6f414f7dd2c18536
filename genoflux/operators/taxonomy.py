"""Species counts, majority vote, final taxon, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence
from .qc import unique


def normalised(df: DataFrame, species: str = "species", genus: str = "genus") -> DataFrame:
    if species not in df.columns:
        raise ValueError(f"column {species!r} not found")
    g = sequence.normal_species(F.col(genus)) if genus in df.columns else sequence.genus_of(F.col(species))
    return df.withColumns({genus: g, species: sequence.normal_species(F.col(species))})


def species_counts(df: DataFrame, group: str = "consensus_group", species: str = "species") -> DataFrame:
    """A3: counts of (group, species). The null group keeps its rows but has no total and no share."""
    counts = df.groupBy(F.col(group).alias("consensus_group"), F.col(species).alias("reported_species")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("consensus_group"))
    out = counts.withColumn("n_in_group", F.when(F.col("consensus_group").isNotNull(), total))
    return out.withColumn("frac", F.col("n") / F.col("n_in_group"))


def vote(df: DataFrame, threshold: float = 0.5, group: str = "consensus_group", species: str = "species", genus: str = "genus", order: str = "ord") -> DataFrame:
    """A5: per group the majority species, else the most frequent genus.

    Ties of species go to the genus; ties of genera to the one met first by ``order``.
    """
    norm = normalised(df, species, genus).where(F.col(group).isNotNull())
    counts = species_counts(norm, group, species)
    by_group = Window.partitionBy("consensus_group")
    top = (
        counts.withColumn("best", F.max("n").over(by_group))
        .withColumn("ties", F.count_if(F.col("n") == F.col("best")).over(by_group))
        .withColumn("place", F.row_number().over(by_group.orderBy(F.desc("n"), "reported_species")))
        .where("place = 1")
    )
    genera = norm.groupBy(F.col(group).alias("consensus_group"), F.col(genus).alias("g")).agg(F.count("*").alias("gn"), F.min(order).alias("first"))
    genera = genera.withColumn("gp", F.row_number().over(by_group.orderBy(F.desc("gn"), "first", "g"))).where("gp = 1").select("consensus_group", "g")
    wins = (F.col("ties") == 1) & (F.col("frac") > F.lit(threshold)) & (F.col("reported_species") != "")
    g = F.coalesce("g", F.lit(""))
    return top.join(genera, "consensus_group", "left").select(
        "consensus_group",
        F.when(wins, F.col("reported_species")).otherwise(g).alias("assigned_sp"),
        F.when(wins, "species").when(g != "", "genus").otherwise("unassigned").alias("assignment_level"),
        F.when(wins, F.concat(F.lit("majority "), sequence.fixed(F.col("frac"), 2)))
        .when(g != "", "tie or not majority; fell back to genus")
        .otherwise("no genus available")
        .alias("assignment_notes"),
        F.col("frac").alias("majority_fraction"),
    )


def labelled(taxonomy: DataFrame) -> DataFrame:
    """Short and full labels."""
    group = F.col("consensus_group")
    return taxonomy.withColumns({"consensus_group_short": sequence.short_label(group), "consensus_group_sp": sequence.species_label(F.col("assigned_sp"), group)})


def final_taxon(
    cluster_sp: Column, cluster_level: Column, cluster_id: Column, cluster_qcov: Column, majority_sp: Column, majority_level: Column, majority_frac: Column,
    min_identity_pct: float = 98.5, min_query_cov_pct: float = 90.0, majority_threshold: float = 0.70,
) -> Column:
    """struct<taxon, level, provenance> by precedence of evidence."""
    some = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    at_least = lambda c, v: F.coalesce(c, F.lit(0.0)) >= F.lit(v)
    is_ = lambda c, v: F.coalesce(c == v, F.lit(False))
    pick = lambda sp, level, how: F.struct(sp.alias("taxon"), F.lit(level).alias("level"), F.lit(how).alias("provenance"))
    return (
        F.when(is_(cluster_level, "species") & at_least(cluster_id, min_identity_pct) & at_least(cluster_qcov, min_query_cov_pct) & some(cluster_sp), pick(cluster_sp, "species", "cluster_seq"))
        .when(is_(majority_level, "species") & at_least(majority_frac, majority_threshold) & some(majority_sp), pick(majority_sp, "species", "majority_species"))
        .when(is_(cluster_level, "genus") & some(cluster_sp), pick(cluster_sp, "genus", "cluster_genus"))
        .when(is_(majority_level, "genus") & some(majority_sp), pick(majority_sp, "genus", "majority_genus"))
        .otherwise(pick(F.lit(""), "unassigned", "none"))
    )


def with_evidence(voted: DataFrame, evidence: DataFrame, **thresholds: float) -> DataFrame:
    """The vote's table joined with sequence-based names (consensus_group, cluster_sp,
    cluster_level, identity_pct, query_cov_pct): final_taxon, final_level, provenance.

    Repeated groups in ``evidence`` fail the job; groups without evidence keep the vote.
    """
    joined_rows = voted.join(unique(evidence, "consensus_group", "evidence"), "consensus_group", "left")
    final = final_taxon(*map(F.col, ("cluster_sp", "cluster_level", "identity_pct", "query_cov_pct", "assigned_sp", "assignment_level", "majority_fraction")), **thresholds)
    out = joined_rows.withColumn("__f", final)
    return out.withColumns({"final_taxon": F.col("__f.taxon"), "final_level": F.col("__f.level"), "provenance": F.col("__f.provenance")}).drop("__f", *[c for c in evidence.columns if c != "consensus_group"])


def conflict(level: Column, species: Column, genus: Column, assigned_sp: Column) -> Column:
    """The assigned name differs from the reported one at its own level."""
    return F.coalesce(F.when(level == "species", species != assigned_sp).when(level == "genus", genus != assigned_sp), F.lit(False))


def joined(annotated: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Many specimens to one taxonomy row; repeated groups on the right fail the job."""
    return annotated.join(unique(taxonomy, "consensus_group", "taxonomy"), "consensus_group", "left")
