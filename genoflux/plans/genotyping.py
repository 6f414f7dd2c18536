"""The whole run: specimens to annotated table, summaries and plot data.

Every stage is lazy; tables that several later stages read (consensus,
distances, diagnostics) are written once to the shared folder.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import sequence
from ..operators import aggregates, align, assign, cluster, consensus, geo, plotdata, progressive, qc, taxonomy, tree
from ..sources import sinks
from .storage import materialize


def dereplicate(sequences: DataFrame, config: Config, aligned: bool = False) -> tuple[DataFrame, DataFrame]:
    """Consensus table and labels (ord, cluster_id) of sequences (processid, nuc, ord)."""
    d = config.dereplication
    valid = sequences.where(sequence.invalid_reason(F.col("nuc"), d.min_sequence_length).isNull())
    rows = valid.select("processid", F.upper(sequence.stripped(F.col("nuc"))).alias("seq"), "ord")
    # Equal sequences are laid out and trimmed once, with the number of their rows.
    kinds = materialize(rows.groupBy("seq").agg(F.min("ord").alias("ord"), F.count("*").alias("n")), "kinds")
    put, trim = {"star": partial(align.star_align, weight="n"), "progressive": progressive.align}[d.align_method], {"gaps": align.trim_columns, "similarity": align.trim_similar}[d.trim_method]
    laid = kinds.withColumn("aln", F.col("seq")) if aligned else trim(put(kinds), weight="n")
    laid = materialize(qc.filter_ungapped(laid, min(d.min_post_trim_length, d.min_sequence_length)), "aligned")
    # Equal aligned sequences are one node; the first stands for all.
    node = laid.groupBy("aln").agg(F.min("ord").alias("node"))
    reps = materialize(node.select(F.col("node").alias("ord"), "aln"), "nodes")
    labels = cluster.cluster_alignment(reps, d.clustering_threshold, d.clustering_method)
    members = laid.join(node, "aln").join(labels.withColumnRenamed("ord", "node"), "node")
    labelled = materialize(rows.join(members.select("seq", "aln", "cluster_id"), "seq").select("processid", "ord", "aln", "cluster_id"), "labels")
    found = qc.filter_relative_length(consensus.consensus(labelled, d.consensus_frequency_cutoff), d.min_consensus_length_ratio)
    return materialize(found.withColumn("ord", F.col("cluster_id").cast("bigint")), "consensus"), labelled


def counted(spark: SparkSession, read: Observation, first: Observation, kept: Observation) -> DataFrame:
    """A1 and the counters of a run, from observations of its first job: no scan of their own."""
    r, n = read.get, first.get["n"]
    row = {
        "n_records": r["n_records"], "n_processids": n, "n_with_sequence": r["n_with_sequence"], "n_without_sequence": r["n_records"] - r["n_with_sequence"], "n_with_coordinates": r["n_with_coordinates"],
        "n_without_coordinates": r["n_records"] - r["n_with_coordinates"], "n_centroids": r["n_centroids"], "n_duplicates": r["n_records"] - n, "n_filtered": n - kept.get["n"], "n_kept": kept.get["n"],
    }
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} bigint" for k in row))


def run(specimens: DataFrame, config: Config | None = None, polygons: DataFrame | None = None, aligned: bool = False, evidence: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables by name. ``specimens``: processid, nuc, ord and whatever else there is.

    ``evidence`` (J5): names found by the sequences of the genotypes (consensus_group, cluster_sp,
    cluster_level, identity_pct, query_cov_pct), which decide the final name and label with the vote.
    """
    config = config or Config()
    given = qc.require_columns(specimens, ["processid", "nuc", "ord"])
    read, unlike, left = Observation(), Observation(), Observation()
    first = qc.keep_first(given.observe(read, *qc.counters(given)), "processid").observe(unlike, F.count("*").alias("n"))
    g = config.geographic
    located = qc.with_coordinates(first)
    kept = materialize(qc.filter_coordinates(located, g.exclude_centroids, g.exclude_zero_coords, g.exclude_missing).observe(left, F.count("*").alias("n")), "specimens")
    counters = counted(specimens.sparkSession, read, unlike, left)
    if polygons is not None and "coord" in kept.columns:
        kept = geo.assign_basins(kept.withColumnsRenamed({"latitude": "lat", "longitude": "lon"}), polygons)
    else:
        kept = kept.withColumnsRenamed({"latitude": "lat", "longitude": "lon"}).withColumn("ocean_basin", F.lit("Unknown"))
    cons, labels = dereplicate(kept, config, aligned)
    a = config.genotype_assignment
    base = materialize(assign.assign(kept, cons, a.min_identity, a.identity_method, a.tie_margin, a.tie_threshold), "diagnostics")
    diagnostics = materialize(assign.renamed_counts(base), "diagnostics")
    # One specimen to one assignment, checked in the plan.
    grouped = kept.join(qc.unique(diagnostics.select("processid", "consensus_group"), "processid", "diagnostics"), "processid")
    voted = taxonomy.labelled(taxonomy.vote(grouped, config.taxonomy.majority_species_threshold))
    if evidence is not None:
        t = config.taxonomy
        known = taxonomy.with_evidence(voted, evidence, min_identity_pct=t.min_identity_pct, min_query_cov_pct=t.min_query_cov_pct, majority_threshold=t.majority_species_threshold)
        known = known.withColumnsRenamed({"final_taxon": "final_group_sp", "final_level": "final_group_level", "provenance": "tax_provenance"})
        voted = known.withColumn("consensus_group_sp", sequence.species_label(F.col("final_group_sp"), F.col("consensus_group")))
    voted = materialize(voted, "taxonomy")
    annotated = taxonomy.joined(grouped, voted)
    annotated = materialize(
        annotated.withColumn("taxonomy_conflict", taxonomy.conflict(F.col("assignment_level"), F.col("species"), F.col("genus"), F.col("assigned_sp"))), "annotated"
    )
    return {
        "counters": counters, "annotated": annotated, "diagnostics": diagnostics, "consensus": cons, "labels": labels, "taxonomy": voted,
        "species_counts": taxonomy.species_counts(taxonomy.normalised(grouped)),
        "assignment_summary": aggregates.assignment_summary(annotated, diagnostics), "characterisation": aggregates.characterisation(annotated, diagnostics),
        "conflicts": aggregates.conflict_report(annotated, diagnostics), "sequence_quality": aggregates.sequence_quality(annotated),
        "basin_counts": geo.basin_counts(annotated, sort_by=None), "basin_summary": geo.basin_summary(annotated), "crosstab": aggregates.crosstab(annotated),
        "basin_abundance": plotdata.basin_abundance(annotated), "color_map": plotdata.color_map(annotated), "distribution_map": plotdata.distribution_document(annotated),
        "bars_relative": plotdata.bar_document(annotated), "bars_total": plotdata.bar_document(annotated, total=True), "bars_faceted": plotdata.bar_document(annotated, facet="assigned_sp"),
        "consensus_metadata": sinks.consensus_metadata(cons), "cluster_stats": aggregates.cluster_stats(cons, diagnostics), "skipped": qc.skip_reasons(kept, config.dereplication.min_sequence_length),
    }


def phylogeny(consensus: DataFrame, taxonomy_table: DataFrame, label: str = "consensus_group_sp") -> dict[str, str]:
    """A distance tree of the consensus sequences and its relabelled form, as Newick texts.

    One tip per genotype: the alignment and the labels of one tree come to the driver.
    """
    rows = align.trim_columns(align.star_align(consensus.select(F.col("consensus_group").alias("processid"), F.col("consensus_seq").alias("seq"), "ord")))
    laid = [(r["processid"], r["aln"]) for r in rows.orderBy("ord").collect()]
    if len(laid) < 2:
        return {}
    labels = {r["consensus_group"]: r[label] for r in taxonomy_table.collect() if r[label]}
    text = tree.write(tree.distance_tree([n for n, _ in laid], cluster.masked_distances([a for _, a in laid])))
    fasta = "".join(f">{labels.get(n, n)}\n{a}\n" for n, a in laid)
    return {"tree": text, "tree_relabeled": tree.relabel_newick(text, labels), "alignment_relabeled": fasta}
