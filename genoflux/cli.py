"""Command line: a whole run, or the statistics of clusters."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from .config import Config, load
from .functions import names


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="genoflux", description="Barcode genotyping on Spark")
    sub = top.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="specimen table to annotated table, summaries and report")
    r.add_argument("input")
    r.add_argument("--output", required=True)
    r.add_argument("--organism")
    r.add_argument("--config")
    r.add_argument("--polygons", help="GeoJSON, Parquet, or a shapefile (with its projection text)")
    r.add_argument("--evidence", help="CSV of names by sequence: consensus_group, cluster_seq_sp, cluster_seq_level, cluster_seq_best_identity, cluster_seq_qcov")
    r.add_argument("--clustering-threshold", type=float)
    r.add_argument("--min-identity", type=float)
    r.add_argument("--tie-margin", type=float)
    r.add_argument("--tie-threshold", type=float)
    r.add_argument("--no-report", action="store_true")
    r.add_argument("--build-tree", action="store_true", help="a distance tree of the genotypes")
    r.add_argument("--aligned", action="store_true", help="sequences are aligned already")
    c = sub.add_parser("cluster-diagnostics", help="assignment and distance statistics of clusters")
    c.add_argument("--consensus", required=True)
    c.add_argument("--metadata", required=True)
    c.add_argument("--diagnostics", required=True)
    c.add_argument("--alignment")
    c.add_argument("--threshold", type=float, default=0.03)
    c.add_argument("--output", required=True)
    return top


def settings(args: argparse.Namespace) -> Config:
    config = load(args.config) if args.config else Config()
    given = {
        "dereplication__clustering_threshold": args.clustering_threshold,
        "genotype_assignment__min_identity": args.min_identity,
        "genotype_assignment__tie_margin": args.tie_margin,
        "genotype_assignment__tie_threshold": args.tie_threshold,
    }
    return config.update(**{k: v for k, v in given.items() if v is not None})


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from .operators import aggregates, cluster, distance, reports
    from .plans.genotyping import run
    from .sources import fasta, sinks, tables

    spark = SparkSession.builder.appName("genoflux").getOrCreate()
    if args.command == "cluster-diagnostics":
        stats = aggregates.cluster_stats(tables.read_consensus(spark, args.consensus, args.metadata).drop("ord"), tables.read_diagnostics(spark, args.diagnostics))
        if args.alignment:
            aln = fasta.read_fasta(spark, args.alignment).select(F.col("header").alias("seq_id"), "ord", F.col("seq").alias("aln"))
            distance.check_alignment(aln)
            pairs = distance.pairwise(aln)
            labels = cluster.clusters(aln, pairs, args.threshold)
            stats = aggregates.cluster_table(stats, aggregates.intra_cluster(labels, pairs))
        sinks.write_csv(stats.orderBy("cluster_id"), args.output, sep="\t")
        return 0
    config = settings(args)
    organism = args.organism or names.organism_of_path(args.input)
    folder = Path(args.output)
    folder.mkdir(parents=True, exist_ok=True)
    sinks.write_parameters({"organism": organism, **config.to_dict()}, str(folder / f"{names.safe_name(organism)}_parameters.json"))
    polygons = tables.read_polygons(spark, args.polygons) if args.polygons else None
    evidence = tables.read_evidence(spark, args.evidence) if args.evidence else None
    found = run(tables.read_specimens(spark, args.input), config, polygons, args.aligned, evidence)
    sinks.write_annotated(found["annotated"], str(folder / "annotated"))
    sinks.write_diagnostics(found["diagnostics"], str(folder / "diagnostics"))
    for name in ("counters", "taxonomy", "species_counts", "assignment_summary", "characterisation", "conflicts", "sequence_quality", "basin_summary", "crosstab", "color_map"):
        sinks.write_csv(found[name], str(folder / name))
    fasta.write_fasta(found["consensus"].withColumnsRenamed({"consensus_group": "header", "consensus_seq": "seq"}), str(folder / "consensus_fasta"), order="ord")
    # With the FASTA of the consensus, what ``cluster-diagnostics`` needs.
    sinks.write_csv(found["consensus_metadata"], str(folder / "consensus_metadata"))
    for name in ("distribution_map", "bars_relative", "bars_total", "bars_faceted"):
        sinks.write_documents(found[name], str(folder / name))
    if args.build_tree:
        from .plans.genotyping import phylogeny

        for name, text in phylogeny(found["consensus"], found["taxonomy"]).items():
            (folder / f"{name}.{'fasta' if name.startswith('alignment') else 'nwk'}").write_text(text.rstrip("\n") + "\n")
    if not args.no_report:
        sinks.html_report(f"{organism}: genotypes", reports.sections(found, config), str(folder / "report.html"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
