"""Summaries over annotated specimens and diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence

STATUSES = ("assigned", "tie", "low_confidence", "below_threshold", "no_sequence")


def with_diagnostics(annotated: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """annotated's own group stays; all of diagnostics' other columns join by process id."""
    return annotated.join(diagnostics.drop("consensus_group"), "processid", "left")


def _status(name: str) -> Column:
    return F.count_if(F.col("status") == name)


def composition(df: DataFrame, by: str = "consensus_group", of: str = "species") -> DataFrame:
    """'species: n (p%)', most frequent first (ties by name), null species left out of the list."""
    counts = df.groupBy(by, of).agg(F.count("*").alias("n"))
    sized = counts.withColumn("total", F.sum("n").over(Window.partitionBy(by))).where(F.col(of).isNotNull())
    text = F.concat(of, F.lit(": "), F.col("n").cast("string"), F.lit(" ("), sequence.fixed(F.col("n") / F.col("total") * 100, 1), F.lit("%)"))
    listed = sized.groupBy(by).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(of).alias("s"), text.alias("t")))).alias("l"))
    return listed.select(by, F.array_join(F.transform("l", lambda x: x["t"]), ", ").alias("composition"))


def assignment_summary(annotated: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """One row. Empty assigned names do not count as names."""
    good = F.when(F.col("status") == "assigned", F.col("identity"))
    total = F.count("*")
    diag = diagnostics.agg(
        total.alias("total_samples"), F.count_if(F.col("status") != "no_sequence").alias("samples_with_sequence"),
        *[_status(s).alias(f"n_{s}") for s in STATUSES], *[(_status(s) / total * 100).alias(f"pct_{s}") for s in STATUSES],
        F.avg(good).alias("mean_identity_assigned"), F.median(good).alias("median_identity_assigned"), F.min(good).alias("min_identity_assigned"), F.max(good).alias("max_identity_assigned"),
    )
    name = F.nullif("assigned_sp", F.lit(""))
    flag = F.count_if("taxonomy_conflict") if "taxonomy_conflict" in annotated.columns else F.lit(0)
    ann = annotated.agg(
        F.count_distinct("consensus_group").alias("n_consensus_groups"), F.count_distinct(name).alias("n_species_identified"), flag.alias("n_taxonomy_conflicts"),
        F.when(F.count(name) > 0, flag / F.count(name) * 100).otherwise(F.lit(0.0)).alias("pct_taxonomy_conflicts"),
    )
    return diag.join(F.broadcast(ann))  # one row each


def _mode(df: DataFrame, by: str, of: str) -> DataFrame:
    """The most frequent value (the smallest of several), null values aside."""
    n = df.where(F.col(of).isNotNull()).groupBy(by, of).agg(F.count("*").alias("n"))
    return n.groupBy(by).agg(F.min_by(of, F.struct((-F.col("n")).alias("k"), F.col(of))).alias(of))


def characterisation(annotated: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """A10: one row per group of its assigned specimens."""
    merged = with_diagnostics(annotated, diagnostics).where((F.col("status") == "assigned") & F.col("consensus_group").isNotNull())
    name = F.nullif("assigned_sp", F.lit(""))
    rows = merged.withColumn("assigned_sp", name)
    stats = rows.groupBy("consensus_group").agg(
        F.count("*").alias("n_samples"), F.avg("identity").alias("mean_identity"), F.min("identity").alias("min_identity"), F.max("identity").alias("max_identity"),
        F.array_sort(F.collect_set("ocean_basin")).alias("basins"),
    )
    return (
        stats.join(_mode(rows, "consensus_group", "assigned_sp"), "consensus_group", "left")
        .join(_mode(rows, "consensus_group", "assignment_notes"), "consensus_group", "left")
        .join(composition(rows), "consensus_group", "left")
        .select(
            "consensus_group", F.coalesce("assigned_sp", F.lit("Unknown")).alias("assigned_sp"), F.coalesce("assignment_notes", F.lit("")).alias("assignment_confidence"),
            "n_samples", "mean_identity", "min_identity", "max_identity", F.coalesce("composition", F.lit("")).alias("reported_species_composition"),
            F.array_join("basins", ", ").alias("geographic_range"), F.size("basins").alias("n_ocean_basins"),
        )
    )


def conflict_report(annotated: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Specimens whose reported name differs from the assigned one, with the evidence."""
    merged = with_diagnostics(annotated, diagnostics)
    sizes = merged.where("consensus_group IS NOT NULL").groupBy("consensus_group").agg(F.count("processid").alias("n_samples_in_assigned_group"))
    rows = merged.where(F.col("taxonomy_conflict") & F.nullif("assigned_sp", F.lit("")).isNotNull())
    rows = rows.join(sizes, "consensus_group", "left").join(composition(merged), "consensus_group", "left")
    delta = F.col("identity") - F.col("runner_up_identity")
    said = F.concat_ws(
        "; ",
        F.concat(F.lit("Genetic identity to assigned group: "), sequence.fixed(F.col("identity"), 3)),
        F.concat(F.lit("Group contains "), F.col("n_samples_in_assigned_group").cast("string"), F.lit(" samples")),
        F.when(delta > 0.01, F.concat(F.lit("Identity "), sequence.fixed(delta, 3), F.lit(" higher than runner-up"))),
        F.when(F.col("status") == "assigned", "High-confidence assignment")
        .when(F.col("status") == "low_confidence", "Low-confidence assignment - verify manually")
        .when(F.col("status") == "tie", "Tied assignment - verify manually"),
    )
    return rows.select(
        "processid", F.col("species").alias("reported_species"), "assigned_sp", "consensus_group", F.col("identity").alias("identity_to_assigned_group"),
        "n_samples_in_assigned_group", F.col("composition").alias("species_composition_of_assigned_group"), "runner_up_group", "runner_up_identity",
        delta.alias("delta_identity"), F.col("status").alias("assignment_status"), said.alias("evidence_summary"),
    )


def sequence_quality(df: DataFrame, nuc: str = "nuc") -> DataFrame:
    """(metric, value) in one pass; shares are of the whole length."""
    s, n = F.upper(nuc), F.length(nuc)
    share = lambda letters: sequence.count_of(s, letters) / n * 100
    ns = sequence.count_of(s, "N")
    have = F.count(nuc)
    metrics: dict[str, Column] = {"total_sequences": F.count("*"), "sequences_with_data": have, "sequences_missing": F.count("*") - have}
    metrics |= {f"{k}_seq_length": f(n) for k, f in (("mean", F.avg), ("median", F.median), ("min", F.min), ("max", F.max), ("std", F.stddev_samp))}
    for name, test in (("seq_below_500bp", n < 500), ("seq_below_600bp", n < 600), ("seq_above_650bp", n > 650), ("seq_with_Ns", ns > 0), ("seq_over_5pct_Ns", share("N") > 5), ("seq_over_1pct_Ns", share("N") > 1)):
        metrics |= {f"n_{name}": F.count_if(test), f"pct_{name}": F.count_if(test) / have * 100}
    metrics |= {"mean_n_count": F.avg(ns), "median_n_count": F.median(ns), "max_n_count": F.max(ns)}
    metrics |= {f"mean_pct_{b}": F.avg(share(b)) for b in "ATGC"}
    metrics |= {f"{k}_gc_content": f(share("GC")) for k, f in (("mean", F.avg), ("median", F.median), ("min", F.min), ("max", F.max))}
    wide = df.agg(*[c.cast("double").alias(k) for k, c in metrics.items()])
    return wide.unpivot([], list(metrics), "metric", "value")


def basin_assignment(df: DataFrame) -> DataFrame:
    """Per basin ('Unknown' for null) all and assigned specimens and the rate."""
    total, assigned = F.count("*"), F.count("consensus_group")
    return df.groupBy(F.coalesce("ocean_basin", F.lit("Unknown")).alias("ocean_basin")).agg(total.alias("total"), assigned.alias("assigned"), (assigned / total).alias("assigned_rate"))


def crosstab(df: DataFrame, include_unknown: bool = True, row: str = "consensus_group", column: str = "ocean_basin") -> DataFrame:
    """A17 in long form with both totals, from which rows and columns are ordered."""
    d = df.select(F.coalesce(row, F.lit("Unassigned")).alias("genotype"), F.coalesce(column, F.lit("Unknown")).alias("basin"))
    if not include_unknown:
        d = d.where("basin <> 'Unknown'")
    n = d.groupBy("genotype", "basin").agg(F.count("*").alias("n"))
    return n.withColumn("row_total", F.sum("n").over(Window.partitionBy("genotype"))).withColumn("column_total", F.sum("n").over(Window.partitionBy("basin")))


def crosstab_wide(long: DataFrame, basins: list[str]) -> DataFrame:
    return long.groupBy("genotype").pivot("basin", basins).sum("n").fillna(0)


def basin_distribution(df: DataFrame) -> DataFrame:
    """Count and share of the known basins."""
    n = df.where("ocean_basin IS NOT NULL AND ocean_basin <> 'Unknown'").groupBy("ocean_basin").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total)).select("ocean_basin", "n", (F.col("n") / F.col("total") * 100).alias("pct"))


def missing_geography(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(F.col("lat").isNull() | F.col("lon").isNull()).alias("missing"))


def cluster_stats(consensus: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """One row per consensus, also where no specimen was considered."""
    base = diagnostics.withColumn("base", sequence.base_group(F.col("consensus_group"))).where("base IS NOT NULL")
    stats = base.groupBy("base").agg(
        *[_status(s).alias(f"n_{s}") for s in STATUSES], F.count("*").alias("n_samples_considered"),
        F.min("identity").alias("identity_min"), F.avg("identity").alias("identity_mean"), F.median("identity").alias("identity_median"), F.max("identity").alias("identity_max"),
    )
    names = _mode(base, "base", "consensus_group")
    joined = consensus.withColumnRenamed("consensus_group", "base").join(stats, "base", "left").join(names, "base", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return joined.select(
        F.coalesce("consensus_group", "base").alias("consensus_group"), "cluster_id", "n_reference", zero("n_assigned").alias("n_assigned"),
        F.greatest(F.col("n_reference") - zero("n_assigned"), F.lit(0)).cast("bigint").alias("n_cluster_members_fail"),
        *[zero(f"n_{s}").alias(f"n_{s}") for s in STATUSES[1:]], zero("n_samples_considered").alias("n_samples_considered"),
        F.length("consensus_seq").alias("consensus_length"), "identity_min", "identity_mean", "identity_median", "identity_max",
    )


def cluster_table(stats: DataFrame, intra: DataFrame) -> DataFrame:
    """The statistics of clusters with those of the distances inside, where there are any."""
    return stats.join(intra, "cluster_id", "left")


def intra_cluster(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """Labels (ord, cluster_id), pairs (i, j, dist); singletons have null statistics."""
    a = labels.withColumnsRenamed({"ord": "i", "cluster_id": "ci"})
    b = labels.withColumnsRenamed({"ord": "j", "cluster_id": "cj"})
    inside = pairs.join(a, "i").join(b, "j").where("ci = cj").withColumnRenamed("ci", "cluster_id")
    stats = inside.groupBy("cluster_id").agg(
        F.min("dist").alias("intra_min"), F.avg("dist").alias("intra_mean"), F.median("dist").alias("intra_median"), F.max("dist").alias("intra_max"), F.percentile("dist", F.lit(0.95)).alias("intra_p95")
    )
    return labels.groupBy("cluster_id").agg(F.count("*").alias("cluster_size")).join(stats, "cluster_id", "left")


def identity_histogram(diagnostics: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins between the least and the greatest positive identity."""
    d = diagnostics.where("identity > 0").select("identity")
    span = d.agg(F.min("identity").alias("lo"), F.max("identity").alias("hi"))
    place = F.floor((F.col("identity") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    b = F.when(F.col("hi") > F.col("lo"), F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    return d.join(F.broadcast(span)).groupBy(b.alias("bin"), "lo", "hi").agg(F.count("*").alias("n"))


def identity_by_status(diagnostics: DataFrame) -> DataFrame:
    q = lambda p: F.percentile("identity", F.lit(p))
    return diagnostics.where("identity > 0").groupBy("status").agg(
        F.count("*").alias("n"), F.min("identity").alias("min"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"), F.max("identity").alias("max"), F.avg("identity").alias("mean")
    )


def status_counts(diagnostics: DataFrame) -> DataFrame:
    return diagnostics.groupBy("status").agg(F.count("*").alias("n"))
