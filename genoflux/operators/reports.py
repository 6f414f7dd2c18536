"""The sections of a run's report and the text on methods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from . import aggregates


def methods_text(config: Config, counts: dict[str, float]) -> str:
    """What was done, with the run's settings and counters (missing ones are left out)."""
    d, a, t = config.dereplication, config.genotype_assignment, config.taxonomy
    said = []
    if counts.get("total_samples") is not None:
        said.append(f"{int(counts['total_samples'])} specimens were read.")
    said.append(
        f"Sequences of at least {d.min_sequence_length} bases were aligned and clustered by {d.clustering_method} linkage at a distance of {d.clustering_threshold};"
        f" a column's base was kept at a share of {d.consensus_frequency_cutoff} or more."
    )
    if counts.get("n_consensus_groups") is not None:
        said.append(f"{int(counts['n_consensus_groups'])} genotypes were assigned to.")
    said.append(f"Specimens were assigned at an identity of {a.min_identity} or more ({a.identity_method}); runners-up within {a.tie_margin} were called ties.")
    said.append(f"A genotype took the species of more than {t.majority_species_threshold} of its specimens, else the most frequent genus.")
    return " ".join(said)


def said_in_log(metrics: dict[str, float | str | None]) -> str:
    """The text on methods from the counters of a run's log; what a log lacks is left out."""
    def n(key: str) -> str | None:
        return None if metrics.get(key) is None else f"{int(metrics[key]):,}"

    parts = [
        ("total_samples_loaded", "{} specimens were read."), ("duplicates_removed", "{} repeated ones were dropped."), ("samples_after_coord_filter", "{} passed the rules on coordinates."),
        ("centroid_coords_excluded", "{} had coordinates of a centroid."), ("valid_sequences", "{} had a valid sequence."), ("sequences_too_short", "{} sequences were too short after trimming."),
        ("pairwise_comparisons", "{} pairs of sequences were compared."), ("consensus_genotypes", "{} genotypes were found."), ("successfully_assigned", "{} specimens were assigned."),
        ("ties_flagged", "{} were ties."), ("low_confidence_flagged", "{} were of low confidence."), ("unassigned_no_sequence", "{} had no sequence."),
        ("unassigned_below_threshold", "{} were below the least identity."), ("ocean_basin_assigned", "{} lie in a basin."), ("unknown_basin", "{} lie in none that is known."),
    ]
    said = [text.format(n(key)) for key, text in parts if n(key) is not None]
    said += [f"{tool} ran with {metrics[key]}." for key, tool in (("mafft_params", "The aligner"), ("trimal_params", "The trimmer"), ("fasttree_params", "The tree builder")) if metrics.get(key)]
    return " ".join(said)


def parameters(config: Config) -> str:
    """The settings of a run."""
    return "; ".join(f"{part}.{key} = {value}" for part, inner in config.to_dict().items() for key, value in inner.items())


def parameter_rows(spark: SparkSession, config: Config) -> DataFrame:
    """The settings that decide most, one row each: place, parameter, value, as_identity (per cent), meaning."""
    d, a = config.dereplication, config.genotype_assignment
    rows = [
        ("Clustering threshold", d.clustering_threshold, (1 - d.clustering_threshold) * 100, "Sequences within this distance may form one genotype; a smaller one gives more genotypes."),
        ("Similarity threshold", a.min_identity, a.min_identity * 100, "Specimens whose best genotype is less alike than this stay unassigned."),
        ("Tie margin", a.tie_margin, a.tie_margin * 100, "If the runner-up is nearer to the best than this, the specimen is a tie to be looked at."),
        ("Tie threshold", a.tie_threshold, a.tie_threshold * 100, "Ties are sought only where the best genotype is at least so alike."),
    ]
    return spark.createDataFrame([(k + 1, *r) for k, r in enumerate(rows)], "place int, parameter string, value double, as_identity double, meaning string")


def _rows(one: DataFrame, entries: list[tuple[str, Column, Column]], names: tuple[str, str, str]) -> DataFrame:
    """A row of counters as a table: place, a title, a value, a share."""
    each = F.array(*[F.struct(F.lit(k + 1).alias("place"), F.lit(t).alias(names[0]), v.cast("double").alias(names[1]), p.cast("double").alias(names[2])) for k, (t, v, p) in enumerate(entries)])
    return one.select(F.explode(each).alias("r")).select("r.*")


def summary_cards(annotated: DataFrame, summary: DataFrame) -> DataFrame:
    """The cards on top of a report: place, title, value, share (per cent; null where none belongs)."""
    one = summary.join(annotated.agg(F.count_distinct("ocean_basin").alias("n_basins")))
    c, none = F.col, F.lit(None)
    known = F.when(c("total_samples") > 0, c("samples_with_sequence") / c("total_samples") * 100).otherwise(F.lit(0.0))
    cards = [
        ("Samples", c("total_samples"), none), ("With sequence", c("samples_with_sequence"), known), ("Genotypes", c("n_consensus_groups"), none), ("Species", c("n_species_identified"), none),
        ("Assigned", c("n_assigned"), c("pct_assigned")), ("Mean identity, per cent", c("mean_identity_assigned") * 100, none), ("Basins", c("n_basins"), none),
        ("Conflicts of names", c("n_taxonomy_conflicts"), c("pct_taxonomy_conflicts")),
    ]
    # Without a conflict there is no card of conflicts.
    return _rows(one, cards, ("title", "value", "share")).where("title <> 'Conflicts of names' OR value > 0")


def status_rows(summary: DataFrame) -> DataFrame:
    """How many specimens have each status, in the order of the report: place, status, n, share."""
    return _rows(summary, [(s, F.col(f"n_{s}"), F.col(f"pct_{s}")) for s in aggregates.STATUSES], ("status", "n", "share"))


def identity_rows(summary: DataFrame) -> DataFrame:
    """Identities of the assigned in per cent: place, metric, identity."""
    none = F.lit(None)
    entries = [(k, F.col(f"{k}_identity_assigned") * 100, none) for k in ("mean", "median", "min", "max")]
    return _rows(summary, entries, ("metric", "identity", "__none")).drop("__none")


def geography(annotated: DataFrame) -> DataFrame:
    """One row: samples with and without a known basin, without coordinates, and their shares."""
    known = F.coalesce("ocean_basin", F.lit("Unknown")) != "Unknown"
    share = lambda n: F.when(F.col("total") > 0, F.col(n) / F.col("total") * 100).otherwise(F.lit(0.0)).alias(f"pct_{n[2:]}")
    one = annotated.agg(F.count("*").alias("total"), F.count_if(known).alias("n_placed"), F.count_if(~known).alias("n_unknown"), F.count_if(F.col("lat").isNull() | F.col("lon").isNull()).alias("n_missing"))
    return one.select("*", *[share(n) for n in ("n_placed", "n_unknown", "n_missing")])


def sections(tables: dict[str, DataFrame], config: Config) -> dict[str, DataFrame | str]:
    """Section titles with a table or a text, for ``sinks.html_report``."""
    ann, diag = tables["annotated"], tables["diagnostics"]
    summary = tables["assignment_summary"]
    row = summary.first().asDict()
    rounded = lambda df: df.select(*[F.round(c, 3).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])
    plain = lambda df: rounded(df.orderBy("place")).drop("place")
    return {
        "Summary": plain(summary_cards(ann, summary)),
        "Records read": tables["counters"],
        "Assignment": plain(status_rows(summary)),
        "Identity of the assigned": plain(identity_rows(summary)),
        "Identity by status": rounded(aggregates.identity_by_status(diag)),
        "Taxonomy": tables["taxonomy"].orderBy("consensus_group"),
        "Species of genotypes": tables["species_counts"].where("consensus_group IS NOT NULL").orderBy("consensus_group", F.desc("n"), "reported_species"),
        "Conflicts": tables["conflicts"].orderBy(F.desc("identity_to_assigned_group"), "processid"),
        "Genotypes": tables["characterisation"].orderBy(F.desc("n_samples"), "consensus_group"),
        "Geography": rounded(geography(ann)),
        "Basins": aggregates.basin_distribution(ann).withColumn("pct", F.round("pct", 1)).orderBy(F.desc("n")),
        "Genotypes and basins": aggregates.crosstab(ann, include_unknown=False).orderBy(F.desc("row_total"), F.desc("column_total"), "genotype", "basin"),
        "Sequence quality": tables["sequence_quality"],
        "Parameters": plain(parameter_rows(ann.sparkSession, config)),
        "All settings": parameters(config),
        "Methods": methods_text(config, row),
    }
