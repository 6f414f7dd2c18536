"""Registered queries of sources, sinks and products: written, read back, held against SQL.

Files go to the folder that driver and executors share, so every query runs on a cluster too.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, projection
from ..operators import aggregates, cluster, distance, geo, plotdata, qc, reports, taxonomy, tree
from ..sources import fasta, shapefile, sinks, tables
from . import fixtures as fx
from .queries import ANNOT, CONS, DIAG, LOCATED, ORACLE_SQL, QUERIES, SPEC, annotated, diagnostics, located, query
from .storage import shared_dir


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}/{name}"


@query("s01_specimen_scan", f"WITH {SPEC} SELECT processid, nuc, coord, species, country_ocean FROM spec")
def _(spark, d):
    path = _path(spark, "specimens.tsv")
    given = fx.specimens(spark, d).select("processid", "nuc", "coord", F.concat(F.lit(" "), "species").alias("species"), F.col("country_ocean").alias("country/ocean"))
    sinks.write_csv(given, path, sep="\t")
    return tables.read_specimens(spark, path).select("processid", "nuc", "coord", "species", "country_ocean")


@query("s02_missing_columns", "SELECT 'nuc' AS missing FROM (SELECT count(*) AS n FROM documents) x")
def _(spark, d):
    """The columns that a table lacks, as the error names them."""
    try:
        qc.require_columns(fx.specimens(spark, d).drop("nuc"), ["processid", "nuc"])
    except ValueError as e:
        return spark.createDataFrame([(str(e).partition(": ")[2],)], "missing string")
    return spark.createDataFrame([], "missing string")


@query("s03_header_check", "SELECT true AS whole, false AS lacking, false AS absent, count(*) AS n FROM documents")
def _(spark, d):
    path = _path(spark, "specimens.tsv")
    s = fx.specimens(spark, d).select("processid", "nuc")
    sinks.write_csv(s, path, sep="\t")
    flags = [tables.header_ok(spark, path), tables.header_ok(spark, path, ("processid", "other")), tables.header_ok(spark, path + "-none")]
    return s.agg(*[F.lit(v).alias(k) for k, v in zip(("whole", "lacking", "absent"), flags, strict=True)], F.count("*").alias("n"))


def _sequences(spark, d) -> DataFrame:
    return fx.specimens(spark, d).where("nuc IS NOT NULL").select(F.col("processid").alias("header"), F.lower("nuc").alias("seq"), "ord")


_FASTA = f"WITH {SPEC} SELECT processid AS header, nuc AS seq FROM spec WHERE nuc IS NOT NULL"


@query("s04_fasta_scan", _FASTA)
def _(spark, d):
    path = _path(spark, "sequences")
    fasta.write_fasta(_sequences(spark, d).repartition(5), path)
    return fasta.read_fasta(spark, path).select("header", "seq")


@query("s04_fasta_source", _FASTA)
def _(spark, d):
    path = _path(spark, "sequences")
    fasta.write_fasta(_sequences(spark, d), path, order="ord", width=0)
    fasta.register(spark)
    return spark.read.format("fasta").option("path", path).option("rangeBytes", 5000).load().select("header", "seq")


@query("s05_fasta_valid", "SELECT true AS whole, false AS with_empty, false AS none, count(*) AS n FROM documents WHERE doc_id % 17 <> 0")
def _(spark, d):
    s = _sequences(spark, d)
    paths = [_path(spark, "sequences") for _ in range(3)]
    fasta.write_fasta(s, paths[0])
    fasta.write_fasta(s.withColumn("seq", F.when(F.col("ord") % 2 == 0, F.lit("")).otherwise(F.col("seq"))), paths[1])
    s.select(F.lit("no record").alias("value")).write.text(paths[2])
    flags = [fasta.valid_fasta(spark, p) for p in paths]
    return s.agg(*[F.lit(v).alias(k) for k, v in zip(("whole", "with_empty", "none"), flags, strict=True)], F.count("*").alias("n"))


@query("s06_consensus_scan", f"WITH {CONS} SELECT consensus_group, consensus_seq, cluster_id::BIGINT AS cluster_id, n_reference::BIGINT AS n_reference FROM cons")
def _(spark, d):
    c = fx.consensus(spark, d)
    records, meta = _path(spark, "consensus"), _path(spark, "consensus_metadata")
    fasta.write_fasta(c.select(F.col("consensus_group").alias("header"), F.col("consensus_seq").alias("seq"), "ord"), records, order="ord")
    sinks.write_csv(c.select("consensus_group", "cluster_id", "n_reference"), meta)
    return tables.read_consensus(spark, records, meta).select("consensus_group", "consensus_seq", F.col("cluster_id").cast("bigint"), F.col("n_reference").cast("bigint"))


@query("s07_diagnostics_scan", f"WITH {DIAG} SELECT processid, coalesce(consensus_group, '') AS consensus_group, round_even(identity, 6) AS identity, status FROM diag")
def _(spark, d):
    path = _path(spark, "diagnostics.csv")
    sinks.write_diagnostics(diagnostics(spark, d).select("processid", "consensus_group", "identity", "status"), path)
    return tables.read_diagnostics(spark, path).select("processid", "consensus_group", "identity", "status")


_BANDS = f"WITH vert AS ({fx.VERTICES}) SELECT r_name AS basin_name, poly_ord::BIGINT AS poly_ord, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax, count(*)::BIGINT AS vertices FROM vert JOIN region ON r_regionkey = poly_ord GROUP BY r_name, poly_ord"


def _bounds(df: DataFrame) -> DataFrame:
    return df.select("basin_name", F.col("poly_ord").cast("bigint"), "xmin", "ymin", "xmax", "ymax", F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r)).cast("bigint").alias("vertices"))


@query("s08_polygon_scan", _BANDS)
def _(spark, d):
    """The jagged bands as GeoJSON and back; a file closes its rings, so their first vertex stands twice in it."""
    point = lambda v: F.array(v["x"], v["y"])
    rings = F.transform("rings", lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), point))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("basin_name").alias("area_name")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")).alias("geometry"))
    # One file has all features, as the format has it: a row for each region.
    whole = fx.coasts(spark, d).agg(F.transform(F.array_sort(F.collect_list(F.struct("poly_ord", feature.alias("f")))), lambda x: x["f"]).alias("features"))
    path = _path(spark, "basins.geojson")
    whole.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.text(path)
    read = tables.read_polygons(spark, path)
    return _bounds(read.withColumn("rings", F.transform("rings", lambda r: F.slice(r, F.lit(1), F.size(r) - 1))))


@query("s09_land_polygons", _BANDS)
def _(spark, d):
    """The same as a table of polygons."""
    path = _path(spark, "land")
    fx.coasts(spark, d).select("basin_name", "poly_ord", "rings").write.parquet(path)
    return _bounds(tables.read_polygons(spark, path))


@query(
    "s13_log_metrics",
    """SELECT count(*)::DOUBLE AS total_samples_loaded, count(DISTINCT lang)::DOUBLE AS consensus_genotypes, count(DISTINCT source)::DOUBLE AS successfully_assigned, 87.5e0 AS assignment_rate,
    count(*)::DOUBLE AS samples_for_assignment, NULL::DOUBLE AS ties_flagged, 'in.tsv' AS input_file, '--auto --thread 4' AS mafft_params, 90::BIGINT AS seconds FROM documents""",
)
def _(spark, d):
    """A log of two runs, with counts of the table; the second counts."""
    path = _path(spark, "run.log")
    counts = fx.documents(spark, d).agg(F.count("*").alias("n"), F.count_distinct("lang").alias("g"), F.count_distinct("source").alias("a"))
    at = lambda t, text: F.lit(f"[2024-01-01 10:{t}] {text}")
    said = F.concat_ws(
        "\n", at("00:00", "Logging to file: a"), F.lit("===="), F.lit("Pipeline - first"), F.lit("  - Ties (ambiguous): 3"), F.lit("Identified 2 unique genotypes"),
        at("02:00", "Logging to file: b"), F.lit("===="), F.lit("Pipeline - second"), F.lit("Input TSV: in.tsv "), F.format_string("Read %d rows and 9 columns", "n"), F.lit("Total samples: 1"),
        F.lit("Running MAFFT alignment: mafft --auto --thread 4 /tmp/x.fasta"), F.format_string("Identified %d unique genotypes", "g"),
        F.lit("Genotype assignment summary"), F.format_string("Total samples: %d", "n"), F.format_string("Successfully assigned: %d (87.5%%)", "a"), at("03:30", "Pipeline completed successfully"),
    )
    counts.select(said.alias("value")).write.text(path)
    names_of = ["total_samples_loaded", "consensus_genotypes", "successfully_assigned", "assignment_rate", "samples_for_assignment", "ties_flagged", "input_file", "mafft_params", "seconds"]
    return tables.log_metrics(spark, path).select(*names_of)


@query("w01_annotated_csv", f"WITH {SPEC} SELECT processid, coalesce(species, '') AS species, coalesce(coord, '') AS coord FROM spec")
def _(spark, d):
    """Every field quoted, so that texts with commas come back whole."""
    path = _path(spark, "annotated")
    sinks.write_annotated(fx.specimens(spark, d).select("processid", "species", "coord"), path)
    return spark.read.csv(path, header=True, escape='"').select("processid", F.coalesce("species", F.lit("")).alias("species"), F.coalesce("coord", F.lit("")).alias("coord"))


@query("w02_fasta_lines", f"WITH {SPEC} SELECT concat('>', processid, chr(10), CASE WHEN length(nuc) > 80 THEN concat(substr(nuc, 1, 80), chr(10), substr(nuc, 81)) ELSE nuc END) AS value FROM spec WHERE nuc IS NOT NULL")
def _(spark, d):
    return fasta.fasta_lines(fx.specimens(spark, d).where("nuc IS NOT NULL"), header="processid", seq="nuc")


@query("w03_rounded_diagnostics", f"WITH {DIAG} SELECT processid, round_even(target_identity, 6) AS target_identity, round_even(classic_identity, 6) AS classic_identity FROM diag")
def _(spark, d):
    return sinks.rounded(diagnostics(spark, d).select("processid", "target_identity", "classic_identity"))


@query("w04_consensus_metadata", f"WITH {CONS} SELECT consensus_group, cluster_id::BIGINT AS cluster_id, n_reference::BIGINT AS n_reference FROM cons")
def _(spark, d):
    """The sidecar of the consensus, as statistics of clusters read it."""
    path = _path(spark, "consensus_metadata")
    sinks.write_csv(sinks.consensus_metadata(fx.consensus(spark, d)), path)
    return spark.read.csv(path, header=True).select("consensus_group", F.col("cluster_id").cast("bigint"), F.col("n_reference").cast("bigint"))


@query("w10_aligned_fasta", f"WITH {SPEC} SELECT processid AS header, aln AS seq FROM spec WHERE aln IS NOT NULL")
def _(spark, d):
    """Gaps and unknown bases come back as they were."""
    path = _path(spark, "alignment")
    fasta.write_fasta(fx.specimens(spark, d).where("aln IS NOT NULL").select(F.col("processid").alias("header"), F.col("aln").alias("seq"), "ord"), path, order="ord")
    return fasta.read_fasta(spark, path).select("header", "seq")


@query("j10_cluster_table", f"SELECT a.*, cluster_size, intra_min, intra_mean, intra_median, intra_max, intra_p95 FROM ({ORACLE_SQL['a20_cluster_stats']}) a LEFT JOIN ({ORACLE_SQL['a21_intra_cluster']}) b USING (cluster_id)")
def _(spark, d):
    return aggregates.cluster_table(QUERIES["a20_cluster_stats"](spark, d), QUERIES["a21_intra_cluster"](spark, d))


@query(
    "v01_map_points",
    f"""WITH {ANNOT}, n AS (SELECT lat, lon, consensus_group AS genotype, coalesce(ocean_basin, 'Unknown') AS basin, count(*) AS n FROM ann WHERE lat IS NOT NULL AND lon IS NOT NULL AND consensus_group IS NOT NULL GROUP BY ALL), s AS (SELECT min(n) AS lo, max(n) AS hi FROM n)
    SELECT genotype, (sum(n) OVER (PARTITION BY genotype))::BIGINT AS sample_count, lat, lon, basin, n, CASE WHEN hi > 1 AND hi > lo THEN 50e0 + (n - lo)::DOUBLE / (hi - lo) * 450e0 ELSE 50e0 END AS size FROM n, s""",
)
def _(spark, d):
    """The points of the map's documents."""
    point = "array<struct<lat:double,lon:double,size:double,basin:string,n:bigint>>"
    rows = plotdata.distribution_document(annotated(spark, d)[0])
    return rows.select("genotype", "sample_count", F.inline(F.from_json("points", point)))


@query("v09_dendrogram")
def _(spark, d):
    """Merges of the families' first aligned sequences by average linkage."""
    heads = fx.specimens(spark, d).groupBy("fam").agg(F.min("ord").alias("ord"), F.min_by("aln", "ord").alias("aln"))
    return cluster.dendrogram(heads.select(F.concat(F.lit("f"), "fam").alias("name"), "ord", "aln"))


@query("w06_documents", f"WITH {SPEC} SELECT source AS genus, count(*) AS n FROM (SELECT genus AS source FROM spec) x GROUP BY 1")
def _(spark, d):
    path = _path(spark, "documents")
    sinks.write_documents(fx.specimens(spark, d).groupBy("genus").agg(F.count("*").alias("n")), path)
    return spark.read.schema("genus string, n bigint").json(path)


_BAR = f"""{ANNOT}, b AS (SELECT ocean_basin AS basin, coalesce(consensus_group_sp, 'Unassigned') AS genotype, ord FROM ann WHERE ocean_basin <> 'Unknown'),
 r AS (SELECT genotype, count(*) AS total, row_number() OVER (ORDER BY count(*) DESC, min(ord)) AS rank FROM b GROUP BY 1)"""


@query("v03_bar_document", f"WITH {_BAR} SELECT genotype, basin, count(*) AS n, any_value(total) AS sample_count, any_value(rank)::BIGINT AS rank, 'total_abundance' AS plot_type FROM b JOIN r USING (genotype) GROUP BY 1, 2")
def _(spark, d):
    rows = plotdata.bar_document(annotated(spark, d)[0], total=True)
    return rows.select("genotype", F.explode("counts").alias("basin", "n"), "sample_count", F.col("rank").cast("bigint").alias("rank"), "plot_type")


@query("v05_faceted_document", f"WITH {ANNOT}, b AS (SELECT assigned_sp AS facet, ocean_basin AS basin, coalesce(consensus_group_sp, 'Unassigned') AS genotype FROM ann WHERE ocean_basin <> 'Unknown' AND assigned_sp IS NOT NULL) SELECT facet, genotype, basin, count(*) AS n, sum(count(*)) OVER (PARTITION BY facet, genotype)::BIGINT AS sample_count FROM b GROUP BY 1, 2, 3")
def _(spark, d):
    rows = plotdata.bar_document(annotated(spark, d)[0], facet="assigned_sp")
    return rows.select("facet", "genotype", F.explode("counts").alias("basin", "n"), "sample_count")


@query("v04_faceted_points", f"WITH {ANNOT} SELECT assigned_sp AS facet, lat, lon, consensus_group AS genotype, count(*) AS n FROM ann WHERE assigned_sp IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND consensus_group IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return plotdata.faceted_points(annotated(spark, d)[0])


_EVIDENCE = "SELECT consensus_group, concat('Seq ', cluster_id) AS cluster_sp, CASE WHEN cluster_id % 3 = 0 THEN 'genus' ELSE 'species' END AS cluster_level, 97.0e0 + cluster_id AS identity_pct, 95.0e0 AS query_cov_pct FROM cons WHERE cluster_id <= 4"


@query(
    "j05_final_taxa",
    f"""WITH {ANNOT}, ev AS ({_EVIDENCE}), t AS (SELECT DISTINCT consensus_group, assigned_sp, assignment_level, majority_fraction FROM ann WHERE consensus_group IS NOT NULL),
    j AS (SELECT t.*, cluster_sp, cluster_level, identity_pct, query_cov_pct,
      CASE WHEN cluster_level = 'species' AND identity_pct >= 98.5e0 AND query_cov_pct >= 90 AND trim(cluster_sp) <> '' THEN 'cluster_seq'
           WHEN assignment_level = 'species' AND coalesce(majority_fraction, 0) >= 0.7e0 AND trim(assigned_sp) <> '' THEN 'majority_species'
           WHEN cluster_level = 'genus' AND trim(cluster_sp) <> '' THEN 'cluster_genus'
           WHEN assignment_level = 'genus' AND trim(assigned_sp) <> '' THEN 'majority_genus' ELSE 'none' END AS provenance FROM t LEFT JOIN ev USING (consensus_group))
    SELECT consensus_group, CASE WHEN provenance LIKE 'cluster%' THEN cluster_sp WHEN provenance LIKE 'majority%' THEN assigned_sp ELSE '' END AS final_taxon, provenance FROM j""",
)
def _(spark, d):
    voted = annotated(spark, d)[0].where("consensus_group IS NOT NULL").select("consensus_group", "assigned_sp", "assignment_level", "majority_fraction").distinct()
    evidence = spark.sql(_EVIDENCE.replace("FROM cons", "FROM {cons}"), cons=fx.consensus(spark, d))
    return taxonomy.with_evidence(voted, evidence).select("consensus_group", "final_taxon", "provenance")


@query("j14_with_outgroup", f"WITH {CONS} SELECT consensus_group, ord::BIGINT AS ord, (row_number() OVER (ORDER BY cluster_id > 6, ord))::BIGINT AS place FROM cons")
def _(spark, d):
    c = fx.consensus(spark, d).select("consensus_group", F.col("ord").cast("bigint").alias("ord"), "cluster_id")
    rows = tree.with_outgroup(c.where("cluster_id <= 6"), c.where("cluster_id > 6"))
    # The order of the result, as rows.
    return rows.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1).select("consensus_group", "ord", "place")


@query("geo_validate_marine", f"WITH {ANNOT}, p AS (SELECT DISTINCT lat, lon FROM ann WHERE lat IS NOT NULL AND lon IS NOT NULL), b AS ({fx.BOXES_SQL}) SELECT lat, lon, bool_or(greatest(xmin - lon, 0, lon - xmax) ** 2 + greatest(ymin - lat, 0, lat - ymax) ** 2 <= 2.25e0) AS is_marine FROM p, b GROUP BY ALL")
def _(spark, d):
    spots = annotated(spark, d)[0].select("lat", "lon").where("lat IS NOT NULL AND lon IS NOT NULL").distinct()
    return geo.valid_marine(spots, fx.ringed(fx.boxes(spark)), buffer=1.5)


@query(
    "p23_organism_names",
    """SELECT doc_id, CASE WHEN lower(p[2]) IN ('data', 'bold', 'samples', 'sequences') THEN p[1] ELSE concat(p[1], '_', p[2]) END AS organism
    FROM (SELECT doc_id, string_split(concat(source, '_', CASE WHEN doc_id % 3 = 0 THEN 'Data' ELSE lang END, '_x'), '_') AS p FROM documents)""",
)
def _(spark, d):
    """The organism of a file's name, in every row."""
    word = F.when(F.col("doc_id") % 3 == 0, "Data").otherwise(F.col("lang"))
    return fx.documents(spark, d).select("doc_id", names.organism_column(F.concat(F.lit("/a.b/"), "source", F.lit("_"), word, F.lit("_x.tsv"))).alias("organism"))


@query("p25_preflight", f"WITH {SPEC} SELECT true AS good, concat_ws('; ', concat(count(*) FILTER (coalesce(nuc, '') = ''), ' empty sequences')) AS issues FROM spec")
def _(spark, d):
    good, issues = qc.preflight(fx.specimens(spark, d))
    return spark.createDataFrame([(good, "; ".join(issues))], "good boolean, issues string")


@query("k1_close_pairs", f"WITH {SPEC}, node AS (SELECT aln, min(ord) AS ord FROM spec GROUP BY aln), chars AS (SELECT ord, p, substr(aln, p, 1) AS c FROM node, unnest(range(1, 129)) AS r(p) WHERE substr(aln, p, 1) IN ('A','C','G','T')), dist AS (SELECT a.ord AS i, b.ord AS j, 1e0 - sum((a.c = b.c)::INT)::DOUBLE / count(*) AS dist FROM chars a JOIN chars b USING (p) WHERE a.ord < b.ord GROUP BY ALL) SELECT i, j, dist FROM dist WHERE dist <= 0.02e0")
def _(spark, d):
    """Pairs up to the cut alone, as clustering takes them."""
    node = fx.specimens(spark, d).groupBy("aln").agg(F.min("ord").alias("ord"))
    return distance.pairwise(node.select(F.col("ord").cast("string").alias("seq_id"), "ord", "aln"), max_distance=0.02).select("i", "j", "dist")


# --- shapefiles and projections -----------------------------------------------------


@query("s08_shapefile_basins", ORACLE_SQL["k5_jagged_coasts"])
def _(spark, d):
    """The jagged bands written as shapefiles and read back; basins from what was read."""
    path = _path(spark, "bands")
    shapefile.write_shapefile(fx.coasts(spark, d).select("rings", "basin_name", "poly_ord").repartitionByRange(3, "poly_ord").sortWithinPartitions("poly_ord"), path)
    read = shapefile.read_shapefile(spark, path)
    s = located(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    polygons = read.select(F.col("attributes")["basin_name"].alias("basin_name"), F.col("attributes")["poly_ord"].cast("int").alias("poly_ord"), "rings")
    return geo.assign_basins(s, polygons).select("processid", "ocean_basin")


_E = "0.08181919084262149e0"
_PHI = "radians(latitude * 0.9e0)"


@query(
    "s08_reprojected",
    f"""WITH {LOCATED} SELECT processid, round(6378137e0 * radians(longitude), 3) AS x, round(6378137e0 * (ln(tan(pi() / 4 + {_PHI} / 2)) - {_E} / 2 * ln((1 + {_E} * sin({_PHI})) / (1 - {_E} * sin({_PHI})))), 3) + 0e0 AS y,
    true AS transverse_ok, true AS mercator_ok, true AS lambert_ok FROM located WHERE latitude IS NOT NULL AND abs(longitude) < 180""",
)
def _(spark, d):
    """Mercator's coordinates (latitudes shrunk to 81 degrees), and whether three projections and their inverses give every coordinate back within 1e-9 degrees."""
    s = located(spark, d).where("latitude IS NOT NULL AND abs(longitude) < 180").select("processid", F.col("longitude").alias("lon"), (F.col("latitude") * 0.9).alias("lat"))
    kinds = {
        "transverse": (projection.Projection("transverse", lon0=3.0, scale=0.9996, east=500000.0), 6.0), "mercator": (projection.Projection("mercator"), 1.0),
        "lambert": (projection.Projection("lambert", lon0=10.0, lat0=52.0, parallels=(35.0, 65.0), east=4e6, north=2.8e6), 1.0),
    }
    out = s
    for name, (p, shrink) in kinds.items():
        x, y = projection.from_degrees(F.col("lon") / shrink, F.col("lat"), p)
        out = out.withColumns({f"{name}_x": x, f"{name}_y": y})
    for name, (p, shrink) in kinds.items():
        lon, lat = projection.to_degrees(F.col(f"{name}_x"), F.col(f"{name}_y"), p)
        out = out.withColumn(f"{name}_ok", (F.abs(lon - F.col("lon") / shrink) < 1e-9) & (F.abs(lat - F.col("lat")) < 1e-9))
    return out.select("processid", F.round("mercator_x", 3).alias("x"), F.round("mercator_y", 3).alias("y"), *[f"{n}_ok" for n in kinds])


# --- sections of the report ----------------------------------------------------------

_SUM = f"s AS ({ORACLE_SQL['a09_assignment_summary']})"


def _entries(rows: list[tuple[str, str, str]], a: str, b: str, c: str) -> str:
    return " UNION ALL ".join(f"SELECT {k + 1} AS place, '{t}' AS {a}, ({v})::DOUBLE AS {b}, ({p})::DOUBLE AS {c} FROM s" for k, (t, v, p) in enumerate(rows))


_CARDS = [
    ("Samples", "total_samples", "NULL"), ("With sequence", "samples_with_sequence", "samples_with_sequence / total_samples * 100"), ("Genotypes", "n_consensus_groups", "NULL"), ("Species", "n_species_identified", "NULL"),
    ("Assigned", "n_assigned", "pct_assigned"), ("Mean identity, per cent", "mean_identity_assigned * 100", "NULL"), ("Basins", "(SELECT count(DISTINCT ocean_basin) FROM b)", "NULL"),
    ("Conflicts of names", "n_taxonomy_conflicts", "pct_taxonomy_conflicts"),
]


@query("v10_summary_cards", f"WITH {_SUM}, b AS (WITH {ANNOT} SELECT ocean_basin FROM ann), c AS ({_entries(_CARDS, 'title', 'value', 'share')}) SELECT * FROM c WHERE title <> 'Conflicts of names' OR value > 0")
def _(spark, d):
    ann, diag = annotated(spark, d)
    return reports.summary_cards(ann, aggregates.assignment_summary(ann, diag))


@query("v10_status_rows", f"WITH {_SUM} {_entries([(s, f'n_{s}', f'pct_{s}') for s in aggregates.STATUSES], 'status', 'n', 'share')}")
def _(spark, d):
    return reports.status_rows(aggregates.assignment_summary(*annotated(spark, d)))


@query("v10_identity_rows", f"WITH {_SUM}, r AS ({_entries([(k, f'{k}_identity_assigned * 100', 'NULL') for k in ('mean', 'median', 'min', 'max')], 'metric', 'identity', 'gone')}) SELECT place, metric, identity FROM r")
def _(spark, d):
    return reports.identity_rows(aggregates.assignment_summary(*annotated(spark, d)))


@query(
    "v10_geography",
    f"""WITH {ANNOT}, g AS (SELECT count(*) AS total, count(*) FILTER (ocean_basin <> 'Unknown') AS n_placed, count(*) FILTER (ocean_basin = 'Unknown') AS n_unknown, count(*) FILTER (lat IS NULL OR lon IS NULL) AS n_missing FROM ann)
    SELECT *, n_placed / total * 100 AS pct_placed, n_unknown / total * 100 AS pct_unknown, n_missing / total * 100 AS pct_missing FROM g""",
)
def _(spark, d):
    return reports.geography(annotated(spark, d)[0])
