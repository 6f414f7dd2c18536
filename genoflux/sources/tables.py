"""Delimited specimen tables, sidecar tables, polygons, logs."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence
from ..operators.qc import keep_first, require_columns

#: Texts that stand for a missing value in delimited files.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def na_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.col(f"`{c}`").isin(NA_TEXTS), F.col(f"`{c}`")).alias(c) if kind == "string" else F.col(f"`{c}`") for c, kind in df.dtypes])


def _kind(spark: SparkSession, path: str) -> tuple[bool, bool]:
    """Whether every line decodes as UTF-8, and whether a line leaves a quote open, which the next then
    continues (one scan on the executors)."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = spark.read.text(path).agg(F.bool_and(F.is_valid_utf8("value")), F.bool_or(quotes % 2 == 1)).first()
    return found[0] is not False, bool(found[1])


def read_specimens(spark: SparkSession, path: str, required: tuple[str, ...] = ("processid", "nuc"), encoding: str | None = None, sep: str = "\t") -> DataFrame:
    """Every column as text, missing values null, the first row of each
    processid kept, and only then white space stripped. ``ord`` numbers the rows
    in file order. Falls back to Latin-1 where the file is not UTF-8. A quoted field may
    hold line breaks; a file with such fields is read file by file, others in ranges."""
    utf8, broken = _kind(spark, path)
    encoding = encoding or ("UTF-8" if utf8 else "ISO-8859-1")
    raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False, encoding=encoding, multiLine=broken, quote='"', escape='"')
    if not raw.columns:
        raise ValueError(f"{path} is empty")
    require_columns(raw, list(required))
    numbered = na_to_null(raw).withColumn("ord", F.monotonically_increasing_id())
    if not numbered.limit(1).count():
        raise ValueError(f"{path} has no records")
    kept = keep_first(numbered, "processid")
    return kept.select(*[sequence.stripped(F.col(f"`{c}`")).alias(c.replace("/", "_")) if c != "ord" else F.col("ord") for c in kept.columns])


def header_ok(spark: SparkSession, path: str, required: tuple[str, ...] = ("processid", "nuc"), sep: str = "\t") -> bool:
    """S3: never raises."""
    try:
        return set(required) <= set(spark.read.csv(path, sep=sep, header=True).columns)
    except Exception:
        return False


def read_diagnostics(spark: SparkSession, path: str) -> DataFrame:
    """Tab for .tsv and .txt, else comma; a null group is ''."""
    sep = "\t" if path.endswith((".tsv", ".txt")) else ","
    df = na_to_null(spark.read.csv(path, sep=sep, header=True))
    numbers = [c for c in ("identity", "target_identity", "classic_identity", "runner_up_identity") if c in df.columns]
    df = df.withColumns({c: F.col(c).try_cast("double") for c in numbers})
    return df.withColumn("consensus_group", F.coalesce("consensus_group", F.lit("")))


def read_consensus(spark: SparkSession, fasta_path: str, metadata_path: str) -> DataFrame:
    """FASTA records of clusters with their sidecar table; a record without one is an error."""
    from .fasta import read_fasta

    seqs = read_fasta(spark, fasta_path).where(F.col("header").startswith("consensus_c")).select(F.col("header").alias("consensus_group"), F.col("seq").alias("consensus_seq"), "ord")
    meta = spark.read.csv(metadata_path, header=True).select("consensus_group", F.col("cluster_id").cast("int"), F.col("n_reference").cast("int"))
    joined = seqs.join(meta, "consensus_group", "left")
    if joined.where("cluster_id IS NULL OR n_reference IS NULL").limit(1).count():
        raise ValueError(f"{metadata_path} lacks records of {fasta_path}")
    return joined


#: The properties that may name a basin, in their order of precedence.
NAME_COLUMNS = ("name", "NAME", "basin", "BASIN", "ocean", "OCEAN", "area_name", "AREA_NAME", "region", "REGION")


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """Names of genotypes by their sequences, as ``taxonomy.with_evidence`` takes them."""
    raw = na_to_null(spark.read.csv(path, header=True))
    number = lambda c: F.col(c).try_cast("double")
    return raw.select(
        "consensus_group", F.col("cluster_seq_sp").alias("cluster_sp"), F.col("cluster_seq_level").alias("cluster_level"), number("cluster_seq_best_identity").alias("identity_pct"), number("cluster_seq_qcov").alias("query_cov_pct")
    )


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with rings, GeoJSON features (Polygon and MultiPolygon), or a shapefile.

    The name is the first known name property. Multi-polygons become one row per part.
    """
    if path.endswith(".shp"):
        from .shapefile import read_shapefile

        return read_shapefile(spark, path)
    if path.endswith((".json", ".geojson")):
        text = spark.read.text(path, wholetext=True)
        point = "array<double>"
        kind = "struct<features:array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>>"
        feature = text.select(F.from_json("value", kind).alias("d")).select(F.posexplode("d.features").alias("poly_ord", "f"))
        name = F.coalesce(*[F.col("f.properties")[n] for n in NAME_COLUMNS], F.element_at(F.map_values("f.properties"), 1))
        one = F.array(F.from_json("f.geometry.coordinates", f"array<array<{point}>>"))
        many = F.from_json("f.geometry.coordinates", f"array<array<array<{point}>>>")
        parts = feature.select(name.alias("basin_name"), "poly_ord", F.explode(F.when(F.col("f.geometry.type") == "Polygon", one).otherwise(many)).alias("part"))
        rings = F.transform("part", lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
        df = parts.select("basin_name", "poly_ord", rings.alias("rings"))
    else:
        df = spark.read.parquet(path)
    return with_bounds(df)


def in_file_order(df: DataFrame) -> DataFrame:
    """Adds __file and __row: a row's place in the Parquet files that ``df`` reads, whatever task reads it."""
    return df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))


def with_bounds(df: DataFrame) -> DataFrame:
    flat = F.flatten("rings")
    bound = lambda f, axis: f(F.transform(flat, lambda p: p[axis]))
    return df.withColumns({"xmin": bound(F.array_min, "x"), "ymin": bound(F.array_min, "y"), "xmax": bound(F.array_max, "x"), "ymax": bound(F.array_max, "y")})


# What a run's log says, by the name of the counter.
LOG_COUNTERS = {
    "total_samples_loaded": r"Read (\d+) rows and.*columns",
    "duplicates_removed": r"Found (\d+) duplicate processids",
    "unique_samples": r"After removing duplicates:.*?(\d+) rows remaining",
    "samples_after_coord_filter": r"Retained (\d+)/\d+.*samples after coordinate filtering",
    "centroid_coords_excluded": r"Excluded (\d+) samples with centroid coordinates",
    "valid_sequences": r"Created (\d+) FASTA records",
    "invalid_sequences": r"Skipped (\d+) samples with missing or invalid sequences",
    "sequences_too_short": r"Filtered (\d+) sequences shorter than.*after trimming",
    "pairwise_comparisons": r"Distance calculation complete:.*?(\d+) pairwise distances",
    "consensus_genotypes": r"Identified (\d+) unique genotypes",
    "successfully_assigned": r"Successfully assigned: (\d+)",
    "assignment_rate": r"Successfully assigned:.*?\((\d+\.?\d*)%\)",
    "unassigned_no_sequence": r"- No sequence in FASTA: (\d+)",
    "unassigned_below_threshold": r"- Below identity threshold: (\d+)",
    "ties_flagged": r"- Ties \(ambiguous\): (\d+)",
    "low_confidence_flagged": r"- Low confidence: (\d+)",
    "samples_with_coords": r"Creating point geometries for (\d+)/\d+ samples with coordinates",
    "ocean_basin_assigned": r"Spatial join results:.*?(\d+) assigned to basins",
    "outside_basins": r"Spatial join results:.*?assigned to basins, (\d+) outside all basins",
    "unknown_basin": r"Assigned (\d+) samples.*to 'Unknown' basin",
}
LOG_TEXTS = {
    "input_file": r"Input TSV:\s*(.*\S)",
    "mafft_params": r"Running MAFFT alignment: mafft (.+?)\s+/",
    "trimal_params": r"Running trimAl: trimal (.+?)\s+-in",
    "fasttree_params": r"Running FastTree: fasttree (.+?)\s+/",
}
LOG_RUN, LOG_START, LOG_END = "Pipeline -", "Logging to file:", "Pipeline completed successfully"
LOG_ASSIGNMENT, LOG_TOTAL, LOG_CONTEXT = "Genotype assignment|(?i:assignment summary)", r"Total samples: (\d+)", 10


def log_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per log file (``log``): the last value of each counter and text in
    its last run, which begins two lines before its heading; start, end and seconds.

    A log without a heading, or a counter without its line, gives nulls.
    """
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("log"), F.split("value", r"\r?\n").alias("l"))
    heads = F.filter(F.transform("l", lambda x, i: F.when(x.contains(LOG_RUN) & ~x.contains(LOG_END), i)), lambda i: i.isNotNull())
    head = F.array_max(heads)
    runs = text.withColumn("run", F.when(head.isNotNull(), F.slice("l", F.greatest(head - 1, F.lit(1)), F.size("l"))))

    def last(values: Column) -> Column:
        found = F.filter(values, lambda v: v != "")
        return F.get(found, F.size(found) - 1)

    def value(pattern: str) -> Column:
        return last(F.transform("run", lambda x: F.regexp_extract(x, pattern, 1)))

    def stamp(said: str) -> Column:
        return F.try_to_timestamp(value(r"^\[(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)\].*" + said), F.lit("yyyy-MM-dd HH:mm:ss"))

    def total(x: Column, i: Column) -> Column:
        near = F.slice("run", F.greatest(i - LOG_CONTEXT, F.lit(0)) + 1, F.least(i, F.lit(LOG_CONTEXT)) + 1)
        return F.when(F.exists(near, lambda c: c.rlike(LOG_ASSIGNMENT)), F.regexp_extract(x, LOG_TOTAL, 1))

    out = runs.select(
        "log", *[value(p).cast("double").alias(k) for k, p in LOG_COUNTERS.items()], last(F.transform("run", total)).cast("double").alias("samples_for_assignment"),
        *[value(p).alias(k) for k, p in LOG_TEXTS.items()], stamp(LOG_START).alias("started"), stamp(LOG_END).alias("ended"),
    )
    return out.withColumn("seconds", F.unix_timestamp("ended") - F.unix_timestamp("started"))
