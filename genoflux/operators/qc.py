"""Record and coordinate quality: keep-first, parsing, filters, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coords, sequence


def keep_first(df: DataFrame, key: str | list[str], order: str | list[str] = "ord") -> DataFrame:
    """The row with the smallest ``order`` of each key; null keys are a key. Further columns of ``order`` settle ties."""
    keys, by = ([c] if isinstance(c, str) else c for c in (key, order))
    rows = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("__first", F.row_number().over(rows)).where("__first = 1").drop("__first")


def strip_strings(df: DataFrame) -> DataFrame:
    return df.select(*[sequence.stripped(F.col(f"`{c}`")).alias(c) if kind == "string" else F.col(f"`{c}`") for c, kind in df.dtypes])


def coordinate_order(df: DataFrame, pair: str) -> DataFrame:
    """One row: 'lon_lat' if some first value exceeds 90 degrees and no second does, else 'lat_lon'."""
    beyond = lambda field: F.count_if(F.abs(F.col(f"{pair}.{field}")) > 90)
    return df.agg(F.when((beyond("lat") > 0) & (beyond("lon") == 0), "lon_lat").otherwise("lat_lon").alias("coord_order"))


def with_coordinates(df: DataFrame, column: str = "coord", infer_order: bool = False) -> DataFrame:
    """Adds latitude and longitude. With ``infer_order`` the order of all pairs
    together decides (one pass of counting, its single row is broadcast)."""
    if column not in df.columns:
        return df.withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")})
    if not infer_order:
        found = df.withColumn("__pair", coords.coordinate_pair(F.col(column)))
        return found.withColumns({"latitude": F.col("__pair.lat"), "longitude": F.col("__pair.lon")}).drop("__pair")
    raw = df.withColumn("__pair", coords.coordinate_pair(F.col(column), validate=False))
    both = raw.join(F.broadcast(coordinate_order(raw, "__pair")))
    swap = F.col("coord_order") == "lon_lat"
    lat = F.when(swap, F.col("__pair.lon")).otherwise(F.col("__pair.lat"))
    lon = F.when(swap, F.col("__pair.lat")).otherwise(F.col("__pair.lon"))
    good = coords.in_range(lat, lon)
    return both.withColumns({"latitude": F.when(good, lat), "longitude": F.when(good, lon)}).drop("__pair", "coord_order")


def filter_coordinates(
    df: DataFrame, exclude_centroids: bool = True, exclude_zero: bool = True, exclude_missing: bool = True, source: str = "coord_source"
) -> DataFrame:
    """Drops missing coordinates, country centroids and (0, 0), as asked; what
    rests on columns the table lacks is skipped."""
    has = "latitude" in df.columns
    if exclude_missing and has:
        df = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if exclude_centroids and source in df.columns:
        df = df.where(~F.coalesce(F.lower(source).contains("centroid"), F.lit(False)))
    if exclude_zero and has:
        df = df.where(~F.coalesce((F.col("latitude") == 0) & (F.col("longitude") == 0), F.lit(False)))
    return df


def filter_ungapped(df: DataFrame, min_length: int, aln: str = "aln") -> DataFrame:
    return df.where(sequence.ungapped_length(F.col(aln)) >= min_length)


def filter_relative_length(df: DataFrame, ratio: float, seq: str = "consensus_seq") -> DataFrame:
    """Sequences of at least ``ratio`` of the median length; a single one stays."""
    middle = df.agg(F.median(F.length(seq)).alias("__median"), F.count("*").alias("__rows"))
    return df.join(F.broadcast(middle)).where((F.col("__rows") <= 1) | (F.length(seq) >= F.col("__median") * F.lit(ratio))).drop("__median", "__rows")


def skip_reasons(df: DataFrame, min_length: int, seq: str = "nuc") -> DataFrame:
    reason = F.when(F.coalesce(seq, F.lit("")) == "", "empty").otherwise(sequence.invalid_reason(F.col(seq), min_length))
    return df.select(reason.alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def data_quality(df: DataFrame) -> DataFrame:
    """One row of counters over a specimen table."""
    empty = lambda c: F.coalesce(sequence.stripped(F.col(c)), F.lit("")) == ""
    return df.agg(
        F.count("*").alias("n_records"),
        F.count_distinct("processid").alias("n_processids"),
        F.count_if(~empty("nuc")).alias("n_with_sequence"),
        F.count_if(empty("nuc")).alias("n_without_sequence"),
        F.count_if(~empty("coord")).alias("n_with_coordinates"),
        F.count_if(empty("coord")).alias("n_without_coordinates"),
        F.count_if(F.lower("coord_source").contains("centroid")).alias("n_centroids"),
    )


def coordinate_quality(df: DataFrame) -> DataFrame:
    """One row: totals, missing, zero, centroid, mean number of decimals of the latitude's text."""
    text = F.get(F.split(F.translate("coord", "[] ", ""), ","), 0)
    return df.agg(
        F.count("*").alias("total_samples"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("missing_coords"),
        F.count_if((F.col("latitude") == 0) & (F.col("longitude") == 0)).alias("zero_coords"),
        F.count_if(F.lower("coord_source").contains("centroid")).alias("centroid_coords"),
        F.avg(F.when(F.col("latitude").isNotNull(), coords.decimals(text))).alias("mean_precision"),
    )


def preflight(df: DataFrame) -> tuple[bool, list[str]]:
    """Whether a table can be analysed, and what speaks against it."""
    missing = [c for c in ("processid", "nuc") if c not in df.columns]
    if missing:
        return False, [f"missing columns: {', '.join(missing)}"]
    found = df.agg(
        F.count("*").alias("n"), F.count_distinct("processid").alias("ids"), F.count_if(F.coalesce("nuc", F.lit("")) == "").alias("empty"),
        (F.count_if(F.col("coord").isNotNull()) if "coord" in df.columns else F.lit(0)).alias("coords"),
    ).first()
    issues = []
    if not found["n"]:
        issues.append("no records")
    elif found["empty"] == found["n"]:
        issues.append("all sequences are empty")
    elif found["empty"]:
        issues.append(f"{found['empty']} empty sequences")
    if found["ids"] < found["n"]:
        issues.append(f"{found['n'] - found['ids']} duplicate process ids")
    if not found["coords"]:
        issues.append("no coordinates")
    return bool(found["n"]) and found["empty"] < found["n"], issues


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def unique(df: DataFrame, key: str, what: str) -> DataFrame:
    """The same rows; a key that repeats fails the job that reads them (J4-J6: joins to one row).

    The check is part of the plan: rows are grouped by the key that the join deals them by anyway.
    """
    rest = [c for c in df.columns if c != key]
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"), F.first(F.struct(*rest)).alias("__row"))
    bad = F.raise_error(F.concat(F.lit(f"{what} repeats {key} "), F.col(key).cast("string"))).cast(one.schema["__row"].dataType)
    checked = one.select(key, F.when(F.col("__n") > 1, bad).otherwise(F.col("__row")).alias("__row"))
    return checked.select(key, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def counters(df: DataFrame) -> list[Column]:
    """What ``data_quality`` counts, for an observation of a specimen table."""
    empty = lambda c: F.coalesce(sequence.stripped(F.col(c)), F.lit("")) == "" if c in df.columns else F.lit(True)
    centroid = F.lower("coord_source").contains("centroid") if "coord_source" in df.columns else F.lit(False)
    return [F.count("*").alias("n_records"), F.count_if(~empty("nuc")).alias("n_with_sequence"), F.count_if(~empty("coord")).alias("n_with_coordinates"), F.count_if(centroid).alias("n_centroids")]


def count_valid(seq: Column) -> Column:
    return F.count_if(sequence.invalid_reason(seq).isNull())
