"""The data of maps, bars and colours, and their JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import numbered
from .geo import BASIN_ORDER

# The five lead colours, and the colour-blind palette that follows.
LEAD_COLORS = ["#8545C1", "#10B3A5", "#FFB031", "#3874F4", "#D975C7"]
PALETTE = ["#0173b2", "#de8f05", "#029e73", "#d55e00", "#cc78bc", "#ca9161", "#fbafe4", "#949494", "#ece133", "#56b4e9"]
MIN_SIZE, MAX_SIZE = 50.0, 500.0


def abundance(df: DataFrame, genotype: str = "consensus_group", order: str = "ord") -> DataFrame:
    """(genotype, n, rank) by count, ties by first occurrence. The ranked table has one row per genotype."""
    n = df.where(F.col(genotype).isNotNull()).groupBy(F.col(genotype).alias("genotype")).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return numbered(n, [F.desc("n"), "first"], "rank").drop("first")


def colors(n: int) -> list[str]:
    """Lead colours first, then the palette without them, repeated as needed."""
    rest = [c for c in PALETTE if c.lower() not in {x.lower() for x in LEAD_COLORS}]
    out = list(LEAD_COLORS)
    while len(out) < n:
        out += rest
    return out[:n]


def color_at(rank: Column) -> Column:
    """The colour of a rank from 1."""
    rest = [c for c in PALETTE if c.lower() not in {x.lower() for x in LEAD_COLORS}]
    lead, tail = F.array(*map(F.lit, LEAD_COLORS)), F.array(*map(F.lit, rest))
    k = rank - 1
    return F.when(k < len(LEAD_COLORS), F.get(lead, k)).otherwise(F.get(tail, (k - len(LEAD_COLORS)) % len(rest)))


def color_map(df: DataFrame) -> DataFrame:
    """V6: consensus_group, consensus_group_sp, color, rank."""
    ranks = abundance(df)
    color = color_at(F.col("rank"))
    labels = df.where("consensus_group IS NOT NULL").groupBy(F.col("consensus_group").alias("genotype")).agg(F.min("consensus_group_sp").alias("consensus_group_sp"))
    return ranks.join(labels, "genotype").select(F.col("genotype").alias("consensus_group"), "consensus_group_sp", color.alias("color"), "rank")


def multiplicity(df: DataFrame, lat: str = "lat", lon: str = "lon", genotype: str = "consensus_group", extra: tuple[str, ...] = ()) -> DataFrame:
    """(place, genotype[, more]) with count and marker size, one row per place.

    Sizes scale the counts from 50 to 500 over the whole table; all 50 if no count exceeds 1.
    """
    d = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(genotype).isNotNull())
    n = d.groupBy(F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.col(genotype).alias("genotype"), *extra).agg(F.count("*").alias("n"))
    span = n.agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    size = F.when((F.col("hi") > 1) & (F.col("hi") > F.col("lo")), MIN_SIZE + (F.col("n") - F.col("lo")) / (F.col("hi") - F.col("lo")) * (MAX_SIZE - MIN_SIZE)).otherwise(F.lit(MIN_SIZE))
    return n.join(F.broadcast(span)).withColumn("size", size).drop("lo", "hi")


def basin_abundance(df: DataFrame, facet: str | None = None, genotype: str = "consensus_group") -> DataFrame:
    """N and share per basin and genotype; unknown basins aside."""
    d = df.where("ocean_basin IS NOT NULL AND ocean_basin <> 'Unknown'")
    keys = [F.col(facet).alias("facet")] if facet else []
    n = d.groupBy(*keys, F.col("ocean_basin").alias("basin"), F.coalesce(genotype, F.lit("Unassigned")).alias("genotype")).agg(F.count("*").alias("n"))
    over = Window.partitionBy(*(["facet"] if facet else []), "basin")
    return n.withColumn("prop", F.col("n") / F.sum("n").over(over))


def charted(long: DataFrame) -> DataFrame:
    """Only the basins of the chart, with their place."""
    place = F.array_position(F.array(*map(F.lit, BASIN_ORDER)), F.col("basin")).cast("int")
    return long.withColumn("basin_place", place).where("basin_place > 0")


def extent(df: DataFrame, buffer: float = 20.0, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """V4: the map's bounds with a margin, within the globe."""
    low = lambda c, m: F.greatest(F.min(c) - F.lit(buffer), F.lit(-m))
    high = lambda c, m: F.least(F.max(c) + F.lit(buffer), F.lit(m))
    return df.agg(low(lon, 180.0).alias("lon_min"), high(lon, 180.0).alias("lon_max"), low(lat, 90.0).alias("lat_min"), high(lat, 90.0).alias("lat_max"))


def distribution_document(df: DataFrame) -> DataFrame:
    """V1: one row per genotype of the map's JSON; empty if fewer than 5 specimens have place and genotype."""
    d = df.where("lat IS NOT NULL AND lon IS NOT NULL AND consensus_group IS NOT NULL")
    enough = d.agg(F.count("*").alias("total")).where("total >= 5")
    places = multiplicity(d.withColumn("basin", F.coalesce("ocean_basin", F.lit("Unknown"))), extra=("basin",))
    doc = places.groupBy("genotype").agg(
        F.array_sort(F.collect_list(F.struct("lat", "lon", "size", "basin", "n"))).alias("points"), F.sum("n").alias("sample_count")
    )
    return doc.join(F.broadcast(enough)).drop("total").select("genotype", "sample_count", F.to_json("points").alias("points"))


def bar_document(df: DataFrame, total: bool = False, facet: str | None = None, genotype: str = "consensus_group_sp", basin: str = "ocean_basin", order: str = "ord") -> DataFrame:
    """V2, V3, V5: one row per genotype (and ``facet``) of a bar chart's JSON.

    genotype, rank and color (by abundance over all known basins), counts (basin ->
    specimens), sample_count, plot_type. Specimens without a genotype are 'Unassigned'.
    """
    d = df.where(F.col(basin).isNotNull() & (F.col(basin) != "Unknown")).withColumn("genotype", F.coalesce(genotype, F.lit("Unassigned")))
    if facet:
        d = d.where(F.col(facet).isNotNull()).withColumn("facet", F.col(facet))
    keys = ["facet"] if facet else []
    n = d.groupBy(*keys, "genotype", F.col(basin).alias("basin")).agg(F.count("*").alias("n"))
    rows = n.groupBy(*keys, "genotype").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("basin", "n")))).alias("counts"), F.sum("n").alias("sample_count"))
    ranks = abundance(d.select("genotype", order), "genotype", order).select("genotype", "rank", color_at(F.col("rank")).alias("color"))
    kind = "faceted_abundance" if facet else "total_abundance" if total else "relative_abundance"
    return rows.join(ranks, "genotype").withColumn("plot_type", F.lit(kind))


def faceted_points(df: DataFrame, facet: str = "assigned_sp", lat: str = "lat", lon: str = "lon", genotype: str = "consensus_group") -> DataFrame:
    """V4: (facet, lat, lon, genotype, n); empty with fewer than five complete rows."""
    d = df.where(F.col(facet).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(genotype).isNotNull())
    n = d.groupBy(F.col(facet).alias("facet"), F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.col(genotype).alias("genotype")).agg(F.count("*").alias("n"))
    enough = d.agg(F.count("*").alias("total")).where("total >= 5").drop("total").withColumn("__one", F.lit(1))
    return n.withColumn("__one", F.lit(1)).join(F.broadcast(enough), "__one").drop("__one")


def filtered(long: DataFrame, genotypes: list[str] | None = None, basins: list[str] | None = None, min_count: int = 1) -> DataFrame:
    """What the report's check boxes and slider select."""
    if genotypes is not None:
        long = long.where(F.col("genotype").isin(genotypes))
    if basins is not None:
        long = long.where(F.col("basin").isin(basins))
    return long.where(F.col("n") >= min_count)
