"""Specimens derived from the driver's ``documents`` table.

The same SQL text runs in both engines: bases from md5, coordinates from whole
numbers (so no float is formatted), names from language and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def base(fam: str) -> str:
    """128 bases of a family number."""
    parts = ", ".join(f"translate(md5(concat('fam', cast({fam} AS string), ':{k}')), '0123456789abcdef', 'ACGTACGTACGTACGT')" for k in range(4))
    return f"concat({parts})"


def _hundredths(x: str) -> str:
    return (
        f"concat(CASE WHEN {x} < 0 THEN '-' ELSE '' END, cast(cast(floor(abs({x}) / 100) AS bigint) AS string), '.',"
        f" lpad(cast(abs({x}) % 100 AS string), 2, '0'))"
    )


SPECIMENS = f"""
SELECT processid, ord, fam, genus, species, country_ocean, coord_source, coord,
       CASE WHEN ord % 17 = 0 THEN NULL
            WHEN ord % 19 = 0 THEN translate(md5(cast(ord AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT')
            WHEN ord % 23 = 0 THEN substr(mutated, 1, 118)
            ELSE mutated END AS nuc,
       mutated AS aln
FROM (
  SELECT concat('PID', cast(doc_id AS string)) AS processid, doc_id AS ord, fam, source AS genus, concat(source, ' ', lang) AS species, lang AS country_ocean,
         CASE WHEN doc_id % 9 = 0 THEN 'Country Centroid' ELSE 'GPS' END AS coord_source,
         CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '[0, 0]' WHEN doc_id % 29 = 0 THEN 'unknown'
              ELSE concat('[', {_hundredths("a")}, ', ', {_hundredths("b")}, ']') END AS coord,
         concat(substr(bases, 1, p - 1), CASE WHEN doc_id % 4 = 0 THEN substr(bases, p, 1) WHEN doc_id % 5 = 0 THEN 'N' ELSE 'T' END, substr(bases, p + 1)) AS mutated
  FROM (SELECT doc_id, lang, source, doc_id % 7 AS fam, {base("(doc_id % 7)")} AS bases, cast(1 + (doc_id * 37) % 128 AS int) AS p,
               doc_id * 7919 % 18001 - 9000 AS a, doc_id * 104729 % 36001 - 18000 AS b FROM documents) x) y
"""

CONSENSUS = f"""
SELECT concat('consensus_c', cast(fam + 1 AS string)) AS consensus_group, {base("fam")} AS consensus_seq, fam AS ord, cast(fam + 1 AS int) AS cluster_id,
       cast(20 * (fam + 1) AS int) AS n_reference
FROM (SELECT DISTINCT doc_id % 7 AS fam FROM documents) f
UNION ALL
SELECT 'consensus_c8', concat(substr({base("0")}, 1, 127), 'N'), 7, 8, 5
UNION ALL
SELECT 'consensus_c9', concat('GGGG', {base("100")}), 8, 9, 3
"""

#: Half-plane boxes with strict bounds; the last overlaps two others.
BOXES = [
    ("North Atlantic Ocean", 0, -180.0, 0.0, 0.0, 90.0),
    ("South Pacific Ocean", 1, -180.0, -90.0, 0.0, 0.0),
    ("Indian Ocean", 2, 0.0, -90.0, 180.0, 0.0),
    ("South Atlantic Ocean", 3, -60.0, -60.0, 20.0, 0.0),
]
BOXES_SQL = " UNION ALL ".join(f"SELECT '{n}' AS basin_name, {o} AS poly_ord, {a}e0 AS xmin, {b}e0 AS ymin, {c}e0 AS xmax, {d}e0 AS ymax" for n, o, a, b, c, d in BOXES)


#: Bands from west to east, one for each region, with a jagged coast of the region's customers
#: (a vertex north and south for each) and a hole of the suppliers of its nations; neighbours overlap.
#: Only sums, products and quotients, so both engines get the same numbers.
COAST = """
SELECT n_regionkey AS poly_ord, c_custkey AS k, row_number() OVER (PARTITION BY n_regionkey ORDER BY c_custkey) AS r, count(*) OVER (PARTITION BY n_regionkey) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
HOLE = """
SELECT n_regionkey AS poly_ord, s_suppkey AS k, row_number() OVER (PARTITION BY n_regionkey ORDER BY s_suppkey) AS r, count(*) OVER (PARTITION BY n_regionkey) AS n
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
VERTICES = f"""
SELECT poly_ord, ring, place, x, y FROM (
  SELECT poly_ord, 0 AS ring, r AS place, -170e0 + 340e0 * (r - 1) / n AS x, -52e0 + 26e0 * poly_ord + 9e0 + (k * 7919 % 1000) / 100e0 AS y FROM ({COAST}) a
  UNION ALL SELECT poly_ord, 0, 2 * n + 1 - r, -170e0 + 340e0 * (r - 1) / n, -52e0 + 26e0 * poly_ord - 9e0 - (k * 6007 % 1000) / 100e0 FROM ({COAST}) b
  UNION ALL SELECT poly_ord, 1, r, -120e0 + 240e0 * (r - 1) / n, -52e0 + 26e0 * poly_ord + 1e0 + (k * 613 % 500) / 100e0 FROM ({HOLE}) c
  UNION ALL SELECT poly_ord, 1, 2 * n + 1 - r, -120e0 + 240e0 * (r - 1) / n, -52e0 + 26e0 * poly_ord - 1e0 - (k * 419 % 500) / 100e0 FROM ({HOLE}) d) v
"""


def coasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """basin_name, poly_ord, rings and bounds of the bands."""
    from pyspark.sql import functions as F

    from ..sources.tables import with_bounds

    at = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "supplier", "nation", "region")}
    text = VERTICES
    for t in ("customer", "supplier", "nation"):
        text = text.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    found = spark.sql(text, **{t: at[t] for t in ("customer", "supplier", "nation")})
    ring = found.groupBy("poly_ord", "ring").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x", "y"))), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("vertices"))
    whole = ring.groupBy("poly_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("ring", "vertices"))), lambda v: v["vertices"]).alias("rings"))
    named = whole.join(at["region"].select(F.col("r_regionkey").alias("poly_ord"), F.col("r_name").alias("basin_name")), "poly_ord")
    return with_bounds(named.select("basin_name", F.col("poly_ord").cast("int").alias("poly_ord"), "rings"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def specimens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SPECIMENS.replace("FROM documents)", "FROM {documents})"), documents=documents(spark, sf_dir).select("doc_id", "lang", "source"))


def consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CONSENSUS.replace("FROM documents)", "FROM {documents})"), documents=documents(spark, sf_dir).select("doc_id"))


def boxes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BOXES, "basin_name string, poly_ord int, xmin double, ymin double, xmax double, ymax double")


def ringed(df: DataFrame) -> DataFrame:
    """Boxes as polygons with one ring."""
    from pyspark.sql import functions as F

    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return df.withColumn("rings", F.array(F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"))))
