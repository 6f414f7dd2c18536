"""Short ranges of a long text."""

from pyspark.sql import functions as F

from genoflux.sources import fasta


def test_short_ranges_share_tasks(spark, tmp_path):
    df = spark.range(4000).select(F.concat(F.lit("s"), "id").alias("header"), F.lpad(F.col("id").cast("string"), 30, "A").alias("seq"), F.col("id").alias("ord"))
    path = f"file://{tmp_path}/x"
    fasta.write_fasta(df, path, order="ord")
    parts = fasta._Reader(path, 50).partitions()
    ranges = [r for p in parts for r in p.ranges]
    assert len(parts) <= fasta.TASKS and len(ranges) > 10 * fasta.TASKS
    read = spark.read.format("fasta").option("path", path).option("rangeBytes", 50).load()
    assert [tuple(r) for r in read.orderBy("ord").select("header", "seq").collect()] == [(f"s{k}", str(k).rjust(30, "A")) for k in range(4000)]
    assert len(fasta._Reader(path, 50_000).partitions()) == len([p for p in parts for r in p.ranges if r.start % 50_000 == 0])
