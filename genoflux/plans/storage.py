"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where it is unset, as in local tests, a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="genoflux-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write and read again; what follows no longer depends on what came before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Adds ``name``: 1, 2, ... in the order of all rows, with no task that sees them all.

    Rows are range-sorted and written with their partition; a number is the place inside
    the partition behind the rows of those before, whose counts (one per partition) are summed.
    """
    part = "__part"
    rows = materialize(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "numbered")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(part).count().select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return rows.withColumn("__place", place).join(offsets, part).withColumn(name, (F.col("__before") + F.col("__place")).cast("int")).drop(part, "__place", "__before")
