"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of the data folder, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Read from ``spark.checkpoint.dir``; only where that is unset and the master is
    local (as in tests) a temporary folder of this machine is chosen and recorded there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="genoflux-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished writes, which otherwise stay
    until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage for good.

    A lost executor costs no recomputation of what lies before, since every
    other executor can read the written files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    if _scratch:
        _scratch[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _delete(spark: SparkSession, where: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    _delete(df.sparkSession, df._stored_at)


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What is materialized inside is deleted at the end, even after an error, but for
    the tables that are handed to the function given (the result still reads those)."""
    kept: set[str] = set()
    _scratch.append([])

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._stored_at)
        return df

    try:
        yield keep
    finally:
        for path in _scratch.pop():
            if path in kept and _scratch:
                _scratch[-1].append(path)
            elif path not in kept:
                _delete(spark, path)


_inside: list = []


def enter(operator: str, forget: Callable[[], object]) -> None:
    """Python workers are reused: when another operator begins in one, the caches of
    the operator before go (``forget`` drops them), and their memory is given back."""
    if _inside and _inside[0] != operator:
        _inside[1]()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass
    _inside[:] = [operator, forget]


def small_batches(spark: SparkSession) -> None:
    """Rows with whole texts go to Python 2,000 at a time, unless the session says
    otherwise than Spark's default: this bounds what workers and their JVM hold."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "2000")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z only, as the contracts ask; other letters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
