"""FASTA as a Spark data source, read in byte ranges and written by tasks with a manifest.

The data source splits large files into ranges; a range owns the records whose '>'
lies in it, so a record is read by one task wherever it ends. It opens files through
the file system that the path names, and takes folders. ``read_fasta`` goes through
Spark's own text reader instead.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage


def read_fasta(spark: SparkSession, path: str, allow_empty: bool = False) -> DataFrame:
    """Header (without '>'), seq (upper case, lines joined), ord in file order.

    Text before the first '>' is discarded; a file without records is an error.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("ord"))
    # Only a file's first piece may lack a '>' that the separator took.
    heads = raw.groupBy("file").agg(F.min(F.struct("start", "ord")).alias("head")).select("file", F.col("head.ord").alias("first"))
    raw = raw.join(heads, "file")
    text = F.regexp_replace("value", "\r", "")
    body = F.when(F.col("ord") != F.col("first"), text).when(text.startswith(">"), F.substring(text, 2, F.length(text)))
    lines = F.split(body, "\n")
    seq = F.upper(F.regexp_replace(F.array_join(F.slice(lines, F.lit(2), F.size(lines)), ""), r"\s", ""))
    out = raw.where(body.isNotNull()).select(F.trim(F.get(lines, 0)).alias("header"), seq.alias("seq"), "ord").where("header <> '' OR seq <> ''")
    if not allow_empty and not out.limit(1).count():
        raise ValueError(f"{path} holds no records")
    return out


def valid_fasta(spark: SparkSession, path: str) -> bool:
    """False without records or with an empty sequence."""
    try:
        return bool(read_fasta(spark, path).agg(F.bool_and(F.length("seq") > 0)).first()[0])
    except ValueError:
        return False


def fasta_lines(df: DataFrame, header: str = "header", seq: str = "seq", width: int = 80) -> DataFrame:
    """One text per record; ``width`` 0 leaves sequences unwrapped."""
    body = F.col(seq) if not width else F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")
    return df.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), body).alias("value"))


def write_fasta(df: DataFrame, path: str, order: str | None = None, width: int = 80) -> None:
    """A folder of parts in the order of ``order``, by the data source's writer."""
    register(df.sparkSession)
    rows = df.select("header", "seq") if order is None else df.repartitionByRange(order).sortWithinPartitions(order).select("header", "seq")
    rows.write.format("fasta").mode("append").option("width", width).save(path)


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, number: int):
        self.path, self.start, self.end, self.number = path, start, end, number


class _Ranges(InputPartition):
    """Neighbouring ranges that one task reads, one after the other."""

    def __init__(self, ranges: list[_Range]):
        self.ranges = ranges


#: Tasks of a reading at most, unless TASK_BYTES a task make more.
TASKS, TASK_BYTES = 256, 64 << 20


class _Reader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = _store(self.path)
        found = store.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [found]
        if found.type == fs.FileType.Directory:
            files = sorted((f for f in store.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File and f.base_name[:1] not in "_."), key=lambda f: f.path)
        base = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else "file://"
        ranges = [_Range(base + f.path, a, min(a + self.size, f.size), k) for k, f in enumerate(files) for a in range(0, max(f.size, 1), self.size)]
        # Short ranges of a long text are dealt to tasks in runs: a task for each would cost more than its reading.
        tasks = max(TASKS, sum(f.size for f in files) // TASK_BYTES)
        run = -(-len(ranges) // tasks)
        return [_Ranges(ranges[k : k + run]) for k in range(0, len(ranges), max(run, 1))]

    def read(self, part: _Ranges) -> Iterator[tuple]:
        for one in part.ranges:
            yield from self._read(one)

    def _read(self, part: _Range) -> Iterator[tuple]:
        store, path = _store(part.path)
        #: Records of one file keep its order, and files theirs.
        before = part.number << 44
        with io.BufferedReader(store.open_input_file(path)) as f:
            f.seek(max(part.start - 1, 0))
            if part.start:
                f.readline()  # the line that began before this range
            header, at, lines = None, 0, []
            while True:
                here = f.tell()
                line = f.readline()
                if not line or (line.startswith(b">") and here >= part.end):
                    break
                if line.startswith(b">"):
                    if header is not None:
                        yield header, "".join(lines), at
                    header, at, lines = line[1:].decode().strip(), before + here, []
                elif header is not None:
                    lines.append("".join(line.decode().upper().split()))
            if header is not None:
                yield header, "".join(lines), at


@dataclass
class _Part(WriterCommitMessage):
    number: int
    name: str
    records: int
    size: int


class _Writer(DataSourceWriter):
    """Rows (header, seq) to a part for each task, under a name that starts with a dot until
    all tasks have ended. A repeated task writes a file of its own; only the one whose message
    the driver got is named. The manifest has the place of each part in the whole text, so
    parts put together in its order are the file in the order of the rows."""

    def __init__(self, path: str, width: int):
        self.path, self.width = path, width

    def write(self, rows: Iterator) -> _Part:
        from pyspark import TaskContext

        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        number = TaskContext.get().partitionId()
        name, records, size = f"part-{number:05d}-{uuid.uuid4().hex[:12]}.fasta", 0, 0
        with store.open_output_stream(f"{folder}/.{name}") as f:
            for row in rows:
                seq = row["seq"] or ""
                lines = [seq[i : i + self.width] for i in range(0, len(seq), self.width)] if self.width else [seq]
                text = ">" + (row["header"] or "") + "\n" + "\n".join(lines) + "\n"
                size += f.write(text.encode())
                records += 1
        return _Part(number, name, records, size)

    def commit(self, messages: list) -> None:
        store, folder = _store(self.path)
        parts, at = [], 0
        for m in sorted((m for m in messages if m), key=lambda m: m.number):
            if m.records:
                store.move(f"{folder}/.{m.name}", f"{folder}/{m.name}")
                parts.append({"file": m.name, "offset": at, "bytes": m.size, "records": m.records})
                at += m.size
            else:
                store.delete_file(f"{folder}/.{m.name}")
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/_manifest-{uuid.uuid4().hex[:12]}.json") as f:
            f.write(json.dumps({"bytes": at, "parts": parts}).encode())

    def abort(self, messages: list) -> None:
        store, folder = _store(self.path)
        for m in messages:
            if m:
                store.delete_file(f"{folder}/.{m.name}")


class FastaSource(DataSource):
    """``spark.read.format("fasta").option("path", ...)``: header, seq, ord (by file and byte offset).
    Writing takes header and seq, and the option ``width`` (letters of a line, 0: one line)."""

    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return "header string, seq string, ord bigint"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("rangeBytes", 64 << 20)))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], int(self.options.get("width", 80)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastaSource)
