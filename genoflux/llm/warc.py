"""Deterministic sharded WARC writer and reader.

Writing. Pages get a payload digest; of equal payloads of at least ``MIN_REVISIT``
bytes the record of the smallest page id is the response and the others revisit
it (decided by a minimum per digest, combined before the shuffle). Records are
dealt to shards by ranges of the page id that follow from an exact histogram, whose
crowded buckets are split again until none holds more than a shard (a single id of more
than that is split by digest), so the same pages always give the same shards, however
Spark splits the input. Within a shard they are sorted by page id and written as one gzip
member per record, rolling to the next file when the compressed size is reached. Headers
and digests are generated anew; ids and dates derive from the content, never
from the clock. A file is written under a temporary name and renamed when it is
complete: a task that is repeated, or runs twice, renames identical bytes over
identical bytes. The manifest (one row per file: name, records, bytes, SHA-256,
first and last page id) is written last; what it does not list is not part of
the archive. Temporary files that lost tasks left behind are deleted then.

Reading goes over the manifest's files, record by record, and checks each
payload against its digest.

Files are opened through the file system named by the folder's scheme, so local
folders, HDFS and object stores serve alike.

Defined cases: a null payload is empty; a null URL has no header and is read back as
null; a null page id is written first with an empty id and read back as null; of repeated rows of one page id and payload
exactly one is the response, the others revisit it; an empty table gives an
empty archive with an empty manifest; page ids are cast to long; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fresh_path, materialize, table

MIN_REVISIT = 100
#: Compressed bytes of a file, and bytes of payloads in a shard, which is some files.
ROLL_BYTES = 16 << 20
SHARD_BYTES = 128 << 20
#: Buckets of the page-id histogram, and of each bucket that holds more than a shard.
BUCKETS, FINER = 1 << 16, 1 << 8
DATE = "1970-01-01T00:00:00Z"
LEVEL = 5

MANIFEST = "file string, shard bigint, records bigint, bytes bigint, sha256 string, first_page bigint, last_page bigint"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _line(value: object) -> str:
    """A header value stays on one line."""
    return str(value if value is not None else "").replace("\r", " ").replace("\n", " ")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, repeat: int) -> bytes:
    """One uncompressed WARC record."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn('page', page_id, digest, repeat)}",
        f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {_line(url)}"]),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Page-ID: {_line(page_id)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn('page', refers_to, digest, 0)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without time or name."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _File:
    """A file under a temporary name; ``close`` renames it and gives its manifest row."""

    def __init__(self, folder: str, shard: int, number: int):
        self.fs, root = _fs(folder)
        self.name, self.shard = f"shard-{shard:08d}-{number:05d}.warc.gz", shard
        self.path, self.temporary = f"{root}/{self.name}", f"{root}/_temporary-{uuid.uuid4().hex}"
        self.fs.create_dir(root, recursive=True)
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.sha, self.bytes, self.records = hashlib.sha256(), 0, 0
        self.first = self.last = None
        self._write(member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: " + _urn("file", self.name).encode() + f"\r\nWARC-Date: {DATE}\r\nWARC-Filename: {self.name}\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode()))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def add(self, page_id: int | None, data: bytes) -> None:
        self._write(member(data))
        self.records += 1
        self.first = page_id if self.first is None else self.first
        self.last = page_id

    def close(self) -> tuple:
        self.out.close()
        self.fs.move(self.temporary, self.path)
        return self.name, self.shard, self.records, self.bytes, self.sha.hexdigest(), self.first, self.last


def _writer(folder: str, roll_bytes: int):
    """Rows sorted by (shard, page_id, digest, kind): a keeper row (kind 0) stands
    before the pages (kind 1) that it speaks of."""
    names = ["file", "shard", "records", "bytes", "sha256", "first_page", "last_page"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    given = ("kind", "shard", "page_id", "url", "html", "digest", "keeper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file: _File | None = None
        number, rows, last, told = 0, [], None, None
        repeat = 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in given]
            for kind, shard, page_id, url, html, digest, keeper in zip(*columns, strict=True):
                shard, page_id, digest = shard.as_py(), page_id.as_py(), digest.as_py()
                if kind.as_py() == 0:
                    told = (page_id, digest, keeper.as_py())
                    continue
                if file and (file.shard != shard or file.bytes >= roll_bytes):
                    number = number + 1 if file.shard == shard else 0
                    rows.append(file.close())
                    file = None
                elif not file:
                    number = 0
                file = file or _File(folder, shard, number)
                repeat = repeat + 1 if last == (page_id, digest) else 0
                last = (page_id, digest)
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                keeper = told[2] if told and told[:2] == last else None
                # Of repeated rows of the response itself, all but the first revisit it.
                refers_to = keeper if keeper is not None and (keeper != page_id or repeat) else None
                file.add(page_id, record(page_id, url.as_py(), payload, digest, refers_to, repeat))
        if file:
            rows.append(file.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds, strict=True)], names=names)

    return run


def with_digests(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes, digest."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("digest"),
    )


def keepers(known: DataFrame) -> DataFrame:
    """(page_id, digest, keeper) of the pages whose payload repeats; payloads themselves do not move."""
    small = known.where(F.col("payload_bytes") >= MIN_REVISIT).select("page_id", "digest")
    repeated = small.groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("keeper")).where("n > 1").drop("n")
    return small.join(repeated, "digest").select("page_id", "digest", "keeper").distinct()


def _bucket() -> Column:
    wide = lambda x: x.cast("decimal(38,0)")
    return F.floor((wide(F.col("page_id")) - wide(F.col("__lo"))) / wide(F.col("__width"))).cast("long")


def shards_of(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[int, int, list[tuple[list, list]]]:
    """The number of shards, how many of them (the first ones) hold null ids, and the levels.

    Level 0 has one cell, the span of all ids, dealt into BUCKETS buckets; a bucket that
    holds more than a shard is a cell of the next level. Of each level: its cells (cell, lo,
    width) and its buckets (cell, bucket, shard, parts, next cell). Exact sums over all
    pages; at most BUCKETS rows, and FINER for every crowded cell, come to the driver.
    Buckets without a next cell make shards in the order of their ids; a single id of more
    than a shard has ``parts`` of them, by digest.
    """
    spark = pages.sparkSession
    size = (F.octet_length(F.coalesce(F.col("html").cast("string"), F.lit(""))) + 1024).cast("long")
    sizes = materialize(pages.select(F.col("page_id").cast("long").alias("page_id"), size.alias("n")), "sizes")
    span = sizes.agg(F.min("page_id").alias("lo"), F.max("page_id").alias("hi"), F.sum(F.when(F.col("page_id").isNull(), F.col("n"))).alias("none")).first()
    nulls = -(-(span["none"] or 0) // shard_bytes)
    spans = [] if span["lo"] is None else [(span["lo"], span["hi"])]
    rows, fan = sizes.where("page_id IS NOT NULL").withColumn("__cell", F.lit(0).cast("long")), BUCKETS
    levels: list[tuple[list, list]] = []
    leaves: list[tuple[int, int, list]] = []  # first id, bytes, bucket
    while spans:
        cells = [(k, lo, max(1, -(-(hi - lo + 1) // fan))) for k, (lo, hi) in enumerate(spans)]
        dealt = _in_buckets(rows, cells)
        buckets, crowded = [], []
        for cell, bucket, n in dealt.groupBy("__cell", "__bucket").agg(F.sum("n")).collect():
            _, lo, width = cells[cell]
            lo += bucket * width
            hi = min(lo + width - 1, spans[cell][1])
            buckets.append([cell, bucket, None, 1, None])
            if n > shard_bytes and hi > lo:
                buckets[-1][4] = len(crowded)
                crowded.append((lo, hi))
            else:
                leaves.append((lo, n, buckets[-1]))
        levels.append((cells, buckets))
        if crowded:
            chosen = spark.createDataFrame([(b[0], b[1], b[4]) for b in buckets if b[4] is not None], "__cell bigint, __bucket bigint, __next bigint")
            rows = dealt.join(F.broadcast(chosen), ["__cell", "__bucket"]).select("page_id", "n", F.col("__next").alias("__cell"))
        spans, fan = crowded, FINER
    shard, filled = nulls, 0
    for _, n, bucket in sorted(leaves, key=lambda x: x[0]):
        if filled and filled + n > shard_bytes:
            shard, filled = shard + 1, 0
        bucket[2], bucket[3] = shard, max(-(-n // shard_bytes), 1)
        shard, filled = (shard + bucket[3], 0) if bucket[3] > 1 else (shard, filled + n)
    discard(sizes)
    return max(shard + (filled > 0), 1), nulls, levels


def _in_buckets(rows: DataFrame, cells: list) -> DataFrame:
    """Rows with ``__cell`` get ``__bucket``; both are null behind the last level."""
    known = rows.sparkSession.createDataFrame(cells, "__cell bigint, __lo bigint, __width bigint")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    bucket = F.floor((wide("page_id") - wide("__lo")) / wide("__width")).cast("long")
    return rows.join(F.broadcast(known), "__cell", "left").withColumn("__bucket", bucket).drop("__lo", "__width")


def with_shard(rows: DataFrame, nulls: int, levels: list[tuple[list, list]]) -> DataFrame:
    """Adds ``shard`` to rows with page_id and digest; what is broadcast is bounded as in ``shards_of``."""
    spark = rows.sparkSession
    out = rows.withColumns({"__cell": F.lit(0).cast("long"), "shard": F.lit(None).cast("long"), "__parts": F.lit(None).cast("long")})
    for cells, buckets in levels:
        known = spark.createDataFrame([tuple(b) for b in buckets], "__cell bigint, __bucket bigint, __shard bigint, __of bigint, __next bigint")
        out = _in_buckets(out, cells).join(F.broadcast(known), ["__cell", "__bucket"], "left")
        out = out.withColumns({"shard": F.coalesce("shard", "__shard"), "__parts": F.coalesce("__parts", "__of"), "__cell": F.col("__next")}).drop("__bucket", "__shard", "__of", "__next")
    shard, parts = F.coalesce("shard", F.lit(0).cast("long")), F.coalesce("__parts", F.lit(max(nulls, 1)).cast("long"))
    part = F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * parts, 32)
    return out.withColumn("shard", shard + part).drop("__cell", "__parts")


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the archive to ``folder`` and return its manifest, as committed."""
    spark = pages.sparkSession
    n, nulls, levels = shards_of(pages, shard_bytes)
    known = with_digests(pages)
    told = keepers(known)
    text, none = F.lit(None).cast("string"), F.lit(None).cast("long")
    # One shuffle moves the payloads: keeper rows meet them in the writer, by order.
    both = known.select(F.lit(1).alias("kind"), "page_id", "url", "html", "digest", none.alias("keeper")).unionByName(
        told.select(F.lit(0).alias("kind"), "page_id", text.alias("url"), text.alias("html"), "digest", "keeper")
    )
    dealt = (
        with_shard(both, nulls, levels)
        .repartitionById(n, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
        .select("kind", "shard", "page_id", "url", "html", "digest", "keeper")
    )
    dealt.mapInArrow(_writer(f"{folder}/data", roll_bytes), MANIFEST).write.parquet(f"{folder}/manifest")
    left = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/data/_temporary-*")
    store = left.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in store.globStatus(left) or []:
        store.delete(found.getPath(), False)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, one gzip member at a time; memory is bounded by a record."""
    unpacker, out, data = zlib.decompressobj(31), io.BytesIO(), b""
    while True:
        if not data:
            data = stream.read(chunk)
            if not data:
                if out.tell():
                    raise ValueError("archive ends within a record")
                return
        out.write(unpacker.decompress(data))
        data = unpacker.unused_data
        if unpacker.eof:
            yield out.getvalue()
            unpacker, out = zlib.decompressobj(31), io.BytesIO()
        elif not data:
            data = b""


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.partition(": ")[::2] for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def _reader(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for data in members(stream):
                        fields, block = parse(data)
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        n = int(http.rpartition(b"Content-Length: ")[2])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{file}: the payload of page {fields['X-Page-ID']} does not match its digest")
                        to = fields.get("X-Refers-To-Page")
                        page = fields["X-Page-ID"]
                        rows.append((int(page) if page else None, fields.get("WARC-Target-URI"), kind, int(to) if to else None, n, digest, payload if with_payload and kind == "response" else None))
                        size += len(data) if with_payload else 200
                        if size > 16 << 20:
                            yield _rows(rows)
                            rows, size = [], 0
                if rows:
                    yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the committed files. A revisit's payload is its response's."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    n = max(1, min(manifest.count(), 100_000))
    return manifest.select("file").repartition(n, "file").mapInArrow(_reader(f"{folder}/data", with_payload), READ)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), folder)
    return read(spark, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
k AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS keeper,
             row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS place FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND place > 1 THEN keeper END AS refers_to
FROM k
"""

QUERIES = {"op7_warc": op7_warc}
ORACLE_SQL = {"op7_warc": ORACLE}
