"""Sequence packing: shortest-pack-first over the length histogram.

Each document becomes its token ids plus one end id. Full cuts of ``capacity``
ids are sequences of their own; the remainders are packed. Only their length
histogram (at most ``capacity`` rows, whatever the corpus holds) reaches the
driver. There lengths are placed longest first, always into the shortest open
pack that has room, as whole groups of equal packs: the state is a count per
packing pattern. Patterns go back to documents by rank: the r-th piece of a
length takes the r-th slot of that length.

Ranks come without gathering a length's rows in one task: rows are counted by
(length, salt), with as many salts as the length has rows in ROWS_PER_SALT, offsets
are running sums over those few counts, and a row's rank is its salt group's offset
plus its number within the group.

Ids move in 16 bits where the vocabulary allows it and leave in 32.

Defined cases: a null text is empty and becomes the end id alone; repeated rows
are packed each for itself (ties are ordered by all columns of the piece); an
empty table gives an empty result; ids of documents are cast to long; other columns
are not read. Every id lies in exactly one piece.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, small_batches, table
from .tokens import default_path, word_bpe

CAPACITY = 2048
END_ID = 1
ROWS_PER_SALT = 1_024

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids_crc32 bigint, ids binary"


def _cutter(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        end = np.array([end_id], dtype=bpe.dtype)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([np.frombuffer(bpe.encode(text.as_py() or ""), dtype=bpe.dtype), end])
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    row = (doc_id, start, len(piece), len(ids), zlib.crc32(piece.astype("<u4").tobytes()), piece.tobytes())
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    size += piece.nbytes
                if size > 8 << 20:
                    yield _pieces(out)
                    out, size = [[], [], [], [], [], []], 0
            if out[0]:
                yield _pieces(out)

    return run


def _pieces(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"]
    )


def cut(docs: DataFrame, text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` ids (little-endian, as wide as the vocabulary needs)
    with the checksum of the ids in 32 bits."""
    small_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(_cutter(path or default_path(), capacity, end_id), PIECES)


def patterns_of(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Shortest-pack-first: (lengths in a sequence, number of such sequences)."""
    room: dict[int, dict[tuple[int, ...], int]] = {}  # free space -> pattern -> count
    spaces: list[int] = []  # sorted keys of room
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            if spaces and spaces[-1] >= length:  # the most free space: the shortest pack
                space = spaces[-1]
                group = room[space]
                pattern, count = next(iter(group.items()))
                used = min(count, left)
                if used == count:
                    del group[pattern]
                    if not group:
                        del room[space]
                        spaces.pop()
                else:
                    group[pattern] = count - used
            else:
                pattern, space = (), capacity
                # as many packs as would take one such piece each; what is left over goes on in the next round
                used = -(-left // max(capacity // length, 1))
            grown, rest = (*pattern, length), space - length
            if rest not in room:
                room[rest] = {}
                bisect.insort(spaces, rest)
            room[rest][grown] = room[rest].get(grown, 0) + used
            left -= used
    return [(pattern, count) for space in sorted(room) for pattern, count in room[space].items()]


def slots_of(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, dict[str, np.ndarray]]:
    """By length: rank ranges with the first sequence and the offset of the slot."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    filled: dict[int, int] = {}
    first = 0
    for pattern, count in patterns:
        at = 0
        for length in pattern:
            slots.setdefault(length, []).append((filled.get(length, 0), first, at))
            filled[length] = filled.get(length, 0) + count
            at += length
        first += count
    return {k: dict(zip(("rank", "sequence", "offset"), np.array(v, dtype=np.int64).T, strict=True)) for k, v in slots.items()}


def _placer(slots: dict[int, dict[str, np.ndarray]], columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, max(whole.num_rows, 1), 1024):
                batch = whole.slice(begin, 1024)
                length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
                rank = batch.column(batch.schema.get_field_index("rank")).to_numpy(zero_copy_only=False)
                sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
                for one in np.unique(length):
                    here, s = length == one, slots[int(one)]
                    k = np.searchsorted(s["rank"], rank[here], side="right") - 1
                    sequence[here] = s["sequence"][k] + rank[here] - s["rank"][k]
                    offset[here] = s["offset"][k]
                kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
                if "ids" in columns:
                    at = columns.index("ids")
                    kept[at] = pa.array([_wide(x.as_py(), n) for x, n in zip(kept[at], length, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    return run


def _wide(ids: bytes, length: int) -> bytes:
    return ids if len(ids) == 4 * length else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def ranked(pieces: DataFrame, counts: list[tuple[int, int]]) -> DataFrame:
    """Adds ``rank`` from 0 within each length, and drops nothing.

    ``counts``: (length, rows), one for each length. Rows, counts and ranks meet by
    (length, salt), so one shuffle serves all.
    """
    spark = pieces.sparkSession
    # At most ``capacity`` pairs of numbers are broadcast.
    salts = spark.createDataFrame([(k, -(-n // ROWS_PER_SALT)) for k, n in counts], "length bigint, __salts bigint")
    of_row = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.col("__salts"))
    salted = pieces.join(F.broadcast(salts), "length").withColumn("__salt", of_row).drop("__salts")
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "__salt").count().select("length", "__salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("length", "__salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (
        salted.withColumn("__n", F.row_number().over(within).cast("long"))
        .join(offsets.hint("merge"), ["length", "__salt"])
        .withColumn("rank", F.col("__before") + F.col("__n") - 1)
        .drop("__salt", "__n", "__before")
    )


def pack(docs: DataFrame, text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32, ids, sequence_id, offset: one row per piece.

    The pieces are written once to the shared folder: their histogram and their
    places both read that copy, so the tokenizer runs once. Without ``with_ids`` the
    ids are neither written nor moved, only their checksum.
    """
    made = cut(docs, text_col, path, capacity, end_id)
    pieces = materialize(made if with_ids else made.drop("ids"), "pieces", compression="zstd")
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = slots_of(patterns_of(histogram, capacity))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked(pieces, sorted(histogram.items())).mapInArrow(_placer(slots, pieces.columns), schema)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, with_ids=False)


QUERIES = {"op3_packing": op3_packing}
ORACLE_SQL: dict[str, str] = {}
