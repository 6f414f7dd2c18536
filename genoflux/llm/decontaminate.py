"""Benchmark decontamination by one Aho-Corasick automaton over item windows.

Texts are normalised as bytes: A-Z lower-cased, every ASCII byte that is neither
digit nor letter a separator, bytes of other characters kept; words are joined
by single spaces. A window is 13 consecutive words of an item (the whole item
if it is shorter). The automaton holds all windows; each text is scanned once,
and word numbers lead back to code-point offsets of the original text.

The windows are made, combined and counted on the executors and written once to the
shared folder. An automaton has to fit a worker's memory, so it holds at most
``block_windows`` of them (some 0.5 GB): the windows are dealt by hash to as many
automata as that takes, one for every benchmark of usual size. Windows are broadcast as
compressed text, a thirtieth of an automaton, with the different lists of items once each. The
text is read once: a worker holds some TURN bytes of it while each automaton is built, passes over
them and goes, so it has one automaton at a time whatever the benchmark's size.

Defined cases: null texts have no words and no hits; null or wordless items
match nothing; repeated item rows count once; repeated documents are judged
each for itself; an empty benchmark leaves every document clean; an empty table gives
an empty result. Kept columns named ``n_words``, ``hit_spans`` or ``hit_items`` give
way to the results; other columns may have any name.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import enter, materialize, scratch, small_batches, table

WORDS_PER_WINDOW = 13
#: Windows in one automaton at most: about 0.5 GB of nodes.
BLOCK_WINDOWS = 200_000
#: Bytes of text that each of several automata scans before the next takes its turn.
TURN = 64 << 20
#: A contaminated document has at least one hit word in this many words.
SHARE = 20

_SEPARATOR = 0x20
NORMAL = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else _SEPARATOR for b in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def windows_of(text: str | None, width: int = WORDS_PER_WINDOW) -> list[str]:
    """An item's windows: space-joined words with a space at both ends, bytes as Latin-1."""
    words = words_of(text)
    return [(b" %s " % b" ".join(words[i : i + width])).decode("latin-1") for i in range(max(len(words) - width, 0) + 1 if words else 0)]


def _windower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = list(dict.fromkeys(windows_of(text)))
            for at in range(0, len(found), 10_000):
                part = found[at : at + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([item_id] * len(part), pa.string())], names=["window", "item_id"])


def packed(windows: list[tuple[str, int]]) -> bytes:
    """Windows and the numbers of their item lists, a line each; windows hold no tab or line break."""
    return zlib.compress("\n".join(f"{w}\t{g}" for w, g in windows).encode("latin-1"), 1)


_built: dict[str, object] = {}


def automaton_of(block: bytes, lists: dict[int, list[str]], key: str):
    """Built when a Python worker needs it; the worker keeps the last one alone."""
    enter("decontaminate", _built.clear)
    if key not in _built:
        import ahocorasick

        _built.clear()
        automaton = ahocorasick.Automaton()
        for line in zlib.decompress(block).decode("latin-1").split("\n") if block else ():
            window, _, number = line.rpartition("\t")
            if window:
                automaton.add_word(window, (window.count(" ") - 1, lists[int(number)]))
        automaton.make_automaton()
        _built[key] = automaton
    return _built[key]


def scan_text(text: str | None, automaton) -> tuple[int, list[tuple[int, int]], list[str]]:
    """Number of words, merged hit ranges [first word, last word + 1), sorted item ids."""
    words = words_of(text)
    if not words or not len(automaton):
        return len(words), [], []
    line = f" {b' '.join(words).decode('latin-1')} "
    hits, items = [], set()
    for end, (n, ids) in automaton.iter(line):
        hits.append((end, n))
        items.update(ids)
    if not hits:
        return len(words), [], []
    ends = {}
    at = -1
    for k in range(len(words) + 1):  # the k-th space stands before word k
        at = at + 1 if k == 0 else at + len(words[k - 1]) + 1
        ends[at] = k
    return len(words), union((ends[end] - n, ends[end]) for end, n in hits), sorted(items)


def union(ranges) -> list[tuple[int, int]]:
    """Ranges that overlap or touch, joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as code-point ranges of the text as it was."""
    if not ranges:
        return []
    spots = [m.span() for m in WORD.finditer(text)]
    return [{"start": spots[a][0], "end": spots[b - 1][1], "first_word": a, "end_word": b} for a, b in ranges]


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
SPAN_SQL = "array<struct<start:bigint,end:bigint,first_word:bigint,end_word:bigint>>"
FOUND = ["n_words", "hit_spans", "hit_items"]


def _turns(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches held together until they have ``size`` bytes."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _scanner(held, key: str, blocks: int):
    """The text is the last column; FOUND takes its place. With several blocks each in turn
    scans some TURN bytes of text, so a worker has one automaton at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs, lists = held.value
        for turn in _turns(batches, TURN if blocks > 1 else 0):
            texts = [x.as_py() for batch in turn for x in batch.column(batch.num_columns - 1)]
            counts, ranges, items = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
            for block in range(blocks):
                automaton = automaton_of(packs[block], lists, f"{key}-{block}")
                for k, text in enumerate(texts):
                    counts[k], more, ids = scan_text(text, automaton)
                    if more:
                        ranges[k] = union([*ranges[k], *more]) if ranges[k] else more
                        items[k] = sorted({*items[k], *ids}) if items[k] else ids
            at = 0
            for batch in turn:
                part = slice(at, at + batch.num_rows)
                at += batch.num_rows
                spans = [original_spans(text, r) for text, r in zip(texts[part], ranges[part], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(counts[part], pa.int64()), pa.array(spans, pa.list_(SPAN)), pa.array(items[part], pa.list_(pa.string()))],
                    names=[*batch.schema.names[:-1], *FOUND],
                )

    return run


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: list[str] | None = None, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``keep`` columns (all by default) plus n_words, hit_spans and hit_items."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    with scratch(spark):
        windows = rows.mapInArrow(_windower, "window string, item_id string").groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        windows = materialize(windows.withColumn("list", F.xxhash64("items", F.size("items"))), "windows")
        blocks = max(-(-windows.count() // block_windows), 1)
        # Windows of one passage share their list of items, which comes once.
        lists = {r["list"]: r["items"] for r in windows.groupBy("list").agg(F.first("items").alias("items")).collect()}
        packs = []
        for k in range(blocks):
            mine = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).select("window", "list").orderBy("window").collect()
            packs.append(packed([(r["window"], r["list"]) for r in mine]))
    held = spark.sparkContext.broadcast((packs, lists))
    columns = [c for c in (docs.columns if keep is None else keep) if c not in FOUND]
    given = docs.select(*columns, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__scanned"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("n_words", T.LongType()), *T._parse_datatype_string(f"hit_spans {SPAN_SQL}, hit_items array<string>").fields])
    return given.mapInArrow(_scanner(held, uuid.uuid4().hex, blocks), schema)


def judged(scanned: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated: hit words are at least a twentieth of all."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end_word"] - s["first_word"])
    return scanned.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(SHARE) * F.col("n_hit") >= F.col("n_words"))
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark")
    return judged(scan(docs, benchmark, keep=["doc_id"])).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
i AS (SELECT DISTINCT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), {WORDS_PER_WINDOW}) AS n, array_to_string(list_slice(w, p, p + least(len(w), {WORDS_PER_WINDOW}) - 1), ' ') AS x
  FROM i, unnest(range(1, greatest(len(w) - {WORDS_PER_WINDOW} + 1, 1) + 1)) AS r(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT u, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS x
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(p) WHERE len(w) >= n),
hit AS (SELECT DISTINCT u, p, n, item_id FROM place JOIN win USING (n, x)),
covered AS (SELECT u, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT u, p, n FROM hit), unnest(range(p, p + n)) AS r(q) GROUP BY u),
items AS (SELECT u, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS joined FROM (SELECT DISTINCT u, item_id FROM hit) GROUP BY u)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (u) LEFT JOIN items USING (u)
"""

QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLE_SQL = {"op2_decontaminate": ORACLE}
