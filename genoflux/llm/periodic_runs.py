"""Periodic runs of words: stretches that repeat with a period, and the text without repeats.

Words are named by Karp, Miller and Rosenberg: the name at level k of a place is the
rank of the 2^k words from there among all such blocks, from sorted pairs of names of
the level below. Two places have the same 2^k words just if their names agree, so
nothing is hashed and no suffix is sorted. How far two places agree (their common
extension) takes the levels downwards, a block of each at most.

A run of period q and length n has n - q places that equal the word q further on. With
n >= max(24, 3q) this stretch holds a whole block of 2^k words that begins at a multiple
of 2^k, where 2^(k+1) - 1 <= max(24 - q, 2q). So for each period only these grid places
are candidates: one comparison of names each, some n a level. The first of neighbouring
candidates is extended in both directions, which gives the maximal run. If a
stretch has several periods of that kind, all are multiples of the smallest (Fine and
Wilf) and reach equally far, so the smallest is kept.

Each document is worked on by itself, in one task, without a shuffle; the names take
four bytes a word and level, and levels end where no block repeats.

Defined cases: a null text has no words; empty texts and those of under 24 words have no
run; a null id counts as the empty text for ``op12``'s rule; rows are independent, so
repeated ids, ties and extra columns (which are kept on request) change nothing.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: A run has at least so many words, and at least so many periods.
SHORTEST, PERIODS = 24, 3
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = "array<struct<start bigint, length bigint, period bigint>>"
OUT = f"n_words bigint, runs {RUNS}, collapsed string"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def _names(codes: np.ndarray) -> list[np.ndarray]:
    """Names of the blocks of 1, 2, 4, ... words; the last level is the first at which none repeats."""
    levels = [codes]
    while True:
        size, last = 1 << (len(levels) - 1), levels[-1]
        if len(last) <= size or int(last.max()) + 1 == len(last):
            return levels
        pair = last[:-size].astype(np.int64) * (int(last.max()) + 1) + last[size:]
        levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))


def _after(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """How many words from ``a`` on equal those from ``b`` on, where a < b."""
    far = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size = 1 << k
        # The names stop where blocks no longer fit; each level is used once, since above it nothing agrees.
        fits = np.flatnonzero(b + far + size <= n)
        same = fits[levels[k][(a + far)[fits]] == levels[k][(b + far)[fits]]]
        far[same] += size
    return far


def _before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before ``a`` equal those before ``b``, where a < b."""
    far = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size = 1 << k
        fits = np.flatnonzero(a - far - size >= 0)
        same = fits[levels[k][(a - far)[fits] - size] == levels[k][(b - far)[fits] - size]]
        far[same] += size
    return far


def _periods(k: int, n: int) -> range:
    """The periods whose candidates are blocks of level ``k``: at level 3 all below 16
    (their stretches have 17 places or more), above it 2^k to 2^(k+1) - 1."""
    return range(1 if k == 3 else 1 << k, min(2 << k, n // PERIODS + 1))


def runs_of(words: list[str]) -> np.ndarray:
    """All runs as rows (start, length, period), by start, then period."""
    n, none = len(words), np.zeros((0, 3), np.int64)
    if n < SHORTEST:
        return none
    different = dict.fromkeys(words)
    codes = np.fromiter(map(dict(zip(different, range(n), strict=False)).__getitem__, words), np.int32, n)
    levels = _names(codes)
    found = []
    for k in range(3, len(levels)):
        names, size = levels[k], 1 << k
        grid = names[::size]
        for q in _periods(k, n):
            ahead = names[q::size]
            hit = grid[: len(ahead)] == ahead
            if not hit.any():
                continue
            hit[1:] &= ~hit[:-1]
            at = np.flatnonzero(hit) * size
            found.append(np.stack([at, np.full(len(at), q)], 1))
    if not found:
        return none
    at, q = np.concatenate(found).T
    start = at - _before(levels, at, at + q)
    length = at + _after(levels, at, at + q, n) + q - start
    keep = length >= np.maximum(SHORTEST, PERIODS * q)
    rows = np.unique(np.stack([start, length, q], 1)[keep], axis=0)
    # Of equal stretches the smallest period stands first.
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for words that no run holds after its first period."""
    over = np.zeros(n + 1, np.int64)
    np.add.at(over, runs[:, 0] + runs[:, 2], 1)
    np.add.at(over, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(over)[:n] == 0


def best_of(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    best = None
    for s, n, q in runs.tolist():
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    return best


def repeated_tail(words: list[str], doc_id: str) -> list[str]:
    """``op12``'s rule: the tail of a tenth of the documents becomes periodic."""
    h, n = zlib.crc32(doc_id.encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _finder(columns: list[str]):
    """Columns, then a text: columns, n_words, runs, collapsed."""
    arrow = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts = [], [], []
            for text in batch.column(batch.num_columns - 1):
                words = words_of(text.as_py())
                rows = runs_of(words)
                keep = kept_words(len(words), rows)
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in rows.tolist()])
                texts.append(" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k))
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(runs, arrow), pa.array(texts, pa.string())], names=[*columns, "n_words", "runs", "collapsed"])

    return run


def find(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_words, runs (start, length, period in words), and the text
    with every run cut to its first period, its words joined by one space."""
    keep = [c for c in keep if c not in ("n_words", "runs", "collapsed")]
    given = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([*given.schema.fields[:-1], *T._parse_datatype_string(OUT).fields])
    return given.mapInArrow(_finder(keep), schema)


DIGEST = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def digest(words: list[str]) -> tuple:
    """The columns that ``op12`` returns, for the words of one document."""
    runs = runs_of(words)
    best = best_of(runs)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    if len(runs):
        keep = kept_words(len(words), runs)
        words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(words).encode()).hexdigest())


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGEST.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in DIGEST.split(", ")]
    for batch in batches:
        ids = batch.column(0).cast(pa.string())
        rows = [digest(repeated_tail(words_of(t.as_py()), i.as_py() or "")) for i, t in zip(ids, batch.column(1), strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_digester, T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(DIGEST).fields]))


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
#: Runs of words have no workable form in SQL; the tests hold the query against brute force.
ORACLE_SQL: dict[str, str] = {}
