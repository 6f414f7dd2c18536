"""Edit-aware token counts: a segment tree of pre-token runs per document, kept.

A document is cut into leaves of about ``LEAF`` characters that begin at white
space, at a digit, or at a mark behind a letter or digit: places where the
vocabulary never merges, so a leaf's count does not depend on its neighbours and a
document's count is the root of a segment tree of leaf counts. ``build`` encodes every
text once and writes lengths and counts of the leaves beside it; that table is kept.

An edit re-encodes the leaves it touches, and a neighbour where the edit touches the
place at which they part (two pre-tokens may now meet there); the new text goes to the
first of them, the others become empty, and the sums on the paths to the root are
updated. A leaf that has grown over ``LARGEST`` characters is cut again, alone. All
else stays as counted: nothing encodes a whole text again. A stretch without any such
place is one leaf, since its ids cannot be counted apart.

Edits are (start, end, text) in code points of the original text, end exclusive.
Defined cases: offsets are clipped to the text, null parts count as 0 or empty;
edits are applied from the last to the first by (start, end, position in the
list), so none moves another's offsets, and where edits overlap the one that
begins earlier cuts only what is left; a null text is empty; no edits leave the
counts; repeated rows are counted each for itself; an empty table gives an empty
result; kept columns that are named like an output give way to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, small_batches, table, text_of
from .tokens import default_path, word_bpe

LEAF = 512
#: A leaf that grows over so many characters is cut again.
LARGEST = 8 * LEAF
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"


#: Where a leaf may begin. A mark behind a mark could be one pre-token with it.
_CUT = re.compile(r"[ \n0-9]|(?<=[A-Za-z0-9])[.,;:!?]")
_MARKS = ".,;:!?"


def cuts_of(text: str, leaf: int = LEAF) -> list[int]:
    """Starts of the leaves: 0 and the first possible place after each full leaf."""
    starts = [0]
    while found := _CUT.search(text, starts[-1] + leaf):
        starts.append(found.start())
    return starts


class TokenTree:
    def __init__(self, lengths: list[int], counts: list[int]):
        self.build(lengths, counts)

    def build(self, lengths: list[int], counts: list[int]) -> None:
        self.size = 1
        while self.size < len(counts):
            self.size *= 2
        self.leaves = len(counts)
        self.counts = [0] * self.size + counts + [0] * (self.size - len(counts))
        self.chars = [0] * self.size + lengths + [0] * (self.size - len(counts))
        for k in range(self.size - 1, 0, -1):
            self.counts[k] = self.counts[2 * k] + self.counts[2 * k + 1]
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]

    @classmethod
    def of(cls, text: str, count) -> "TokenTree":
        parts = parts_of(text)
        return cls([len(p) for p in parts], [count(p) for p in parts])

    def kept(self) -> tuple[list[int], list[int]]:
        """Lengths and counts of the leaves."""
        return self.chars[self.size : self.size + self.leaves], self.counts[self.size : self.size + self.leaves]

    @property
    def total(self) -> int:
        return self.counts[1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """Leaf that holds a character (the last one at the end), and its start."""
        k, start = 1, 0
        while k < self.size:
            k *= 2
            if place >= start + self.chars[k] and self.chars[k + 1]:
                start += self.chars[k]
                k += 1
        return k - self.size, start

    def put(self, leaf: int, chars: int, count: int) -> None:
        k = leaf + self.size
        self.chars[k], self.counts[k] = chars, count
        while k > 1:
            k //= 2
            self.counts[k] = self.counts[2 * k] + self.counts[2 * k + 1]
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]

    def replace(self, text: str, start: int, end: int, new: str, count) -> tuple[str, int]:
        """The text after the edit, and the characters that were encoded again."""
        first, at = self.leaf_at(start)
        if start <= at and at > 0:
            first, at = self.leaf_at(at - 1)
        last, there = self.leaf_at(max(end - 1, start)) if end > start else self.leaf_at(start)
        stop = there + self.chars[last + self.size]
        while end >= stop and stop < len(text) and text[stop] in _MARKS:
            last, there = self.leaf_at(stop)
            stop = there + self.chars[last + self.size]
        # White space and digits stand alone whatever comes before them, so the next leaf stays.
        region = text[at:start] + new + text[end:stop]
        if len(region) > LARGEST:
            parts = parts_of(region)
            lengths, counts = self.kept()
            lengths[first : last + 1] = [len(p) for p in parts]
            counts[first : last + 1] = [count(p) for p in parts]
            self.build(lengths, counts)
        else:
            self.put(first, len(region), count(region))
            for leaf in range(first + 1, last + 1):
                if self.chars[leaf + self.size]:
                    self.put(leaf, 0, 0)
        return text[:start] + new + text[end:], len(region)


def parts_of(text: str) -> list[str]:
    starts = cuts_of(text)
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]


def edited(text: str, tree: TokenTree, edits: list[dict] | None, count) -> dict:
    """The text and its tree after ``edits``, and what was encoded for them."""
    out = {"n_before": tree.total, "n_leaves": tree.leaves, "n_encoded": 0}
    limit = len(text)
    clip = lambda v, default: min(max(default if v is None else v, 0), len(text))
    spots = sorted(((clip(e["start"], 0), clip(e["end"], 0), i, e["text"] or "") for i, e in enumerate(edits or []) if e), reverse=True)
    for start, end, _, new in spots:
        text, n = tree.replace(text, start, max(min(end, limit), start), new, count)
        out["n_encoded"] += n
        limit = start
    lengths, counts = tree.kept()
    return out | {"n_after": tree.total, "text": text, "lengths": lengths, "counts": counts}


TREE = "tree struct<lengths:array<int>,counts:array<int>>"
TREE_ARROW = pa.struct([("lengths", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
OUT = f"n_before bigint, n_after bigint, n_leaves bigint, n_encoded bigint, edited_text string, {TREE}"


def _counting(path: str):
    bpe = word_bpe(path)
    width = bpe.dtype.itemsize
    return lambda part: len(bpe.encode(part)) // width


def _builder(path: str):
    """The last column is the text; its tree is added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counting(path)
        for batch in batches:
            trees = [dict(zip(("lengths", "counts"), TokenTree.of(t.as_py() or "", count).kept(), strict=True)) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(trees, TREE_ARROW)], names=[*batch.schema.names, "tree"])

    return run


def build(docs: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None) -> DataFrame:
    """``keep`` columns, ``text`` and ``tree`` (lengths and counts of its leaves): the table to keep."""
    small_batches(docs.sparkSession)
    keep = [c for c in keep if c not in ("text", "tree")]
    given = docs.select(*keep, F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([*given.schema.fields, *T._parse_datatype_string(TREE).fields])
    return given.mapInArrow(_builder(path or default_path()), schema)


def _editor(path: str, columns: list[str], with_text: bool):
    """Columns, text, tree, edits in."""
    names = ["n_before", "n_after", "n_leaves", "n_encoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counting(path)
        for batch in batches:
            given = zip(*(batch.column(len(columns) + i) for i in range(3)), strict=True)
            rows = [edited(t.as_py() or "", TokenTree(k["lengths"].as_py(), k["counts"].as_py()), e.as_py(), count) for t, k, e in given]
            kept = [batch.column(i) for i in range(len(columns))]
            texts = pa.array([r["text"] if with_text else None for r in rows], pa.string())
            trees = pa.array([{"lengths": r["lengths"], "counts": r["counts"]} if with_text else None for r in rows], TREE_ARROW)
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array([r[n] for r in rows], pa.int64()) for n in names), texts, trees], names=[*columns, *names, "edited_text", "tree"])

    return run


def count_edited(trees: DataFrame, edits: Column, keep: list[str], path: str | None = None, with_text: bool = True) -> DataFrame:
    """``keep`` columns of a kept table (of ``build``), counts before and after ``edits`` (a
    column of EDITS), leaves before, characters encoded, the edited text and its tree, to
    be kept in turn. Without ``with_text`` the last two are null."""
    names = {"n_before", "n_after", "n_leaves", "n_encoded", "edited_text", "tree"}
    keep = [c for c in keep if c not in names]
    given = trees.select(*keep, F.col("text").alias("__text"), F.col("tree").alias("__tree"), edits.cast(EDITS).alias("__edits"))
    schema = T.StructType([*[trees.schema[c] for c in keep], *T._parse_datatype_string(OUT).fields])
    return given.mapInArrow(_editor(path or default_path(), keep, with_text), schema)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Joins an edit table (doc_id, start, end, text) as the column ``edits``."""
    listed = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "text"))).alias("edits"))
    return trees.join(listed, "doc_id", "left")


def sample_edits(text: Column, doc_id: Column) -> Column:
    """Three edits that follow from the id and the length: a cut near the start,
    a replacement in the middle, an insertion near the end."""
    n = F.length(text)
    spot = lambda part: F.floor(n * F.lit(part)).cast("long")
    edit = lambda at, size, new: F.struct(at.alias("start"), (at + size).alias("end"), new.alias("text"))
    return F.array(
        edit(spot(0.1), F.pmod(F.coalesce(doc_id, F.lit(0)), F.lit(17)), F.lit("")),
        edit(spot(0.5), F.lit(5), F.concat(F.lit(" edit "), F.coalesce(doc_id.cast("string"), F.lit("")))),
        edit(spot(0.9), F.lit(0), F.lit("end-mark")),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = materialize(build(table(spark, sf_dir, "documents"), ["doc_id"]), "token-trees", "zstd")
    edits = sample_edits(text_of(), F.col("doc_id"))
    return count_edited(trees, edits, ["doc_id"], with_text=False).drop("edited_text", "tree")


QUERIES = {"op10_token_counts": op10_token_counts}
ORACLE_SQL: dict[str, str] = {}
