"""Trees: Newick text as rows and back, labels, layout, and a distance tree.

Trees have one tip per genotype, so the codec and the layout work on one tree at
a time; many trees are rows of a table and run in parallel through ``node_rows`` and ``layout_rows``
(or, for a text at hand, the table functions). Nodes of these are numbers in arrays, put out in batches.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from ..functions import sequence
from ..schemas import TREE
from .cluster import linkage


@dataclass
class Node:
    name: str | None = None
    length: float | None = None
    support: float | None = None
    children: list["Node"] = field(default_factory=list)

    def tips(self) -> list["Node"]:
        out, work = [], [self]
        while work:
            node = work.pop()
            if node.children:
                work.extend(reversed(node.children))
            else:
                out.append(node)
        return out


def _tokens(text: str) -> Iterator[tuple[str, str | float | None]]:
    """The signs of a Newick text, lengths (':') and labels ('n'), without comments."""
    at, n = 0, len(text)
    while at < n:
        c = text[at]
        if c in "(,)":
            yield c, None
            at += 1
        elif c == ";":
            return
        elif c == "[":
            at = text.index("]", at) + 1
        elif c == ":":
            end = at + 1
            while end < n and text[end] not in ",();[":
                end += 1
            yield c, float(text[at + 1 : end])
            at = end
        elif c.isspace():
            at += 1
        elif c == "'":
            end, name = at + 1, ""
            while True:
                stop = text.index("'", end)
                name += text[end:stop]
                if text[stop + 1 : stop + 2] != "'":
                    break
                name, end = name + "'", stop + 2
            yield "n", name
            at = stop + 1
        else:
            end = at
            while end < n and text[end] not in ",():;[":
                end += 1
            yield "n", text[at:end].strip()
            at = end


class Flat:
    """A tree as arrays, parents before children: some 50 bytes a node and its name."""

    LENGTH, SUPPORT, NAME, INNER = 1, 2, 4, 8

    def __init__(self):
        self.parent, self.length, self.support = array("q"), array("d"), array("d")
        self.marks, self.names, self.starts, self.ends = bytearray(), bytearray(), array("q"), array("q")

    def add(self, parent: int) -> int:
        if parent >= 0:
            self.marks[parent] |= self.INNER
        self.parent.append(parent)
        self.length.append(0.0)
        self.support.append(0.0)
        self.starts.append(0)
        self.ends.append(0)
        self.marks.append(0)
        return len(self.parent) - 1

    def set_length(self, node: int, length: float) -> None:
        self.length[node] = length
        self.marks[node] |= self.LENGTH

    def set_support(self, node: int, support: float) -> None:
        self.support[node] = support
        self.marks[node] |= self.SUPPORT

    def set_name(self, node: int, name: str) -> None:
        self.starts[node] = len(self.names)
        self.names += name.encode()
        self.ends[node] = len(self.names)
        self.marks[node] |= self.NAME

    def name_of(self, node: int) -> str | None:
        return self.names[self.starts[node] : self.ends[node]].decode() if self.marks[node] & self.NAME else None

    def length_of(self, node: int) -> float | None:
        return self.length[node] if self.marks[node] & self.LENGTH else None

    def support_of(self, node: int) -> float | None:
        return self.support[node] if self.marks[node] & self.SUPPORT else None

    def is_tip(self, node: int) -> bool:
        return not self.marks[node] & self.INNER


def parse(text: str) -> Node:
    """A Newick tree; quoted names, comments in brackets, support values on inner nodes."""
    root = Node()
    stack, node = [], root
    for sign, value in _tokens(text):
        if sign == "(":
            child = Node()
            node.children.append(child)
            stack.append(node)
            node = child
        elif sign == ",":
            if not stack:
                raise ValueError("comma outside of a group")
            node = Node()
            stack[-1].children.append(node)
        elif sign == ")":
            if not stack:
                raise ValueError("unbalanced ')'")
            node = stack.pop()
        elif sign == ":":
            node.length = value
        else:
            support = _number(value) if node.children else None
            if support is not None:
                node.support = support
            else:
                node.name = value
    if stack:
        raise ValueError("unbalanced '('")
    return root


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def flat(text: str) -> Flat:
    """The tree of ``parse`` as arrays."""
    out = Flat()
    node, stack = out.add(-1), []
    for sign, value in _tokens(text):
        if sign == "(":
            stack.append(node)
            node = out.add(node)
        elif sign == ",":
            if not stack:
                raise ValueError("comma outside of a group")
            node = out.add(stack[-1])
        elif sign == ")":
            if not stack:
                raise ValueError("unbalanced ')'")
            node = stack.pop()
        elif sign == ":":
            out.set_length(node, value)
        else:
            support = None if out.is_tip(node) else _number(value)
            if support is not None:
                out.set_support(node, support)
            else:
                out.set_name(node, value)
    if stack:
        raise ValueError("unbalanced '('")
    return out


def _flat_of(root: Node) -> Flat:
    out, work = Flat(), [(root, -1)]
    while work:
        node, parent = work.pop()
        k = out.add(parent)
        if node.length is not None:
            out.set_length(k, node.length)
        if node.support is not None:
            out.set_support(k, node.support)
        if node.name is not None:
            out.set_name(k, node.name)
        work.extend((c, k) for c in reversed(node.children))
    return out


def _quoted(name: str) -> str:
    return "'" + name.replace("'", "''") + "'" if any(c in " ,():;[]'" for c in name) else name


def write(node: Node) -> str:
    def one(x: Node) -> str:
        inner = f"({','.join(map(one, x.children))})" if x.children else ""
        label = f"{x.support:g}" if x.children and x.support is not None else _quoted(x.name) if x.name else ""
        return inner + label + (f":{x.length:g}" if x.length is not None else "")

    return one(node) + ";"


def _nodes(t: Flat) -> Iterator[tuple]:
    """Rows of TREE."""
    for k, parent in enumerate(t.parent):
        yield k, parent if parent >= 0 else None, t.length_of(k), t.support_of(k), t.name_of(k), t.is_tip(k)


def _places(t: Flat, min_support: float) -> Iterator[tuple]:
    """V7: name, x, y, is_tip, support of each node, children before parents."""
    n = len(t.parent)
    x, y, low, high = np.zeros(n), np.zeros(n), np.full(n, np.inf), np.full(n, -np.inf)
    place = 0
    for k, parent in enumerate(t.parent):
        # The root stands at 0 whatever its length.
        x[k] = (x[parent] if parent >= 0 else -t.length[k]) + t.length[k]
        if t.is_tip(k):
            y[k], place = place, place + 1
    for k in range(n - 1, -1, -1):
        if not t.is_tip(k):
            y[k] = (low[k] + high[k]) / 2
        parent = t.parent[k]
        if parent >= 0:
            low[parent], high[parent] = min(low[parent], y[k]), max(high[parent], y[k])

    def row(k: int) -> tuple:
        support = t.support_of(k)
        return t.name_of(k), float(x[k]), float(y[k]), t.is_tip(k), support if (support or 0) >= min_support else None

    open_: list[int] = []
    for k, parent in enumerate(t.parent):
        while open_ and open_[-1] != parent:
            yield row(open_.pop())
        open_.append(k)
    while open_:
        yield row(open_.pop())


LAYOUT = "name string, x double, y double, is_tip boolean, support double"
#: Nodes in a batch.
BATCH = 1 << 14


def _by_tree(trees: DataFrame, keep: list[str], rows, fields: list[T.StructField]) -> DataFrame:
    """The columns ``keep`` of each tree with its rows, a batch at a time."""
    schema = T.StructType([*(trees.schema[c] for c in keep), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32()}
        for batch in batches:
            for i in range(batch.num_rows):
                text, found = batch.column(len(keep))[i].as_py(), []
                if text is None:
                    continue

                def put() -> pa.RecordBatch:
                    mine = [batch.column(c).take(pa.array(np.full(len(found), i))) for c in range(len(keep))]
                    return pa.RecordBatch.from_arrays([*mine, *(pa.array(v, kinds[f.dataType.simpleString()]) for v, f in zip(zip(*found, strict=True), fields, strict=True))], names=schema.names)

                for row in rows(flat(text)):
                    found.append(row)
                    if len(found) == BATCH:
                        yield put()
                        found = []
                if found:
                    yield put()

    return trees.select(*keep, "text").mapInArrow(run, schema)


def node_rows(trees: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and TREE of the trees with a ``text``."""
    return _by_tree(trees, [*keep], _nodes, TREE.fields)


def layout_rows(trees: DataFrame, *keep: str, min_support: float = 70.0) -> DataFrame:
    """V7 for trees that are rows of a table: ``keep`` and where the nodes of each ``text`` stand."""
    return _by_tree(trees, [*keep], lambda t: _places(t, min_support), T._parse_datatype_string(LAYOUT).fields)


@udtf(returnType=TREE)
class newick_nodes:  # noqa: N801
    """Rows of a tree, parents before children."""

    def eval(self, text: str):
        if text is not None:
            yield from _nodes(flat(text))


@udtf(returnType=LAYOUT)
class newick_layout:  # noqa: N801
    """V7 for one text: where the nodes stand."""

    def eval(self, text: str, min_support: float):
        if text is not None:
            yield from _places(flat(text), min_support)


def relabelled(tips: DataFrame, taxonomy: DataFrame, label: str = "consensus_group_sp", name: str = "name") -> DataFrame:
    """The label of a tip by its own name, else by its base name, else unchanged."""
    labels = taxonomy.where(F.col(label).isNotNull()).groupBy(F.col("consensus_group").alias("g")).agg(F.min(label).alias("l"))
    base = labels.groupBy(sequence.base_group(F.col("g")).alias("b")).agg(F.min("l").alias("bl"))
    out = tips.join(labels, F.col(name) == F.col("g"), "left").join(base, sequence.base_group(F.col(name)) == F.col("b"), "left")
    return out.withColumn("label", F.coalesce("l", "bl", name)).drop("g", "l", "b", "bl")


def relabel_newick(text: str, labels: dict[str, str]) -> str:
    """The tree with its tips renamed; used for one tree's file."""
    import re

    root = parse(text)
    short = {re.sub(r"_n\d+$", "", k): v for k, v in labels.items()}
    for tip in root.tips():
        tip.name = labels.get(tip.name or "", short.get(re.sub(r"_n\d+$", "", tip.name or ""), tip.name))
    return write(root)


def layout(root: Node, min_support: float = 70.0) -> list[dict]:
    """V7: x is the depth, y the leaf's place or the middle of the children."""
    return [dict(zip(("name", "x", "y", "is_tip", "support"), row, strict=True)) for row in _places(_flat_of(root), min_support)]


def distance_tree(ids: list[str], d: np.ndarray, method: str = "average") -> Node:
    """A linkage tree of a few sequences; not a likelihood tree, and named so."""
    nodes = [Node(name=i, length=0.0) for i in ids]
    heights = [0.0] * len(ids)
    for a, b, h, _ in linkage(d, method):
        for k in (a, b):
            nodes[k].length = h / 2 - heights[k]
        nodes.append(Node(children=[nodes[a], nodes[b]], length=None))
        heights.append(h / 2)
    return nodes[-1]


def with_outgroup(ingroup: DataFrame, outgroup: DataFrame) -> DataFrame:
    """Ingroup records first."""
    a = ingroup.withColumn("part", F.lit(0))
    return a.unionByName(outgroup.withColumn("part", F.lit(1))).orderBy("part", "ord").drop("part")


def tree_rows(spark: SparkSession, text: str) -> DataFrame:
    return newick_nodes(F.lit(text))
