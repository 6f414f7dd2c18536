"""N-gram Jaccard join with signature trees, exact, without all-pairs work.

A document's set: its distinct shingles as 64-bit fingerprints. Two documents
link when ``100 * |A and B| >= 85 * |A or B|``. Steps:

1. One pass over the texts: set size, a 128-bit fingerprint of the whole set,
   min-hash keys, and the tokens that a prefix (below) can need. Documents of
   equal sets are one class, its smallest id the representative; copies are never
   expanded.
2. Star links: every class meets one class, the smallest id among those that share
   a key with it, and the pair is verified on the full sets. A group of thousands of
   near copies costs one pair per member here. Components of the true links are
   labels.
3. Completion, which loses no link: linked sets share a token within their
   prefixes (the first ``n - ceil(0.85 n) + 1`` tokens in any fixed order). The
   order: a fixed part of all fingerprints comes first (the sampled tokens, some 1.6
   prefixes of them per set), among them by the number of classes that hold them,
   counted exactly. So a set with a prefix of tokens that nobody else holds meets no
   one, and goes no further. Only tokens that are met by classes of different labels
   go on; large groups are dealt into pairs of blocks. In each group a signature
   tree is built: nodes hold OR-combined token bitmaps, size and label ranges, and a
   dual traversal drops node pairs whose greatest possible overlap is too small or
   that hold a single label.
4. Surviving pairs are verified on the full sets; components of all true links
   are the result.

Steps 2 and 3 leave out pairs of a component that is known by then: they give exact
components, not every link. The number of links is counted afterwards, inside each
component (a link never leaves it): its classes are dealt into pairs of blocks, and
in each the trees are met and the sets compared. What comes out is a count per class
and pair of blocks, not the pairs.

Hot groups: copies, keys, heads and tokens that very many rows share are combined
before they are shuffled, and their totals are written before rows join to them, so
that both sides of such a join are plain exchanges, whose large partitions Spark splits.

Orders and samples affect speed alone. Fingerprints are 64 bits wide: within a
pair of sets a false match has a chance of about |A||B| / 2^64.

Defined cases: null texts and texts without words have empty sets and link with
nothing; fewer words than a shingle make one shingle; rows that share an id are
one node of the links (each keeps its own size); a row with a null id keeps a
null component and links with nothing; an empty table gives an empty result; other
columns are not read. Ids are cast to long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, enter, materialize, release, small_batches, table

SHINGLE, PERCENT = 4, 85
#: Min-hash keys of a set, and minima in each.
KEYS, ROWS = 6, 3
BITS = 2048
#: Tokens kept of a set, in prefixes: so many have their holders counted.
SAMPLED = 1.6
#: Rows in a block of a token's group; sets in a block of a component.
BLOCK, SETS = 1_500, 256
FANOUT = 8
#: A group of so many rows is a single leaf of its tree.
LEAF = 32
#: Ids are filtered by so many hash buckets before texts are shuffled; so many numbers are broadcast at most.
BUCKETS = 1 << 18

_U = np.uint64
_R = 0x9E3779B97F4A7C15  # odd
_R_INVERSE = pow(_R, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_NORMAL = bytes(0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            steps = np.full(size, _R, dtype=np.uint64)
            steps[0] = 1
            cls.up = np.multiply.accumulate(steps)
            steps = np.full(size, _R_INVERSE, dtype=np.uint64)
            steps[0] = 1
            cls.down = np.multiply.accumulate(steps)
        return cls.up, cls.down


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted set of fingerprints of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL)
    if not raw or raw.isspace():
        return np.zeros(0, dtype=np.uint64)
    a = np.frombuffer(b" " + raw + b" ", dtype=np.uint8)
    edge = np.flatnonzero(np.diff(a != 32))
    start, end = edge[0::2] + 1, edge[1::2] + 1
    up, down = _Powers.of(len(a) + 1)
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[a] * up[: len(a)], out=sums[1:])
    words = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    k = min(width, len(words))
    out = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        out = out * _U(0x2545F4914F6CDD1D) + words[j : len(words) - k + 1 + j] * _PLACE[j]
    return np.unique(mixed(out))


def needed(a, b, percent: int = PERCENT):
    """The smallest overlap of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def sample_limit(percent: int) -> int:
    """Sampled tokens have their leading 48 bits below this."""
    return min(int(SAMPLED * (100 - percent) / 100 * (1 << 48)), 1 << 48)


def keys_of(s: np.ndarray) -> np.ndarray:
    """Min-hash keys by one permutation: the least token of each residue class (an
    empty class takes the next one's), ROWS of them to a key."""
    n = KEYS * ROWS
    first = np.full(n, -1, dtype=np.int64)
    first[(s[::-1] % _U(n)).astype(np.int64)] = np.arange(len(s))[::-1]
    held = np.flatnonzero(first >= 0)
    at = first[held[np.searchsorted(held, np.arange(n)) % len(held)]]
    low = s[at].reshape(KEYS, ROWS)
    return mixed((low * _PLACE[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(KEYS, dtype=np.uint64))


def bitmap_of(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, dtype=np.uint8)
    bits[(mixed(tokens + _U(7)) % _U(BITS)).astype(np.int64)] = 1
    return np.packbits(bits)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _begin() -> None:
    """This operator keeps nothing in a worker; what another kept there goes."""
    enter("jaccard", lambda: None)


def _sketcher(width: int, percent: int):
    """doc_id and text in; size, fingerprint, keys, number of sampled tokens, and the
    leading 48 bits of the tokens that a prefix can need, ascending."""
    limit = _U(sample_limit(percent) << 16) if sample_limit(percent) < 1 << 48 else None
    names = ["doc_id", "n", "f1", "f2", "keys", "sampled", "tokens"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingles(text.as_py(), width)
                n = len(s)
                if not n:
                    rows.append((doc_id, 0, 0, 0, [], 0, []))
                    continue
                f1 = int(np.bitwise_xor.reduce(mixed(s + _U(11))).view(np.int64))
                f2 = int(np.add.reduce(mixed(s ^ _U(0x5DEECE66D))).view(np.int64))
                sampled = n if limit is None else int(np.searchsorted(s, limit))
                kept = s[: max(sampled, prefix_length(n, percent))] >> _U(16)
                rows.append((doc_id, n, f1, f2, _signed(keys_of(s)), sampled, _signed(kept)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds, strict=True)], names=names)

    return run


def _setter(width: int, columns: list[str], bits: bool):
    """``columns`` and a text in; ``columns``, the set and, if wished, its bitmap out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), 256):
                batch = whole.slice(at, 256)
                sets = [shingles(t.as_py(), width) for t in batch.column(len(columns))]
                out = [*(batch.column(i) for i in range(len(columns))), pa.array([x.tobytes() for x in sets], pa.binary())]
                names = [*columns, "tokens"]
                if bits:
                    out += [pa.array([len(x) for x in sets], pa.int64()), pa.array([bitmap_of(x).tobytes() for x in sets], pa.binary())]
                    names += ["n", "bits"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _set(x) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), dtype=np.uint64)


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for batch in batches:
            good = pa.array([alike(_set(x), _set(y), percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    return run


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


class SignatureTree:
    """Rows sorted by size; each level ORs FANOUT nodes of the one below. A level holds
    bitmaps, least and greatest size, tokens beyond the bitmap, least and greatest label."""

    def __init__(self, n: np.ndarray, bits: np.ndarray, label: np.ndarray):
        self.levels = [(bits, n, n, n - _popcount(bits), label, label)]
        low, high = np.minimum.reduceat, np.maximum.reduceat
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, e, first, last = self.levels[-1]
            cuts = np.arange(0, len(lo), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, cuts), low(lo, cuts), high(hi, cuts), high(e, cuts), low(first, cuts), high(last, cuts)))


def dual(left: SignatureTree, right: SignatureTree, percent: int, same: bool, chunk: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i of left, j of right; i < j if both are one tree) of different labels that may link.

    An overlap is at most the common bits of both bitmaps plus the tokens by which
    either set exceeds its own bits. Node pairs of a single label are not entered.
    """
    top = max(len(left.levels), len(right.levels)) - 1
    level = lambda t, k: t.levels[min(k, len(t.levels) - 1)]
    work = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        k, i, j = work.pop()
        if len(i) > chunk:
            work += [(k, i[at : at + chunk], j[at : at + chunk]) for at in range(0, len(i), chunk)]
            continue
        (lb, llo, lhi, le, lf, ll), (rb, rlo, rhi, re, rf, rl) = level(left, k), level(right, k)
        fits = (100 * lhi[i] >= percent * rlo[j]) & (100 * rhi[j] >= percent * llo[i])
        fits &= (lf[i] != rl[j]) | (ll[i] != rf[j])
        if same:
            fits &= i < j if k == 0 else i <= j
        i, j = i[fits], j[fits]
        most = _popcount(lb[i] & rb[j]) + np.minimum(le[i], re[j])
        fits = most >= needed(llo[i], rlo[j], percent)
        i, j = i[fits], j[fits]
        if not len(i):
            continue
        if k == 0:
            yield i, j
            continue
        down = lambda t, x: (
            (x[:, None] * FANOUT + np.arange(FANOUT)) if k < len(t.levels) else np.repeat(x[:, None], 1, axis=1)
        )
        ci, cj = down(left, i), down(right, j)
        pi, pj = np.repeat(ci, cj.shape[1], axis=1).ravel(), np.tile(cj, (1, ci.shape[1])).ravel()
        inside = (pi < len(level(left, k - 1)[1])) & (pj < len(level(right, k - 1)[1]))
        work.append((k - 1, pi[inside], pj[inside]))


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype=np.uint64).reshape(len(rows), -1)


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str], keys: int, flush) -> Iterator[pa.RecordBatch]:
    """Gives ``flush`` whole groups (rows sorted by the first ``keys`` columns, integers)
    and the starts of the groups with the end behind them."""
    _begin()
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        now = {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names)}
        held = now if held is None else {k: np.concatenate([held[k], now[k]]) for k in names}
        key = np.stack([held[k] for k in names[:keys]])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        if len(cuts):
            yield from flush(held, np.concatenate([[0], cuts]))
            held = {k: v[cuts[-1] :] for k, v in held.items()}
    if held is not None and len(held[names[0]]):
        yield from flush(held, np.array([0, len(held[names[0]])]))


def _sides(rows: dict[str, np.ndarray], label: str) -> list[tuple[dict[str, np.ndarray], SignatureTree]]:
    """One tree of a block with itself, or one of each of two blocks; none if a side is empty."""
    order = np.argsort(rows["n"], kind="stable")
    rows = {k: v[order] for k, v in rows.items()}
    tree = lambda r: SignatureTree(r["n"], _matrix(r["bits"]), r[label])
    if rows["p"][0] == rows["q"][0]:
        return [(rows, tree(rows))] * 2
    both = [{k: v[rows["side"] == side] for k, v in rows.items()} for side in (0, 1)]
    return [(r, tree(r)) for r in both] if all(len(r["n"]) for r in both) else []


def _candidates(percent: int):
    """Sorted rows (token, p, q, side, id, label, n, bits) in, possible pairs out."""

    def group(rows: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sides = _sides(rows, "label")
        if sides:
            (x, left), (y, right) = sides
            for i, j in dual(left, right, percent, left is right):
                yield np.minimum(x["id"][i], y["id"][j]), np.maximum(x["id"][i], y["id"][j])

    def leaves(held: dict[str, np.ndarray], starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Groups that fit one leaf are compared row by row, many of a size at once."""
        n, label, ids = held["n"], held["label"], held["id"]
        for size in np.unique(sizes):
            first, second = np.triu_indices(size, 1)
            here = starts[sizes == size]
            step = max(1, (1 << 14) // len(first))
            for at in range(0, len(here), step):
                rows = here[at : at + step, None] + np.arange(size)
                i, j = rows[:, first].ravel(), rows[:, second].ravel()
                fits = (label[i] != label[j]) & (100 * n[i] >= percent * n[j]) & (100 * n[j] >= percent * n[i])
                i, j = i[fits], j[fits]
                if not len(i):
                    continue
                used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
                bits = _matrix([held["bits"][k] for k in used])
                extra = n[used] - _popcount(bits)
                x, y = back[: len(i)], back[len(i) :]
                fits = _popcount(bits[x] & bits[y]) + np.minimum(extra[x], extra[y]) >= needed(n[i], n[j], percent)
                yield np.minimum(ids[i[fits]], ids[j[fits]]), np.maximum(ids[i[fits]], ids[j[fits]])

    def flush(held: dict[str, np.ndarray], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts, sizes = cuts[:-1], np.diff(cuts)
        some = sizes > 1
        starts, sizes = starts[some], sizes[some]
        small = (sizes <= LEAF) & (held["p"][starts] == held["q"][starts])
        yield from _packed(leaves(held, starts[small], sizes[small]))
        for s, z in zip(starts[~small], sizes[~small], strict=True):
            yield from _packed(group({k: v[s : s + z] for k, v in held.items()}))

    names = ["token", "p", "q", "side", "id", "label", "n", "bits"]
    return lambda batches: _grouped(batches, names, 3, flush)


def _packed(pairs: Iterator[tuple[np.ndarray, np.ndarray]], most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Pairs as batches of about ``most``, without repeats in each."""
    held, size = [], 0
    for a, b in pairs:
        held.append(np.stack([a, b]))
        size += len(a)
        if size >= most:
            yield _batch(held)
            held, size = [], 0
    if size:
        yield _batch(held)


def _batch(held: list[np.ndarray]) -> pa.RecordBatch:
    pair = np.unique(np.concatenate(held, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pair[0], pa.int64()), pa.array(pair[1], pa.int64())], names=["a", "b"])


def _counter(percent: int):
    """Sorted rows (root, p, q, side, id, n, bits, tokens) in; (id, links) out, one row per id and pair of blocks."""

    def flush(held: dict[str, np.ndarray], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, links = [], []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            sides = _sides({k: v[s:e] for k, v in held.items()}, "id")
            if not sides:
                continue
            (x, left), (y, right) = sides
            for i, j in dual(left, right, percent, left is right):
                good = [alike(np.frombuffer(x["tokens"][a], np.uint64), np.frombuffer(y["tokens"][b], np.uint64), percent) for a, b in zip(i, j, strict=True)]
                found, n = np.unique(np.concatenate([x["id"][i[good]], y["id"][j[good]]]), return_counts=True)
                ids.append(found)
                links.append(n)
        if ids:
            every, at = np.unique(np.concatenate(ids), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate(links), minlength=len(every)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.int64()), pa.array(total, pa.int64())], names=["id", "links"])

    names = ["root", "p", "q", "side", "id", "n", "bits", "tokens"]
    return lambda batches: _grouped(batches, names, 3, flush)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links joined to stars, 100,000 at a time: fewer links, the same components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def stars() -> pa.RecordBatch:
        far = [(x, find(x)) for x in list(root) if find(x) != x]
        root.clear()
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in far], pa.int64()), pa.array([r for _, r in far], pa.int64())], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
            if len(root) >= 100_000:
                yield stars()
    yield stars()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, root): every node of ``edges`` (a, b) with the smallest id of its component.

    Alternating large-star and small-star steps (Kiveris et al. 2014), after each
    partition has joined its own links: each step is written to the shared folder,
    minima are combined before shuffles and written before rows join to them.
    """
    e = materialize(edges.where("a <> b").mapInArrow(_forest, "a bigint, b bigint"), "edges")
    before = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = materialize(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        root = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(root, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(root.select("a", F.col("m").alias("b")))
        last, e = e, materialize(small.where("a <> b").distinct(), "edges")
        for old in (last, least, large, root):
            discard(old)
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if before == now:
            return e.select(F.col("a").alias("id"), F.col("b").alias("root"))
        before = now
    raise RuntimeError("components did not settle")


def texts_of(ids: DataFrame, docs: DataFrame, columns: list[str]) -> DataFrame:
    """``ids`` (id, more columns) with the texts of these rows: ``columns``, text.

    Before texts are shuffled, rows are left out whose id falls in no hash bucket of
    the wanted ones; at most BUCKETS numbers are broadcast for that.
    """
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")
    wanted = ids.select(bucket("id").alias("__bucket")).distinct()
    near = docs.withColumn("__bucket", bucket("doc_id")).join(F.broadcast(wanted), "__bucket", "left_semi").drop("__bucket")
    return near.join(ids.hint("merge"), near["doc_id"] == ids["id"]).select(*columns, "text")


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The written ``pairs`` (a, b) that link. Only texts that stand in a pair are turned
    to sets; each travels once to a pair's other end, and a head's once for all its pairs."""
    spark = pairs.sparkSession
    far = texts_of(pairs.select(F.col("b").alias("id"), "a"), docs, ["a", "id"]).mapInArrow(_setter(width, ["a", "b"], False), "a bigint, b bigint, tokens binary")
    heads = materialize(pairs.select(F.col("a").alias("id")).distinct(), "heads")
    near = texts_of(heads, docs, ["id"]).mapInArrow(_setter(width, ["a"], False), "a bigint, tokens binary").select("a", F.col("tokens").alias("x"))
    full = far.join(near.hint("merge"), "a").select("a", "b", "x", "tokens")
    out = materialize(full.mapInArrow(_verifier(percent), "a bigint, b bigint"), "links")
    discard(heads)
    release(spark)
    return out


def blocks_of(rows: DataFrame, size: str, most: int) -> DataFrame:
    """Rows of a group of ``size`` rows, dealt into pairs (p, q) of blocks of about ``most``; ``side`` tells the block."""
    blocks = F.ceil(F.col(size) / most).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    dealt = rows.withColumn("__blocks", blocks).withColumn("__own", F.pmod(F.xxhash64("id"), F.col("__blocks")).cast("int")).withColumn("__other", other)
    return (
        dealt.withColumn("p", F.least("__own", "__other")).withColumn("q", F.greatest("__own", "__other"))
        .withColumn("side", (F.col("__own") > F.col("__other")).cast("int")).drop("__blocks", "__own", "__other")
    )


def prefix_rows(nodes: DataFrame, percent: int) -> DataFrame:
    """(token, id, label) of the prefixes, without tokens that a single class holds.

    ``nodes``: id, n, label, sampled, tokens. A set's sampled tokens come first, by
    the number of their holders; behind them, if they do not fill the prefix, the others.
    """
    spark = nodes.sparkSession
    want = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / F.lit(100)) + 1
    first = F.slice("tokens", F.lit(1), F.col("sampled").cast("int"))
    holders = nodes.select(F.explode(first).alias("token")).groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = materialize(holders, "holders", "zstd")
    release(spark)
    # Tokens that are shared grow with the corpus, so they are joined by a shuffle at every size.
    back = nodes.select("id", F.explode(first).alias("token")).join(shared.hint("merge"), "token")
    held = materialize(back.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("holders", "token"))).alias("held")), "held", "zstd")
    discard(shared)
    release(spark)
    alone = F.col("sampled") - F.coalesce(F.size("held"), F.lit(0))
    common = F.transform(F.slice(F.coalesce("held", F.array().cast("array<struct<holders:bigint,token:bigint>>")), F.lit(1), F.greatest(want - alone, F.lit(0)).cast("int")), lambda x: x["token"])
    others = F.slice("tokens", (F.col("sampled") + 1).cast("int"), F.greatest(want - F.col("sampled"), F.lit(0)).cast("int"))
    # A set whose own tokens fill the prefix, and that keeps no other ones, gives no row.
    open_sets = nodes.join(held.hint("merge"), "id", "left").where((want > alone) | (F.size(others) > 0))
    out = materialize(open_sets.select("id", "label", F.explode(F.concat(common, others)).alias("token")), "prefixes", "zstd")
    discard(held)
    release(spark)
    return out


def joined(docs: DataFrame, text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Sizes (doc_id, n), members (doc_id, rep), roots (id, root) of linked classes, and the texts they come from."""
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = "doc_id bigint, n bigint, f1 bigint, f2 bigint, keys array<bigint>, sampled bigint, tokens array<bigint>"
    rows = materialize(given.mapInArrow(_sketcher(width, percent), sketch), "sketches", "zstd")
    live = rows.where("n > 0 AND doc_id IS NOT NULL")

    # Classes of equal sets; only sets that occur again need a join to find their representative.
    classes = materialize(live.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep <> last").drop("last"), "classes")
    members = live.select("doc_id", "n", "f1", "f2").join(classes, ["n", "f1", "f2"], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"))
    members = materialize(members.distinct(), "members")
    copies = members.where("doc_id <> rep").select("doc_id").distinct()
    own = live.join(copies, "doc_id", "left_anti")

    # Star links by min-hash keys: one for each class.
    keyed = materialize(own.select(F.col("doc_id").alias("id"), "n", F.posexplode("keys").alias("k", "key")), "keys")
    heads = materialize(keyed.groupBy("k", "key").agg(F.min(F.struct("id", "n")).alias("head"), F.max("id").alias("last")).where("head.id <> last").select("k", "key", "head"), "heads")
    fits = (100 * F.col("n") >= percent * F.col("head.n")) & (100 * F.col("head.n") >= percent * F.col("n"))
    star = keyed.join(heads, ["k", "key"]).where((F.col("id") != F.col("head.id")) & fits)
    star = materialize(star.groupBy(F.col("id").alias("b")).agg(F.min("head.id").alias("a")).select("a", "b"), "pairs")
    for old in (keyed, heads, classes):
        discard(old)
    release(spark)
    links = verified(star, given, width, percent)
    discard(star)
    label = components(links)
    nodes = own.select(F.col("doc_id").alias("id"), "n", "sampled", "tokens").join(label, "id", "left")
    nodes = materialize(nodes.select("id", "n", "sampled", "tokens", F.coalesce("root", "id").alias("label")), "nodes", "zstd")
    sizes = materialize(rows.select("doc_id", "n"), "sizes")
    discard(rows)
    release(spark)

    flat = prefix_rows(nodes, percent)
    discard(nodes)
    met = flat.groupBy("token").agg(F.count("*").alias("rows"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token", "rows")
    met = materialize(met, "tokens")
    shared = materialize(blocks_of(flat.join(met.hint("merge"), "token"), "rows", BLOCK).select("token", "p", "q", "side", "id", "label"), "groups", "zstd")
    discard(flat)
    discard(met)
    release(spark)
    known = materialize(shared.select("id").distinct(), "ids")
    sets = texts_of(known, given, ["id"]).mapInArrow(_setter(width, ["id"], True), "id bigint, tokens binary, n bigint, bits binary").select("id", "n", "bits")
    sets = materialize(sets.where("n > 0"), "bitmaps", "zstd")
    dealt = shared.join(sets.hint("merge"), "id").select("token", "p", "q", "side", "id", "label", "n", "bits")
    pairs = dealt.repartition("token", "p", "q").sortWithinPartitions("token", "p", "q").mapInArrow(_candidates(percent), "a bigint, b bigint")
    rest = materialize(pairs.where("a <> b").distinct(), "pairs")
    for old in (shared, known, sets):
        discard(old)
    release(spark)
    more = verified(rest, given, width, percent)
    discard(rest)
    return sizes, members, components(links.union(more)), given


def count_links(members: DataFrame, roots: DataFrame, given: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, links): links of every linked class to other classes."""
    sizes = materialize(roots.groupBy("root").agg((F.count("*") + 1).alias("size")), "sizes")
    everyone = roots.select("id", "root").union(roots.select(F.col("root").alias("id"), "root").distinct())
    dealt = blocks_of(everyone.join(sizes, "root"), "size", SETS).select("root", "p", "q", "side", "id")
    ids = materialize(everyone.select("id").distinct(), "ids")
    sets = texts_of(ids, given, ["id"]).mapInArrow(_setter(width, ["id"], True), "id bigint, tokens binary, n bigint, bits binary")
    # Rows that share an id: the class's own set is the one of its representative row; all are compared.
    full = dealt.join(sets.where("n > 0").hint("merge"), "id").select("root", "p", "q", "side", "id", "n", "bits", "tokens")
    counted = full.repartition("root", "p", "q").sortWithinPartitions("root", "p", "q").mapInArrow(_counter(percent), "id bigint, links bigint")
    return materialize(counted.groupBy("id").agg(F.sum("links").alias("links")), "links")


def join(docs: DataFrame, text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT, links: bool = True) -> DataFrame:
    """doc_id, n_shingles, n_links (links of the row's class to other classes), component_id.

    Without ``links`` there is no n_links and less work.
    """
    sizes, members, roots, given = joined(docs, text_col, width, percent)
    found = members.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    totals = [F.min(F.coalesce("root", "rep")).alias("component_id")]
    if links:
        found = found.join(count_links(members, roots, given, width, percent).withColumnRenamed("id", "rep"), "rep", "left")
        totals.append(F.max("links").alias("links"))
    found = found.groupBy("doc_id").agg(*totals)
    counted = [F.coalesce("links", F.lit(0)).alias("n_links")] if links else []
    return sizes.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", *counted, F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), links=False).select("doc_id", "n_shingles", "component_id")


def op6_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + {SHINGLE - 1}], ' ') AS x
      FROM w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS r(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
r(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(other)::BIGINT AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.id = d.doc_id GROUP BY ALL
"""

#: The same with the links to other sets, each of those sets counted once.
LINKS_ORACLE = ORACLE.rpartition("SELECT d.doc_id")[0].rstrip() + r""",
k AS (SELECT doc_id, md5(string_agg(x, chr(10) ORDER BY x)) AS k FROM s GROUP BY doc_id),
l AS (SELECT e.a AS doc_id, count(DISTINCT kb.k) FILTER (kb.k <> ka.k) AS n FROM e JOIN k ka ON ka.doc_id = e.a JOIN k kb ON kb.doc_id = e.b GROUP BY e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(l.n, 0)::BIGINT AS n_links, min(other)::BIGINT AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN l USING (doc_id) JOIN r ON r.id = d.doc_id GROUP BY ALL
"""

QUERIES = {"op6_jaccard_join": op6_jaccard_join, "op6_jaccard_links": op6_jaccard_links}
ORACLE_SQL = {"op6_jaccard_join": ORACLE, "op6_jaccard_links": LINKS_ORACLE}
