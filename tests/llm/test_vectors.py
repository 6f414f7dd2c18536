"""op11 and op13: vectors against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoflux.llm import hard_negatives, vector_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, root int"


def planted(seed=0, n=500, dim=16):
    """Random vectors, pairs and a large group around the limit, copies, and rows that link with nothing."""
    r = np.random.default_rng(seed)
    v = r.standard_normal((n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[n // 2 :: 2] = v[: n // 2 : 2] + r.standard_normal((len(v[n // 2 :: 2]), dim)) * 0.04
    v[100:200] = v[100] + r.standard_normal((100, dim)) * 0.035
    label = r.integers(0, 3, n)
    label[100:190] = 1
    label[n // 2 :: 2] = label[: n // 2 : 2]
    rows = [(i, v[i].tolist(), int(label[i]), "x", 0) for i in range(n)]
    rows += [(n + i, rows[7][1], rows[7][2], None, None) for i in range(90)]
    odd = [None, [], [0.0] * dim, [1.0] * (dim - 1) + [None], [1.0] * (dim - 1) + [math.nan], [1.0] * (dim - 1) + [math.inf], rows[7][1][:-1]]
    rows += [(2000 + i, x, 1, None, None) for i, x in enumerate(odd)]
    rows += [(3000, rows[7][1], None, None, None), (None, rows[7][1], rows[7][2], None, None), (3001, [x * 3 for x in rows[7][1]], rows[7][2], None, None)]
    return rows


def brute(rows, cosine):
    sound = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    root, links = {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    vectors = [np.array(r[1], np.float32).astype(float) for r in sound]
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if len(a) == len(b) and sound[i][2] == sound[j][2] and a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                links[sound[i][0]] += 1
                links[sound[j][0]] += 1
                x, y = sorted((find(sound[i][0]), find(sound[j][0])))
                root[y] = x
    return {r[0]: (links[r[0]], find(r[0]) if r[0] is not None else None, r[0] is not None and find(r[0]) == r[0]) for r in rows}


@pytest.mark.parametrize("window", [64, 8])
def test_near_duplicates(spark, window):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA)
    found = vector_dedup.find(df, window=window).collect()
    got = {r["vec_id"]: tuple(r)[1:] for r in found}
    want = brute(rows, vector_dedup.COSINE)
    assert len(found) == len(rows)
    linked = [k for k, v in want.items() if v[0]]
    assert len(linked) > 200 and max(v[0] for v in want.values()) > window
    # Every pass may overlook a pair; what is found must be right and nearly all.
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(got[k] != want[k] for k in want) <= (0 if window == 64 else 5)


def test_empty_and_single(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    assert vector_dedup.find(df.limit(0)).count() == 0
    assert [tuple(r) for r in vector_dedup.find(df.where("vec_id = 3")).collect()] == [(3, 0, 3, True)]


def test_doubles_and_repeated_rows(spark):
    df = spark.createDataFrame([(5, [1.0, 2.0], "a"), (5, [1.0, 2.0], "a"), (4, [1e200, 2e200], "a"), (6, [1.0, -2.0], "a")], "vec_id int, embedding array<double>, label string")
    assert sorted(map(tuple, vector_dedup.find(df).collect())) == [(4, 2, 4, True), (5, 2, 4, False), (5, 2, 4, False), (6, 0, 6, True)]


def test_blocks_and_ends_of_partitions(spark, monkeypatch):
    """Small blocks, steps and partitions give the same links."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    monkeypatch.setattr(vector_dedup, "PARTITION_ROWS", 70)
    rows = planted(1)
    got = {r["vec_id"]: tuple(r)[1:] for r in vector_dedup.find(spark.createDataFrame(rows, SCHEMA), window=32, miss=1e-5).collect()}
    assert got == brute(rows, vector_dedup.COSINE)


def test_passes_follow_the_rows():
    assert [vector_dedup.passes_for(n) for n in (0, 64, 5000)] == [1, 1, 6]
    assert vector_dedup.passes_for(10**9) < 40


def brute_negatives(rows, anchor, flip):
    kept = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * float(np.float32(x))) for x in v]
        one = ((label + 1) % 10 if flip(i) else label, w)
        kept[i] = min(kept.get(i, one), one)
    dim = max({len(w) for _, w in kept.values()}, key=lambda n: (sum(len(w) == n for _, w in kept.values()), n)) if kept else 0
    kept = {i: x for i, x in kept.items() if len(x[1]) == dim}
    out = set()
    for a, (label, v) in kept.items():
        if not anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=True)) for i, (_, w) in kept.items()}
        first = sorted((i for i in kept if i != a and kept[i][0] == label), key=lambda i: (-score[i], i))[:5]
        for p in first:
            near = sorted((i for i in kept if kept[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]), key=lambda i: (-score[i], i))[:5]
            out |= {(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(near)}
    return out


@pytest.mark.parametrize(("anchors", "candidates", "fewest"), [(2048, 16_384, 8), (7, 40, 20)])
def test_hard_negatives(spark, monkeypatch, anchors, candidates, fewest):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", anchors)
    monkeypatch.setattr(hard_negatives, "CANDIDATE_BLOCK", candidates)
    monkeypatch.setattr(hard_negatives, "FEWEST", fewest)
    rows = planted(3)
    # Copies of anchors under other labels, and a hot cell of all labels.
    rows += [(4000 + i, [x + 0.002 * i for x in rows[i][1]], (rows[i][2] + 1) % 3, None, None) for i in range(60)]
    rows += [(5000 + i, rows[100][1], i % 4, None, None) for i in range(120)] + [rows[20], (20, rows[21][1], 2, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(hard_negatives.prepared(df, label), F.col("vec_id") % 10 == 0).collect()
    want = brute_negatives(rows, lambda i: i % 10 == 0, lambda i: i % 7 == 0)
    assert len(got) == len(want) > 300
    assert {tuple(r) for r in got} == want


def test_no_anchors_and_large_numbers(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    assert hard_negatives.mine(hard_negatives.prepared(df.limit(0), F.col("label")), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(hard_negatives.prepared(df, F.col("label")), F.col("vec_id") < 0).count() == 0
    rows = [(i, [1e6 + i, 2e6 - 3 * i, float(i)], i % 2, None, None) for i in range(40)] + [(50, [1e8, 1e8, 1.0], 0, None, None)]
    got = hard_negatives.mine(hard_negatives.prepared(spark.createDataFrame(rows, SCHEMA), F.col("label")), F.col("vec_id") % 10 == 0).collect()
    assert {tuple(r) for r in got} == brute_negatives(rows[:-1], lambda i: i % 10 == 0, lambda i: False) != set()
