"""K2: linkage dealt over many tasks equals the chain in one task and merging the nearest pair."""

import os
import random

import numpy as np
import pytest

from genoflux.operators import cluster, distance
from genoflux.operators.agglomerate import UNIT
from genoflux.plans import fixtures
from genoflux.plans.queries import QUERIES, average_by_rounds

FOLDER = "/root/testdata/sf0.001"


def merged_one_by_one(d, threshold, method):
    """Always the nearest pair of all; ties to the smaller first member, then the smaller second."""
    d, limit = np.round(np.asarray(d) * UNIT), round(threshold * UNIT)
    members = {i: [i] for i in range(len(d))}
    weight = {i: {i: 1.0} for i in range(len(d))}

    def height(a, b):
        block = d[np.ix_(members[a], members[b])]
        if method == "average":
            return float(block.sum()) / block.size
        if method == "complete":
            return float(block.max())
        return sum(weight[a][i] * weight[b][j] * d[i, j] for i in members[a] for j in members[b])

    known = {(a, b): height(a, b) for a in members for b in members if a < b}
    while known:
        h, a, b = min((h, a, b) for (a, b), h in known.items())
        if h > limit:
            break
        members[a] = sorted(members[a] + members.pop(b))
        weight[a] = {i: w / 2 for part in (weight[a], weight.pop(b)) for i, w in part.items()}
        known = {k: v for k, v in known.items() if a not in k and b not in k}
        known |= {(min(a, c), max(a, c)): height(*sorted((a, c))) for c in members if c != a}
    return {frozenset(m) for m in members.values()}


def partition(rows):
    out = {}
    for r in rows:
        out.setdefault(r["cluster_id"], set()).add(r["ord"])
    return {frozenset(v) for v in out.values()}


def family(seed, n, length=60):
    """One chain of mutations with ties, N and gaps: a single component at the cut."""
    r = random.Random(seed)
    rows = ["".join(r.choices("ACGT", k=length))]
    while len(rows) < n:
        s = list(r.choice(rows[-6:]))
        for i in r.sample(range(length), r.randint(1, 3)):
            s[i] = r.choice("ACGTACGTN-")
        rows.append("".join(s))
    return rows


@pytest.mark.parametrize("method", ["average", "complete", "weighted"])
def test_rounds_equal_the_chain(spark, method):
    rows = family(4, 14)
    df = spark.createDataFrame(list(enumerate(rows)), "ord bigint, aln string")
    d = cluster.masked_distances(rows)
    want = merged_one_by_one(d, 0.09, method)
    assert 1 < len(want) < 14
    assert partition([{"cluster_id": c, "ord": i} for i, c in enumerate(cluster.cut_labels(d, 0.09, method))]) == want
    if method == "weighted":
        pairs = distance.pairwise(df.selectExpr("string(ord) AS seq_id", "ord", "aln"))
        assert partition(cluster.clusters(df, pairs, 0.09, method, group_rows=1).collect()) == want
    else:
        assert partition(cluster.cluster_alignment(df, 0.09, method, group_rows=1).collect()) == want


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are absent")
def test_whole_table(spark):
    """Every specimen of the driver's smallest table: rounds, groups and repeated merging agree."""
    s = fixtures.specimens(spark, FOLDER).select("processid", "ord", "aln").collect()
    first = {}
    for r in sorted(s, key=lambda r: r["ord"]):
        first.setdefault(r["aln"], r["ord"])
    ords = sorted(first.values())
    seqs = {v: k for k, v in first.items()}
    d = cluster.masked_distances([seqs[o] for o in ords])
    for name, method in (("k2_average_linkage", "average"), ("rounds", "average"), ("k2_complete_linkage", "complete")):
        want = {frozenset(r["processid"] for r in s if first[r["aln"]] in {ords[i] for i in group}) for group in merged_one_by_one(d, 0.03, method)}
        got = {}
        for r in (average_by_rounds if name == "rounds" else QUERIES[name])(spark, FOLDER).collect():
            got.setdefault(r["cluster_id"], set()).add(r["processid"])
        assert {frozenset(v) for v in got.values()} == want, name


@pytest.mark.parametrize("method", ["average", "complete", "weighted"])
def test_chain_with_ties(method):
    for seed in range(25):
        rows = family(seed, 40, 24)
        d = cluster.masked_distances(rows)
        for cut in (0.05, 0.12, 0.2):
            labels = cluster.cut_labels(d, cut, method)
            assert partition([{"cluster_id": c, "ord": i} for i, c in enumerate(labels)]) == merged_one_by_one(d, cut, method)


def test_plan_has_no_group_of_a_component(spark):
    df = spark.createDataFrame(list(enumerate(family(4, 6))), "ord bigint, aln string")
    found = cluster.agglomerate(df.select("ord"), distance.pairwise(df.selectExpr("string(ord) AS seq_id", "ord", "aln"), max_distance=0.09), lambda p: distance.of_pairs(p, distance.encoded(df.selectExpr("string(ord) AS seq_id", "ord", "aln"))), 0.09)
    assert "Pandas" not in found._jdf.queryExecution().toString()
    assert found.count() == 6


def test_pairs_once(spark):
    df = spark.createDataFrame([(str(i), i, s) for i, s in enumerate(family(1, 50))], "seq_id string, ord bigint, aln string")
    got = [(r["i"], r["j"], r["id_i"]) for r in distance.pairwise(df, blocks=5).collect()]
    assert sorted(got) == [(i, j, str(i)) for i in range(50) for j in range(i + 1, 50)]
