"""K4: paths in a doubling band against the full table, and the seed index against every pair."""

import random

import numpy as np
import pytest

from genoflux.operators import assign, nearest, paths


def full_table(q, t):
    """Every cell; from the end the diagonal, then the insertion, then the deletion."""
    n, m = len(q), len(t)
    c = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j:
                c[i][j] = min(c[i - 1][j - 1] + (q[i - 1] != t[j - 1]), c[i - 1][j] + 1, c[i][j - 1] + 1)
            else:
                c[i][j] = i + j
    i, j, ops = n, m, ""
    while i or j:
        if i and j and c[i][j] == c[i - 1][j - 1] + (q[i - 1] != t[j - 1]):
            ops += "=" if q[i - 1] == t[j - 1] else "X"
            i, j = i - 1, j - 1
        elif i and c[i][j] == c[i - 1][j] + 1:
            ops += "I"
            i -= 1
        else:
            ops += "D"
            j -= 1
    return ops[::-1]


def mutated(r, s, edits):
    s = list(s)
    for _ in range(edits):
        at = r.randrange(len(s) + 1)
        kind = r.random()
        if kind < 0.4 and at < len(s):
            s[at] = r.choice("ACGT")
        elif kind < 0.7:
            s.insert(at, r.choice("ACGT"))
        elif at < len(s):
            del s[at]
    return "".join(s)


def plain(ops):
    out, k = "", 0
    while k < len(ops):
        e = k
        while e < len(ops) and ops[e] == ops[k]:
            e += 1
        out += f"{e - k}{ops[k]}"
        k = e
    return tuple(ops.count(x) for x in "=XID") + (out,)


def test_paths_equal_the_full_table(monkeypatch):
    r = random.Random(3)
    pairs = [("", ""), ("", "AC"), ("ACG", ""), ("ACTG", "ACTGACTG"), ("ACTGACTGNNNN", "ACTGACTG"), ("é" * 3, "éa")]
    for _ in range(250):
        q = "".join(r.choices("ACGT"[: r.choice([1, 2, 4])], k=r.randrange(0, 130)))
        pairs.append((q, mutated(r, q, r.randrange(0, 40)) if r.random() < 0.8 else "".join(r.choices("ACGT", k=r.randrange(0, 90)))))
    want = [plain(full_table(q, t)) for q, t in pairs]
    assert paths.align(*map(list, zip(*pairs, strict=True))) == want
    monkeypatch.setattr(paths, "CELLS", 300)
    assert paths.align(*map(list, zip(*pairs, strict=True))) == want


def test_long_pairs_take_little_memory():
    r = random.Random(4)
    q = "".join(r.choices("ACGT", k=12_000))
    t = mutated(r, q, 60)
    m, x, i, d, _ = paths.align([q], [t])[0]
    assert m + x + i == len(q) and m + x + d == len(t) and x + i + d <= 60


def planted(r):
    """Consensus sequences of several lengths in families, and sequences near, between and far from them."""
    heads = ["".join(r.choices("ACGT", k=r.choice([90, 120, 140]))) for _ in range(8)]
    cons = [mutated(r, h, r.randrange(0, 12)) for h in heads for _ in range(6)] + [heads[0]] * 2 + ["ACGT", "A" * 60]
    seqs = [mutated(r, r.choice(cons), r.choice([0, 1, 3, 8, 20])) for _ in range(230)]
    seqs += [s[: len(s) // 2] for s in seqs[:15]] + ["".join(r.choices("ACGT", k=100)) for _ in range(10)] + ["AC", "N" * 40, cons[3] + "".join(r.choices("ACGT", k=50))]
    return sorted({s for s in seqs if s}), cons


@pytest.mark.parametrize("method", ["target_based", "classic"])
def test_candidates_hold_the_first_two(spark, method):
    seqs, cons = planted(random.Random(6))
    s = spark.createDataFrame([(x,) for x in seqs], "nuc string")
    c = spark.createDataFrame([(f"c{i}", x, i) for i, x in enumerate(cons)], "consensus_group string, consensus_seq string, ord bigint")
    metric = "target_identity" if method == "target_based" else "classic_identity"
    top = lambda rows: {n: sorted(((-r[metric], r["c_ord"], r["edit_distance"]) for r in rows if r["nuc"] == n))[:2] for n in seqs}
    every = assign.scored(s, c).collect()
    some = assign.scored(s, c, top_by=method).collect()
    assert len(every) == len(seqs) * len(cons)
    assert top(some) == top(every)
    # Far sequences need every pair; those near to a consensus need few.
    assert len(some) < 0.4 * len(every)


def test_scored_pairs_grow_less_than_the_product(spark):
    r = random.Random(7)
    heads = ["".join(r.choices("ACGT", k=150)) for _ in range(80)]
    found = []
    for n in (10, 40, 80):
        c = spark.createDataFrame([(f"c{i}", x, i) for i, x in enumerate(heads[:n])], "consensus_group string, target string, c_ord bigint")
        s = spark.createDataFrame([(x,) for x in {mutated(r, r.choice(heads[:n]), 3) for _ in range(100)}], "nuc string")
        found.append(nearest.candidates(s, c, "target_based").count())
    assert found[2] < 3 * found[0] and np.ptp(found) < 400


@pytest.mark.parametrize("cons", [["ACGTACGTACGTACGT"], []])
def test_one_or_no_consensus(spark, cons):
    c = spark.createDataFrame([(f"c{i}", x, i) for i, x in enumerate(cons)], "consensus_group string, consensus_seq string, ord bigint")
    s = spark.createDataFrame([("p", "ACGTACGTACGTACGA"), ("n", None), ("e", "")], "processid string, nuc string")
    got = {r["processid"]: (r["consensus_group"], r["runner_up_group"], r["status"]) for r in assign.assign(s, c).collect()}
    assert got == {"p": ("c0" if cons else None, None, "assigned" if cons else "below_threshold"), "n": (None, None, "no_sequence"), "e": (None, None, "no_sequence")}
