"""Equal sequences are laid out, trimmed and counted once; pairs are dealt to tasks by their number."""

import random

from pyspark.sql import functions as F

from genoflux.config import Config
from genoflux.operators import align, assign, consensus, nearest
from genoflux.plans import genotyping


def families(seed, n, repeats):
    r = random.Random(seed)
    heads = ["".join(r.choices("ACGT", k=120)) for _ in range(n)]
    kinds = [h[:k] + c + h[k + 1 :] for h in heads for k, c in ((0, h[0]), (40, "N"), (80, "A"))]
    return [s for s in kinds for _ in range(repeats)]


def test_equal_sequences_are_laid_out_once(spark, monkeypatch):
    seqs = families(1, 2, 5)
    rows = [(f"P{i}", s if i % 2 else s.lower(), i) for i, s in enumerate(seqs)]
    written = {}

    def seen(df, tag, materialize=genotyping.materialize):
        out = materialize(df, tag)
        written[tag] = out.count()
        return out

    monkeypatch.setattr(genotyping, "materialize", seen)
    config = Config().update(dereplication__min_sequence_length=100, dereplication__min_post_trim_length=100)
    cons, labels = genotyping.dereplicate(spark.createDataFrame(rows, "processid string, nuc string, ord bigint"), config)
    assert written["aligned"] == len(set(seqs))
    assert labels.count() == len(rows)
    assert sorted(r["n_reference"] for r in cons.collect()) == [15, 15]


def test_weights_stand_for_rows(spark):
    many = spark.createDataFrame([(s,) for s in ["AC-GT"] * 4 + ["ACGGT"] * 3 + ["A--GA"] * 2 + [None]], "aln string")
    few = many.groupBy("aln").agg(F.count("*").alias("n"))
    for trim in (align.trim_columns, align.trim_similar):
        assert {r["aln"] for r in trim(few, weight="n").collect()} == {r["aln"] for r in trim(many).collect()}
    # Six of nine rows lack the third place, and two of three texts; the second place lacks two of nine, and one of three.
    assert sorted(r["aln"] for r in align.trim_columns(few, 0.25, weight="n").collect()) == ["", "A-GA", "ACGT", "ACGT"]
    assert sorted(r["aln"] for r in align.trim_columns(few, 0.25).collect()) == ["", "AGA", "AGT", "AGT"]
    seqs = spark.createDataFrame([("AACCGG", 1), ("AACGG", 9)], "seq string, n bigint")
    assert {r["aln"].replace("-", "") for r in align.star_align(seqs, weight="n").collect()} == {"AACCGG", "AACGG"}


def test_equal_members_vote_by_their_rows(spark):
    rows = [(1, 5, "ACGT"), (1, 2, "acga"), (1, 7, "ACGT"), (1, 3, "ACGA"), (1, 9, None), (2, 1, "TT"), (2, 4, "T-")]
    got = {r["cluster_id"]: (r["consensus_seq"], r["n_reference"]) for r in consensus.consensus(spark.createDataFrame(rows, "cluster_id int, ord bigint, aln string"), 0.5).collect()}
    assert got == {1: ("ACGA", 5), 2: ("TT", 2)}


def test_pairs_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(nearest, "TASK_PAIRS", 20)
    r = random.Random(4)
    targets = [(f"g{i}", s, i) for i, s in enumerate(dict.fromkeys(families(2, 4, 1)))]
    # Short ones that are like no genotype meet them all.
    short = ["".join(r.choices("ACGT", k=32)) for _ in range(40)]
    s = spark.createDataFrame([(x,) for x in [*short, *(t for _, t, _ in targets)]], "nuc string")
    c = spark.createDataFrame(targets, "consensus_group string, consensus_seq string, ord bigint")
    found = nearest.candidates(s, c.select("consensus_group", F.col("consensus_seq").alias("target"), F.col("ord").alias("c_ord")), "target_based")
    assert found.rdd.getNumPartitions() >= found.count() // 20 > 8

    def top(pairs):
        out = {}
        for p in pairs:
            out.setdefault(p["nuc"], []).append((-p["target_identity"], p["c_ord"]))
        return {k: sorted(v)[:2] for k, v in out.items()}

    assert top(assign.scored(s, c, top_by="target_based").collect()) == top(assign.scored(s, c).collect())
