"""Quoted line breaks, parts that fail, columns by similarity, checks inside the plan."""

import json
import os

import pytest
from pyspark.sql import functions as F

from genoflux.config import Config
from genoflux.operators import align, qc, taxonomy
from genoflux.plans.genotyping import run
from genoflux.sources import fasta, tables


def test_quoted_line_breaks_stay_in_their_record(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text('processid\tnuc\tnote\nA\tACGT\t"first\nsecond\t""x"""\nB\tGG\tplain 5" long\n')
    got = tables.read_specimens(spark, str(path)).orderBy("ord").collect()
    assert [(r["processid"], r["nuc"], r["note"]) for r in got] == [("A", "ACGT", 'first\nsecond\t"x"'), ("B", "GG", 'plain 5" long')]
    (tmp_path / "b.tsv").write_text("processid\tnuc\tnote\nA\tACGT\tplain\n")
    assert tables.read_specimens(spark, str(tmp_path / "b.tsv")).count() == 1


def test_fasta_parts_in_order(spark, tmp_path):
    rows = [(f"h{i:03d}", "ACGT" * i, i) for i in range(60)]
    path = str(tmp_path / "out")
    fasta.write_fasta(spark.createDataFrame(rows, "header string, seq string, ord int").repartition(7), path, order="ord", width=10)
    names = sorted(n for n in os.listdir(path) if n.endswith(".fasta"))
    assert not any(n.startswith(".") and n.endswith(".fasta") for n in os.listdir(path))
    manifest = json.loads(next((tmp_path / "out").glob("_manifest-*")).read_text())
    assert [p["file"] for p in manifest["parts"]] == names and sum(p["records"] for p in manifest["parts"]) == 60
    whole = b"".join((tmp_path / "out" / p["file"]).read_bytes() for p in manifest["parts"])
    assert len(whole) == manifest["bytes"]
    for p in manifest["parts"]:
        assert whole[p["offset"] : p["offset"] + 1] == b">"
    assert whole.decode().count(">") == 60 and [x.split("\n")[0] for x in whole.decode().split(">")[1:]] == [r[0] for r in rows]
    back = spark.read.format("fasta").load(path).orderBy("ord").collect()
    assert [(r["header"], r["seq"]) for r in back] == [(h, s) for h, s, _ in rows]


def test_failed_fasta_task_leaves_no_part(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(40).repartition(4).select(F.col("id").cast("string").alias("header"), F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.lit("ACGT")).cast("string").alias("seq"))
    with pytest.raises(Exception):
        fasta.write_fasta(df, path)
    assert not [n for n in (os.listdir(path) if os.path.isdir(path) else []) if not n.startswith(".")]
    fasta.write_fasta(df.where("id <> 7"), path)
    assert spark.read.format("fasta").load(path).count() == 39


def test_columns_by_similarity(spark):
    rows = ["ACGT-A-C", "ACGTTA-C", "ACGT-A-C", "ACGTCAGC", "ACGA-A-C"]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, aln string")
    scores = {r["k"]: (round(r["gap"], 6), round(r["similarity"], 6)) for r in align.column_scores(df).collect()}
    assert scores[0] == (0.0, 1.0) and scores[3] == (0.0, 0.6) and scores[4] == (0.6, 0.0) and scores[6] == (0.8, 0.0)
    assert [r["aln"] for r in align.trim_similar(df).orderBy("id").collect()] == ["ACGTAC", "ACGTAC", "ACGTAC", "ACGTAC", "ACGAAC"]
    # What scores over one half stays whole, and so do equal rows and a single one.
    for some in (["ACGT", "ACGA", "ACGT"], ["ACGT"] * 3, ["ACGT", "ACTT", "ACAT", "ACCT"]):
        one = spark.createDataFrame(list(enumerate(some)), "id int, aln string")
        assert [r["aln"] for r in align.trim_similar(one).orderBy("id").collect()] == some


def test_repeated_keys_fail_the_job(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "consensus_group string, x int")
    right = spark.createDataFrame([("a", "s"), ("b", None)], "consensus_group string, assigned_sp string")
    assert sorted(r["assigned_sp"] or "" for r in taxonomy.joined(left, right).collect()) == ["", "s"]
    with pytest.raises(Exception, match="taxonomy repeats consensus_group a"):
        taxonomy.joined(left, right.union(right)).collect()
    once = qc.unique(right, "consensus_group", "x")
    assert once.columns == right.columns and once.count() == 2


def test_run_with_evidence_and_counters(spark):
    a, b = "ACGTTGCA" * 20, "TTGACCAT" * 20
    rows = [(f"p{i}", a if i < 6 else b, "[1.0, 2.0]" if i % 2 else None, "GPS" if i != 3 else "Country Centroid", "X y" if i < 6 else "Z w", "X" if i < 6 else "Z", i) for i in range(10)] + [("p0", b, None, "GPS", "X y", "X", 10), ("p20", None, None, "GPS", "X y", "X", 11)]
    df = spark.createDataFrame(rows, "processid string, nuc string, coord string, coord_source string, species string, genus string, ord int")
    config = Config().update(dereplication__min_sequence_length=100, dereplication__min_post_trim_length=100, geographic__exclude_missing=False, geographic__exclude_centroids=False)
    plain = run(df, config, aligned=True)
    assert plain["counters"].first().asDict() == {
        "n_records": 12, "n_processids": 11, "n_with_sequence": 11, "n_without_sequence": 1, "n_with_coordinates": 5, "n_without_coordinates": 7, "n_centroids": 1, "n_duplicates": 1, "n_filtered": 0, "n_kept": 11,
    }
    groups = {r["assigned_sp"]: r["consensus_group"] for r in plain["taxonomy"].collect()}
    evidence = spark.createDataFrame([(groups["X y"], "Better name", "species", 99.5, 95.0)], "consensus_group string, cluster_sp string, cluster_level string, identity_pct double, query_cov_pct double")
    found = run(df, config, aligned=True, evidence=evidence)
    got = {r["assigned_sp"]: (r["final_group_sp"], r["tax_provenance"], r["consensus_group_sp"].rpartition(" ")[0]) for r in found["taxonomy"].collect()}
    assert got == {"X y": ("Better name", "cluster_seq", "Better name"), "Z w": ("Z w", "majority_species", "Z w")}
    with pytest.raises(Exception, match="evidence repeats"):
        run(df, config, aligned=True, evidence=evidence.union(evidence))


@pytest.mark.parametrize(
    "change", [{"dereplication__min_sequence_length": 99}, {"dereplication__min_post_trim_length": 60}, {"dereplication__clustering_threshold": 1}, {"dereplication__clustering_threshold": 0}, {"dereplication__trim_method": "x"}]
)
def test_bounds_of_settings(change):
    with pytest.raises(ValueError):
        Config().update(**change)
