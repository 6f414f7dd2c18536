"""Operators against brute force and fixed cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoflux import config
from genoflux.config import Config, parse_value
from genoflux.functions import coords, names, sequence
from genoflux.operators import align, assign, cluster, consensus, distance, geo, qc, reports, taxonomy, tree
from genoflux.plans import fixtures


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text,want",
    [
        ("[34.5, -76.2]", (34.5, -76.2)), ("34.5, -76.2", (34.5, -76.2)), ("34.5 -76.2", (34.5, -76.2)), ("(90, 180)", (90.0, 180.0)),
        ("nope", None), ("", None), (None, None), ("91, 0", None), ("0, 181", None), ("1,2,3", None), ("nan, nan", None), ("1e1, 2", (10.0, 2.0)),
    ],
)
def test_coordinates(spark, text, want):
    got = one(spark, coords.coordinate_pair(F.lit(text).cast("string")))
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize("header,want", [("Sphyrna_lewini_ANGBF11456-15.COI-5P", "ANGBF11456-15"), ("species_BOLD12345", "BOLD12345"), ("plain", None), ("Genus_sp. x_PID1.COI", "sp")])
def test_processid(spark, header, want):
    assert one(spark, sequence.processid_of(F.lit(header))) == want


@pytest.mark.parametrize(
    "seq,want",
    [("ACGT" * 30, None), ("acgt" * 30, None), ("ACGT", "too_short"), ("N" * 80 + "A" * 40, "too_many_n"), ("-" * 170 + "ACGT" * 10, "too_many_gaps"), ("ACGR" * 30, "invalid_characters"), (None, "too_short")],
)
def test_validation(spark, seq, want):
    assert one(spark, sequence.invalid_reason(F.lit(seq).cast("string"))) == want


def test_cigar(spark):
    assert tuple(one(spark, sequence.cigar_counts(F.lit("5=1X4=2I3D1M")))) == (10, 1, 2, 3)
    assert tuple(one(spark, sequence.cigar_counts(F.lit("")))) == (0, 0, 0, 0)


def test_path_identity_cases():
    assert assign.align_path("ACTGACTGNNNN", "ACTGACTG")[:4] == (8, 0, 4, 0)
    assert assign.align_path("ACTG", "ACTGACTG")[:4] == (4, 0, 0, 4)
    assert assign.align_path("", "AC")[:4] == (0, 0, 0, 2)


def test_path_distance_is_levenshtein(spark):
    random.seed(1)
    pairs = [("".join(random.choices("ACG", k=random.randint(0, 12))), "".join(random.choices("ACG", k=random.randint(0, 12)))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "q string, t string").select("q", "t", F.levenshtein("q", "t").alias("d"))
    for q, t, d in df.collect():
        m, x, i, dd, _ = assign.align_path(q, t)
        assert x + i + dd == d and m + x + i == len(q) and m + x + dd == len(t)


def masked(a, b):
    used = [(x, y) for x, y in zip(a.upper(), b.upper()) if x in "ACGT" and y in "ACGT"]
    return 1.0 if not used else 1 - sum(x == y for x, y in used) / len(used)


@pytest.mark.parametrize("method", assign.METHODS)
def test_paths_of_contenders_give_the_same_top(spark, method):
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    roots = [letters(rng.randint(20, 40)) for _ in range(4)]
    vary = lambda s: "".join(c for c in s for c in (c, "", "A", c + "G")[0 if rng.random() > 0.2 else rng.randint(1, 3)])
    cons = [(f"g{k}", vary(rng.choice(roots)), k) for k in range(12)] + [("same", roots[0], 12), ("again", roots[0], 13)]
    nucs = sorted({vary(rng.choice(roots)) or "A" for _ in range(25)})
    c = spark.createDataFrame(cons, "consensus_group string, consensus_seq string, ord long")
    s = spark.createDataFrame([(n,) for n in nucs], "nuc string")
    metric = "target_identity" if method == "target_based" else "classic_identity"

    def top(rows):
        by = {}
        for r in rows:
            by.setdefault(r["nuc"], []).append((-r[metric], r["c_ord"], r["consensus_group"], r["matches"]))
        return {n: sorted(v)[:2] for n, v in by.items()}

    every, some = (assign.scored(s, c, path=True, top_by=by).collect() for by in (None, method))
    assert len(every) == len(nucs) * len(cons) and len(some) < len(every)
    assert top(some) == top(every)


def test_distances(spark):
    random.seed(2)
    seqs = ["".join(random.choices("ACGTN-acgt", k=150)) for _ in range(23)] + ["-" * 150]
    df = spark.createDataFrame([(str(i), i, s) for i, s in enumerate(seqs)], "seq_id string, ord bigint, aln string")
    got = {(r["i"], r["j"]): r["dist"] for r in distance.pairwise(df, blocks=5).collect()}
    assert len(got) == 24 * 23 // 2
    for (i, j), d in got.items():
        assert d == pytest.approx(masked(seqs[i], seqs[j]))


def test_unequal_alignment_is_an_error(spark):
    with pytest.raises(ValueError):
        distance.check_alignment(spark.createDataFrame([("a", "AC"), ("b", "ACG")], "seq_id string, aln string"))


def naive(d, t, method):
    groups = [[i] for i in range(len(d))]
    weight = {(i, j): d[i, j] for i in range(len(d)) for j in range(len(d)) if i != j}
    ids = list(range(len(d)))
    nxt = len(d)
    while len(ids) > 1:
        a, b = min(((x, y) for x in ids for y in ids if x < y), key=lambda p: weight[p])
        if weight[(a, b)] > t:
            break
        na, nb = len(groups[a]), len(groups[b])
        groups.append(groups[a] + groups[b])
        for k in ids:
            if k not in (a, b):
                x, y = weight[(min(a, k), max(a, k))], weight[(min(b, k), max(b, k))]
                weight[(min(k, nxt), max(k, nxt))] = {"average": (na * x + nb * y) / (na + nb), "complete": max(x, y), "single": min(x, y), "weighted": (x + y) / 2}[method]
        ids = [k for k in ids if k not in (a, b)] + [nxt]
        nxt += 1
    return {frozenset(groups[k]) for k in ids}


@pytest.mark.parametrize("method", ["single", "complete", "average", "weighted"])
def test_clusters(spark, method):
    rng = np.random.default_rng(3)
    p = rng.random((18, 2))
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
    rows = [(i, j, float(d[i, j])) for i in range(18) for j in range(i + 1, 18)]
    nodes = spark.createDataFrame([(i,) for i in range(18)], "ord bigint")
    got = cluster.clusters(nodes, spark.createDataFrame(rows, "i bigint, j bigint, dist double"), 0.25, method).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["cluster_id"], set()).add(r["ord"])
    assert {frozenset(g) for g in groups.values()} == naive(d, 0.25, method)


@pytest.mark.parametrize("method", ["single", "complete", "average", "weighted", "ward"])
def test_clusters_of_an_alignment(spark, method):
    """Distances inside components give what a table of all pairs gives, and what repeated merging of the nearest pair gives."""
    random.seed(8)
    heads = ["".join(random.choices("ACGT", k=400)) for _ in range(4)]
    seqs = []
    for k in range(30):
        s = list(heads[k % 4])
        for i in random.sample(range(400), random.randint(0, 9)):
            s[i] = random.choice("ACGTN-")
        seqs.append("".join(s))
    df = spark.createDataFrame([(str(i), i, s) for i, s in enumerate(seqs)], "seq_id string, ord bigint, aln string")
    groups = lambda rows: {frozenset(r["ord"] for r in rows if r["cluster_id"] == c) for c in {r["cluster_id"] for r in rows}}
    got = cluster.cluster_alignment(df, 0.02, method).collect()
    assert groups(got) == groups(cluster.clusters(df, distance.pairwise(df), 0.02, method).collect())
    firsts = [min(r["ord"] for r in got if r["cluster_id"] == c) for c in sorted({r["cluster_id"] for r in got})]
    assert firsts == sorted(firsts) and sorted({r["cluster_id"] for r in got}) == list(range(1, len(firsts) + 1))
    d = cluster.masked_distances(seqs)
    heights = [h for *_, h, _ in cluster.linkage(d, method)]
    assert heights == sorted(heights) and cluster.linkage(d, method)[-1][3] == len(seqs)


def test_clusters_reject_bad_settings(spark):
    n = spark.createDataFrame([(1,)], "ord bigint")
    e = spark.createDataFrame([], "i bigint, j bigint, dist double")
    with pytest.raises(ValueError):
        cluster.clusters(n, e, 2.0)
    with pytest.raises(ValueError):
        cluster.clusters(n, e, 0.1, "median")
    assert cluster.clusters(n, e, 0.1).count() == 1


def test_consensus(spark):
    rows = [(1, 1, "ACGT"), (1, 2, "ACGT"), (1, 3, "ACGT"), (1, 4, "TC-N"), (2, 5, "----"), (2, 6, "NNNN")]
    got = {r["cluster_id"]: r for r in consensus.consensus(spark.createDataFrame(rows, "cluster_id int, ord bigint, aln string")).collect()}
    assert (got[1]["consensus_seq"], got[1]["n_reference"], got[1]["consensus_group"]) == ("ACGT", 4, "consensus_c1")
    assert got[2]["consensus_seq"] == ""


def test_assignment_without_sequence_and_single_consensus(spark):
    s = spark.createDataFrame([("a", None), ("b", ""), ("c", "ACGTACGT")], "processid string, nuc string")
    c = spark.createDataFrame([("g1", "ACGTACGT", 0)], "consensus_group string, consensus_seq string, ord bigint")
    got = {r["processid"]: r for r in assign.assign(s, c).collect()}
    assert got["a"]["status"] == got["b"]["status"] == "no_sequence"
    assert got["c"]["status"] == "assigned" and got["c"]["runner_up_group"] is None and got["c"]["runner_up_identity"] == -1.0
    with pytest.raises(ValueError):
        assign.assign(s, c, identity_method="other")


def test_vote(spark):
    rows = [("g1", "A a", "A", 1), ("g1", "A a", "A", 2), ("g1", "B b", "B", 3), ("g2", "A a", "A", 4), ("g2", "B b", "B", 5), (None, "A a", "A", 6), ("g3", None, None, 7)]
    got = {r["consensus_group"]: (r["assigned_sp"], r["assignment_level"]) for r in taxonomy.vote(spark.createDataFrame(rows, "consensus_group string, species string, genus string, ord bigint")).collect()}
    assert got == {"g1": ("A a", "species"), "g2": ("A", "genus"), "g3": ("", "unassigned")}


def test_polygon_with_hole(spark):
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    rings = [ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((4, 4), (6, 4), (6, 6), (4, 6))]
    assert geo.ring_contains(1, 1, rings) and not geo.ring_contains(5, 5, rings)
    assert not geo.ring_contains(0, 5, rings) and not geo.ring_contains(11, 5, rings)
    assert geo.nearest_edge(1, 5, rings) == (0.0, 5.0)


def test_polygons_held_or_carried(spark, monkeypatch):
    shapes = [
        ("A", 0, [[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]]),
        ("B", 1, [[(8, 8), (20, 8), (14, 20)]]),
        ("C", 2, [[(5, 5), (5.5, 5), (5.5, 5.5)]]),
    ]
    rows = [(n, k, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings], *(float(f(v[i] for r in rings for v in r)) for f, i in ((min, 0), (min, 1), (max, 0), (max, 1)))) for n, k, rings in shapes]
    polygons = spark.createDataFrame(rows, "basin_name string, poly_ord int, rings array<array<struct<x:double,y:double>>>, xmin double, ymin double, xmax double, ymax double")
    spots = spark.createDataFrame([(y / 2, x / 2) for x in range(-2, 44) for y in range(-2, 44)], "point_lat double, point_lon double")

    def found():
        basins = {(r[0], r[1]): r[2] for r in geo.first_basin(spots, polygons).collect()}
        moved = geo.classify_coordinates(spots.toDF("latitude", "longitude"), polygons, "snap").collect()
        near = geo.valid_marine(spots.toDF("lat", "lon"), polygons, 0.5).where("is_marine").count()
        return basins, sorted(map(str, moved)), near

    held = found()
    want = {}
    for y, x in ((y / 2, x / 2) for x in range(-2, 44) for y in range(-2, 44)):
        name = next((n for n, _, rings, *_ in rows if geo.ring_contains(x, y, rings)), None)
        if name:
            want[y, x] = name
    assert held[0] == want and {"A", "B"} <= set(want.values())
    monkeypatch.setattr(geo, "BROADCAST_VERTICES", 0)
    monkeypatch.setattr(geo, "AT_ONCE", 8)
    assert found() == held


def test_basin_fallback(spark):
    s = spark.createDataFrame([("a", 10.0, -20.0, None), ("b", 95.0, 0.0, "Sea X"), ("c", None, None, "")], "processid string, lat double, lon double, country_ocean string")
    got = {r["processid"]: r["ocean_basin"] for r in geo.assign_basins(s, fixtures.boxes(spark), country_ocean="country_ocean").collect()}
    assert got == {"a": "North Atlantic Ocean", "b": "Sea X", "c": "Unknown"}


def test_newick_round_trip():
    text = "((A:0.1,B_n2:0.2)90:0.05,('C c':0.3,D:0.4)60:0.1);"
    root = tree.parse(text)
    assert [t.name for t in root.tips()] == ["A", "B_n2", "C c", "D"]
    assert tree.write(tree.parse(tree.write(root))) == tree.write(root)
    assert tree.relabel_newick(text, {"B": "sp B"}).count("'sp B'") == 1
    places = {r["name"]: (r["x"], r["y"]) for r in tree.layout(root) if r["is_tip"]}
    assert places["A"] == (pytest.approx(0.15), 0.0) and places["D"][1] == 3.0
    with pytest.raises(ValueError):
        tree.parse("((A,B);")


def test_star_align(spark):
    df = spark.createDataFrame([(1, "ACGTACGT"), (2, "ACGTACGT"), (3, "ACGACGT"), (4, "ACGTTACGT"), (5, None)], "ord bigint, seq string")
    got = {r["ord"]: r["aln"] for r in align.star_align(df).collect()}
    assert got[5] is None and len({len(v) for v in got.values() if v}) == 1
    assert all(got[k].replace("-", "") == s for k, s in ((1, "ACGTACGT"), (3, "ACGACGT"), (4, "ACGTTACGT")))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "processid string, nuc string, coord string, coord_source string, ord bigint, species string, genus string, consensus_group string")
    assert qc.keep_first(empty, "processid").count() == 0
    assert qc.filter_coordinates(qc.with_coordinates(empty)).count() == 0
    assert taxonomy.vote(empty).count() == 0
    assert qc.preflight(empty)[0] is False


def test_config(tmp_path):
    c = Config().update(taxonomy__majority_species_threshold=0.6)
    c.save(str(tmp_path / "c.json"))
    from genoflux.config import load

    assert load(str(tmp_path / "c.json")) == c
    assert parse_value("1") is True and parse_value("4") == 4 and parse_value("0.5") == 0.5
    with pytest.raises(ValueError):
        Config().update(dereplication__clustering_threshold=2)
    with pytest.raises(ValueError):
        Config().update(nothing__here=1)


def test_names():
    assert names.organism_of_path("/x/Sphyrna_lewini_data.tsv") == "Sphyrna_lewini"
    assert names.organism_of_path("Carcharhinus_data.tsv") == "Carcharhinus"
    assert names.compare_versions("1.10", "1.9") == 1 and names.elapsed(3700) == "1h 1m 40s"


def test_sources(spark, tmp_path):
    from genoflux.sources import fasta, sinks, tables

    (tmp_path / "a.tsv").write_bytes("processid\tnuc\tspecies\nA\t ACGT\tX é\nB\tNA\tY\nA\tTTTT\tZ\n A\tGG\t\n".encode("latin-1"))
    got = tables.read_specimens(spark, str(tmp_path / "a.tsv")).orderBy("ord").collect()
    assert [(r["processid"], r["nuc"], r["species"]) for r in got] == [("A", "ACGT", "X é"), ("B", None, "Y"), ("A", "GG", None)]
    with pytest.raises(ValueError):
        tables.read_specimens(spark, str(tmp_path / "a.tsv"), required=("other",))
    assert tables.header_ok(spark, str(tmp_path / "a.tsv")) and not tables.header_ok(spark, str(tmp_path / "none.tsv"))
    (tmp_path / "a.fasta").write_text("junk\n>one two\nacg\nT\n\n>b\nGG\n")
    assert [(r["header"], r["seq"]) for r in fasta.read_fasta(spark, str(tmp_path / "a.fasta")).orderBy("ord").collect()] == [("one two", "ACGT"), ("b", "GG")]
    assert fasta.valid_fasta(spark, str(tmp_path / "a.fasta"))
    fasta.register(spark)
    for size in (1, 7, 1000):
        rows = spark.read.format("fasta").option("path", str(tmp_path / "a.fasta")).option("rangeBytes", size).load().orderBy("ord").collect()
        assert [(r["header"], r["seq"]) for r in rows] == [("one two", "ACGT"), ("b", "GG")]
    (tmp_path / "many").mkdir()
    (tmp_path / "many/a.fasta").write_text(">a1\nAC\n>a2\nGG\n")
    (tmp_path / "many/b.fasta").write_text("junk\n>b1\nTT\n")
    (tmp_path / "many/c.fasta").write_text(">c1\nCC\n>c2\nAA")
    want = [("a1", "AC"), ("a2", "GG"), ("b1", "TT"), ("c1", "CC"), ("c2", "AA")]
    assert sorted((r["header"], r["seq"]) for r in fasta.read_fasta(spark, str(tmp_path / "many")).collect()) == want
    for where in (str(tmp_path / "many"), f"file://{tmp_path}/many"):
        assert [(r["header"], r["seq"]) for r in spark.read.format("fasta").option("path", where).option("rangeBytes", 4).load().orderBy("ord").collect()] == want
    (tmp_path / "empty.fasta").write_text("")
    with pytest.raises(ValueError):
        fasta.read_fasta(spark, str(tmp_path / "empty.fasta"))
    df = spark.createDataFrame([("x", "A" * 170)], "header string, seq string")
    assert fasta.fasta_lines(df).first()["value"] == ">x\n" + "A" * 80 + "\n" + "A" * 80 + "\n" + "A" * 10
    sinks.write_annotated(df, str(tmp_path / "out"))
    sinks.html_report("t", {"s": df, "n": "text"}, str(tmp_path / "r.html"))
    assert "<table>" in (tmp_path / "r.html").read_text()
    (tmp_path / "p.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"name":"B"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]]]}}]}')
    poly = tables.read_polygons(spark, str(tmp_path / "p.json"))
    assert tuple(poly.select("basin_name", "xmin", "ymax").first()) == ("B", 0.0, 4.0)


LOG = """[2024-01-01 09:00:00] Logging to file: old
====
Pipeline - old
Found 9 duplicate processids
[2024-01-01 10:00:00] Logging to file: new
====
Pipeline - new
Input TSV: /data/in.tsv
Read 12 rows and 30 columns
After removing duplicates: 11 rows remaining
Retained 10/11 samples after coordinate filtering
Total samples: 99
Running trimAl: trimal -automated1 -in a.fasta
Identified 2 unique genotypes
Identified 3 unique genotypes
Genotype assignment summary:
  Total samples: 10
  Successfully assigned: 9 (90.0%)
  - Ties (ambiguous): 1
Spatial join results: 8 assigned to basins, 2 outside all basins
Assigned 2 samples with coordinates to 'Unknown' basin
[2024-01-01 10:01:30] Pipeline completed successfully
"""


def test_log_metrics(spark, tmp_path):
    from genoflux.sources import tables

    (tmp_path / "run.log").write_text(LOG)
    (tmp_path / "none.log").write_text("Read 12 rows and 30 columns\n")
    got = {r["log"].rpartition("/")[2]: r.asDict() for r in tables.log_metrics(spark, str(tmp_path)).collect()}
    m = got["run.log"]
    want = {
        "total_samples_loaded": 12, "unique_samples": 11, "samples_after_coord_filter": 10, "consensus_genotypes": 3, "samples_for_assignment": 10, "successfully_assigned": 9, "assignment_rate": 90,
        "ties_flagged": 1, "ocean_basin_assigned": 8, "outside_basins": 2, "unknown_basin": 2, "duplicates_removed": None, "input_file": "/data/in.tsv", "trimal_params": "-automated1", "mafft_params": None, "seconds": 90,
    }
    assert {k: m[k] for k in want} == want
    assert all(v is None for k, v in got["none.log"].items() if k != "log")
    said = reports.said_in_log(m)
    assert said.startswith("12 specimens were read. 10 passed") and said.endswith("The trimmer ran with -automated1.") and "repeated" not in said
    assert reports.said_in_log(got["none.log"]) == ""


def test_dendrogram_and_template(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0, "ACGTACGTAC"), ("b", 1, "ACGTACGTAA"), ("c", 2, "TTTTACGTAA")], "name string, ord bigint, aln string")
    got = [tuple(r) for r in cluster.dendrogram(rows).orderBy("step").collect()]
    assert got[0][1:5] == (0, 1, "a", "b") and got[0][5:] == (pytest.approx(0.1), 2)
    assert set(got[1][1:3]) == {2, 3} and got[1][5:] == (pytest.approx((0.4 + 0.3) / 2), 3)
    assert cluster.dendrogram(rows.limit(1)).count() == 0
    config.write_template(str(tmp_path / "t.json"))
    assert config.load(str(tmp_path / "t.json")) == config.Config()
    assert "dereplication.clustering_threshold = " in reports.parameters(config.Config())


def test_stream_equals_batch(spark, tmp_path):
    from genoflux.streaming.assign_stream import assign_stream, stream_specimens

    s = spark.createDataFrame([("a", "ACGTACGT"), ("b", "ACGTTCGT"), ("c", None)], "processid string, nuc string")
    c = spark.createDataFrame([("g1", "ACGTACGT", 0), ("g2", "TTTTTTTT", 1)], "consensus_group string, consensus_seq string, ord bigint")
    s.repartition(2).write.parquet(str(tmp_path / "in"))
    q = assign_stream(stream_specimens(spark, str(tmp_path / "in"), s.schema, max_files=1), c, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("processid", "status").collect()
    want = assign.assign(s, c).select("processid", "status").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_command_line(spark, tmp_path):
    from genoflux.cli import main

    random.seed(5)
    bases = ["".join(random.choices("ACGT", k=150)) for _ in range(2)]
    rows = ["processid\tnuc\tcoord\tcoord_source\tspecies\tgenus"]
    for i in range(12):
        s = list(bases[i % 2])
        s[10 + i] = "A"
        rows.append(f"P{i}\t{''.join(s)}\t[{i}.5, -{i}.25]\tGPS\tGen sp{i % 2}\tGen")
    (tmp_path / "Gen_sp_data.tsv").write_text("\n".join(rows) + "\n")
    Config().update(dereplication__min_sequence_length=100, dereplication__min_post_trim_length=100).save(str(tmp_path / "c.json"))
    assert main(["run", str(tmp_path / "Gen_sp_data.tsv"), "--output", str(tmp_path / "out"), "--config", str(tmp_path / "c.json"), "--min-identity", "0.8", "--build-tree"]) == 0
    got = spark.read.csv(str(tmp_path / "out/annotated"), header=True)
    assert got.count() == 12 and got.select("consensus_group").distinct().count() == 2
    assert {r["assigned_sp"] for r in got.collect()} == {"Gen sp0", "Gen sp1"}
    assert "Methods" in (tmp_path / "out/report.html").read_text()
    assert (tmp_path / "out/tree.nwk").read_text().endswith(";\n") and "Gen sp0" in (tmp_path / "out/tree_relabeled.nwk").read_text()
    # The run's own files are what the other command takes.
    assert main(["cluster-diagnostics", "--consensus", str(tmp_path / "out/consensus_fasta"), "--metadata", str(tmp_path / "out/consensus_metadata"), "--diagnostics", str(tmp_path / "out/diagnostics"), "--output", str(tmp_path / "stats")]) == 0
    assert spark.read.csv(str(tmp_path / "stats"), header=True, sep="\t").count() == spark.read.csv(str(tmp_path / "out/consensus_metadata"), header=True).count()
