"""Queries that must see every row of their table."""

from itertools import combinations

from genoflux.plans import fixtures
from genoflux.plans.queries import QUERIES


def documents(spark, tmp_path, n=160):
    rows = [(i, "en", "web") for i in range(n)]
    spark.createDataFrame(rows, "doc_id bigint, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def masked(x, y):
    both = [(a, b) for a, b in zip(x, y, strict=True) if a in "ACGT" and b in "ACGT"]
    return 1.0 - sum(a == b for a, b in both) / len(both) if both else 1.0


def test_all_pairs_of_all_specimens(spark, tmp_path):
    folder = documents(spark, tmp_path)
    first, count = {}, {}
    for r in fixtures.specimens(spark, folder).select("ord", "aln").orderBy("ord").collect():
        first.setdefault(r["aln"], r["ord"])
        count[r["aln"]] = count.get(r["aln"], 0) + 1
    want = {(first[x], first[y], count[x], count[y]): round(masked(x, y), 9) for x, y in combinations(first, 2)}
    got = QUERIES["k1_all_pairs"](spark, folder).collect()
    assert {(r["i"], r["j"], r["n_i"], r["n_j"]): round(r["dist"], 9) for r in got} == want and len(got) == len(want)
    # Pairs of specimens: those of different sequences and those of one.
    assert sum(r["n_i"] * r["n_j"] for r in got) + sum(n * (n - 1) // 2 for n in count.values()) == 160 * 159 // 2


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, z in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != z))
    return row[-1]


def test_distance_of_every_row(spark, tmp_path):
    parts = [(1, "cold widget", "ECONOMY"), (2, "", "PROMO"), (51, "promo", "PROMO"), (52, None, "ECONOMY"), (53, "large bolt", "STANDARD")]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r["p_partkey"]: r["dist"] for r in QUERIES["p15_levenshtein_rows"](spark, str(tmp_path)).collect()}
    assert got == {k: None if n is None else edits(n, t.lower()) for k, n, t in parts}
