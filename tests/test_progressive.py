"""Progressive alignment against the star, and what it may never change."""

import random

import pytest

from genoflux.operators import align, progressive

from .test_nearest import mutated


def pairs_alike(rows):
    """Sum over columns of the pairs of rows with the same letter."""
    total = 0
    for column in zip(*rows, strict=True):
        for c in "ACGT":
            k = column.count(c)
            total += k * (k - 1) // 2
    return total


def family(seed, n=24, length=150, edits=8):
    r = random.Random(seed)
    heads = ["".join(r.choices("ACGT", k=length))]
    for _ in range(3):
        heads.append(mutated(r, heads[0], edits))
    return [mutated(r, r.choice(heads), r.randrange(0, edits)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_columns_score_at_least_the_star(spark, seed):
    rows = family(seed)
    df = spark.createDataFrame([*enumerate(rows), (99, None), (98, "")], "id int, seq string")
    got = {r["id"]: r["aln"] for r in progressive.align(df).collect()}
    assert got[99] is None and got[98] is None and len(got) == len(rows) + 2
    laid = [got[i] for i in range(len(rows))]
    assert len({len(x) for x in laid}) == 1 and [x.replace("-", "") for x in laid] == rows
    star = {r["id"]: r["aln"] for r in align.star_align(df).collect()}
    assert pairs_alike(laid) >= pairs_alike([star[i] for i in range(len(rows))])


def test_no_gaps_where_none_are_needed(spark):
    r = random.Random(8)
    base = "".join(r.choices("ACGT", k=120))
    rows = []
    for _ in range(9):
        s = list(base)
        for i in r.sample(range(120), 5):
            s[i] = r.choice("ACGTN")
        rows.append("".join(s))
    df = spark.createDataFrame(list(enumerate(rows)), "id int, seq string")
    assert [x["aln"] for x in progressive.align(df).orderBy("id").collect()] == rows


@pytest.mark.parametrize("rows", [[], ["ACGT"], ["ACGT", "ACGT"], ["A", "ACGTACGTACGTACGT"]])
def test_few_sequences(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, seq string")
    got = [r["aln"] for r in progressive.align(df).orderBy("id").collect()]
    assert len({len(x) for x in got}) <= 1 and [x.replace("-", "") for x in got] == rows
