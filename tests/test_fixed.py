"""Decimals as C prints them."""

import random

from genoflux.functions import sequence
from genoflux.operators import aggregates


def test_fixed_decimals_are_those_of_c(spark):
    r = random.Random(2)
    values = [k / 16 for k in range(400)] + [(2 * k + 1) / 20 for k in range(500)] + [(2 * k + 1) / 2000 for k in range(500)] + [k / n * 100 for n in (7, 16, 80, 400, 1600) for k in range(60)] + [r.random() * 10 ** r.randrange(-3, 7) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in [*values, -0.25, -1.5, None]], "v double")
    for digits in (1, 2, 3):
        for v, text in df.select("v", sequence.fixed(df["v"], digits)).collect():
            assert text == (None if v is None else f"{v:.{digits}f}"), v


def test_shares_of_names_as_sql_prints_them(spark):
    """1 of 16 is 6.25 per cent: printed 6.2, not 6.3."""
    df = spark.createDataFrame([("c1", "a" if k else "b") for k in range(16)], "consensus_group string, species string")
    assert aggregates.composition(df).first()["composition"] == "a: 15 (93.8%), b: 1 (6.2%)"
