"""The licence classifier's plan stays small."""

from genoflux.llm import license_scan


def test_odds_are_not_written_into_each_other(spark):
    """Each logit stands in the plan a few times, not once for each pair of classes."""
    paras = spark.createDataFrame([(1, 0, ["mit", "license"])], "k int, line int, words array<string>")
    plan = license_scan.classified(paras, ["k"], license_scan.train())._jdf.queryExecution().analyzed().toString()
    assert plan.upper().count("SQRT") < 10 * len(license_scan.CLASSES)
