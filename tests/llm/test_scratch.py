"""What a call leaves in the shared folder."""

import os

import corpus_pipeline
from genoflux.llm import vector_dedup
from genoflux.llm.common import materialize, scratch, shared_dir

FOLDER = "/root/testdata/sf0.001"


def held(spark):
    folder = shared_dir(spark).removeprefix("file://")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_scratch_keeps_what_is_named(spark):
    before = held(spark)
    with scratch(spark) as keep:
        kept = keep(materialize(spark.range(3), "kept"))
        with scratch(spark) as inner:
            inside = inner(materialize(spark.range(4), "inner"))
            materialize(spark.range(5), "gone")
        assert inside.count() == 4
    assert kept.count() == 3 and {n.split("-")[0] for n in held(spark) - before} == {"kept"}
    try:
        with scratch(spark):
            materialize(spark.range(3), "failed")
            raise ValueError
    except ValueError:
        pass
    assert {n.split("-")[0] for n in held(spark) - before} == {"kept"}


def test_vectors_leave_their_result_alone(spark):
    before = held(spark)
    assert vector_dedup.op11_vector_dedup(spark, FOLDER).count() == 500
    assert {n.split("-")[0] for n in held(spark) - before} == {"found"}


def test_pipeline_leaves_the_last_stage(spark):
    before = held(spark)
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    left = {n.rpartition("-")[0] for n in held(spark) - before}
    assert "secrets" in left and not left & {"toxicity", "near-duplicates", "decontamination", "links", "edges", "training"}
