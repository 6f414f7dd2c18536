"""Odd inputs of every corpus operator and stage, and scores against plain Python."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from genoflux.llm import decontaminate, jaccard_join, license_scan, packing, quality_model, quality_rules, secret_scan, token_counts, toxicity, warc
from genoflux.llm.tokens import default_path, word_bpe

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"{a}{b}" for a in ("stone", "river", "cloud", "grass", "light") for b in ("fall", "bed", "less", "y", "ing")]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def labelled(spark, n=120):
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        rows.append((i, prose(60, i) + (" vile scumbag idiot" if bad else "") if i % 4 else "# $ % short", "en", "s", 1))
        labels.append((i, int(i % 4 != 0), int(bad and i % 4 != 0)))
    docs = spark.createDataFrame(rows + [(None, None, None, None, None), (500, "", None, "x", 0), (3, rows[3][1], "en", "s", 1), (3, rows[3][1], "en", "s", 1)], SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def all_of(spark, docs, labels):
    """Every operator's rows on one table."""
    bench = spark.createDataFrame([("b", prose(30, 7)), (None, "x"), ("c", None)], "item_id string, text string")
    lexicon, model = toxicity.train(docs, labels)
    feats = quality_model.features(docs)
    counted = quality_rules.with_counts(docs.withColumn("__lang", F.col("lang")))
    return {
        "secrets": secret_scan.scan(docs), "windows": secret_scan.scan(docs, by_window=True), "redacted": secret_scan.redact(docs),
        "hits": decontaminate.judged(decontaminate.scan(docs, bench)), "quality": quality_model.scored(feats, quality_model.train(feats, labels)),
        "rules": quality_rules.judged(counted, quality_rules.cutoffs(counted, labels, "__lang"), "__lang"), "join": jaccard_join.join(docs), "licences": license_scan.scan(docs),
        "toxicity": toxicity.score(docs, lexicon, model), "tokens": token_counts.count_edited(token_counts.build(docs, ["doc_id"]), F.array(), ["doc_id"]),
    }


def test_every_row_is_answered(spark):
    docs, labels = labelled(spark)
    n = docs.count()
    for name, df in all_of(spark, docs, labels).items():
        assert df.count() == n, name


def test_empty_tables(spark):
    docs, labels = labelled(spark)
    for name, df in all_of(spark, docs.limit(0), labels).items():
        assert df.count() == 0, name
    assert packing.pack(docs.limit(0)).count() == 0
    for name, df in all_of(spark, docs, labels.limit(0)).items():
        assert df.count() == docs.count(), name


NAMES = ["features", "score", "predicted", "base_spans", "all_spans", "n_words", "hit_items", "hit_spans", "tree", "n_before", "rank", "id", "label", "token"]


def test_other_columns_do_not_clash(spark):
    docs, labels = labelled(spark, 24)
    plain, wide = all_of(spark, docs, labels), all_of(spark, docs.withColumns({c: F.lit("kept") for c in NAMES}), labels)
    for name, df in plain.items():
        given = [c for c in df.columns if c != "features"]
        rows = lambda x: sorted(map(repr, x.select(*given).collect()))
        assert rows(df) == rows(wide[name]), name
    assert all(c in wide["redacted"].columns for c in NAMES)


def test_long_texts(spark):
    long = prose(60_000, 1) + " token=" + "Ab3" * 10_000 + " " + "x1" * 60_000
    docs = spark.createDataFrame([(1, long, "en", "s", 1), (2, long, "en", "s", 1), (3, long + " end", "de", "s", 1), (4, "q" * 300_000, "en", "s", 1)], SCHEMA).repartition(4)
    _, labels = labelled(spark)
    began = time.time()
    got = {k: v.count() for k, v in all_of(spark, docs, labels).items()}
    assert set(got.values()) == {4} and time.time() - began < 240
    roots = {r["doc_id"]: r["component_id"] for r in jaccard_join.join(docs).collect()}
    assert roots == {1: 1, 2: 1, 3: 1, 4: 4}
    pieces = packing.pack(docs).agg(F.sum("length")).first()[0]
    bpe = word_bpe(default_path())
    assert pieces == sum(len(bpe.ids_of(t)) + 1 for t in (long, long, long + " end", "q" * 300_000))


def logistic(raw):
    return 1 / (1 + math.exp(-max(min(raw, 30.0), -30.0)))


def test_quality_scores_equal_plain_python(spark):
    docs, labels = labelled(spark)
    feats = quality_model.features(docs)
    model = quality_model.train(feats, labels)
    at = quality_model.CUT_AT
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality_model.scored(feats, model).collect():
        want = logistic(float(quality_model.features_of(texts[r["doc_id"]]) @ model["w"]) - model["cut"] + math.log(at / (1 - at)))
        assert r["score"] == pytest.approx(want) and r["predicted"] == int(r["score"] >= at)


def test_pairwise_loss_is_at_its_minimum():
    """The gradient of the summed pair loss vanishes at the fitted weights."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, quality_model.FEATURES))
    y = (x[:, 0] + rng.normal(size=150) > 0).astype(int)
    model = quality_model.fit(x, y, partners=10**6, ridge=1e-3)
    scale = x.std(axis=0) + 1e-9
    d = (x[y == 1][:, None] - x[y == 0][None]).reshape(-1, x.shape[1]) / scale
    w = model["w"] * scale
    gradient = -(d / (1 + np.exp(d @ w))[:, None]).mean(axis=0) + 1e-3 * w
    assert np.abs(gradient).max() < 1e-5


def test_toxicity_scores_equal_plain_python(spark):
    docs, labels = labelled(spark)
    lexicon, model = toxicity.train(docs, labels)
    fresh = toxicity.Lexicon(lexicon.terms, *lexicon.totals)
    at = toxicity.CUT_AT
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in toxicity.score(docs, lexicon, model).collect():
        raw = float(np.dot(fresh.features(texts[r["doc_id"]]), model["w"])) + model["bias"] + math.log(at / (1 - at))
        assert r["score"] == pytest.approx(logistic(raw)) and r["predicted"] == int(r["score"] >= at)


def test_toxicity_forgets_without_changing(monkeypatch):
    terms = {"idiot": (9, 0), "moron": (9, 1), "worthl*": (9, 0)}
    words = ["".join(random.Random(k).choices("idotmrnwl", k=random.Random(k).randint(3, 60))) for k in range(400)] + ["diiot", "idio", "morron", "worthless", "x" * 100_000]
    want = [toxicity.Lexicon(terms, 20, 100).features(w) for w in words]
    monkeypatch.setattr(toxicity, "_CHUNKS", 5)
    monkeypatch.setattr(toxicity, "_SPOTS", 50)
    small = toxicity.Lexicon(terms, 20, 100)
    assert [small.features(w) for w in words] == want


def test_licence_classes_equal_plain_python(spark):
    """A line's class and probability, computed from the weights in plain Python."""
    model = license_scan.train()
    rng = random.Random(4)
    lines = [" ".join(w for w in t.split() if rng.random() > 0.15) for ts in license_scan.TEMPLATES.values() for t in ts] + license_scan.NEAR_MISSES
    lines = [t for t in lines if license_scan.words_of(t)]
    paras = spark.createDataFrame([(i, 0, license_scan.words_of(t)) for i, t in enumerate(lines)], "k bigint, line int, words array<string>")
    got = {r["k"]: (r["family"], r["probability"]) for r in license_scan.classified(paras, ["k"], model).collect()}
    want = {}
    for i, t in enumerate(lines):
        found = license_scan.grams(license_scan.words_of(t))
        z = sum((model["weights"][g] for g in found if g in model["weights"]), np.zeros(len(license_scan.CLASSES))) / math.sqrt(len(found)) + model["bias"]
        p = np.exp((z - z.max()) / model["temperature"])
        p /= p.sum()
        if p.argmax() and p.max() >= model["least"]:
            want[i] = (license_scan.CLASSES[p.argmax()], p.max())
    assert got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)


def test_evidence_by_plain_searches_first(spark):
    parts = [*license_scan.STEMS, *license_scan.PHRASES, "gnu", "MPL", "isc", "under MIT", "cc by", "bsd", "epl-", "cc0", "discuss", "example", "mit"]
    rng = random.Random(9)
    texts = [rng.choice(["", "a", "é", "İ", "-", "\u212a"]) + p.replace(" ", rng.choice([" ", "\n", ", ", "\t- ", "x"])).swapcase() + rng.choice(["", "s", ".", "ß"]) for p in parts for _ in range(12)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select("text", license_scan.evident(F.col("text")).alias("e"), F.col("text").rlike(license_scan.ANCHOR).alias("a")).collect()
    assert all(r["e"] == r["a"] for r in got) and 0 < sum(r["e"] for r in got) < len(got)


UNKNOWN = [
    "Licensed under the European Union Public Licence, version 1.2.",
    "This software is licensed under the Boost Software License, Version 1.0.",
    "You may copy this program under the terms of the Artistic License.",
    "Licensed under the Intel Open Source License.",
    "Use is governed by the Ruby licence.",
    "This font is licensed under the Ubuntu Font Licence.",
]


def test_licences_that_no_family_covers(spark):
    got = license_scan.scan(spark.createDataFrame(list(enumerate(UNKNOWN)), "doc_id bigint, text string")).collect()
    assert all(r["n_confirmed"] == 0 for r in got), got


def folder(spark, tmp_path, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("b", prose(30, 7))], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline_of_odd_tables(spark, tmp_path):
    docs, labels = labelled(spark, 30)
    empty = folder(spark, tmp_path / "empty", docs.limit(0), labels)
    assert corpus_pipeline.run(spark, empty).count() == 0
    bare = folder(spark, tmp_path / "bare", docs.withColumn("text", F.lit(None).cast("string")), labels)
    assert corpus_pipeline.run(spark, bare).count() == docs.count()
    whole = folder(spark, tmp_path / "whole", docs, labels)
    kept = corpus_pipeline.run(spark, whole)
    # Rows of one id stand and fall together, and rows without an id or a text stay.
    assert kept.where("doc_id IS NULL").count() == 1 and kept.where("doc_id = 500").count() == 1
    assert kept.where("doc_id = 3").count() in (0, 3)


def test_archive_of_odd_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string, shard int")
    assert warc.write(pages, f"file://{tmp_path}/a").count() == 0
    big = "<p>" + "z" * 3_000_000
    pages = spark.createDataFrame([(i, "u", big, 5) for i in (4, 2, 9)], "page_id bigint, url string, html string, shard int")
    warc.write(pages, f"file://{tmp_path}/b", roll_bytes=2000)
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read(spark, f"file://{tmp_path}/b").collect()}
    assert got == {2: ("response", None, 3_000_003), 4: ("revisit", 2, 3_000_003), 9: ("revisit", 2, 3_000_003)}
