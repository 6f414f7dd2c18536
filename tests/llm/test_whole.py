"""Corpus operators on what a shorter job would miss."""

import hashlib
import random
import uuid

import pytest

from genoflux.llm import jaccard_join, license_scan, secret_scan
from .test_small import brute_components

HELD_OUT = {
    "This dataset is licensed under CC BY-NC 4.0": "CC-BY-NC",
    "Figures are licensed under a Creative Commons Attribution-NonCommercial 4.0 licence.": "CC-BY-NC",
    "Content licensed under CC BY-ND 3.0": "CC-BY-ND",
    "All texts: CC BY 4.0": "CC-BY",
    "Distributed under the MIT license.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "The server is licensed under the GNU Affero General Public License.": "AGPL",
    "Made available under the Eclipse Public License 2.0": "EPL",
    "Distributed under the ISC license": "ISC",
    "Released under the Apache License 2.0": "Apache-2.0",
    "Distributed under GPL v2 or later.": "GPL",
    "Available under LGPL 2.1": "LGPL",
    "(c) 2019, BSD 3-Clause": "BSD",
}


def scanned(spark, texts):
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    return {r["doc_id"]: r for r in rows}


def test_licence_lines_outside_the_templates(spark):
    assert not set(HELD_OUT) & {t for ts in license_scan.TEMPLATES.values() for t in ts}
    got = scanned(spark, list(HELD_OUT))
    assert [got[i]["families"] for i in range(len(HELD_OUT))] == list(HELD_OUT.values())


def test_licence_of_the_data_is_confirmed(spark):
    got = scanned(spark, ["Then are Of it.\nLicensed under CC BY-NC 4.0."])
    assert got[0]["findings"] == "1:CC-BY-NC:confirmed"


def test_wrapped_licences(spark):
    wrapped = {
        "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and associated\ndocumentation files, to deal in the Software\nwithout restriction.": "MIT",
        "Some words before it.\n\n\nThis library is free\nsoftware; you can redistribute it and/or modify it under the terms of the GNU\nLesser General Public License.\n \nAnd after.": "LGPL",
        "First line of a page\nof other words\nLicensed under the Eclipse\nPublic License 2.0.\nand more of them": "EPL",
        "Neither the name of the copyright holder nor\nthe names of its contributors may be used to\nendorse or promote products derived from this\nsoftware without specific prior written permission.": "BSD",
    }
    got = scanned(spark, list(wrapped))
    for i, family in enumerate(wrapped.values()):
        assert got[i]["families"] == family and got[i]["findings"].endswith(f"{family}:confirmed"), got[i]
    assert got[2]["findings"] == "2:EPL:confirmed"
    assert got[1]["findings"].split(":")[0] in ("3", "4")


def digest(name, i):
    return hashlib.new(name, str(i).encode()).hexdigest()


def made(i):
    return {"SHA-1": digest("sha1", i).upper(), "MD5": digest("md5", i).upper(), "uuid": str(uuid.UUID(hex=digest("md5", i)))}


def test_secrets_by_window(spark):
    texts = [(f"{kind}{i}", f"see {x} now") for i in range(150) for kind, x in made(i).items()]
    rows = secret_scan.scan(spark.createDataFrame(texts, "doc_id string, text string"), by_window=True).collect()
    for kind in made(0):
        found = [bool(r["all_spans"]) for r in rows if r["doc_id"].startswith(kind)]
        assert sum(found) >= 0.97 * len(found), (kind, sum(found))


def test_allow_words_suppress_only_their_windows(spark):
    key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    upper = key.upper()
    texts = [f"at /sample/keys/{upper} end", "at sample0123456789abcdefghij end", "dGhQzcyBpWcyBhIHNlYJldCBrZXkgMTIz", "AbQzXrTyUvKpLmNwSdGhJcEfBi", "plain-hyphenated-words-without-any-digit", f"example-{key[:22]}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["all_spans"]] for r in secret_scan.scan(frame, by_window=True).collect()}
    at = texts[0].index(upper)
    assert any(k == 3 and a <= at + 1 and b >= at + len(upper) for a, k, b in got[0])
    assert got[1] == [] and got[2] and got[3] and got[4] == []
    assert got[5] and all(a >= len("example") for a, _, _ in got[5])
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(frame).collect()}
    assert upper[1:] not in clean[0] and clean[1] == texts[1]
    # Nothing that the whole-candidate rule finds is lost.
    for r in secret_scan.scan(frame).collect():
        covered = {p for a, _, b in got[r["doc_id"]] for p in range(a, b)}
        assert all(p in covered for a, _, b in r["all_spans"] for p in range(a, b))


@pytest.mark.parametrize("links", [True, False])
def test_links_of_a_group_are_all_found(spark, monkeypatch, links):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "SETS", 9)
    monkeypatch.setattr(jaccard_join, "LEAF", 2)
    draw = random.Random(3)
    words = [f"w{i}" for i in range(90)]
    texts = []
    for size in (25, 6, 1):
        base = draw.choices(words, k=80)
        texts += [" ".join([*base[:i], f"new{i}", *base[i + 1 :]]) for i in draw.sample(range(80), size)]
    texts += [texts[0], texts[0].upper(), texts[30], "", None]
    sets, root = brute_components(texts, 4, 80)
    classes = {frozenset(s) for s in sets}
    near = lambda a, b: len(a & b) and 100 * len(a & b) >= 80 * len(a | b)
    want = [sum(bool(near(s, c)) for c in classes if c != s) for s in map(frozenset, sets)]
    assert max(want) == 24
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r for r in jaccard_join.join(frame, percent=80, links=links).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == root
    if links:
        assert [got[i]["n_links"] for i in range(len(texts))] == want
