import math

import pytest
from pyspark.sql import functions as F

from weavegraph.llm import licenses

#: What stands in the driver's documents.
LINES = {"Licensed under CC BY-NC 4.0.": "CC-BY", "GNU General Public License, version 3": "GPL", "Licensed under the Apache License": "Apache", "Released under the MIT License.": "MIT", "All rights reserved.": "Proprietary"}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def classifier(docs):
    return licenses.train(docs)


def test_driver_table(docs):
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in licenses.license_report(docs).collect()}
    assert got.keys() == rows.keys()
    wrong = 0
    for i, text in rows.items():
        want = {family for line, family in LINES.items() if line in text}
        wrong += set(got[i].families) != want
    assert wrong <= 3


def test_other_wordings(classifier):
    say = lambda *lines: [(a, b) for a, b, *_ in classifier.judge([x.encode() for x in lines])]
    assert say("licensed under the apache license version 2.0") == [(0, "Apache")]
    assert say("", "The of and the to is.", "xx yy Released under the MIT License.") == [(2, "MIT")]
    assert say("This program is free software; you may redistribute it and modify it under the terms of the GNU General Public License as published by the Free Software Foundation") == [(0, "GPL")]
    assert say("This work is licensed under the Imaginary Vendor License, version 3.") == [(0, "unknown")]
    assert 0.25 <= classifier.temperature <= 8 and 0.5 <= classifier.threshold <= 1


def test_edges(spark, docs, classifier):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "\n\n"), (4, "Released under the MIT License."), (4, "Released under the MIT License."), (None, "x")], "doc_id bigint, text string").withColumn("families", F.lit(1))
    got = licenses.scan(odd, classifier, carry=["doc_id", "families"], into="l").select("doc_id", F.col("l.families").alias("f"), "l.paragraphs").collect()
    assert sorted((str(r.doc_id), r.f) for r in got) == [("1", []), ("2", []), ("3", []), ("4", ["MIT"]), ("4", ["MIT"]), ("None", [])]
    assert all(p.line == 0 and p.template > 0.9 for r in got for p in r.paragraphs)
    assert licenses.license_report(odd.limit(0)).count() == 0


def test_wrapped_notices(spark, classifier):
    import textwrap

    mit, gpl, bsd = licenses.TEMPLATES["MIT"][1], licenses.TEMPLATES["GPL"][1], licenses.TEMPLATES["BSD"][1]
    wrap = lambda t, width=72, sign="": "\n".join(sign + x for x in textwrap.wrap(t, width))
    prose = "Haanth reoush hewh and onon hahehe."
    rows = [(1, wrap(mit)), (2, wrap(bsd, 40)), (3, f"{prose}\n{wrap(gpl, sign='# ')}\n{prose}\n\n{prose}"), (4, wrap(mit, 30) + "\n\n" + wrap(gpl, 50)), (5, f"{prose}\n{prose}"), (6, mit)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.families, r.unknown) for r in licenses.scan(table, classifier, carry=["doc_id"], into="l").select("doc_id", "l.*").collect()}
    assert got == {1: (["MIT"], 0), 2: (["BSD"], 0), 3: (["GPL"], 0), 4: (["GPL", "MIT"], 0), 5: ([], 0), 6: (["MIT"], 0)}


def test_unknown_licences_are_told(classifier):
    """Names that no family has, in wordings that all have."""
    lines = ["Licensed under the Frobnicate License, Version 7.", "Released under the Quux License.", "This work is licensed under the Acme Public License, version 2.", "SPDX-License-Identifier: Wombat-1.0", "Distributed under the terms of the Zorp Software License."]
    assert [(i, f) for i, f, *_ in classifier.judge([x.encode() for x in lines])] == [(i, "unknown") for i in range(len(lines))]


def test_every_template_is_its_family(classifier):
    texts = [(name, t) for name, its in licenses.TEMPLATES.items() for t in its]
    got = {i: f for i, f, *_ in classifier.judge([t.encode() for _, t in texts])}
    wrong = [(name, got.get(i), t[:50]) for i, (name, t) in enumerate(texts) if got.get(i) != name]
    assert not wrong and len(licenses.TEMPLATES) >= 15


def test_scores_by_brute_force(classifier):
    """Probabilities out of the weights, one n-gram at a time."""
    lines = ["Released under the MIT License.", "the the of a", "zzz", "", "licensed under the GNU general public license and the GNU general public license"]
    some, p = classifier.probabilities([x.encode() for x in lines])
    vocabulary = {h: i for i, h in enumerate(classifier.vocabulary.tolist())}
    want = {}
    for i, line in enumerate(lines):
        _, grams = licenses.ngrams([line.encode()])
        places = {vocabulary[g] for g in grams.tolist() if g in vocabulary}
        if places:
            z = (classifier.bias + sum(classifier.weights[q] for q in places)) / classifier.temperature
            e = [math.exp(v - max(z)) for v in z]
            want[i] = [v / sum(e) for v in e]
    assert some.tolist() == sorted(want) and all(abs(a - b) < 1e-9 for i, row in zip(some.tolist(), p, strict=True) for a, b in zip(row, want[i], strict=True))


def test_calibration_on_paragraphs_of_its_own(classifier, docs):
    """Of made paragraphs from another seed, predictions are as often right as their probabilities say."""
    other = licenses.Classifier(seed=99)
    lines, labels = other.made([w.encode() for r in docs.limit(40).collect() for w in (r.text or "").split("\n")[:3]])
    some, p = classifier.probabilities(lines)
    right, sure = p.argmax(axis=1) == labels[some], p.max(axis=1)
    assert right.mean() > 0.93 and abs(right.mean() - sure.mean()) < 0.05
    assert right[sure > 0.9].mean() > 0.96


def test_a_very_long_text(spark, classifier):
    text = "\n".join(["nothing of the kind"] * 60_000 + ["Released under the MIT License."] + ["of the"] * 60_000)
    got = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), classifier, carry=["doc_id"], into="l").select("l.*").first()
    assert got.families == ["MIT"] and [p.line for p in got.paragraphs if p.family == "MIT"] == [60_000]
