"""Quality, toxicity, language, licences and the linear models: held-out accuracy and odd inputs."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_helpers import ODD, docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tradewinds.llm import langid, licenses, linear, quality, toxicity

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def larger(spark):
    return lambda name: spark.read.parquet(f"{LARGER}/{name}.parquet")


def remainder(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_dual_descent_reaches_the_primal_optimum():
    random = np.random.default_rng(1)
    x = random.normal(size=(60, 5))
    y = np.sign(x @ [1, -2, 0.5, 0, 0] + 0.3 * random.normal(size=60))
    features = [np.arange(5)] * 60
    w = linear.hinge_by_dual_descent(features, list(x), y, 5, np.ones(60), epochs=3_000)

    def loss(w):
        return 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w)).sum()

    assert all(loss(w) <= loss(w + 0.02 * random.normal(size=5)) + 1e-6 for _ in range(200))


def test_calibration_keeps_the_order_and_finite_slope():
    slope, offset = linear.calibrated(np.array([-2.0, -1, 1, 2]), np.array([0.0, 0, 1, 1]))
    assert 0 < slope < 20 and abs(offset) < 5


def test_quality_on_held_out_labels(larger):
    model = quality.fit(larger("documents"), larger("labels"))
    scored = {r.doc_id: r for r in quality.score(larger("documents"), model).collect()}
    held = [(scored[r.doc_id], r.quality) for r in larger("labels").collect() if remainder(r.doc_id, 3) == 1]
    assert all(s.held_out for s, _ in held) and all(0 <= s.score <= 1 for s, _ in held)
    assert np.mean([s.predicted == q for s, q in held]) > 0.97
    kept = quality.accepted(larger("documents"), model)
    assert kept.columns == larger("documents").columns
    assert rows(kept, "doc_id") == rows(quality.score(larger("documents"), model).where("predicted = 1"), "doc_id")


def test_quality_learns_nothing_from_held_out_rows(spark, docs):
    found = [(i, "good words here" if i % 2 else "BAD!! BAD!! BAD!!") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    turned = spark.createDataFrame([(i, i % 2 if remainder(i, 3) != 1 else 1 - i % 2) for i in range(40)], "doc_id bigint, quality int")
    a, b = (rows(quality.score(docs(found), quality.fit(docs(found), of))) for of in (labels, turned))
    assert a == b


def test_quality_odd(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    seen = next(i for i in range(len(ODD)) if remainder(i, 3) != 1)
    one = spark.createDataFrame([(seen, 0), (None, 1), (4, None), (6, 7)], "doc_id bigint, quality int")
    found = docs([*enumerate(ODD), (None, "no id"), (2**60 + 1, "x"), (1, "twice")])
    for labels, score in ((none, 0.5), (one, 0.0)):
        got = quality.score(found, quality.fit(found, labels)).collect()
        assert len(got) == len(ODD) + 3 and all(abs(r.score - score) < 1e-9 for r in got)
    assert {r.doc_id for r in got} == {*range(len(ODD)), None, 2**60 + 1}
    assert quality.score(docs([]), quality.fit(docs([]), none)).collect() == []


def test_toxicity_on_held_out_labels(larger):
    model = toxicity.fit(larger("documents"), larger("labels"))
    scored = {r.doc_id: r for r in toxicity.score(larger("documents"), model).collect()}
    held = [(scored[r.doc_id], r.toxic) for r in larger("labels").collect() if remainder(r.doc_id, 4) == 2]
    assert all(s.held_out for s, _ in held)
    assert np.mean([s.predicted == t for s, t in held]) > 0.93
    assert np.mean([s.predicted for s, t in held if not t]) < 0.05


def test_label_model_finds_accuracies_and_repeats():
    random = np.random.default_rng(4)
    truth = random.random(20_000) < 0.1
    votes = [np.where(truth, random.random(20_000) < hit, random.random(20_000) < false)
             for hit, false in ((0.9, 0.01), (0.8, 0.02), (0.6, 0.05))]
    votes += [votes[2], votes[2]]
    patterns, counts = np.unique(sum(v.astype(np.int64) << k for k, v in enumerate(votes)), return_counts=True)
    model = toxicity.fit_label_model(patterns, counts, 5)
    assert abs(model.share - 0.1) < 0.03
    weight = model.yes * model.trust
    assert weight[0] > weight[2] > 0 > model.no.max()
    assert model.trust[2] < 0.5 < model.trust[0]
    none, one, two, every = model.posterior(np.array([0b00000, 0b00001, 0b00011, 0b11111]))
    assert none < 0.1 < one < two < every and every > 0.9


def planted(rates, copies=(), share=0.1, n=200_000, seed=7, flips=0.0):
    """Voters with (hit, false) rates; `copies` of voters, a share of them flipped; the true share per pattern."""
    random = np.random.default_rng(seed)
    truth = random.random(n) < share
    votes = [np.where(truth, random.random(n) < hit, random.random(n) < false) for hit, false in rates]
    votes += [np.where(random.random(n) < flips, random.random(n) < 0.1, votes[k]) for k in copies]
    patterns = sum(v.astype(np.int64) << k for k, v in enumerate(votes))
    seen, at, counts = np.unique(patterns, return_inverse=True, return_counts=True)
    return seen, counts, np.bincount(at, truth) / counts, len(votes)


@pytest.mark.parametrize("case", [
    {"rates": [(0.9, 0.01), (0.8, 0.02), (0.6, 0.05)], "copies": [2, 2]},
    {"rates": [(0.9, 0.01), (0.8, 0.02), (0.3, 0.1)], "copies": [2, 2, 2]},
    {"rates": [(0.95, 0.002), (0.9, 0.005), (0.4, 0.05), (0.5, 0.1)]},
    {"rates": [(0.7, 0.01), (0.7, 0.02), (0.5, 0.05), (0.4, 0.08)], "copies": [3, 3]},
    {"rates": [(0.8, 0.01), (0.7, 0.02), (0.6, 0.04), (0.4, 0.1)], "copies": [3, 3], "flips": 0.1},
])
def test_label_model_posteriors_of_planted_voters(case):
    patterns, counts, true, voters = planted(**case)
    model = toxicity.fit_label_model(patterns, counts, voters)
    often = counts >= 400
    assert np.abs(model.posterior(patterns) - true)[often].max() < 0.05
    assert (np.abs(model.posterior(patterns) - true) * counts).sum() / counts.sum() < 0.005
    together = sorted(len(g) for g in model.groups)
    assert together[-1] == 1 + len(case.get("copies", ()))


def enumerated(model, patterns, counts):
    """Posteriors by Bayes' rule, pattern by pattern, from the model's tables of joint votes."""
    out = []
    for pattern in patterns.tolist():
        odds = model.share / (1 - model.share)
        for group, table in zip(model.groups, model.odds):
            odds *= np.exp(table[sum((pattern >> k & 1) << n for n, k in enumerate(group))])
        out.append(odds / (1 + odds))
    return np.array(out)


def test_posteriors_by_enumeration():
    patterns, counts, _, voters = planted([(0.9, 0.01), (0.8, 0.02), (0.6, 0.05)], [2])
    model = toxicity.fit_label_model(patterns, counts, voters)
    every = np.arange(2**voters)
    assert np.allclose(model.posterior(every), enumerated(model, every, counts))
    assert sorted(k for g in model.groups for k in g) == list(range(voters))


def test_toxicity_odd(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    found = docs([*enumerate(ODD), (None, "no id"), (90, "you are an idiot and a moron, pathetic scum"), (91, "a fine day")])
    got = {r.doc_id: r for r in toxicity.score(found, toxicity.fit(found, none)).collect()}
    assert len(got) == len(ODD) + 3 and all(0 <= r.score <= 1 for r in got.values())
    assert toxicity.score(docs([]), toxicity.fit(docs([]), none)).collect() == []
    quiet = docs([(1, "a fine day"), (2, None)])
    assert {r.predicted for r in toxicity.score(quiet, toxicity.fit(quiet, none)).collect()} == {0}


def test_disguised_insults_are_a_vote():
    plain, disguised, clean = toxicity.Voters([]).votes(["you moron", "you m0r0n", "you there"])
    assert plain and disguised and not clean


def test_language_on_held_out_documents(larger):
    learned = langid.dictionaries(larger("documents"))
    lang = {r.doc_id: r.lang for r in larger("documents").collect()}
    got = langid.predict_language(larger("documents"), learned).collect()
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.97
    assert {r.held_out == (remainder(r.doc_id, 4) == 2) for r in got} == {True}


def test_language_odd(docs):
    found = docs([*enumerate(ODD), (None, "no id")]).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict_language(found, langid.dictionaries(found)).collect()} == {"und"}
    got = {r.doc_id: r for r in langid.predict_language(found, {"en": b"some words", "de": b"ein paar"}).collect()}
    assert [got[k].lang_pred == "und" for k in range(len(ODD))] == [
        not any(c.isalpha() for c in t or "") for t in ODD
    ]
    assert langid.predict_language(docs([]), {}).collect() == []
    # Numbers and marks that are no letters, and letters beyond the alphabet.
    signs = docs([(1, "½ ² ① Ⅷ 12"), (2, "½ ª"), (3, "漢")])
    got = {r.doc_id: r.lang_pred for r in langid.predict_language(signs, {"en": b"some words", "de": b"ein paar"}).collect()}
    assert [got[k] == "und" for k in (1, 2, 3)] == [True, False, False]


def test_licences_found_and_confirmed(docs):
    lines = ["Some first line of words.", "Licensed under the Apache License, Version 2.0.", "words after", "Released under the MIT License."]
    found = docs([(1, "\n".join(lines)), (2, "he lost his driving license"), (3, "All rights reserved."), (3, "All rights reserved.")])
    model = licenses.fit_model(["the words of a line like this", "and another one", "to be or not to be of the kind"] * 20)
    got = rows(licenses.scan(found, model), "doc_id", "line", "family", "confirmed", "text")
    assert got == [
        (1, 1, "apache-2.0", True, lines[1]), (1, 3, "mit", True, lines[3]),
        (3, 0, "proprietary", True, "All rights reserved."), (3, 0, "proprietary", True, "All rights reserved."),
    ]


def test_every_template_is_its_own_family():
    model = licenses.fit_model(["the words of a line like this", "and another one"] * 20)
    for family, texts in licenses.notices().items():
        for text in texts:
            words = licenses._line_words(text)
            p = model.probabilities(licenses._grams(words))
            assert model.families[p.argmax()] == family, text
            assert model.cover(model.families.index(family), words)[0] == 1.0


def test_licence_lines_equal_one_by_one():
    model = licenses.fit_model(["the words of a line like this", "and another one"] * 20)
    texts = ["Licensed under the\nMIT License", "a b c\n\nThis work is licensed under a CC BY 4.0.\nof the public", "", "x"]
    for first, block, words, at, _ in licenses.lines(texts):
        found = dict(model.lines_found(words, at))
        for k in range(len(at) - 1):
            p = model.probabilities(licenses._grams(words[at[k]:at[k + 1]]))
            assert (k in found) == (p[:-1].max() >= model.least)


def test_licences_odd(docs):
    found = docs([*enumerate(ODD), (None, "Released under the MIT License.")])
    model = licenses.fit(found)
    assert (None, "mit") in rows(licenses.scan(found, model), "doc_id", "family")
    assert licenses.scan(docs([]), licenses.fit(docs([]))).collect() == []
