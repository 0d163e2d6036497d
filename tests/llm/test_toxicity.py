"""Held-out accuracy, and defined scores for odd rows."""

import zlib

import numpy as np
import pytest
from helpers import ODD, clashing, docs

from panelcast.llm import boosting, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    texts, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    odd = docs(spark, [(None if i is None else 10**6 + i, t) for i, t in ODD])
    got = toxicity.score(clashing(texts.unionByName(odd), ["score", "toxic", "part"]), labels)
    return got.collect(), {r.doc_id: r.toxic for r in labels.collect()}


def test_held_out_rows_are_those_of_the_contract(scored):
    for r in scored[0]:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_held_out_accuracy(scored):
    got = [(r.predicted, scored[1][r.doc_id]) for r in scored[0] if r.held_out and r.doc_id in scored[1]]
    toxic = [p for p, y in got if y == 1]
    assert sum(toxic) >= 0.75 * len(toxic)
    assert sum(p for p, y in got if y == 0) <= 0.01 * len(got)


def test_odd_rows_get_a_score(scored):
    odd = [r for r in scored[0] if r.doc_id is None or r.doc_id >= 10**6]
    assert len(odd) == len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored[0])
    assert all(r.predicted == 0 for r in odd)
    twice = [r.score for r in odd if r.doc_id == 10**6 + 5]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_without_toxic_labels_and_without_rows(spark):
    table = docs(spark, [(k, f"some words of text {k}") for k in range(30)])
    labels = spark.createDataFrame([(k, None if k == 3 else 0) for k in range(30)], "doc_id long, toxic int")
    for known in (labels, labels.where("false")):
        assert {r.score for r in toxicity.score(table, known).collect()} == {0.0}
    assert toxicity.score(table.where("false"), labels).count() == 0


def test_entries_and_features():
    assert toxicity.entries_of("clowns") == ["clowns", "clow*", "clown*", "clowns*"]
    assert "x" * 60 not in toxicity.entries_of("x" * 60)
    lexicon = toxicity.Lexicon({"clown": np.array([4.0])}, 0)
    row = dict(zip(toxicity.FEATURES, toxicity.features("YOU clown, id1ot! " + "far " * 20 + "clown", lexicon)))
    assert (row["strong_hits"], row["strong_types"], row["near_person"]) == (2, 1, 1)
    assert row["obfuscated_share"] > 0 and row["shouted_share"] > 0
    assert len(toxicity.features("", lexicon)) == len(toxicity.FEATURES)


def test_margins_equal_those_of_the_library(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    draw = np.random.default_rng(3)
    x = draw.random((300, 2))
    table = spark.createDataFrame([(float(a), float(b), float(a + b * b > 0.8)) for a, b in x], "a double, b double, y double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(table)
    model = GBTClassifier(labelCol="y", maxIter=6, maxDepth=3, seed=1).fit(vectors)
    trees = [boosting.tree(t, w) for t, w in zip(model.trees, model.treeWeights)]
    want = [r.probability[1] for r in model.transform(vectors).collect()]
    assert boosting.probability(boosting.margin(trees, x)) == pytest.approx(want)
