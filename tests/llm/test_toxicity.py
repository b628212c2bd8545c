"""The convolutional classifier: gradients, generalisation by stems, odd texts."""

from __future__ import annotations

import numpy as np

from gridmetrics.llm import toxicity
from gridmetrics.llm.training import sigmoid


def _loss(model, rows, label, weight):
    top, _ = model.features(rows)
    z = np.maximum(top, 0) @ model.weights["o"] + model.weights["c"][0]
    p = sigmoid(z)
    return -weight * (label * np.log(p) + (1 - label) * np.log(1 - p))


def test_gradients_equal_finite_differences():
    grams = toxicity.grams_of(b"some words repeated words and somewhat longer words here")
    model = toxicity.Model(np.unique(toxicity._buckets(grams[grams != 0])), 3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rows, rng = model.rows_of(grams), np.random.default_rng(0)
    grad = {k: np.zeros_like(v) for k, v in model.weights.items()}
    model._backward(rows, 1, 0.7, grad)
    for name, weights in model.weights.items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in weights.shape)
            if name == "E" and at[0] == 0:
                continue  # the null vector is not learned
            was, step, sides = weights[at], 1e-5, []
            for sign in (1, -1):
                weights[at] = was + sign * step
                sides.append(_loss(model, rows, 1, 0.7))
            weights[at] = was
            slope = (sides[0] - sides[1]) / (2 * step)
            assert abs(slope - grad[name][at]) < 1e-4 * max(1, abs(slope)), (name, at)


def test_beginnings_of_words():
    data = b"Abcdefgh abcdefghij abc \xc3\xa9tonnement abcdefgz"
    grams = toxicity.grams_of(data)
    assert grams.shape == (3, 5)
    assert grams[1, 0] == grams[1, 1] == grams[1, 4] != 0, "five bytes in common"
    assert grams[2, 0] == 0 and grams[2, 1] != 0, "a word of eight bytes is no longer than eight"
    assert not grams[1:, 2].any()
    assert toxicity.grams_of(b"").shape == (3, 0)


def test_unseen_forms_of_a_stem_are_caught_and_clean_texts_left(spark):
    rng, rows, truth = np.random.default_rng(5), [], {}
    word = lambda: "w" + "".join(rng.choice(list("abcdefghij"), 5))
    for i in range(400):
        words, toxic = [word() for _ in range(60)], i % 8 == 0
        if toxic:  # every form occurs once in the whole corpus
            for at in rng.integers(0, 60, 3):
                words[at] = "stupidest" + "".join(rng.choice(list("klmnop"), 6))
        rows.append((i, " ".join(words)))
        truth[i] = int(toxic)
    rows += [(400, None), (401, ""), (402, "x " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    model = toxicity.learned(docs, labels, labels.doc_id < 240)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in truth if i >= 240]
    caught = [got[i] >= toxicity.THRESHOLD for i in held if truth[i]]
    false = [got[i] >= toxicity.THRESHOLD for i in held if not truth[i]]
    assert np.mean(caught) >= 0.9 and np.mean(false) <= 0.05
    assert got[400] == got[401] and 0 <= got[402] <= 1
    kept = {r.doc_id for r in toxicity.below_threshold(docs, model).collect()}
    assert kept == {i for i, s in got.items() if s < toxicity.THRESHOLD}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_gradient_of_several_texts_is_the_sum_of_theirs(monkeypatch):
    monkeypatch.setattr(toxicity, "_WORDS", 40)  # the second text goes through alone
    texts = [b"some words repeated words", b"more words " * 30, b"", b"a somewhat longer text of words"]
    grams = [toxicity.grams_of(t) for t in texts]
    model = toxicity.Model(np.unique(np.concatenate([toxicity._buckets(g[g != 0]) for g in grams])), 3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rows, labels, weights = [model.rows_of(g) for g in grams], [1, 0, 0, 1], [0.7, 0.2, 0.1, 0.4]
    want = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for one in zip(rows, labels, weights):
        model._backward(*one, want)
    want["E"][0] = 0
    got = model.gradient(rows, labels, weights)
    assert all(np.allclose(got[k], want[k], atol=1e-6) for k in want)


def test_every_labelled_row_is_learned_from(spark):
    from pyspark.sql import functions as F

    # A word that only the toxic rows with the greatest hashes have: a sample of the smallest would never see it.
    ids = spark.range(6600).select("id", (F.col("id") % 2).cast("int").alias("toxic"), F.xxhash64("id").alias("hash"))
    late = {r.id for r in ids.where("toxic = 1").orderBy(F.desc("hash")).limit(300).collect()}
    rng, rows = np.random.default_rng(9), []
    for i in range(6600):
        words = [f"{c}{c}{c}" for c in rng.choice(list("abcdefgh"), 5)]
        rows.append((i, " ".join([*words, "zebra" if i in late else "yak" if i % 2 else "ox"])))
    docs = spark.createDataFrame([*rows, (7000, "aaa zebra bbb"), (7001, "aaa ox bbb")], "doc_id long, text string")
    labels = ids.select(F.col("id").alias("doc_id"), "toxic")
    model = toxicity.learned(docs, labels, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score(docs.where("doc_id >= 7000"), model).collect()}
    assert got[7000] >= toxicity.THRESHOLD > got[7001]


def test_many_shards_learn_as_one(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    rng, rows = np.random.default_rng(6), []
    for i in range(500):
        words = ["w" + "".join(rng.choice(list("abcdef"), 4)) for _ in range(30)]
        rows.append((i, " ".join([*words, "vile" if i % 5 == 0 else "kind"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 5 = 0) AS toxic")
    model = toxicity.learned(docs, labels, labels.doc_id < 400)
    got = {r.doc_id: r.score >= toxicity.THRESHOLD for r in toxicity.score(docs, model).collect()}
    assert np.mean([got[i] == (i % 5 == 0) for i in range(400, 500)]) >= 0.97
