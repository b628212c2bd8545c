"""Pseudonyms: the network of characters against one written in Python, and as a permutation."""

from __future__ import annotations

import hashlib
import itertools

from pyspark.sql import functions as F

from gridmetrics.llm import feistel


def _classed(text, classes, key, kind):
    """The network of ``classed`` in Python."""
    half = len(text) // 2
    u, v = text[:half], text[half:]
    for turn in range(1, feistel.ROUNDS + 1):
        digest, moved = hashlib.sha256("|".join((key, kind, str(turn), v)).encode()).hexdigest(), []
        for i, c in enumerate(u):
            by = int(digest[i % 16 * 4 : i % 16 * 4 + 4], 16)
            for letters in classes:
                if c in letters:
                    c = letters[(letters.index(c) + by) % len(letters)]
                    break
            moved.append(c)
        u, v = v, "".join(moved)
    return u + v


def test_classed_is_the_network_and_a_permutation(spark):
    letters = ("0123456789", "abc")
    words = ["".join(w) for n in (1, 2, 3) for w in itertools.product("0123456789", repeat=n)]
    words += ["".join(w) for w in itertools.product("abc", "0123456789", "abc", "-", "abc")]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select("w", feistel.classed(F.col("w"), letters, "k", "t").alias("new")).collect()
    assert {r.w: r.new for r in rows} == {w: _classed(w, letters, "k", "t") for w in words}
    assert sorted(r.new for r in rows) == sorted(words), "each value of a format is met once"


def test_plan_is_expressions_alone(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = feistel.pseudonymise(docs, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan
