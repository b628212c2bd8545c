"""What the trained operators share: labelled rows, Adam, and thresholds.

``labelled`` gives every labelled row. ``labelled_sample`` is for operators that fit on a sample: its bound
(rows of each class) is a parameter of each operator; the rows are those with the smallest hash of
their id, so the sample is the same on every run and does not depend on how the tables are split.
Scoring covers every row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import likely, stored


def smallest(rows: DataFrame, order: list[Column], size: int, bound: int) -> DataFrame:
    """The ``bound`` rows of ``size`` that come first in the order of a hash.

    A cut at one and a half times the share that is wanted leaves only about that many rows to
    sort, however many partitions there are.
    """
    if size > 2 * bound + 1000:
        share = 1.5 * bound / size
        rows = rows.where(order[0] < int(-(2**63) + share * 2**64))
    return rows.orderBy(*order).limit(bound)


def _named(labels: DataFrame, label: str, learn: Column, doc_id: str) -> DataFrame:
    """(doc_id, label) of the usable labels that ``learn`` admits, one row an id."""
    return (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def _texts(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))


def labelled(
    documents: DataFrame, labels: DataFrame, label: str, learn: Column, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, label, data) of every labelled document; odd rows as in ``labelled_sample``.

    A bitmap of fixed size drops the texts without a label before anything is shuffled.
    """
    named = stored(_named(labels, label, learn, doc_id))
    return (
        likely(_texts(documents, doc_id, text), "doc_id", named)
        .join(named, "doc_id")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.min("text").cast("binary").alias("data"))
    )


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    bound: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, label, data) of at most ``bound`` labelled documents of each class.

    Labels other than 0 and 1 and null ids teach nothing; a document labelled both ways counts as
    1; of documents that share an id the smallest text is taken.
    """
    named = _named(labels, label, learn, doc_id)
    sizes = {r.label: r.n for r in named.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = named.where(F.col("label") == value)
        part = smallest(part, order, sizes.get(value, 0), bound)
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most 2 * bound ids and labels: their size is bounded whatever the tables hold.
    return (
        _texts(documents, doc_id, text)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.min("text").cast("binary").alias("data"))
    )


def prior(labels: DataFrame, label: str, learn: Column, doc_id: str = "doc_id") -> float:
    """Share of label 1 among all labelled rows to learn from; a half if there are none."""
    value = F.col(label).cast("int")
    named = labels.select(F.col(doc_id).alias("doc_id"), value.alias("v"))
    share = named.where(F.col("doc_id").isNotNull() & F.col("v").isin(0, 1) & learn).agg(F.avg("v"))
    found = share.first()[0]
    return 0.5 if found is None else min(0.99, max(0.01, found))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Adam:
    """Adam over a dict of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float) -> None:
        self.weights, self.rate, self.steps = weights, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.steps += 1
        fix1, fix2 = 1 - 0.9**self.steps, 1 - 0.999**self.steps
        for k, g in gradients.items():
            m, v = self.first[k], self.second[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.weights[k] -= self.rate * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)


def best_cut(logits: np.ndarray, labels: np.ndarray, share: float = 0.5) -> float:
    """The logit that separates 0 from 1 with least error where a share ``share`` of rows is 1.

    Of several such cuts the one with most room is taken, halfway between its neighbours.
    """
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order].astype(float)
    n0, n1 = max(1.0, (1 - y).sum()), max(1.0, y.sum())
    missed = np.concatenate([[0], np.cumsum(y)]) / n1
    false = 1 - np.concatenate([[0], np.cumsum(1 - y)]) / n0
    error = share * missed + (1 - share) * false
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    best = np.flatnonzero(error <= error.min() + 1e-12)
    i = best[np.argmax(edges[best + 1] - edges[best])]
    return float((edges[i] + edges[i + 1]) / 2)


def best_cut_of_counts(values: np.ndarray, zeros: np.ndarray, ones: np.ndarray, share: float = 0.5) -> float:
    """``best_cut`` where ``zeros`` and ``ones`` rows of each label lie at ``values`` (ascending, distinct)."""
    missed = np.concatenate([[0], np.cumsum(ones)]) / max(1, ones.sum())
    false = 1 - np.concatenate([[0], np.cumsum(zeros)]) / max(1, zeros.sum())
    error = share * missed + (1 - share) * false
    edges = np.concatenate([[values[0] - 1], values, [values[-1] + 1]])
    best = np.flatnonzero(error <= error.min() + 1e-12)
    i = best[np.argmax(edges[best + 1] - edges[best])]
    return float((edges[i] + edges[i + 1]) / 2)


def at_threshold(logits: np.ndarray, cuts: np.ndarray, threshold: float) -> np.ndarray:
    """Scores in (0, 1) in which each row's own cut falls on ``threshold``."""
    return sigmoid(logits - cuts + np.log(threshold / (1 - threshold)))


def segments(lengths: list[int]) -> np.ndarray:
    """Starts of consecutive segments, for ``reduceat``; no segment may be empty."""
    return np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
