"""Quality by attention-based multiple-instance learning, trained in numpy.

A text is a bag of passages of 64 tokens. Every passage is encoded: character classes, token shapes,
hashed tokens, repetition inside the passage and against the text before it. Gated attention,
learned from document labels alone, weights the encoded passages; a logistic layer scores the
weighted sum.

Fitting uses at most ``SAMPLE`` labelled rows of each class and runs on the driver; every document is
scored, from its whole text. Defined results: null is empty text, which is one passage of noughts; without
labels of both classes every score is 0.5; repeated rows give repeated rows; columns besides
id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    NON_SPACE,
    hash_words,
    map_rows,
    remainder,
    shingles,
    table,
    text_bytes,
    word_spans,
)
from .training import Adam, at_threshold, best_cut, labelled_sample, prior, segments, sigmoid

SAMPLE = 1500
THRESHOLD = 0.3
PASSAGE = 64
SHAPES, HASHED = 64, 128
HIDDEN, GATES = 24, 12
_CLASSES = 6
#: Class of each byte: 0 white space, 1 lower, 2 upper, 3 digit, 4 other ASCII, 5 beyond ASCII.
_CLASS = np.array(
    [
        5 if c > 127 else 1 if 97 <= c <= 122 else 2 if 65 <= c <= 90 else 3 if 48 <= c <= 57
        else 0 if c == 32 or 9 <= c <= 13 else 4
        for c in range(256)
    ],
    np.int64,
)
WIDTH = _CLASSES + 6 + SHAPES + HASHED


def encode(data: bytes) -> np.ndarray:
    """One row of features for each passage of the text, at least one."""
    lowered = data.translate(NON_SPACE)
    starts, ends = word_spans(lowered)
    n = len(starts)
    if not n:
        return np.zeros((1, WIDTH), np.float32)
    count = -(-n // PASSAGE)
    passage = np.arange(n) // PASSAGE
    size = np.bincount(passage, minlength=count).astype(float)
    raw = np.frombuffer(data, np.uint8)
    firsts = starts[::PASSAGE]
    of_byte = np.repeat(np.arange(count), np.diff(np.append(firsts, len(raw))))
    classes = np.bincount(
        of_byte * _CLASSES + _CLASS[raw[firsts[0] :]], minlength=count * _CLASSES
    ).reshape(count, _CLASSES)
    hashes = hash_words(lowered)
    lengths = ends - starts
    last, before = raw[ends - 1], raw[np.maximum(ends - 2, starts)]
    mean = lambda x: np.bincount(passage, x, count) / size
    same = np.append(False, hashes[1:] == hashes[:-1])
    doubled = (last == before) & (_CLASS[last] == 4) & (lengths > 1)
    runs = shingles(hashes)
    _, first_at = np.unique(runs, return_index=True)
    repeated = np.ones(n)
    repeated[first_at] = 0
    repeated[len(runs) :] = 0
    _, distinct_at = np.unique(hashes + passage.astype(np.uint64), return_index=True)
    shape = (
        _CLASS[raw[starts]] * 7 + _CLASS[last] * 31 + np.minimum(lengths, 12) // 3 * 11
    ) % SHAPES
    out = np.empty((count, WIDTH), np.float32)
    out[:, :_CLASSES] = classes / np.maximum(1, classes.sum(1, keepdims=True))
    out[:, _CLASSES : _CLASSES + 6] = np.stack(
        [
            np.log1p(size) / np.log1p(PASSAGE),
            np.minimum(mean(lengths) / 10, 5),
            mean(same),
            mean(doubled),
            mean(repeated),
            np.bincount(passage[distinct_at], minlength=count) / size,
        ],
        axis=1,
    )
    at = _CLASSES + 6
    out[:, at : at + SHAPES] = (
        np.bincount(passage * SHAPES + shape, minlength=count * SHAPES).reshape(count, SHAPES)
        / size[:, None]
    )
    bag = np.bincount(
        passage * HASHED + (hashes % np.uint64(HASHED)).astype(np.int64), minlength=count * HASHED
    ).reshape(count, HASHED)
    out[:, at + SHAPES :] = np.sqrt(bag / size[:, None])
    return out


class Model:
    """Encoder, gated attention and logistic layer."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.weights = {
            "W": small(WIDTH, HIDDEN),
            "b": np.zeros(HIDDEN, np.float32),
            "V": small(HIDDEN, GATES),
            "U": small(HIDDEN, GATES),
            "w": small(GATES),
            "c": small(HIDDEN),
            "d": np.zeros(1, np.float32),
        }
        self.center = np.zeros(WIDTH, np.float32)
        self.scale = np.ones(WIDTH, np.float32)
        self.cut = 0.0

    def forward(self, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> dict:
        w = self.weights
        x = (x - self.center) * self.scale
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
        s = (t * g) @ w["w"]
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), lengths))
        a = e / np.repeat(np.add.reduceat(e, starts), lengths)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ w["c"] + w["d"][0]}

    def logits(self, bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the bags, and the attention of all their passages in order."""
        lengths = np.array([len(b) for b in bags])
        f = self.forward(np.concatenate(bags), segments(lengths), lengths)
        return f["logit"], f["a"]

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int, seed: int) -> None:
        rng, w = np.random.default_rng(seed), self.weights
        every = np.concatenate(bags)
        self.center = every.mean(0)
        self.scale = (1 / (every.std(0) + 0.05)).astype(np.float32)
        weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum()) * len(labels)
        adam = Adam(w, 0.004)
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for start in range(0, len(order), 64):
                batch = order[start : start + 64]
                lengths = np.array([len(bags[i]) for i in batch])
                f = self.forward(
                    np.concatenate([bags[i] for i in batch]), segments(lengths), lengths
                )
                error = (sigmoid(f["logit"]) - labels[batch]) * weight[batch] / len(batch)
                adam.step(self._gradients(f, error, segments(lengths), lengths))

    def _gradients(self, f: dict, error: np.ndarray, starts, lengths) -> dict:
        w = self.weights
        dz = np.repeat(error[:, None] * w["c"], lengths, axis=0)
        da = (dz * f["h"]).sum(1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), lengths))
        dtg = ds[:, None] * w["w"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ w["V"].T + dg @ w["U"].T
        dx = dh * (1 - f["h"] ** 2)
        grad = {
            "W": f["x"].T @ dx + 1e-4 * w["W"],
            "b": dx.sum(0),
            "V": f["h"].T @ dt,
            "U": f["h"].T @ dg,
            "w": (f["t"] * f["g"]).T @ ds,
            "c": f["z"].T @ error + 1e-4 * w["c"],
            "d": np.array([error.sum()]),
        }
        return {k: v.astype(np.float32) for k, v in grad.items()}


def train(sample: DataFrame, share: float = 0.5, epochs: int = 12, seed: int = 11) -> Model | None:
    """Fit on a bounded sample of (doc_id, label, data); a fifth of it sets the threshold."""

    def of(rows):
        for row in rows:
            yield row["doc_id"], row["label"], encode(row["data"]).tobytes()

    kind = sample.schema["doc_id"].dataType.simpleString()
    encoded = map_rows(sample, f"doc_id {kind}, label int, bag binary", of, "data")
    rows = sorted(encoded.collect(), key=lambda r: r.doc_id)
    labels = np.array([r.label for r in rows])
    if len(set(labels.tolist())) < 2:
        return None
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, WIDTH) for r in rows]
    kept = np.random.default_rng(seed).random(len(rows)) < 0.2
    learn = ~kept
    if min(len(set(labels[kept].tolist())), len(set(labels[learn].tolist()))) < 2:
        kept = learn = np.ones(len(rows), bool)  # too few for two parts: use all in both
    model = Model(seed)
    model.fit([bags[i] for i in np.flatnonzero(learn)], labels[learn], epochs, seed)
    logits, _ = model.logits([bags[i] for i in np.flatnonzero(kept)])
    model.cut = best_cut(logits, labels[kept], share)
    return model


def score(
    documents: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, score, and the passage that got most attention with its weight."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def of(rows):
        model = shared.value
        for row in rows:
            if model is None:
                yield row["doc_id"], 0.5, 0, 1.0
                continue
            logits, attention = model.logits([encode(row["data"])])
            top = int(attention.argmax())
            mark = float(at_threshold(logits, model.cut, THRESHOLD)[0])
            yield row["doc_id"], mark, top, float(attention[top])

    named = documents.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("data"))
    kind = documents.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, score double, top_passage int, top_weight double"
    return map_rows(named, schema, of, "data")


def learned(documents: DataFrame, labels: DataFrame, learn: Column, bound: int = SAMPLE) -> Model | None:
    """The quality model of the labelled rows that ``learn`` admits."""
    return train(
        labelled_sample(documents, labels, "quality", learn, bound), prior(labels, "quality", learn)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: quality of every text, learned from rows whose remainder modulo 5 is not 0."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learned(documents, labels, remainder("doc_id", 5) != 0)
    return score(documents, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
