"""Toxicity by a convolutional text classifier, trained in numpy.

Words and their beginnings of ``PREFIXES`` bytes are hashed into 2**24 buckets, and a place in a text has the
sum of their embeddings, so a form never seen is judged by the stem it shares with others. A bucket
has an embedding if it occurs in at least ``LEAST_SHARE`` of the training texts, or in fewer (three at
least) of which more are of one label than chance explains (``LEAST_SCORE`` standard errors); all
others have the null vector and cannot be learned by heart. Filters of widths 1 to 3 run over the
words, each filter's maximum over the whole text feeds a logistic layer. The number of training steps, not of epochs,
is fixed from below, so that a small table is learned as well.

Every labelled row that the caller admits is learned from, in tasks. Buckets are counted over all of them.
They are dealt by id to shards; in each round every shard takes one pass of steps from the same weights
and Adam's moments, and both are averaged over the shards, block by block. One shard makes all its passes at
once. The number of shards follows from the rows, up to ``SHARDS``, not from the cluster; a
shard is streamed, so a task holds a batch of it.

Thresholds are calibrated by language on scores that cross-validation gives: each training text is
scored by a model that did not see it, and all logits are counted on a grid of ``GRID`` steps a unit.
The language is guessed from the text's function words, so nothing but the text enters a score; each
language's threshold falls on ``THRESHOLD`` of the returned score.

The driver holds the weights, the admitted buckets and the counts on the grid only; every document is
scored. Defined results: null is empty text; an empty text has a score (that of no evidence);
without labels of both classes every score is 0; repeated rows give repeated rows; columns besides
id and text are ignored.
"""

from __future__ import annotations

import itertools
import operator

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    STEP_BYTES,
    hash_words,
    map_columns,
    map_rows,
    mix,
    remainder,
    ship,
    stored,
    table,
    text_bytes,
    word_spans,
    word_table,
)
from .training import Adam, at_threshold, best_cut_of_counts, labelled, prior, sigmoid

THRESHOLD = 0.3
#: Share of the training texts a bucket must occur in to get an embedding (three texts at least).
LEAST_SHARE = 0.005
#: Standard errors by which a rarer bucket's share of toxic texts must differ from the share of all.
LEAST_SCORE = 5.0
#: Bytes of the beginnings of words that are hashed beside the words.
PREFIXES = (5, 8)
#: Parts of the cross-validation, and steps (batches) a fit makes at least and at most.
FOLDS, STEPS = 4, (400, 700)
BATCH = 32
#: Rows and bytes of texts of a shard, and the number of shards beyond which they grow instead.
SHARD_ROWS, SHARD_BYTES, SHARDS = 16384, 64 << 20, 64
#: Words that a batch's arrays hold at once; longer texts go through one by one.
_WORDS = 1 << 16
#: Floats of a block that is averaged, steps of the grid a unit of the logit, and its ends.
_BLOCK, GRID, _ENDS = 1 << 16, 256, 64
WIDTHS, FILTERS, DIMENSIONS = (1, 2, 3), 8, 8
#: Weight decay of the fit.
DECAY = 3e-4
#: Positives of a language needed for a threshold of its own.
LEAST_POSITIVE = 8
_LETTERS = word_table(b"abcdefghijklmnopqrstuvwxyz")
#: Frequent function words by which a text's language is guessed.
_FUNCTION_WORDS = {
    "en": "the of and to in is that for it was with as",
    "fr": "le la les et des une dans est pour que du qui",
    "de": "der die und das ist nicht ein mit von den sich zu",
    "es": "el los las que por con una para del y en no",
}
LANGUAGES = ("", *_FUNCTION_WORDS)
_KEYS = np.array(
    [hash_words(w.encode())[0] for words in _FUNCTION_WORDS.values() for w in words.split()]
)
_ORDER = np.argsort(_KEYS)
_KEY_LANGUAGE = np.repeat(np.arange(1, 5), [len(w.split()) for w in _FUNCTION_WORDS.values()])


def words_of(data: bytes) -> np.ndarray:
    """Hashes of the words (letters only, A-Z lowered) of a whole text."""
    return hash_words(data.translate(_LETTERS))


def grams_of(data: bytes) -> np.ndarray:
    """A column a word: the hash of the word and those of its beginnings; 0 where it is no longer than them."""
    data = data.translate(_LETTERS)
    rows = [hash_words(data)]
    for size in PREFIXES:
        rows.append(_beginnings(data, size, len(rows[0])))
    return np.stack(rows)


def _beginnings(data: bytes, size: int, n: int) -> np.ndarray:
    """Hashes of the first ``size`` bytes of each of the ``n`` words; 0 for words not longer."""
    out, at, done = np.zeros(n, np.uint64), 0, 0
    codes = np.frombuffer(data, np.uint8)
    while at < len(data):
        cut = data.find(b" ", at + STEP_BYTES)
        end = cut if cut >= 0 else len(data)
        starts, ends = word_spans(data[at:end])
        long = np.flatnonzero(ends - starts > size)
        bytes_of = codes[at + starts[long][:, None] + np.arange(size)].astype(np.uint64)
        value = np.full(len(long), size, np.uint64)
        for j in range(size):
            value = value * np.uint64(0x9E3779B97F4A7C15) + bytes_of[:, j]
        out[done + long] = mix(value)
        at, done = end, done + len(starts)
    return out


def language_of(words: np.ndarray) -> int:
    """Index into LANGUAGES; 0 if no function word occurs."""
    sorted_keys = _KEYS[_ORDER]
    at = np.minimum(np.searchsorted(sorted_keys, words), len(sorted_keys) - 1)
    met = sorted_keys[at] == words
    counts = np.bincount(_KEY_LANGUAGE[_ORDER][at[met]], minlength=len(LANGUAGES))
    return int(counts.argmax()) if counts.any() else 0


def _buckets(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(40)).astype(np.int64)


def rows_among(among: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Places of a text's grams among the buckets, a line a word; at least as many lines as the widest filter needs."""
    found = _buckets(grams)
    at = np.minimum(np.searchsorted(among, found), len(among) - 1)
    rows = np.where((among[at] == found) & (grams != 0), at, 0).T
    short = max(WIDTHS) - len(rows)
    return np.pad(rows, ((0, short), (0, 0))) if short > 0 else rows


class Model:
    """Embeddings, filters and the logistic layer; row 0 of the embeddings is the null vector."""

    def __init__(self, buckets: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.buckets = np.concatenate([[-1], buckets]).astype(np.int64)
        w: dict[str, np.ndarray] = {"E": rng.normal(0, 0.1, (len(self.buckets), DIMENSIONS))}
        w["E"][0] = 0
        for width in WIDTHS:
            fan = width * DIMENSIONS
            w[f"W{width}"] = rng.normal(0, 0.3 / np.sqrt(width), (fan, FILTERS))
            w[f"b{width}"] = np.zeros(FILTERS)
        w["o"] = rng.normal(0, 0.3, len(WIDTHS) * FILTERS)
        w["c"] = np.zeros(1)
        self.weights = {k: v.astype(np.float32) for k, v in w.items()}
        self.cuts = np.zeros(len(LANGUAGES))

    def rows_of(self, grams: np.ndarray) -> np.ndarray:
        """Embedding rows, a line a word; at least as many lines as the widest filter needs."""
        return rows_among(self.buckets, grams)

    def features(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima of all filters, and the positions that have them."""
        w, tops, places = self.weights, [], []
        for start in range(0, len(rows), 1 << 17):  # long texts in overlapping parts
            part = rows[start : start + (1 << 17) + max(WIDTHS) - 1]
            if len(part) < max(WIDTHS):
                break
            x, top, place = w["E"][part].sum(axis=1), [], []
            for width in WIDTHS:
                n = len(part) - width + 1
                y = sum(
                    x[j : j + n] @ w[f"W{width}"][j * DIMENSIONS : (j + 1) * DIMENSIONS]
                    for j in range(width)
                )
                best = y.argmax(0)
                top.append(y[best, np.arange(FILTERS)] + w[f"b{width}"])
                place.append(best + start)
            tops.append(np.concatenate(top))
            places.append(np.concatenate(place))
        which = np.argmax(tops, axis=0)
        columns = np.arange(len(which))
        return np.array(tops)[which, columns], np.array(places)[which, columns]

    def logit(self, grams: np.ndarray) -> float:
        return self.logit_of(self.rows_of(grams))

    def logit_of(self, rows: np.ndarray) -> float:
        top, _ = self.features(rows)
        return float(np.maximum(top, 0) @ self.weights["o"] + self.weights["c"][0])

    def score(self, grams: np.ndarray) -> float:
        """Score in (0, 1) in which the language's own cut falls on the threshold."""
        return float(at_threshold(self.logit(grams), self.cuts[language_of(grams[0])], THRESHOLD))

    def gradient(self, texts: list[np.ndarray], labels: list[int], weights: list[float]) -> dict[str, np.ndarray]:
        """Gradient of the weighted loss over the rows of some texts."""
        grad = {k: np.zeros_like(v) for k, v in self.weights.items()}
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and held + len(texts[end]) <= _WORDS:
                held += len(texts[end])
                end += 1
            if end == at:
                self._backward(texts[at], labels[at], weights[at], grad)
                end += 1
            else:
                self._add(texts[at:end], np.array(labels[at:end]), np.array(weights[at:end]), grad)
            at = end
        grad["E"][0] = 0
        return grad

    def _add(self, texts, labels, weights, grad) -> None:
        """``_backward`` of several texts at once: one product for all filters and words."""
        w, wide, every = self.weights, max(WIDTHS), FILTERS * len(WIDTHS)
        kind = w["E"].dtype
        rows = np.concatenate([*texts, np.zeros((wide, texts[0].shape[1]), texts[0].dtype)])
        x = w["E"].take(rows[:, 0], axis=0, mode="clip")
        for gram in range(1, rows.shape[1]):
            live = np.flatnonzero(rows[:, gram])
            x[live] += w["E"].take(rows[live, gram], axis=0, mode="clip")
        n, lying = len(rows) - wide, np.ascontiguousarray(x.T)
        windows = np.concatenate([lying[:, j : j + n] for j in range(wide)])
        joint = np.zeros((every, wide * DIMENSIONS), kind)
        for k, width in enumerate(WIDTHS):
            joint[k * FILTERS : (k + 1) * FILTERS, : width * DIMENSIONS] = w[f"W{width}"].T
        y = joint @ windows
        bias = np.concatenate([w[f"b{width}"] for width in WIDTHS])
        place = np.empty((len(texts), every), np.int64)
        start = 0
        for i, text in enumerate(texts):
            for k, width in enumerate(WIDTHS):
                mine = slice(k * FILTERS, (k + 1) * FILTERS)
                best = y[mine, start : start + len(text) - width + 1].argmax(1)
                place[i, mine] = best + start
            start += len(text)
        top = y[np.arange(every), place] + bias
        on = np.maximum(top, 0)
        error = ((sigmoid(on @ w["o"] + w["c"][0]) - labels) * weights).astype(kind)
        grad["o"] += error @ on
        grad["c"] += error.sum()
        back = np.where(top > 0, error[:, None] * w["o"], 0).astype(kind)
        best = x[place[:, :, None] + np.arange(wide)].reshape(*place.shape, -1)
        weight = np.einsum("bf,bfd->fd", back, best)
        for k, width in enumerate(WIDTHS):
            mine = slice(k * FILTERS, (k + 1) * FILTERS)
            grad[f"W{width}"] += weight[mine, : width * DIMENSIONS].T
            grad[f"b{width}"] += back[:, mine].sum(0)
        flow = (back[:, :, None] * joint).reshape(-1, wide, DIMENSIONS)
        met = rows[place[:, :, None] + np.arange(wide)].reshape(-1, wide, rows.shape[1])
        # Only what reaches an embedding: live filters, and grams that have one.
        which, word, gram = np.nonzero((met != 0) & (flow != 0).any(2)[:, :, None])
        target, flow = met[which, word, gram], flow[which, word]
        if len(target):
            order = np.argsort(target, kind="stable")
            target = target[order]
            first = np.flatnonzero(np.diff(target, prepend=-1))
            grad["E"][target[first]] += np.add.reduceat(flow[order], first, axis=0)

    def _backward(self, rows, label, weight, grad) -> None:
        w = self.weights
        top, place = self.features(rows)
        on = np.maximum(top, 0)
        error = (sigmoid(on @ w["o"] + w["c"][0]) - label) * weight
        grad["o"] += error * on
        grad["c"] += error
        back = np.where(top > 0, error * w["o"], 0).astype(np.float32)
        for k, width in enumerate(WIDTHS):
            mine = slice(k * FILTERS, (k + 1) * FILTERS)
            # The rows of each filter's best window: filter, word, gram.
            g, at = back[mine], rows[place[mine][:, None] + np.arange(width)]
            windows = w["E"][at].sum(axis=2).reshape(FILTERS, -1)
            grad[f"W{width}"] += (windows * g[:, None]).T
            grad[f"b{width}"] += g
            flow = (w[f"W{width}"].T * g[:, None]).reshape(FILTERS, width, 1, DIMENSIONS)
            np.add.at(grad["E"], at, np.broadcast_to(flow, (*at.shape, DIMENSIONS)))

    def calibrate(self, counts: np.ndarray, prior: float) -> None:
        """A cut for each language that has enough examples; the others share one.

        ``counts`` has a line a language, a place of the grid and a label: how many rows lie there.
        """
        self.cuts[:] = _cut(counts.sum(0), prior)
        for i, mine in enumerate(counts):
            if mine.sum(0).min() >= LEAST_POSITIVE:
                self.cuts[i] = _cut(mine, prior)


def _cut(counts: np.ndarray, prior: float) -> float:
    held = np.flatnonzero(counts.any(1))
    return best_cut_of_counts(held / GRID - _ENDS, counts[held, 0], counts[held, 1], prior)


class _Fit:
    """One model in training: Adam's state, the part of the rows it must not see, the rows of the next step."""

    def __init__(self, model: Model, part: int, balance: list[float]) -> None:
        self.model, self.part, self.balance = model, part, balance
        self.adam = Adam(model.weights, 0.02)
        self.seen, self._held = 0, []

    def take(self, rows: np.ndarray, label: int, part: int) -> None:
        if part != self.part:
            self._held.append((rows, label, self.balance[label]))
            if len(self._held) == BATCH:
                self.step()

    def step(self) -> None:
        if self._held:
            texts, labels, weights = map(list, zip(*self._held))
            grad = self.model.gradient(texts, labels, [w / len(texts) for w in weights])
            for k, weight in self.model.weights.items():
                grad[k] += DECAY * weight
            self.adam.step(grad)
            self.seen += len(texts)
            self._held = []

    def _arrays(self) -> list[np.ndarray]:
        of = (self.model.weights, self.adam.first, self.adam.second)
        return [arrays[k] for arrays in of for k in sorted(arrays)]

    def state(self, moments: bool = True) -> np.ndarray:
        """All weights, then Adam's moments."""
        return np.concatenate([a.ravel() for a in self._arrays()[: None if moments else len(self.model.weights)]])

    def restore(self, state: np.ndarray, steps: int) -> None:
        at = 0
        for array in self._arrays():
            if at == len(state):
                break  # weights only
            array[...] = state[at : at + array.size].reshape(array.shape)
            at += array.size
        self.adam.steps = steps


class _Rows:
    """Labelled texts; ``part`` is the fold."""

    def __init__(self, sample: DataFrame) -> None:
        part = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
        self.rows = stored(sample.withColumn("part", part), "zstd")
        found = self.rows.groupBy("part", "label").agg(F.count("*").alias("n"), F.sum(F.length("data")).alias("size"))
        self.counts, self.size = np.zeros((FOLDS, 2), np.int64), 0
        for r in found.collect():
            self.counts[r.part, r.label] += r.n
            self.size += r.size

    def seen(self, part: int) -> np.ndarray:
        """Rows of each label that the model of a part learns from; part -1 is held back by no one."""
        return self.counts.sum(0) - (self.counts[part] if part >= 0 else 0)

    def parts(self) -> list[int]:
        """The models to fit: that of all rows, and one a fold unless a label is too rare for that."""
        folds = range(FOLDS) if self.counts.sum(0).min() >= 2 * FOLDS else ()
        return [-1, *(folds if all(self.seen(k).min() > 0 for k in folds) else ())]

    def shards(self) -> int:
        by_rows, by_size = -(-int(self.counts.sum()) // SHARD_ROWS), -(-self.size // SHARD_BYTES)
        return min(SHARDS, max(1, by_rows, by_size))


def admitted(labelled_rows: _Rows, parts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that get an embedding in some model, and a line of flags a model: frequent ones, and rarer ones
    that lean to one label, among all rows the model learns from."""

    def of(rows):
        met = {}
        for row in rows:
            grams = grams_of(row["data"])
            met.setdefault((row["part"], row["label"]), []).append(np.unique(_buckets(grams[grams != 0])))
        for (part, label), buckets in met.items():
            bucket, n = np.unique(np.concatenate(buckets), return_counts=True)
            yield bucket, np.full(len(bucket), 2 * part + label), n

    counted = map_columns(labelled_rows.rows, "bucket int, of int, n int", of, "data")
    sums = [F.sum(F.when(F.col("of") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(2 * FOLDS)]
    flags = []
    for part in parts:
        zeros, ones = (
            sum((F.col(f"n{2 * k + label}") for k in range(FOLDS) if k != part), F.lit(0)) for label in (0, 1)
        )
        size = float(labelled_rows.seen(part).sum())
        share = float(labelled_rows.seen(part)[1]) / size
        n = zeros + ones
        lean = F.abs(ones - share * n) / F.sqrt(F.greatest(F.lit(1e-9), share * (1 - share) * n))
        flags.append((n >= 3) & ((n >= LEAST_SHARE * size) | (lean >= LEAST_SCORE)))
    chosen = counted.groupBy("bucket").agg(*sums).select("bucket", F.array(*flags).alias("flags"))
    rows = sorted(chosen.where(F.exists("flags", lambda x: x)).collect())
    buckets = np.array([r.bucket for r in rows], np.int64)
    return buckets, np.array([r.flags for r in rows], bool).reshape(-1, len(parts)).T


def _short(rows: np.ndarray) -> np.ndarray:
    """The same rows with at most as many null lines in succession as the widest filter: no maximum changes."""
    places = np.arange(len(rows))
    last = np.maximum.accumulate(np.where(rows.any(1), places, -1))
    return rows[places - last <= max(WIDTHS)]


def _dealt(texts: _Rows, buckets: np.ndarray, shards: int, seed: int) -> RDD:
    """(label, part, language, rows of the embeddings, shard) of every text, shard by shard in the order of a hash.

    An RDD, so that all rounds read the files of one shuffle.
    """
    shared = texts.rows.sparkSession.sparkContext.broadcast(buckets)

    def of(part):
        for row in part:
            grams = grams_of(row["data"])
            rows = _short(rows_among(shared.value, grams)).astype(np.int32)
            yield row["doc_id"], row["label"], row["part"], language_of(grams[0]), rows.tobytes()

    kind = texts.rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, label int, part int, language int, rows binary"
    dealt = map_rows(texts.rows, schema, of, "data")
    # The shard is a column: it does not hang on how many partitions there are.
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int"))
    dealt = dealt.repartition(shards, "shard")
    return dealt.sortWithinPartitions("shard", F.xxhash64("doc_id", F.lit(seed)), "doc_id").drop("doc_id").rdd


def _lines(row) -> np.ndarray:
    return np.frombuffer(row.rows, np.int32).reshape(-1, 1 + len(PREFIXES))


def _start(buckets: np.ndarray, own: np.ndarray, part: int, seen: np.ndarray, seed: int) -> _Fit:
    """A model before its first step; buckets that are not its own keep the null vector."""
    model = Model(buckets, seed)
    model.weights["E"][1:][~own] = 0
    return _Fit(model, part, [float(0.5 / max(1, n) * seen.sum()) for n in seen])


def _passes(rows: int) -> int:
    a_pass = max(1, -(-rows // BATCH))
    return max(1, -(-min(STEPS[1], max(STEPS[0], 6 * a_pass)) // a_pass))


def _round(dealt: RDD, number: int, fits: list[_Fit], passes: list[int] | None, last: bool = True) -> None:
    """One round over all shards; the averages become the state of ``fits``. ``passes`` for one shard only.

    Moments travel only where they are needed: not before the first step, and not after the last round.
    """
    context, buckets = dealt.context, fits[0].model.buckets
    sent = [(fit.part, fit.balance, fit.state(fit.adam.steps > 0), fit.adam.steps) for fit in fits]
    shared = context.broadcast((buckets, sent))

    def learn(rows):
        for shard, mine in itertools.groupby(rows, lambda row: row.shard):
            yield from of_shard(shard, mine)

    def of_shard(shard, rows):
        buckets, sent = shared.value
        mine, held = [], []
        for part, balance, state, steps in sent:
            mine.append(_Fit(Model(buckets[1:]), part, balance))
            mine[-1].restore(state, steps)
        for row in rows:
            if passes is not None:
                held.append((_lines(row), row.label, row.part))
                continue
            for fit in mine:
                fit.take(_lines(row), row.label, row.part)
        for k, fit in enumerate(mine):
            rng = np.random.default_rng(number + k)
            for _ in range(passes[k] if passes is not None else 0):
                for i in rng.permutation(len(held)):
                    fit.take(*held[i])
                fit.step()
            fit.step()
            state = fit.state(not last).astype(np.float32)
            for block in range(0, len(state) if fit.seen else 0, _BLOCK):
                yield (k, block), (shard, fit.seen, fit.adam.steps, state[block : block + _BLOCK].tobytes())

    # The weights and moments of the models, once: their size follows from the admitted buckets.
    averaged: dict[int, list] = {}
    for (k, block), found in dealt.mapPartitions(learn).groupByKey().mapValues(_mean).collect():
        averaged.setdefault(k, []).append((block, *found))
    for k, blocks in averaged.items():
        state = b"".join(state for _, _, state in sorted(blocks))
        fits[k].restore(np.frombuffer(state, np.float32), max(steps for _, steps, _ in blocks))
    shared.destroy()


def _mean(states) -> tuple[int, bytes]:
    """Most steps, and the mean state by rows; in the order of the shards, so the sum is always the same."""
    states = sorted(states)
    rows = sum(n for _, n, _, _ in states)
    total = sum(n / rows * np.frombuffer(state, np.float32).astype(float) for _, n, _, state in states)
    return max(steps for _, _, steps, _ in states), total.astype(np.float32).tobytes()


def _counted(dealt: RDD, fits: list[_Fit]) -> np.ndarray:
    """Rows by language, place of the logit on the grid, and label; each is scored by the model that did not see it."""
    shared = dealt.context.broadcast([_bare(fit.model) for fit in fits])
    fold = {fit.part: k for k, fit in enumerate(fits)}

    def place(row):
        logit = shared.value[fold.get(row.part, 0)].logit_of(_lines(row))
        return (row.language, int(np.clip(np.rint((logit + _ENDS) * GRID), 0, 2 * _ENDS * GRID)), row.label), 1

    out = np.zeros((len(LANGUAGES), 2 * _ENDS * GRID + 1, 2), np.int64)
    for key, n in dealt.map(place).reduceByKey(operator.add).collect():
        out[key] = n
    shared.destroy()
    return out


def _bare(model: Model) -> Model:
    """The weights alone, for rows whose embeddings are looked up already."""
    bare = object.__new__(Model)
    bare.weights = model.weights
    return bare


def train(sample: DataFrame, share: float = 0.5, seed: int = 7) -> Model | None:
    """Fit on all of (doc_id, label, data); thresholds come from cross-validation."""
    ship(sample.sparkSession)
    texts = _Rows(sample)
    if not texts.counts.sum(0).all():
        return None
    parts, shards = texts.parts(), texts.shards()
    buckets, own = admitted(texts, parts)
    fits = [_start(buckets, own[k], part, texts.seen(part), seed + 1 + part) for k, part in enumerate(parts)]
    model = fits[0].model
    dealt = _dealt(texts, model.buckets, shards, seed)
    if shards == 1:
        _round(dealt, seed, fits, [_passes(int(texts.seen(part).sum())) for part in parts])
    else:
        rounds = max(2, _passes(-(-int(texts.counts.sum()) // shards)))
        for number in range(rounds):
            _round(dealt, seed + number, fits, None, number + 1 == rounds)
    model.calibrate(_counted(dealt, fits), share)
    return model


def score(
    documents: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, guessed language, raw logit, that language's cut, and the score of each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def of(rows):
        model = shared.value
        for row in rows:
            grams = grams_of(row["data"])
            language = language_of(grams[0])
            if model is None:
                yield row["doc_id"], LANGUAGES[language], 0.0, 0.0, 0.0
                continue
            logit, cut = model.logit(grams), float(model.cuts[language])
            yield (
                row["doc_id"],
                LANGUAGES[language],
                logit,
                cut,
                float(at_threshold(logit, cut, THRESHOLD)),
            )

    named = documents.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("data"))
    kind = documents.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, language string, logit double, cut double, score double"
    return map_rows(named, schema, of, "data")


def below_threshold(
    documents: DataFrame, model: Model | None, text: str = "text"
) -> DataFrame:
    """The rows of ``documents``, all columns as they are, that score below the threshold.

    The test runs inside the scan: a text goes to Python, the verdict comes back beside its row.
    """
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(data: pd.Series) -> pd.Series:
        model = shared.value
        if model is None:
            return pd.Series(True, index=data.index)
        return data.map(lambda x: model.score(grams_of(x)) < THRESHOLD).astype(bool)

    return documents.where(clean(text_bytes(text)))


def learned(documents: DataFrame, labels: DataFrame, learn: Column) -> Model | None:
    """The toxicity model of all labelled rows that ``learn`` admits."""
    return train(labelled(documents, labels, "toxic", learn), prior(labels, "toxic", learn))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: toxicity of every text, learned from rows whose remainder modulo 4 is not 2."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learned(documents, labels, remainder("doc_id", 4) != 2)
    return score(documents, model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
