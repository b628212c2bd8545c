"""Subword lattice likelihood of texts.

The vocabulary is an existing one: the byte strings of a public rank file, never trained here. A word,
with the blank before it, is a lattice. One arc spans the whole word if training texts have it;
behind a back-off arc lie all vocabulary pieces that occur in the word, then the word's end. The
word's probability is the sum over all its segmentations, found by a forward recursion in log space.

Scores: a word arc has its training frequency less an absolute discount (from the numbers of words seen
once and twice); the back-off arc has what the discount sets free. Piece scores start from the
vocabulary's own order and are re-estimated by expectation maximisation over all training
words, each word counting once, as the discount takes as much from each. Pieces with a blank in front
open a word, the others and the end follow; each kind sums to one, so all texts together have
probability one at most. A text's log probability is the sum over its words and one end mark.

The lattice of a word is the same wherever the word occurs, so it is solved once per distinct word, in
parallel over the table of words, and joined back. Words that make up at least 1 / ``HEAD`` of the
training tokens number at most ``HEAD``; they are broadcast, which also takes every hot key
out of the join. All other words are joined by a shuffle.

Defined results: null is empty text, whose only token is the end; repeated rows give repeated rows;
without training rows counts are nought, the base score is that of unseen tokens, and pieces keep
the scores of their order; columns besides id and text are ignored.
"""

from __future__ import annotations

import base64
import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NON_SPACE, _arrow_schema, _batch, _steps, map_rows, remainder, ship, stored, table, text_bytes

#: Most words that are broadcast.
HEAD = 100_000
#: Rounds of expectation maximisation, and the uses every piece has beforehand.
ROUNDS, SMOOTH = 3, 0.01
_CELLS = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWEST = -1e300
RANKS = "byte_bpe_multi_50k.tiktoken"


def words_of(data: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered."""
    return data.translate(NON_SPACE).split()


class Lattice:
    """Pieces with natural-log scores, looked up by a hash that is checked to have no clash."""

    def __init__(self, pieces: list[bytes], scores: np.ndarray) -> None:
        self.pieces, self.scores = pieces, scores
        self.longest = max(map(len, pieces))
        codes = np.array([self._code(p) for p in pieces], np.uint64)
        if len(np.unique(codes)) != len(codes):
            raise ValueError("two pieces share a hash")
        bits = 20
        slot = (codes >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        self.codes, self.ids = codes[order], order
        first = np.searchsorted(slot[order], np.arange(1 << bits))
        counts = np.bincount(slot, minlength=1 << bits)
        self.first, self.depth = np.where(counts > 0, first, 0), int(counts.max())
        self.filled = counts > 0
        self.shift = np.uint64(64 - bits)
        # Pieces of one length are looked for only if the vocabulary has any.
        self.lengths = sorted({len(p) for p in pieces})

    @staticmethod
    def _code(piece: bytes) -> int:
        out = 0
        for byte in piece:
            out = (out * int(_BASE) + byte + 1) & ((1 << 64) - 1)
        return Lattice._mixed(np.array([out], np.uint64))[0]

    @staticmethod
    def _mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def arcs(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in words of one length (rows of bytes): row, start, end and piece of each."""
        n, width = letters.shape
        rows, starts, ends, found = [], [], [], []
        code = np.zeros((n, width), np.uint64)
        for length in range(1, min(self.longest, width) + 1):
            # code[:, i] becomes the hash of the ``length`` bytes from i on.
            code = code[:, : width - length + 1] * _BASE + letters[:, length - 1 :].astype(np.uint64) + np.uint64(1)
            if length not in self.lengths:
                continue
            mixed = self._mixed(code)
            # Most slots hold no piece, and what falls there is none.
            slot = (mixed >> self.shift).astype(np.int64).ravel()
            spots = np.flatnonzero(self.filled[slot])
            at, mixed = self.first[slot[spots]], mixed.ravel()[spots]
            piece = np.full(at.shape, -1, np.int64)
            for step in range(self.depth):
                place = np.minimum(at + step, len(self.codes) - 1)
                hit = self.codes[place] == mixed
                piece[hit] = self.ids[place[hit]]
            there = piece >= 0
            row, start = np.divmod(spots[there], code.shape[1])
            rows.append(row)
            starts.append(start)
            ends.append(start + length)
            found.append(piece[there])
        return tuple(np.concatenate(x) for x in (rows, starts, ends, found))

    def forward(self, letters: np.ndarray, arcs) -> np.ndarray:
        """Log probability of all segmentations of each prefix; column ``width`` is the word's."""
        n, width = letters.shape
        alpha = np.full((n, width + 1), _LOWEST)
        alpha[:, 0] = 0
        rows, starts, ends, found = arcs
        order = _order(ends, width)
        rows, starts, found = rows[order], starts[order], found[order]
        cuts = np.searchsorted(ends[order], np.arange(1, width + 2))
        for end in range(1, width + 1):
            mine = slice(cuts[end - 1], cuts[end])
            alpha[:, end] = _gathered(
                rows[mine], alpha[rows[mine], starts[mine]] + self.scores[found[mine]], n
            )
        return alpha

    def backward(self, letters: np.ndarray, arcs) -> np.ndarray:
        n, width = letters.shape
        beta = np.full((n, width + 1), _LOWEST)
        beta[:, width] = 0
        rows, starts, ends, found = arcs
        order = _order(starts, width)
        rows, ends, found = rows[order], ends[order], found[order]
        cuts = np.searchsorted(starts[order], np.arange(width + 1))
        for start in range(width - 1, -1, -1):
            mine = slice(cuts[start], cuts[start + 1])
            beta[:, start] = _gathered(
                rows[mine], beta[rows[mine], ends[mine]] + self.scores[found[mine]], n
            )
        return beta

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural-log marginal probability of each word, with the blank before it."""
        out = np.empty(len(words))
        for index, letters in _by_length(words):
            out[index] = self.forward(letters, self.arcs(letters))[:, -1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations, weighted by the words' counts."""
        out = np.zeros(len(self.pieces))
        for index, letters in _by_length(words):
            arcs = self.arcs(letters)
            rows, starts, ends, found = arcs
            alpha, beta = self.forward(letters, arcs), self.backward(letters, arcs)
            share = np.exp(
                alpha[rows, starts] + self.scores[found] + beta[rows, ends] - alpha[rows, -1]
            )
            out += np.bincount(found, share * counts[index][rows], len(out))
        return out


def _order(places: np.ndarray, width: int) -> np.ndarray:
    """Stable order of places up to ``width``; short numbers are sorted by radix."""
    return np.argsort(places.astype(np.uint16) if width < 1 << 16 else places, kind="stable")


def _gathered(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Log of the sum of exponentials for each of n rows; every row has a value."""
    top = np.full(n, _LOWEST)
    np.maximum.at(top, rows, values)
    return top + np.log(np.bincount(rows, np.exp(values - top[rows]), n))


def _by_length(words: list[bytes]):
    """Index and byte matrix of words of one length, in parts of bounded size."""
    if not words:
        return
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for group in np.split(order, edges[1:]):
        if not len(group):
            continue
        width = int(lengths[group[0]])
        step = max(1, _CELLS // (width * 8))
        for at in range(0, len(group), step):
            index = group[at : at + step]
            joined = b"".join(b" " + words[i] for i in index)
            yield index, np.frombuffer(joined, np.uint8).reshape(len(index), width)


def vocabulary(ranks: bytes) -> tuple[list[bytes], np.ndarray]:
    """Pieces that can occur in a word (a blank only in front), and weights by their order."""
    pieces = [base64.b64decode(line.split()[0]) for line in ranks.splitlines() if line]
    kept = [p for p in pieces if len(p) == 1 or p[1:].translate(NON_SPACE) == p[1:] and b" " not in p[1:]]
    return kept, 1.0 / (np.arange(len(kept)) + 100.0)


def normalised(pieces: list[bytes], uses: np.ndarray, words: float) -> tuple[np.ndarray, float]:
    """Natural-log scores of the pieces, and of a word's end."""
    opens = np.array([p[:1] == b" " for p in pieces])
    weights = uses + SMOOTH * uses.sum() / max(1, len(uses)) / 100 + 1e-12
    scores = np.log(weights)
    scores[opens] -= math.log(weights[opens].sum())
    following = weights[~opens].sum() + words
    scores[~opens] -= math.log(following)
    return scores, math.log(words / following)


def word_counts(documents: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, c): every distinct word of all texts with its count in those to learn from."""

    def of(rows):
        learned, other = Counter(), set()
        for row in rows:
            (learned.update if row["learn"] else other.update)(words_of(row["data"]))
        yield from learned.items()
        yield from ((word, 0) for word in other - learned.keys())

    named = documents.select(text_bytes(text).alias("data"), learn.alias("learn"))
    return map_rows(named, "word binary, c long", of, "data").groupBy("word").agg(
        F.sum("c").alias("c")
    )


def fit(counts: DataFrame, ranks: bytes, rounds: int = ROUNDS) -> tuple[Lattice, float]:
    """The lattice of pieces with scores from all training words, and the score of a word's end.

    Each round sums expected uses over the table of words; what reaches the driver is one
    number per piece of the vocabulary, whatever the size of the corpus.
    """
    pieces, weights = vocabulary(ranks)
    scores, end = normalised(pieces, weights, weights.sum() / 3)
    lattice, spark = Lattice(pieces, scores), counts.sparkSession
    ship(spark)
    learned = counts.where("c > 0")
    words = learned.count()
    for _ in range(rounds if words else 0):
        shared = spark.sparkContext.broadcast(lattice)

        def run(batches, shared=shared):
            import pyarrow as pa

            total = np.zeros(len(shared.value.pieces))
            for batch in batches:
                found = batch.column("word").to_pylist()
                total += shared.value.expected(found, np.ones(len(found)))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(total[used])], ["piece", "uses"]
            )

        uses = np.zeros(len(pieces))
        rows = learned.select("word").mapInArrow(run, "piece int, uses double")
        for row in rows.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            uses[row.piece] = row.uses
        scores, end = normalised(pieces, uses, words)
        lattice = Lattice(pieces, scores)
    return lattice, end


def score(
    documents: DataFrame,
    learn: Column,
    ranks: bytes,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row (log10)."""
    spark = documents.sparkSession
    ship(spark)
    counts = stored(word_counts(documents, learn, doc_id, text))
    c = F.col("c")
    sums = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count_if(c > 0).alias("v"),
        F.count_if(c == 1).alias("once"),
        F.count_if(c == 2).alias("twice"),
    ).first()
    ends = documents.where(learn).count()
    n, v = sums.n + ends, sums.v + (1 if ends else 0)
    lattice, word_end = fit(counts, ranks)
    shared = spark.sparkContext.broadcast(lattice)
    discount = (sums.once + 1) / (sums.once + 2 * sums.twice + 2)
    # Without training rows a word and the end are as likely, and every word is backed off.
    free, end = (discount * sums.v / n, ends / n) if n else (0.5, 0.5)
    free = free or 1.0 / (n + 1)

    def of_words(batches):
        import pyarrow as pa

        for batch in batches:
            times = batch.column("c").to_numpy().astype(float)
            spelled = shared.value.log_probabilities(batch.column("word").to_pylist()) + word_end
            whole = np.where(times > 0, np.maximum(times - discount, 0) / max(1, n), 0)
            with np.errstate(divide="ignore"):
                p = np.logaddexp(np.log(whole), math.log(free) + spelled) / math.log(10)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(p)], ["word", "c", "p"]
            )

    words = stored(counts.mapInArrow(of_words, "word binary, c long, p double"))
    is_head = (F.col("c") > 0) & (F.col("c") * HEAD >= n)
    # By the condition there are at most HEAD such words.
    head = {bytes(r.word): (r.c, r.p) for r in words.where(is_head).collect()}
    known = spark.sparkContext.broadcast(head)
    base_of = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    end_row = (1, int(ends > 0), base_of(ends), math.log10(end or 1.0 / (n + 1)))

    kind = documents.schema[doc_id].dataType.simpleString()
    schema = (
        f"row_no long, word binary, times int, doc_id {kind}, tokens long, met long, base double, total double"
    )
    names, types = _arrow_schema(spark, schema)

    def lines_of(batches):
        common = {w: (c, base_of(c), p) for w, (c, p) in known.value.items()}
        out = [[] for _ in names]
        for row in (row for batch in batches for rows in _steps(batch, "data") for row in rows):
            tokens, met, base, total = end_row
            rest, often = [], []
            for word, times in Counter(words_of(row["data"])).items():
                tokens += times
                entry = common.get(word)
                if entry is None:
                    rest.append(word)
                    often.append(times)
                else:
                    met += times
                    base += times * entry[1]
                    total += times * entry[2]
            # A blank cannot be in a word: the row's own line meets no word in the join.
            own = b" " + row["row_no"].to_bytes(8, "big")
            n = len(rest)
            for column, first, others in zip(
                out,
                (row["row_no"], own, 0, row["doc_id"], tokens, met, base, total),
                ([row["row_no"]] * n, rest, often, [None] * n, [0] * n, [0] * n, [0.0] * n, [0.0] * n),
            ):
                column.append(first)
                column.extend(others)
            if len(out[0]) >= 20_000:
                yield _batch(out, names, types)
                out = [[] for _ in names]
        if out[0]:
            yield _batch(out, names, types)

    lines = documents.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(doc_id).alias("doc_id"),
        text_bytes(text).alias("data"),
    ).mapInArrow(lines_of, schema)
    tail = words.where(~is_head).select(
        "word",
        (F.col("c") > 0).cast("int").alias("seen"),
        F.log10((F.col("c") + 0.1) / F.lit(n + 0.1 * (v + 1))).alias("b"),
        "p",
    )
    times = F.col("times")
    return (
        lines.join(tail, "word", "left")
        .groupBy("row_no")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("tokens").alias("n_tokens"),
            F.sum(F.col("met") + times * F.coalesce("seen", F.lit(0))).alias("n_known"),
            F.sum(F.col("base") + times * F.coalesce("b", F.lit(0.0))).alias("base_score"),
            F.sum(F.col("total") + times * F.coalesce("p", F.lit(0.0))).alias("score"),
        )
        .select(
            "doc_id",
            "n_tokens",
            "n_known",
            F.lit(n).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: likelihood of every text, learned from rows whose remainder modulo 10 is not 0."""
    from .byte_bpe import rank_file

    documents = table(spark, sf_dir, "documents")
    found = score(documents, remainder("doc_id", 10) != 0, rank_file(RANKS)[0])
    return found.withColumn("held_out", remainder("doc_id", 10) == 0).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
