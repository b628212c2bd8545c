"""Fill-in-the-middle rewriting; a wavelet matrix over character classes finds the cuts.

Every byte of a text's UTF-8 form gets one of six classes, and the wavelet matrix of that
sequence answers how often a class occurs before a position. Sums of such ranks count
boundaries: newlines end lines, white space before something else ends words, bytes that
continue no character start characters. A cut after k units is found by bisection on the
summed ranks, and the characters in a part are a difference of two ranks.

Texts are rewritten row by row, without a shuffle; a text costs some six bytes of memory a byte.

Defined results: null or empty text has no units and stays plain, as does a text that holds a
marker; a null id counts as empty text in the random choice; repeated rows give repeated rows;
columns besides id and text are ignored; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, table, text_bytes

# Markers of the three parts; a text that holds one of them stays plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

# Classes of bytes. *_EDGE is white space whose next byte is not white.
OTHER, CONTINUED, BLANK, BLANK_EDGE, NEWLINE, NEWLINE_EDGE = range(6)
_BITS = 3
_BLOCK = 64  # bytes of a bit vector that one entry of its directory covers

_KIND = np.full(256, OTHER, np.uint8)
_KIND[0x80:0xC0] = CONTINUED
_KIND[[9, 11, 12, 13, 32]] = BLANK
_KIND[10] = NEWLINE


def classes(data: bytes) -> np.ndarray:
    """The class of every byte."""
    kinds = _KIND[np.frombuffer(data, np.uint8)]
    white = kinds >= BLANK
    kinds[:-1] += white[:-1] & ~white[1:]
    return kinds


class BitVector:
    """Packed bits with the number of ones before every block."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        counts = np.zeros(-(-len(packed) // _BLOCK) * _BLOCK, np.uint8)
        counts[: len(packed)] = np.bitwise_count(packed)
        per_block = counts.reshape(-1, _BLOCK).sum(axis=1, dtype=np.int64)
        self.before = [0, *np.cumsum(per_block).tolist()]
        self.packed = packed.tobytes()

    def ones(self, end: int) -> int:
        """Ones among the first ``end`` bits."""
        block, rest = divmod(end, 8 * _BLOCK)
        if not rest:
            return self.before[block]
        start = block * _BLOCK
        word = int.from_bytes(self.packed[start : start + (rest + 7) // 8], "little")
        return self.before[block] + (word & ((1 << rest) - 1)).bit_count()


class WaveletMatrix:
    """Ranks over a sequence of classes: one bit vector a bit, highest bit first."""

    def __init__(self, sequence: np.ndarray) -> None:
        self.size = len(sequence)
        self.levels: list[tuple[BitVector, int]] = []
        for bit in range(_BITS - 1, -1, -1):
            ones = (sequence >> bit & 1).astype(bool)
            self.levels.append((BitVector(ones), self.size - int(np.count_nonzero(ones))))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        self.first = [self._place(kind, 0) for kind in range(1 << _BITS)]

    def _place(self, kind: int, end: int) -> int:
        for bit, (vector, zeros) in zip(range(_BITS - 1, -1, -1), self.levels):
            ones = vector.ones(end)
            end = zeros + ones if kind >> bit & 1 else end - ones
        return end

    def rank(self, kind: int, end: int) -> int:
        """Occurrences of ``kind`` among the first ``end`` places."""
        return self._place(kind, end) - self.first[kind]

    def total(self, kinds: tuple[int, ...], end: int) -> int:
        """Occurrences of any of ``kinds`` among the first ``end`` places."""
        return sum(self.rank(kind, end) for kind in kinds)

    def select(self, kinds: tuple[int, ...], k: int) -> int:
        """The place of the k-th (from 1) occurrence of any of ``kinds``, by bisection on ranks."""
        low, high = 0, self.size
        while high - low > 1:
            middle = (low + high) // 2
            if self.total(kinds, middle) >= k:
                high = middle
            else:
                low = middle
        return low


#: Classes that end a unit where they stand; a rest without such an end is one more unit.
ENDS = {"line": (NEWLINE, NEWLINE_EDGE), "word": (BLANK_EDGE, NEWLINE_EDGE)}
_STARTS = (OTHER, BLANK, BLANK_EDGE, NEWLINE, NEWLINE_EDGE)


class Units:
    """A text cut into lines, characters, or words with the white space after them.

    White space at the very start is a unit of words by itself.
    """

    def __init__(self, data: bytes, unit: str) -> None:
        self.size, self.ends = len(data), None if unit == "char" else ENDS[unit]
        self.matrix = WaveletMatrix(classes(data)) if data else None
        if self.matrix is None:
            self.count = self.ended = 0
            return
        self.ended = self.matrix.total(self.ends or _STARTS, self.size)
        closed = self.ends is None or self._after(self.ended) == self.size
        self.count = self.ended + (not closed)

    def _after(self, k: int) -> int:
        return self.matrix.select(self.ends or _STARTS, k) + 1 if k else 0

    def cut(self, k: int) -> int:
        """The byte after the k-th unit."""
        if k == 0:
            return 0
        if k >= self.count or (self.ends is not None and k > self.ended):
            return self.size
        return self._after(k) if self.ends is not None else self.matrix.select(_STARTS, k + 1)

    def chars(self, start: int, end: int) -> int:
        """Code points between two bytes."""
        if self.matrix is None:
            return 0
        continued = self.matrix.rank(CONTINUED, end) - self.matrix.rank(CONTINUED, start)
        return end - start - continued


def rewritten(data: bytes, draws: tuple[int, int, int, int], unit: str, rate: int, spm: int):
    """(units, form, code points of prefix and middle, output) of one text."""
    units = Units(data, unit)
    marked = any(marker.encode() in data for marker in (PREFIX, SUFFIX, MIDDLE))
    if not data or marked or draws[2] % 100 >= rate:
        return units.count, PLAIN, None, None, data
    one, two = draws[0] % (units.count + 1), draws[1] % (units.count + 1)
    first, second = units.cut(min(one, two)), units.cut(max(one, two))
    prefix, middle, suffix = data[:first], data[first:second], data[second:]
    form = SPM if draws[3] % 100 < spm else PSM
    if form == PSM:
        parts = (PREFIX.encode(), prefix, SUFFIX.encode(), suffix)
    else:
        parts = (SUFFIX.encode(), suffix, PREFIX.encode(), prefix)
    output = b"".join((*parts, MIDDLE.encode(), middle))
    return units.count, form, units.chars(0, first), units.chars(first, second), output


def draws_of(seed: int, doc_id) -> tuple[int, ...]:
    """Four 32-bit numbers that follow from the seed and the id."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def fill_in_middle(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    unit: str = "line",
    rate: int = 100,
    spm: int = 50,
    seed: int = 7,
) -> DataFrame:
    """One row per document row: id, units, form, part lengths and the rewritten ``output``.

    ``unit`` is ``line``, ``word`` or ``char``; ``rate`` and ``spm`` are percentages of texts
    rewritten and, of those, with the suffix first.
    """
    if unit != "char" and unit not in ENDS:
        raise ValueError(f"unknown unit {unit!r}")

    def of(rows):
        for row in rows:
            draws = draws_of(seed, row["doc_id"])
            yield row["doc_id"], *rewritten(row["data"], draws, unit, rate, spm)

    docs = documents.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("data"))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary"
    done = map_rows(docs, schema, of, "data")
    return done.withColumn("output", F.col("output").cast("string"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of.

    No part holds a marker, and a marker's first character occurs in it only once, so each
    marker's first occurrence in the output is the one that was put there.
    """
    whole, kind = F.col(output), F.col(form)
    body = F.substr(whole, F.lit(len(PREFIX) + 1))
    head = F.substring_index(body, MIDDLE, 1)
    middle = F.substring_index(body, MIDDLE, -1)
    psm = F.concat(F.substring_index(head, SUFFIX, 1), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, F.substring_index(head, PREFIX, 1))
    return F.when(kind == PSM, psm).when(kind == SPM, spm).otherwise(whole)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the digest columns of rewriting ``documents`` line by line."""
    done = fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda column: F.sha2(column.cast("binary"), 256)
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored()).alias("restored_sha256"),
    )


ORACLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), numbers AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS c1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM drawn
), parts AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1 : least(c1, c2)], '') AS prefix,
         array_to_string(units[least(c1, c2) + 1 : greatest(c1, c2)], '') AS middle,
         array_to_string(units[greatest(c1, c2) + 1 :], '') AS suffix
  FROM numbers
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(coalesce(prefix, '')) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(coalesce(middle, '')) AS BIGINT) END AS middle_chars,
       sha256(CASE form
         WHEN 'psm' THEN '<P>' || coalesce(prefix, '') || '<S>' || coalesce(suffix, '') || '<M>' || coalesce(middle, '')
         WHEN 'spm' THEN '<S>' || coalesce(suffix, '') || '<P>' || coalesce(prefix, '') || '<M>' || coalesce(middle, '')
         ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
