"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is words. Windows of equal length share one set of tables: a shift table over
blocks of words tells how far a position can jump because no window has its block that near the
end; where the shift is nought, the bucket of the window's last block names test strings, and a
direct comparison confirms the occurrence.

Windows are dealt by hash into chunks of bounded size, so what a task holds does not grow with the
benchmark; every document is searched against every chunk. Rows are joined again by id and digest.

Defined results: null or wordless text has no words and no hits; an item of fewer than 13 words is
one window; wordless items have none; a null ``item_id`` is written as empty text; repeated rows
give repeated rows; columns besides id and text are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, map_rows, table, text_bytes

WINDOW = 13
#: (window, item) pairs and bytes of windows that one chunk holds on average at most.
CHUNK_PAIRS, CHUNK_BYTES = 100_000, 32 << 20


def words_of(data: bytes) -> list[bytes]:
    """Words of 0-9, A-Z (lowered), a-z and everything beyond ASCII."""
    return data.translate(ALNUM).split()


class Matcher:
    """Shift and suffix tables for windows of one length."""

    def __init__(self, patterns: dict[tuple, list[str]], block: int = 3) -> None:
        self.length = m = len(next(iter(patterns)))
        self.block = b = min(block, m)
        self.default = m - b + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[str]]] = {}
        for pattern, items in patterns.items():
            for end in range(b, m + 1):
                key = pattern[end - b : end]
                self.shift[key] = min(self.shift.get(key, self.default), m - end)
            self.buckets.setdefault(pattern[m - b :], {})[pattern] = items

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Starts of the occurrences, with the items they belong to."""
        m, b, default = self.length, self.block, self.default
        shift, end, n = self.shift.get, self.length, len(words)
        while end <= n:
            key = tuple(words[end - b : end])
            jump = shift(key, default)
            if jump:
                end += jump
                continue
            items = self.buckets[key].get(tuple(words[end - m : end]))
            if items is not None:
                yield end - m, items
            end += 1


def matchers(pairs: Iterable[tuple[bytes, str]]) -> list[Matcher]:
    """One matcher for each window length."""
    by_length: dict[int, dict[tuple, list[str]]] = {}
    for window, item in pairs:
        pattern = tuple(window.split(b" "))
        by_length.setdefault(len(pattern), {}).setdefault(pattern, []).append(item)
    return [Matcher(patterns) for _, patterns in sorted(by_length.items())]


def search(words: list[bytes], tables: list[Matcher]) -> tuple[list[int], set[str]]:
    """Positions of the words inside occurrences, ascending, and the items that occur."""
    spans, items = [], set()
    for matcher in tables:
        for start, found in matcher.find(words):
            spans.append((start, start + matcher.length))
            items.update(found)
    hit, done = [], 0
    for start, end in sorted(spans):
        hit.extend(range(max(start, done), end))
        done = max(done, end)
    return hit, items


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window, item) pairs: words of each window joined by one blank, distinct."""

    def of(rows):
        for row in rows:
            words = words_of(row["data"])
            for start in range(max(1, len(words) - WINDOW + 1) if words else 0):
                yield b" ".join(words[start : start + WINDOW]), row["item"]

    named = benchmark.select(
        text_bytes(text).alias("data"),
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
    )
    return map_rows(named, "window binary, item string", of, "data").distinct()


_CACHE: dict[str, list[Matcher]] = {}


def _tables(broadcast) -> list[Matcher]:
    """A worker keeps the tables of the chunk it searches, and no other."""
    if broadcast.value[0] not in _CACHE:
        _CACHE.clear()
        _CACHE[broadcast.value[0]] = matchers(broadcast.value[1])
    return _CACHE[broadcast.value[0]]


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    threshold: tuple[int, int] = (1, 20),
) -> DataFrame:
    """One row per document row: words, hit words, items that occur, and the verdict.

    ``threshold`` is the least share of hit words, as (numerator, denominator).
    """
    spark = documents.sparkSession
    pairs = windows(benchmark, item_id, text).withColumn(
        "chunk_key", F.xxhash64("window", "item")
    )
    pairs = pairs.persist()
    size = pairs.agg(F.count("*").alias("n"), F.sum(F.length("window")).alias("b")).first()
    chunks = max(1, math.ceil(size.n / CHUNK_PAIRS), math.ceil((size.b or 0) / CHUNK_BYTES))
    docs = documents.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("data"))
    found = None
    for chunk in range(chunks):
        mine = pairs.where(F.pmod("chunk_key", F.lit(chunks)) == chunk)
        held = [(bytes(r.window), r.item) for r in mine.select("window", "item").collect()]
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, held))
        part = _searched(docs, shared)
        found = part if found is None else found.unionAll(part)
    pairs.unpersist()
    merged = found.groupBy("doc_id", "digest", "n_words").agg(
        F.count("*").alias("rows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"),
    )
    share, whole = threshold
    return merged.withColumn(
        "copy", F.explode(F.array_repeat(F.lit(1), (F.col("rows") / chunks).cast("int")))
    ).select(
        "doc_id",
        "n_words",
        "n_hit",
        "item_ids",
        ((F.col("n_hit") > 0) & (whole * F.col("n_hit") >= share * F.col("n_words"))).alias(
            "contaminated"
        ),
        F.col("digest").alias("text_digest"),
    )


def _searched(docs: DataFrame, shared) -> DataFrame:
    import hashlib

    def of(rows):
        tables = _tables(shared)
        for row in rows:
            words = words_of(row["data"])
            hit, items = search(words, tables)
            digest = hashlib.md5(row["data"]).hexdigest()
            yield row["doc_id"], digest, len(words), hit, sorted(items)

    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, digest string, n_words long, hit array<int>, items array<string>"
    )
    return map_rows(docs, schema, of, "data")


def clean(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``documents``, all columns as they are, that are not contaminated.

    Rows are met by id and text digest: equal rows have equal verdicts.
    """
    bad = decontaminate(documents, benchmark, doc_id, text).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_digest")).distinct()
    rows = documents.select(F.struct("*").alias("row")).withColumn(
        "_digest", F.md5(F.coalesce(F.col("row")[text], F.lit("")))
    )
    same = F.col("row")[doc_id].eqNullSafe(F.col("_id")) & (rows["_digest"] == bad["_digest"])
    return rows.join(bad, same, "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the digest columns of decontaminating ``documents`` by ``benchmark``."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sizes AS (
  SELECT DISTINCT least(13, len(w)) AS m FROM items WHERE len(w) > 0
), patterns AS (
  SELECT DISTINCT item, least(13, len(w)) AS m,
         array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS window_text
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s
        FROM items WHERE len(w) > 0)
), doc_windows AS (
  SELECT row_no, m, s, array_to_string(w[s : s + m - 1], ' ') AS window_text
  FROM (SELECT row_no, w, m, unnest(range(1, len(w) - m + 2)) AS s
        FROM words, sizes WHERE len(w) >= m)
), occurrences AS (
  SELECT row_no, d.s, d.m, item FROM doc_windows d JOIN patterns USING (m, window_text)
), hits AS (
  SELECT row_no, count(DISTINCT p) AS n_hit
  FROM (SELECT row_no, unnest(range(s, s + m)) AS p FROM occurrences) GROUP BY row_no
), found AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT row_no, item FROM occurrences) GROUP BY row_no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hits USING (row_no) LEFT JOIN found USING (row_no)
"""
