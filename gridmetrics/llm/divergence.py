"""How far sources of a language diverge in their terms, by late materialisation of strings.

A first pass over the texts decides each language's vocabulary on fixed-width term digests alone:
tasks count documents by (language, term) and shuffle digests and numbers. A bitmap of the digests
that stay, sized by their number, goes to the second pass, which counts by (language, source) and
drops terms nobody keeps inside the task; what the bitmap lets through in vain an exact join removes.
Beside its counts a task names each (digest, term) once, and the least and the greatest string of a
digest differ exactly where two terms collide. Such a digest is split into pieces, one a term,
counted by a pass of their own. Term ids are (digest, piece), so nothing depends on collisions being
rare. Text is joined back to the few output rows that name terms.

Every shuffle on a term, group or language has been summed inside tasks before. Pairs of sources
are compared in blocks: sources of a language are numbered and cut into blocks of ``BLOCK``, terms
into chunks of about ``CHUNK``, and one step holds a matrix of two blocks by one chunk.

All arithmetic is on integers (decimals where a count times 10^9 may pass 63 bits).

Defined results: null text, language and source count as ''; a group without terms has count 0 for
every kept term; a language without kept terms has V = 0 and pair values 0; repeated rows are
separate documents; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import STEP_BYTES, _arrow_schema, _batch, ship, stored, table, text_bytes, word_table

LEAST_DOCUMENTS = 30
TOP = 50
SCALE = 1_000_000_000
#: Sources and terms that one step compares at once: 2 * BLOCK * CHUNK numbers of eight bytes.
BLOCK, CHUNK = 64, 4096
#: Distinct (group, term) counts a task holds before it hands them on.
HELD = 400_000
#: Bytes of text whose terms a task tells apart at a time.
LONG = 32 << 20

_LETTERS = word_table(b"abcdefghijklmnopqrstuvwxyz")
_DOCS = "lang string, digest long, docs long"
_COUNTS = "lang string, source string, digest long, n long, term binary"
#: Bits a kept digest has in the bitmap, and the most bits in all (32 MB).
_BITS_EACH, _MOST_BITS = 16, 1 << 28


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """Lists of the terms of a text, a few megabytes at a time."""
    data, at = data.translate(_LETTERS), 0
    while at < len(data):
        cut = data.find(b" ", at + STEP_BYTES)
        end = cut if cut >= 0 else len(data)
        yield data[at:end].split()
        at = end


def _shards(data: bytes) -> Iterator[Iterator[list[bytes]]]:
    """The terms of a text; those of a very long one in several passes, each with its own terms."""
    passes = 1 + len(data) // LONG
    for k in range(passes):
        if passes == 1:
            yield terms_of(data)
        else:
            yield ([w for w in words if crc32(w) % passes == k] for words in terms_of(data))


def digest_of(term: bytes, bits: int = 64) -> int:
    """The leading bits of a 64-bit hash, as a signed long."""
    value = xxhash.xxh3_64_intdigest(term) >> (64 - bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _texts(documents: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        text_bytes(text).alias("data"),
    )


def _pieces(texts: DataFrame, schema: str, run) -> DataFrame:
    """Map Arrow batches by ``run``, which yields lists of columns, into batches of bounded length."""
    ship(texts.sparkSession)
    names, types = _arrow_schema(texts.sparkSession, schema)

    def of(batches):
        for columns in run(batches):
            for at in range(0, len(columns[0]), 20_000):
                yield _batch([column[at : at + 20_000] for column in columns], names, types)

    return texts.mapInArrow(of, schema)


def _vocabulary(texts: DataFrame, least: int, bits: int) -> DataFrame:
    """(lang, digest) of the digests that at least ``least`` documents of the language hold."""

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, data in zip(batch["lang"].to_pylist(), batch["data"]):
                for shard in _shards(data.as_py()):
                    docs, seen = held.setdefault(lang, Counter()), set()
                    for words in shard:
                        seen.update(words)
                    before = len(docs)
                    docs.update(seen)
                    size += len(docs) - before
                    if size >= HELD:
                        yield from flushed(held)
                        held, size = {}, 0
        yield from flushed(held)

    def flushed(held):
        for lang, docs in held.items():
            yield [lang] * len(docs), [digest_of(term, bits) for term in docs], list(docs.values())

    docs = _pieces(texts, _DOCS, run).groupBy("lang", "digest").agg(F.sum("docs").alias("docs"))
    return docs.where(F.col("docs") >= least).select("lang", "digest")


def _bitmap(digests: DataFrame) -> np.ndarray:
    """A bit for each digest; its size follows their number and is bounded."""
    size = min(_MOST_BITS, max(1 << 15, 1 << (digests.count() * _BITS_EACH).bit_length()))
    spot = F.pmod("digest", F.lit(size))
    parts = digests.groupBy(F.floor(spot / 32768).cast("int").alias("part")).agg(
        F.bitmap_construct_agg((spot % 32768).cast("int")).alias("bits")
    )
    out = np.zeros(size // 8, np.uint8)
    for r in parts.collect():
        out[r.part * 4096 : (r.part + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _counts(texts: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """Occurrences by (lang, source, digest), summed inside tasks, of digests that may be wanted.

    One row a task and (digest, term) has the term.
    """
    bitmap = texts.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches):
        marks, held, digests, size, room = bitmap.value, {}, {}, 0, HELD
        named = set()
        for batch in batches:
            keys = zip(batch["lang"].to_pylist(), batch["source"].to_pylist())
            for key, data in zip(keys, batch["data"]):
                n = held.setdefault(key, Counter())
                for words in terms_of(data.as_py()):
                    before = len(n)
                    n.update(words)
                    size += len(n) - before
                    if size >= room:
                        # Terms nobody keeps go; the rest stays until it fills the room itself.
                        for counter in held.values():
                            _drop_others(counter, digests, marks, bits)
                        size = sum(map(len, held.values()))
                        room = HELD + size
                        if size >= HELD:
                            yield from flushed(held, digests, named)
                            held, digests, size, room = {}, {}, 0, HELD
                            n = held.setdefault(key, Counter())
        for counter in held.values():
            _drop_others(counter, digests, marks, bits)
        yield from flushed(held, digests, named)

    def flushed(held, digests, named):
        for (lang, source), n in held.items():
            terms = [None if term in named else term for term in n]
            named.update(n)
            yield [lang] * len(n), [source] * len(n), [digests[t] for t in n], list(n.values()), terms

    return _pieces(texts, _COUNTS, run)


def _drop_others(counter: Counter, digests: dict[bytes, int], marks: np.ndarray, bits: int) -> None:
    """Leave only terms whose digest is marked; ``digests`` remembers those found so far."""
    unknown = [term for term in counter if term not in digests]
    found = np.fromiter((digest_of(t, bits) for t in unknown), np.int64, len(unknown))
    spots = np.mod(found, 8 * len(marks))
    marked = marks[spots >> 3] >> (spots & 7).astype(np.uint8) & 1 == 1
    for term, digest, keep in zip(unknown, found.tolist(), marked.tolist()):
        if keep:
            digests[term] = digest
        else:
            del counter[term]


def _by_string(texts: DataFrame, collided: DataFrame, bits: int) -> DataFrame:
    """Documents and occurrences by (lang, source, digest, term) of terms whose digest may have collided."""
    bitmap = texts.sparkSession.sparkContext.broadcast(_bitmap(collided))

    def run(batches):
        for batch in batches:
            keys = zip(batch["lang"].to_pylist(), batch["source"].to_pylist())
            for (lang, source), data in zip(keys, batch["data"]):
                for shard in _shards(data.as_py()):
                    n, digests = Counter(), {}
                    for words in shard:
                        n.update(words)
                    _drop_others(n, digests, bitmap.value, bits)
                    size = len(n)
                    yield [lang] * size, [source] * size, [digests[t] for t in n], list(n.values()), list(n)

    return _pieces(texts, _COUNTS, run).join(collided, "digest", "left_semi").withColumn("docs", F.lit(1))


def _split(texts: DataFrame, least: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Counts of kept terms by (lang, source, digest, piece), and the text of every (digest, piece)."""
    group, key = ["lang", "source"], ["lang", "digest"]
    kept = stored(_vocabulary(texts, least, bits))
    wanted = kept.select("digest").distinct()
    counted = stored(_counts(texts, wanted, bits))
    plain = counted.select(*group, "digest", "n").join(kept, key, "left_semi")
    plain = plain.groupBy(*group, "digest").agg(F.sum("n").alias("n"))

    named = counted.select("digest", "term").where(F.col("term").isNotNull())
    extremes = stored(
        named.join(wanted, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("term").alias("least"), F.max("term").alias("greatest"))
    )
    single = extremes.where(F.col("least") == F.col("greatest"))
    terms = single.select("digest", F.lit(0).alias("piece"), F.col("least").alias("term"))
    collided = extremes.where(F.col("least") != F.col("greatest")).select("digest")
    if collided.isEmpty():
        return plain.select(*group, "digest", F.lit(0).alias("piece"), "n"), terms

    # Collided digests are counted again by their strings, numbered from 1.
    alone = plain.join(collided, "digest", "left_anti").select(*group, "digest", F.lit(0).alias("piece"), "n")
    apart = stored(_by_string(texts, collided, bits))
    sums = apart.groupBy(*group, "digest", "term").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    numbered = apart.select("digest", "term").distinct().withColumn("piece", place)
    enough = apart.groupBy("lang", "digest", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
    pieces = sums.join(enough, ["lang", "digest", "term"], "left_semi").join(numbered, ["digest", "term"])
    return (
        alone.unionByName(pieces.select(*group, "digest", "piece", "n")),
        terms.unionByName(numbered.select("digest", "piece", "term")),
    )


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 5) / (total + 5 * terms)), exactly."""
    wide = lambda c: c.cast("decimal(28,0)")
    top = (wide(n) + wide(F.lit(5))) * F.lit(SCALE).cast("decimal(10,0)")
    bottom = wide(total) + wide(F.lit(5)) * terms.cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", top, F.greatest(bottom, wide(F.lit(1))))


def divergence(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP,
    bits: int = 64,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of both parts.

    ``pair``: every other source of the language, by the summed difference of term shares.
    ``term``: the ``top`` terms a source uses more than its language does. ``bits`` narrows the
    digests; results do not depend on it.
    """
    rows = _texts(documents, text, lang, source)
    counts, texts = _split(rows, least_documents, bits)
    counts = stored(counts)

    named = rows.select("lang", "source").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    overall = counts.groupBy("lang", "digest", "piece").agg(F.sum("n").alias("all"))
    langs = overall.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("all").alias("lang_total")
    )
    groups = stored(
        named.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")])
    )
    shares = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "digest", "piece", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p")
    )
    return _terms(shares, overall, langs, texts, top).unionByName(_pairs(shares, groups))


def _terms(shares: DataFrame, overall: DataFrame, langs: DataFrame, texts: DataFrame, top: int) -> DataFrame:
    q = overall.join(langs, "lang").select(
        "lang", "digest", "piece", _share(F.col("all"), F.col("lang_total"), F.col("terms")).alias("q")
    )
    higher = shares.join(q, ["lang", "digest", "piece"]).where("p > q")
    valued = higher.select("lang", "source", "digest", "piece", (F.col("p") - F.col("q")).alias("value"))
    # By value alone first, all ties kept: the text that orders ties is joined to these rows only.
    group = Window.partitionBy("lang", "source")
    best = valued.withColumn("rank", F.rank().over(group.orderBy(F.desc("value"))))
    best = best.where(F.col("rank") <= top).join(texts, ["digest", "piece"])
    order = F.row_number().over(group.orderBy(F.desc("value"), "term"))
    ranked = best.withColumn("rank", order).where(F.col("rank") <= top)
    return ranked.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank"
    )


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with its summed difference of shares."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    blocks = F.ceil(F.count("*").over(Window.partitionBy("lang")) / BLOCK)
    chunks = F.floor(F.col("terms") / CHUNK) + 1
    numbered = groups.select(
        "lang", "source", "terms", place.alias("place"),
        blocks.cast("int").alias("blocks"), chunks.cast("int").alias("chunks"),
        _share(F.lit(0), F.col("total"), F.col("terms")).alias("absent"),
    )
    numbered = stored(numbered.withColumn("block", F.col("place") % F.col("blocks")))
    # A row goes to every pair of blocks (i <= j) that holds its own block.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = lambda rows: rows.withColumn("other", other).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
    )
    sources = numbered.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = spread(sources).select(
        "lang", "i", "j", "chunk", "block", "place", F.lit(None).cast("long").alias("digest"),
        F.lit(0).alias("piece"), F.col("absent").alias("p"),
    )
    chunk = F.pmod(F.xxhash64("digest", "piece"), "chunks").cast("int")
    values = spread(shares.join(numbered, ["lang", "source"]).withColumn("chunk", chunk)).select(
        "lang", "i", "j", "chunk", "block", "place", "digest", "piece", "p"
    )
    partial = members.unionByName(values).groupBy("lang", "i", "j", "chunk").applyInArrow(
        _differences, "lang string, a int, b int, seen long, value long"
    )
    summed = partial.groupBy("lang", "a", "b").agg(F.sum("seen").alias("seen"), F.sum("value").alias("value"))
    directions = F.explode(F.array(_ordered("a", "b"), _ordered("b", "a")))
    both = summed.select("lang", directions.alias("x"), "seen", "value").select("lang", "x.*", "seen", "value")
    mine = numbered.select("lang", F.col("place").alias("a"), "source", "terms", F.col("absent").alias("p"))
    theirs = numbered.select(
        "lang", F.col("place").alias("b"), F.col("source").alias("item"), F.col("absent").alias("q")
    )
    unseen = (F.col("terms") - F.col("seen")) * F.abs(F.col("p") - F.col("q"))
    valued = both.join(mine, ["lang", "a"]).join(theirs, ["lang", "b"]).select(
        "lang", "source", "item", (F.col("value") + unseen).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def _ordered(a: str, b: str) -> Column:
    return F.struct(F.col(a).alias("a"), F.col(b).alias("b"))


def _differences(step: pa.Table) -> pa.Table:
    """Summed differences of the pairs between two blocks (or within one), over one chunk of terms.

    Rows without a digest give a source's share of absent terms. ``seen`` counts the terms that
    occur in any of these sources; for all others every source has its absent share.
    """
    member = step["digest"].is_null().to_numpy()
    place, block, p = (step[name].to_numpy() for name in ("place", "block", "p"))
    order = np.argsort(place[member])
    places, blocks, absent = (x[member][order] for x in (place, block, p))
    keys = np.empty(int((~member).sum()), [("digest", np.int64), ("piece", np.int64)])
    for name in keys.dtype.names:
        keys[name] = step[name].filter(pa.array(~member)).to_numpy()
    terms, at = np.unique(keys, return_inverse=True)
    matrix = np.repeat(absent[:, None], len(terms), axis=1)
    matrix[np.searchsorted(places, place[~member]), at] = p[~member]
    within = step["i"][0].as_py() == step["j"][0].as_py()
    left, right, value = [], [], []
    for k in range(len(places)):
        others = np.arange(k + 1, len(places))
        others = others if within else others[blocks[others] != blocks[k]]
        left.append(np.full(len(others), places[k]))
        right.append(places[others])
        value.append(np.abs(matrix[others] - matrix[k]).sum(axis=1))
    a, b, total = (np.concatenate(x) for x in (left, right, value))
    return pa.table(
        {
            "lang": pa.array([step["lang"][0].as_py()] * len(a), pa.string()),
            "a": pa.array(a, pa.int32()),
            "b": pa.array(b, pa.int32()),
            "seen": pa.array(np.full(len(a), len(terms)), pa.int64()),
            "value": pa.array(total, pa.int64()),
        }
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the audit of ``documents``."""
    return divergence(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), counted AS (
  SELECT r, lang, source, t, count(*) AS n
  FROM (SELECT r, lang, source, unnest(w) AS t FROM docs) GROUP BY r, lang, source, t
), kept AS (
  SELECT lang, t, CAST(sum(n) AS HUGEINT) AS n FROM counted GROUP BY lang, t HAVING count(*) >= 30
), vocabulary AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY lang
), by_source AS (
  SELECT c.lang, c.source, c.t, CAST(sum(c.n) AS HUGEINT) AS n
  FROM counted c JOIN kept k ON c.lang = k.lang AND c.t = k.t GROUP BY c.lang, c.source, c.t
), groups AS (
  SELECT g.lang, g.source, CAST(coalesce(sum(b.n), 0) AS HUGEINT) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN by_source b ON g.lang = b.lang AND g.source = b.source GROUP BY g.lang, g.source
), shares AS (
  SELECT g.lang, g.source, k.t, coalesce(b.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(b.n, 0) + 5)) // (g.total + 5 * v.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n + 5)) // (v.total + 5 * v.v) AS q
  FROM groups g JOIN vocabulary v ON g.lang = v.lang JOIN kept k ON g.lang = k.lang
  LEFT JOIN by_source b ON b.lang = g.lang AND b.source = g.source AND b.t = k.t
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS f
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), every AS (
  SELECT * FROM pairs
  UNION ALL
  SELECT lang, source, 'term', t, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS k FROM every
)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(k AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR k <= 50
"""
