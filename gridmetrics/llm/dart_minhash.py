"""Near-duplicate documents by DartMinHash and a banded join.

A document is the weighted set of its runs of five words; a run's weight is how often it occurs. Each
unit of weight of an element is a strip of the plane (weight, rank). Darts are thrown into strips by
hashing: a strip is cut into cells of doubling rank, the number of darts in a cell is Poisson with
the cell's area, and each dart names a coordinate and a rank. The earliest dart of each coordinate
is the signature; two signatures agree in a coordinate with the probability of the weighted Jaccard
similarity. Cells are opened only until every coordinate is hit, so a document of any length costs about
``COORDINATES * ln(COORDINATES)`` darts.

Documents with the same word sequence are one node before anything is joined. Coordinates are
banded; nodes that share a band's key meet in a bucket. Candidates are verified on the exact weighted sets:

1. in buckets of up to ``LARGE`` nodes each pair, in larger ones each node against the least one. Pairs whose
   signatures agree in less than ``AGREE`` of the coordinates are dropped before any text is read; a
   pair of similarity 0.8 falls there with probability 2e-6.
2. large buckets that still hold several classes, in pairs of blocks of bounded size: a task gets two
   blocks, compares all their nodes and returns only links that join classes, so no list of pairs
   exists anywhere; two blocks of one class are not compared.

So no pair that shares a bucket is left out unless both are in one class already. Classes are connected
components of verified links.

Defined results: null, empty and wordless texts have no words and are copies of one another; texts of one
to four words make one run; the class id is the least ``doc_id`` of the class (null only if all are
null); of repeated rows one is kept; other columns go along untouched whatever their names.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, hash_words, map_rows, mix, shingles, signed, stored, table, text_bytes
from .components import components

WORDS, SIMILARITY = 5, 0.8
#: 24 bands of 5: a pair of similarity 0.8 shares none with probability 7e-5.
BANDS, BAND = 24, 5
COORDINATES = BANDS * BAND
#: Least agreement of signatures at which texts are compared.
AGREE = 0.62
#: Nodes of a bucket beyond which it is compared in blocks, and nodes of a block.
LARGE, BLOCK = 16, 128
_BITS = 1 << 25
_FIRST_CELL = 2.0**-8
_STRIPS = 1 << 18


def strips(data: bytes, size: int = WORDS) -> np.ndarray:
    """Ids of the units of weight of a text's runs, distinct and sorted by run."""
    runs = np.sort(shingles(hash_words(data.translate(ALNUM)), size))
    n = len(runs)
    first = np.ones(n, bool)
    first[1:] = runs[1:] != runs[:-1]
    starts = np.flatnonzero(first)
    layer = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    return mix(runs + layer.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _poisson(area: float) -> np.ndarray:
    """Distribution function of the number of darts in a cell, as far as doubles tell."""
    k = np.arange(int(area + 12 * math.sqrt(area) + 24))
    logs = k * math.log(area) - area - np.array([math.lgamma(i + 1) for i in k])
    return np.cumsum(np.exp(logs))


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """The earliest dart of each coordinate of each non-empty set of strips."""
    out = np.zeros((len(sets), coordinates), np.uint64)
    start = 0
    while start < len(sets):
        end, held = start, 0
        while end < len(sets) and (end == start or held + len(sets[end]) <= _STRIPS):
            held += len(sets[end])
            end += 1
        out[start:end] = _signatures(sets[start:end], coordinates)
        start = end
    return out


def _signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    ids = np.concatenate(sets)
    value = np.zeros(len(sets) * coordinates, np.uint64)
    hit = np.zeros(len(sets) * coordinates, bool)
    low, width, level = 0.0, _FIRST_CELL, 0
    while len(ids):
        seeds = mix(ids + np.uint64((level + 1) * 0xA0761D6478BD642F & (1 << 64) - 1))
        chance = (seeds >> np.uint64(11)).astype(np.float64) * 2.0**-53
        count = np.searchsorted(_poisson(width), chance, side="right")
        some = np.flatnonzero(count)
        darts, owners = [], []
        for t in range(int(count.max(initial=0))):
            some = some[count[some] > t]
            darts.append(mix(seeds[some] + np.uint64((t + 1) * 0xE7037ED1A0B428DB & (1 << 64) - 1)))
            owners.append(owner[some])
        if darts:
            dart, of = np.concatenate(darts), np.concatenate(owners)
            place = of * coordinates + (dart % np.uint64(coordinates)).astype(np.int64)
            # A coordinate hit in an earlier cell has an earlier dart than any of this cell's.
            new = ~hit[place]
            dart, place = dart[new], place[new]
            rank = mix(dart)
            order = np.lexsort((rank, place))
            place, first = np.unique(place[order], return_index=True)
            value[place] = dart[order][first]
            hit[place] = True
        open_sets = ~hit.reshape(len(sets), coordinates).all(1)
        alive = open_sets[owner]
        ids, owner = ids[alive], owner[alive]
        low, level = low + width, level + 1
        width = low  # cells double in rank
    return value.reshape(len(sets), coordinates)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = signature.reshape(len(signature), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(parts.shape[2]):
        key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + parts[:, :, j])
    return signed(key)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets of strips."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _sketched(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Each row with a number, its node digest and band keys, written once."""

    def of(rows):
        sets = [strips(r["data"]) for r in rows]
        full = [i for i, s in enumerate(sets) if len(s)]
        marks = signatures([sets[i] for i in full])
        found = dict(zip(full, band_keys(marks).tolist()))
        short = dict(zip(full, (m.tobytes() for m in (marks & np.uint64(0xFFFF)).astype(np.uint16))))
        for i, r in enumerate(rows):
            words = b" ".join(r["data"].translate(ALNUM).split())
            digest = hashlib.blake2b(words, digest_size=16).digest()
            yield r["row_no"], digest, found.get(i, []), short.get(i, b""), r["data"], r["doc_id"]

    kind = documents.schema[doc_id].dataType.simpleString()
    named = documents.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(doc_id).alias("doc_id"),
        text_bytes(text).alias("data"),
    )
    schema = f"row_no long, digest binary, keys array<long>, mark binary, data binary, doc_id {kind}"
    return map_rows(named, schema, of, "data")


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree enough to compare their texts."""

    def of(rows):
        for r in rows:
            a, b = (np.frombuffer(r[c], np.uint16) for c in ("mark_a", "mark"))
            if (a == b).mean() >= AGREE:
                yield r["a"], r["b"]

    marked = _joined(pairs, nodes.select("node", "mark"), "mark")
    return map_rows(marked, "a long, b long", of, "mark")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose weighted sets are at least ``least`` similar."""

    def of(rows):
        last, kept = None, None
        for r in rows:
            if r["a"] != last:
                last, kept = r["a"], strips(r["data_a"])
            if similarity(kept, strips(r["data"])) >= least:
                yield r["a"], r["b"]

    return map_rows(_joined(pairs, texts, "data"), "a long, b long", of, "data")


def likely_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the wanted nodes and of the few others that a bitmap of fixed size lets through; no shuffle of texts."""
    spot = F.pmod(F.xxhash64("node"), F.lit(_BITS))
    bits = wanted.groupBy(F.floor(spot / 32768).alias("part")).agg(
        F.bitmap_construct_agg((spot % 32768).cast("int")).alias("bits")
    )
    # _BITS / 8 bytes in all, whatever the number of nodes.
    named = rows.select(F.col("row_no").alias("node"), "data").withColumn("spot", spot)
    byte = F.expr("conv(hex(substring(bits, int(spot % 32768) div 8 + 1, 1)), 16, 10)").cast("int")
    return (
        named.withColumn("part", F.floor(F.col("spot") / 32768))
        .join(F.broadcast(bits), "part")
        .where(byte.bitwiseAND(F.expr("shiftleft(1, int(spot % 8))")) != 0)
        .select("node", "data")
    )


def texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the wanted nodes."""
    return likely_texts(rows, wanted).join(wanted, "node", "left_semi")


def _joined(pairs: DataFrame, of_node: DataFrame, value: str) -> DataFrame:
    left = of_node.select(F.col("node").alias("a"), F.col(value).alias(f"{value}_a"))
    right = of_node.select(F.col("node").alias("b"), value)
    return pairs.join(left, "a").join(right, "b")


def _common(sets: list[np.ndarray], n: int) -> np.ndarray:
    """Sizes of the intersections of the first n sets with the others."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    ids, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = uses[column] > 1
    owner, column = owner[several], column[several]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, len(sets) - n), np.float32)
    for start in range(0, int(column.max(initial=-1)) + 1, 4096):
        lo, hi = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[lo:hi], column[lo:hi] - start] = 1
        total += part[:n] @ part[n:].T
    return total


def _joining(rows_a: list[dict], rows_b: list[dict], least: float):
    """Links between nodes of two blocks that join classes; a few for each class, never all."""
    sets = [strips(r["data"]) for r in (*rows_a, *rows_b)]
    common = _common(sets, len(rows_a))
    size_a, size_b = (np.array([len(s) for s in x]) for x in (sets[: len(rows_a)], sets[len(rows_a) :]))
    linked = common >= least * (size_a[:, None] + size_b[None, :] - common) - 1e-6
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i, j in np.argwhere(linked):
        a, b = root(rows_a[i]["root"]), root(rows_b[j]["root"])
        if a != b:
            parent[a] = b
            yield rows_a[i]["node"], rows_b[j]["node"]


def _in_blocks(large: DataFrame, roots: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links that join classes within large buckets, found by pairs of blocks."""
    placed = _mixed(large, roots)
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("own"))
    sizes = sizes.withColumn("big", F.col("own") >= BLOCK)
    small = sizes.where("NOT big").groupBy("key").agg(F.sum("own").alias("few"))
    # A large class has blocks of its own; small classes share blocks. No block depends on order.
    number = F.when(
        F.col("big"), F.pmod(F.xxhash64("node"), F.ceil(F.col("own") / BLOCK))
    ).otherwise(F.pmod(F.xxhash64("root"), F.ceil(F.col("few") / BLOCK)))
    block = F.struct(F.when(F.col("big"), F.col("root")).alias("of"), number.alias("number"))
    dealt = (
        placed.join(sizes, ["key", "root"])
        .join(small, "key", "left")
        .select("key", "node", "root", block.alias("block"))
    )
    blocks = stored(
        dealt.join(texts, "node")
        .groupBy("key", "block")
        .agg(F.collect_list(F.struct("node", "root", "data")).alias("rows"))
    )
    names = blocks.select("key", "block")
    other = names.select("key", F.col("block").alias("other"))
    pairs = names.join(other, "key").where(
        "block <= other AND NOT (block.of IS NOT NULL AND other.of IS NOT NULL AND block.of = other.of)"
    )
    met = pairs.join(blocks, ["key", "block"]).join(
        blocks.select("key", F.col("block").alias("other"), F.col("rows").alias("others")),
        ["key", "other"],
    )

    def of(rows):
        for r in rows:
            yield from _joining(r["rows"], r["others"], least)

    named = met.select("rows", "others", F.lit(b"").alias("size"))
    return map_rows(named, "a long, b long", of, "size")


def classes(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """One line per row: row_no, doc_id, class_id, class_size, keep.

    ``keep`` marks one row of each class, that of the least id. ``row_no`` is a number the operator
    gives the row.
    """
    rows = stored(_sketched(documents, doc_id, text))
    nodes = stored(
        rows.groupBy("digest").agg(
            F.min("row_no").alias("node"),
            F.min("keys").alias("keys"),
            F.min("mark").alias("mark"),
        )
    )
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    leaders = (
        buckets.groupBy("key")
        .agg(F.min("node").alias("leader"), F.count("*").alias("n"))
        .where("n > 1")
    )
    members = stored(buckets.join(leaders, "key"))
    near = stored(_alike(_pairs(members), nodes))
    large = members.where(F.col("n") > LARGE)
    wanted = stored(
        large.select("node")
        .unionAll(near.select(F.col("a").alias("node")))
        .unionAll(near.select(F.col("b").alias("node")))
        .distinct()
    )
    texts = stored(texts_of(rows, wanted))
    links = stored(_verified(near, texts, least))
    links = stored(links.unionAll(_in_blocks(large, components(links), texts, least)))
    roots = components(links)
    named = (
        nodes.select("digest", "node")
        .join(roots, "node", "left")
        .select("digest", F.coalesce("root", "node").alias("root"))
    )
    labelled = stored(rows.select("row_no", "doc_id", "digest").join(named, "digest").drop("digest"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no")
    heads = labelled.groupBy("root").agg(
        F.min(order).alias("head"), F.count("*").alias("class_size")
    )
    return labelled.join(heads, "root").select(
        "row_no",
        "doc_id",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        (F.col("row_no") == F.col("head.row_no")).alias("keep"),
    )


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with their class so far, of buckets that hold several classes."""
    placed = members.select("key", "node").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    mixed = (
        placed.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("key")
    )
    return stored(placed.join(mixed, "key"))


def _pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b: all of small buckets, and those with the least node of large ones."""
    small = members.where(F.col("n") <= LARGE).select("key", "node")
    within = (
        small.select("key", F.col("node").alias("a"))
        .join(small.select("key", F.col("node").alias("b")), "key")
        .where("a < b")
        .select("a", "b")
    )
    star = members.where((F.col("n") > LARGE) & (F.col("node") != F.col("leader")))
    star = star.select(F.col("leader").alias("a"), F.col("node").alias("b"))
    return within.unionAll(star).distinct()


def first_of_each_class(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """The rows of ``documents``, all columns, that stand for their class."""
    numbered = documents.select(
        F.monotonically_increasing_id().alias("row_no"), F.struct("*").alias("row")
    )
    kept = classes(documents, doc_id, text, least).where("keep").select("row_no")
    return numbered.join(kept, "row_no", "left_semi").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the class of near-duplicates of every document."""
    return classes(table(spark, sf_dir, "documents")).drop("row_no")
