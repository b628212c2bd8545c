"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are dealt into row blocks, queries into query blocks; a row block meets every query block
(a stated query set against all rows, in blocks). The dimensions are cut into ``LISTS`` lists.

1. Each pair of blocks gathers, for each list, its k best partial scores for each query, with the
   total score of the entries found. The k-th best total over all blocks is the query's cutoff.
2. The cutoff is sent back with the query block. A vector whose partial scores all lie below
   cutoff / LISTS has a total below the cutoff, so only entries at or above that uniform
   threshold in some list are collected.
3. The totals of what was collected are resolved exactly, and the k best remain.

Partial scores may be negative: the bound needs no sign. Totals are exact integers. Defined results:
vectors that are null, or hold null or non-finite components, take no part; shorter vectors count
as padded by noughts; empty vectors score 0; every row is a candidate of its own, also where ids
repeat, but a query never meets a row of its own id; ties go to the smaller id; a null id takes no part.
Floored components beyond 2**31 raise an error rather than round.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship, table

K = 5
LISTS = 2
#: Rows of a row block and queries of a query block.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 512
#: Copies of each query block, so that one block's work spreads over many tasks.
SPREAD = 64


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Ids and floor(256 * x) of the vectors that take part."""
    good = F.forall(
        embedding,
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & good).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(embedding, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"),
    )


def _matrix(vectors) -> np.ndarray:
    """Vectors as rows of one matrix, padded by noughts."""
    matrix = np.zeros((len(vectors), max([len(v) for v in vectors], default=0)), np.int32)
    for i, v in enumerate(vectors):
        v = np.asarray(v, np.int64)
        if len(v) and np.abs(v).max() >= 1 << 31:
            raise ValueError("a component is beyond 32 bits")
        matrix[i, : len(v)] = v
    return matrix


def _row_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of whole vectors; a block is one row."""

    def run(batches):
        for frame in batches:
            for start in range(0, len(frame), BLOCK_ROWS):
                part = frame.iloc[start : start + BLOCK_ROWS]
                matrix = _matrix(list(part["v"]))
                yield pd.DataFrame(
                    {
                        "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                        "width": [matrix.shape[1]],
                        "matrix": [matrix.tobytes()],
                    }
                )

    return rows.mapInPandas(run, "ids binary, width int, matrix binary")


def _unpacked(ids: bytes, width: int, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, np.int64)
    return names, np.frombuffer(matrix, np.int32).reshape(len(names), width).astype(np.float64)


def _partials(block: dict, lists: int):
    """Ids of rows and queries, and the partial scores of each list."""
    ids, rows = _unpacked(block["ids"], block["width"], block["matrix"])
    names, queries = _unpacked(block["q_ids"], block["q_width"], block["q_matrix"])
    width = min(rows.shape[1], queries.shape[1])
    cuts = np.linspace(0, width, lists + 1).astype(int)
    top = max(1.0, np.abs(rows).max(initial=0)) * max(1.0, np.abs(queries).max(initial=0))
    kind = np.float64 if top * max(1, width) < 2**53 else object
    if kind is object:
        rows, queries = (x.astype(np.int64).astype(object) for x in (rows, queries))
    parts = [queries[:, a:b] @ rows[:, a:b].T for a, b in zip(cuts, cuts[1:])]
    own = names[:, None] == ids[None, :]
    return ids, names, parts, own


def _blocks_of(frames):
    for frame in frames:
        yield from frame.to_dict("records")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near].astype(np.float64)))][:k]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["query_id", "copy", "vec_id", "place", "score"])


_FOUND = "query_id long, copy int, vec_id long, place int, score long"


def _first_lists(k: int, lists: int):
    """Phase 1: the k best of each local list, with total scores, each row once a query."""

    def run(frames):
        for block in _blocks_of(frames):
            ids, names, parts, own = _partials(block, lists)
            total, out = sum(parts), []
            for i, name in enumerate(names):
                other = np.flatnonzero(~own[i])
                chosen = set()
                for part in parts:
                    chosen.update(other[_best(part[i, other], ids[other], k)].tolist())
                out += [(name, i, ids[j], j, int(total[i, j])) for j in sorted(chosen)]
            if out:
                yield _frame(out)

    return run


def _above(lists: int):
    """Phases 2 and 3: entries at or above the uniform threshold, resolved to total scores."""

    def run(frames):
        for block in _blocks_of(frames):
            ids, names, parts, own = _partials(block, lists)
            known = dict(zip(block["cut_ids"], block["cut_scores"]))
            cut = np.array([known.get(n, -math.inf) for n in names], np.float64)
            near = np.zeros(own.shape, bool)
            for part in parts:
                near |= part.astype(np.float64) * lists >= cut[:, None]
            total = sum(parts)
            near &= ~own & (total.astype(np.float64) >= cut[:, None])
            where = np.argwhere(near)
            for start in range(0, len(where), 50_000):
                yield _frame(
                    [
                        (names[i], i, ids[j], j, int(total[i, j]))
                        for i, j in where[start : start + 50_000]
                    ]
                )

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    lists: int = LISTS,
) -> DataFrame:
    """Each query's k best rows by inner product: query_id, rank, vec_id, score."""
    ship(vectors.sparkSession)
    rows = integer_vectors(vectors, vec_id, embedding)
    asked = integer_vectors(queries, vec_id, embedding).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    block_of = lambda c: F.pmod(F.xxhash64(c), F.lit(n_blocks)).cast("int")
    spread = F.explode(F.expr(f"sequence(0, {SPREAD - 1})"))
    packed = _query_blocks(
        asked.groupBy(block_of("vec_id").alias("q_block")).agg(
            F.sort_array(F.collect_list(F.struct("vec_id", "v"))).alias("all")
        )
    ).select("*", spread.alias("spread"))
    row_blocks = _row_blocks(rows).select(
        "*",
        F.pmod(F.xxhash64("ids"), F.lit(SPREAD)).cast("int").alias("spread"),
        F.explode(F.expr(f"sequence(0, {n_blocks - 1})")).alias("q_block"),
    )
    met = row_blocks.join(packed, ["q_block", "spread"])
    first = met.mapInPandas(_first_lists(k, lists), _FOUND)
    cutoffs = _ranked(first, k).where(F.col("rank") == k).select("query_id", "score")
    known = (
        cutoffs.groupBy(block_of("query_id").alias("q_block"))
        .agg(F.collect_list(F.struct("query_id", "score")).alias("cuts"))
        .select(
            "q_block",
            F.col("cuts.query_id").alias("cut_ids"),
            F.col("cuts.score").alias("cut_scores"),
        )
    )
    bounded = packed.join(known, "q_block", "left").withColumns(
        {c: F.coalesce(c, F.expr("array()").cast("array<bigint>")) for c in ("cut_ids", "cut_scores")}
    )
    collected = row_blocks.join(bounded, ["q_block", "spread"]).mapInPandas(_above(lists), _FOUND)
    return _ranked(collected, k).select("query_id", "rank", "vec_id", "score")


def _query_blocks(grouped: DataFrame) -> DataFrame:
    def run(frames):
        for block in _blocks_of(frames):
            matrix = _matrix([r["v"] for r in block["all"]])
            ids = np.array([r["vec_id"] for r in block["all"]], np.int64)
            yield pd.DataFrame(
                {
                    "q_block": [block["q_block"]],
                    "q_ids": [ids.tobytes()],
                    "q_width": [matrix.shape[1]],
                    "q_matrix": [matrix.tobytes()],
                }
            )

    return grouped.mapInPandas(run, "q_block int, q_ids binary, q_width int, q_matrix binary")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "place")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the 5 best rows for every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH parts AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
