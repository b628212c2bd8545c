"""The corpus pipeline: stages over ``documents``, each calling one operator of ``gridmetrics.llm``.

A stage gets what its predecessor kept and returns a DataFrame; all but the last return the columns of
``documents``. Rows with null or empty texts pass toxicity (no evidence), meet as copies of one another in
the near-duplicate stage, and are not contaminated. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.llm import byte_bpe, dart_minhash, feistel, toxicity, wu_manber
from gridmetrics.llm.common import remainder, stored, table

#: The toxicity model learns from the labelled rows of the whole corpus that the query does not hold out.
_HELD_OUT = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score lies below the threshold."""
    corpus, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learned(corpus, labels, remainder("doc_id", 4) != _HELD_OUT)
    return toxicity.below_threshold(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return dart_minhash.first_of_each_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return wu_manber.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal values replaced."""
    return feistel.pseudonymise(docs, feistel.DEMO_KEY)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded bytes."""
    encoded = byte_bpe.encode_documents(docs, *byte_bpe.rank_file(), output="all")
    return encoded.drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("encoding", encode),
]

#: A trained classifier decides the first stage; SQL cannot express it. Tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
