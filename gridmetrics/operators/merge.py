"""Natural-key operators for tables without a MERGE statement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Exactly one row per key: the first under ``order``.

    ``row_number() = 1`` is limited per key before the shuffle as well as after it, so a key
    with many copies sends at most one row per task.
    """
    ranked = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def merge_by_key(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Update matching rows, insert the others, delete nothing. ``batch`` is unique on key.

    With ``update`` only those columns change on a match; otherwise the whole row does.
    """
    columns = target.columns
    if update is None:
        kept = target.join(batch.select(*key), list(key), "left_anti")
        return kept.select(*columns).unionByName(batch.select(*columns))
    t, b = target.alias("t"), batch.alias("b")
    same = [F.col(f"t.{name}") == F.col(f"b.{name}") for name in key]
    matched = F.col(f"b.{key[0]}").isNotNull()
    in_target = F.col(f"t.{key[0]}").isNotNull()

    def pick(name: str) -> Column:
        if name in update:
            return F.when(matched, F.col(f"b.{name}")).otherwise(F.col(f"t.{name}"))
        return F.when(in_target, F.col(f"t.{name}")).otherwise(F.col(f"b.{name}"))

    return t.join(b, same, "full_outer").select(*[pick(name).alias(name) for name in columns])


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows a DELETE would leave: an unknown (NULL) predicate deletes nothing."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def new_only(batch: DataFrame, existing: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Batch rows not already present under ``identity``; repeats within the batch stay."""
    seen = existing.select(*identity).distinct()
    return batch.join(seen, list(identity), "left_anti").select(*batch.columns)


def new_by_digest(
    batch: DataFrame, existing: DataFrame, identity: Sequence[str], digest: str
) -> DataFrame:
    """:func:`new_only` for frames that both carry a digest of the identity.

    A digest that is not stored settles it. Only for stored digests is the identity itself
    read and compared, so two records of one digest are still told apart.
    """
    stored = existing.select(digest).distinct()
    fresh = batch.join(stored, digest, "left_anti")
    doubtful = batch.join(stored, digest, "left_semi")
    compared = existing.join(doubtful.select(digest).distinct(), digest, "left_semi")
    seen = compared.select(digest, *[F.col(c).alias(f"_{c}") for c in identity]).distinct()
    same = doubtful[digest] == seen[digest]
    for column in identity:
        same &= doubtful[column].eqNullSafe(seen[f"_{column}"])
    collided = doubtful.join(seen, same, "left_anti")
    return fresh.select(*batch.columns).unionByName(collided.select(*batch.columns))
