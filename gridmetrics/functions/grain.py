"""Observation grain of one record's timestamps, without leaving the record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def modal_minutes(instants: Column) -> Column:
    """Most frequent whole-minute gap between the distinct instants of an array.

    Ties go to the gap seen first in time; fewer than two distinct instants give 0.
    The gaps are ordered by (gap, position) and folded run by run, so the cost is one
    sort of an array the row already holds and no shuffle.
    """
    micros = F.array_sort(F.array_distinct(F.transform(instants, F.unix_micros)))
    gaps = F.zip_with(
        F.slice(micros, F.lit(2), F.greatest(F.size(micros) - 1, F.lit(0))),
        F.slice(micros, F.lit(1), F.greatest(F.size(micros) - 1, F.lit(0))),
        lambda later, earlier: F.floor((later - earlier) / MICROS_PER_MINUTE).cast("int"),
    )
    ordered = F.array_sort(
        F.transform(gaps, lambda gap, i: F.struct(gap.alias("gap"), i.alias("at")))
    )

    def state(gap: Column, n: Column, first: Column, top: Column, top_n: Column, top_first: Column):
        return F.struct(
            gap.cast("int").alias("gap"), n.cast("int").alias("n"), first.cast("int").alias("first"),
            top.cast("int").alias("top"), top_n.cast("int").alias("top_n"),
            top_first.cast("int").alias("top_first"),
        )

    def extend(run: Column, item: Column) -> Column:
        same = run.gap == item.gap
        n = F.when(same, run.n + 1).otherwise(1)
        first = F.when(same, run.first).otherwise(item["at"])
        wins = (n > run.top_n) | ((n == run.top_n) & (first < run.top_first))
        return state(
            item.gap, n, first,
            F.when(wins, item.gap).otherwise(run.top),
            F.when(wins, n).otherwise(run.top_n),
            F.when(wins, first).otherwise(run.top_first),
        )

    zero = F.lit(0)
    return F.aggregate(ordered, state(F.lit(-1), zero, zero, zero, zero, zero), extend, lambda run: run.top)
