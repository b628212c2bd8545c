"""Observation grain of series held as table rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmetrics.functions.grain import MICROS_PER_MINUTE


def modal_grain(df: DataFrame, keys: Sequence[str], instant: str) -> DataFrame:
    """Most frequent whole-minute gap per key; ties to the gap seen first; too few points: 0.

    Exact without ordering a whole series in one task. Instants are de-duplicated and
    reduced to one summary per (key, clock minute): gaps inside a minute are all shorter
    than a minute, hence 0, and only their number and first position matter. The window
    then runs over minute summaries, whose number is bounded by the time span covered
    and not by the number of rows.
    """
    keys = list(keys)
    points = (
        df.select(*keys, F.unix_micros(F.col(instant).cast("timestamp")).alias("us"))
        .filter("us is not null")
        .distinct()
    )
    minutes = points.groupBy(*keys, F.floor(F.col("us") / MICROS_PER_MINUTE).alias("minute")).agg(
        F.count(F.lit(1)).alias("n"), F.min("us").alias("first"), F.max("us").alias("last")
    )
    before = Window.partitionBy(*keys).orderBy("minute")
    minutes = minutes.withColumn("previous", F.lag("last").over(before))
    across = F.floor((F.col("first") - F.col("previous")) / MICROS_PER_MINUTE)
    gaps = minutes.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("long").alias("gap"), (F.col("n") - 1).alias("n"), F.col("first").alias("seen")),
                F.struct(
                    F.coalesce(across, F.lit(0)).alias("gap"),
                    F.when(across.isNotNull(), 1).otherwise(0).cast("long").alias("n"),
                    F.coalesce("previous", "first").alias("seen"),
                ),
            )
        ),
    )
    # Placeholders (n = 0) keep every key present and never win against a real gap.
    counted = gaps.groupBy(*keys, "gap").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("n") > 0, F.col("seen"))).alias("seen")
    )
    return counted.groupBy(*keys).agg(
        F.max_by("gap", F.struct("n", -F.col("seen"))).cast("int").alias("period_minutes")
    )
