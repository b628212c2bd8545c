"""Generated calendars and month windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_bounds(*dated: tuple[DataFrame, Column]) -> DataFrame:
    """One row ``(start_date, end_date)`` over several sources, each reduced first."""
    sides = [
        df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")) for df, day in dated
    ]
    return reduce(DataFrame.unionByName, sides).agg(
        F.min("lo").alias("start_date"), F.max("hi").alias("end_date")
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """Gapless ``dim_date`` between the bounds, inside the plan; empty bounds are an error."""
    start = F.coalesce(
        "start_date", F.raise_error(F.lit("cannot build the calendar: no dated rows")).cast("date")
    )
    day = F.col("date")
    return bounds.select(
        F.explode(F.sequence(start, F.col("end_date"), F.expr("interval 1 day"))).alias("date")
    ).select(
        "date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.weekday(day).alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def explode_month_windows(df: DataFrame, start: str, end: str) -> DataFrame:
    """Split each row's inclusive range at month ends: ``window_start``, ``window_end``.

    The first and last windows are clipped to the range; a start after the end is an error.
    """
    first, last = F.col(start), F.col(end)
    checked = F.when(first <= last, F.trunc(first, "MM")).otherwise(
        F.raise_error(F.concat(F.lit("start after end: "), first, F.lit(" > "), last)).cast("date")
    )
    months = F.sequence(checked, last, F.expr("interval 1 month"))
    return (
        df.withColumn("_month", F.explode(months))
        .withColumn("window_start", F.greatest("_month", first))
        .withColumn("window_end", F.least(F.last_day("_month"), last))
        .drop("_month")
    )
