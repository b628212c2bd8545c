"""Silver -> star schema: three dimensions and three facts on natural keys."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.functions.dates import civil_date
from gridmetrics.operators.calendar import calendar, date_bounds
from gridmetrics.spec import SPECS


class Star(NamedTuple):
    """The gold tables that measures and reports read."""

    demand: DataFrame
    generation: DataFrame
    price: DataFrame
    dim_date: DataFrame
    dim_technology: DataFrame


MONTH = "year_month"


def within(fact: DataFrame, first: Column, last: Column) -> DataFrame:
    """Rows of daily data with ``date`` between two days.

    Where the frame carries its storage month, the months that the days imply are asked for
    too, which prunes partitions.
    """
    rows = fact.filter(F.col("date").between(first, last))
    if MONTH not in fact.columns:
        return rows
    months = [F.date_format(day, "yyyy-MM") for day in (first, last)]
    return rows.filter(F.col(MONTH).between(*months))


# ``kept`` names storage columns to carry along, such as a partition column.


def fact_demand(silver_demand: DataFrame, *kept: str) -> DataFrame:
    return silver_demand.select("date", F.col("value").alias("demand_mwh"), *kept)


def fact_generation(silver_generation: DataFrame, *kept: str) -> DataFrame:
    """The renewable flag stays on the dimension."""
    return silver_generation.select(
        "date", "technology", F.col("value").alias("generation_mwh"), *kept
    )


def fact_price(silver_price: DataFrame, *kept: str) -> DataFrame:
    """Adds the civil day, so late-evening instants line up with the daily facts."""
    return silver_price.select(
        "datetime_utc",
        civil_date(F.col("datetime_utc")).alias("date"),
        "series",
        "period_minutes",
        F.col("value").alias("price_eur_mwh"),
        *kept,
    )


def dim_date(demand: DataFrame, generation: DataFrame, price: DataFrame) -> DataFrame:
    """Calendar over the silver tables, reaching the furthest of the three.

    Prices are reduced to their first and last instant, and only those two are converted.
    """
    ends = price.agg(F.min("datetime_utc").alias("first"), F.max("datetime_utc").alias("last"))
    priced = ends.select(F.explode(F.array("first", "last")).alias("moment"))
    day = F.col("date")
    return calendar(
        date_bounds((demand, day), (generation, day), (priced, civil_date(F.col("moment"))))
    )


def dim_technology(silver_generation: DataFrame) -> DataFrame:
    label = F.when(F.col("is_renewable"), "Renewable").otherwise("Non-renewable")
    return (
        silver_generation.select("technology", "is_renewable")
        .distinct()
        .withColumn("renewable_label", label)
    )


def dim_indicator(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(s.name, s.path, s.table, s.grain, s.unit) for s in SPECS],
        "indicator STRING, source_path STRING, silver_table STRING, grain STRING, unit STRING",
    )


def star(demand: DataFrame, generation: DataFrame, price: DataFrame) -> Star:
    """The star over three silver tables, as lazy frames."""
    return Star(
        demand=fact_demand(demand),
        generation=fact_generation(generation),
        price=fact_price(price),
        dim_date=dim_date(demand, generation, price),
        dim_technology=dim_technology(generation),
    )
