"""Facts reduced by storage month and by day: what marts, calendar, dimensions and checks need.

Month summaries are additive: those of a month follow from that month's rows alone, so after a load
only the touched months are summed again. Day summaries hold a row per day (and technology or
series), whatever the number of observations, and serve all invariants from one scan of a fact.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.functions.dates import civil_date, year_month
from gridmetrics.operators.star import MONTH, Star


def _rows() -> Column:
    return F.count(F.lit(1)).alias("n_rows")


def _dated(df: DataFrame, moment: str) -> DataFrame:
    """With the storage month, derived where the frame does not carry it."""
    return df if MONTH in df.columns else df.withColumn(MONTH, year_month(F.col(moment)))


def demand_months(silver_demand: DataFrame) -> DataFrame:
    return _dated(silver_demand, "date").groupBy(MONTH).agg(
        _rows(), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def generation_months(silver_generation: DataFrame) -> DataFrame:
    """Per month, technology and flag; taken from silver, which has the flag."""
    return _dated(silver_generation, "date").groupBy(MONTH, "technology", "is_renewable").agg(
        _rows(),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("value").alias("mwh"),
    )


def price_months(fact_price: DataFrame) -> DataFrame:
    """Per storage (UTC) month, civil month and series."""
    return _dated(fact_price, "datetime_utc").groupBy(
        MONTH, F.year("date").alias("year"), F.month("date").alias("month"), "series"
    ).agg(
        _rows(),
        F.count("price_eur_mwh").alias("n_prices"),
        F.sum("price_eur_mwh").alias("total"),
        F.min("datetime_utc").alias("first_instant"),
        F.max("datetime_utc").alias("last_instant"),
    )


def bounds(demand: DataFrame, generation: DataFrame, price: DataFrame) -> DataFrame:
    """First and last civil day over the three month summaries; two instants are converted."""
    dated = [df.agg(F.min("first_date").alias("lo"), F.max("last_date").alias("hi")) for df in (demand, generation)]
    instants = price.agg(F.min("first_instant").alias("lo"), F.max("last_instant").alias("hi"))
    dated.append(instants.select(civil_date(F.col("lo")).alias("lo"), civil_date(F.col("hi")).alias("hi")))
    return reduce(DataFrame.unionByName, dated).agg(
        F.min("lo").alias("start_date"), F.max("hi").alias("end_date")
    )


class Days(NamedTuple):
    """The three facts reduced to days."""

    demand: DataFrame
    generation: DataFrame
    price: DataFrame


def days(star: Star) -> Days:
    """One row per day of demand, per day and technology, and per day and series, with row counts."""
    return Days(
        demand=star.demand.groupBy("date").agg(_rows()),
        generation=star.generation.groupBy("date", "technology").agg(
            _rows(), F.sum("generation_mwh").alias("mwh")
        ),
        price=star.price.groupBy("date", "series").agg(
            _rows(), F.count("price_eur_mwh").alias("n_prices"), F.sum("price_eur_mwh").alias("total")
        ),
    )
