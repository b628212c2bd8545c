"""Report visuals, slicers, proofs and drill queries over the star and its marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmetrics.operators import measures
from gridmetrics.operators.marts import by_month_technology
from gridmetrics.operators.star import Star, within
from gridmetrics.spec import DEFAULT_SERIES, SPOT_SERIES

# --- report visuals -------------------------------------------------------------------


def demand_by_month(star: Star, dates: Column | None = None) -> DataFrame:
    """Complete months only; ``month`` rides along so that names sort by month number."""
    by = ("year", "month", "month_name")
    return (
        measures.total_demand(star, by, dates, complete=True)
        .filter(F.col("demand_mwh").isNotNull())
        .orderBy("year", "month")
    )


def generation_by_month_technology(star: Star, dates: Column | None = None) -> DataFrame:
    by = ("year", "month", "technology")
    return (
        measures.total_generation(star, by, dates, complete=True)
        .filter(F.col("generation_mwh").isNotNull())
        .orderBy("year", "month", "technology")
    )


def share_by_month(star: Star, dates: Column | None = None) -> DataFrame:
    return measures.renewables_share(star, ("year", "month"), dates).orderBy("year", "month")


def price_by_date(star: Star, series: Sequence[str] | None = (DEFAULT_SERIES,)) -> DataFrame:
    """Daily means with their 30-day means, of the default series; None takes all series together."""
    return measures.avg_price_30d(star, series).orderBy("date")


def years(star: Star) -> DataFrame:
    return star.dim_date.select("year").distinct().orderBy("year")


def price_series(star: Star) -> DataFrame:
    return star.price.select("series").distinct().orderBy("series")


# --- proofs and repair diagnostics ----------------------------------------------------


def row_counts(objects: Mapping[str, DataFrame], summed: Mapping[str, DataFrame] = {}) -> DataFrame:
    """One labelled count per object; ``summed`` objects are given by a summary with ``n_rows``."""
    rows = F.count(F.lit(1))
    total = F.coalesce(F.sum("n_rows"), F.lit(0))
    counted = [(name, df, rows) for name, df in objects.items()]
    counted += [(name, df, total) for name, df in summed.items()]
    counts = [
        df.agg(n.alias("row_count")).select(F.lit(name).alias("object_name"), "row_count")
        for name, df, n in counted
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("object_name")


def calendar_gap(dim_date: DataFrame) -> DataFrame:
    """Missing days between the calendar's ends; 0 when gapless."""
    return dim_date.agg(
        (F.datediff(F.max("date"), F.min("date")) + 1 - F.count(F.lit(1))).cast("long").alias("missing_days")
    )


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row, counted per orphaned key."""
    counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(dimension.select(key).distinct(), key, "left_anti")


def star_month(star: Star, year: int, month: int) -> DataFrame:
    """Fact x both dimensions for one month, split by the renewable flag."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    daily = (
        within(star.generation, first, F.last_day(first))
        .groupBy("date", "technology")
        .agg(F.sum("generation_mwh").alias("_mwh"))
    )
    days = star.dim_date.filter((F.col("year") == year) & (F.col("month") == month))
    return (
        daily.join(days.select("date", "year", "month"), "date")
        .join(star.dim_technology, "technology")
        .groupBy("year", "month", "is_renewable")
        .agg(
            F.count_distinct("date").alias("day_count"),
            F.round(F.sum("_mwh"), 3).alias("generation_mwh"),
        )
        .orderBy("is_renewable")
    )


def latest_months(mart: DataFrame, n: int = 12) -> DataFrame:
    return mart.orderBy(F.desc("year"), F.desc("month")).limit(n)


def technology_damage(silver_generation: DataFrame, technology: str) -> DataFrame:
    """How many rows one technology has, and over which days."""
    return (
        silver_generation.filter(F.col("technology") == technology)
        .groupBy("technology")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
    )


def daily_ratio(generation: DataFrame, demand: DataFrame) -> DataFrame:
    """Generation over demand on days present in both; generation is summed before the join."""
    produced = generation.groupBy("date").agg(F.sum("value").alias("produced"))
    demanded = demand.select("date", F.col("value").alias("demanded"))
    return produced.join(demanded, "date").select(
        "date", "produced", "demanded", F.try_divide("produced", "demanded").alias("ratio")
    )


def recent_ratio(generation: DataFrame, demand: DataFrame, as_of: date, days: int = 40) -> DataFrame:
    """Post-repair ratio per day, rounded, from ``days`` before ``as_of``."""
    recent = (F.date_sub(F.lit(as_of), days), F.lit(date.max))
    return (
        daily_ratio(within(generation, *recent), within(demand, *recent))
        .select("date", F.round("ratio", 2).alias("gen_over_demand"))
        .orderBy("date")
    )


# --- drill queries --------------------------------------------------------------------


def monthly_totals(fact_demand: DataFrame) -> DataFrame:
    return (
        fact_demand.groupBy(F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(F.sum("demand_mwh").alias("demand_mwh"), F.count(F.lit(1)).alias("days"))
        .orderBy("year", "month")
    )


def share_of_month(star: Star, year: int, month: int) -> DataFrame:
    """Renewable percentage of one month."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    one = within(star.generation, first, F.last_day(first))
    flagged = by_month_technology(one).join(star.dim_technology, "technology")
    renewable = F.sum(F.when(F.col("is_renewable"), F.col("mwh")).otherwise(F.lit(0.0)))
    return flagged.agg((F.try_divide(renewable, F.sum("mwh")) * 100).alias("renewables_share_pct"))


def top_prices(fact_price: DataFrame, series: str = SPOT_SERIES, n: int = 10) -> DataFrame:
    """The dearest instants of a series; equal prices go to the earlier instant."""
    return (
        fact_price.filter(F.col("series") == series)
        .select("datetime_utc", "price_eur_mwh")
        .orderBy(F.desc("price_eur_mwh"), "datetime_utc")
        .limit(n)
    )


def latest_per_series(fact_price: DataFrame) -> DataFrame:
    """Newest instant of each series with its price, reduced map-side per series."""
    return fact_price.groupBy("series").agg(
        F.max("datetime_utc").alias("datetime_utc"),
        F.max_by("price_eur_mwh", "datetime_utc").alias("price_eur_mwh"),
    )


def rolling_daily_mean(fact_price: DataFrame, series: str = SPOT_SERIES, rows: int = 7) -> DataFrame:
    """Daily (UTC day) mean and its mean over the last ``rows`` daily rows.

    The global window sees one row per day, never the observations.
    """
    daily = (
        fact_price.filter(F.col("series") == series)
        .groupBy(F.to_date("datetime_utc").alias("date"))
        .agg(F.avg("price_eur_mwh").alias("avg_price"))
    )
    last_rows = Window.orderBy("date").rowsBetween(-(rows - 1), Window.currentRow)
    return daily.select("date", F.avg("avg_price").over(last_rows).alias("rolling_avg_price"))
