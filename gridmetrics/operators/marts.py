"""Monthly aggregates stored beside the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_month_technology(fact_generation: DataFrame) -> DataFrame:
    """Generation reduced to (year, month, technology) before any dimension is joined."""
    return fact_generation.groupBy(
        F.year("date").alias("year"), F.month("date").alias("month"), "technology"
    ).agg(F.sum("generation_mwh").alias("mwh"))


def monthly_renewables_share(fact_generation: DataFrame, dim_technology: DataFrame) -> DataFrame:
    """Renewable and total MWh and their share in percent, per month."""
    return _share(by_month_technology(fact_generation), dim_technology)


def share_of_summaries(months: DataFrame, dim_technology: DataFrame) -> DataFrame:
    """The same from month summaries of generation, whose storage month is the civil month."""
    summed = months.groupBy(
        F.year("first_date").alias("year"), F.month("first_date").alias("month"), "technology"
    ).agg(F.sum("mwh").alias("mwh"))
    return _share(summed, dim_technology)


def _share(summed: DataFrame, dim_technology: DataFrame) -> DataFrame:
    flagged = summed.join(dim_technology.select("technology", "is_renewable"), "technology")
    renewable = F.sum(F.when(F.col("is_renewable"), F.col("mwh")).otherwise(F.lit(0.0)))
    total = F.sum("mwh")
    return flagged.groupBy("year", "month").agg(
        F.round(renewable, 3).alias("renewable_mwh"),
        F.round(total, 3).alias("total_mwh"),
        F.round(F.try_divide(100 * renewable, total), 2).alias("renewables_share_pct"),
    )


def monthly_avg_price(fact_price: DataFrame) -> DataFrame:
    """Mean of observations per (civil month, series): the grain is constant within one."""
    parts = fact_price.groupBy(
        F.year("date").alias("year"), F.month("date").alias("month"), "series"
    ).agg(
        F.sum("price_eur_mwh").alias("total"),
        F.count("price_eur_mwh").alias("n_prices"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return avg_price_of_summaries(parts)


def avg_price_of_summaries(months: DataFrame) -> DataFrame:
    """The same from month summaries of prices; a civil month spans up to two storage months."""
    mean = F.try_divide(F.sum("total"), F.sum("n_prices"))
    return months.groupBy("year", "month", "series").agg(
        F.round(mean, 2).alias("avg_price_eur_mwh"), F.sum("n_rows").alias("n_observations")
    )
