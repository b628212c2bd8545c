"""The report measures as grouped DataFrame queries over the star.

``by`` names calendar columns (from ``dim_date``) and/or ``technology`` columns; ``dates`` is
an optional filter on the calendar. Facts are reduced to their join keys first, so what
meets a dimension is bounded by days (times technologies), not by fact rows. Constants that
ignore the filter context, such as the last loaded date, are scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmetrics.operators.star import Star
from gridmetrics.spec import DEFAULT_SERIES

DATE_COLUMNS = ("date", "year", "month", "month_name", "quarter", "day_of_week", "is_weekend")


def last_loaded(fact: DataFrame) -> Column:
    """Latest fact date with every filter removed."""
    return fact.select(F.max("date")).scalar()


def _visible(star: Star, by: Sequence[str], dates: Column | None) -> DataFrame:
    """Calendar days in context, each with the month end of its group's last day."""
    days = star.dim_date if dates is None else star.dim_date.filter(dates)
    group = Window.partitionBy(*[c for c in by if c in DATE_COLUMNS])
    return days.withColumn("period_end", F.last_day(F.max("date").over(group)))


def _in_context(daily: DataFrame, star: Star, by: Sequence[str], dates: Column | None) -> DataFrame:
    """Daily rows in context with the calendar's columns; every fact date is in the calendar,
    so it is not read where neither ``by`` nor ``dates`` asks for it.
    """
    if dates is None and not any(c in star.dim_date.columns for c in by):
        return daily
    return daily.join(star.dim_date if dates is None else star.dim_date.filter(dates), "date")


def _total(fact: DataFrame, value: str, keys: Sequence[str], star: Star, by: Sequence[str], dates: Column | None, complete: bool) -> DataFrame:
    daily = fact.groupBy(*keys).agg(F.sum(value).alias("_daily"))
    joined = daily.join(_visible(star, by, dates), "date")
    if any(c in ("is_renewable", "renewable_label") for c in by):
        joined = joined.join(star.dim_technology, "technology")
    total = F.sum("_daily")
    if complete:
        total = F.when(F.max("period_end") <= last_loaded(fact), total)
    return joined.groupBy(*by).agg(total.alias("total"))


def total_demand(star: Star, by: Sequence[str] = (), dates: Column | None = None, complete: bool = False) -> DataFrame:
    """Summed demand; ``complete`` blanks periods whose calendar month end is not loaded."""
    return _total(star.demand, "demand_mwh", ["date"], star, by, dates, complete).withColumnRenamed(
        "total", "demand_mwh"
    )


def total_generation(star: Star, by: Sequence[str] = (), dates: Column | None = None, complete: bool = False) -> DataFrame:
    """Summed generation; ``complete`` as for demand. Ratios are never blanked this way."""
    return _total(
        star.generation, "generation_mwh", ["date", "technology"], star, by, dates, complete
    ).withColumnRenamed("total", "generation_mwh")


def _price_rows(star: Star, dates: Column | None, series: Sequence[str] | None) -> DataFrame:
    prices = star.price
    if series is not None:
        prices = prices.filter(F.col("series").isin(*series))
    if dates is not None:
        prices = prices.join(star.dim_date.filter(dates).select("date"), "date", "left_semi")
    return prices


def peak_demand(star: Star, by: Sequence[str] = (), dates: Column | None = None) -> DataFrame:
    """Largest single demand value."""
    daily = star.demand.groupBy("date").agg(F.max("demand_mwh").alias("_peak"))
    return _in_context(daily, star, by, dates).groupBy(*by).agg(
        F.max("_peak").alias("peak_demand_mwh")
    )


def demand_yoy_r12(star: Star) -> DataFrame:
    """Last 12 complete months against the 12 before, anchored on the last loaded date.

    Date filters are ignored on purpose; blank when the prior span is empty or zero.
    """
    month_before = lambda day, n: F.last_day(F.add_months(day, -n))
    anchors = star.demand.agg(F.max("date").alias("last")).select(
        month_before(F.col("last"), 1).alias("curr_end")
    )
    curr_end = F.col("curr_end")
    prior_end = month_before(curr_end, 12)
    bounds = {
        "curr_end": curr_end,
        "curr_start": F.date_add(F.add_months(curr_end, -12), 1),
        "prior_end": prior_end,
        "prior_start": F.date_add(F.add_months(prior_end, -12), 1),
    }
    bound = anchors.select(F.struct(*[value.alias(name) for name, value in bounds.items()])).scalar()
    day = F.col("date")
    within = lambda span: day.between(bound[f"{span}_start"], bound[f"{span}_end"])
    sums = star.demand.agg(
        F.sum(F.when(within("curr"), F.col("demand_mwh"))).alias("current_mwh"),
        F.sum(F.when(within("prior"), F.col("demand_mwh"))).alias("prior_mwh"),
    )
    change = F.try_divide(F.col("current_mwh") - F.col("prior_mwh"), F.col("prior_mwh"))
    return sums.withColumn("demand_yoy", change)


def data_through(star: Star) -> DataFrame:
    """The earliest of the three facts' last dates, as text; null if a fact is empty."""
    demand, generation, price = (
        fact.agg(F.max("date").alias("last")) for fact in (star.demand, star.generation, star.price)
    )
    # Every fact must reach the date, so one without rows leaves it unknown.
    lasts = demand.unionByName(generation).unionByName(price)
    return lasts.agg(
        F.when(F.count("last") == F.count("*"), F.date_format(F.min("last"), "yyyy-MM-dd")).alias(
            "data_through"
        )
    )


def renewables_share(star: Star, by: Sequence[str] = (), dates: Column | None = None) -> DataFrame:
    """Renewable fraction (not percent) of generation; partial periods are valid."""
    daily = star.generation.groupBy("date", "technology").agg(F.sum("generation_mwh").alias("_daily"))
    joined = _in_context(daily, star, by, dates).groupBy(*by, "technology").agg(
        F.sum("_daily").alias("_mwh")
    )
    flagged = joined.join(star.dim_technology, "technology")
    renewable = F.sum(F.when(F.col("is_renewable"), F.col("_mwh")))
    return flagged.groupBy(*by).agg(
        F.try_divide(renewable, F.sum("_mwh")).alias("renewables_share")
    )


def avg_price(star: Star, by: Sequence[str] = (), dates: Column | None = None, series: Sequence[str] | None = None) -> DataFrame:
    """Mean of observations in context."""
    daily = _price_rows(star, None, series).groupBy("date", "series").agg(
        F.sum("price_eur_mwh").alias("_sum"), F.count("price_eur_mwh").alias("_n")
    )
    return _in_context(daily, star, by, dates).groupBy(*by).agg(
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_price")
    )


def price_min_max(
    star: Star, dates: Column | None = None, series: Sequence[str] | None = (DEFAULT_SERIES,)
) -> DataFrame:
    """Lowest and highest price in context, of the default series; None takes all series."""
    return _price_rows(star, dates, series).agg(
        F.min("price_eur_mwh").alias("min_price"), F.max("price_eur_mwh").alias("max_price")
    )


def avg_price_30d(star: Star, series: Sequence[str] | None = None, by_series: bool = False) -> DataFrame:
    """Per civil day with a price: its mean, and the mean of daily means over 30 calendar days.

    Days without a price are skipped, not counted as zero. The window runs over daily rows
    only, whose number is bounded by the calendar.
    """
    keys = ["series"] if by_series else []
    daily = _price_rows(star, None, series).groupBy(*keys, "date").agg(
        F.avg("price_eur_mwh").alias("avg_price")
    ).filter(F.col("avg_price").isNotNull())
    trailing = (
        Window.partitionBy(*keys)
        .orderBy(F.datediff("date", F.lit("1970-01-01")))
        .rangeBetween(-29, Window.currentRow)
    )
    return daily.withColumn("avg_price_30d", F.avg("avg_price").over(trailing))
