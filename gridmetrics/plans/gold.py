"""The star and its monthly marts from silver: built in full, or brought up to date by month.

Beside the facts stand their month summaries. Dimensions, the calendar and the marts are made from
summaries alone, so an update reads and writes the touched months of silver and facts, and nothing
of the others but their summaries, whose size is bounded by months, technologies and series.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.operators import marts, star, summaries
from gridmetrics.operators.calendar import calendar
from gridmetrics.sources import tables
from gridmetrics.spec import DEMAND, GENERATION, PRICES, SPECS, spec_for

logger = logging.getLogger(__name__)

SHARE_MART = "gold.mlv_monthly_renewables_share"
PRICE_MART = "gold.mlv_monthly_avg_price"
FACT_PRICE = "gold.fact_price_hourly"
STAR_TABLES = {
    "demand": "gold.fact_demand_daily",
    "generation": "gold.fact_generation_daily",
    "price": FACT_PRICE,
    "dim_date": "gold.dim_date",
    "dim_technology": "gold.dim_technology",
}
DIM_INDICATOR = "gold.dim_indicator"
OBJECTS = (*STAR_TABLES.values(), DIM_INDICATOR, SHARE_MART, PRICE_MART)


# Facts are one-to-one projections of a silver table and share its monthly layout.
FACTS = {
    "gold.fact_demand_daily": (DEMAND, star.fact_demand),
    "gold.fact_generation_daily": (GENERATION, star.fact_generation),
    FACT_PRICE: (PRICES, star.fact_price),
}
# Month summaries: the monthly table each is made from and how.
DEMAND_MONTHS, GENERATION_MONTHS, PRICE_MONTHS = (
    "gold.agg_demand_month", "gold.agg_generation_month", "gold.agg_price_month",
)
SUMMARIES = {
    DEMAND_MONTHS: (spec_for(DEMAND).table, summaries.demand_months),
    GENERATION_MONTHS: (spec_for(GENERATION).table, summaries.generation_months),
    PRICE_MONTHS: (FACT_PRICE, summaries.price_months),
}


def _fact(spark: SparkSession, table: str, months: Sequence[str] | None = None) -> DataFrame:
    indicator, project = FACTS[table]
    silver = tables.months_of(spark, spec_for(indicator).table, months)
    return project(silver, tables.MONTH)


def _summary(spark: SparkSession, table: str, months: Sequence[str] | None = None) -> DataFrame:
    source, summarise = SUMMARIES[table]
    return summarise(tables.months_of(spark, source, months))


def build_star(spark: SparkSession) -> dict[str, int]:
    """Rebuild facts, summaries and dimensions. An empty silver layer is an error before any write."""
    if all(tables.read_table(spark, spec.table).isEmpty() for spec in SPECS):
        raise ValueError("cannot build the calendar: no dated rows")
    counts = _rebuild_all(spark, {table: _fact(spark, table) for table in FACTS})
    _rebuild_all(spark, {table: _summary(spark, table) for table in SUMMARIES})
    return {**counts, **_rebuild_all(spark, _dimensions(spark))}


def can_update(spark: SparkSession) -> bool:
    """Whether a full build has left everything that an update starts from."""
    return all(spark.catalog.tableExists(table) for table in (*OBJECTS, *SUMMARIES))


def update_gold(spark: SparkSession, months: Sequence[str]) -> None:
    """Bring star and marts up to date after a load that touched only the storage ``months``.

    Other months of silver and facts are neither read nor written. The result equals
    :func:`build_star` and :func:`build_marts`.
    """
    for table in FACTS:
        tables.replace_months(spark, table, _fact(spark, table, months), months)
    for table in SUMMARIES:
        tables.replace_months(spark, table, _summary(spark, table, months), months)
    flags = _flags(spark)
    _rebuild_all(spark, _dimensions(spark))
    # A technology that is new or changed its flag can move the share of any month.
    every = flags != _flags(spark)
    following = {_next(month) for month in months}
    _update_mart(spark, SHARE_MART, None if every else sorted({*months, *following}))
    _update_mart(spark, PRICE_MART, sorted({*months, *following}))


def _flags(spark: SparkSession) -> set[tuple]:
    """The technology dimension, a handful of rows."""
    return {tuple(row) for row in tables.read_table(spark, STAR_TABLES["dim_technology"]).collect()}


def _next(month: str) -> str:
    return f"{date.fromisoformat(f'{month}-01') + timedelta(days=31):%Y-%m}"


def _previous(month: str) -> str:
    return f"{date.fromisoformat(f'{month}-01') - timedelta(days=1):%Y-%m}"


def _dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    read = lambda table: tables.read_table(spark, table)
    return {
        "gold.dim_date": calendar(summaries.bounds(*map(read, SUMMARIES))),
        "gold.dim_technology": star.dim_technology(read(GENERATION_MONTHS)),
        DIM_INDICATOR: star.dim_indicator(spark),
    }


def _mart(spark: SparkSession, table: str, months: Sequence[str] | None) -> DataFrame:
    """A mart with its month as storage column, of all or of the given civil months."""
    if table == SHARE_MART:
        technologies = tables.read_table(spark, STAR_TABLES["dim_technology"])
        rows = marts.share_of_summaries(tables.months_of(spark, GENERATION_MONTHS, months), technologies)
    else:
        # The first local hours of a month lie in the UTC month before.
        stored = None if months is None else sorted({*months, *map(_previous, months)})
        rows = marts.avg_price_of_summaries(tables.months_of(spark, PRICE_MONTHS, stored))
    rows = rows.withColumn(tables.MONTH, F.format_string("%04d-%02d", "year", "month"))
    return rows if months is None else rows.filter(F.col(tables.MONTH).isin(list(months)))


def _update_mart(spark: SparkSession, table: str, months: Sequence[str] | None) -> None:
    if months is None:
        _rebuild_all(spark, {table: _mart(spark, table, None)})
    else:
        tables.replace_months(spark, table, _mart(spark, table, months), months)


def build_marts(spark: SparkSession) -> dict[str, int]:
    """Rebuild the monthly aggregates from the summaries of the star just written."""
    return _rebuild_all(spark, {table: _mart(spark, table, None) for table in (SHARE_MART, PRICE_MART)})


def read_star(spark: SparkSession) -> star.Star:
    """The star as stored; facts keep their storage month, by which date filters prune."""
    kept = {name: tables.months_of(spark, table, None) for name, table in STAR_TABLES.items()}
    return star.Star(**kept)


def _rebuild_all(spark: SparkSession, frames: dict[str, DataFrame]) -> dict[str, int]:
    counts = {}
    for table, frame in frames.items():
        counts[table] = tables.rebuild(spark, table, frame)
        logger.info("%s rebuilt: %d rows", table, counts[table])
    return counts
