"""The silver tables, derived from the test tables inside each query.

Every query builds what it needs from the whole given tables: demand and generation as one row per
day (times part type), prices as a projection of the events. :class:`Gold` is the star of one
query; a part that several of its branches read is written once, within that query.

Money columns have two decimals; they are summed as decimals so that a total does not depend
on the order in which rows arrive.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.operators import star, summaries
from gridmetrics.sources.staging import written

RENEWABLE = ("ECONOMY", "PROMO", "SMALL")
# The events are from January 2024; moved by whole days they overlap the other tables' end.
PRICE_SHIFT_DAYS = 8200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_sum(column: str):
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, value``: ordered value per day."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        exact_sum("o_totalprice").alias("value")
    )


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the technology of their part."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", F.col("p_type").alias("technology")
    )
    return lines.join(parts, "l_partkey")


def generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, technology, is_renewable, value``: shipped value per day and part type."""
    daily = shipped(spark, sf_dir).groupBy(F.to_date("l_shipdate").alias("date"), "technology")
    return daily.agg(exact_sum("l_extendedprice").alias("value")).select(
        "date", "technology", F.col("technology").isin(*RENEWABLE).alias("is_renewable"), "value"
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their shifted instant."""
    shift = F.expr(f"interval {PRICE_SHIFT_DAYS} days")
    return table(spark, sf_dir, "events").withColumn(
        "datetime_utc", (F.col("ts") - shift).cast("timestamp")
    )


def price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``datetime_utc, series, value, period_minutes``: one row per event."""
    return events(spark, sf_dir).select(
        "datetime_utc",
        F.col("event_type").alias("series"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("period_minutes"),
    )


class Gold:
    """The star over the three silver tables, for one query."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def silver_generation(self) -> DataFrame:
        return written(generation(self.spark, self.sf_dir))

    @cached_property
    def demand(self) -> DataFrame:
        return star.fact_demand(demand(self.spark, self.sf_dir))

    @cached_property
    def generation(self) -> DataFrame:
        return star.fact_generation(self.silver_generation)

    @cached_property
    def price(self) -> DataFrame:
        return star.fact_price(price(self.spark, self.sf_dir))

    @cached_property
    def dim_date(self) -> DataFrame:
        """From first and last days alone: one column of each table, no row is converted."""
        ordered = table(self.spark, self.sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
        sent = shipped(self.spark, self.sf_dir).select(F.to_date("l_shipdate").alias("date"))
        return star.dim_date(ordered, sent, price(self.spark, self.sf_dir))

    @cached_property
    def dim_technology(self) -> DataFrame:
        return star.dim_technology(self.silver_generation)

    @cached_property
    def days(self) -> summaries.Days:
        """The facts reduced to days, each written from one scan."""
        return summaries.Days(*map(written, summaries.days(self)))
