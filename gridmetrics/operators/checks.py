"""Data-quality checks as verdict rows.

Each table is judged from one aggregation over one scan; a verdict row is
``check, table, column, status, observed, threshold, details``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.operators.reports import daily_ratio
from gridmetrics.operators.summaries import Days
from gridmetrics.spec import (
    GENERATION_LOW,
    MAX_NULL_PCT,
    MAX_ROW_DELTA_PCT,
    PRICE_HIGH,
    PRICE_LOW,
    RATIO_HIGH,
    RATIO_LABEL,
    RATIO_LOW,
)

# Statuses, check names and detail texts (in the functions below) are stored output.
PASS, FAIL = "PASS", "FAIL"
ROW_COUNT = "row_count"


@dataclass(frozen=True)
class TableRules:
    """What one table is held to."""

    table: str
    not_null: tuple[str, ...]
    low: float
    high: float
    out_of_range: str
    date_expr: str


# The checked tables, columns and range predicates of the silver stage.
SILVER_RULES: tuple[TableRules, ...] = (
    TableRules("silver.demand_daily", ("date", "value"), 0.0, float("inf"), "value <= 0", "date"),
    TableRules(
        "silver.generation_daily",
        ("date", "technology", "value"),
        GENERATION_LOW,
        float("inf"),
        f"(is_renewable AND value < 0) OR value < {GENERATION_LOW}",
        "date",
    ),
    TableRules(
        "silver.price_hourly",
        ("datetime_utc", "series", "value"),
        PRICE_LOW,
        PRICE_HIGH,
        f"value < {PRICE_LOW} OR value > {PRICE_HIGH}",
        "to_date(datetime_utc)",
    ),
)


def verdict(check: str, table: str, column: str | None, passed: Column, observed: Column, threshold: float, details: Column) -> Column:
    """One verdict as a struct column. A NULL condition is a failure."""
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).cast("string").alias("column"),
        F.when(F.coalesce(passed, F.lit(False)), PASS).otherwise(FAIL).alias("status"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        details.alias("details"),
    )


def null_pct(table: str, column: str, nulls: Column, total: Column, max_pct: float = MAX_NULL_PCT) -> Column:
    pct = F.coalesce(F.try_divide(F.lit(100.0) * nulls, total), F.lit(0.0))
    return verdict(
        "null_pct", table, column, pct <= max_pct, pct, max_pct,
        F.format_string("%d/%d null (%.2f%%)", nulls, total, pct),
    )


def value_range(table: str, column: str, bad: Column, low: float, high: float) -> Column:
    return verdict(
        "value_range", table, column, bad == 0, bad, 0.0,
        F.format_string(f"%d rows outside [{low}, {high}]", bad),
    )


def freshness(table: str, newest: Column, floor: date) -> Column:
    """Days behind ``floor``; an empty table fails with an infinite lag."""
    expected = F.lit(floor)
    behind = F.greatest(F.datediff(expected, newest), F.lit(0))
    details = F.when(
        newest.isNull(), F.lit(f"table empty; expected max date >= {floor.isoformat()}")
    ).otherwise(
        F.concat(F.lit("max date "), F.date_format(newest, "yyyy-MM-dd"), F.lit(f", expected >= {floor.isoformat()}"))
    )
    observed = F.when(newest.isNull(), F.lit(float("inf"))).otherwise(behind.cast("double"))
    return verdict("freshness", table, "date", newest >= expected, observed, 0.0, details)


def row_count_delta(table: str, current: Column, previous: Column, max_pct: float = MAX_ROW_DELTA_PCT) -> Column:
    """Swing against the previous load; without one (0) the check passes."""
    first = previous == 0
    pct = F.coalesce(F.try_divide(F.lit(100.0) * F.abs(current - previous), previous), F.lit(0.0))
    details = F.when(
        first, F.format_string("no baseline (first load), current=%d", current)
    ).otherwise(F.format_string("%d -> %d (%.2f%% change)", previous, current, pct))
    return verdict("row_count_delta", table, None, first | (pct <= max_pct), pct, max_pct, details)


def row_count(table: str, current: Column) -> Column:
    """Informational; the next load's baseline."""
    return verdict(ROW_COUNT, table, None, F.lit(True), current, 0.0, F.format_string("row count = %d", current))


def ratio_band(table: str, label: str, bad_days: Column, extreme: Column, low: float, high: float) -> Column:
    shown = F.coalesce(F.format_string("%.2f", extreme), F.lit("n/a"))
    shown = F.when(extreme.isNull(), F.lit("n/a")).otherwise(shown)
    details = F.concat(
        F.format_string(f"%d day(s) with {label} outside [{low}, {high}]; furthest ", bad_days), shown
    )
    return verdict("ratio_band", table, label, bad_days == 0, F.coalesce(extreme, F.lit(0.0)), high, details)


def baselines(verdicts: DataFrame, last_green: bool = False) -> DataFrame:
    """Newest recorded row count per table: ``table, previous``.

    By default any run counts, also one that failed. ``last_green`` uses only runs without
    a failing verdict.
    """
    history = verdicts.filter(F.col("check") == ROW_COUNT)
    if last_green:
        red = verdicts.filter(F.col("status") == FAIL).select("run_ts").distinct()
        history = history.join(red, "run_ts", "left_anti")
    return history.groupBy("table").agg(
        F.max_by("observed", "run_ts").cast("long").alias("previous")
    )


def table_verdicts(df: DataFrame, rules: TableRules, floor: date, baseline: DataFrame | None = None) -> DataFrame:
    """All single-table checks of one table from one pass over it."""
    nulls = {name: f"_null_{i}" for i, name in enumerate(rules.not_null)}
    facts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.expr(rules.out_of_range)).alias("_bad"),
        F.max(F.expr(rules.date_expr)).alias("_newest"),
        *[F.count_if(F.col(name).isNull()).alias(alias) for name, alias in nulls.items()],
    )
    previous = F.lit(0).cast("long")
    if baseline is not None:
        own = baseline.filter(F.col("table") == rules.table)
        previous = F.coalesce(own.select(F.max("previous")).scalar(), previous)
    facts = facts.withColumn("_previous", previous)
    n = F.col("_n")
    rows = [
        row_count(rules.table, n),
        row_count_delta(rules.table, n, F.col("_previous")),
        *[null_pct(rules.table, name, F.col(alias), n) for name, alias in nulls.items()],
        value_range(rules.table, "value", F.col("_bad"), rules.low, rules.high),
        freshness(rules.table, F.col("_newest"), floor),
    ]
    return facts.select(F.inline(F.array(*rows)))


def ratio_verdict(generation: DataFrame, demand: DataFrame, low: float = RATIO_LOW, high: float = RATIO_HIGH) -> DataFrame:
    """Generation against demand on shared days: the one check that compares two tables.

    The reported extreme is the highest ratio above the band, else the lowest below it.
    """
    ratio = F.col("ratio")
    days = daily_ratio(generation, demand.filter("value > 0"))
    facts = days.agg(
        F.count_if((ratio < low) | (ratio > high)).alias("bad"),
        F.max(F.when(ratio > high, ratio)).alias("hi"),
        F.min(F.when(ratio < low, ratio)).alias("lo"),
    )
    row = ratio_band(
        "silver.generation_daily", RATIO_LABEL, F.col("bad"), F.coalesce("hi", "lo"), low, high
    )
    return facts.select(F.inline(F.array(row)))


def silver_verdicts(demand: DataFrame, generation: DataFrame, price: DataFrame, floor: date, baseline: DataFrame | None = None) -> DataFrame:
    """The whole silver suite: three tables, then the ratio between two of them."""
    tables = (demand, generation, price)
    parts = [table_verdicts(df, rules, floor, baseline) for df, rules in zip(tables, SILVER_RULES)]
    return reduce(DataFrame.unionByName, [*parts, ratio_verdict(generation, demand)])


def failures(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.col("status") == FAIL)


def _violations(check: str, table: str, column: str | None, counted: DataFrame) -> DataFrame:
    """Verdict from a one-row frame ``n`` of violations."""
    n = F.coalesce(F.col("n"), F.lit(0))
    row = verdict(check, table, column, n == 0, n, 0.0, F.format_string("%d violation(s)", n))
    return counted.select(F.inline(F.array(row)))


def star_verdicts(
    days: Days, dim_date: DataFrame, dim_technology: DataFrame, share_mart: DataFrame
) -> DataFrame:
    """Invariants of the star: gapless, no orphans, unique technologies, sane monthly share.

    ``days`` are the facts reduced to days, from one scan each; every check reads those.
    """
    n = F.count(F.lit(1)).alias("n")
    gap = dim_date.agg(
        (F.datediff(F.max("date"), F.min("date")) + 1 - F.count(F.lit(1))).alias("n")
    )
    parts = [_violations("calendar_gapless", "gold.dim_date", "date", gap)]
    # One orphan test per relationship; distinct keys meet the dimension, not fact rows.
    for table, fact, key, dimension in (
        ("gold.fact_demand_daily", days.demand, "date", dim_date),
        ("gold.fact_generation_daily", days.generation, "date", dim_date),
        ("gold.fact_price_hourly", days.price, "date", dim_date),
        ("gold.fact_generation_daily", days.generation, "technology", dim_technology),
    ):
        lost = fact.groupBy(key).agg(F.sum("n_rows").alias("rows")).join(
            dimension.select(key).distinct(), key, "left_anti"
        )
        parts.append(_violations("no_orphans", table, key, lost.agg(F.sum("rows").alias("n"))))
    doubled = dim_technology.groupBy("technology").agg(F.count(F.lit(1)).alias("rows"))
    parts.append(
        _violations("unique_key", "gold.dim_technology", "technology", doubled.filter("rows > 1").agg(n))
    )
    mart = "gold.mlv_monthly_renewables_share"
    parts.append(
        _violations("renewable_within_total", mart, "renewable_mwh", share_mart.filter("renewable_mwh > total_mwh").agg(n))
    )
    outside = F.coalesce(
        (F.col("renewables_share_pct") <= 0) | (F.col("renewables_share_pct") >= 100), F.lit(True)
    )
    parts.append(_violations("share_in_open_range", mart, "renewables_share_pct", share_mart.filter(outside).agg(n)))
    # The stored mart against the share recomputed through the star.
    renewable = F.sum(F.when(F.col("is_renewable"), F.col("_mwh")).otherwise(0.0))
    monthly = (
        days.generation.join(dim_date.select("date", "year", "month"), "date")
        .groupBy("year", "month", "technology")
        .agg(F.sum("mwh").alias("_mwh"))
        .join(dim_technology, "technology")
        .groupBy("year", "month")
        .agg(F.round(renewable, 3).alias("_renewable"))
    )
    differs = F.coalesce(F.abs(F.col("renewable_mwh") - F.col("_renewable")) > 0.0015, F.lit(True))
    off = share_mart.join(monthly, ["year", "month"], "full_outer").filter(differs)
    parts.append(_violations("mart_equals_star", mart, "renewable_mwh", off.agg(n)))
    # A month is whole when it has as many distinct days as the calendar says, per flag.
    expected = dim_date.groupBy("year", "month").agg(F.count(F.lit(1)).alias("_days"))
    covered = (
        days.generation.join(dim_technology, "technology")
        .select("date", "is_renewable").distinct()
        .groupBy(F.year("date").alias("year"), F.month("date").alias("month"), "is_renewable")
        .agg(F.count(F.lit(1)).alias("_covered"))
    )
    short = covered.join(expected, ["year", "month"]).filter("_covered <> _days")
    parts.append(_violations("day_count_complete", "gold.fact_generation_daily", "date", short.agg(n)))
    return reduce(DataFrame.unionByName, parts)
