"""The quality gate: store every verdict first, then stop the run if any failed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from enum import StrEnum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.functions.dates import year_month
from gridmetrics.operators import checks
from gridmetrics.sources import tables
from gridmetrics.spec import FRESHNESS_LAG_DAYS, SPECS, VERDICT_SCHEMA, VERDICT_TABLE

class Stage(StrEnum):
    """What a gate can judge."""

    SILVER = "silver"


class GateFailure(RuntimeError):
    """One or more checks failed; all verdicts are stored."""

    def __init__(self, failed: list) -> None:
        self.failed = failed
        super().__init__("\n".join([f"{len(failed)} check(s) failed", *map(_line, failed)]))


def _line(verdict) -> str:
    where = ".".join((verdict["table"], verdict["column"] or "*"))
    return f"{where} {verdict['check']}: {verdict['details']}"


def silver_tables(spark: SparkSession) -> list[DataFrame]:
    return [tables.read_table(spark, spec.table) for spec in SPECS]


def run_gate(
    spark: SparkSession,
    stage: str,
    as_of: date | None = None,
    run_ts: datetime | None = None,
    baseline: str = "last_run",
    judged: Sequence[DataFrame] | None = None,
    verdict_table: str = VERDICT_TABLE,
) -> None:
    """Judge a stage. ``as_of`` is today (UTC); freshness asks for the day before it.

    ``judged`` are demand, generation and prices, by default the stored silver tables.

    ``baseline="last_green"`` compares row counts with the last run that had no failure
    instead of the last run of any outcome.
    """
    stage = Stage(stage).value
    run_ts = run_ts or tables.utc_now()
    as_of = as_of or tables.utc_now().date()
    floor = as_of - timedelta(days=FRESHNESS_LAG_DAYS)
    tables.ensure_table(spark, verdict_table, VERDICT_SCHEMA, monthly=True)
    known = checks.baselines(tables.read_table(spark, verdict_table), last_green=baseline == "last_green")
    demand, generation, price = judged or silver_tables(spark)
    stamped = checks.silver_verdicts(demand, generation, price, floor, known).select(
        F.lit(run_ts).cast("timestamp").alias("run_ts"), F.lit(stage).alias("stage"), "*"
    ).withColumn(tables.MONTH, year_month(F.col("run_ts")))
    # A couple of dozen verdicts: one file a run, and the month's files are made one.
    tables.append(spark, verdict_table, stamped.coalesce(1))
    tables.compact(spark, verdict_table, [f"{run_ts:%Y-%m}"])
    this_run = (F.col("run_ts") == F.lit(run_ts).cast("timestamp")) & (F.col("stage") == stage)
    this_month = F.col(tables.MONTH) == f"{run_ts:%Y-%m}"
    stored = tables.months_of(spark, verdict_table).filter(this_month & this_run)
    failed = checks.failures(stored.drop(tables.MONTH)).orderBy(
        "table", "check", "column"
    ).collect()
    if failed:
        raise GateFailure(failed)
