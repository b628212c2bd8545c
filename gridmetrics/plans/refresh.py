"""The chain: plan and fetch -> watermark -> silver -> gate -> gold -> marts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from gridmetrics.operators import work_plan
from gridmetrics.plans import gate, gold, silver
from gridmetrics.sources import landing, tables
from gridmetrics.spec import SPECS, WATERMARK_SCHEMA, WATERMARK_TABLE

Fetch = Callable[[DataFrame], None]


def ingest(
    spark: SparkSession,
    mode: str,
    fetch: Fetch,
    as_of: date | None = None,
    start: str = "",
    end: str = "",
) -> None:
    """Plan the work, hand it to ``fetch``, and advance the watermarks only if that returns.

    The watermark records the end the plan itself used, so a run that crosses midnight
    cannot skip a day. A backfill may move a watermark back; a daily run advances it also
    when there was nothing to fetch.
    """
    feeds = work_plan.indicators(spark)
    if work_plan.Mode(mode) is work_plan.Mode.BACKFILL:
        last = work_plan.check_date(end, "end")
        plan = work_plan.backfill_plan(feeds, work_plan.check_date(start, "start"), last)
    else:
        tables.ensure_rebuilt(spark, WATERMARK_TABLE, WATERMARK_SCHEMA)
        last = work_plan.day_before(as_of or tables.utc_now().date())
        plan = work_plan.daily_plan(feeds, spark.table(WATERMARK_TABLE), last)
    fetch(plan)
    tables.upsert_watermarks(spark, work_plan.watermark_updates(feeds, last, tables.utc_now()))


def refresh(
    spark: SparkSession, root: str, as_of: date | None = None, months: Sequence[date] | None = None
) -> None:
    """Load landed files, gate, bring gold up to date. A failed gate leaves gold as it was.

    With ``months`` (first days), as planned by :func:`ingest`, only those months' files are
    read and only the table months they can touch are rewritten; otherwise everything is
    loaded and gold is rebuilt.
    """
    for spec in SPECS:
        files = landing.read_landed(spark, root, spec.name, months)
        silver.load_indicator(spark, files, spec.name)
    gate.run_gate(spark, "silver", as_of)
    if months is None or not gold.can_update(spark):
        gold.build_star(spark)
        gold.build_marts(spark)
    else:
        gold.update_gold(spark, touched_months(months))


def touched_months(months: Sequence[date]) -> list[str]:
    """Storage months a file of a civil month can hold: its own, and the one before, where
    the first local hours of a month lie in UTC."""
    days = {m.replace(day=1) for m in months} | {m.replace(day=1) - timedelta(days=1) for m in months}
    return sorted(f"{d:%Y-%m}" for d in days)
