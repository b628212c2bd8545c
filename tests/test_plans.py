"""Jobs: silver load, gate, gold, refresh chain, planning, stream."""

from __future__ import annotations

import json
import os
from dataclasses import replace
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gridmetrics.operators import checks, measures, reports, work_plan
from gridmetrics.operators.calendar import explode_month_windows
from gridmetrics.plans import gate, gold, refresh, silver
from gridmetrics.sources import landing, tables
from gridmetrics.spec import (
    DEFAULT_SERIES, DEMAND, GENERATION, PRICES, QUARANTINE_TABLE, SPECS, SPOT_SERIES, VERDICT_TABLE, WATERMARK_TABLE,
)
from gridmetrics.streaming.landing_stream import load_new
from tests.conftest import day, entry, envelope, series

JANUARY = [date(2024, 1, 1) + timedelta(days=i) for i in range(31)]


def land_file(root, indicator, month, payload, bom=True):
    path = landing.raw_path(str(root), indicator, month)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(("﻿" if bom else "") + json.dumps(payload, ensure_ascii=False, indent=None if bom else 1))


def daily(amount):
    return [entry(amount, day(d.isoformat())) for d in JANUARY]


def land_january(root, demand=100.0):
    land_file(root, DEMAND, JANUARY[0], envelope(series("Demanda", "Demanda", daily(demand))))
    land_file(root, GENERATION, JANUARY[0], envelope(
        series("Eólica", "Renovable", daily(70.0), composite=False),
        series("Nuclear", "No-Renovable", daily(40.0), composite=False),
        series("Generación total", "total", daily(110.0), composite=False),
    ), bom=False)
    hours = [
        entry(50.0 + h % 24, (datetime(2024, 1, 1) + timedelta(hours=h)).isoformat(timespec="milliseconds") + "+01:00")
        for h in range(31 * 24)
    ]
    land_file(root, PRICES, JANUARY[0], envelope(series("PVPC", "x", hours), series("Precio mercado spot", "x", hours)))


AS_OF = date(2024, 2, 1)


COUNTS = {
    "gold.dim_date": 31, "gold.fact_demand_daily": 31, "gold.fact_generation_daily": 62,
    "gold.fact_price_hourly": 1488, "gold.dim_technology": 2, "gold.dim_indicator": 3,
    gold.SHARE_MART: 1, gold.PRICE_MART: 2,
}


def counts(spark):
    return {table: tables.read_table(spark, table).count() for table in gold.OBJECTS}


def test_refresh_builds_everything_and_is_idempotent(lake, tmp_path):
    land_january(tmp_path)
    refresh.refresh(lake, str(tmp_path), AS_OF)
    assert counts(lake) == COUNTS
    share = lake.table(gold.SHARE_MART).first()
    assert (share["renewable_mwh"], share["total_mwh"], share["renewables_share_pct"]) == (2170.0, 3410.0, 63.64)
    # The same month again, this time reading and rewriting only what it can touch.
    untouched = lake.sql("SELECT input_file_name() FROM gold.fact_price_hourly").distinct().count()
    land_january(tmp_path, demand=105.0)
    refresh.refresh(lake, str(tmp_path), AS_OF, months=[date(2024, 1, 1)])
    assert counts(lake) == COUNTS
    assert lake.sql("SELECT input_file_name() FROM gold.fact_price_hourly").distinct().count() == untouched
    assert lake.table("gold.fact_demand_daily").agg(F.sum("demand_mwh")).first()[0] == 31 * 105.0
    assert lake.table(VERDICT_TABLE).count() == 42
    assert lake.table(QUARANTINE_TABLE).count() == 0
    # What the incremental run left equals a full rebuild.
    content = lambda: {t: sorted(map(str, tables.read_table(lake, t).collect())) for t in gold.OBJECTS}
    incremental = content()
    gold.build_star(lake)
    gold.build_marts(lake)
    assert content() == incremental


def test_corrupt_file_is_gated_and_gold_stays(lake, tmp_path):
    land_january(tmp_path)
    refresh.refresh(lake, str(tmp_path), AS_OF)
    broken = daily(100.0)
    for i, value in ((4, -4200.5), (5, -1.0), (6, -99999.0), (7, None)):
        broken[i]["value"] = value
    del broken[8]["datetime"]
    land_file(tmp_path, DEMAND, JANUARY[0], envelope(series("Demanda", "Demanda", broken)))
    with pytest.raises(gate.GateFailure, match=r"silver.demand_daily.value value_range: 3 rows outside \[0.0, inf\]"):
        refresh.refresh(lake, str(tmp_path), AS_OF, months=[date(2024, 1, 1)])
    verdicts = lake.table(VERDICT_TABLE)
    assert verdicts.count() == 42, "every verdict is stored before the run stops"
    assert verdicts.filter("status = 'FAIL'").count() == 1
    assert lake.table(QUARANTINE_TABLE).count() == 2
    assert lake.table("gold.fact_demand_daily").agg(F.sum("demand_mwh")).first()[0] == 3100.0
    # The same bad file again: nothing new in quarantine. Then the good file: green.
    reload = lambda: silver.load_indicator(lake, landing.read_landed(lake, str(tmp_path), DEMAND), DEMAND)
    assert reload() == {"row": 29, "quarantine": 2, "unusable": 0}
    assert lake.table(QUARANTINE_TABLE).count() == 2
    land_january(tmp_path)
    assert reload() == {"row": 31, "quarantine": 0, "unusable": 0}
    gate.run_gate(lake, "silver", AS_OF)


def land_months(root, *months, price=50.0, share=70.0):
    """Three indicators for whole months; prices reach into the UTC month before."""
    for first in months:
        days_of = [first + timedelta(days=i) for i in range(28)]
        values = lambda amount: [entry(amount + d.day, day(d.isoformat())) for d in days_of]
        land_file(root, DEMAND, first, envelope(series("Demanda", "Demanda", values(100.0))))
        land_file(root, GENERATION, first, envelope(
            series("Eólica", "Renovable", values(share)), series("Nuclear", "No-Renovable", values(40.0)),
        ))
        hours = [
            entry(price + d.day, day(d.isoformat()).replace("T00", f"T{hour:02}")) for d in days_of for hour in range(24)
        ]
        land_file(root, PRICES, first, envelope(series("PVPC", "x", hours)))


def gold_content(spark):
    shown = (*gold.OBJECTS, *gold.SUMMARIES)
    return {t: sorted(map(str, tables.read_table(spark, t).collect())) for t in shown}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_update_by_month_equals_a_full_build_and_leaves_other_months_alone(lake, tmp_path, monkeypatch):
    first, second, third = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
    land_months(tmp_path, first, second, third)
    for spec in SPECS:
        silver.load_indicator(lake, landing.read_landed(lake, str(tmp_path), spec.name), spec.name)
    gold.build_star(lake)
    gold.build_marts(lake)
    files = lambda table: {
        (r[0], r[1]) for r in lake.table(table).select("year_month", F.input_file_name()).distinct().collect()
    }
    monthly = (*gold.FACTS, *gold.SUMMARIES, gold.SHARE_MART, gold.PRICE_MART)
    before = {table: files(table) for table in monthly}
    land_months(tmp_path, third, price=80.0, share=90.0)
    for spec in SPECS:
        silver.load_indicator(lake, landing.read_landed(lake, str(tmp_path), spec.name, [third]), spec.name)
    read, seen = tables.months_of, []
    monkeypatch.setattr(tables, "months_of", lambda spark, *a: seen.append((read(spark, *a), *a)) or read(spark, *a))
    gold.update_gold(lake, refresh.touched_months([third]))
    monkeypatch.undo()
    large = {*gold.FACTS, *(spec.table for spec in SPECS)}
    for frame, table, months in seen:
        assert set(months) == {"2024-02", "2024-03"} or table not in large
        scans = [line for line in plan_of(frame).splitlines() if "FileScan" in line]
        assert scans and all("PartitionFilters: [year_month" in line or "isnotnull(year_month" in line for line in scans)
    after = {table: files(table) for table in monthly}
    for table in (*gold.FACTS, *gold.SUMMARIES):
        kept = {f for f in before[table] if f[0] == "2024-01"}
        assert kept <= after[table], f"{table}: an untouched month keeps its files"
        assert not {f for f in before[table] if f[0] == "2024-03"} & after[table]
    incremental = gold_content(lake)
    gold.build_star(lake)
    gold.build_marts(lake)
    assert gold_content(lake) == incremental
    # A technology that changes its flag moves the share of every month.
    rows = tables.read_table(lake, "silver.generation_daily")
    flipped = rows.filter("date >= '2024-03-01'").select("date", "technology", (~F.col("is_renewable")).alias("is_renewable"), "value")
    flipped = flipped.selectExpr("*", "'f' AS file", "0 AS series_pos", "0 AS entry_pos")
    spec = next(s for s in SPECS if s.name == GENERATION)
    tables.upsert(lake, spec.table, flipped, spec.key, spec.month_of, silver.newest_first())
    gold.update_gold(lake, ["2024-03"])
    incremental = gold_content(lake)
    gold.build_star(lake)
    gold.build_marts(lake)
    assert gold_content(lake) == incremental


def test_date_filters_prune_stored_months(lake, tmp_path):
    land_months(tmp_path, date(2024, 1, 1), date(2024, 2, 1))
    refresh.refresh(lake, str(tmp_path), date(2024, 2, 29))
    star = gold.read_star(lake)
    silver_tables = [tables.months_of(lake, spec.table) for spec in SPECS]
    # The calendar is a stored table; no report scans prices for it.
    for frame in (
        reports.star_month(star, 2024, 2), reports.share_of_month(star, 2024, 2),
        reports.recent_ratio(silver_tables[1], silver_tables[0], date(2024, 2, 28), 10),
    ):
        assert frame.count() > 0
        scans = [line for line in plan_of(frame).splitlines() if "FileScan" in line and "year_month" in line]
        assert scans and all("year_month#" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
        assert "price" not in plan_of(frame)
    assert reports.star_month(star, 2024, 2).first()["day_count"] == 28


def test_landed_envelopes_load_in_refresh(lake, tmp_path, spark):
    land_months(tmp_path / "by_hand", date(2024, 1, 1))
    root = str(tmp_path / "raw")
    for spec in SPECS:
        files = landing.read_landed(lake, str(tmp_path / "by_hand"), spec.name)
        landing.land(files.selectExpr(f"'{spec.name}' AS indicator", "2024 AS year", "1 AS month", "value"), root)
    refresh.refresh(lake, root, date(2024, 1, 29))
    assert tables.read_table(lake, "gold.fact_demand_daily").count() == 28


def test_stream_lists_an_unusable_file_and_loads_the_rest(lake, tmp_path):
    root, checkpoint = tmp_path / "raw", str(tmp_path / "checkpoint")
    land_file(root, DEMAND, date(2024, 1, 1), {"data": 1})
    land_file(root, DEMAND, date(2024, 2, 1), envelope(series("D", "D", [entry(3, day("2024-02-01"))])))
    for _ in range(2):
        load_new(lake, str(root), DEMAND, checkpoint).awaitTermination()
    assert [r["value"] for r in tables.read_table(lake, "silver.demand_daily").collect()] == [3.0]
    for _ in range(2):
        with pytest.raises(silver.UnusableFiles):
            silver.load_indicator(lake, landing.read_landed(lake, str(root), DEMAND), DEMAND)
    assert lake.table(silver.UNUSABLE_TABLE).count() == 1, "each file is listed once"


def test_quarantine_can_append_repeats(lake, files):
    payload = files({"a": envelope(series("D", "D", [entry(None, day("2024-01-01"))]))})
    for _ in range(2):
        silver.load_indicator(lake, payload, DEMAND, append_repeats=True)
    assert lake.table(QUARANTINE_TABLE).count() == 2
    stored = lake.table(QUARANTINE_TABLE).first()
    assert stored["indicator"] == DEMAND and stored["loaded_at"] is not None


def test_unusable_file_stops_the_load_before_any_write(lake, files):
    bad = {f"bad{k:02}": {"data": k} for k in range(25)}
    payload = files({
        "good": envelope(series("D", "D", [entry(1, day("2024-01-01")), entry(None, day("2024-01-02"))])),
        **bad,
    })
    with pytest.raises(silver.UnusableFiles, match="25 unusable"):
        silver.load_indicator(lake, payload, DEMAND)
    listed = [row.file for row in lake.table(silver.UNUSABLE_TABLE).collect()]
    assert len(listed) == 25 and all(any(name in file for file in listed) for name in bad)
    assert tables.read_table(lake, "silver.demand_daily").count() == 0
    assert lake.table(QUARANTINE_TABLE).count() == 0


def test_later_file_wins_a_repeated_day(lake, files):
    payload = files({
        "f_202401": envelope(series("D", "D", [entry(1, day("2024-01-31"))])),
        "f_202402": envelope(series("D", "D", [entry(2, day("2024-01-31")), entry(3, day("2024-01-31"))])),
    })
    silver.load_indicator(lake, payload, DEMAND)
    assert [r["value"] for r in tables.read_table(lake, "silver.demand_daily").collect()] == [3.0]


def test_gate_on_empty_silver(lake):
    silver.ensure_silver(lake)
    with pytest.raises(gate.GateFailure) as caught:
        gate.run_gate(lake, "silver", AS_OF)
    assert {(r["check"], r["observed"]) for r in caught.value.failed} == {("freshness", float("inf"))}
    assert len(caught.value.failed) == 3
    with pytest.raises(Exception, match="no dated rows"):
        gold.build_star(lake)


def test_gate_rejects_an_unknown_stage(lake):
    with pytest.raises(ValueError, match="Stage"):
        gate.run_gate(lake, "bronze")


def test_row_count_baseline_last_run_or_last_green(spark):
    run = lambda n: datetime(2024, 1, n)
    history = spark.createDataFrame(
        [
            (run(1), "row_count", "t", "PASS", 100.0), (run(1), "freshness", "t", "PASS", 0.0),
            (run(2), "row_count", "t", "PASS", 40.0), (run(2), "row_count_delta", "t", "FAIL", 60.0),
        ],
        "run_ts TIMESTAMP, check STRING, table STRING, status STRING, observed DOUBLE",
    )
    rules = replace(checks.SILVER_RULES[0], table="t")
    now = spark.range(40).select(F.lit(AS_OF).alias("date"), F.lit(1.0).alias("value"))

    def delta(baseline):
        found = checks.table_verdicts(now, rules, AS_OF, baseline).filter("check = 'row_count_delta'").first()
        return found["status"], found["details"]

    # By default a failed run's count is the next baseline, so the second such run passes.
    assert delta(checks.baselines(history)) == ("PASS", "40 -> 40 (0.00% change)")
    assert delta(checks.baselines(history, last_green=True)) == ("FAIL", "100 -> 40 (60.00% change)")
    assert delta(None) == ("PASS", "no baseline (first load), current=40")
    assert delta(checks.baselines(history.filter("table = 'other'"))) == ("PASS", "no baseline (first load), current=40")


def test_verdict_thresholds(spark):
    def one(column):
        row = spark.range(1).select(column.alias("v")).first()["v"]
        return row["status"], row["observed"], row["details"]

    n = lambda value: F.lit(value).cast("long")
    assert one(checks.null_pct("t", "c", n(0), n(250))) == ("PASS", 0.0, "0/250 null (0.00%)")
    assert one(checks.null_pct("t", "c", n(1), n(250))) == ("FAIL", 0.4, "1/250 null (0.40%)")
    assert one(checks.null_pct("t", "c", n(0), n(0)))[:2] == ("PASS", 0.0)
    assert one(checks.value_range("t", "c", n(7), -2.0, 9.5)) == ("FAIL", 7.0, "7 rows outside [-2.0, 9.5]")
    assert one(checks.row_count_delta("t", n(119), n(80)))[:2] == ("PASS", 48.75)
    assert one(checks.row_count_delta("t", n(121), n(80)))[:2] == ("FAIL", 51.25)
    assert one(checks.row_count_delta("t", n(0), n(64)))[:2] == ("FAIL", 100.0)
    newest = lambda text: F.lit(text).cast("date")
    assert one(checks.freshness("t", newest("2024-02-01"), AS_OF))[:2] == ("PASS", 0.0)
    assert one(checks.freshness("t", newest("2024-03-05"), AS_OF))[:2] == ("PASS", 0.0)
    assert one(checks.freshness("t", newest("2024-01-31"), AS_OF))[:2] == ("FAIL", 1.0)
    assert one(checks.freshness("t", newest(None), AS_OF)) == ("FAIL", float("inf"), "table empty; expected max date >= 2024-02-01")
    band = lambda days, extreme: one(checks.ratio_band("t", "r", n(days), F.lit(extreme).cast("double"), 0.8, 1.6))
    assert band(0, None) == ("PASS", 0.0, "0 day(s) with r outside [0.8, 1.6]; furthest n/a")
    assert band(5, 1.75) == ("FAIL", 1.75, "5 day(s) with r outside [0.8, 1.6]; furthest 1.75")
    assert band(2, 0.79)[:2] == ("FAIL", 0.79)


def test_prices_default_to_one_series(spark):
    prices = [(date(2024, 5, 1), s, v) for s, v in ((DEFAULT_SERIES, 11.0), (DEFAULT_SERIES, 13.0), (SPOT_SERIES, 90.0))]
    star = SimpleNamespace(price=spark.createDataFrame(prices, "date DATE, series STRING, price_eur_mwh DOUBLE"))
    assert [r["avg_price"] for r in reports.price_by_date(star).collect()] == [12.0]
    assert [r["avg_price"] for r in reports.price_by_date(star, None).collect()] == [38.0]
    assert tuple(measures.price_min_max(star).first()) == (11.0, 13.0)
    assert tuple(measures.price_min_max(star, series=None).first()) == (11.0, 90.0)


# --- planning -------------------------------------------------------------------------


def windows(spark, start, end):
    ranged = spark.createDataFrame([(date.fromisoformat(start), date.fromisoformat(end))], "a DATE, b DATE")
    return sorted((str(r["window_start"]), str(r["window_end"])) for r in explode_month_windows(ranged, "a", "b").collect())


def test_month_windows_are_clipped(spark):
    assert windows(spark, "2024-01-15", "2024-03-02") == [
        ("2024-01-15", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-02"),
    ]
    assert windows(spark, "2024-01-31", "2024-01-31") == [("2024-01-31", "2024-01-31")]
    assert windows(spark, "2023-12-31", "2024-01-01") == [("2023-12-31", "2023-12-31"), ("2024-01-01", "2024-01-01")]
    with pytest.raises(Exception, match="start after end"):
        windows(spark, "2024-02-02", "2024-02-01")


def test_backfill_is_indicator_major(spark):
    plan = work_plan.backfill_plan(work_plan.indicators(spark), date(2024, 1, 10), date(2024, 2, 5)).collect()
    assert [(r["indicator_name"], r["start"], r["end"]) for r in plan[:2]] == [
        (DEMAND, "2024-01-10T00:00", "2024-01-31T23:59"), (DEMAND, "2024-02-01T00:00", "2024-02-05T23:59"),
    ]
    assert [r["indicator_name"] for r in plan] == [s.name for s in SPECS for _ in range(2)]
    assert plan[0]["raw_path"] == f"raw/{DEMAND}/2024/01/{DEMAND}_202401.json"
    assert plan[0]["url"] == "/es/datos/demanda/evolucion?start_date=2024-01-10T00:00&end_date=2024-01-31T23:59&time_trunc=day"


def marks(spark, **last_end):
    return spark.createDataFrame([(k, v, datetime(2024, 1, 1)) for k, v in last_end.items()], "indicator STRING, last_end STRING, updated_at TIMESTAMP")


def test_daily_plan_tests_currency_before_the_month_snap(spark):
    known = marks(spark, **{DEMAND: "2024-03-14T23:59", GENERATION: "2024-03-13T23:59", PRICES: "2024-01-31T23:59"})
    plan = work_plan.daily_plan(work_plan.indicators(spark), known, date(2024, 3, 14)).collect()
    assert [(r["indicator_name"], r["start"], r["end"]) for r in plan] == [
        (GENERATION, "2024-03-01T00:00", "2024-03-14T23:59"),
        (PRICES, "2024-02-01T00:00", "2024-02-29T23:59"),
        (PRICES, "2024-03-01T00:00", "2024-03-14T23:59"),
    ]


@pytest.mark.parametrize("stored", ["2024-03-14", "2024-3-14T23:59", "2024-02-30T23:59", "junk"])
def test_malformed_or_missing_watermark_is_an_error(spark, stored):
    feeds = work_plan.indicators(spark).filter(F.col("indicator_name") == DEMAND)
    with pytest.raises(Exception, match="watermark"):
        work_plan.daily_plan(feeds, marks(spark, **{DEMAND: stored}), date(2024, 3, 20)).collect()
    with pytest.raises(Exception, match="watermark"):
        work_plan.daily_plan(feeds, marks(spark, other="2024-03-14T23:59"), date(2024, 3, 20)).collect()


def test_parameters_are_strict():
    assert work_plan.Mode("daily") == "daily"
    assert work_plan.check_date("2024-02-29", "p") == date(2024, 2, 29)
    assert work_plan.check_watermark("2024-02-29T23:59") == "2024-02-29T23:59"
    assert work_plan.day_before(date(2024, 3, 1)) == date(2024, 2, 29)
    for call in (
        lambda: work_plan.Mode(""), lambda: work_plan.check_date("", "p"),
        lambda: work_plan.check_date("20240229", "p"), lambda: work_plan.check_date("2024-02-30", "p"),
        lambda: work_plan.check_watermark("2024-02-29"),
    ):
        with pytest.raises(ValueError):
            call()


def test_ingest_advances_the_watermark_only_after_success(lake):
    fetched = []
    refresh.ingest(lake, "backfill", lambda plan: fetched.append(plan.count()), start="2024-01-01", end="2024-02-29")
    state = lambda: {r["indicator"]: r["last_end"] for r in lake.table(WATERMARK_TABLE).collect()}
    assert fetched == [6] and set(state().values()) == {"2024-02-29T23:59"}

    def fail(plan):
        raise OSError("down")

    with pytest.raises(OSError):
        refresh.ingest(lake, "daily", fail, as_of=date(2024, 3, 3))
    assert set(state().values()) == {"2024-02-29T23:59"}
    refresh.ingest(lake, "daily", lambda plan: fetched.append(plan.count()), as_of=date(2024, 3, 3))
    refresh.ingest(lake, "daily", lambda plan: fetched.append(plan.count()), as_of=date(2024, 3, 3))
    assert fetched == [6, 3, 0] and set(state().values()) == {"2024-03-02T23:59"}
    refresh.ingest(lake, "backfill", lambda plan: None, start="2024-01-01", end="2024-01-31")
    assert set(state().values()) == {"2024-01-31T23:59"}


# --- stream ---------------------------------------------------------------------------


def test_stream_loads_each_landed_file_once(lake, tmp_path):
    root, checkpoint = tmp_path / "raw", str(tmp_path / "checkpoint")
    rows = lambda: sorted((str(r["date"]), r["value"]) for r in tables.read_table(lake, "silver.demand_daily").collect())
    land_file(root, DEMAND, date(2024, 1, 1), envelope(series("D", "D", [entry(1, day("2024-01-01"))])))
    load_new(lake, str(root), DEMAND, checkpoint).awaitTermination()
    assert rows() == [("2024-01-01", 1.0)]
    land_file(root, DEMAND, date(2024, 2, 1), envelope(series("D", "D", [entry(2, day("2024-01-01")), entry(3, day("2024-02-01"))])))
    load_new(lake, str(root), DEMAND, checkpoint).awaitTermination()
    assert rows() == [("2024-01-01", 2.0), ("2024-02-01", 3.0)]
    load_new(lake, str(root), DEMAND, checkpoint).awaitTermination()
    assert rows() == [("2024-01-01", 2.0), ("2024-02-01", 3.0)]
