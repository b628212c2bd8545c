"""Table sinks: upsert, delete, rebuild, watermarks, landing."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridmetrics.operators import merge
from gridmetrics.sources import landing, tables
from gridmetrics.sources.staging import shared_folder, staged
from gridmetrics.spec import GENERATION, QUARANTINE_SCHEMA, QUARANTINE_TABLE, WATERMARK_TABLE, spec_for

SPEC = spec_for(GENERATION)


def order():
    return [F.desc("file"), F.desc("pos")]


def batch(spark, *rows):
    """Rows ``(date, technology, value[, file, pos])``."""
    full = [(date.fromisoformat(r[0]), r[1], True, float(r[2]), *(r[3:] or ("f", 0))) for r in rows]
    return spark.createDataFrame(
        full, "date DATE, technology STRING, is_renewable BOOLEAN, value DOUBLE, file STRING, pos INT"
    )


def upsert(spark, *rows):
    tables.ensure_table(spark, SPEC.table, SPEC.schema, monthly=True)
    tables.upsert(spark, SPEC.table, batch(spark, *rows), SPEC.key, SPEC.month_of, order())


def content(spark):
    return sorted(
        (str(r["date"]), r["technology"], r["value"]) for r in tables.read_table(spark, SPEC.table).collect()
    )


def data_files(spark):
    return {r[0]: r[1] for r in spark.table(SPEC.table).select("year_month", F.input_file_name()).distinct().collect()}


def test_empty_table_is_typed_and_scannable(lake):
    tables.ensure_table(lake, SPEC.table, SPEC.schema, monthly=True)
    df = tables.read_table(lake, SPEC.table)
    assert df.columns == ["date", "technology", "is_renewable", "value"]
    assert dict(df.dtypes)["date"] == "date"
    assert df.count() == 0


def test_upsert_updates_inserts_and_never_deletes(lake):
    upsert(lake, ("2024-01-01", "a", 1), ("2024-01-02", "a", 2), ("2024-02-01", "a", 3))
    before = data_files(lake)
    upsert(lake, ("2024-01-02", "a", 20), ("2024-01-03", "b", 30))
    expected = [("2024-01-01", "a", 1.0), ("2024-01-02", "a", 20.0), ("2024-01-03", "b", 30.0), ("2024-02-01", "a", 3.0)]
    assert content(lake) == expected
    after = data_files(lake)
    assert after["2024-02"] == before["2024-02"], "an untouched month keeps its files"
    assert after["2024-01"] != before["2024-01"]
    upsert(lake, ("2024-01-02", "a", 20), ("2024-01-03", "b", 30))
    assert content(lake) == expected, "the same batch again changes nothing"
    upsert(lake)
    assert content(lake) == expected


def test_survivor_of_a_repeated_key_is_deterministic(lake):
    upsert(
        lake,
        ("2024-01-01", "a", 1, "f1", 9), ("2024-01-01", "a", 2, "f2", 1), ("2024-01-01", "a", 3, "f2", 2),
    )
    assert content(lake) == [("2024-01-01", "a", 3.0)]


def test_month_must_follow_from_the_key(lake):
    with pytest.raises(ValueError, match="key"):
        tables.upsert(lake, SPEC.table, batch(lake), ["technology"], "date", order())


def test_delete_rewrites_only_touched_months(lake):
    upsert(
        lake, ("2024-01-01", "a", 1), ("2024-01-01", "total", 9), ("2024-02-01", "a", 2),
        ("2024-03-01", "total", 9),
    )
    before = data_files(lake)
    tables.delete_rows(lake, SPEC.table, F.col("technology") == "total")
    assert content(lake) == [("2024-01-01", "a", 1.0), ("2024-02-01", "a", 2.0)]
    after = data_files(lake)
    assert set(after) == {"2024-01", "2024-02"}, "a month left without rows is gone"
    assert after["2024-02"] == before["2024-02"]
    tables.delete_rows(lake, SPEC.table, F.col("technology") == "total")
    assert len(content(lake)) == 2


def test_delete_keeps_rows_with_an_unknown_predicate(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t STRING")
    assert {r["t"] for r in merge.delete_where(df, F.col("t") == "a").collect()} == {"b", None}


def test_compaction_rewrites_only_months_of_small_files(lake):
    tables.ensure_table(lake, SPEC.table, SPEC.schema, monthly=True)
    add = lambda day, technology: batch(lake, (day, technology, 1)).withColumn("year_month", F.lit(day[:7]))
    for technology in "abc":
        tables.append(lake, SPEC.table, add("2024-01-01", technology).coalesce(1))
    tables.append(lake, SPEC.table, add("2024-02-01", "a").coalesce(1))
    files = lambda: {r["part"]: r["files"] for r in tables.file_sizes(lake, SPEC.table).collect()}
    expected, before = content(lake), data_files(lake)
    assert files() == {"2024-01": 3, "2024-02": 1}
    assert tables.compact(lake, SPEC.table, ["2024-02"]) == []
    assert tables.compact(lake, SPEC.table, small=1) == [], "files of this size are large enough"
    assert tables.compact(lake, SPEC.table) == ["2024-01"]
    assert files() == {"2024-01": 1, "2024-02": 1} and content(lake) == expected
    assert data_files(lake)["2024-02"] == before["2024-02"], "an untouched month keeps its files"
    assert tables.compact(lake, SPEC.table) == [], "nothing is left to do"


def test_rebuild_replaces_schema_and_can_read_itself(lake):
    assert tables.rebuild(lake, "gold.t", lake.range(5).toDF("a")) == 5
    assert tables.rebuild(lake, "gold.t", lake.table("gold.t").select((F.col("a") + 1).alias("b"), F.lit("x").alias("c"))) == 5
    assert sorted(r["b"] for r in lake.table("gold.t").collect()) == [1, 2, 3, 4, 5]


def test_counts_of_an_empty_write_are_zero(lake):
    nothing = lake.range(5).repartition(2).filter("id > 9").groupBy("id").count()
    assert tables.rebuild(lake, "gold.t", nothing) == 0
    tables.rebuild(lake, "gold.m", lake.createDataFrame([(1, "2024-01")], "v INT, year_month STRING"))
    rows = nothing.selectExpr("CAST(id AS INT) AS v", "'2024-01' AS year_month")
    tables.replace_months(lake, "gold.m", rows, ["2024-01"])
    assert lake.table("gold.m").count() == 0


def test_failed_rebuild_leaves_the_last_good_table(lake):
    tables.rebuild(lake, "gold.t", lake.range(3).toDF("a"))
    broken = lake.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("a"))
    with pytest.raises(Exception, match="boom"):
        tables.rebuild(lake, "gold.t", broken)
    assert lake.table("gold.t").count() == 3


def test_rebuild_that_stops_between_its_steps_leaves_the_last_good_table(lake, monkeypatch):
    mark = lambda end: lake.createDataFrame(
        [("a", end, datetime(2024, 2, 1))], "indicator STRING, last_end STRING, updated_at TIMESTAMP"
    )
    tables.rebuild(lake, "gold.t", lake.range(3).toDF("a"))
    tables.upsert_watermarks(lake, mark("2024-01-31T23:59"))

    def stop(*_):
        raise OSError("stopped")

    monkeypatch.setattr(tables, "_switch", stop)
    with pytest.raises(OSError):
        tables.rebuild(lake, "gold.t", lake.range(9).selectExpr("id AS b", "1 AS c"))
    with pytest.raises(OSError):
        tables.upsert_watermarks(lake, mark("2024-02-29T23:59"))
    assert lake.table("gold.t").columns == ["a"] and lake.table("gold.t").count() == 3
    assert lake.table(WATERMARK_TABLE).first()["last_end"] == "2024-01-31T23:59"
    monkeypatch.undo()
    tables.upsert_watermarks(lake, mark("2024-02-29T23:59"))
    assert lake.table(WATERMARK_TABLE).first()["last_end"] == "2024-02-29T23:59"
    for n in (4, 5, 6):
        tables.rebuild(lake, "gold.t", lake.range(n).toDF("a"))
    assert lake.table("gold.t").count() == 6
    kept = lake.sql("SHOW TABLES IN gold LIKE 't__v_*'").count()
    assert kept == 2, "the current version and the one before it, for readers that began earlier"


def test_rebuilt_monthly_table_takes_months_and_prunes(lake):
    frame = lambda *r: lake.createDataFrame(list(r), "v INT, year_month STRING")
    assert tables.rebuild(lake, "gold.m", frame((1, "2024-01"), (2, "2024-02"), (3, "2024-03"))) == 3
    tables.replace_months(lake, "gold.m", frame((20, "2024-02"), (99, "2024-09")), ["2024-02", "2024-03"])
    assert sorted(tuple(r) for r in lake.table("gold.m").collect()) == [(1, "2024-01"), (20, "2024-02")]
    plan = tables.months_of(lake, "gold.m", ["2024-01"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def quarantined(lake, indicator, *raws):
    rows = [(raw, indicator, "why", datetime(2024, 1, 1)) for raw in raws]
    return lake.createDataFrame(rows, "raw STRING, indicator STRING, reason STRING, loaded_at TIMESTAMP")


def test_quarantine_is_keyed_by_digest_and_reads_one_indicator(lake):
    tables.ensure_table(lake, QUARANTINE_TABLE, QUARANTINE_SCHEMA, by="indicator")
    identity = ["indicator", "raw", "reason"]
    put = lambda indicator, *raws: tables.append_new(
        lake, QUARANTINE_TABLE, quarantined(lake, indicator, *raws), identity, indicator=indicator
    )
    put("d", "x", "x", "y")
    put("g", "x")
    put("d", "x", "z")
    read = lambda: sorted((r["indicator"], r["raw"]) for r in lake.table(QUARANTINE_TABLE).collect())
    assert read() == [("d", "x"), ("d", "x"), ("d", "y"), ("d", "z"), ("g", "x")]
    put("d", "x", "z")
    assert len(read()) == 5, "a second run adds nothing"
    own = lake.table(QUARANTINE_TABLE).filter("indicator = 'd'")
    new = quarantined(lake, "d", "q").withColumn("digest", F.xxhash64(*identity))
    plan = merge.new_by_digest(new, own, identity, "digest")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("indicator" in scan.split("PartitionFilters")[1] for scan in scans)
    assert any("ReadSchema: struct<digest:bigint>" in scan for scan in scans), "digests settle it without texts"


def test_equal_digests_of_different_records_are_told_apart(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "raw STRING, digest LONG")
    existing = rows(("a", 1), ("b", 2), (None, 3))
    batch = rows(("a", 1), ("other", 1), ("c", 4), (None, 3), ("d", 3))
    new = merge.new_by_digest(batch, existing, ["raw"], "digest").collect()
    assert sorted(r["raw"] for r in new) == ["c", "d", "other"]


def test_append_new_skips_what_is_stored_but_keeps_repeats(lake):
    tables.ensure_table(lake, "silver.log", "raw STRING, at INT")
    rows = lambda *r: lake.createDataFrame(list(r), "raw STRING, at INT")
    tables.append_new(lake, "silver.log", rows(("x", 1), ("x", 1), ("y", 1)), ["raw"])
    tables.append_new(lake, "silver.log", rows(("x", 2), ("z", 2)), ["raw"])
    assert sorted((r["raw"], r["at"]) for r in lake.table("silver.log").collect()) == [
        ("x", 1), ("x", 1), ("y", 1), ("z", 2),
    ]


def test_watermarks_update_two_columns_and_may_move_back(lake):
    update = lambda *r: lake.createDataFrame(list(r), "indicator STRING, last_end STRING, updated_at TIMESTAMP")
    tables.upsert_watermarks(lake, update(("a", "2024-01-31T23:59", datetime(2024, 2, 1)), ("b", "2024-01-31T23:59", datetime(2024, 2, 1))))
    tables.upsert_watermarks(lake, update(("a", "2023-12-31T23:59", datetime(2024, 2, 2)), ("c", "2024-03-31T23:59", datetime(2024, 2, 2))))
    assert sorted(tuple(r) for r in lake.table(WATERMARK_TABLE).collect()) == [
        ("a", "2023-12-31T23:59", datetime(2024, 2, 2)),
        ("b", "2024-01-31T23:59", datetime(2024, 2, 1)),
        ("c", "2024-03-31T23:59", datetime(2024, 2, 2)),
    ]


def test_merge_updates_only_the_named_columns(spark):
    target = spark.createDataFrame([("a", 1, "keep"), ("b", 2, "keep")], "k STRING, v INT, w STRING")
    new = spark.createDataFrame([("a", 10, "new"), ("c", 30, "new")], "k STRING, v INT, w STRING")
    merged = merge.merge_by_key(target, new, ["k"], update=["v"])
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 10, "keep"), ("b", 2, "keep"), ("c", 30, "new")]


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    unique = merge.latest_by_key(df, ["k"], [F.desc("v")])
    assert sorted((r["k"], r["v"]) for r in unique.collect()) == [(0, 99), (1, 97), (2, 98)]
    plan = unique._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:], "a partial limit sits below the exchange"


def test_staging_lives_in_the_shared_folder_and_is_dropped(spark):
    with staged(spark.range(4)) as df:
        assert df.count() == 4
        assert shared_folder(spark) in df.select(F.input_file_name()).first()[0]
        name = spark.sql("SHOW TABLES IN gridmetrics_stage").first()["tableName"]
    assert not spark.catalog.tableExists(f"gridmetrics_stage.{name}")


def test_landing_replaces_exactly_its_months(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = lambda *r: spark.createDataFrame(list(r), "indicator STRING, year INT, month INT, value STRING")
    landing.land(rows(("d", 2024, 1, "{\n1}"), ("d", 2024, 2, "{2}"), ("g", 2024, 1, "{3}")), root)
    paths = landing.land(rows(("d", 2024, 2, "\ufeff{22}")), root)
    assert paths == [landing.raw_path(root, "d", date(2024, 2, 1))]
    read = lambda *a: sorted((r["file"][-len("d_202401.json") :], r["value"].strip()) for r in landing.read_landed(spark, root, *a).collect())
    assert read("d") == [("d_202401.json", "{\n1}"), ("d_202402.json", "{22}")]
    assert read("d", [date(2024, 2, 1)]) == [("d_202402.json", "{22}")]
    assert read("g") == [("g_202401.json", "{3}")]
    with pytest.raises(ValueError, match="two envelopes"):
        landing.land(rows(("d", 2024, 2, "{4}"), ("d", 2024, 2, "{5}")), root)
    assert read("d") == [("d_202401.json", "{\n1}"), ("d_202402.json", "{22}")]


def test_whole_files_with_and_without_a_bom(spark, tmp_path):
    for month, text in ((1, "﻿{\"a\":\n 1}"), (2, "{\"a\": 2}")):
        path = landing.raw_path(str(tmp_path), "d", date(2024, month, 1))
        target = tmp_path / "d" / "2024" / f"{month:02d}"
        target.mkdir(parents=True)
        (target / path.rsplit("/", 1)[1]).write_text(text, encoding="utf-8")
    every = landing.read_landed(spark, str(tmp_path), "d")
    assert {r["value"] for r in every.collect()} == {'{"a": 2}', '{"a":\n 1}'}
    one = landing.read_landed(spark, str(tmp_path), "d", [date(2024, 2, 1)])
    assert [r["file"].rsplit("/", 1)[1] for r in one.collect()] == ["d_202402.json"]
