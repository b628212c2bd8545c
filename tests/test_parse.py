"""Envelope parsing: typing, triage, quarantine, grain."""

from __future__ import annotations

import contextlib
import io
import re
import json
from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmetrics.functions import dates, grain, json_values
from gridmetrics.operators import parse
from gridmetrics.operators.grain import modal_grain
from gridmetrics.spec import DEMAND, GENERATION, PRICES, spec_for
from tests.conftest import day, entry, envelope, series


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# --- demand ---------------------------------------------------------------------------


def test_demand_rows_keep_the_written_date(files):
    payload = envelope(
        series("Demanda", "Demanda", [
            entry(48210.5, "2024-01-01T00:00:00.000+01:00"),
            entry(1, "2024-07-02T00:00:00.000+02:00"),
        ]),
        series("Other", None, [entry(2.5, "2024-01-03")]),
    )
    parsed = parse.parse(files({"a": payload}), DEMAND)
    assert rows(parsed.rows, "date", "value") == [
        (date(2024, 1, 1), 48210.5), (date(2024, 1, 3), 2.5), (date(2024, 7, 2), 1.0),
    ]
    assert parsed.quarantined.count() == 0
    assert parsed.unusable.count() == 0


def test_demand_quarantines_structure_not_meaning(files):
    payload = envelope(
        series("Demanda", "Demanda", [
            entry(None, day("2024-05-07")), {"value": 2.25, "percentage": 1}, entry(-12.25, day("2024-05-09")),
        ])
    )
    parsed = parse.parse(files({"a": json.dumps(payload, indent=2)}), DEMAND)
    assert rows(parsed.rows, "date", "value") == [(date(2024, 5, 9), -12.25)]
    assert rows(parsed.quarantined, "reason") == [("missing datetime",), ("non-numeric value null",)]


def test_only_finite_json_numbers_are_values(files):
    text = '{"included":[{"attributes":{"values":[{"value":%s,"datetime":"2024-01-01"},{"value":7,"datetime":"2024-01-02"}]}}]}'
    rejected = ['"1.5"', "true", "null", "[1]", '{"a":1}', "NaN", "Infinity", "1e999", '"NaN"']
    parsed = parse.parse(files({raw: text % raw for raw in rejected}), DEMAND)
    assert rows(parsed.rows, "file", "value") == sorted((raw, 7.0) for raw in rejected)
    assert parsed.quarantined.count() == len(rejected)


def test_json_numbers_of_any_size(files):
    text = '{"included":[{"attributes":{"values":[{"value":%s,"datetime":"2024-01-01"}]}}]}'
    numbers = {"3": 3.0, "-0.25": -0.25, "1e3": 1000.0, "12345678901234567890123456789012345678901": 1.2345678901234568e40}
    parsed = parse.parse(files({raw: text % raw for raw in numbers}), DEMAND)
    assert {r["file"]: r["value"] for r in parsed.rows.collect()} == numbers


def test_datetime_is_judged_before_value(files):
    payload = envelope(series("D", "D", [entry("x", "junk"), entry("x", 5), {"value": None}, 7, None, "text"]))
    reasons = rows(parse.parse(files({"a": payload}), DEMAND).quarantined, "reason")
    assert reasons == [
        ("entry is not an object",), ("entry is not an object",), ("entry is not an object",),
        ("missing datetime",), ("non-string datetime 5",), ("not an ISO 8601 datetime: junk",),
    ]


def test_quarantined_raw_keeps_key_order_and_letters(files):
    text = '{"included":[{"attributes":{"values":[{"zeta":"Eólica","value":null,"alpha":1,"datetime":"2024-01-01"}]}}]}'
    raw = parse.parse(files({"a": text}), DEMAND).quarantined.first()["raw"]
    assert raw == '{"zeta":"Eólica","value":null,"alpha":1,"datetime":"2024-01-01"}'


def test_values_that_are_not_a_list_are_no_rows(files):
    payload = {"included": [
        {"attributes": {"title": "a", "type": "Renovable", "values": {"a": 1}}},
        {"attributes": {"title": "b", "type": "Renovable"}},
        {"attributes": {"title": "c", "type": "Renovable", "values": [entry(1, "2024-01-01")]}},
    ]}
    for indicator in (DEMAND, GENERATION, PRICES):
        parsed = parse.parse(files({"a": payload}), indicator)
        assert parsed.rows.count() == 1
        assert parsed.quarantined.count() == 0


# --- files ----------------------------------------------------------------------------


@pytest.mark.parametrize("indicator", [DEMAND, GENERATION, PRICES])
def test_unusable_files_are_listed_not_quarantined(files, indicator):
    parsed = parse.parse(
        files({
            "no list": {"data": {}},
            "not a list": {"included": {"a": 1}},
            "broken": '{"included":[',
            "top level list": '[{"included":[]}]',
            "series": {"included": [5]},
            "attributes null": {"included": [{"attributes": None}]},
            "attributes text": {"included": [{"attributes": "x"}]},
            "null series": {"included": [None]},
            "empty": {"included": []},
        }),
        indicator,
    )
    assert {r["file"] for r in parsed.unusable.collect()} == {
        "no list", "not a list", "broken", "top level list", "series",
        "attributes null", "attributes text", "null series",
    }
    assert parsed.rows.count() == 0
    assert parsed.quarantined.count() == 0


def test_absent_attributes_are_an_empty_object(files):
    payload = {"included": [{"type": "x"}]}
    assert parse.parse(files({"a": payload}), DEMAND).rows.count() == 0
    assert rows(parse.parse(files({"a": payload}), GENERATION).quarantined, "raw") == [("{}",)]
    assert parse.parse(files({"a": payload}), PRICES).quarantined.count() == 0


def test_unknown_indicator_is_an_error(files):
    with pytest.raises(ValueError, match="unknown indicator"):
        parse.parse(files({"a": envelope()}), "nope")
    assert spec_for(PRICES).key == ("datetime_utc", "series")


# --- generation -----------------------------------------------------------------------


def generation(aggregate_attributes: dict, title="Generación total", kind="Generación total"):
    values = [entry(10.0, day("2024-01-01")), entry(20.0, day("2024-01-02"))]
    total = series(title, kind, values, **aggregate_attributes)
    return envelope(
        series("Eólica", "Renovable", values, composite=False),
        series("Nuclear", "No-Renovable", values, composite=False),
        total,
    )


def test_generation_types_and_flags(files):
    parsed = parse.parse(files({"a": generation({"composite": True})}), GENERATION)
    assert rows(parsed.rows, "date", "technology", "is_renewable", "value") == [
        (date(2024, 1, 1), "Eólica", True, 10.0), (date(2024, 1, 1), "Nuclear", False, 10.0),
        (date(2024, 1, 2), "Eólica", True, 20.0), (date(2024, 1, 2), "Nuclear", False, 20.0),
    ]
    assert parsed.quarantined.count() == 0


#: Each JSON type with either truth, and what has no truth.
FLAGS = [kind(truth) for truth in (True, False) for kind in (bool, int, float, str)] + ["absent", None, [], {}]


def test_aggregate_is_dropped_under_every_flag(files):
    payloads = {
        repr(flag): generation({} if flag == "absent" else {"composite": flag}) for flag in FLAGS
    }
    parsed = parse.parse(files(payloads), GENERATION)
    assert {r["technology"] for r in parsed.rows.collect()} == {"Eólica", "Nuclear"}
    assert parsed.rows.count() == 4 * len(FLAGS)
    assert parsed.quarantined.count() == 0


def test_each_signal_alone_marks_the_aggregate(files):
    signals = [
        ("Generación total", "Renovable", False),
        ("  GENERACION TOTAL ", None, None),
        ("anything", "total", False),
        ("anything", "GENERACIÓN TOTAL", False),
        ("anything", "Renovable", "t"),
        (None, None, 2),
    ]
    payloads = {
        str(i): generation({"composite": flag}, title=title, kind=kind)
        for i, (title, kind, flag) in enumerate(signals)
    }
    parsed = parse.parse(files(payloads), GENERATION)
    assert {r["file"]: r["count"] for r in parsed.rows.groupBy("file").count().collect()} == {
        name: 4 for name in payloads
    }
    assert parsed.quarantined.count() == 0


def test_falsy_flags_keep_technologies(files):
    flags = [kind(False) for kind in (bool, int, float, str)] + ["n", None]
    payloads = {
        str(i): envelope(series("Eólica", "Renovable", [entry(1, day("2024-01-01"))], composite=flag))
        for i, flag in enumerate(flags)
    }
    assert parse.parse(files(payloads), GENERATION).rows.count() == len(flags)


def test_unknown_series_is_one_quarantine_record(files):
    values = [entry(1, day("2024-01-01")), entry(None, day("2024-01-02"))]
    payload = envelope(
        series("Baterías", "Almacenamiento", values),
        series(7, "Renovable", values),
    )
    parsed = parse.parse(files({"a": payload}), GENERATION)
    found = parsed.quarantined.collect()
    assert parsed.rows.count() == 0
    assert len(found) == 2
    assert any("Almacenamiento" in r["reason"] and "Baterías" in r["reason"] for r in found)
    assert {len(json.loads(r["raw"])["values"]) for r in found} == {2}


def test_renewable_flag_uses_the_raw_type(files):
    payload = envelope(
        series("a", "renovable", [entry(1, day("2024-01-01"))]),
        series("b", "Renovable", [entry(1, day("2024-01-01"))]),
        series("c", " NO-RENOVABLE", [entry(1, day("2024-01-01"))]),
    )
    parsed = parse.parse(files({"a": payload}), GENERATION)
    assert rows(parsed.rows, "technology", "is_renewable") == [("a", False), ("b", True), ("c", False)]


def test_bad_technology_entry_names_its_series(files):
    payload = envelope(series("Eólica", "Renovable", [entry("1.5", day("2024-01-01"))]))
    assert rows(parse.parse(files({"a": payload}), GENERATION).quarantined, "indicator", "reason") == [
        (GENERATION, "Eólica: non-numeric value 1.5")
    ]


# --- prices ---------------------------------------------------------------------------


def clock(start: datetime, minutes: int, n: int, offset="+02:00"):
    return [
        entry(1.0 + i, (start + timedelta(minutes=minutes * i)).isoformat(timespec="milliseconds") + offset)
        for i in range(n)
    ]


def test_grain_is_per_series_and_instants_are_utc(files):
    start = datetime(2025, 6, 1)
    payload = envelope(series("PVPC", "x", clock(start, 60, 24)), series("Spot", "x", clock(start, 15, 96)))
    parsed = parse.parse(files({"a": payload}), PRICES)
    assert rows(parsed.rows.groupBy("series", "period_minutes").count(), "series", "period_minutes", "count") == [
        ("PVPC", 60, 24), ("Spot", 15, 96),
    ]
    assert parsed.rows.agg(F.min("datetime_utc")).first()[0] == datetime(2025, 5, 31, 22)


def test_grain_survives_the_clock_change(files):
    # 25 local hours on the last Sunday of October: 02:00 occurs at +02:00 and at +01:00.
    hours = [entry(1, f"2024-10-27T{h:02d}:00:00.000+02:00") for h in range(3)]
    hours += [entry(1, f"2024-10-27T{h:02d}:00:00.000+01:00") for h in range(2, 24)]
    parsed = parse.parse(files({"a": envelope(series("PVPC", "x", hours))}), PRICES)
    assert parsed.rows.select("datetime_utc").distinct().count() == 25
    assert rows(parsed.rows.select("period_minutes").distinct(), "period_minutes") == [(60,)]


def test_grain_edge_cases(files):
    at = lambda text: entry(1, f"2024-01-01T{text}+00:00")
    payload = envelope(
        series("one", "x", [at("00:00:00")]),
        series("same", "x", [at("00:00:00"), at("00:00:00")]),
        series("seconds", "x", [at("00:00:00"), at("00:00:30"), at("00:01:00")]),
        series("tie", "x", [at("00:00:00"), at("00:15:00"), at("01:15:00"), at("01:20:00")]),
        series("later wins", "x", [at("00:00:00"), at("01:00:00"), at("01:05:00"), at("01:10:00")]),
        series("good only", "x", [at("00:00:00"), entry(None, "2024-01-01T00:01:00+00:00"), at("00:10:00")]),
        series(None, "x", [at("00:00:00"), entry("bad", "bad")]),
    )
    parsed = parse.parse(files({"a": payload}), PRICES)
    assert rows(parsed.rows.select("series", "period_minutes").distinct(), "series", "period_minutes") == [
        ("good only", 10), ("later wins", 5), ("one", 0), ("same", 0), ("seconds", 0), ("tie", 15),
    ]
    assert rows(parsed.quarantined, "reason") == [("good only: non-numeric value null",)]


def test_grain_is_per_file_and_series_occurrence(files):
    start = datetime(2025, 6, 1)
    payloads = {
        "a": envelope(series("S", "x", clock(start, 60, 3)), series("S", "x", clock(start, 5, 3))),
        "b": envelope(series("S", "x", clock(start, 30, 3))),
    }
    parsed = parse.parse(files(payloads), PRICES)
    found = parsed.rows.groupBy("file", "series_pos", "period_minutes").count()
    assert rows(found, "file", "series_pos", "period_minutes") == [("a", 0, 60), ("a", 1, 5), ("b", 0, 30)]


def expected_mode(instants):
    ordered = sorted(instants)
    gaps = [int((b - a).total_seconds() // 60) for a, b in zip(ordered, ordered[1:]) if b > a]
    return Counter(gaps).most_common(1)[0][0] if gaps else 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 2000), max_size=25), min_size=1, max_size=12))
def test_both_grain_operators_equal_a_plain_mode(spark, samples):
    start = datetime(2024, 1, 1)
    instants = [[start + timedelta(seconds=20 * s) for s in sample] for sample in samples]
    arrays = spark.createDataFrame(list(enumerate(instants)), "k INT, ts ARRAY<TIMESTAMP>")
    in_record = {r["k"]: r["m"] for r in arrays.select("k", grain.modal_minutes(F.col("ts")).alias("m")).collect()}
    assert in_record == {k: expected_mode(ts) for k, ts in enumerate(instants)}
    table = arrays.select("k", F.explode("ts").alias("ts"))
    in_table = {r["k"]: r["period_minutes"] for r in modal_grain(table, ["k"], "ts").collect()}
    assert in_table == {k: expected_mode(ts) for k, ts in enumerate(instants) if ts}


# --- functions ------------------------------------------------------------------------

MOMENTS = [
    "2024-01-01", "20240101", "2024-W01-1", "2024W011", "2024-W53", "2020-W53-7", "2024-W01",
    "2024-01-01T00", "2024-01-01 05:06", "2024-01-01x05:06:07,1234567+0130", "20240101T050607Z",
    "20240101T0506-02:30", "2024-01-01T05:06:07.5+01:00", "2024-01-01T05:06:07+01:00:30", "2024-6-1",
    "2024", "2024-01", "2024-02-30", "2024-01-01T24:00", "2024-01-01T0506:07", "2024-0101", "",
    "2024-01-01T", "2024-01-01T05:06:07.", "0000-01-01", "2024-001", "2024-01-01T05:06:60",
    "2024-01-01 ", " 2024-01-01", "２０２４-01-01", "2024-01-01T05:06z", "2024-W00-1", "2024-W10-8",
]


def test_iso_reading_agrees_with_the_standard_library(spark):
    iso = dates.iso_text(F.col("t"))
    got = {
        r["t"]: (r["i"], r["d"])
        for r in spark.createDataFrame([(m,) for m in MOMENTS], "t STRING")
        .select("t", dates.instant(iso).alias("i"), dates.written_date(iso).alias("d")).collect()
    }
    for moment in MOMENTS:
        try:
            stamp = datetime.fromisoformat(moment)
        except ValueError:
            assert got[moment][0] is None, moment
            continue
        utc = stamp.astimezone(timezone.utc).replace(tzinfo=None) if stamp.tzinfo else stamp
        assert got[moment] == (utc, stamp.date()), moment


def test_text_normalisation_and_flags(spark):
    df = spark.sql("select '\\u00a0 GENERACIÓN Total\\t' as t, parse_json('\"2\"') as s, parse_json('2') as n, cast(null as variant) as absent")
    row = df.select(
        json_values.normalized(F.col("t")).alias("t"),
        json_values.flag_is_true(F.col("s")).alias("s"),
        json_values.flag_is_true(F.col("n")).alias("n"),
        json_values.flag_is_true(F.col("absent")).alias("a"),
    ).first()
    assert tuple(row) == ("generacion total", False, True, False)


def test_series_are_dealt_once_and_typed_after_it(files):
    for indicator in (DEMAND, GENERATION, PRICES):
        parsed = parse.parse(files({"a": envelope()}), indicator)
        plan = parsed.rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        below = plan[plan.index("Exchange hashpartitioning(file") :]
        assert "variant" not in below, "only the list of series is decoded before they are dealt"
        assert "Python" not in plan


def test_no_generated_method_is_too_long_to_be_compiled(spark, files):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for indicator in (DEMAND, GENERATION, PRICES):
            records = parse.all_records(files({"a": envelope()}), indicator)
            with contextlib.redirect_stdout(io.StringIO()) as shown:
                records.explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
            assert sizes and max(sizes) < 8000, (indicator, sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_texts_are_taken_out_of_variants_once(spark):
    files = spark.createDataFrame([("f", '{"included":[]}')], "file string, value string")
    plan = parse.generation_records(files)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") <= 8, plan.count("try_variant_get(")


def test_reasons_show_the_value(spark):
    values = ["true", '"7"', "null", "1e400", "12.5", "[1]"]
    entries = ",".join('{"value":%s,"datetime":"2024-01-01"}' % v for v in values)
    text = '{"included":[{"attributes":{"title":"Eólica","type":"Renovable","values":[%s]}}]}' % entries
    parsed = parse.parse(spark.createDataFrame([("f", text)], "file string, value string"), GENERATION)
    assert [r.value for r in parsed.rows.collect()] == [12.5]
    reasons = sorted(r.reason.split(": ", 1)[1] for r in parsed.quarantined.collect())
    assert len(reasons) == 5 and "non-numeric value true" in reasons and "non-numeric value 7" in reasons
