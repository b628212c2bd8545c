"""Envelopes -> typed rows and quarantine records, with one shuffle of raw series.

A file is exploded into its series, the series are dealt over the cluster by file and position, and
each is exploded into its entries; every entry becomes one record whose ``kind`` says what it is.
That one shuffle of raw text spreads a huge file, or many small ones that one task reads, over all
cores; all typing comes after it. The price grain is worked out where a series was dealt to.

* ``row``: a typed observation;
* ``quarantine``: something that could not be typed, with its raw JSON and a reason;
* ``unusable``: a file whose envelope cannot be read at all.

Range problems (a negative demand, a wild price) are rows: judging values is the gate's job.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.functions import dates, grain, json_values
from gridmetrics.spec import (
    AGGREGATE_TITLES,
    AGGREGATE_TYPES,
    DEMAND,
    GENERATION,
    PRICES,
    RENEWABLE_TYPE,
    TECHNOLOGY_TYPES,
    spec_for,
)

ROW, QUARANTINE, UNUSABLE = "row", "quarantine", "unusable"
POSITION = ("file", "series_pos", "entry_pos")


class Parsed(NamedTuple):
    """The outputs of a parse; all three read the same plan."""

    rows: DataFrame
    quarantined: DataFrame
    unusable: DataFrame


def _stand_in() -> Column:
    """One NULL text: explodes to the single record of a rejected file or series."""
    return F.array(F.lit(None).cast("string"))


def _each(array: str) -> Column:
    """Explode without the size filter Spark infers for a plain column.

    That filter is pushed below the projection that decodes the JSON and would decode every
    series twice.
    """
    return F.posexplode(F.coalesce(F.col(array), F.slice(F.col(array), 1, 0)))


def explode_series(files: DataFrame) -> DataFrame:
    """``(file, value)`` -> one row per series: its text, decoded head and raw entries.

    ``problem`` is set where the file as a whole is unusable: no ``included`` list, a series
    that is not an object, or attributes that are present but not an object. Absent
    attributes are an empty object. ``head`` has the variant title, type and flag and the
    entries as JSON texts; entries are NULL where ``values`` is absent or not a list, so such
    a series has no record. An unusable file gets one stand-in entry to carry its problem.
    """
    included = F.from_json("value", "included array<string>")["included"]
    series = files.select(
        "file", F.posexplode(F.coalesce(included, _stand_in())).alias("series_pos", "series")
    )
    series = series.repartition("file", "series_pos")
    head = F.from_json(
        "series",
        "attributes struct<title variant, type variant, composite variant, values array<string>>",
    )["attributes"]
    series = series.withColumn("head", head)
    text = F.col("series")
    present = F.array_contains(F.json_object_keys(text), "attributes")
    problem = (
        F.when(text.isNull(), "no 'included' series array")
        .when(~text.startswith("{"), "series is not an object")
        .when(F.col("head").isNull() & present, "series attributes are not an object")
    )
    return series.withColumn("problem", problem).withColumn(
        "entries", F.when(F.col("problem").isNull(), F.col("head")["values"]).otherwise(_stand_in())
    )


def is_aggregate(composite: Column, title: Column, kind: Column) -> Column:
    """Flag, title or type marks a known aggregate; no signal can veto another."""
    return (
        json_values.flag_is_true(composite)
        | F.coalesce(json_values.normalized(title).isin(*AGGREGATE_TITLES), F.lit(False))
        | F.coalesce(kind.isin(*AGGREGATE_TYPES), F.lit(False))
    )


def is_technology(kind: Column) -> Column:
    """Whether the series is typed as a real technology; never NULL."""
    return F.coalesce(kind.isin(*TECHNOLOGY_TYPES), F.lit(False))


# An entry is typed in four steps. Each takes the previous step's struct, so that nothing is
# evaluated twice and no generated method grows beyond what the JVM compiles.


def _open(raw: Column) -> Column:
    return F.struct(raw.alias("raw"), F.from_json(raw, "datetime variant, value variant").alias("e"))


def _fields(opened: Column) -> Column:
    moment, value = opened["e"]["datetime"], opened["e"]["value"]
    return F.struct(
        opened["raw"].alias("raw"),
        json_values.json_type(moment).alias("moment_type"),
        F.try_variant_get(moment, "$", "string").alias("moment"),
        json_values.json_type(value).alias("value_type"),
        json_values.as_double(value).alias("number"),
        value.alias("value"),
    )


def _spelled(fields: Column) -> Column:
    # Getting a text out of a variant is dear: each text once, and a value's only where a reason shows it.
    plain = json_values.is_number_type(fields["value_type"]) & _finite(fields["number"])
    value_text = F.when(~F.coalesce(plain, F.lit(False)), F.try_variant_get(fields["value"], "$", "string"))
    return F.struct(
        *[fields[name].alias(name) for name in ("raw", "moment_type", "moment", "value_type", "number")],
        value_text.alias("value_text"),
        dates.iso_text(F.when(fields["moment_type"] == "STRING", fields["moment"])).alias("iso"),
    )


def _finite(number: Column) -> Column:
    return ~F.isnan(number) & (F.abs(number) < float("inf"))


def _typed(fields: Column) -> Column:
    return F.struct(
        *[fields[name].alias(name) for name in ("raw", "moment_type", "moment", "value_type", "number", "value_text")],
        dates.instant(fields["iso"]).alias("instant"),
        dates.written_date(fields["iso"]).alias("day"),
    )


def entry_problem(entry: Column) -> Column:
    """Why an entry cannot be typed, else NULL. The datetime is judged before the value."""
    shown = lambda text: F.coalesce(text, F.lit("null"))
    finite = _finite(entry["number"])
    return (
        F.when(~F.coalesce(entry["raw"].startswith("{"), F.lit(False)), "entry is not an object")
        .when(entry["moment_type"].isNull(), "missing datetime")
        .when(entry["moment_type"] != "STRING", F.concat(F.lit("non-string datetime "), shown(entry["moment"])))
        .when(entry["instant"].isNull(), F.concat(F.lit("not an ISO 8601 datetime: "), entry["moment"]))
        .when(entry["value_type"].isNull(), "missing value")
        .when(
            ~json_values.is_number_type(entry["value_type"]),
            F.concat(F.lit("non-numeric value "), shown(entry["value_text"])),
        )
        .when(entry["number"].isNull() | ~finite, F.concat(F.lit("value is not finite: "), shown(entry["value_text"])))
    )


def _explode_entries(series: DataFrame, kept: list[str]) -> DataFrame:
    """One row per raw entry, typed with plain (code-generated) columns."""
    exploded = series.select(*kept, _each("entries").alias("entry_pos", "text"))
    step = exploded.select(*kept, "entry_pos", _open(F.col("text")).alias("x"))
    step = step.select(*kept, "entry_pos", _fields(F.col("x")).alias("x"))
    step = step.select(*kept, "entry_pos", _spelled(F.col("x")).alias("x"))
    step = step.select(*kept, "entry_pos", _typed(F.col("x")).alias("x"))
    return step.select(*kept, "entry_pos", "x", entry_problem(F.col("x")).alias("entry_problem"))


def _records(
    entries: DataFrame,
    indicator: str,
    prefix: Column | None = None,
    whole_series: tuple[Column, Column] | None = None,
    **columns: Column,
) -> DataFrame:
    """Entries -> records. ``whole_series`` is (raw, reason) of a series rejected as one."""
    file_problem, problem = F.col("problem"), F.col("entry_problem")
    raw = F.coalesce(F.col("x")["raw"], F.lit("null"))
    reason = problem if prefix is None else F.concat(prefix, F.lit(": "), problem)
    bad = problem.isNotNull()
    if whole_series is not None:
        rejected = whole_series[1].isNotNull()
        raw = F.when(rejected, whole_series[0]).otherwise(raw)
        reason = F.when(rejected, whole_series[1]).otherwise(reason)
        bad = bad | rejected
    return entries.select(
        *POSITION,
        F.when(file_problem.isNotNull(), UNUSABLE).when(bad, QUARANTINE).otherwise(ROW).alias("kind"),
        F.lit(indicator).alias("indicator"),
        F.when(file_problem.isNull() & bad, raw).alias("raw"),
        F.when(file_problem.isNotNull(), file_problem).when(bad, reason).alias("reason"),
        *[value.alias(name) for name, value in columns.items()],
    )


def demand_records(files: DataFrame) -> DataFrame:
    """Every entry of every series, keyed on the civil date it states."""
    series = explode_series(files)
    entries = _explode_entries(series, ["file", "series_pos", "problem"])
    x = F.col("x")
    return _records(entries, DEMAND, date=x["day"], value=x["number"])


def generation_series(files: DataFrame) -> DataFrame:
    """Series with their triage: aggregate, technology or unknown."""
    head = F.col("head")
    # Texts first, each once: everything after reads the columns.
    series = explode_series(files).withColumns(
        {"technology": json_values.text_or_null(head.title), "type_text": json_values.text_or_null(head.type)}
    )
    title, kind = F.col("technology"), F.col("kind")
    series = series.withColumn("kind", json_values.normalized(F.col("type_text")))
    return series.withColumns(
        {
            "triage": F.when(is_aggregate(head.composite, title, kind), "aggregate")
            .when(is_technology(kind) & title.isNotNull(), "technology")
            .otherwise("unknown"),
            # The raw, un-normalised type decides: "renovable" is a technology, not renewable.
            "is_renewable": F.coalesce(F.col("type_text") == RENEWABLE_TYPE, F.lit(False)),
        }
    ).drop("type_text", "kind")


def generation_records(files: DataFrame) -> DataFrame:
    """Technology series by entry; unknown series as one quarantine record each."""
    head = F.col("head")
    shown = lambda value: F.coalesce(F.to_json(value), F.lit("null"))
    unknown = F.col("triage") == "unknown"
    # Only a rejected series carries its text through the explode.
    series = generation_series(files).withColumns(
        {
            "rejected_raw": F.when(
                unknown, F.coalesce(F.get_json_object("series", "$.attributes"), F.lit("{}"))
            ),
            "rejected_reason": F.when(
                unknown,
                F.concat(
                    F.lit("unrecognised generation series: title="), shown(head.title),
                    F.lit(" type="), shown(head.type),
                ),
            ),
        }
    )
    kept_entries = (
        F.when(F.col("problem").isNotNull() | unknown, _stand_in())
        .when(F.col("triage") == "technology", F.col("entries"))
    )
    entries = _explode_entries(
        series.withColumn("entries", kept_entries),
        ["file", "series_pos", "problem", "technology", "is_renewable", "rejected_raw", "rejected_reason"],
    )
    x = F.col("x")
    return _records(
        entries,
        GENERATION,
        F.col("technology"),
        (F.col("rejected_raw"), F.col("rejected_reason")),
        date=x["day"],
        technology=F.col("technology"),
        is_renewable=F.col("is_renewable"),
        value=x["number"],
    )


def price_records(files: DataFrame) -> DataFrame:
    """Entries of every titled series, with the grain of their own file and series.

    Only entries that type feed the grain. A series without a string title is skipped.
    """
    series = explode_series(files).withColumn(
        "series", json_values.text_or_null(F.col("head").title)
    )
    # Untitled series lose their entries instead of being filtered: a filter would be pushed
    # below the projection that decodes the title and decode it twice.
    wanted = F.col("series").isNotNull() | F.col("problem").isNotNull()
    series = series.withColumn("entries", F.when(wanted, F.col("entries")))
    kept = ["file", "series_pos", "problem", "series"]
    typed = _explode_entries(series, kept)
    # The series were dealt by these keys, so gathering a series again moves nothing.
    whole = typed.groupBy(*kept).agg(
        F.collect_list(F.struct("entry_pos", "x", "entry_problem")).alias("xs")
    )
    good = F.filter("xs", lambda entry: entry["entry_problem"].isNull())
    instants = F.transform(good, lambda entry: entry["x"]["instant"])
    entries = whole.withColumn("period_minutes", grain.modal_minutes(instants)).select(
        *kept, "period_minutes", F.inline("xs")
    )
    x = F.col("x")
    return _records(
        entries,
        PRICES,
        F.col("series"),
        datetime_utc=x["instant"],
        series=F.col("series"),
        value=x["number"],
        period_minutes=F.col("period_minutes"),
    )


RECORDS = {DEMAND: demand_records, GENERATION: generation_records, PRICES: price_records}


def unusable_files(files: DataFrame) -> DataFrame:
    """``(file, problem)`` for every file whose envelope cannot be read."""
    return explode_series(files).filter(F.col("problem").isNotNull()).select("file", "series_pos", "problem")


def all_records(files: DataFrame, indicator: str) -> DataFrame:
    """Rows, quarantine and unusable files of one indicator in one pass over the files."""
    return RECORDS[spec_for(indicator).name](files)


def split(records: DataFrame, staged: bool = True) -> Parsed:
    """Split records by kind. Rows keep their position for a deterministic de-duplication.

    Staged records are filtered plainly, which reaches the file scan. Over an unstaged plan
    a filter on ``kind`` would be pushed below the projections that type an entry, and every
    entry would be typed twice; exploding one-or-no structs keeps it above them.
    """
    typed = [name for name in records.columns if name not in (*POSITION, "kind", "indicator", "raw", "reason")]

    def of_kind(kind: str, *columns: str) -> DataFrame:
        chosen = F.col("kind") == kind
        if staged:
            return records.filter(chosen).select(*columns)
        return records.select(F.inline(F.when(chosen, F.array(F.struct(*columns)))))

    return Parsed(
        rows=of_kind(ROW, *typed, *POSITION),
        quarantined=of_kind(QUARANTINE, "raw", "indicator", "reason"),
        unusable=of_kind(UNUSABLE, "file", "reason").withColumnRenamed("reason", "problem"),
    )


def parse(files: DataFrame, indicator: str) -> Parsed:
    """Parse envelopes of one indicator lazily; an unknown indicator is an error."""
    return split(all_records(files, indicator), staged=False)
