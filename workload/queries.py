"""Every registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.functions.dates import year_month
from gridmetrics.operators import checks, grain, marts, measures, merge, parse, reports, star, summaries, work_plan
from gridmetrics.operators.calendar import calendar, date_bounds
from gridmetrics.plans import gate
from gridmetrics.session import configure
from gridmetrics.sources import landing, tables
from gridmetrics.sources.landing import without_bom
from gridmetrics.sources.staging import scratch_folder, scratch_schema, written
from gridmetrics.spec import DEMAND, FRESHNESS_LAG_DAYS, GENERATION, PRICES
from workload import envelopes, standins

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The days the queries treat as "today", splits between loads, chosen months.
FLOOR = date(2001, 11, 3)
AS_OF = date(2001, 8, 10)
LOAD_SPLIT = datetime(1998, 7, 1)
WATERMARK_SPLIT = datetime(2001, 10, 25)
PROOF_MONTH = (1999, 3)
TECHNOLOGY = "PROMO"
SERIES = "click"
LINE_KEY = ["l_orderkey", "l_linenumber"]
SMALL_QUANTITY = 10
FIRST_RUN, SECOND_RUN = datetime(2001, 11, 3, 6), datetime(2001, 11, 4, 6)


def query(function: Query) -> Query:
    """Register under the function's own name; settings are applied when it is called."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def naive(df: DataFrame, *instants: str) -> DataFrame:
    """Instants as zone-less UTC values, the form the test tables use."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


def gold_objects(spark: SparkSession, sf_dir: str) -> standins.Gold:
    return standins.Gold(spark, sf_dir)


# --- envelopes -> typed rows ------------------------------------------------------------


@query
def parse_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse(envelopes.demand_orders(spark, sf_dir), DEMAND).rows.select("date", "value")


@query
def quarantine_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = parse.parse(envelopes.demand_orders(spark, sf_dir), DEMAND).quarantined
    return rejected.select(
        "indicator", "reason", F.get_json_object("raw", "$.percentage").cast("long").alias("order_key")
    )


@query
def parse_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.parse(envelopes.generation_months(spark, sf_dir), GENERATION).rows
    return rows.select("date", "technology", "is_renewable", "value")


@query
def parse_generation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technology rows from one file per line item, totalled per type as written."""
    rows = parse.parse(envelopes.generation_lines(spark, sf_dir), GENERATION).rows
    totals = rows.groupBy("technology", "is_renewable", F.year("date").alias("year"))
    return totals.agg(F.count(F.lit(1)).alias("n_rows"), standins.exact_sum("value").alias("value"))


@query
def quarantine_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = parse.parse(envelopes.generation_lines(spark, sf_dir), GENERATION).quarantined
    reference = F.coalesce(
        F.get_json_object("raw", "$.magnitude"), F.get_json_object("raw", "$.percentage")
    )
    return rejected.select("reason", reference.alias("line_ref"))


@query
def landed_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month files written to a landing zone, with byte-order marks, read back and parsed."""
    month = F.to_date(F.regexp_extract("file", r"(\d{6})", 1), "yyyyMM")
    root = f"{scratch_folder(spark)}/raw_{uuid.uuid4().hex}"
    files = envelopes.generation_months(spark, sf_dir).select(
        F.lit(GENERATION).alias("indicator"), F.year(month).alias("year"), F.month(month).alias("month"),
        F.concat(F.lit("\ufeff"), "value").alias("value"),
    )
    landing.land(files, root)
    rows = parse.parse(landing.read_landed(spark, root, GENERATION), GENERATION).rows
    return rows.select("date", "technology", "is_renewable", "value")


@query
def parse_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.parse(without_bom(envelopes.price_days(spark, sf_dir)), PRICES).rows
    return naive(rows.select("datetime_utc", "series", "value", "period_minutes"), "datetime_utc")


@query
def quarantine_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = parse.parse(without_bom(envelopes.price_days(spark, sf_dir)), PRICES).quarantined
    return rejected.groupBy("indicator", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def unusable_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.unusable_files(envelopes.customer_files(spark, sf_dir)).select("file", "problem")


@query
def mv_renewables_share_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: monthly files -> parse and triage -> silver rows -> star -> monthly share."""
    parsed = parse.parse(envelopes.generation_months(spark, sf_dir), GENERATION).rows
    rows = written(parsed.select("date", "technology", "is_renewable", "value"))
    return marts.monthly_renewables_share(star.fact_generation(rows), star.dim_technology(rows))


@query
def modal_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain of each (series, UTC month) over all events."""
    prices = standins.price(spark, sf_dir).withColumn("month", year_month(F.col("datetime_utc")))
    return grain.modal_grain(prices, ["series", "month"], "datetime_utc")


# --- natural-key operators --------------------------------------------------------------


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.to_date("l_shipdate").alias("l_shipdate"),
    )


def newest_line() -> list:
    return [F.desc(name) for name in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")]


def loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The lines of an earlier and a later load, each unique on the key."""
    later = F.col("l_shipdate") >= F.lit(LOAD_SPLIT.date())
    everything = lines(spark, sf_dir)
    unique = lambda df: merge.latest_by_key(df, LINE_KEY, newest_line())
    return unique(everything.filter(~later)), unique(everything.filter(later))


@query
def dedupe_natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.latest_by_key(lines(spark, sf_dir), LINE_KEY, newest_line())


@query
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later load first, then the earlier one, reduced and written once, upserted over it."""
    earlier, later = loads(spark, sf_dir)
    return merge.merge_by_key(later, written(earlier), LINE_KEY)


def line_table(spark: SparkSession, sf_dir: str) -> str:
    """A monthly catalog table with all lines, put there by the upsert sink."""
    table, rows = f"{scratch_schema(spark)}.lines", lines(spark, sf_dir)
    columns = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    tables.ensure_table(spark, table, columns, monthly=True)
    tables.upsert(spark, table, rows, [*LINE_KEY, "l_shipdate"], "l_shipdate", newest_line())
    return table


@query
def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines in a catalog table, then those of later months with a doubled quantity over them."""
    table = line_table(spark, sf_dir)
    later = lines(spark, sf_dir).filter(F.col("l_shipdate") >= F.lit(LOAD_SPLIT.date()))
    doubled = later.withColumn("l_quantity", 2 * F.col("l_quantity"))
    tables.upsert(spark, table, doubled, [*LINE_KEY, "l_shipdate"], "l_shipdate", newest_line())
    return tables.read_table(spark, table)


@query
def sink_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines in a catalog table, less those of small quantity."""
    table = line_table(spark, sf_dir)
    tables.delete_rows(spark, table, F.col("l_quantity") < SMALL_QUANTITY)
    return tables.read_table(spark, table)


@query
def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch twice: the second run changes nothing."""
    earlier, later = loads(spark, sf_dir)
    return merge.merge_by_key(merge.merge_by_key(earlier, later, LINE_KEY), later, LINE_KEY)


@query
def quarantine_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log entries of later events not logged before, repeats within the batch kept."""
    logged = standins.events(spark, sf_dir).select(
        F.col("event_type").alias("indicator"), F.col("props").alias("raw"), "user_id",
        F.to_date("datetime_utc").alias("day"),
    )
    split = F.lit(AS_OF)
    return merge.new_only(
        logged.filter(F.col("day") >= split),
        logged.filter(F.col("day") < split),
        ["indicator", "raw", "user_id"],
    )


@query
def delete_by_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.delete_where(standins.generation(spark, sf_dir), F.col("technology") == TECHNOLOGY)


def line_watermarks(df: DataFrame, updated_at: datetime) -> DataFrame:
    return df.groupBy(F.concat(F.lit("supplier_"), "l_suppkey").alias("indicator")).agg(
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd'T'23:59").alias("last_end")
    ).withColumn("updated_at", F.lit(updated_at).cast("timestamp"))


@query
def watermark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier watermarks of all shipments before a day, updated by those from that day on."""
    shipped = standins.table(spark, sf_dir, "lineitem")
    known = line_watermarks(shipped.filter(F.col("l_shipdate") < F.lit(WATERMARK_SPLIT.date())), datetime(1995, 1, 11))
    new = line_watermarks(shipped.filter(F.col("l_shipdate") >= F.lit(WATERMARK_SPLIT.date())), datetime(2001, 12, 1))
    merged = merge.merge_by_key(known, new, ["indicator"], update=["last_end", "updated_at"])
    return naive(merged, "updated_at")


@query
def sink_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a stored table, as two runs leave it."""
    shipped, split = standins.table(spark, sf_dir, "lineitem"), F.lit(WATERMARK_SPLIT.date())
    table = f"{scratch_schema(spark)}.watermarks"
    for when, at in ((F.col("l_shipdate") < split, datetime(1995, 1, 11)), (F.col("l_shipdate") >= split, datetime(2001, 12, 1))):
        tables.upsert_watermarks(spark, line_watermarks(shipped.filter(when), at), table)
    return naive(spark.table(table), "updated_at")


# --- star -------------------------------------------------------------------------------


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_objects(spark, sf_dir).dim_date


@query
def dim_technology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_objects(spark, sf_dir).dim_technology


@query
def fact_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_objects(spark, sf_dir).demand


@query
def fact_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_objects(spark, sf_dir).generation


@query
def fact_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(gold_objects(spark, sf_dir).price, "datetime_utc")


# --- marts, proofs, repair --------------------------------------------------------------


def share_of(objects: standins.Gold) -> DataFrame:
    return marts.monthly_renewables_share(objects.generation, objects.dim_technology)


def share_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_of(gold_objects(spark, sf_dir))


@query
def mv_renewables_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_mart(spark, sf_dir)


@query
def mv_avg_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.monthly_avg_price(gold_objects(spark, sf_dir).price)


def updated_by_month(spark: SparkSession, rows: DataFrame, summarise, moment: str) -> DataFrame:
    """Month summaries stored before LOAD_SPLIT, then brought up to date for the months from then on."""
    table = f"{scratch_schema(spark)}.months"
    before = rows.filter(F.col(moment) < F.lit(LOAD_SPLIT))
    tables.rebuild(spark, table, summarise(before))
    touched = rows.filter(F.col(moment) >= F.date_trunc("month", F.lit(LOAD_SPLIT)))
    fresh = written(summarise(touched))
    months = [r[0] for r in fresh.select(tables.MONTH).distinct().collect()]
    tables.replace_months(spark, table, fresh, months)
    return tables.months_of(spark, table)


@query
def mv_share_by_month_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share mart from stored month summaries, only the later months summed again."""
    rows = standins.generation(spark, sf_dir)
    months = updated_by_month(spark, rows, summaries.generation_months, "date")
    return marts.share_of_summaries(months, star.dim_technology(months))


@query
def mv_avg_price_by_month_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price mart in the same way; a civil month meets two storage months."""
    months = updated_by_month(spark, gold_objects(spark, sf_dir).price, summaries.price_months, "datetime_utc")
    return marts.avg_price_of_summaries(months)


@query
def gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts are counted from their days, so each is scanned once."""
    objects = gold_objects(spark, sf_dir)
    days = objects.days
    return reports.row_counts(
        {
            "gold.dim_date": objects.dim_date,
            "gold.dim_indicator": star.dim_indicator(spark),
            "gold.dim_technology": objects.dim_technology,
            "gold.mlv_monthly_avg_price": days.price.select(F.year("date"), F.month("date"), "series").distinct(),
            "gold.mlv_monthly_renewables_share": share_of(objects),
        },
        {
            "gold.fact_demand_daily": days.demand,
            "gold.fact_generation_daily": days.generation,
            "gold.fact_price_hourly": days.price,
        },
    )


@query
def calendar_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days missing from the demand fact taken as a calendar, and from the real calendar."""
    objects = gold_objects(spark, sf_dir)
    labelled = lambda df, name: reports.calendar_gap(df).withColumn("calendar", F.lit(name))
    return labelled(objects.dim_date, "dim_date").unionByName(labelled(objects.demand, "loaded demand days"))


@query
def orphan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation days without any demand day: orphans of a calendar made from demand."""
    objects = gold_objects(spark, sf_dir)
    return reports.orphans(objects.generation, objects.demand, "date")


@query
def star_join_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.star_month(gold_objects(spark, sf_dir), *PROOF_MONTH)


@query
def latest_12_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_months(share_mart(spark, sf_dir))


@query
def technology_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.technology_damage(standins.generation(spark, sf_dir), TECHNOLOGY)


@query
def ratio_recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_ratio(
        standins.generation(spark, sf_dir), standins.demand(spark, sf_dir), AS_OF
    )


# --- quality ----------------------------------------------------------------------------


def verdict_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts recorded by earlier runs: one per year of demand and generation days and
    one per day of events."""
    def recorded(df: DataFrame, table: str, period: str, run_ts) -> DataFrame:
        return df.groupBy(period).agg(F.count(F.lit(1)).cast("double").alias("observed")).select(
            run_ts.cast("timestamp").alias("run_ts"), F.lit("row_count").alias("check"),
            F.lit(table).alias("table"), F.lit("PASS").alias("status"), "observed",
        )

    next_year = F.make_date(F.col("period") + 1, F.lit(1), F.lit(1))
    yearly = lambda df: df.withColumn("period", F.year("date"))
    daily = standins.price(spark, sf_dir).withColumn("period", F.to_date("datetime_utc"))
    return (
        recorded(yearly(standins.demand(spark, sf_dir)), "silver.demand_daily", "period", next_year)
        .unionByName(recorded(yearly(standins.generation(spark, sf_dir)), "silver.generation_daily", "period", next_year))
        .unionByName(recorded(daily, "silver.price_hourly", "period", F.col("period")))
    )


def all_verdicts(spark: SparkSession, sf_dir: str, with_history: bool) -> DataFrame:
    known = checks.baselines(verdict_history(spark, sf_dir)) if with_history else None
    return checks.silver_verdicts(
        standins.demand(spark, sf_dir), standins.generation(spark, sf_dir),
        standins.price(spark, sf_dir), FLOOR, known,
    )


@query
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run: no baseline yet."""
    return rounded(all_verdicts(spark, sf_dir, False), 6, "observed")


@query
def dq_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing verdicts of a run that has a history."""
    failed = checks.failures(all_verdicts(spark, sf_dir, True))
    return rounded(failed, 6, "observed").select("check", "table", "column", "observed", "threshold")


@query
def dq_row_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest recorded row count of each table."""
    return checks.baselines(verdict_history(spark, sf_dir))


@query
def dq_ratio_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cross-table check per day: ratio and whether it is out of band."""
    days = reports.daily_ratio(
        standins.generation(spark, sf_dir), standins.demand(spark, sf_dir).filter("value > 0")
    )
    outside = (F.col("ratio") < checks.RATIO_LOW) | (F.col("ratio") > checks.RATIO_HIGH)
    return days.select("date", F.round("ratio", 6).alias("ratio"), outside.alias("out_of_band"))


@query
def dq_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = gold_objects(spark, sf_dir)
    return checks.star_verdicts(objects.days, objects.dim_date, objects.dim_technology, share_of(objects))


@query
def gate_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the gate, as stored: every verdict of a failing run is kept, and its row
    counts are the baseline of the next. ``raised`` is the number of failures each run reported."""
    judged = [
        written(build(spark, sf_dir)) for build in (standins.demand, standins.generation, standins.price)
    ]
    table, raised = f"{scratch_schema(spark)}.verdicts", F.lit(0)
    as_of = FLOOR + timedelta(days=FRESHNESS_LAG_DAYS)
    for at in (FIRST_RUN, SECOND_RUN):
        failed = 0
        try:
            gate.run_gate(spark, "silver", as_of, at, judged=judged, verdict_table=table)
        except gate.GateFailure as failure:
            failed = len(failure.failed)
        raised = F.when(F.col("run_ts") == F.lit(at).cast("timestamp"), failed).otherwise(raised)
    stored = tables.read_table(spark, table).withColumn("raised", raised.cast("long"))
    return rounded(naive(stored, "run_ts"), 6, "observed")


# --- measures and report ----------------------------------------------------------------


@query
def demand_by_month_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.demand_by_month(gold_objects(spark, sf_dir)), 2, "demand_mwh")


@query
def demand_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = measures.total_demand(gold_objects(spark, sf_dir), ("year", "quarter", "is_weekend"))
    return rounded(total, 2, "demand_mwh")


@query
def peak_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.peak_demand(gold_objects(spark, sf_dir))


@query
def demand_yoy_r12(spark: SparkSession, sf_dir: str) -> DataFrame:
    yoy = measures.demand_yoy_r12(gold_objects(spark, sf_dir))
    return rounded(rounded(yoy, 2, "current_mwh", "prior_mwh"), 6, "demand_yoy")


@query
def data_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.data_through(gold_objects(spark, sf_dir))


@query
def share_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measures.renewables_share(gold_objects(spark, sf_dir)), 6, "renewables_share")


@query
def share_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the year slicer set to two years."""
    chosen = F.col("year").isin(1996, 1998)
    return rounded(reports.share_by_month(gold_objects(spark, sf_dir), chosen), 6, "renewables_share")


@query
def generation_by_month_technology_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_month = reports.generation_by_month_technology(gold_objects(spark, sf_dir))
    return rounded(by_month, 2, "generation_mwh")


@query
def generation_by_year_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = measures.total_generation(gold_objects(spark, sf_dir), ("year", "renewable_label"))
    return rounded(total, 2, "generation_mwh")


@query
def avg_price_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of observations of one series by calendar month."""
    mean = measures.avg_price(gold_objects(spark, sf_dir), ("year", "month"), series=[SERIES])
    return rounded(mean, 6, "avg_price")


@query
def price_daily_avg30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the series slicer at one series."""
    return rounded(reports.price_by_date(gold_objects(spark, sf_dir), [SERIES]), 6, "avg_price", "avg_price_30d")


@query
def price_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.price_min_max(gold_objects(spark, sf_dir), series=None)


@query
def slicer_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.years(gold_objects(spark, sf_dir))


@query
def slicer_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.price_series(gold_objects(spark, sf_dir))


# --- drill ------------------------------------------------------------------------------


@query
def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.monthly_totals(gold_objects(spark, sf_dir).demand), 2, "demand_mwh")


@query
def share_one_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = reports.share_of_month(gold_objects(spark, sf_dir), *PROOF_MONTH)
    return rounded(share, 6, "renewables_share_pct")


@query
def top10_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(reports.top_prices(gold_objects(spark, sf_dir).price, SERIES), "datetime_utc")


@query
def latest_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(reports.latest_per_series(gold_objects(spark, sf_dir).price), "datetime_utc")


@query
def rolling7_daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolling = reports.rolling_daily_mean(gold_objects(spark, sf_dir).price, SERIES)
    return rounded(rolling, 6, "rolling_avg_price")


# --- work planning ----------------------------------------------------------------------


@query
def calendar_of_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gapless calendar over the order dates alone."""
    orders = standins.table(spark, sf_dir, "orders")
    return calendar(date_bounds((orders, F.to_date("o_orderdate")))).select("date", "day_of_week")


@query
def plan_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part brand as a feed, over the whole range of order dates."""
    feeds = standins.table(spark, sf_dir, "part").select("p_brand").distinct().select(
        F.substring_index("p_brand", "#", -1).cast("int").alias("position"),
        F.concat(F.lit("brand/"), "p_brand").alias("indicator_path"),
        F.col("p_brand").alias("indicator_name"),
        F.lit("day").alias("time_trunc"),
    )
    day = F.to_date("o_orderdate")
    orders = standins.table(spark, sf_dir, "orders")
    plan = work_plan.backfill_plan(
        feeds, orders.select(F.min(day)).scalar(), orders.select(F.max(day)).scalar()
    )
    return plan.drop("window_start", "window_end")


@query
def plan_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a feed, resumed after its last shipment."""
    watermarks = line_watermarks(standins.table(spark, sf_dir, "lineitem"), datetime(2001, 12, 1))
    feeds = standins.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("position"),
        F.concat(F.lit("supplier/"), "s_suppkey").alias("indicator_path"),
        F.concat(F.lit("supplier_"), "s_suppkey").alias("indicator_name"),
        F.lit("hour").alias("time_trunc"),
    )
    return work_plan.daily_plan(feeds, watermarks, FLOOR).drop("window_start", "window_end")
