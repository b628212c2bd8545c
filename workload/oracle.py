"""DuckDB SQL for the registered queries, computed straight from the test tables."""

from __future__ import annotations

DEMAND = """demand AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1)"""
GENERATION = """generation AS (
  SELECT CAST(l_shipdate AS DATE) AS date, p_type AS technology,
         p_type IN ('ECONOMY', 'PROMO', 'SMALL') AS is_renewable,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
PRICE = """price AS (
  SELECT datetime_utc,
         CAST((datetime_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid' AS DATE) AS date,
         series, period_minutes, value
  FROM (SELECT ts - INTERVAL 8200 DAY AS datetime_utc, event_type AS series,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS period_minutes, value
        FROM events))"""
CALENDAR = """bounds AS (
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT date AS d FROM demand UNION ALL SELECT date FROM generation UNION ALL SELECT date FROM price)),
dim_date AS (
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, isodow(d) >= 6 AS is_weekend
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM bounds))"""
TECHNOLOGY = """dim_technology AS (
  SELECT DISTINCT technology, is_renewable,
         CASE WHEN is_renewable THEN 'Renewable' ELSE 'Non-renewable' END AS renewable_label
  FROM generation)"""
SHARE = """share AS (
  SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         round(sum(CASE WHEN is_renewable THEN value ELSE 0 END), 3) AS renewable_mwh,
         round(sum(value), 3) AS total_mwh,
         round(100 * sum(CASE WHEN is_renewable THEN value ELSE 0 END) / sum(value), 2)
           AS renewables_share_pct
  FROM generation GROUP BY 1, 2)"""
AVG_PRICE = """avg_price AS (
  SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, series,
         round(avg(value), 2) AS avg_price_eur_mwh, count(*) AS n_observations
  FROM price GROUP BY 1, 2, 3)"""
RATIO = """ratio AS (
  SELECT d.date, g.produced / d.value AS ratio
  FROM (SELECT date, sum(value) AS produced FROM generation GROUP BY 1) g
  JOIN demand d ON d.date = g.date WHERE d.value > 0)"""
SECONDS = """seconds AS (
  SELECT series, datetime_utc, value,
         CAST((datetime_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid' AS DATE) AS day
  FROM (SELECT event_type AS series, date_trunc('second', ts - INTERVAL 8200 DAY) AS datetime_utc,
               max(value) AS value FROM events GROUP BY 1, 2))"""
LINES = """lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem)"""
ALL = (DEMAND, GENERATION, PRICE)
GOLD = (*ALL, CALENDAR, TECHNOLOGY)


def sql(ctes: tuple[str, ...], body: str) -> str:
    return f"WITH {', '.join(ctes)} {body}"


def modal(keys: str, points: str) -> str:
    """Most frequent whole-minute gap per key, ties to the first seen, as CTE ``grain``."""
    return f"""gaps AS (
  SELECT {keys}, seen, (us - seen) // 60000000 AS gap FROM (
    SELECT {keys}, us, lag(us) OVER (PARTITION BY {keys} ORDER BY us) AS seen
    FROM (SELECT DISTINCT {keys}, epoch_us(datetime_utc) AS us FROM {points})) WHERE seen IS NOT NULL),
grain AS (
  SELECT {keys}, CAST(gap AS INTEGER) AS period_minutes FROM (
    SELECT {keys}, gap, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, seen) AS rn FROM (
      SELECT {keys}, gap, count(*) AS n, min(seen) AS seen FROM gaps GROUP BY ALL)) WHERE rn = 1)"""


def newest(name: str, where: str, key: str = "l_orderkey, l_linenumber") -> str:
    """Newest line per key as CTE ``name``."""
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {key}
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
    FROM lines WHERE {where}) WHERE rn = 1)"""


def watermarks(where: str, updated_at: str) -> str:
    return f"""SELECT 'supplier_' || l_suppkey AS indicator,
  strftime(max(l_shipdate), '%Y-%m-%d') || 'T23:59' AS last_end, TIMESTAMP '{updated_at}' AS updated_at
  FROM lineitem WHERE {where} GROUP BY 1"""


def complete_months(source: str, extra: str, total: str) -> str:
    """Totals per month whose calendar end has been loaded."""
    return f"""SELECT c.year, c.month, {extra} round(sum(f.value), 2) AS {total}
  FROM {source} f JOIN dim_date c ON c.date = f.date
  JOIN (SELECT year, month, last_day(max(date)) AS period_end FROM dim_date GROUP BY 1, 2) e
    ON e.year = c.year AND e.month = c.month
  WHERE e.period_end <= (SELECT max(date) FROM {source})
  GROUP BY ALL"""


# (table, source, checked columns, out-of-range predicate, range text, newest day)
_SUITE = (
    ("silver.demand_daily", "demand", ("date", "value"), "value <= 0", "[0.0, inf]", "date"),
    (
        "silver.generation_daily", "generation", ("date", "technology", "value"),
        "(is_renewable AND value < 0) OR value < -1000", "[-1000.0, inf]", "date",
    ),
    (
        "silver.price_hourly", "price", ("datetime_utc", "series", "value"),
        "value < -500 OR value > 4000", "[-500.0, 4000.0]", "CAST(datetime_utc AS DATE)",
    ),
)
_COLUMNS = '"check", "table", "column", status, observed, threshold, details'


def _verdict(check, table, column, passed, observed, threshold, details, source) -> str:
    label = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return f"""SELECT '{check}' AS "check", '{table}' AS "table", {label} AS "column",
  CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status, CAST({observed} AS DOUBLE) AS observed,
  CAST({threshold} AS DOUBLE) AS threshold, {details} AS details FROM {source}"""


def suite(baseline: bool) -> str:
    """All silver verdicts."""
    parts = []
    for table, source, columns, bad, band, newest_day in _SUITE:
        previous = (
            f"(SELECT previous FROM baseline WHERE \"table\" = '{table}')" if baseline else "0"
        )
        nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in columns)
        facts = (
            f"(SELECT count(*) AS n, count(*) FILTER (WHERE {bad}) AS bad, max({newest_day}) AS newest, "
            f"{previous} AS prev, {nulls} FROM {source})"
        )
        delta = "CASE WHEN prev = 0 THEN 0.0 ELSE 100.0 * abs(n - prev) / prev END"
        parts.append(_verdict("row_count", table, None, "TRUE", "n", 0, "printf('row count = %d', n)", facts))
        parts.append(
            _verdict(
                "row_count_delta", table, None, f"({delta}) <= 50", delta, 50,
                "CASE WHEN prev = 0 THEN printf('no baseline (first load), current=%d', n) "
                f"ELSE printf('%d -> %d (%.2f%% change)', CAST(prev AS BIGINT), n, {delta}) END", facts,
            )
        )
        for c in columns:
            pct = f"CAST(CASE WHEN n = 0 THEN 0 ELSE 100.0 * null_{c} / n END AS DOUBLE)"
            parts.append(
                _verdict("null_pct", table, c, f"{pct} <= 0", pct, 0,
                         f"printf('%d/%d null (%.2f%%)', null_{c}, n, {pct})", facts)
            )
        parts.append(
            _verdict("value_range", table, "value", "bad = 0", "bad", 0,
                     f"printf('%d rows outside {band}', bad)", facts)
        )
        parts.append(
            _verdict("freshness", table, "date", "newest >= DATE '2001-11-03'",
                     "greatest(date_diff('day', newest, DATE '2001-11-03'), 0)", 0,
                     "'max date ' || strftime(newest, '%Y-%m-%d') || ', expected >= 2001-11-03'", facts)
        )
    extremes = """(SELECT count(*) FILTER (WHERE ratio < 0.8 OR ratio > 1.6) AS bad,
      coalesce(max(ratio) FILTER (WHERE ratio > 1.6), min(ratio) FILTER (WHERE ratio < 0.8)) AS extreme FROM ratio)"""
    parts.append(
        _verdict("ratio_band", "silver.generation_daily", "generation/demand", "bad = 0",
                 "coalesce(extreme, 0.0)", 1.6,
                 "printf('%d day(s) with generation/demand outside [0.8, 1.6]; furthest ', bad) || "
                 "coalesce(printf('%.2f', extreme), 'n/a')", extremes)
    )
    return " UNION ALL ".join(parts)


BASELINE = """history AS (
  SELECT 'silver.demand_daily' AS "table", year(date) + 1 AS run, count(*) AS observed FROM demand GROUP BY 2
  UNION ALL
  SELECT 'silver.generation_daily', year(date) + 1, count(*) FROM generation GROUP BY 2
  UNION ALL
  SELECT 'silver.price_hourly', CAST(strftime(datetime_utc, '%Y%m%d') AS BIGINT), count(*) FROM price GROUP BY 2),
baseline AS (
  SELECT "table", CAST(max_by(observed, run) AS BIGINT) AS previous FROM history GROUP BY 1)"""


def invariants() -> str:
    def row(check, table, column, violations):
        return _verdict(check, table, column, "n = 0", "n", 0, "printf('%d violation(s)', n)",
                        f"(SELECT CAST(coalesce({violations}, 0) AS BIGINT) AS n)")

    mart = "gold.mlv_monthly_renewables_share"
    lost = lambda source, key, dim: f"(SELECT count(*) FROM {source} f ANTI JOIN {dim} d ON d.{key} = f.{key})"
    parts = [
        row("calendar_gapless", "gold.dim_date", "date",
            "(SELECT date_diff('day', min(date), max(date)) + 1 - count(*) FROM dim_date)"),
        row("no_orphans", "gold.fact_demand_daily", "date", lost("demand", "date", "dim_date")),
        row("no_orphans", "gold.fact_generation_daily", "date", lost("generation", "date", "dim_date")),
        row("no_orphans", "gold.fact_price_hourly", "date", lost("price", "date", "dim_date")),
        row("no_orphans", "gold.fact_generation_daily", "technology", lost("generation", "technology", "dim_technology")),
        row("unique_key", "gold.dim_technology", "technology",
            "(SELECT count(*) FROM (SELECT technology FROM dim_technology GROUP BY 1 HAVING count(*) > 1))"),
        row("renewable_within_total", mart, "renewable_mwh", "(SELECT count(*) FROM share WHERE renewable_mwh > total_mwh)"),
        row("share_in_open_range", mart, "renewables_share_pct",
            "(SELECT count(*) FROM share WHERE NOT (renewables_share_pct > 0 AND renewables_share_pct < 100))"),
        row("mart_equals_star", mart, "renewable_mwh",
            """(SELECT count(*) FROM share s FULL JOIN (
                SELECT c.year, c.month, sum(g.value) FILTER (WHERE g.is_renewable) AS renewable
                FROM generation g JOIN dim_date c ON c.date = g.date GROUP BY 1, 2) x
                ON x.year = s.year AND x.month = s.month
              WHERE NOT coalesce(abs(s.renewable_mwh - x.renewable) <= 0.0015, FALSE))"""),
        row("day_count_complete", "gold.fact_generation_daily", "date",
            """(SELECT count(*) FROM (
                SELECT year(date) AS y, month(date) AS m, is_renewable, count(DISTINCT date) AS covered
                FROM generation GROUP BY 1, 2, 3) x
              JOIN (SELECT year, month, count(*) AS days FROM dim_date GROUP BY 1, 2) c
                ON c.year = x.y AND c.month = x.m WHERE covered <> days)"""),
    ]
    return " UNION ALL ".join(parts)


_PLAN_COLUMNS = """position, indicator_path, indicator_name, time_trunc,
  strftime(ws, '%Y-%m-%d') || 'T00:00' AS start, strftime(we, '%Y-%m-%d') || 'T23:59' AS "end",
  '/es/datos/' || indicator_path || '?start_date=' || strftime(ws, '%Y-%m-%d') || 'T00:00&end_date='
    || strftime(we, '%Y-%m-%d') || 'T23:59&time_trunc=' || time_trunc AS url,
  'raw/' || indicator_name || '/' || strftime(ws, '%Y/%m') || '/' || indicator_name || '_'
    || strftime(ws, '%Y%m') || '.json' AS raw_path"""


def work_items(ranged: str) -> str:
    return f"""SELECT {_PLAN_COLUMNS} FROM (
  SELECT *, greatest(CAST(m AS DATE), lo) AS ws, least(last_day(m), hi) AS we FROM (
    SELECT *, unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS m FROM ({ranged})))"""


WATERMARKS = f"""WITH known AS ({watermarks("l_shipdate < DATE '2001-10-25'", "1995-01-11 00:00:00")}),
  new AS ({watermarks("l_shipdate >= DATE '2001-10-25'", "2001-12-01 00:00:00")})
  SELECT coalesce(n.indicator, k.indicator) AS indicator, coalesce(n.last_end, k.last_end) AS last_end,
    coalesce(n.updated_at, k.updated_at) AS updated_at
  FROM known k FULL JOIN new n ON n.indicator = k.indicator"""
# What a second run finds: the row counts of the first.
FIRST_COUNTS = """baseline AS (
  SELECT 'silver.demand_daily' AS "table", count(*) AS previous FROM demand
  UNION ALL SELECT 'silver.generation_daily', count(*) FROM generation
  UNION ALL SELECT 'silver.price_hourly', count(*) FROM price)"""


def gate_runs() -> str:
    """Stored verdicts of two runs, each with the number of its failures."""
    runs = (("2001-11-03 06:00:00", False), ("2001-11-04 06:00:00", True))
    stored = [
        f"SELECT TIMESTAMP '{at}' AS run_ts, 'silver' AS stage, * FROM ({suite(second)})" for at, second in runs
    ]
    return f"""SELECT * REPLACE (round(observed, 6) AS observed),
      CAST(count(*) FILTER (WHERE status = 'FAIL') OVER (PARTITION BY run_ts) AS BIGINT) AS raised
      FROM ({" UNION ALL ".join(stored)})"""


ORACLE: dict[str, str] = {
    "parse_demand": """SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS value
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "quarantine_demand": """SELECT 'demanda_evolucion' AS indicator,
        CASE o_orderpriority WHEN '3-MEDIUM' THEN 'non-numeric value null'
          WHEN '4-NOT SPECIFIED' THEN 'non-numeric value ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
          ELSE 'missing datetime' END AS reason, o_orderkey AS order_key
        FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
    "parse_generation": sql((GENERATION,), "SELECT date, technology, is_renewable, value FROM generation"),
    "landed_generation": sql((GENERATION,), "SELECT date, technology, is_renewable, value FROM generation"),
    "parse_generation_lines": """SELECT p_type AS technology, l_returnflag = 'R' AS is_renewable,
        CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n_rows,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag IN ('A', 'R') AND l_linestatus <> 'O' GROUP BY ALL""",
    "quarantine_generation": """SELECT CASE WHEN l_returnflag NOT IN ('A', 'R')
          THEN 'unrecognised generation series: title="' || p_type || '" type="Almacenamiento"'
          ELSE p_type || ': non-numeric value true' END AS reason,
        l_orderkey || '-' || l_linenumber AS line_ref
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag NOT IN ('A', 'R') OR l_linestatus = 'O'""",
    "parse_prices": sql(
        (SECONDS, "good AS (SELECT * FROM seconds WHERE value >= 5)", modal("series, day", "good")),
        """SELECT g.datetime_utc, g.series, g.value, coalesce(m.period_minutes, 0) AS period_minutes
        FROM good g LEFT JOIN grain m ON m.series = g.series AND m.day = g.day""",
    ),
    "quarantine_prices": sql(
        (SECONDS,),
        """SELECT 'precios_mercados' AS indicator, series || ': non-numeric value '
          || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS reason, count(*) AS n_rows
        FROM seconds WHERE value < 5 GROUP BY ALL""",
    ),
    "unusable_files": """SELECT 'customer-' || c_custkey AS file,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'series is not an object'
          ELSE 'no ''included'' series array' END AS problem
        FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "mv_renewables_share_parsed": sql((GENERATION, SHARE), "SELECT * FROM share"),
    "modal_grain": sql(
        (PRICE, "monthly AS (SELECT series, strftime(datetime_utc, '%Y-%m') AS month, datetime_utc FROM price)",
         modal("series, month", "monthly")),
        """SELECT DISTINCT p.series, p.month, coalesce(g.period_minutes, 0) AS period_minutes
        FROM monthly p LEFT JOIN grain g ON g.series = p.series AND g.month = p.month""",
    ),
    "dedupe_natural_key": sql((LINES, newest("unique_lines", "TRUE")), "SELECT * FROM unique_lines"),
    "upsert_merge": sql(
        (LINES, newest("early", "l_shipdate < DATE '1998-07-01'"), newest("late", "l_shipdate >= DATE '1998-07-01'")),
        """SELECT * FROM early UNION ALL SELECT * FROM late
        ANTI JOIN early USING (l_orderkey, l_linenumber)""",
    ),
    "sink_upsert": sql(
        (LINES, newest("kept", "TRUE", "l_orderkey, l_linenumber, l_shipdate")),
        """SELECT * REPLACE (CASE WHEN l_shipdate >= DATE '1998-07-01' THEN 2 * l_quantity
          ELSE l_quantity END AS l_quantity) FROM kept""",
    ),
    "sink_delete": sql(
        (LINES, newest("kept", "TRUE", "l_orderkey, l_linenumber, l_shipdate")),
        "SELECT * FROM kept WHERE NOT coalesce(l_quantity < 10, FALSE)",
    ),
    "upsert_twice": sql(
        (LINES, newest("early", "l_shipdate < DATE '1998-07-01'"), newest("late", "l_shipdate >= DATE '1998-07-01'")),
        """SELECT * FROM late UNION ALL SELECT * FROM early
        ANTI JOIN late USING (l_orderkey, l_linenumber)""",
    ),
    "quarantine_new_only": """WITH logged AS (
          SELECT event_type AS indicator, props AS raw, user_id, CAST(ts - INTERVAL 8200 DAY AS DATE) AS day FROM events)
        SELECT * FROM logged n WHERE day >= DATE '2001-08-10' AND NOT EXISTS (
          SELECT 1 FROM logged o WHERE o.day < DATE '2001-08-10' AND o.indicator = n.indicator
            AND o.raw = n.raw AND o.user_id = n.user_id)""",
    "delete_by_predicate": sql((GENERATION,), "SELECT * FROM generation WHERE technology <> 'PROMO'"),
    "watermark_upsert": WATERMARKS,
    "sink_watermarks": WATERMARKS,
    "dim_date": sql((*ALL, CALENDAR), "SELECT * FROM dim_date"),
    "dim_technology": sql((GENERATION, TECHNOLOGY), "SELECT * FROM dim_technology"),
    "fact_demand": sql((DEMAND,), "SELECT date, value AS demand_mwh FROM demand"),
    "fact_generation": sql((GENERATION,), "SELECT date, technology, value AS generation_mwh FROM generation"),
    "fact_price": sql((PRICE,), "SELECT datetime_utc, date, series, period_minutes, value AS price_eur_mwh FROM price"),
    "mv_renewables_share": sql((GENERATION, SHARE), "SELECT * FROM share"),
    "mv_avg_price": sql((PRICE, AVG_PRICE), "SELECT * FROM avg_price"),
    "mv_share_by_month_update": sql((GENERATION, SHARE), "SELECT * FROM share"),
    "mv_avg_price_by_month_update": sql((PRICE, AVG_PRICE), "SELECT * FROM avg_price"),
    "gold_row_counts": sql(
        (*GOLD, SHARE, AVG_PRICE),
        """SELECT 'gold.dim_date' AS object_name, count(*) AS row_count FROM dim_date
        UNION ALL SELECT 'gold.dim_indicator', 3
        UNION ALL SELECT 'gold.dim_technology', count(*) FROM dim_technology
        UNION ALL SELECT 'gold.fact_demand_daily', count(*) FROM demand
        UNION ALL SELECT 'gold.fact_generation_daily', count(*) FROM generation
        UNION ALL SELECT 'gold.fact_price_hourly', count(*) FROM price
        UNION ALL SELECT 'gold.mlv_monthly_avg_price', count(*) FROM avg_price
        UNION ALL SELECT 'gold.mlv_monthly_renewables_share', count(*) FROM share""",
    ),
    "calendar_gap": sql(
        (*ALL, CALENDAR),
        """SELECT date_diff('day', min(date), max(date)) + 1 - count(*) AS missing_days, 'dim_date' AS calendar FROM dim_date
        UNION ALL SELECT date_diff('day', min(date), max(date)) + 1 - count(*), 'loaded demand days' FROM demand""",
    ),
    "orphan_facts": sql(
        (DEMAND, GENERATION),
        "SELECT date, count(*) AS n_rows FROM generation WHERE date NOT IN (SELECT date FROM demand) GROUP BY 1",
    ),
    "star_join_month": sql(
        GOLD,
        """SELECT d.year, d.month, t.is_renewable, count(DISTINCT d.date) AS day_count,
          round(sum(f.value), 3) AS generation_mwh
        FROM generation f JOIN dim_date d ON f.date = d.date JOIN dim_technology t ON f.technology = t.technology
        WHERE d.year = 1999 AND d.month = 3 GROUP BY 1, 2, 3""",
    ),
    "latest_12_months": sql((GENERATION, SHARE), "SELECT * FROM share ORDER BY year DESC, month DESC LIMIT 12"),
    "technology_damage": sql(
        (GENERATION,),
        """SELECT technology, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date
        FROM generation WHERE technology = 'PROMO' GROUP BY 1""",
    ),
    "ratio_recent_days": sql(
        (DEMAND, GENERATION),
        """SELECT g.date, round(sum(g.value) / d.value, 2) AS gen_over_demand
        FROM generation g JOIN demand d ON d.date = g.date
        WHERE g.date >= DATE '2001-08-10' - 40 GROUP BY g.date, d.value""",
    ),
    "dq_results": sql(
        (*ALL, RATIO, f"suite AS ({suite(False)})"),
        'SELECT "check", "table", "column", status, round(observed, 6) AS observed, threshold, details FROM suite',
    ),
    "dq_failures": sql(
        (*ALL, RATIO, BASELINE, f"suite AS ({suite(True)})"),
        """SELECT "check", "table", "column", round(observed, 6) AS observed, threshold
        FROM suite WHERE status = 'FAIL'""",
    ),
    "dq_row_delta": sql((*ALL, BASELINE), "SELECT * FROM baseline"),
    "dq_ratio_band": sql(
        (DEMAND, GENERATION, RATIO),
        "SELECT date, round(ratio, 6) AS ratio, ratio < 0.8 OR ratio > 1.6 AS out_of_band FROM ratio",
    ),
    "dq_invariants": sql((*GOLD, SHARE), invariants()),
    "gate_effects": sql((*ALL, RATIO, FIRST_COUNTS), gate_runs()),
    "demand_by_month_complete": sql((*ALL, CALENDAR), complete_months("demand", "month_name,", "demand_mwh")),
    "demand_by_quarter": sql(
        (*ALL, CALENDAR),
        """SELECT c.year, c.quarter, c.is_weekend, round(sum(f.value), 2) AS demand_mwh
        FROM demand f JOIN dim_date c ON c.date = f.date GROUP BY ALL""",
    ),
    "peak_demand": sql((DEMAND,), "SELECT max(value) AS peak_demand_mwh FROM demand"),
    "demand_yoy_r12": sql(
        (DEMAND, """spans AS (
          SELECT ce, CAST(ce - INTERVAL 12 MONTH AS DATE) + 1 AS cs, pe, CAST(pe - INTERVAL 12 MONTH AS DATE) + 1 AS ps
          FROM (SELECT ce, last_day(ce - INTERVAL 12 MONTH) AS pe
                FROM (SELECT last_day(max(date) - INTERVAL 1 MONTH) AS ce FROM demand)))"""),
        """SELECT round(c, 2) AS current_mwh, round(p, 2) AS prior_mwh, round((c - p) / p, 6) AS demand_yoy FROM (
          SELECT sum(value) FILTER (WHERE date BETWEEN cs AND ce) AS c,
                 sum(value) FILTER (WHERE date BETWEEN ps AND pe) AS p FROM demand, spans)""",
    ),
    "data_through": sql(
        ALL,
        """SELECT strftime(least((SELECT max(date) FROM demand), (SELECT max(date) FROM generation),
          (SELECT max(date) FROM price)), '%Y-%m-%d') AS data_through""",
    ),
    "share_total": sql(
        (GENERATION,),
        "SELECT round(sum(value) FILTER (WHERE is_renewable) / sum(value), 6) AS renewables_share FROM generation",
    ),
    "share_by_month": sql(
        (*ALL, CALENDAR),
        """SELECT c.year, c.month, round(sum(value) FILTER (WHERE is_renewable) / sum(value), 6) AS renewables_share
        FROM generation g JOIN dim_date c ON c.date = g.date WHERE c.year IN (1996, 1998) GROUP BY 1, 2""",
    ),
    "generation_by_month_technology_complete": sql(
        (*ALL, CALENDAR), complete_months("generation", "technology,", "generation_mwh")
    ),
    "generation_by_year_label": sql(
        GOLD,
        """SELECT c.year, t.renewable_label, round(sum(g.value), 2) AS generation_mwh
        FROM generation g JOIN dim_date c ON c.date = g.date JOIN dim_technology t ON t.technology = g.technology
        GROUP BY 1, 2""",
    ),
    "avg_price_by_month": sql(
        (PRICE,),
        """SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
          round(avg(value), 6) AS avg_price FROM price WHERE series = 'click' GROUP BY 1, 2""",
    ),
    "price_daily_avg30d": sql(
        (PRICE,),
        """SELECT date, round(avg_price, 6) AS avg_price,
          round(avg(avg_price) OVER (ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW), 6)
            AS avg_price_30d
        FROM (SELECT date, avg(value) AS avg_price FROM price WHERE series = 'click' GROUP BY 1)""",
    ),
    "price_min_max": sql((PRICE,), "SELECT min(value) AS min_price, max(value) AS max_price FROM price"),
    "slicer_years": sql((*ALL, CALENDAR), "SELECT DISTINCT year FROM dim_date"),
    "slicer_series": sql((PRICE,), "SELECT DISTINCT series FROM price"),
    "monthly_totals": sql(
        (DEMAND,),
        """SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
          round(sum(value), 2) AS demand_mwh, count(*) AS days FROM demand GROUP BY 1, 2""",
    ),
    "share_one_month": sql(
        (GENERATION,),
        """SELECT round(sum(CASE WHEN is_renewable THEN value ELSE 0 END) / sum(value) * 100, 6)
          AS renewables_share_pct FROM generation WHERE year(date) = 1999 AND month(date) = 3""",
    ),
    "top10_prices": sql(
        (PRICE,),
        """SELECT datetime_utc, value AS price_eur_mwh FROM price WHERE series = 'click'
        ORDER BY value DESC, datetime_utc LIMIT 10""",
    ),
    "latest_per_series": sql(
        (PRICE,),
        """SELECT series, datetime_utc, value AS price_eur_mwh FROM (
          SELECT *, row_number() OVER (PARTITION BY series ORDER BY datetime_utc DESC) AS rn FROM price) WHERE rn = 1""",
    ),
    "rolling7_daily_mean": sql(
        (PRICE,),
        """SELECT date, round(avg(a) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_avg_price
        FROM (SELECT CAST(datetime_utc AS DATE) AS date, avg(value) AS a FROM price WHERE series = 'click' GROUP BY 1)""",
    ),
    "calendar_of_feeds": """SELECT CAST(d AS DATE) AS date, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week FROM (
        SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""",
    "plan_backfill": work_items(
        """SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS position, 'brand/' || p_brand AS indicator_path,
          p_brand AS indicator_name, 'day' AS time_trunc,
          (SELECT CAST(min(o_orderdate) AS DATE) FROM orders) AS lo, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS hi
        FROM part"""
    ),
    "plan_daily": work_items(
        """SELECT CAST(s_suppkey AS INTEGER) AS position, 'supplier/' || s_suppkey AS indicator_path,
          'supplier_' || s_suppkey AS indicator_name, 'hour' AS time_trunc,
          CAST(date_trunc('month', CAST(max(l_shipdate) AS DATE) + 1) AS DATE) AS lo, DATE '2001-11-03' AS hi
        FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey
        HAVING CAST(max(l_shipdate) AS DATE) + 1 <= DATE '2001-11-03'"""
    ),
}
