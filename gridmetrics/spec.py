"""The three indicators, their tables and the fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass

CIVIL_ZONE = "Europe/Madrid"

# Indicator names, request paths, tables, keys, grains and units.
DEMAND = "demanda_evolucion"
GENERATION = "generacion_estructura"
PRICES = "precios_mercados"


@dataclass(frozen=True)
class IndicatorSpec:
    """How one indicator is requested, where it lands and what identifies a row."""

    name: str
    path: str
    time_trunc: str
    table: str
    key: tuple[str, ...]
    schema: str
    month_of: str
    grain: str
    unit: str


SPECS: tuple[IndicatorSpec, ...] = (
    IndicatorSpec(
        name=DEMAND,
        path="demanda/evolucion",
        time_trunc="day",
        table="silver.demand_daily",
        key=("date",),
        schema="date DATE NOT NULL, value DOUBLE NOT NULL",
        month_of="date",
        grain="1 row per civil day (Europe/Madrid)",
        unit="MWh",
    ),
    IndicatorSpec(
        name=GENERATION,
        path="generacion/estructura-generacion",
        time_trunc="day",
        table="silver.generation_daily",
        key=("date", "technology"),
        schema=(
            "date DATE NOT NULL, technology STRING NOT NULL, "
            "is_renewable BOOLEAN NOT NULL, value DOUBLE NOT NULL"
        ),
        month_of="date",
        grain="1 row per civil day x technology",
        unit="MWh",
    ),
    IndicatorSpec(
        name=PRICES,
        path="mercados/precios-mercados-tiempo-real",
        time_trunc="hour",
        table="silver.price_hourly",
        key=("datetime_utc", "series"),
        schema=(
            "datetime_utc TIMESTAMP NOT NULL, series STRING NOT NULL, "
            "value DOUBLE NOT NULL, period_minutes INT NOT NULL"
        ),
        month_of="datetime_utc",
        grain="1 row per UTC instant x series (60-min; spot 15-min from 2025-01-01)",
        unit="EUR/MWh",
    ),
)
BY_NAME = {spec.name: spec for spec in SPECS}

QUARANTINE_TABLE = "silver.quarantine"
QUARANTINE_SCHEMA = (
    "raw STRING NOT NULL, indicator STRING NOT NULL, "
    "reason STRING NOT NULL, loaded_at TIMESTAMP NOT NULL, digest BIGINT NOT NULL"
)
WATERMARK_TABLE = "bronze.ctl_watermark"
WATERMARK_SCHEMA = "indicator STRING NOT NULL, last_end STRING NOT NULL, updated_at TIMESTAMP NOT NULL"
VERDICT_TABLE = "ops.dq_results"
VERDICT_SCHEMA = (
    "run_ts TIMESTAMP NOT NULL, stage STRING NOT NULL, check STRING NOT NULL, "
    "table STRING NOT NULL, column STRING, status STRING NOT NULL, "
    "observed DOUBLE NOT NULL, threshold DOUBLE NOT NULL, details STRING NOT NULL"
)

# How the upstream payload labels its series.
RENEWABLE_TYPE = "Renovable"
TECHNOLOGY_TYPES = ("renovable", "no-renovable")
AGGREGATE_TITLES = ("generacion total",)
AGGREGATE_TYPES = ("total", "generacion total")
TRUE_WORDS = ("true", "t", "yes", "y", "1")
ACCENTED = "áéíóúüñÁÉÍÓÚÜÑ"
UNACCENTED = "aeiouunAEIOUUN"
DEFAULT_SERIES = "PVPC"
SPOT_SERIES = "Precio mercado spot"

# Gate thresholds.
PRICE_LOW, PRICE_HIGH = -500.0, 4000.0
GENERATION_LOW = -1000.0
RATIO_LOW, RATIO_HIGH = 0.8, 1.6
RATIO_LABEL = "generation/demand"
MAX_NULL_PCT = 0.0
MAX_ROW_DELTA_PCT = 50.0
FRESHNESS_LAG_DAYS = 1


def spec_for(name: str) -> IndicatorSpec:
    """Look an indicator up by name; an unknown name is an error."""
    if name not in BY_NAME:
        raise ValueError(f"unknown indicator {name!r}; expected one of {sorted(BY_NAME)}")
    return BY_NAME[name]
