"""Landing files of one indicator -> its silver table and the quarantine."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.operators.parse import QUARANTINE, ROW, UNUSABLE, all_records, split
from gridmetrics.sources import tables
from gridmetrics.sources.staging import Counts, staged
from gridmetrics.spec import QUARANTINE_SCHEMA, QUARANTINE_TABLE, SPECS, spec_for

logger = logging.getLogger(__name__)
UNUSABLE_TABLE = "silver.unusable_files"
UNUSABLE_SCHEMA = (
    "indicator STRING NOT NULL, file STRING, problem STRING, found_at TIMESTAMP NOT NULL"
)


class UnusableFiles(ValueError):
    """Some files could not be read as envelopes; no row and no quarantined record was written.

    All of them are in ``UNUSABLE_TABLE``; the message says how many parts.
    """

    def __init__(self, indicator: str, count: int) -> None:
        self.count = count
        super().__init__(f"{indicator}: {count} unusable envelope part(s), all in {UNUSABLE_TABLE}")


def ensure_silver(spark: SparkSession) -> None:
    """Create the silver tables and the quarantine, empty but typed."""
    for spec in SPECS:
        tables.ensure_table(spark, spec.table, spec.schema, monthly=True)
    tables.ensure_table(spark, QUARANTINE_TABLE, QUARANTINE_SCHEMA, by="indicator")
    tables.ensure_table(spark, UNUSABLE_TABLE, UNUSABLE_SCHEMA, by="indicator")


def newest_first() -> list:
    """Survivor of a key repeated within a batch: latest file, then latest position."""
    return [F.desc("file"), F.desc("series_pos"), F.desc("entry_pos")]


def load_indicator(
    spark: SparkSession,
    files: DataFrame,
    indicator: str,
    loaded_at: datetime | None = None,
    append_repeats: bool = False,
    skip_unusable: bool = False,
) -> dict[str, int]:
    """Parse envelopes, quarantine what did not type, upsert the rest; idempotent.

    The files are parsed once into a written staging table, counted by that write, that all
    following steps read. Unusable files are listed in a table, each once, and stop the load
    before rows are written; with ``skip_unusable`` the other files are loaded. By default a
    quarantined record already stored by an earlier run is not stored again;
    ``append_repeats`` stores it anyway. Tables that a load appends to are compacted.
    """
    spec = spec_for(indicator)
    ensure_silver(spark)
    kinds = (ROW, QUARANTINE, UNUSABLE)
    written = Counts(**{kind: F.count_if(F.col("kind") == kind) for kind in kinds})
    with staged(written.of(all_records(files, indicator))) as records:
        counts = {kind: written.get(kind) for kind in kinds}
        logger.info("%s: %s", indicator, counts)
        parsed = split(records)
        stamp = F.lit(loaded_at or tables.utc_now()).cast("timestamp")
        if counts[UNUSABLE]:
            listed = parsed.unusable.select(
                F.lit(indicator).alias("indicator"), "file", "problem", stamp.alias("found_at")
            )
            identity = ["indicator", "file", "problem"]
            tables.append_new(spark, UNUSABLE_TABLE, listed, identity, indicator=indicator)
            tables.compact(spark, UNUSABLE_TABLE, [indicator])
            if not skip_unusable:
                raise UnusableFiles(indicator, counts[UNUSABLE])
        if counts[QUARANTINE]:
            rejected = parsed.quarantined.withColumn("loaded_at", stamp)
            identity = ["indicator", "raw", "reason"]
            if append_repeats:
                digest = F.xxhash64(*identity).alias(tables.DIGEST)
                tables.append(spark, QUARANTINE_TABLE, rejected.select("*", digest))
            else:
                tables.append_new(spark, QUARANTINE_TABLE, rejected, identity, indicator=indicator)
            tables.compact(spark, QUARANTINE_TABLE, [indicator])
        if counts[ROW]:
            months = tables.upsert(
                spark, spec.table, parsed.rows, spec.key, spec.month_of, newest_first()
            )
            tables.compact(spark, spec.table, months)
    return counts
