"""Catalog tables: create, append, upsert, delete, compact and full rebuild.

Large tables are partitioned by ``year_month`` so that an upsert or a delete rewrites only
the months it touches. The rewritten months are staged by the committer and replace the old
files at commit, after every task has read its input. One writer per table at a time.

A table that is rebuilt as a whole is a view over its current version. A rebuild writes a new
version beside it and then turns the view with one catalog call, so whoever reads at any
moment, also after a run that died between the steps, sees a complete table. The version
before the current one stays for readers that began earlier; older ones are dropped.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.functions.dates import year_month
from gridmetrics.operators.merge import delete_where, latest_by_key, merge_by_key, new_by_digest, new_only
from gridmetrics.sources.staging import Counts, staged
from gridmetrics.spec import WATERMARK_SCHEMA, WATERMARK_TABLE

MONTH = "year_month"
DIGEST = "digest"
#: A partition of several files is compacted if they are smaller than this on average.
SMALL_FILE = 8 << 20


def ensure_namespace(spark: SparkSession, table: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.split('.')[0]}")


def ensure_table(
    spark: SparkSession, table: str, schema: str, monthly: bool = False, by: str | None = None
) -> None:
    """Create an empty typed table if there is none, so that later scans always succeed.

    A monthly table has the storage column ``year_month``; ``by`` names a column of the schema
    that partitions it instead. The overwrite mode belongs to a partitioned table itself:
    whatever the session says, an overwrite replaces the partitions it writes and never the
    whole table.
    """
    ensure_namespace(spark, table)
    columns = f"{schema}, {MONTH} STRING" if monthly else schema
    by = MONTH if monthly else by
    layout = f"OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY ({by})" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET {layout}")


def physical(spark: SparkSession, table: str) -> str:
    """The table that holds the rows: the current version of a rebuilt table, else itself."""
    if not _is_view(spark, table):
        return table
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'View Text'")
    return re.search(r"FROM (\S+)", described.first()["data_type"])[1]


def _is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"


def _current(spark: SparkSession, table: str) -> DataFrame:
    """Scan by name with a fresh file listing: another session may have replaced months."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Scan by name without the storage partition column."""
    return _current(spark, table).drop(MONTH)


def append(spark: SparkSession, table: str, df: DataFrame) -> None:
    df.select(*spark.table(table).columns).write.mode("append").insertInto(table)


def append_new(
    spark: SparkSession, table: str, df: DataFrame, identity: Sequence[str], **within: str
) -> None:
    """Append only rows not yet present under ``identity``: re-runs add nothing.

    ``within`` holds partition values that all rows of ``df`` have; only those partitions are
    read. A table with a ``digest`` column is keyed by the digest of the identity, and the
    identity itself is compared only where digests are equal.
    """
    existing = _current(spark, table)
    for column, value in within.items():
        existing = existing.filter(F.col(column) == value)
    if DIGEST in existing.columns:
        batch = df.withColumn(DIGEST, F.xxhash64(*identity))
        with staged(batch) as new:
            append(spark, table, new_by_digest(new, existing, identity, DIGEST))
    else:
        append(spark, table, new_only(df, existing, identity))


def replace_months(spark: SparkSession, table: str, df: DataFrame, months: Sequence[str]) -> None:
    """Make ``months`` of ``table`` hold exactly the rows ``df`` has there, other months untouched.

    The rows are counted by month while they are written, so the months left without any are
    known afterwards; a dynamic overwrite leaves those alone, so they are dropped.
    """
    months = sorted(set(months))
    if not months:
        return
    rows = df.filter(F.col(MONTH).isin(months))
    counts = Counts(**{f"n{i}": F.count_if(F.col(MONTH) == month) for i, month in enumerate(months)})
    _replace(spark, table, counts.of(rows), MONTH)
    for i, month in enumerate(months):
        if not counts.get(f"n{i}"):
            spark.sql(f"ALTER TABLE {physical(spark, table)} DROP IF EXISTS PARTITION ({MONTH} = '{month}')")


def _replace(spark: SparkSession, table: str, df: DataFrame, column: str) -> None:
    """Overwrite exactly the partitions present in ``df``.

    The rebalance sizes output files by data volume: small partitions become one file and a
    hot one is written by several tasks.
    """
    (
        df.select(*spark.table(table).columns)
        .hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .insertInto(physical(spark, table))
    )


def _months(df: DataFrame) -> list[str]:
    """Distinct months; bounded by the calendar, not by the rows."""
    return [row[0] for row in df.select(MONTH).distinct().collect()]


def upsert(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    key: Sequence[str],
    month_of: str,
    order: Sequence[Column],
) -> list[str]:
    """Update rows that match on ``key``, insert the rest, delete nothing; returns the months.

    The batch is reduced to one row per key under ``order`` and written once; the months it
    holds are known from that, so the target is read with partition pruning.
    """
    if month_of not in key:
        raise ValueError("the month must follow from the key, or a key could change partition")
    unique = latest_by_key(batch, key, order).withColumn(MONTH, year_month(F.col(month_of)))
    with staged(unique.select(*spark.table(table).columns)) as new:
        months = _months(new)
        if months:
            target = _current(spark, table).filter(F.col(MONTH).isin(months))
            _replace(spark, table, merge_by_key(target, new, [*key, MONTH]), MONTH)
    return months


def delete_rows(spark: SparkSession, table: str, predicate: Column) -> None:
    """Delete matching rows by rewriting the months that hold any."""
    touched = _months(_current(spark, table).filter(predicate))
    if not touched:
        return
    kept = delete_where(_current(spark, table).filter(F.col(MONTH).isin(touched)), predicate)
    replace_months(spark, table, kept, touched)


def file_sizes(spark: SparkSession, table: str) -> DataFrame:
    """``part, files, bytes`` of every partition, from file listings alone."""
    rows = physical(spark, table)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {rows}")
    location = described.filter("col_name = 'Location'").first()["data_type"]
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    column = partition_column(spark, table)
    part = F.regexp_extract("path", f"/{column}=([^/]*)/", 1) if column else F.lit("")
    return listed.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def partition_column(spark: SparkSession, table: str) -> str | None:
    columns = spark.catalog.listColumns(physical(spark, table))
    return next((column.name for column in columns if column.isPartition), None)


def compact(
    spark: SparkSession, table: str, parts: Sequence[str] | None = None, small: int = SMALL_FILE
) -> list[str]:
    """Rewrite partitions that hold several small files into well-sized ones; content stays.

    ``parts`` limits the partitions looked at. Returns those rewritten; a partition just
    rewritten is left alone the next time.
    """
    column = partition_column(spark, table)
    if column is None:
        raise ValueError(f"{table} has no partitions to rewrite one by one")
    # Partitions are bounded by the calendar or the indicators, not by rows.
    sizes = file_sizes(spark, table).filter((F.col("files") > 1) & (F.col("bytes") < small * F.col("files")))
    wanted = sorted(r["part"] for r in sizes.collect() if parts is None or r["part"] in parts)
    if wanted:
        _replace(spark, table, _current(spark, table).filter(F.col(column).isin(wanted)), column)
    return wanted


def months_of(spark: SparkSession, table: str, months: Sequence[str] | None = None) -> DataFrame:
    """Scan of a monthly table with its partition column, optionally only some months."""
    rows = _current(spark, table)
    return rows if months is None else rows.filter(F.col(MONTH).isin(list(months)))


def rebuild(spark: SparkSession, table: str, df: DataFrame) -> int:
    """Replace data and schema of ``table`` and return the row count.

    A frame with the storage column gives a monthly table. Rows are counted during the write.
    """
    ensure_namespace(spark, table)
    version = f"{table}__v_{uuid.uuid4().hex}"
    counts = Counts(n=F.count(F.lit(1)))
    rows = counts.of(df)
    if MONTH in df.columns:
        monthly = rows.hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH)
        monthly.option("partitionOverwriteMode", "dynamic").saveAsTable(version)
    else:
        rows.write.saveAsTable(version)
    before = physical(spark, table)
    _switch(spark, table, version)
    for old in _versions(spark, table) - {version, before}:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return counts.get("n")


def _switch(spark: SparkSession, table: str, version: str) -> None:
    """Make ``version`` the content of ``table``: one catalog call once the view exists."""
    if _is_view(spark, table):
        spark.sql(f"ALTER VIEW {table} AS SELECT * FROM {version}")
        return
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # a plain table of an older layout
    spark.sql(f"CREATE VIEW {table} AS SELECT * FROM {version}")


def _versions(spark: SparkSession, table: str) -> set[str]:
    schema, name = table.split(".")
    listed = spark.sql(f"SHOW TABLES IN {schema} LIKE '{name}__v_*'").collect()
    return {f"{schema}.{row['tableName']}" for row in listed}


def ensure_rebuilt(spark: SparkSession, table: str, schema: str) -> None:
    """Like :func:`ensure_table`, for a table that later runs rebuild as a whole."""
    if not spark.catalog.tableExists(table):
        rebuild(spark, table, spark.createDataFrame([], schema))


def upsert_watermarks(spark: SparkSession, updates: DataFrame, table: str = WATERMARK_TABLE) -> None:
    """Set ``last_end`` and ``updated_at`` of known indicators, insert the others."""
    ensure_rebuilt(spark, table, WATERMARK_SCHEMA)
    merged = merge_by_key(
        _current(spark, table), updates, ["indicator"], update=["last_end", "updated_at"]
    )
    rebuild(spark, table, merged)


def utc_now() -> datetime:
    """Current instant as the naive UTC value Spark reads under a UTC session."""
    from datetime import timezone

    return datetime.now(timezone.utc)
