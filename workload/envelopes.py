"""Raw envelopes ``(file, value)`` written from the test tables.

Monthly and daily files are built from rows already reduced to days or seconds, so the
number of entries in a file is bounded by the clock. Row envelopes (one file per source row)
need no grouping and make the parse work grow with the table; which rows carry a fault
follows from their own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.functions.dates import civil_date
from gridmetrics.spec import CIVIL_ZONE
from workload import standins


def civil_midnight(day: Column) -> Column:
    """Local midnight with the (approximate) summer or winter offset; the date is as written."""
    summer = F.month(day).between(4, 10)
    offset = F.when(summer, "+02:00").otherwise("+01:00")
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00.000"), offset)


def local_instant(instant: Column) -> Column:
    """Local wall-clock text of a UTC instant with its true offset."""
    local = F.from_utc_timestamp(instant, CIVIL_ZONE)
    hours = ((F.unix_timestamp(local) - F.unix_timestamp(instant)) / 3600).cast("int")
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.format_string("+%02d:00", hours)
    )


def generation_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per month: a series per technology and the aggregate over all of them."""
    daily = standins.generation(spark, sf_dir)
    kind = F.when(F.col("is_renewable"), "Renovable").otherwise("No-Renovable")
    of_series = lambda title, kind: F.struct(
        title.alias("title"), kind.alias("type"), F.col("date").alias("date"), F.col("value").alias("value")
    )
    both = daily.select(
        F.inline(
            F.array(
                of_series(F.col("technology"), kind),
                of_series(F.lit("Generación total"), F.lit("total")),
            )
        )
    )
    totals = both.groupBy("title", "type", "date").agg(
        F.sum(F.col("value").cast("decimal(20,2)")).cast("double").alias("value")
    )
    entry = F.struct(F.col("value"), civil_midnight(F.col("date")).alias("datetime"))
    series = totals.groupBy(F.date_format("date", "yyyyMM").alias("yyyymm"), "title", "type").agg(
        F.sort_array(F.collect_list(F.struct("date", entry.alias("entry")))).alias("dated")
    )
    attributes = F.struct(
        "title", "type", F.lit(False).alias("composite"),
        F.transform("dated", lambda d: d["entry"]).alias("values"),
    )
    files = series.groupBy("yyyymm").agg(
        F.sort_array(F.collect_list(F.struct(attributes.alias("attributes")))).alias("included")
    )
    return files.select(
        F.concat(F.lit("generacion_estructura_"), "yyyymm", F.lit(".json")).alias("file"),
        F.to_json(F.struct("included")).alias("value"),
    )


def demand_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order; the order priority decides how its entry is written."""
    day = F.to_date("o_orderdate")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    priority = F.col("o_orderpriority")
    value = (
        F.when(priority == "3-MEDIUM", "null")
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit('"'), amount, F.lit('"')))
        .otherwise(amount)
    )
    moment = (
        F.when(priority == "5-LOW", "")
        .when(priority == "2-HIGH", F.concat(F.lit(',"datetime":"'), F.date_format(day, "yyyyMMdd"), F.lit('"')))
        .otherwise(F.concat(F.lit(',"datetime":"'), civil_midnight(day), F.lit('"')))
    )
    return table_rows(
        standins.table(spark, sf_dir, "orders"),
        F.concat(F.lit("order-"), "o_orderkey"),
        F.concat(
            F.lit('{"included":[{"type":"Demanda","attributes":{"title":"Demanda","values":[{"value":'),
            value, F.lit(',"percentage":'), F.col("o_orderkey"), moment, F.lit("}]}}]}"),
        ),
    )


def generation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per line item: its own series, typed by the return flag, and an aggregate."""
    lines = standins.shipped(spark, sf_dir)
    flag = F.col("l_returnflag")
    kind = F.when(flag == "R", "Renovable").when(flag == "A", " NO-RENOVABLE ").otherwise("Almacenamiento")
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    value = F.when(F.col("l_linestatus") == "O", F.lit("true")).otherwise(amount)
    reference = F.concat("l_orderkey", F.lit("-"), "l_linenumber")
    text = F.concat(
        F.lit('{"included":[{"attributes":{"title":"'), "technology", F.lit('","type":"'), kind,
        F.lit('","composite":"no","magnitude":"'), reference,
        F.lit('","values":[{"value":'), value, F.lit(',"percentage":"'), reference,
        F.lit('","datetime":"'), civil_midnight(F.to_date("l_shipdate")),
        F.lit('"}]}},{"attributes":{"title":"GENERACIÓN TOTAL ","type":"x","values":[{"value":'),
        amount, F.lit("}]}}]}"),
    )
    return table_rows(lines, F.concat(F.lit("line-"), reference), text)


def price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per (series, civil day): one entry per second, cheap ones written as text."""
    seconds = price_seconds(spark, sf_dir)
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    shown = F.when(F.col("value") < 5, F.concat(F.lit('"'), amount, F.lit('"'))).otherwise(amount)
    entry = F.concat(
        F.lit('{"value":'), shown, F.lit(',"datetime":"'), local_instant(F.col("datetime_utc")), F.lit('"}')
    )
    files = seconds.groupBy("series", "day").agg(
        F.sort_array(F.collect_list(F.struct("datetime_utc", entry.alias("entry")))).alias("dated")
    )
    entries = F.concat_ws(",", F.transform("dated", lambda d: d["entry"]))
    return files.select(
        F.concat_ws("/", F.lit("prices"), "series", F.col("day").cast("string")).alias("file"),
        F.concat(
            F.lit('﻿{"included":[{"attributes":{"title":7,"values":[{"value":1}]}},{"attributes":{"title":"'),
            "series", F.lit('","values":['), entries, F.lit("]}}]}"),
        ).alias("value"),
    )


def price_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest value per (series, second), with the civil day."""
    second = F.date_trunc("second", "datetime_utc")
    return (
        standins.events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("series"), second.alias("datetime_utc"))
        .agg(F.max("value").alias("value"))
        .withColumn("day", civil_date(F.col("datetime_utc")))
    )


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per customer; the market segment decides whether it is readable."""
    segment = F.col("c_mktsegment")
    text = (
        F.when(segment == "AUTOMOBILE", '{"data":{"type":"x"}}')
        .when(segment == "FURNITURE", '{"included":{"attributes":{}}}')
        .when(segment == "HOUSEHOLD", '{"included":[{"attributes":{"values":[]}},7]}')
        .when(segment == "MACHINERY", '{"included":[{"attributes":')
        .otherwise('{"included":[]}')
    )
    return table_rows(
        standins.table(spark, sf_dir, "customer"), F.concat(F.lit("customer-"), "c_custkey"), text
    )


def table_rows(df: DataFrame, file: Column, text: Column) -> DataFrame:
    """One file per row, lying anywhere in the cluster, as landed files do."""
    return df.repartition(file).select(file.alias("file"), text.alias("value"))
