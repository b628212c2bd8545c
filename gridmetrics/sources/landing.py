"""The raw landing zone: one JSON envelope per (indicator, month) file."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BOM = r"^﻿+"


def raw_path(root: str, indicator: str, month: date) -> str:
    """File of one (indicator, month): fetching the same month always replaces the same file."""
    return f"{root}/{indicator}/{month:%Y}/{month:%m}/{indicator}_{month:%Y%m}.json"


def read_envelopes(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row ``(file, value)`` per whole file, byte-order marks stripped.

    ``wholetext`` keeps multi-line envelopes whole. Nothing is collected: each file is
    decoded in the task that reads it.
    """
    wanted = paths if isinstance(paths, str) else list(paths)
    return without_bom(
        spark.read.text(wanted, wholetext=True).select(
            F.col("_metadata.file_path").alias("file"), "value"
        )
    )


def read_landed(
    spark: SparkSession, root: str, indicator: str, months: Iterable[date] | None = None
) -> DataFrame:
    """Envelopes of one indicator, optionally only the given months' files."""
    if months is None:
        return read_envelopes(spark, f"{root}/{indicator}/*/*/*.json")
    return read_envelopes(spark, [raw_path(root, indicator, month) for month in months])


def without_bom(files: DataFrame) -> DataFrame:
    """Drop leading byte-order marks from ``value``."""
    return files.withColumn("value", F.regexp_replace("value", _BOM, ""))


def land(envelopes: DataFrame, root: str) -> list[str]:
    """Write ``(indicator, year, month, value)`` envelopes to the files that :func:`raw_path` names.

    Each file replaces that of the same indicator and month; other months are left alone.
    Tasks write to a folder beside the landing zone; only when all is written the files are moved,
    each by one rename, so a reader finds the old or the new file. Returns the paths; their number is
    bounded by indicators and months. Two envelopes of one month are an error before any move.
    """
    spark = envelopes.sparkSession
    keys = ["indicator", "year", "month"]
    folder = f"{root}/_landing/{uuid.uuid4().hex}"
    envelopes.select("value", *keys).repartition(*keys).write.option("maxRecordsPerFile", 1).partitionBy(
        *keys
    ).text(folder)
    named = {}
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    for (written,) in listed.select("path").collect():
        indicator, year, month = re.search(r"/indicator=([^/]+)/year=(\d+)/month=(\d+)/", written).groups()
        target = raw_path(root, unquote(indicator), date(int(year), int(month), 1))
        if target in named:
            raise ValueError(f"two envelopes for {target}")
        named[target] = written
    files = _Files(spark, root)
    for target, written in named.items():
        files.move(written, target)
    files.delete(folder)
    return sorted(named)


class _Files:
    """Renames and deletions in the file system of ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.hadoop = self.jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        where = self.hadoop.Path(root).getFileSystem(conf).makeQualified(self.hadoop.Path(root))
        self.context = self.hadoop.FileContext.getFileContext(where.toUri(), conf)

    def move(self, source: str, target: str) -> None:
        to = self.hadoop.Path(target)
        self.context.mkdir(to.getParent(), self.hadoop.permission.FsPermission.getDirDefault(), True)
        rename = getattr(self.hadoop, "Options$Rename")
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self.context.rename(self.hadoop.Path(source), to, options)

    def delete(self, folder: str) -> None:
        self.context.delete(self.hadoop.Path(folder), True)
