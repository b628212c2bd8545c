"""Written intermediate results, kept on the cluster's shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_DATABASE = "gridmetrics_stage"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir")


_scratch: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder on shared storage; removed when the driver ends."""
    application = spark.sparkContext.applicationId
    if application not in _scratch:
        folder = f"{shared_folder(spark).rstrip('/')}/{_DATABASE}/{application}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _scratch[application] = folder
    return _scratch[application]


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and hand back a scan of the files.

    For results that several branches of one plan read: the work above is done once, the
    scan has exact sizes for choosing joins, and a lost executor only re-reads files. The
    files stay for the life of the application.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_schema(spark: SparkSession) -> str:
    """A new, empty catalog schema below the application's folder."""
    name = f"{_DATABASE}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch_folder(spark)}/{name}'")
    return name


class Counts:
    """Counts that a write takes of the rows it writes: no second scan."""

    def __init__(self, **counts: Column) -> None:
        self._columns = [count.alias(name) for name, count in counts.items()]
        self._observation = Observation()

    def of(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, *self._columns)

    def get(self, name: str) -> int:
        """Waits for the write. A plan that was found to be empty while it ran reports no
        metrics at all; its counts are 0."""
        if self._observation._jo.getRow().length() == 0:
            return 0
        return self._observation.get[name]


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """Write ``df`` once and hand back a scan of it.

    Several jobs can then read the result without recomputing it, and a lost executor
    costs a re-read of files instead of a re-run of the plan above. The table is dropped
    on exit.
    """
    spark = df.sparkSession
    location = f"{shared_folder(spark).rstrip('/')}/{_DATABASE}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_DATABASE} LOCATION '{location}'")
    table = f"{_DATABASE}.t_{uuid.uuid4().hex}"
    try:
        df.write.format("parquet").saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
