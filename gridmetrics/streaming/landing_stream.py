"""Landing zone as a file stream: each file is parsed once, upserts stay idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmetrics.plans.silver import load_indicator
from gridmetrics.sources.landing import without_bom
from gridmetrics.spec import spec_for


def new_envelopes(spark: SparkSession, pattern: str) -> DataFrame:
    """Stream of ``(file, value)`` over whole files matching ``pattern``."""
    return without_bom(
        spark.readStream.text(pattern, wholetext=True).select(
            F.col("_metadata.file_path").alias("file"), "value"
        )
    )


def load_new(spark: SparkSession, root: str, indicator: str, checkpoint: str) -> StreamingQuery:
    """Load every file not seen under ``checkpoint`` yet, then stop.

    A micro-batch that is retried upserts the same keys again and stores no quarantine
    record twice. An unusable file is listed and the rest of its batch is loaded: failing
    would only bring the same file back.
    """
    spec_for(indicator)
    return (
        new_envelopes(spark, f"{root}/{indicator}/*/*/*.json")
        .writeStream.foreachBatch(
            lambda files, _: load_indicator(files.sparkSession, files, indicator, skip_unusable=True) and None
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
