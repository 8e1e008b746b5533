"""New images as a stream: the stateless stages, as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import triage


def arriving(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of metric files (Parquet) as they arrive in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def flag_arrivals(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Quality flags for what has arrived, written once each; groups of copies need
    all images and are a batch plan."""
    flagged = triage.quality_flags(rows).withColumn("quality_score", triage.quality_score())
    return (
        flagged.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
