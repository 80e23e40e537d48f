"""Arriving files as a stream, validated batch by batch. An extension: the catalogue work itself is batch work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.validation import validate


def validate_arrivals(spark: SparkSession, folder: str, schema: StructType, entity: str, out: str, checkpoint: str) -> StreamingQuery:
    """All Parquet files not yet seen: valid and quarantined records appended under ``out``; ends when nothing is left."""

    def one(batch: DataFrame, epoch: int) -> None:
        checked = validate(batch, entity)
        checked.valid.withColumn("_epoch", F.lit(epoch)).write.mode("append").parquet(f"{out}/valid")
        checked.quarantine.withColumn("_epoch", F.lit(epoch)).write.mode("append").parquet(f"{out}/quarantine")

    return spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, kind: str, size: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts by kind and tumbling window; rows later than ``late`` are dropped."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
