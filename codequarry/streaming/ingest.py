"""Incremental ingestion of records: an extension beyond batch building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def new_records(spark: SparkSession, path: str, schema: T.StructType, key: list[str], time: str, late: str = "7 days") -> DataFrame:
    """A stream of records, each key once within the time that late ones may take; state older than that is dropped."""
    return spark.readStream.schema(schema).parquet(path).withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, group: str, width: str = "30 days", slide: str | None = None) -> DataFrame:
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.groupBy(w.alias("w"), group).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", group, "n")


def run_available(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes all that is there and stops; the next run goes on from there, each record written once."""
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q
