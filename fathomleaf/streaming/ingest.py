"""Incremental ingest: files that came since the last run, each once, by the stream's checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathomleaf.functions import text as X

SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def text_stream(spark: SparkSession, root: str) -> DataFrame:
    """(path, text): cleaned text files as they arrive; blank ones left out."""
    raw = spark.readStream.format("binaryFile").schema(SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(root)
    return raw.select("path", X.clean_text(F.decode("content", "UTF-8")).alias("text")).filter(F.length(X.strip("text")) > 0)


def ingest(spark: SparkSession, root: str, out: str, checkpoint: str) -> StreamingQuery:
    """Take what is there and stop."""
    return text_stream(spark, root).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums by window and type, for batches and for streams with late rows."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
