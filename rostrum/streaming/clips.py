"""Streaming twins of batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_clips(observations: DataFrame, ts: str, keys: list[str], gap: str = "30 seconds", late: str = "10 minutes") -> DataFrame:
    """Clips as session windows: keys, start, end and rows of each session. On a stream
    a session is emitted when the watermark passes it."""
    stream = observations.withWatermark(ts, late) if observations.isStreaming else observations
    return stream.groupBy(*keys, F.session_window(ts, gap).alias("s")).agg(F.count("*").alias("n_rows")).select(*keys, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n_rows")


def drain(source: DataFrame, work, checkpoint: str) -> None:
    """Runs ``work(batch, id)`` over all that is pending, then stops."""
    source.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
