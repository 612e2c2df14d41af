"""Silence segments of arriving offsets: an extension, as the reference model is batch only.

Offsets of a recording may come in any order within the watermark. Their spans, lengthened by the silence that ends a
segment, are sessions of their own length; sessions that meet are one segment, closed once the watermark passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streaming_segments(offsets: DataFrame, silence_ms: int = 300, late: str = "10 minutes", key: str = "utt_id", recorded_at: str = "recorded_at") -> DataFrame:
    """``(key, start_time, end_time, n)`` of a stream of offsets with ``recorded_at`` (when the recording began, a timestamp),
    ``start_time`` and ``end_time``. Start and end are timestamps. Rows without times or of no length don't count."""
    ms = lambda c: F.round(F.col(c) * 1000).cast("bigint")
    rows = offsets.filter("start_time is not null and end_time is not null and end_time > start_time").withColumn("at", F.timestamp_millis(F.unix_millis(recorded_at) + ms("start_time")))
    span = F.concat((ms("end_time") - ms("start_time") + silence_ms).cast("string"), F.lit(" milliseconds"))
    w = rows.withWatermark("at", late).groupBy(key, F.session_window("at", span).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(key, F.col("w.start").alias("start_time"), F.timestamp_millis(F.unix_millis("w.end") - silence_ms).alias("end_time"), "n")
