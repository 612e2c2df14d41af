"""Continuous periods and silences of overlapping intervals (problem 3).

Overlapping spans are merged by ``session_window`` with a gap duration taken from each row, so that a span's
session is the span itself. A recording is cut into time blocks first, which keeps a continuous feed from
landing in one task: spans merge inside their block, and only one summary row per block (the latest end, the
next opening) is carried from block to block. Periods that touch, which the session merge keeps apart, and
periods that reach over a block border are joined afterwards from these summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..runtime import materialize

BLOCK_MS = 300_000


def to_ms(seconds: Column) -> Column:
    """Seconds rounded to milliseconds, as a whole number. NaN and infinity give null."""
    s = seconds.cast("double")
    ok = s.isNotNull() & ~F.isnan(s) & (F.abs(s) < F.lit(9.0e12))
    return F.when(ok, F.round(s * F.lit(1000.0), 0)).cast("bigint")


def valid_spans(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """``(key, start_ms, end_ms)`` of the rows that count: key and both times present, end after start."""
    return df.select(F.col(key).alias("key"), to_ms(F.col(start)).alias("start_ms"), to_ms(F.col(end)).alias("end_ms")).filter(
        "key is not null and start_ms is not null and end_ms is not null and end_ms > start_ms"
    )


def _merged_in_blocks(df: DataFrame, key: str, start: str, end: str, block_ms: int) -> DataFrame:
    """``key, block, start_ms, end_ms, n, seen``: the spans merged inside their block, with the latest end before
    each in the block. Written once, as three branches of the plan read it."""
    spans = valid_spans(df, key, start, end).withColumn("block", F.expr(f"floor(start_ms / {block_ms})"))
    merged = (
        spans.groupBy(
            "key",
            "block",
            F.session_window(F.timestamp_millis("start_ms"), F.concat((F.col("end_ms") - F.col("start_ms")).cast("string"), F.lit(" milliseconds"))).alias("w"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .select("key", "block", F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms"))
    )
    in_block = W.partitionBy("key", "block").orderBy("start_ms", "end_ms")
    return merged.withColumn("seen", F.max("end_ms").over(in_block.rowsBetween(W.unboundedPreceding, -1)))


def continuous_periods(df: DataFrame, key: str = "utt_id", start: str = "start_time", end: str = "end_time", block_ms: int = BLOCK_MS) -> DataFrame:
    """``(key, start_ms, end_ms, next_start_ms, gap_ms)``: the continuous periods of each key in order, with the
    start of the following period and the silence before it (null after the last period).

    Times are rounded to milliseconds. Rows with a null key, a null or non-finite time, or an end not after the
    start, do not count; repeated rows change nothing; touching spans are one period. An empty table gives an
    empty result. Further columns of the input are ignored, whatever their names.
    """
    inner = materialize(_merged_in_blocks(df, key, start, end, block_ms))
    # one row per block: what later blocks need to know of it
    blocks = inner.groupBy("key", "block").agg(F.max("end_ms").alias("block_end"))
    order = W.partitionBy("key").orderBy("block")
    carry = blocks.select("key", "block", F.max("block_end").over(order.rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
    marked = (
        inner.join(carry, ["key", "block"])
        .withColumn("before_ms", F.greatest("seen", "carried"))
        .filter("before_ms is null or start_ms > before_ms")
        .select("key", "block", "start_ms", "before_ms")
    )
    # a period ends where the silence before the next opening begins; across blocks by the blocks' first openings
    firsts = marked.groupBy("key", "block").agg(F.min_by(F.struct("start_ms", "before_ms"), "start_ms").alias("first"))
    coming = blocks.join(firsts, ["key", "block"], "left").select(
        "key",
        "block",
        F.first("first", ignorenulls=True).over(order.rowsBetween(1, W.unboundedFollowing)).alias("coming"),
        F.max("block_end").over(W.partitionBy("key")).alias("last_end"),
    )
    here = W.partitionBy("key", "block").orderBy("start_ms")
    return (
        marked.withColumn("following", F.lead(F.struct("start_ms", "before_ms")).over(here))
        .join(coming, ["key", "block"])
        .withColumn("following", F.coalesce("following", "coming"))
        .select(
            F.col("key").alias(key),
            "start_ms",
            F.coalesce(F.col("following.before_ms"), "last_end").alias("end_ms"),
            F.col("following.start_ms").alias("next_start_ms"),
            (F.col("following.start_ms") - F.col("following.before_ms")).alias("gap_ms"),
        )
    )


def silences(df: DataFrame, key: str = "utt_id", start: str = "start_time", end: str = "end_time", min_gap_ms: int = 1000, block_ms: int = BLOCK_MS) -> DataFrame:
    """``(key, gap_start_ms, gap_end_ms)``: silences of at least ``min_gap_ms`` between neighbouring periods of
    :func:`continuous_periods`; none before the first or after the last period."""
    return (
        continuous_periods(df, key, start, end, block_ms)
        .filter(F.col("gap_ms") >= min_gap_ms)
        .select(key, F.col("end_ms").alias("gap_start_ms"), F.col("next_start_ms").alias("gap_end_ms"))
    )
