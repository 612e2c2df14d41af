"""Offsets ``(text, start_time, end_time)`` in order: cleaning, nesting, and windows that no long recording can clog.

A window over a whole recording would bring a continuous feed into one task. Here a recording is cut into blocks of
its order number; values move inside a block by a window, and between blocks by one summary row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import strip

BLOCK_ROWS = 4096
ORDER = ("pos", "start_time", "end_time", "offset_id")


def clean_offsets(df: DataFrame, key: str = "utt_id") -> DataFrame:
    """One row of each delivery: same recording, position, text and times count once, under their smallest
    ``offset_id``. Rows without recording, position or times are left out; null texts stay."""
    return df.filter(f"{key} is not null and pos is not null and start_time is not null and end_time is not null").groupBy(key, "pos", "text", "start_time", "end_time").agg(F.min("offset_id").alias("offset_id"))


def blocked(df: DataFrame, pos: str = "pos", rows: int = BLOCK_ROWS) -> DataFrame:
    """With ``block``, which follows the order number."""
    return df.withColumn("block", F.floor(F.col(pos) / rows))


def _block_window(key: str, order: tuple[str, ...]) -> W:
    return W.partitionBy(key, "block").orderBy(*order)


def with_previous(df: DataFrame, values: dict[str, str], key: str = "utt_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """For a blocked ``df``: columns (values of ``values``) of the row before, across block borders; null at the first."""
    w = _block_window(key, order)
    last = df.groupBy(key, "block").agg(F.max_by(F.struct(*[F.col(c).alias(n) for c, n in values.items()]), F.struct(*order)).alias("__last"))
    carry = last.select(key, "block", F.lag("__last").over(W.partitionBy(key).orderBy("block")).alias("__carry"))
    df = df.withColumn("__n", F.row_number().over(w))
    for c, n in values.items():
        df = df.withColumn(n, F.lag(c).over(w))
    df = df.join(carry, [key, "block"])
    for n in values.values():
        df = df.withColumn(n, F.when(F.col("__n") == 1, F.col(f"__carry.{n}")).otherwise(F.col(n)))
    return df.drop("__n", "__carry")


def running_total(df: DataFrame, value: Column, name: str, key: str = "utt_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """For a blocked ``df``: the sum of ``value`` up to and with each row, as ``name``."""
    w = _block_window(key, order)
    df = df.withColumn("__v", value.cast("bigint"))
    sums = df.groupBy(key, "block").agg(F.sum("__v").alias("__s"))
    base = sums.select(key, "block", F.coalesce(F.sum("__s").over(W.partitionBy(key).orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    return df.withColumn("__r", F.sum("__v").over(w.rowsBetween(W.unboundedPreceding, 0))).join(base, [key, "block"]).withColumn(name, F.col("__base") + F.col("__r")).drop("__v", "__r", "__base")


def to_nested(df: DataFrame, key: str = "utt_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """``(key, offsets)``: each recording as one array in order; for recordings of ordinary length."""
    item = F.struct(*order, "text")
    return df.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(x["text"].alias("text"), x["start_time"].alias("start_time"), x["end_time"].alias("end_time"))).alias("offsets")
    )


def to_long(df: DataFrame, key: str = "utt_id", offsets: str = "offsets") -> DataFrame:
    """``(key, pos, text, start_time, end_time)`` from nested offsets."""
    return df.select(key, F.posexplode(offsets).alias("pos", "o")).select(key, "pos", "o.text", "o.start_time", "o.end_time")


def shift(df: DataFrame, by: list[str], order: tuple[str, ...] = ORDER) -> DataFrame:
    """Times relative to the first start of each group of ``by``, rounded to 3 places; the order numbers stay."""
    first = df.groupBy(*by).agg(F.min_by("start_time", F.struct(*order)).alias("__first"))
    return df.join(first, by).withColumn("start_time", F.round(F.col("start_time") - F.col("__first"), 3)).withColumn("end_time", F.round(F.col("end_time") - F.col("__first"), 3)).drop("__first")


def is_blank_token(text: Column) -> Column:
    """Whether an offset's text is the single space that stands between words."""
    return F.coalesce(text == " ", F.lit(False))


def last_end(df: DataFrame, key: str = "utt_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """``(key, duration)``: the end of the last row in order, which isn't always the latest end."""
    return df.groupBy(key).agg(F.max_by("end_time", F.struct(*order)).alias("duration"))


def valid_recordings(df: DataFrame, key: str = "utt_id") -> DataFrame:
    """``(key, valid, n)``: whether every row of a recording has text and times, in long form."""
    whole = F.col("text").isNotNull() & F.col("start_time").isNotNull() & F.col("end_time").isNotNull()
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.bool_and(whole).alias("valid"), F.count(F.lit(1)).alias("n"))


def drop_blank_tokens(offsets: Column, keep_whitespace: bool = False) -> Column:
    """Nested offsets without single-space tokens (unless kept), texts stripped (unless kept)."""
    kept = offsets if keep_whitespace else F.filter(offsets, lambda o: ~is_blank_token(o["text"]))
    return F.transform(
        kept,
        lambda o: F.struct(
            (o["text"] if keep_whitespace else strip(o["text"])).alias("text"), F.round(o["start_time"], 3).alias("start_time"), F.round(o["end_time"], 3).alias("end_time")
        ),
    )


def joined_text(offsets: Column) -> Column:
    """Texts of nested offsets joined by a space, empty and null ones skipped."""
    return F.array_join(F.filter(F.transform(offsets, lambda o: o["text"]), lambda t: t != ""), " ")


def merge_on_delimiter(df: DataFrame, is_delimiter: Column, key: str = "utt_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """``(key, word, start_time, end_time, text, n)``: sounds between delimiters joined to words, ``word`` from 0;
    leading and repeated delimiters make no word."""
    df = running_total(blocked(df), F.when(is_delimiter, 1).otherwise(0), "__d", key, order).filter(~F.coalesce(is_delimiter, F.lit(False)))
    merged = df.groupBy(key, "__d").agg(
        F.min_by("start_time", F.struct(*order)).alias("start_time"),
        F.max_by("end_time", F.struct(*order)).alias("end_time"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "text"))), lambda x: x["text"]), " ").alias("text"),
        F.count(F.lit(1)).alias("n"),
    )
    blocks = merged.withColumn("block", F.floor(F.col("__d") / BLOCK_ROWS))
    return running_total(blocks, F.lit(1), "word", key, ("__d",)).withColumn("word", F.col("word") - 1).select(key, "word", "start_time", "end_time", "text", "n")
