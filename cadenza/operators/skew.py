"""Joins whose left side may have hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot with more rows than this. Of hot keys the thousand largest are salted: any other key has less than a
#: thousandth of all rows.
HOT_ROWS = 200_000
HOT_KEYS = 1000


def hot_keys(df: DataFrame, on: list[str], rows: int = HOT_ROWS) -> DataFrame | None:
    """``(*on, __salts)`` of the hot keys, at most a thousand; None if there are none. ``__salts`` is the number of stretches of
    ``rows`` rows a key is cut into."""
    if df.count() <= rows:
        return None
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows)
    hot = counts.orderBy(F.desc("__n")).limit(HOT_KEYS).select(*on, F.ceil(F.col("__n") / rows).cast("int").alias("__salts"))
    found = hot.collect()
    return df.sparkSession.createDataFrame(found, hot.schema) if found else None


def join_hot(left: DataFrame, right: DataFrame, on: list[str], spread: Column, how: str = "inner", rows: int = HOT_ROWS) -> DataFrame:
    """``left.join(right, on, how)`` for a ``right`` with few rows of each key: the rows of a hot key on the left are spread over
    salts by the hash of ``spread``, those on the right are copied to them. ``how`` is ``inner`` or ``left``."""
    hot = hot_keys(left, on, rows)
    if hot is None:
        return left.join(right, on, how)
    salt = F.when(F.col("__salts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("__salts")).cast("int")).otherwise(0)
    salted = left.join(F.broadcast(hot), on, "left").withColumn("__salt", salt).drop("__salts")
    copied = right.join(F.broadcast(hot), on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))).drop("__salts")
    return salted.join(copied, [*on, "__salt"], how).drop("__salt")


#: What may be broadcast, in bytes of its values and 16 a value.
BROADCAST_BYTES = 32_000_000


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small enough to be broadcast: its rows and the bytes of its values are added up."""
    kinds = dict(df.dtypes)
    width = F.lit(16 * len(kinds))
    for c, kind in kinds.items():
        if kind == "string":
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind != "boolean" and kind.partition("<")[0] in ("array", "map", "struct"):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0] <= limit


def join_lookup(left: DataFrame, right: DataFrame, on: list[str], spread: Column, how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """``left.join(right, on, how)`` for a written ``right`` with few rows of each key: broadcast if it fits, else a join that
    spreads hot keys."""
    return left.join(F.broadcast(right), on, how) if fits(right, limit) else join_hot(left, right, on, spread, how)
