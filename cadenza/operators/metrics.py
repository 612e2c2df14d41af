"""Phoneme error rates and punctuation alignment over rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..kernels.per import EPSILON, equalise, phoneme_errors
from ..kernels.punctuation import PUNCTUATIONS, place_punctuation
from .lexicon import long_lexicon


def equalised_lexicon(lexicon: DataFrame, epsilon: str = EPSILON) -> DataFrame:
    """``(word, variants)``: each word's pronunciations, split at spaces and filled to one length."""

    def run(variants: pd.Series) -> pd.Series:
        return pd.Series([equalise([list(v) for v in vs], epsilon) for vs in variants])

    split = lambda p: F.filter(F.split(p, r"\s+"), lambda x: x != "")
    words = long_lexicon(lexicon).groupBy("word").agg(F.transform(F.array_sort(F.collect_set("pronunciation")), split).alias("v"))
    return words.select("word", F.pandas_udf(run, "array<array<string>>")("v").alias("variants"))


def _errors(stacks: pd.Series, predictions: pd.Series) -> pd.DataFrame:
    rows = [phoneme_errors([[list(v) for v in w] for w in s], list(p)) for s, p in zip(stacks, predictions, strict=True)]
    return pd.DataFrame(rows, columns=["errors", "total"])


def error_counts(df: DataFrame, variants: str, prediction: str) -> DataFrame:
    """``df`` with ``errors`` and ``total``; ``variants`` has the equalised variants of each word in order."""
    r = F.pandas_udf(_errors, "errors int, total int")(variants, prediction)
    return df.withColumn("__r", r).withColumn("errors", F.col("__r.errors")).withColumn("total", F.col("__r.total")).drop("__r")


def words_with_variants(df: DataFrame, key: str, words: str, lexicon: DataFrame) -> DataFrame:
    """``(key, variants)``: the variants of each word in order. A word out of the lexicon is an error that names it."""
    long = df.select(key, F.posexplode(words).alias("i", "word"))
    found = long.join(lexicon, "word", "left")
    checked = F.coalesce("variants", F.raise_error(F.concat(F.lit("not in the lexicon: "), F.col("word"))).cast("array<array<string>>"))
    return found.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", checked.alias("v")))), lambda x: x["v"]).alias("variants"))


def error_rate(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Errors over total, over all rows or per group; null where the total is 0."""
    return counts.groupBy(*(by or [])).agg(F.sum("errors").alias("errors"), F.sum("total").alias("total"), F.round(F.try_divide(F.sum("errors"), F.sum("total")), 6).alias("per"))


def punctuated(offsets: Column, truth: Column, punctuations: tuple[str, ...] = PUNCTUATIONS) -> Column:
    """Nested phoneme offsets with the punctuation of ``truth``, its phonemes and punctuation as an array. Null where either is
    null or empty, or no cut of the phonemes fits the truth."""

    def place(items: list | None, true: list | None) -> list[dict] | None:
        if items is None or true is None or not len(items):
            return None
        try:
            placed = place_punctuation([x["text"] or "" for x in items], [x["start_time"] for x in items], [x["end_time"] for x in items], list(true), punctuations)
        except ValueError:
            return None
        return [{"text": a, "start_time": b, "end_time": c} for a, b, c in placed]

    def run(o: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([place(items, true) for items, true in zip(o, t, strict=True)], dtype=object)

    return F.pandas_udf(run, "array<struct<text:string,start_time:double,end_time:double>>")(offsets, truth)


def aligned_words(df: DataFrame, key: str, emissions: str, words: str, labels: dict[str, int], samples: str, rate: int = 16_000) -> DataFrame:
    """``(key, text, start_time, end_time)``: words forced onto frame log-probabilities; rows whose words don't fit give
    nothing."""
    from ..kernels.ctc import word_times

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, e, w, n in zip(pdf["k"], pdf["e"], pdf["w"], pdf["n"], strict=True):
                try:
                    rows += [(k, *t) for t in word_times(np.array([list(f) for f in e], dtype=float), list(w), labels, int(n), rate)]
                except ValueError:
                    continue
            yield pd.DataFrame(rows, columns=["k", "text", "start_time", "end_time"])

    source = df.select(F.col(key).cast("string").alias("k"), F.col(emissions).alias("e"), F.col(words).alias("w"), F.col(samples).cast("bigint").alias("n"))
    return source.mapInPandas(run, "k string, text string, start_time double, end_time double").withColumnRenamed("k", key)
