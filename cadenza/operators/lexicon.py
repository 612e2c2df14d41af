"""Lexicons: merge, lookup with fallback, missing words, pronunciation counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .skew import fits


def long_lexicon(lexicon: DataFrame) -> DataFrame:
    """Distinct ``(word, pronunciation)``; null words, arrays and entries give nothing."""
    return lexicon.filter("word is not null").select("word", F.explode("pronunciations").alias("pronunciation")).filter("pronunciation is not null").distinct()


def merge_lexicons(*lexicons: DataFrame) -> DataFrame:
    """``(word, pronunciations)``: the union of all pronunciations of a word, sorted."""
    both = long_lexicon(lexicons[0])
    for x in lexicons[1:]:
        both = both.unionByName(long_lexicon(x))
    return both.groupBy("word").agg(F.array_sort(F.collect_set("pronunciation")).alias("pronunciations"))


def small(df: DataFrame) -> DataFrame:
    """``df``, written, to be broadcast if its bytes allow it, else as it is (a shuffled join)."""
    df = materialize(df)
    return F.broadcast(df) if fits(df) else df


def lookup(words: DataFrame, lexicon: DataFrame, word: str = "word", fallback: Callable[[Column], Column] | None = None) -> DataFrame:
    """``words`` with ``pronunciations`` and ``known``; an unknown word has what ``fallback`` makes of it, by default
    itself."""
    made = (fallback or (lambda w: w))(F.col(word))
    found = words.join(small(lexicon.select(F.col("word").alias(word), "pronunciations")), word, "left")
    return found.withColumn("known", F.col("pronunciations").isNotNull()).withColumn("pronunciations", F.coalesce("pronunciations", F.array(made)))


def missing_words(words: DataFrame, lexicon: DataFrame, word: str = "word") -> DataFrame:
    """Distinct words that the lexicon lacks."""
    return words.select(word).filter(F.col(word).isNotNull()).distinct().join(small(lexicon.select(F.col("word").alias(word)).distinct()), word, "left_anti")


def pronunciation_counts(pairs: DataFrame, word: str = "word", phoneme: str = "phoneme") -> DataFrame:
    """``(word, phoneme, n)``."""
    return pairs.groupBy(word, phoneme).agg(F.count(F.lit(1)).alias("n"))


def counts_by_word(counts: DataFrame) -> DataFrame:
    """``(word, counts)`` with a map from phonemes to numbers."""
    return counts.groupBy("word").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("phoneme", "n")))).alias("counts"))
