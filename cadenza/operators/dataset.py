"""Data set curation: agreement filters, splits by speaker, totals, interval containment, log records, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.paths import stem
from ..functions.text import glued
from ..runtime import materialize


def same_words(label: Column, transcript: Column) -> Column:
    """Whether a label, a list of words, equals the transcript once white space inside words is gone."""
    return F.array_join(F.transform(label, lambda w: F.regexp_replace(w, r"\s+", "")), " ") == transcript


def phonemes_match(said: Column, variants: Column) -> Column:
    """Whether as many words were said as there are variant lists, each among the space-free variants of its place."""
    pairs = F.arrays_zip(said.alias("s"), variants.alias("v"))
    return (F.size(said) == F.size(variants)) & F.forall(pairs, lambda p: F.array_contains(F.transform(p["v"], glued), p["s"]))


def confident(aligned: Column, greedy: Column, frames: Column, threshold: float = -0.2) -> Column:
    """Whether the aligned log-probability falls short of the greedy one by no more than the threshold per frame."""
    score = (aligned - greedy) / frames
    return F.coalesce(score > threshold, F.lit(False)) & ~F.isnan(score)


def speaker_splits(df: DataFrame, speaker: str = "speaker", test_size: float = 0.1, valid_size: float = 0.1) -> DataFrame:
    """``(speaker, n, split)``: speakers by number of rows, largest first and names ascending; one goes to train while the
    rows before it are fewer than train's share, then to test, then to validation. Null speakers take no part.

    Speakers are sorted in ranges, of which each task has one; the rows before a range come from the sums of the ranges.
    """
    counts = df.filter(F.col(speaker).isNotNull()).groupBy(speaker).agg(F.count(F.lit(1)).alias("n"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(counts.repartitionByRange(ranges, F.desc("n"), F.col(speaker)).withColumn("__r", F.spark_partition_id()))
    sums = ranged.groupBy("__r").agg(F.sum("n").alias("__n")).withColumn("__r", F.col("__r").cast("bigint"))
    total = ranged.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    train, test = int((1 - test_size - valid_size) * total), int((1 - valid_size) * total)
    within = F.coalesce(F.sum("n").over(W.partitionBy("__r").orderBy(F.desc("n"), speaker).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = ranged.withColumn("__w", within).join(F.broadcast(sums_before(sums, "__r", "__n", "__base")), "__r").withColumn("before", F.col("__base") + F.col("__w"))
    return ranked.select(speaker, "n", F.when(F.col("before") < train, "train").when(F.col("before") < test, "test").otherwise("validation").alias("split"))


def sums_before(sums: DataFrame, number: str, value: str, name: str, width: int = 10_000) -> DataFrame:
    """``(number, name)``: the sum of ``value`` over all smaller numbers, for one row per whole number. Sums go by stretches of
    ``width`` numbers, and between the stretches by one row each."""
    sums = sums.withColumn("__s", F.floor(F.col(number) / width))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    tops = sums.groupBy("__s").agg(F.sum(value).alias("__t")).select("__s", before("__t", W.orderBy("__s")).alias("__top"))
    inner = sums.select(number, "__s", before(value, W.partitionBy("__s").orderBy(number)).alias("__in"))
    return inner.join(tops, "__s").select(number, (F.col("__top") + F.col("__in")).alias(name))


def contained(outer: DataFrame, inner: DataFrame, by: str, tolerance: float = 0.06, cell: float = 1.0) -> DataFrame:
    """Each outer interval with the inner ones of the same ``by`` that lie within it, give or take the tolerance, as
    ``inner_start, inner_end, inner_text``; one row per match, and one of nulls where there is none.

    Both sides are copied to the cells of time they take up, inner ones of ordinary order to that of their start alone,
    and a pair counts in the first cell both have. So the join is on equal keys and a long recording is many groups.
    """
    at = lambda c: F.floor(c / cell)
    outer = materialize(outer.withColumn("__o", F.monotonically_increasing_id()))
    wide = outer.withColumn("__first", at(F.col("start_time") - tolerance)).withColumn("__cell", F.explode(F.sequence(F.col("__first"), at(F.greatest("end_time", "start_time") + tolerance))))
    narrow = (
        inner.select(F.col(by), F.col("start_time").alias("inner_start"), F.col("end_time").alias("inner_end"), F.col("text").alias("inner_text"))
        .filter("inner_start is not null and inner_end is not null")
        .withColumn("__inner", at(F.least("inner_start", "inner_end")))
        .withColumn("__inner", F.when(F.col("inner_end") >= F.col("inner_start"), at(F.col("inner_start"))).otherwise(F.col("__inner")))
        .withColumn("__cell", F.explode(F.sequence(F.col("__inner"), at(F.col("inner_start")))))
    )
    met = wide.join(narrow, [by, "__cell"]).filter(
        (F.col("__cell") == F.greatest("__first", "__inner")) & (F.col("inner_start") >= F.col("start_time") - tolerance) & (F.col("inner_end") <= F.col("end_time") + tolerance)
    )
    met = met.drop("__cell", "__first", "__inner")
    none = outer.join(met.select("__o").distinct(), "__o", "left_anti")
    for c in ("inner_start", "inner_end"):
        none = none.withColumn(c, F.lit(None).cast("double"))
    return met.unionByName(none.withColumn("inner_text", F.lit(None).cast("string"))).drop("__o")


def before_after(df: DataFrame, keep: Column, by: str, samples: Column, rate: float = 16_000.0) -> DataFrame:
    """``(by, n, kept, hours)``: rows there are, rows to be kept, and the hours of all samples."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(keep, 1)).alias("kept"), F.round(F.sum(samples.cast("double")) / F.lit(rate) / F.lit(3600.0), 6).alias("hours"))


def without_prefixes(text: Column, prefixes: tuple[str, ...]) -> Column:
    """Whether a text starts with none of the prefixes; null for null."""
    out = F.lit(True)
    for x in prefixes:
        out = out & ~text.startswith(x)
    return out


def with_partner(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Rows whose ``on`` is in ``other``."""
    return df.join(other.select(on), on, "left_semi")


def without_partner(df: DataFrame, *others: DataFrame, on: str) -> DataFrame:
    """Rows whose ``on`` is not in all of ``others``: what is there only in part counts as missing."""
    have = others[0].select(on)
    for x in others[1:]:
        have = have.join(x.select(on), on, "left_semi")
    return df.join(have, on, "left_anti")


def preferred_text(df: DataFrame, on: str, *texts: DataFrame) -> DataFrame:
    """``df`` with ``text`` from the first of ``texts`` ``(on, text)`` that has one; the last of a key's equal rows by text wins."""
    names = []
    for i, t in enumerate(texts):
        names.append(f"__t{i}")
        df = df.join(t.groupBy(on).agg(F.max("text").alias(names[-1])), on, "left")
    return df.withColumn("text", F.coalesce(*names)).drop(*names)


def by_base_name(df: DataFrame, aligned: DataFrame, path: str = "audio") -> DataFrame:
    """``df`` with ``offsets`` of ``aligned`` ``(path, offsets)`` whose file has the same name without folder and extension; of equal
    names the last path counts, and without one the offsets are empty."""
    named = aligned.select(stem(F.col(path)).alias("__stem"), path, "offsets").groupBy("__stem").agg(F.max_by("offsets", path).alias("__o"))
    found = df.withColumn("__stem", stem(F.col(path))).join(named, "__stem", "left").drop("__stem")
    return found.withColumn("offsets", F.coalesce("__o", F.slice("__o", 1, 0), F.array().cast(aligned.schema["offsets"].dataType))).drop("__o")


def keep_labelled(df: DataFrame, scores: DataFrame, key: str, label: str) -> DataFrame:
    """Rows whose best label is ``label``; ``scores`` is ``(key, scores)`` of a classifier, the first of equal scores by label."""
    best = scores.select(key, F.array_min(F.transform("scores", lambda x: F.struct((-x["score"]).alias("s"), x["label"].alias("label")))).alias("__b"))
    return df.join(best.filter(F.col("__b.label") == label).select(key), key, "left_semi")


def total_duration(df: DataFrame, by: str, duration: Column) -> DataFrame:
    return df.groupBy(by).agg(F.round(F.sum(duration), 3).alias("duration"))


def log_record(date: str, label: str, code: Column, duration: Column) -> Column:
    """A log payload as a struct."""
    return F.struct(
        F.struct(
            F.lit(date).alias("date"), F.lit(label).alias("label"), F.substring_index(code, "-", 1).alias("language"), code.alias("language-code"), duration.alias("duration")
        ).alias("fields")
    )


def batches(df: DataFrame, order: str, size: int = 10, block: int = 10_000) -> DataFrame:
    """``df`` with ``batch`` from 0: ``size`` rows each in ascending order of a unique whole number. Rows before a block of
    that number come from the counts of the blocks."""
    df = df.withColumn("__b", F.floor(F.col(order) / block))
    base = sums_before(df.groupBy("__b").agg(F.count(F.lit(1)).alias("__n")), "__b", "__n", "__base")
    rank = F.col("__base") + F.row_number().over(W.partitionBy("__b").orderBy(order)) - 1
    return df.join(base, "__b").withColumn("batch", F.floor(rank / size)).drop("__b", "__base")


def best_of(scores: Column) -> Column:
    """``struct<score, label>``: the highest score of an array and its position from 0, the first of equal ones; null if the array
    is null or has no score."""
    ranked = F.array_max(F.transform(scores, lambda x, i: F.when(x.isNotNull(), F.struct(x.alias("score"), (-i).alias("back")))))
    return F.when(ranked.isNotNull(), F.struct(ranked["score"].alias("score"), (-ranked["back"]).cast("bigint").alias("label")))


def best_label(scores: DataFrame, by: list[str], threshold: float | None = None) -> DataFrame:
    """The label of the highest score per group; of equal scores the first label."""
    scores = scores if threshold is None else scores.filter(F.col("score") >= threshold)
    return scores.groupBy(*by).agg(F.min_by(F.struct("label", "score"), F.struct((-F.col("score")).alias("s"), "label")).alias("b")).select(*by, "b.label", "b.score")
