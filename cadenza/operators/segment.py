"""Segmentation of offsets: by silence, by word overlap and by phoneme overlap with a ground truth; gap tags; chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.paths import chunk_path
from ..functions.text import fold, phoneme_form, pronunciations_form
from ..kernels.overlap import equal_blocks
from .offsets import ORDER, blocked, merge_on_delimiter, running_total, with_previous

EXTRA_MS = 50


# --- silence, long form

def silence_segments(df: DataFrame, silence_duration: float = 0.0, key: str = "utt_id", order: tuple[str, ...] = ORDER, previous: bool = False) -> DataFrame:
    """Rows with ``segment`` from 0: a new one begins where the start, less the end of the row before, rounded to 3
    places, is at least ``silence_duration``. With ``previous`` also ``prev_end`` and ``prev_pos`` of the row before, null where
    a segment begins."""
    df = with_previous(blocked(df), {"end_time": "prev_end", order[0]: "prev_pos"}, key, order)
    gap = F.round(F.col("start_time") - F.col("prev_end"), 3)
    begins = F.coalesce(gap >= silence_duration, F.lit(True))
    df = df.withColumns({"__begins": begins, "prev_end": F.when(~begins, F.col("prev_end")), "prev_pos": F.when(~begins, F.col("prev_pos"))})
    df = running_total(df, F.col("__begins").cast("int"), "segment", key, order).withColumn("segment", F.col("segment") - 1).drop("__begins", "block")
    return df if previous else df.drop("prev_end", "prev_pos")


def tagged_segments(df: DataFrame, minimum_empty_duration: float, empty_tag: str = "<EMPTY>", key: str = "utt_id") -> DataFrame:
    """Long form of :func:`silence_segments` with ``previous``: a tag row between neighbours of one segment whose rounded gap is at
    least the minimum. Tags have the position of the row before and ``is_tag`` true; they sort after it."""
    item = lambda pos, text, start, end, tag: F.struct(pos.cast("bigint").alias("pos"), text.alias("text"), start.alias("start_time"), end.alias("end_time"), F.lit(tag).alias("is_tag"))
    c = F.col
    own = item(c("pos"), c("text"), c("start_time"), c("end_time"), False)
    tag = F.when(F.round(c("start_time") - c("prev_end"), 3) >= minimum_empty_duration, item(c("prev_pos"), F.lit(empty_tag), c("prev_end"), c("start_time"), True))
    rows = df.select(key, "segment", F.explode(F.array(own, tag)).alias("x")).filter("x is not null")
    return rows.select(key, "x.pos", "x.text", "x.start_time", "x.end_time", "segment", "x.is_tag")


def segment_bounds(df: DataFrame, key: str = "utt_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """``(key, segment, n, start_time, end_time)``: first start and last end by order."""
    return df.groupBy(key, "segment").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("start_time", F.struct(*order)).alias("start_time"), F.max_by("end_time", F.struct(*order)).alias("end_time")
    )


def chunk_lengths(bounds: DataFrame, audio_ms: str | None = None) -> DataFrame:
    """With ``chunk_ms``: 50 ms beyond the last end, no further than the audio's length."""
    stop = F.col("end_time") * 1000 + EXTRA_MS
    stop = F.least(stop, F.col(audio_ms).cast("double")) if audio_ms else stop
    return bounds.withColumn("chunk_ms", F.round(stop - F.col("start_time") * 1000, 3))


def long_chunks(bounds: DataFrame, minimum_chunk_duration: float = 0.2, audio_ms: str | None = None) -> DataFrame:
    """Chunks of at least the minimum duration. ``segment`` is their index: it was counted before, so it has holes."""
    return chunk_lengths(bounds, audio_ms).filter(F.col("chunk_ms") >= minimum_chunk_duration * 1000)


def label_tags(tags: DataFrame, scores: DataFrame, threshold: float, key: str = "utt_id") -> DataFrame:
    """Tag rows with the label of their best score at or above ``threshold`` as text, else as they are. ``scores`` has
    ``key, segment, pos, label, score``; of equal scores the first by label wins."""
    best = scores.filter(F.col("score") >= threshold).groupBy(key, "segment", "pos").agg(F.min_by("label", F.struct((-F.col("score")).alias("s"), "label")).alias("label"))
    named = tags.join(best, [key, "segment", "pos"], "left")
    return named.withColumn("text", F.when(F.col("is_tag") & F.col("label").isNotNull(), F.concat(F.lit("<"), "label", F.lit(">"))).otherwise(F.col("text"))).drop("label")


def phoneme_overlap_segments(sounds: DataFrame, variants: DataFrame, key: str = "utt_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """:func:`phoneme_overlap_runs` of sounds, merged to words between single spaces."""
    words = merge_on_delimiter(sounds, F.coalesce(F.col("text") == " ", F.lit(False)), key, order)
    return phoneme_overlap_runs(words.select(key, F.col("word").alias("i"), "start_time", "end_time", phoneme_form(F.col("text")).alias("heard")), variants, key)


def phoneme_overlap_runs(words: DataFrame, variants: DataFrame, key: str = "utt_id") -> DataFrame:
    """``(key, first_word, n, start_time, end_time)``: runs of words ``(key, i, start_time, end_time, heard)`` whose sounds match the
    ground truth. ``variants`` has ``key, m, j, heard``: a phoneme form of word ``j`` of the ``m`` words of the truth."""
    m = words.join(variants, [key, "heard"]).filter("i < m and j >= i").select(key, "i", "start_time", "end_time").distinct()
    # matches lie within the ground truth, so a recording has no more of them than its truth has words
    r = m.withColumn("k", F.col("i") - F.row_number().over(W.partitionBy(key).orderBy("i")))
    return r.groupBy(key, "k").agg(F.min("i").alias("first_word"), F.count(F.lit(1)).alias("n"), F.min_by("start_time", "i").alias("start_time"), F.max_by("end_time", "i").alias("end_time")).drop("k")


# --- nested form, for recordings of ordinary length

def silence_chunks(offsets: Column, silence_duration: float) -> Column:
    """Array of segments. No offsets give one empty segment."""
    n = F.size(offsets)
    gap = lambda i: F.round(F.get(offsets, i)["start_time"] - F.get(offsets, i - 1)["end_time"], 3)
    cuts = F.filter(F.sequence(F.lit(0), n), lambda i: (i == 0) | (i == n) | (gap(i) >= silence_duration))
    return F.when(n == 0, F.array(offsets)).otherwise(F.transform(F.sequence(F.lit(1), F.size(cuts) - 1), lambda k: F.slice(offsets, F.get(cuts, k - 1) + 1, F.get(cuts, k) - F.get(cuts, k - 1))))


def insert_tags(segment: Column, minimum_empty_duration: float, empty_tag: str = "<EMPTY>") -> Column:
    """One nested segment with a tag in every gap of at least the minimum."""
    after = lambda i: F.get(segment, i + 1)["start_time"]
    tag = lambda o, i: F.struct(F.lit(empty_tag).alias("text"), o["end_time"].alias("start_time"), after(i).alias("end_time"))
    return F.flatten(F.transform(segment, lambda o, i: F.when(F.round(after(i) - o["end_time"], 3) >= minimum_empty_duration, F.array(o, tag(o, i))).otherwise(F.array(o))))


def shift_segment(segment: Column) -> Column:
    first = F.get(segment, F.lit(0))["start_time"]
    return F.transform(
        segment, lambda o: F.struct(o["text"].alias("text"), F.round(o["start_time"] - first, 3).alias("start_time"), F.round(o["end_time"] - first, 3).alias("end_time"))
    )


def _blocks_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([[] if a is None or b is None else [{"at": i, "n": n} for i, n in equal_blocks(list(a), list(b))] for a, b in zip(left, right, strict=True)])


def overlap_blocks(words: Column, truth: Column) -> Column:
    """``array<struct<at, n>>``: stretches of ``words`` that the sequence matcher finds equal in ``truth``."""
    # nondeterministic for the planner, as it would run twice for the filter that an explosion implies
    return F.pandas_udf(_blocks_batch, "array<struct<at:int,n:int>>").asNondeterministic()(words, truth)


def word_overlap_chunks(offsets: Column, truth: Column) -> Column:
    """Segments of offsets whose texts match the ground truth, both lower-cased and stripped."""
    blocks = overlap_blocks(F.transform(offsets, lambda o: F.coalesce(fold(o["text"]), F.lit(""))), F.transform(truth, lambda w: F.coalesce(fold(w), F.lit(""))))
    return F.transform(blocks, lambda b: F.slice(offsets, b["at"] + 1, b["n"]))


def merge_sounds(offsets: Column) -> Column:
    """Nested sounds to words: joined between ``" "`` tokens; leading and repeated ones make no word."""
    n = F.size(offsets)
    cuts = F.concat(F.array(F.lit(-1)), F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(offsets, i)["text"] == " "), F.array(n))
    spans = F.filter(F.transform(F.sequence(F.lit(1), F.size(cuts) - 1), lambda k: F.slice(offsets, F.get(cuts, k - 1) + 2, F.get(cuts, k) - F.get(cuts, k - 1) - 1)), lambda s: F.size(s) > 0)
    words = F.transform(
        spans,
        lambda s: F.struct(
            F.array_join(F.transform(s, lambda o: o["text"]), " ").alias("text"), F.get(s, F.lit(0))["start_time"].alias("start_time"), F.get(s, F.size(s) - 1)["end_time"].alias("end_time")
        ),
    )
    return F.when(n > 0, words).otherwise(F.slice(words, 1, 0))


def overlap_matches(words: Column, variants: Column) -> Column:
    """Positions ``i`` of words that match: ``i`` lies within the ground truth, and some position from ``i`` on has the
    word among its variants."""
    m = F.size(variants)
    hit = lambda i: (i < m) & F.exists(F.slice(variants, i + 1, F.greatest(m - i, F.lit(0))), lambda v: F.array_contains(v, F.get(words, i)))
    return F.when(F.size(words) > 0, F.filter(F.sequence(F.lit(0), F.size(words) - 1), hit)).otherwise(F.array().cast("array<int>"))


def islands(found: Column) -> Column:
    """Runs of consecutive numbers in a sorted array, as ``array<struct<at, n>>``."""
    firsts = F.filter(found, lambda x: ~F.array_contains(found, x - 1))
    lasts = F.filter(found, lambda x: ~F.array_contains(found, x + 1))
    return F.transform(F.arrays_zip(firsts.alias("a"), lasts.alias("z")), lambda p: F.struct(p["a"].alias("at"), (p["z"] - p["a"] + 1).alias("n")))


def phoneme_overlap_chunks(offsets: Column, variants: Column) -> Column:
    """Segments of merged words whose sounds match the ground truth, given the variants of each of its words; no match
    gives no segment."""
    words = merge_sounds(offsets)
    said = F.transform(words, lambda w: phoneme_form(w["text"]))
    return F.transform(islands(overlap_matches(said, variants)), lambda b: F.slice(words, b["at"] + 1, b["n"]))


def variants_of(words: Column, lexicon: Column) -> Column:
    """Variants of each word in a ``map<string, array<string>>``; out of the lexicon a word stands for itself."""
    return F.transform(words, lambda w: F.coalesce(F.element_at(lexicon, fold(w)), F.array(fold(w))))


def normalised_lexicon(lexicon: DataFrame) -> DataFrame:
    """``(word, pronunciations)`` in phoneme form, one row per word as it is spelled."""
    return lexicon.filter("word is not null").withColumn("p", F.explode(pronunciations_form(F.col("pronunciations")))).groupBy("word").agg(F.array_sort(F.collect_set("p")).alias("pronunciations"))


def segment_manifest(chunks: DataFrame, audio: str, outdir: str, transcript: str, index: str = "segment") -> DataFrame:
    """``(wav_path, tsv_path, text)`` of each chunk; the text is the whole recording's."""
    out = F.lit(outdir)
    return chunks.select(
        chunk_path(F.col(audio), out, F.col(index), "wav").alias("wav_path"), chunk_path(F.col(audio), out, F.col(index), "tsv").alias("tsv_path"), F.col(transcript).alias("text")
    )
