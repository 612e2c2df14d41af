"""End-to-end plans: recordings to segments, and data set filtering. Everything is lazy; only transcription, the dear
step, is kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..backends import G2P, Classifier, Transcriber, classify, spoken, transcribe
from ..config import RunConfig
from ..functions.paths import chunk_path
from ..functions.text import fold, split_words
from ..operators.audio import NoiseScorer, score_gaps
from ..operators.dataset import keep_labelled, phonemes_match
from ..operators.lexicon import lookup, merge_lexicons
from ..operators.offsets import drop_blank_tokens, joined_text
from ..operators.segment import EXTRA_MS, insert_tags, normalised_lexicon, phoneme_overlap_chunks, shift_segment, silence_chunks, word_overlap_chunks
from ..runtime import materialize
from ..sources.readers import valid


def recordings_to_segments(
    utterances: DataFrame,
    config: RunConfig,
    transcriber: Callable[[], Transcriber] | None,
    outdir: str,
    classifier: Callable[[], Classifier] | None = None,
    lexicon: DataFrame | None = None,
    noise: Callable[[], NoiseScorer] | None = None,
    transcripts: DataFrame | None = None,
    lengths: DataFrame | None = None,
    g2p: Callable[[], G2P] | None = None,
) -> DataFrame:
    """``(audio, segment, first, last, offsets, text, wav_path, tsv_path)`` of the utterance table; ``first`` and ``last`` are the chunk's
    start and end in the recording.

    Rows that aren't a child's are dropped before transcription if the run classifies; recordings whose transcription
    fails, is empty or lacks text or times are left out. ``segment`` counts all segments, so chunks too short leave
    holes. ``text`` is the whole recording's. One row is one recording of ordinary length; a continuous feed belongs
    into the long-form operators. Gaps keep their empty tag unless ``noise`` names them. ``transcripts``, ``(audio, offsets)``, take
    the place of a transcriber; ``lengths``, ``(audio, seconds)``, bound the last chunk; ``g2p`` says words the lexicon lacks, which
    else stand for themselves.
    """
    s = config.segmenter
    u = utterances.filter("ground_truth <> ''") if config.filter_empty_transcript else utterances
    if config.do_classify:
        if classifier is None:
            raise ValueError("the run classifies but has no classifier")
        u = keep_labelled(u, classify(u, classifier), "audio", "child")
    if transcripts is None and transcriber is None:
        raise ValueError("the run has neither a transcriber nor transcripts")
    offsets = (materialize(transcribe(u, transcriber)) if transcripts is None else transcripts).withColumn("offsets", drop_blank_tokens(F.col("offsets"), s.keep_whitespace)).filter(valid(F.col("offsets")))
    rows = u.join(offsets, "audio").withColumn("text", joined_text(F.col("offsets")))
    if s.type == "silence":
        rows = rows.withColumn("segments", silence_chunks(F.col("offsets"), s.silence_duration))
    elif s.type == "word_overlap":
        rows = rows.withColumn("segments", word_overlap_chunks(F.col("offsets"), split_words(F.col("ground_truth"))))
    else:
        if lexicon is None:
            raise ValueError("phoneme overlap needs a lexicon")
        words = rows.select("audio", F.posexplode(split_words(F.col("ground_truth"))).alias("i", "w")).withColumn("word", fold(F.col("w")))
        found = lookup(words, normalised_lexicon(lexicon), fallback=spoken(g2p) if g2p else None).withColumnRenamed("pronunciations", "v")
        variants = found.groupBy("audio").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("variants"))
        rows = rows.join(variants, "audio").withColumn("segments", phoneme_overlap_chunks(F.col("offsets"), F.col("variants")))
    if config.do_noise_classify:
        rows = rows.withColumn("segments", F.transform("segments", lambda x: insert_tags(x, config.noise_classifier.minimum_empty_duration)))
    chunks = rows.select("audio", "text", F.posexplode("segments").alias("segment", "offsets")).filter(F.size("offsets") > 0)
    if config.do_noise_classify and noise is not None:
        chunks = materialize(chunks)
        gaps = chunks.select("audio", "segment", F.posexplode("offsets").alias("pos", "o")).filter("o.text = '<EMPTY>'").select("audio", "segment", "pos", "o.start_time", "o.end_time")
        found = score_gaps(gaps, noise, config.noise_classifier.threshold).groupBy("audio", "segment").agg(F.map_from_entries(F.collect_list(F.struct("pos", "label"))).alias("labels"))
        named = lambda o, i: F.coalesce(F.concat(F.lit("<"), F.element_at("labels", i), F.lit(">")), o["text"])
        tagged = F.transform("offsets", lambda o, i: F.struct(named(o, i).alias("text"), o["start_time"].alias("start_time"), o["end_time"].alias("end_time")))
        chunks = chunks.join(found, ["audio", "segment"], "left").withColumn("offsets", F.when(F.col("labels").isNotNull(), tagged).otherwise(F.col("offsets"))).drop("labels")
    stop = F.element_at("offsets", -1)["end_time"] * 1000 + EXTRA_MS
    if lengths is not None:
        chunks = chunks.join(lengths.select("audio", (F.col("seconds") * 1000).alias("__ms")), "audio", "left")
        stop = F.least(stop, F.col("__ms"))
    length = stop - F.get("offsets", F.lit(0))["start_time"] * 1000
    chunks = chunks.filter(F.round(length, 3) >= s.minimum_chunk_duration * 1000).withColumn("first", F.get("offsets", F.lit(0))["start_time"]).withColumn("last", F.element_at("offsets", -1)["end_time"])
    chunks = chunks.withColumn("offsets", shift_segment(F.col("offsets")))
    out = F.lit(outdir)
    return chunks.select(
        "audio", "segment", "first", "last", "offsets", "text", chunk_path(F.col("audio"), out, F.col("segment"), "wav").alias("wav_path"), chunk_path(F.col("audio"), out, F.col("segment"), "tsv").alias("tsv_path")
    )


def keep_matching(rows: DataFrame, key: str, text: str, transcript: str, *lexicons: DataFrame, g2p: Callable[[], G2P] | None = None) -> DataFrame:
    """Rows whose transcript, phoneme words between spaces, matches the variants of the text's words place by place. ``g2p`` says
    words the lexicons lack, which else stand for themselves."""
    words = rows.select(key, F.posexplode(split_words(F.col(text))).alias("i", "w")).withColumn("word", fold(F.col("w")))
    found = lookup(words, merge_lexicons(*lexicons), fallback=spoken(g2p) if g2p else None).withColumnRenamed("pronunciations", "v")
    variants = found.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("__variants"))
    good = F.coalesce(F.col(transcript) != "", F.lit(False)) & phonemes_match(split_words(F.col(transcript)), F.col("__variants"))
    return rows.join(variants, key).filter(good).drop("__variants")
