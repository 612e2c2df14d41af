"""Command line: python -m cadenza {run,segment,periods,split,stats} INPUT OUTPUT [options]"""

from __future__ import annotations

import argparse
import importlib
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import RunConfig
from .functions.paths import with_suffix
from .operators.audio import cut_chunks, duration, wav_contents
from .operators.dataset import speaker_splits, total_duration
from .operators.offsets import clean_offsets
from .operators.periods import continuous_periods
from .operators.segment import long_chunks, segment_bounds, silence_segments
from .plans.pipeline import recordings_to_segments
from .runtime import materialize, ship
from .sources.readers import json_lexicon, offsets_json, utterances_from_folder, utterances_from_manifest
from .sources.writers import tsv_content, write_files, write_manifest

log = logging.getLogger("cadenza")


def build(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    df = spark.read.parquet(a.input)
    if a.command == "segment":
        return long_chunks(segment_bounds(silence_segments(clean_offsets(df), a.silence)), a.minimum)
    if a.command == "periods":
        return continuous_periods(df)
    if a.command == "split":
        return df.join(speaker_splits(df, "speaker", a.test, a.valid).select("speaker", F.col("split").alias("new_split")), "speaker")
    return total_duration(df, a.by, F.col(a.duration))


def _named(name: str | None):
    """``module:attribute``, or None."""
    return getattr(importlib.import_module(name.partition(":")[0]), name.partition(":")[2]) if name else None


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    """Labels the recordings of a folder or of a JSON manifest: chunks as WAV and TSV files and their manifest below the output.
    Returns the number of chunks."""
    manifest = a.input.endswith(".json")
    utterances = utterances_from_manifest(spark, a.input) if manifest else utterances_from_folder(spark, a.input)
    contents = wav_contents(spark, a.audio or (str(Path(a.input).parent) if manifest else a.input))
    lengths = contents.select("audio", duration(F.col("content")).alias("seconds"))
    transcripts = None
    if a.offsets:
        transcripts = offsets_json(spark, a.offsets).select(with_suffix(F.col("path"), ".wav").alias("audio"), "offsets")
    lexicon = json_lexicon(spark, a.lexicon) if a.lexicon else None
    chunks = materialize(
        recordings_to_segments(utterances, RunConfig.load(a.config), _named(a.transcriber), a.output, _named(a.classifier), lexicon, _named(a.noise), transcripts, lengths, _named(a.g2p))
    )
    write_files(chunks.withColumn("tsv", tsv_content("offsets")), "tsv_path", "tsv")
    cut = cut_chunks(chunks.select("audio", "wav_path", "first", "last"), contents, "first", "last")
    write_files(cut, "wav_path", "wav")
    write_manifest(chunks.select("wav_path", "tsv_path", "text"), f"{a.output}/manifest")
    n = chunks.count()
    log.info("%d chunks below %s", n, a.output)
    return n


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cadenza", description=__doc__)
    p.add_argument("command", choices=["run", "segment", "periods", "split", "stats"])
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--silence", type=float, default=0.0, help="seconds of silence that end a segment")
    p.add_argument("--minimum", type=float, default=0.2, help="seconds a chunk must last")
    p.add_argument("--test", type=float, default=0.1, help="share of the test split")
    p.add_argument("--valid", type=float, default=0.1, help="share of the validation split")
    p.add_argument("--by", default="language", help="column of stats")
    p.add_argument("--duration", default="duration", help="column with seconds")
    p.add_argument("--config", default="config.json", help="run: the configuration, JSON")
    p.add_argument("--audio", help="run: folder of the recordings a manifest names, by default its own")
    p.add_argument("--offsets", help="run: folder of offsets, a JSON file per recording, instead of a transcriber")
    p.add_argument("--lexicon", help="run: JSON object of words to pronunciations")
    for name in ("transcriber", "classifier", "noise", "g2p"):
        p.add_argument(f"--{name}", help=f"run: module:function that makes the {name}")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("cadenza").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    if a.command == "run":
        run(spark, a)
        return
    build(spark, a).write.mode("overwrite").parquet(a.output)


if __name__ == "__main__":
    main()
