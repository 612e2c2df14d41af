"""Recordings as files: durations, chunks cut out of them, and noise labels for gaps."""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..backends import resampled, wav_bytes, wav_duration, wav_samples


class NoiseScorer(Protocol):
    def scores(self, audio: str, start: float, end: float) -> list[tuple[str, float]]:
        """Labels with scores of a stretch of a recording."""


def wav_contents(spark: SparkSession, path: str) -> DataFrame:
    """``(audio, content)`` of the WAV files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true").load(path).filter("length > 0")
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("audio"), "content")


def _durations(content: pd.Series) -> pd.Series:
    out = []
    for c in content:
        try:
            out.append(None if c is None else wav_duration(bytes(c)))
        except Exception:  # noqa: BLE001 - a broken file has no duration
            out.append(None)
    return pd.Series(out, dtype="float64")


def duration(content: Column) -> Column:
    """Seconds of WAV contents; null where they can't be read."""
    return F.pandas_udf(_durations, "double")(content)


def cut_chunks(chunks: DataFrame, contents: DataFrame, start: str = "start_time", end: str = "end_time", extra_ms: int = 50, batch: int = 16, to_rate: int | None = None) -> DataFrame:
    """``chunks`` with ``wav``: the stretch of the recording ``audio`` from ``start`` to ``extra_ms`` beyond ``end``, no
    further than its length, as a 16-bit mono file, at ``to_rate`` if it is given. All chunks of a recording are cut from one reading of it."""
    listed = chunks.groupBy("audio").agg(F.collect_list(F.struct(*chunks.columns)).alias("c")).join(contents, "audio")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema.fields) + ", wav binary"
    names = chunks.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for items, content in zip(pdf["c"], pdf["content"], strict=True):
                x, rate = wav_samples(bytes(content))
                if to_rate and rate != to_rate:
                    x, rate = resampled(x, rate, to_rate), to_rate
                rows = []
                for r in items:
                    a, b = round(r[start] * rate), min(round((r[end] + extra_ms / 1000) * rate), len(x))
                    rows.append([*(r[n] for n in names), wav_bytes(x[a:b], rate)])
                    if len(rows) == batch:
                        yield pd.DataFrame(rows, columns=[*names, "wav"])
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=[*names, "wav"])

    return listed.mapInPandas(run, schema)


def fixed_chunks(df: DataFrame, samples: str, size: int, least: int = 400) -> DataFrame:
    """``df`` with ``k, first_sample, end_sample`` of its chunks of ``size`` samples; a tail shorter than ``least`` is dropped, and a row
    of no samples gives none."""
    n = F.col(samples).cast("bigint")
    k = df.filter(n > 0).withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / size))))
    return k.withColumns({"first_sample": F.col("k") * size, "end_sample": F.least(n, (F.col("k") + 1) * size)}).filter(F.col("end_sample") - F.col("first_sample") >= least)


def strided_chunks(samples: Column, chunk: int, left: int | None = None, right: int | None = None) -> Column:
    """``array<struct<first, end, left, right>>``: overlapping chunks of a recording, a sixth of the chunk on each side by default; the
    outer ends have no overlap. Chunks that would be nothing but overlap are left out."""
    left = round(chunk / 6) if left is None else left
    right = round(chunk / 6) if right is None else right
    if chunk < left + right:
        raise ValueError("the chunk is shorter than its overlaps")
    step = max(chunk - left - right, 1)
    n = samples.cast("bigint")
    last = (lambda a: a + chunk >= n) if right == 0 else (lambda a: a + chunk > n)
    starts = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(step).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    own = lambda a: F.when(a == 0, 0).otherwise(left)
    # those up to the first that reaches the end, which have more than their overlap
    kept = F.filter(starts, lambda a: ((a == 0) | ~last(a - step)) & (F.least(a + chunk, n) - a > own(a)))
    return F.transform(kept, lambda a: F.struct(a.alias("first"), F.least(a + chunk, n).alias("end"), own(a).cast("int").alias("left"), F.when(last(a), 0).otherwise(right).cast("int").alias("right")))


def padded(samples: Column, length: int) -> Column:
    """Samples cut or filled with zeros to ``length``, for a batch of equal inputs; null stays null."""
    cut = F.slice(samples, 1, length)
    return F.concat(cut, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), length - F.size(cut))))


def convert_audio(df: DataFrame, source: str, target: str, rate: int = 16_000, channels: int = 1) -> DataFrame:
    """``df`` with ``converted``: whether ffmpeg made the file ``target`` out of ``source``, at a rate and number of channels. Both name
    columns with paths the executors have; without ffmpeg it's an error."""
    if shutil.which("ffmpeg") is None:
        raise RuntimeError("ffmpeg isn't there")

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            made = subprocess.run(["ffmpeg", "-y", "-i", x, "-acodec", "pcm_s16le", "-ac", str(channels), "-ar", str(rate), y], capture_output=True)
            out.append(made.returncode == 0)
        return pd.Series(out)

    return df.withColumn("converted", F.pandas_udf(run, "boolean")(source, target))


def long_enough(samples: Column, least: int = 1600) -> Column:
    """Whether an array has more than ``least`` samples."""
    return F.size(samples) > least


def score_gaps(tags: DataFrame, make: Callable[[], NoiseScorer], threshold: float) -> DataFrame:
    """``(audio, segment, pos, label)``: the best label at or above the threshold of each gap ``(audio, segment, pos, start_time,
    end_time)``; gaps without one give no row, so none takes another's label. Of equal scores the first label wins."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            rows = []
            for a, s, p, x, y in zip(pdf["audio"], pdf["segment"], pdf["pos"], pdf["start_time"], pdf["end_time"], strict=True):
                good = [(-v, n) for n, v in model.scores(a, x, y) if v >= threshold]
                if good:
                    rows.append((a, s, p, min(good)[1]))
            yield pd.DataFrame(rows, columns=["audio", "segment", "pos", "label"])

    return tags.select("audio", "segment", "pos", "start_time", "end_time").mapInPandas(run, "audio string, segment int, pos int, label string")
