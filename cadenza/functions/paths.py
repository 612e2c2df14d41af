"""Columns taken from paths: ``{dir}/{lang-region}/{speaker}_{utt}.{ext}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def parent(path: Column) -> Column:
    """Name of the folder the file lies in; empty if there is none."""
    return F.substring_index(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), "/", -1)


def with_suffix(path: Column, suffix: str) -> Column:
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", ""), F.lit(suffix))


def language_of(code: Column) -> Column:
    return F.substring_index(code, "-", 1)


def speaker_of(path: Column) -> Column:
    """The base name up to the first underscore."""
    return F.substring_index(stem(path), "_", 1)


def chunk_path(audio: Column, outdir: Column, index: Column, ext: str) -> Column:
    """``{outdir}/{parent}/{stem}-{index}.{ext}``."""
    return F.concat(outdir, F.lit("/"), parent(audio), F.lit("/"), stem(audio), F.lit("-"), index.cast("string"), F.lit(f".{ext}"))


def outdir_path(audio: Column, outdir: Column) -> Column:
    return F.concat(outdir, F.lit("/"), parent(audio))
