"""Models behind interfaces: transcribers, classifiers, multilabel scorers, grapheme-to-phoneme. Inference runs in
``mapInPandas``, one model per Python worker. The stand-ins here are deterministic and need no weights."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import schemas


class Transcriber(Protocol):
    def transcribe(self, audio: str) -> list[tuple[str, float, float]] | None:
        """Offsets of one recording; None if it can't be transcribed."""


class Classifier(Protocol):
    def scores(self, audio: str) -> list[tuple[str, float]]:
        """Labels with scores."""


class G2P(Protocol):
    def phonemes(self, text: str) -> list[str]:
        """A phoneme string per word, punctuation kept."""


class DictionaryG2P:
    """Phonemes from a dictionary; words that lack there are spelled letter by letter. ``rule`` mends a word's phonemes."""

    def __init__(self, words: dict[str, str], punctuation: str = "?,.!;", rule: Callable[[str, list[str]], list[str]] | None = None):
        self.words, self.punctuation, self.rule = words, punctuation, rule

    def _word(self, word: str) -> str:
        said = self.words.get(word, " ".join(word)).split()
        return " ".join(self.rule(word, said) if self.rule else said)

    def phonemes(self, text: str) -> list[str]:
        spaced = "".join(f" {c} " if c in self.punctuation else c for c in text.lower())
        return [w if w in self.punctuation else self._word(w) for w in spaced.split()]


def velar_nasal(word: str, phonemes: list[str], written: str = "ng", prenasal: str = "ᵑg", nasal: str = "ŋ") -> list[str]:
    """Swahili ``ng'`` is a velar nasal alone: of the prenasalised stops of a word those written with an apostrophe become one.
    Where the letters and the stops don't correspond, the phonemes stay."""
    places = [i for i, p in enumerate(phonemes) if p == prenasal]
    marked = [part.startswith("'") for part in word.split(written)[1:]]
    if len(places) != len(marked):
        return list(phonemes)
    plain = {i for i, m in zip(places, marked, strict=True) if m}
    return [nasal if i in plain else p for i, p in enumerate(phonemes)]


#: Languages with a converter, and the rule of each.
_RULES: dict[str, Callable | None] = {"en": None, "id": None, "sw": velar_nasal}
_MAKERS: dict[str, Callable[[dict[str, str]], G2P]] = {}


def register_g2p(language: str, make: Callable[[dict[str, str]], G2P]) -> None:
    """Converter of a language, made of a dictionary of its words."""
    _MAKERS[language.lower()] = make


def get_g2p(code: str, words: dict[str, str]) -> G2P:
    """The converter for a language code, whose region (``en-US``) doesn't matter; NotImplementedError if there is none."""
    language = code.split("-")[0].lower()
    if language in _MAKERS:
        return _MAKERS[language](words)
    if language not in _RULES:
        raise NotImplementedError(f"no phonemes for {code}")
    return DictionaryG2P(words, rule=_RULES[language])


def spoken(make: Callable[[], G2P]) -> Callable[[Column], Column]:
    """A column function from words to their phonemes, for words a lexicon lacks; the converter is made once per batch."""

    def run(words: pd.Series) -> pd.Series:
        g2p = make()
        return pd.Series([None if w is None else " ".join(g2p.phonemes(w)) for w in words], dtype=object)

    return F.pandas_udf(run, "string")


def transcribe(df: DataFrame, make: Callable[[], Transcriber], key: str = "audio") -> DataFrame:
    """``(key, offsets)``; ``make`` is called once per task. Failed recordings have null offsets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            cells = []
            for a in pdf[key]:
                o = model.transcribe(a)
                cells.append(None if o is None else [{"text": t, "start_time": round(s, 3), "end_time": round(e, 3)} for t, s, e in o])
            yield pd.DataFrame({key: pdf[key], "offsets": pd.Series(cells, dtype=object)})

    return df.select(key).mapInPandas(run, f"`{key}` string, offsets {schemas.OFFSETS}")


def classify(df: DataFrame, make: Callable[[], Classifier], key: str = "audio", threshold: float | None = None) -> DataFrame:
    """``(key, scores)``: labels at or above the threshold, or all; rows without any keep an empty array."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            cells = [[{"label": n, "score": float(s)} for n, s in model.scores(a) if threshold is None or s >= threshold] for a in pdf[key]]
            yield pd.DataFrame({key: pdf[key], "scores": pd.Series(cells, dtype=object)})

    return df.select(key).mapInPandas(run, f"`{key}` string, scores {schemas.SCORES}")


def wav_samples(content: bytes) -> tuple[np.ndarray, int]:
    """``(samples in [-1, 1] of the first channel, rate)`` of a PCM file."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels = w.getsampwidth(), w.getnchannels()
        raw = np.frombuffer(w.readframes(w.getnframes()), dtype={1: np.uint8, 2: np.int16, 4: np.int32}[width])
        x = raw.astype(np.float32)[::channels]
        return (x - 128) / 128 if width == 1 else x / float(1 << (8 * width - 1)), w.getframerate()


def resampled(samples: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Samples at another rate, by linear interpolation between neighbours."""
    n = round(len(samples) * to / rate)
    return np.interp(np.arange(n) * rate / to, np.arange(len(samples)), samples).astype(np.float32) if len(samples) else samples


def wav_duration(content: bytes) -> float:
    """Seconds, from the header."""
    with wave.open(io.BytesIO(content)) as w:
        return w.getnframes() / w.getframerate()


def wav_bytes(samples: np.ndarray, rate: int = 16_000) -> bytes:
    """A 16-bit mono file of samples in [-1, 1], truncated."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype(np.int16).tobytes())
    return out.getvalue()
