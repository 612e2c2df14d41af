"""Validated run configuration."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

TRANSCRIBERS = ("wav2vec2", "whisper", "parakeet")
SEGMENTERS = ("silence", "word_overlap", "phoneme_overlap")


@dataclass(frozen=True)
class ClassifierConfig:
    model: str
    max_duration_s: float = 3.0
    batch_size: int = 1


@dataclass(frozen=True)
class NoiseClassifierConfig:
    model: str
    minimum_empty_duration: float = 1.0
    threshold: float = 0.3
    batch_size: int = 1


@dataclass(frozen=True)
class TranscriberConfig:
    type: str
    model: str
    return_timestamps: str | bool
    chunk_length_s: int | None = None
    transcriber_device: str = "cuda"

    def __post_init__(self) -> None:
        if self.type not in TRANSCRIBERS:
            raise ValueError(f"transcriber type {self.type!r} is none of {TRANSCRIBERS}")
        allowed = {"wav2vec2": ("word", "char"), "parakeet": ("word",), "whisper": (True,)}[self.type]
        if not any(self.return_timestamps is a or (isinstance(a, str) and self.return_timestamps == a) for a in allowed):
            raise ValueError(f"{self.type} can't return timestamps {self.return_timestamps!r}, only {allowed}")
        if self.type != "parakeet" and self.chunk_length_s is None:
            raise ValueError(f"{self.type} needs chunk_length_s")


@dataclass(frozen=True)
class SegmenterConfig:
    type: str
    silence_duration: float = 0.0
    minimum_chunk_duration: float = 0.2
    lexicon_path: str | None = None
    keep_whitespace: bool = False
    segment_with_ground_truth: bool = False

    def __post_init__(self) -> None:
        if self.type not in SEGMENTERS:
            raise ValueError(f"segmenter type {self.type!r} is none of {SEGMENTERS}")


@dataclass(frozen=True)
class RunConfig:
    transcriber: TranscriberConfig
    segmenter: SegmenterConfig
    do_classify: bool = False
    do_noise_classify: bool = False
    filter_empty_transcript: bool = False
    classifier: ClassifierConfig | None = None
    noise_classifier: NoiseClassifierConfig | None = None
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, c: dict) -> RunConfig:
        """Sub-sections are read only where their flag is set; unknown keys in a section are a TypeError."""
        flags = {k: bool(c.get(k, False)) for k in ("do_classify", "do_noise_classify", "filter_empty_transcript")}
        return cls(
            TranscriberConfig(**c["transcriber"]),
            SegmenterConfig(**c["segmenter"]),
            **flags,
            classifier=ClassifierConfig(**c["classifier"]) if flags["do_classify"] else None,
            noise_classifier=NoiseClassifierConfig(**c["noise_classifier"]) if flags["do_noise_classify"] else None,
        )

    @classmethod
    def load(cls, path: str) -> RunConfig:
        return cls.from_dict(json.loads(Path(path).read_text(encoding="utf-8")))
