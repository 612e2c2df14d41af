"""Explicit schemas of all record kinds."""

from __future__ import annotations

UTTERANCE = "audio string, id string, language_code string, language string, ground_truth string"
OFFSET = "struct<text:string,start_time:double,end_time:double>"
OFFSETS = f"array<{OFFSET}>"
SEGMENTS = f"array<{OFFSETS}>"
INPUT_MANIFEST = "audio string, text string, id string, speaker string, accent string, language string"
SEGMENT_MANIFEST = "wav_path string, tsv_path string, text string"
ALIGNER_MANIFEST = "audio_filepath string, text string, words_level_ctm_filepath string"
SEGMENT_TSV = "start_time double, end_time double, label string"
EXPLORER_MANIFEST = "audio_filepath string, duration double, text string"
SCORES = "array<struct<label:string,score:double>>"
LEXICON = "word string, pronunciations array<string>"
CTM = "utt string, channel string, start_time double, end_time double, text string"
EMISSIONS = "array<array<float>>"
AUDIO = "struct<path:string,array:array<float>,sampling_rate:int>"
