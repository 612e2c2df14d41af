"""Text columns: trimming, normalisation, tokens, phonemes."""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Length marks, ties and stress signs taken off phonemes; tags taken out of transcripts.
DIACRITICS = "ːˑ̯̆͡‿̩͜ˈˌ"
TAGS = ("<comma>", "<period>", "<questionmark>", "<exclamationpoint>", "<sil>", "<music>", "<noise>", "<other>")

_ENDS = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, _ENDS, "")


def fold(c: Column) -> Column:
    """Lower case and stripped."""
    return strip(F.lower(c))


def transcript_form(c: Column) -> Column:
    """Punctuation to spaces, lower case, single spaces, then without tags (whose removal may leave double spaces)."""
    c = strip(F.regexp_replace(strip(F.lower(F.regexp_replace(c, r"[,?.!\-;:\"]", " "))), r"\s+", " "))
    for tag in TAGS:
        c = strip(F.regexp_replace(c, tag, ""))
    return c


def split_words(c: Column) -> Column:
    """Words between white space, without empty ones."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def tokens(c: Column) -> Column:
    """Lower-case words, numbers and punctuation runs of a text, without tokens that are a part of the ASCII
    punctuation string (so ``()`` goes and ``...`` stays)."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+(?:['’-][\p{L}\p{N}_]+)*|\.{2,}|[^\s\p{L}\p{N}_]+)"), 1)
    return F.filter(found, lambda t: ~F.lit(string.punctuation).contains(t))


def phoneme_form(c: Column) -> Column:
    """Phonemes without diacritics, stripped."""
    return strip(F.translate(c, DIACRITICS, ""))


def pronunciations_form(c: Column) -> Column:
    """The distinct phoneme forms of an array of pronunciations; null entries go."""
    return F.array_distinct(F.transform(F.filter(c, lambda p: p.isNotNull()), phoneme_form))


def glued(c: Column) -> Column:
    """Without any space."""
    return F.replace(c, F.lit(" "), F.lit(""))


_UNITS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_SCALES = ("thousand", "million", "billion", "trillion", "quadrillion")


def number_words(n: int) -> str:
    """English words of a whole number: hundreds joined by "and", scales by commas."""
    if n < 20:
        return _UNITS[n]
    if n < 100:
        return _TENS[n // 10 - 2] + (f"-{_UNITS[n % 10]}" if n % 10 else "")
    if n < 1000:
        return f"{_UNITS[n // 100]} hundred" + (f" and {number_words(n % 100)}" if n % 100 else "")
    groups = []
    while n:
        n, r = divmod(n, 1000)
        groups.append(r)
    if len(groups) > len(_SCALES) + 1:
        return " ".join(_UNITS[int(c)] for c in str(sum(g * 1000**i for i, g in enumerate(groups))))
    parts = [(number_words(g) + (f" {_SCALES[i - 1]}" if i else ""), i, g) for i, g in reversed(list(enumerate(groups))) if g]
    text = parts[0][0]
    for words, i, g in parts[1:]:
        text += (" and " if i == 0 and g < 100 else ", ") + words
    return text


def letters_without_marks(text: str) -> str:
    """Compatibility forms as ordinary letters, marks taken off; stands in for a full transliteration."""
    return unicodedata.normalize("NFKC", "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)))


def numbers_spelled(text: str) -> str:
    return _DIGITS.sub(lambda m: number_words(int(m.group())), text)


_DIGITS = re.compile(r"\d+")


def _each(f: Callable[[str], str]) -> Callable[[Column], Column]:
    """A text function as a column function, null giving null."""
    return F.pandas_udf(lambda s: pd.Series([None if t is None else f(t) for t in s], dtype=object), "string")


def aligner_form(c: Column) -> Column:
    """The form forced alignment works on: letters without marks, lower case, no ASCII punctuation, digits as English words,
    single spaces. Only texts that aren't ASCII and texts with digits go to Python, for that step alone."""
    foreign = F.octet_length(c) != F.char_length(c)
    c = F.when(foreign, _each(letters_without_marks)(F.when(foreign, c))).otherwise(c)
    c = F.regexp_replace(F.lower(c), r"[!-/:-@\[-`{-~]", "")
    counted = c.rlike(r"\p{Nd}")
    c = F.when(counted, _each(numbers_spelled)(F.when(counted, c))).otherwise(c)
    return F.regexp_replace(c, r"\s+", " ")


def int16_pcm(c: Column) -> Column:
    """Float samples to 16-bit, clipped to [-1, 1] and truncated."""
    return F.transform(c, lambda x: (F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)) * F.lit(32767.0)).cast("int").cast("smallint"))


def float_pcm(c: Column, width: int = 2) -> Column:
    """Whole samples of ``width`` bytes to floats in [-1, 1]."""
    return F.transform(c, lambda x: (x / F.lit(float(1 << (8 * width - 1)))).cast("float"))


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def greedy_log_probability(frames: Column) -> Column:
    """Sum over frames of the log of the largest softmax probability: minus the log of the sum of exp(x - max)."""
    return F.aggregate(
        F.transform(frames, lambda f: -F.ln(F.aggregate(f, F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - F.array_max(f).cast("double"))))),
        F.lit(0.0),
        lambda a, x: a + x,
    )
