"""Punctuation put back into recognised phonemes."""

from __future__ import annotations

import math
import re
from difflib import SequenceMatcher
from functools import lru_cache
from statistics import stdev

PUNCTUATIONS = ("?", ",", ".", "!", ";")


def parts_of(phonemes: list[str], punctuations: tuple[str, ...] = PUNCTUATIONS) -> tuple[list[str], list[str]]:
    """``(stretches with the punctuation between them, stretches without)`` of a phoneme list joined by spaces."""
    pattern = "([" + re.escape("".join(punctuations)) + "])"
    parts = [p.strip() for p in re.split(pattern, " ".join(phonemes))]
    parts = [p for p in parts if p]
    return parts, [p for p in parts if p not in punctuations]


def best_cut(texts: list[str], against: list[str], m: int, target: float) -> tuple[int, ...] | None:
    """The ends of ``m`` consecutive stretches of ``texts``, none empty, whose sizes deviate within 1 of ``target`` and which are
    most similar to the first ``m`` of ``against``, place by place; of equally similar ones the first in order.

    A dynamic programme over where a stretch ends and the sum of squared sizes up to there, which settles the deviation as
    the sizes add up to all texts. States that can't come within the deviation any more are left out."""
    n = len(texts)
    low, high = 0.0, math.inf
    if m > 1:  # of the squares: the deviation squared is their sum less n * n / m, over m - 1
        low = max(target - 1, 0.0) ** 2 * (m - 1) + n * n / m - 1e-6 * n
        high = (target + 1) ** 2 * (m - 1) + n * n / m + 1e-6 * n
    letters = set(" ".join(texts))
    matchers = [None if letters.isdisjoint(x) else SequenceMatcher(None, "", x) for x in against[:m]]

    @lru_cache(maxsize=None)
    def similar(a: int, b: int, k: int) -> float:
        if matchers[k] is None:
            return 0.0
        matchers[k].set_seq1(" ".join(texts[a:b]))
        return matchers[k].ratio()

    states: dict[tuple[int, int], tuple[float, tuple[int, ...]]] = {(0, 0): (0.0, ())}
    for k in range(m):
        left = m - 1 - k
        after: dict[tuple[int, int], tuple[float, tuple[int, ...]]] = {}
        for (at, squares), (score, ends) in states.items():
            for end in range(n, n + 1) if not left else range(at + 1, n - left + 1):
                q, rest = squares + (end - at) ** 2, n - end
                if (q + rest * rest / left if left else q) > high or (q + (rest - left + 1) ** 2 + left - 1 if left else q) < low:
                    continue
                got = score + similar(at, end, k)
                old = after.get((end, q))
                if old is None or got > old[0] or got == old[0] and (*ends, end) < old[1]:
                    after[end, q] = (got, (*ends, end))
        states = after
    fitting = []
    for (_, q), (score, ends) in states.items():
        deviation = math.sqrt(max(0.0, (q * m - n * n) / (m * (m - 1)))) if m > 1 else target
        if target - 1 <= deviation <= target + 1:
            fitting.append((-score / m, ends))
    return min(fitting)[1] if fitting else None


def place_punctuation(texts: list[str], starts: list[float], ends: list[float], truth: list[str], punctuations: tuple[str, ...] = PUNCTUATIONS, paired: str = "as_is") -> list[tuple[str, float, float]]:
    """The offsets with punctuation. The recognised texts are cut into as many stretches as the truth has, of sizes whose
    deviation is within 1 of the truth's, the first of the most similar. Stretches are compared with the truth's parts in
    order, punctuation included (``paired="cleaned"`` leaves it out). No fitting cut is an error."""
    parts, clean = parts_of(truth, punctuations)
    n, m = len(texts), len(clean)
    cuts = best_cut(texts, clean if paired == "cleaned" else parts, m, stdev([len(p.split()) for p in clean]) if m > 1 else 0.0) if 0 < m <= n else None
    if cuts is None:
        raise ValueError("no cut of the recognised phonemes fits the truth")
    bounds = iter(zip((0, *cuts), cuts, strict=False))
    out: list[tuple[str, float, float]] = []
    at = 0
    for p in parts:
        if p in punctuations:
            begin = out[-1][2] if out else starts[0]
            out.append((p, begin, starts[at] if at < n else begin))
        else:
            a, at = next(bounds)
            out += zip(texts[a:at], starts[a:at], ends[a:at], strict=True)
    return out
