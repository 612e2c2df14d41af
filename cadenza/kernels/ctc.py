"""Forced alignment of labels to frame log-probabilities (CTC, blank 0)."""

from __future__ import annotations

from itertools import accumulate, pairwise

import numpy as np


def align(log_probs: np.ndarray, targets: list[int], blank: int = 0) -> tuple[list[int], np.ndarray]:
    """``(label of each frame, its probability)`` on the best path; ValueError if the frames are too few."""
    frames, n = len(log_probs), len(targets)
    repeats = sum(a == b for a, b in zip(targets, targets[1:], strict=False))
    if frames < n + repeats:
        raise ValueError("the targets are too long for the frames")
    states = [blank]
    for t in targets:
        states += [t, blank]
    s = np.array(states)
    skip = np.zeros(len(s), dtype=bool)
    skip[2:] = (s[2:] != blank) & (s[2:] != s[:-2])
    score = np.full(len(s), -np.inf)
    score[: min(2, len(s))] = log_probs[0, s[: min(2, len(s))]]
    back = np.zeros((frames, len(s)), dtype=np.int8)
    for t in range(1, frames):
        one = np.concatenate(([-np.inf], score[:-1]))
        two = np.where(skip, np.concatenate(([-np.inf, -np.inf], score[:-2]))[: len(s)], -np.inf)
        options = np.stack([score, one, two])
        back[t] = options.argmax(axis=0)
        score = options.max(axis=0) + log_probs[t, s]
    at = len(s) - 1 if len(s) == 1 or score[-1] >= score[-2] else len(s) - 2
    path = []
    for t in range(frames - 1, -1, -1):
        path.append(at)
        at -= int(back[t, at])
    labels = [int(s[p]) for p in path[::-1]]
    return labels, np.exp(log_probs[np.arange(frames), labels])


def spans(labels: list[int], probs: np.ndarray, blank: int = 0) -> list[tuple[int, int, int, float]]:
    """``(label, first frame, frame after the last, mean probability)`` of each run of one label, blanks aside."""
    out, a = [], 0
    for t in range(1, len(labels) + 1):
        if t == len(labels) or labels[t] != labels[a]:
            if labels[a] != blank:
                out.append((labels[a], a, t, float(np.mean(probs[a:t]))))
            a = t
    return out


def by_lengths(items: list, lengths: list[int]) -> list[list]:
    """``items`` regrouped by the given lengths, which must add up."""
    ends = list(accumulate(lengths, initial=0))
    if ends[-1] != len(items):
        raise ValueError("lengths don't add up")
    return [items[a:b] for a, b in pairwise(ends)]


def word_times(log_probs: np.ndarray, words: list[str], labels: dict[str, int], samples: int, rate: int) -> list[tuple[str, float, float]]:
    """``(word, start, end)`` in seconds at 2 places; a word ends where its last label's span starts."""
    path, probs = align(log_probs, [labels[c] for w in words for c in w])
    unit = samples / len(log_probs) / rate
    groups = by_lengths(spans(path, probs), [len(w) for w in words])
    return [(w, round(unit * g[0][1], 2), round(unit * g[-1][1], 2)) for w, g in zip(words, groups, strict=True) if g]


def alignment_score(log_probs: np.ndarray, targets: list[int]) -> float:
    """Sum of the path's log-probabilities less that of the best label of each frame, per frame; minus infinity if
    the targets don't fit."""
    try:
        _, probs = align(log_probs, targets)
    except ValueError:
        return float("-inf")
    return float((np.log(probs).sum() - log_probs.max(axis=1).sum()) / len(log_probs))


def chunks(samples: int, size: int, least: int = 400) -> list[tuple[int, int]]:
    """Fixed chunks of a recording's samples; a tail shorter than ``least`` is dropped."""
    return [(a, min(a + size, samples)) for a in range(0, samples, size) if min(a + size, samples) - a >= least]
