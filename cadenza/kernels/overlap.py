"""Sequence matching of token lists."""

from __future__ import annotations

from difflib import SequenceMatcher


def equal_blocks(words: list[str], truth: list[str]) -> list[tuple[int, int]]:
    """``(start, length)`` in ``words`` of each stretch equal in ``truth``, neighbours of one opcode joined; popular
    tokens of long truths are no anchors, as is the matcher's default."""
    return [(i, j - i) for tag, i, j, _, _ in SequenceMatcher(None, words, truth).get_opcodes() if tag == "equal"]


def ratio(a: str, b: str) -> float:
    """Twice the matched length over the total length."""
    return SequenceMatcher(None, a, b).ratio()
