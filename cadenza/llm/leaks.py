"""Evaluation passages inside training documents (problem 7).

Pigeonhole edit matching on words. An item is cut into consecutive pieces, short enough that any passage of
``min_words`` words with at most ``max_errors`` word edits holds one of its ``max_errors + 1`` pieces unchanged. One
automaton finds the exact hits of all pieces in a document's words; around each hit the passage is verified with
Myers' bit-parallel edit distance over words, and the unbroken run of equal words is measured.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Shared, materialize, once
from .lookalike import choose, plain_form, repair, suspects

_NO_WORD = re.compile(r"[\W_]+")


def word_list(text: str | None, vocabulary=frozenset()) -> list[str]:
    """Words of the consistent form: runs of letters or digits, lower-cased."""
    if not text:
        return []
    base = plain_form(text)
    if found := suspects(base):
        base = repair(base, choose(found, vocabulary))
    return _NO_WORD.sub(" ", base.lower()).split()


def piece_words(min_words: int, max_errors: int) -> int:
    """Words of a piece, so that any ``min_words`` consecutive words hold ``max_errors + 1`` whole pieces."""
    return max(1, (min_words + 1) // (max_errors + 2))


def myers(pattern: list[str], text: list[str], most: int) -> int | None:
    """Least edits between ``pattern`` and any stretch of ``text`` if no more than ``most``, else None. One step of the
    bit-parallel recurrence per word of the text."""
    m = len(pattern)
    if m == 0:
        return 0
    where: dict[str, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | (1 << i)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = mask, 0, m, m
    for w in text:
        eq = where.get(w, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (mask & ~(xh | up))
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph <<= 1
        mh <<= 1
        up = (mh | (mask & ~(xv | ph))) & mask
        down = ph & xv & mask
        best = min(best, score)
    return best if best <= most else None


class Matcher:
    """Automaton of the pieces of all items, with what verification needs."""

    def __init__(self, items: list[tuple[int, list[str]]], min_words: int, max_errors: int):
        import ahocorasick

        self.items, self.min_words, self.max_errors = items, min_words, max_errors
        self.size = piece_words(min_words, max_errors)
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, w) in enumerate(items):
            if len(w) >= min_words:
                for a in range(0, len(w) - self.size + 1, self.size):
                    places.setdefault(f" {' '.join(w[a : a + self.size])} ", []).append((k, a))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, (len(piece), at))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, words: list[str]) -> dict[int, tuple[int, int]]:
        """Item number to ``(longest run of equal words, least edits of a passage)``."""
        out: dict[int, tuple[int, int]] = {}
        if self.empty or len(words) < self.size:
            return out
        text = f" {' '.join(words)} "
        starts: list[int] | None = None
        done: dict[int, list[tuple[int, int, int]]] = {}
        m = self.min_words
        for last, (length, at) in self.automaton.iter(text):
            if starts is None:
                starts = list(accumulate((len(w) + 1 for w in words), initial=0))
            p = bisect_right(starts, last - length + 1) - 1
            for k, a in at:
                # a hit on a stretch of this diagonal that was measured already tells nothing new
                if any(d == p - a and x <= p < y for d, x, y in done.get(k, ())):
                    continue
                w = self.items[k][1]
                i, j = a, p
                while i and j and w[i - 1] == words[j - 1]:
                    i, j = i - 1, j - 1
                e, f = a + self.size, p + self.size
                while e < len(w) and f < len(words) and w[e] == words[f]:
                    e, f = e + 1, f + 1
                done.setdefault(k, []).append((p - a, j, f))
                run, edits = e - i, None
                if run >= m:
                    edits = 0
                elif self.max_errors:
                    edits = self._verify(w, words, a, p)
                if edits is not None:
                    old = out.get(k)
                    out[k] = (run, edits) if old is None else (max(run, old[0]), min(edits, old[1]))
        return out

    def _verify(self, w: list[str], words: list[str], a: int, p: int) -> int | None:
        m, e = self.min_words, self.max_errors
        best = None
        for s in range(max(0, a + self.size - m), min(a, len(w) - m) + 1):
            lo = max(0, p - (a - s) - e)
            got = myers(w[s : s + m], words[lo : lo + m + 2 * e], e if best is None else best - 1)
            if got is not None:
                best = got
                if best <= 1:
                    break
        return best


def _scan(items: Shared, min_words: int, max_errors: int):
    """Scans documents with the automaton of the items, made once per Python worker."""

    def make() -> tuple[Matcher, set[str]]:
        texts, known = items.value
        listed = [(i, word_list(t, known)) for i, t in texts]
        return Matcher(listed, min_words, max_errors), {x for _, w in listed for x in w}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, vocabulary = once(("items", items.id, min_words, max_errors), make)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["id"], pdf["text"], strict=True):
                for k, (length, edits) in matcher.find(word_list(text, vocabulary)).items():
                    rows.append((doc, matcher.items[k][0], length, edits))
            yield pd.DataFrame(rows, columns=["id", "item", "run_words", "edits"])

    return run


def _known(texts: list[str], docs: DataFrame) -> set[str]:
    """Of the forms that tokens of items may be repaired to, those that the corpus holds; the documents are read only if
    there are such tokens and the items themselves lack the forms."""
    said: set[str] = set()
    wanted: set[str] = set()
    for t in texts:
        base = plain_form(t)
        found = suspects(base)
        wanted |= {fix.lower() for _, fix, _ in found}
        said |= set(_NO_WORD.sub(" ", base.lower()).split()) - {token.lower() for token, _, _ in found}
    known, wanted = wanted & said, wanted - said
    if wanted:
        spark = docs.sparkSession
        asked = F.broadcast(spark.createDataFrame([(w,) for w in sorted(wanted)], "word string"))
        spoken = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("word"))
        known |= {r["word"] for r in spoken.join(asked, "word", "left_semi").distinct().collect()}
    return known


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = 12,
    max_errors: int = 1,
    shard_chars: int = 20_000_000,
) -> DataFrame:
    """``(doc_id, item_id, run_words, edits)``: documents that hold a passage of at least ``min_words`` words of an item
    with at most ``max_errors`` word edits; ``run_words`` is the longest unbroken run of equal words at such a place, and
    ``edits`` is 0 where it has ``min_words`` or more.

    Items of fewer words, null and blank texts and null ids take no part; a repeated row counts once per document and
    item. The items are held by every Python worker, so they are cut into shards of about ``shard_chars`` characters and the
    documents are scanned once per shard, one shard after the other. Documents are read in place, without a shuffle. Whole
    texts are scanned. Further columns are ignored; an empty table gives an empty result.

    Words are those of the consistent form by the vocabulary of items and documents: a token of a document is repaired where
    the result is a word of an item, as other repairs can't make a passage of one; a token of an item where the items or
    the documents hold the result.
    """
    if min_words < 1 or max_errors < 0 or max_errors + 2 > min_words + 1:
        raise ValueError("min_words must exceed max_errors")
    texts = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).cast("string").alias("text")).filter("id is not null and text is not null").distinct()
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-int(chars) // shard_chars))
    source = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(doc_text).cast("string").alias("text")).filter(F.col("id").isNotNull() & (F.length("text") >= min_words))
    found = None
    for s in range(shards):
        part = texts if shards == 1 else texts.filter(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == s)
        held = [(r["id"], r["text"]) for r in part.collect()]
        items_held = Shared(docs.sparkSession, (held, _known([t for _, t in held], source)))
        hits = source.mapInPandas(_scan(items_held, min_words, max_errors), "id bigint, item bigint, run_words int, edits int")
        if shards > 1:  # one shard after the other, so that one is held at a time
            hits = materialize(hits)
            items_held.broadcast.destroy()
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy(F.col("id").alias(doc_id), F.col("item").alias(item_id)).agg(F.max("run_words").alias("run_words"), F.min("edits").alias("edits"))
