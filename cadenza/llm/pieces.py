"""Splitting oversized recordings at natural boundaries (problem 1).

The time-stamped text of a recording is read as a structure tree: its chapters, in them ever shorter pauses, and
single words as leaves. Chapters are cut without looking at the whole recording: every window of the time of a
long recording has its longest pause as a chapter border, so a continuous feed is many groups of bounded time.
Within a chapter sibling subtrees are merged bottom-up to the limit, and only an oversized node is descended into.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators.periods import to_ms
from ..runtime import materialize

CHAPTER_MS = 600_000
#: Pauses, in ms, that open a level of the tree, the widest first; below them come word starts, then any time.
LEVELS = (5000, 2000, 1000, 500, 250, 100, 1)


def pack_chapter(start: np.ndarray, end: np.ndarray, lo: int, hi: int, limit: int, reach0: int | None = None) -> list[int]:
    """Cut times between ``lo`` and ``hi`` so that no stretch is longer than ``limit``. ``start`` is sorted;
    ``reach0`` is the latest end of what came before.

    A cut lies in the middle of a pause where an oversized node has one, else at the start of a word, else (a word
    longer than the limit) evenly.
    """
    if hi - lo <= limit:
        return []
    ends = np.maximum.accumulate(end) if len(end) else end
    if reach0 is not None and len(ends):
        ends = np.maximum(ends, reach0)
    gaps = start[1:] - ends[:-1]

    def build(a: int, b: int, left: int, right: int, level: int) -> list[tuple[int, int]]:
        if right - left <= limit:
            return [(left, right)]
        at: list[int] = []
        borders: list[int] = []
        while not borders and level < len(LEVELS):
            if b - a > 1:
                at = (np.flatnonzero(gaps[a : b - 1] >= LEVELS[level]) + a + 1).tolist()
                borders = [int(ends[i - 1] + gaps[i - 1] // 2) for i in at]
            level += 1
        if not borders and level == len(LEVELS):
            for i in range(a + 1, b):
                if left < start[i] < right and (not borders or start[i] > borders[-1]):
                    at.append(i)
                    borders.append(int(start[i]))
            level += 1
        if not borders:
            n = -(-(right - left) // limit)
            marks = [left + (right - left) * k // n for k in range(n + 1)]
            return list(zip(marks, marks[1:], strict=False))
        edges, ids = [left, *borders, right], [a, *at, b]
        out: list[tuple[int, int]] = []
        for k in range(len(edges) - 1):
            for piece in build(ids[k], ids[k + 1], edges[k], edges[k + 1], level):
                if out and piece[1] - out[-1][0] <= limit:
                    out[-1] = (out[-1][0], piece[1])
                else:
                    out.append(piece)
        return out

    return [e for _, e in build(0, len(start), lo, hi, 0)[:-1]]


_PIECES = "array<struct<start_ms:bigint,end_ms:bigint,at:int,n:int>>"


def _pieces_batch(limit_ms: int, overlap_ms: int):
    def run(starts: pd.Series, ends: pd.Series, lo: pd.Series, hi: pd.Series, reach: pd.Series, least: pd.Series) -> pd.Series:
        out = []
        for s, e, x, y, r, f in zip(starts, ends, lo, hi, reach, least, strict=True):
            s, e = np.asarray(s, dtype=np.int64), np.asarray(e, dtype=np.int64)
            k = int(np.searchsorted(s, x))  # before it: what the overlap reaches back to
            marks = [int(x), *pack_chapter(s[k:], e[k:], int(x), int(y), limit_ms - overlap_ms, None if pd.isna(r) else int(r)), int(y)]
            cell = []
            for a, b in zip(marks, marks[1:], strict=False):
                a = max(a - overlap_ms, int(f))
                p, q = (int(v) for v in np.searchsorted(s, [a, b]))
                cell.append({"start_ms": a, "end_ms": b, "at": p + 1, "n": q - p})
            out.append(cell)
        return pd.Series(out)

    return run


def split_recordings(
    df: DataFrame,
    key: str = "utt_id",
    start: str = "start_time",
    end: str = "end_time",
    text: str = "text",
    pos: str = "pos",
    limit_s: float = 30.0,
    overlap_s: float = 2.0,
    chapter_ms: int = CHAPTER_MS,
) -> DataFrame:
    """``(key, chapter_ms, piece, start_ms, end_ms, n_items, text, oversized)``: each recording as consecutive pieces
    of at most ``limit_s``, each starting ``overlap_s`` before the end of the one before (or where the recording starts,
    if that is later); ``piece`` counts from 0
    within the chapter that starts at ``chapter_ms``. Recordings within the limit come out as one piece with
    ``oversized`` false.

    Times are rounded to milliseconds; a row with a null key, a null or non-finite time or an end not after its start
    doesn't count. Rows delivered again (same key, position, text and times) count once. A piece's text is that of
    the rows that start in it, in the order of start, end and position; null and blank texts add nothing, a piece
    of nothing else has the empty text. A row longer than the limit belongs to the piece it starts in. Further columns
    are ignored; an empty table gives an empty result.
    """
    limit_ms, overlap_ms = round(limit_s * 1000), round(overlap_s * 1000)
    if not 0 <= overlap_ms < limit_ms <= chapter_ms:
        raise ValueError("the overlap must be shorter than the limit, and the limit than a chapter")
    rows = (
        df.select(
            F.col(key).alias("key"),
            to_ms(F.col(start)).alias("s"),
            to_ms(F.col(end)).alias("e"),
            F.col(pos).cast("bigint").alias("p"),
            F.regexp_replace(F.col(text).cast("string"), r"^\s+|\s+$", "").alias("t"),
        )
        .filter("key is not null and s is not null and e is not null and e > s")
        .withColumn("window", F.expr(f"floor(s / {chapter_ms})"))
    )
    # one row per recording and window of its time
    by_time = W.partitionBy("key").orderBy("window")
    earlier, later = by_time.rowsBetween(W.unboundedPreceding, -1), by_time.rowsBetween(1, W.unboundedFollowing)
    windows = materialize(
        rows.groupBy("key", "window")
        .agg(F.min("s").alias("lo"), F.max("e").alias("hi"))
        .select(
            "key",
            "window",
            F.max("hi").over(earlier).alias("carried"),
            F.min("lo").over(W.partitionBy("key")).alias("rec_lo"),
            F.max("hi").over(W.partitionBy("key")).alias("rec_hi"),
        )
    )
    # the longest pause of each window of a recording longer than a chapter
    inside = W.partitionBy("key", "window").orderBy("s", "e")
    borders = (
        rows.select("key", "window", "s", "e")
        .join(windows.filter(F.col("rec_hi") - F.col("rec_lo") > chapter_ms).select("key", "window", "carried"), ["key", "window"])
        .withColumn("before", F.greatest(F.max("e").over(inside.rowsBetween(W.unboundedPreceding, -1)), "carried"))
        .filter("before is not null")
        .groupBy("key", "window")
        .agg(F.max(F.struct((F.col("s") - F.col("before")).alias("pause"), (-F.col("s")).alias("neg"), "before")).alias("m"))
        .select("key", "window", F.when(F.col("m.pause") > 0, F.col("m.before") + F.expr("m.pause div 2")).otherwise(-F.col("m.neg")).alias("border"), F.col("m.before").alias("reach"))
    )
    marked = windows.join(borders, ["key", "window"], "left").withColumn("mark", F.when(F.col("border").isNotNull() & (F.col("border") > F.col("rec_lo")), F.struct("border", "reach")))
    marked = marked.select(
        "key",
        "window",
        (F.col("rec_hi") - F.col("rec_lo") > limit_ms).alias("oversized"),
        "rec_hi",
        F.col("mark").alias("here"),
        F.coalesce(F.max("mark").over(earlier), F.struct(F.col("rec_lo").alias("border"), F.lit(None).cast("bigint").alias("reach"))).alias("prior"),
        F.first("mark", ignorenulls=True).over(later).alias("next"),
        "rec_lo",
    )
    # each row with the chapter it lies in, and with the one or two that reach back to it
    end_of = lambda mark: F.coalesce(F.col(f"{mark}.border"), F.col("rec_hi"))
    chapter = lambda m, until: F.struct(F.col(f"{m}.border").alias("lo"), until.alias("hi"), F.col(f"{m}.reach").alias("reach"))
    prior = chapter("prior", F.coalesce(F.col("here.border"), end_of("next")))
    here, following = chapter("here", end_of("next")), F.struct(F.col("next.border").alias("lo"), F.lit(None).cast("bigint").alias("hi"), F.col("next.reach").alias("reach"))
    s = F.col("s")
    placed = (
        rows.join(marked, ["key", "window"])
        .withColumn(
            "chapters",
            F.filter(
                F.array(
                    F.when(F.col("here.border").isNull() | (s < F.col("here.border")), prior),
                    F.when(s >= F.col("here.border") - overlap_ms, here),
                    F.when(s >= F.col("next.border") - overlap_ms, following),
                ),
                lambda c: c.isNotNull(),
            ),
        )
        .select("key", F.explode("chapters").alias("c"), F.struct("s", "e", "p", "t").alias("item"), "oversized", "rec_lo")
    )
    grouped = placed.groupBy("key", F.col("c.lo").alias("lo")).agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("c.hi").alias("hi"), F.max("c.reach").alias("reach"), F.max("oversized").alias("oversized"), F.min("rec_lo").alias("rec_lo")
    )
    # nondeterministic for the planner, as it would run twice for the filter that the explosion implies
    cut = F.pandas_udf(_pieces_batch(limit_ms, overlap_ms), _PIECES).asNondeterministic()
    fits = grouped.filter("not oversized").withColumn("pieces", F.array(F.struct(F.col("lo").alias("start_ms"), F.col("hi").alias("end_ms"), F.lit(1).alias("at"), F.size("items").alias("n"))))
    large = grouped.filter("oversized").withColumn("pieces", cut(F.col("items.s"), F.col("items.e"), F.col("lo"), F.col("hi"), F.col("reach"), F.col("rec_lo")))
    said = lambda items: F.array_join(F.filter(items, lambda t: t != ""), " ")
    return (
        fits.select("key", "lo", "items", "oversized", "pieces")
        .unionByName(large.select("key", "lo", "items", "oversized", "pieces"))
        .select("key", "lo", "items", "oversized", F.posexplode("pieces").alias("piece", "x"))
        .select(
            F.col("key").alias(key),
            F.col("lo").alias("chapter_ms"),
            "piece",
            "x.start_ms",
            "x.end_ms",
            F.col("x.n").alias("n_items"),
            said(F.slice(F.col("items.t"), F.col("x.at"), F.col("x.n"))).alias("text"),
            "oversized",
        )
    )
