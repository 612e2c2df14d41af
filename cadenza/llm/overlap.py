"""Same or near-same records across splits (problem 4).

Two texts a few edits apart share one of their rarest words: of n words as many as there may be edits, and one more, are
looked at, in the order of how often words occur in all texts (a prefix filter). Evaluation texts are sharded by these
words, training texts are sent to the shards of theirs, so each goes to a few shards however many there are. In a shard,
evaluation texts are cut into one piece more than the edits a partner may need, so a near copy holds some piece unchanged;
an Aho-Corasick automaton of the pieces scans the shard's training texts. Matched intervals of one evaluation text in one
training text are merged into its coverage; where enough of the pieces are covered, Myers' bit-parallel distance over words
decides. Rows come back by their text at the end.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_hot
from ..runtime import Shared, materialize, once
from .lookalike import unify, words_number, words_text


def edits_allowed(n: int, ratio: float) -> int:
    return int(math.floor(ratio * n + 1e-9))


def longest_partner(n: int, ratio: float) -> int:
    """Most words a text may have that one of ``n`` words can become: L - n <= ratio * L."""
    best = n
    while best + 1 - n <= edits_allowed(best + 1, ratio):
        best += 1
    return best


def cut(n: int, ratio: float) -> list[tuple[int, int]]:
    """Where ``n`` words are cut: one piece more than the most edits any partner allows, sizes as even as can be."""
    k = min(n, edits_allowed(longest_partner(n, ratio), ratio) + 1)
    marks = [n * i // k for i in range(k + 1)]
    return list(zip(marks, marks[1:], strict=False))


def distance(where: dict[str, int], m: int, text: list[str], most: int) -> int | None:
    """Levenshtein distance of a pattern, given as bit masks by word, and ``text`` if at most ``most``."""
    mask, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, left = mask, 0, m, len(text)
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
        left -= 1
        if score - left > most:
            return None
        ph = (ph << 1) | 1
        mh <<= 1
        up = (mh | (mask & ~(xv | ph))) & mask
        down = ph & xv & mask
    return score if score <= most else None


def merged_length(spans: list[tuple[int, int]]) -> int:
    """Words covered by intervals, overlaps counted once."""
    total, reach = 0, -1
    for a, b in sorted(spans):
        if b > reach:
            total += b - max(a, reach)
            reach = b
    return total


def _scan_shard(ratio: float):
    def run(evals: pd.DataFrame, trains: pd.DataFrame) -> pd.DataFrame:
        import ahocorasick

        names = ["train_key", "eval_key", "edits", "covered"]
        if evals.empty or trains.empty:
            return pd.DataFrame(columns=names)
        held = dict(zip(evals["e_key"], evals["e_text"], strict=True))  # a text is there once for each of its rare words
        keys = list(held)
        texts = [t.split(" ") for t in held.values()]
        places: dict[str, list[tuple[int, int]]] = {}
        pieces = [cut(len(w), ratio) for w in texts]
        for e, w in enumerate(texts):
            for k, (a, b) in enumerate(pieces[e]):
                places.setdefault(f" {' '.join(w[a:b])} ", []).append((e, k))
        automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            automaton.add_word(piece, (len(piece), at))
        automaton.make_automaton()
        masks: dict[int, dict[str, int]] = {}
        out = []
        for key, text in dict(zip(trains["t_key"], trains["t_text"], strict=True)).items():
            w = text.split(" ")
            n = len(w)
            starts: list[int] | None = None
            hits: dict[int, set[int]] = {}
            for last, (length, at) in automaton.iter(f" {text} "):
                if starts is None:
                    starts = list(accumulate((len(x) + 1 for x in w), initial=0))
                p = bisect_right(starts, last - length + 1) - 1
                for e, k in at:
                    m = len(texts[e])
                    d = edits_allowed(max(m, n), ratio)
                    if abs(m - n) <= d and abs(p - pieces[e][k][0]) <= d:
                        hits.setdefault(e, set()).add(k)
            for e, got in hits.items():
                m = len(texts[e])
                d = edits_allowed(max(m, n), ratio)
                if len(got) < len(pieces[e]) - d:  # an edit spoils one piece at most
                    continue
                where = masks.get(e)
                if where is None:
                    where = {}
                    for i, x in enumerate(texts[e]):
                        where[x] = where.get(x, 0) | (1 << i)
                    masks[e] = where
                edits = distance(where, m, w, d)
                if edits is not None:
                    out.append((key, keys[e], edits, merged_length([pieces[e][k] for k in got])))
        return pd.DataFrame(out, columns=names)

    return run


#: Words are counted by bucket of their checksum, so that the counts have a bound: words of a bucket are as frequent together.
BUCKETS = 1 << 18
#: Shards of a task at least: many small ones, as a piece of common words then hits few texts at once.
SHARDS = 32


def rare_buckets(words: list[str], counts: list[int], ratio: float) -> set[int]:
    """Buckets of the rarest words of a text, one more than the edits it may have to a partner no longer than itself. Of two
    texts within ``ratio`` some of these are the same: they share all but that many words, whatever the order is, and a
    word said again is another one."""
    said = Counter(words)
    buckets = [crc32(w.encode()) % BUCKETS for w in words]
    if len(said) == len(words):
        ranked = sorted(zip(map(counts.__getitem__, buckets), buckets, words, strict=True))
    else:
        again = [said.subtract((w,)) or said[w] for w in words]
        ranked = sorted(zip(map(counts.__getitem__, buckets), buckets, words, again, strict=True))
    return {x[1] for x in ranked[: edits_allowed(len(words), ratio) + 1]}


def _with_rare(shared, ratio: float):
    """Adds ``rare``, the buckets of a text's rarest words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = once(("counts", shared.id), lambda: np.frombuffer(shared.value, dtype=np.int64).tolist())
        for pdf in batches:
            yield pdf.assign(rare=pd.Series([sorted(rare_buckets(t.split(" "), counts, ratio)) for t in pdf["text"]], dtype=object, index=pdf.index))

    return run


def word_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """How often the words of each bucket occur in texts of words joined by one space: ``BUCKETS`` numbers."""
    bucket = F.pmod(F.crc32(F.col("w").cast("binary")), F.lit(BUCKETS)).alias("bucket")
    found = df.select(F.explode(F.split(text, " ")).alias("w")).groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).toPandas()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def near_texts(texts: DataFrame, counts: np.ndarray, ratio: float = 0.2, shard_words: int = 600_000, block_chars: int = 16_000_000) -> DataFrame:
    """``(train_key, eval_key, edits, covered)`` for a table of distinct ``(key, is_train, text, n)``: texts are words joined by
    one space, ``n`` their number. ``counts`` by :func:`word_counts` set the order of rarity, any will do. ``shard_words`` bounds
    the evaluation texts and ``block_chars`` the training texts a task holds; both cut the work into more tasks, nothing is
    left out. Only sums by bucket reach the driver, and the plan made of them, a row per bucket, is broadcast."""
    spark = texts.sparkSession
    schema = "key string, is_train boolean, text string, n int, rare array<int>"
    ranked = materialize(texts.select("key", "is_train", "text", "n").mapInPandas(_with_rare(Shared(spark, counts.tobytes()), ratio), schema))
    spread = ranked.withColumn("bucket", F.explode("rare")).drop("rare")
    load = spread.groupBy("bucket").agg(F.sum(F.when(~F.col("is_train"), F.col("n"))).alias("words"), F.sum(F.when(F.col("is_train"), F.length("text"))).alias("chars"))
    plan = load.filter("words is not null and chars is not null").toPandas().astype("int64")  # buckets of both sides
    words, chars = plan["words"].to_numpy(), plan["chars"].to_numpy()
    plan["subs"], plan["blocks"] = np.maximum(1, -(-words // shard_words)), np.maximum(1, -(-chars // block_chars))
    large = ((plan["subs"] > 1) | (plan["blocks"] > 1)).to_numpy()
    size = np.where(large, 0.0, np.maximum(words / shard_words, chars / block_chars))
    bins = max(SHARDS * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(2 * size.sum()))
    # shards in turn, the largest buckets first, back and forth; large buckets have shards of their own
    turn = np.arange(len(plan)) % (2 * bins)
    shard = np.empty(len(plan), dtype=np.int64)
    shard[np.argsort(-size, kind="stable")] = np.where(turn < bins, turn, 2 * bins - 1 - turn)
    shard[large] = bins + np.arange(int(large.sum()))
    plan["shard"] = shard
    placed = spread.join(F.broadcast(spark.createDataFrame(plan[["bucket", "shard", "subs", "blocks"]], "bucket int, shard bigint, subs bigint, blocks bigint")), "bucket")
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    part = lambda c: F.pmod(F.xxhash64("key"), F.col(c))
    e = placed.filter("not is_train").select(F.col("shard").alias("e_shard"), part("subs").alias("sub"), every("blocks").alias("block"), F.col("key").alias("e_key"), F.col("text").alias("e_text"))
    t = placed.filter("is_train").select(F.col("shard").alias("t_shard"), every("subs").alias("sub"), part("blocks").alias("block"), F.col("key").alias("t_key"), F.col("text").alias("t_text"))
    return e.groupBy("e_shard", "sub", "block").cogroup(t.groupBy("t_shard", "sub", "block")).applyInPandas(_scan_shard(ratio), "train_key string, eval_key string, edits int, covered int")


def cross_split_copies(
    df: DataFrame,
    row_id: str = "row_id",
    text: str = "text",
    split: str = "split",
    train: str = "train",
    evaluation: tuple[str, ...] = ("validation", "test"),
    min_words: int = 8,
    ratio: float = 0.2,
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(links, rows)``. ``links``: ``(train_key, eval_key, edits, covered)`` between distinct word lists, one of a train
    row and one of an evaluation row, of at least ``min_words`` words each, that become each other by at most ``ratio``
    times the longer one's words in edits; ``covered`` is the words of the evaluation text found unchanged. ``rows``:
    ``(row_id, side, key, split, *keep)``, the membership.

    Words are those of the consistent form. Rows with a null id, text or split, of other splits or of fewer words take
    no part. Repeated rows come out as often as they are there.
    """
    keep = keep or []
    rows = df.select(F.col(row_id).alias("rid"), F.col(text).alias("t"), F.col(split).alias("split"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    rows = rows.filter(F.col("rid").isNotNull() & F.col("t").isNotNull() & F.col("split").isin(train, *evaluation))
    rows = unify(rows, {"t": "t"}).withColumn("text", words_text(F.col("t"))).withColumn("n", words_number(F.col("text"))).filter(F.col("n") >= min_words)
    rows = materialize(rows.select("rid", (F.col("split") == train).alias("is_train"), F.md5("text").alias("key"), "text", "n", "split", *[f"keep_{c}" for c in keep]))
    distinct = rows.groupBy("key", "is_train").agg(F.first("text").alias("text"), F.first("n").alias("n"))
    links = materialize(near_texts(distinct, word_counts(rows), ratio).distinct())
    return links, rows.select("rid", "is_train", "key", "split", "n", *[f"keep_{c}" for c in keep])


def copy_pairs(links: DataFrame, rows: DataFrame, salt_rows: int = 20_000) -> DataFrame:
    """``(a, b)`` with ``a < b``: the row pairs behind ``links``. Texts of many rows are salted by their number."""
    count = lambda side: rows.filter(side).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    n_train = count("is_train").select(F.col("key").alias("train_key"), F.ceil(F.col("rows") / salt_rows).cast("bigint").alias("salts"))
    salted = materialize(links.select("train_key", "eval_key").join(n_train, "train_key"))
    evals = rows.filter("not is_train").select(F.col("rid").alias("e"), F.col("key").alias("eval_key"))
    some = join_hot(evals, salted, ["eval_key"], F.col("e")).select("train_key", "e", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"))
    linked = salted.select("train_key", "salts").distinct()
    trains = join_hot(rows.filter("is_train").select(F.col("rid").alias("t"), F.col("key").alias("train_key")), linked, ["train_key"], F.col("t"))
    trains = trains.select("train_key", "t", F.pmod(F.xxhash64("t"), F.col("salts")).alias("salt"))
    return some.join(trains, ["train_key", "salt"]).select(F.least("e", "t").alias("a"), F.greatest("e", "t").alias("b"))


def overlap_report(links: DataFrame, rows: DataFrame, by: str) -> DataFrame:
    """``(split, by, eval_rows, leaked_rows, pairs, mean_coverage)`` per evaluation split and source: rows there
    are, rows with a copy in train, pairs with train rows and the mean share of a leaked row's words found unchanged."""
    n_train = rows.filter("is_train").groupBy("key").agg(F.count(F.lit(1)).alias("n_train")).withColumnRenamed("key", "train_key")
    per_text = links.join(n_train, "train_key").groupBy(F.col("eval_key").alias("key")).agg(F.sum("n_train").alias("n_train"), F.max("covered").alias("covered"))
    return (
        rows.filter("not is_train")
        .join(per_text, "key", "left")
        .groupBy("split", F.col(f"keep_{by}").alias(by))
        .agg(
            F.count(F.lit(1)).alias("eval_rows"),
            F.count("n_train").alias("leaked_rows"),
            F.coalesce(F.sum("n_train"), F.lit(0)).alias("pairs"),
            F.round(F.avg(F.col("covered") / F.col("n")), 4).alias("mean_coverage"),
        )
    )
