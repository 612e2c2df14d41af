"""Filling fixed-capacity containers (problem 6).

Items are hashed into partitions and packed there best-fit decreasing. Dual feasible functions give a lower bound on
each partition's containers: a partition that meets its bound is certified and done. The partitions with a gap
exchange the documents of their emptier containers and are packed again, as long as that saves a container. What is left
uncertified is marked, and the bound over all items is reported. Only ids and sizes take part; text is not moved.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize


def lower_bound(sizes: np.ndarray, capacity: int, times: np.ndarray | None = None) -> int:
    """Containers needed at least by items of these sizes, each so many ``times``: the best of the total size and two families of dual feasible functions
    (Fekete and Schepers): one rounds large items up to the capacity and drops those below a threshold, one counts
    in multiples of the capacity over k + 1."""
    if len(sizes) == 0:
        return 0
    size, n = np.unique(np.asarray(sizes, dtype=np.int64), return_counts=True) if times is None else (np.asarray(sizes), np.asarray(times))
    best = -(-int((size * n).sum()) // capacity)
    for eps in size[size * 2 <= capacity]:
        f = np.where(size > capacity - eps, capacity, np.where(size < eps, 0, size))
        best = max(best, -(-int((f * n).sum()) // capacity))
    for k in range(1, 13):
        whole = (size * (k + 1)) % capacity == 0
        f = np.where(whole, size * k, (size * (k + 1) // capacity) * capacity)
        best = max(best, -(-int((f * n).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container number of each item: the largest items first, each into the fullest container it fits."""
    order = np.argsort(-np.asarray(sizes), kind="stable")
    out = np.empty(len(sizes), dtype=np.int64)
    rooms: list[int] = []  # distinct free spaces, sorted
    at: dict[int, list[int]] = {}
    n = 0
    for i in order.tolist():
        s = int(sizes[i])
        j = bisect_left(rooms, s)
        if j < len(rooms):
            room = rooms[j]
            held = at[room]
            c = held.pop()
            if not held:
                del at[room]
                del rooms[j]
        else:
            room, c = capacity, n
            n += 1
        out[i] = c
        left = room - s
        if left:
            if left in at:
                at[left].append(c)
            else:
                at[left] = [c]
                insort(rooms, left)
    return out


def _pack(capacity: int):
    """Packs one partition; it is certified if it needs no more containers than its bound."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["size"].to_numpy(dtype=np.int64)
        bins = best_fit_decreasing(sizes, capacity)
        used = int(bins.max()) + 1 if len(bins) else 0
        fill = np.bincount(bins, weights=sizes, minlength=used)
        return pdf.assign(bin=bins, fill=fill[bins].astype(np.int64), certified=used <= lower_bound(sizes, capacity))

    return run


_ITEM = "id bigint, piece int, n_pieces int, byte_at int, byte_length int, size bigint"
_PACKED = f"{_ITEM}, part bigint, bin bigint, fill bigint, certified boolean"
_COLUMNS = ["id", "piece", "n_pieces", "byte_at", "byte_length", "size"]


def byte_cuts(raw: bytes, capacity: int) -> list[int]:
    """Where a UTF-8 text is cut into as few pieces as can be: each as long as its capacity lets, never inside a character,
    and room for the end token in the last."""
    cuts, at = [], 0
    while len(raw) - at + 1 > capacity:
        at += capacity
        if at >= len(raw):
            at = len(raw)
        else:
            while raw[at] & 0xC0 == 0x80:
                at -= 1
        cuts.append(at)
    return cuts


def byte_pieces(text: Column, capacity: int) -> Column:
    """``array<int>``: the marks between which the pieces of a text lie, in bytes of its UTF-8 form: one piece if its bytes
    and the end token fit, else as few as can be. Only large texts that aren't ASCII go to Python."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else byte_cuts(bytes(t), capacity) for t in texts], dtype=object)

    n = F.octet_length(text)
    large = n + 1 > capacity
    plain = n == F.char_length(text)
    even = F.transform(F.sequence(F.lit(1), F.ceil((n + 1) / capacity).cast("int") - 1), lambda k: F.least(k * capacity, n))
    found = F.pandas_udf(run, "array<int>")(F.when(large & ~plain, text.cast("binary")))
    cuts = F.when(~large, F.array().cast("array<int>")).when(plain, even).otherwise(found)
    return F.concat(F.array(F.lit(0)), cuts, F.array(n))


def _items(df: DataFrame, id_col: str, text_col: str, capacity: int) -> DataFrame:
    text = F.col(text_col).cast("string")
    marked = df.filter(F.col(id_col).isNotNull() & text.isNotNull() & text.rlike(r"\S")).select(F.col(id_col).cast("bigint").alias("id"), byte_pieces(text, capacity).alias("marks"))
    ends = marked.select("id", "marks", (F.size("marks") - 1).alias("n_pieces")).select("id", "marks", "n_pieces", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)).alias("piece"))
    at = lambda k: F.get("marks", k)
    pieces = ends.select("id", "piece", "n_pieces", at(F.col("piece")).alias("byte_at"), (at(F.col("piece") + 1) - at(F.col("piece"))).alias("byte_length"))
    return pieces.withColumn("size", (F.col("byte_length") + F.when(F.col("piece") == F.col("n_pieces") - 1, 1).otherwise(0)).cast("bigint"))


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, partition_items: int = 50_000, keep_fill: float = 0.995) -> DataFrame:
    """``(doc_id, piece, n_pieces, byte_at, byte_length, n_tokens, container, certified)``: where each document, or each piece
    of one larger than a container, lies. Tokens are UTF-8 bytes and one end token per text, which is its last piece's.
    ``certified`` says that the container is full, or of a partition that no packing of its items could fit into fewer.

    Null and blank texts and null ids don't take part; a repeated row is packed as often as it is there (its id then
    names several items). ``container`` is unique over the whole result. ``partition_items`` bounds what one task
    packs and is a parameter, not a cap: there are as many partitions as that takes. Containers filled to ``keep_fill`` stay
    when the others of an uncertified partition are exchanged. Further columns are ignored; an empty table gives an empty
    result. ``capacity`` must be at least 8.
    """
    if capacity < 8:
        raise ValueError("capacity must be at least 8")
    items = materialize(_items(df, id_col, text_col, capacity))
    full = F.col("size") == capacity
    out = items.filter(full).select(*_COLUMNS, F.concat_ws("-", F.lit("full"), F.monotonically_increasing_id()).alias("container"), F.lit(True).alias("certified"))
    left, n, before, r = items.filter(~full).select(*_COLUMNS, F.lit("").alias("container")), None, None, 0
    while True:
        n = left.count() if n is None else n
        parts = max(1, -(-n // partition_items))
        part = F.pmod(F.xxhash64("id", "piece", F.lit(r)), F.lit(parts)).cast("bigint")
        packed = materialize(left.select(*_COLUMNS, part.alias("part")).groupBy("part").applyInPandas(_pack(capacity), _PACKED))
        packed = packed.withColumn("container", F.concat_ws("-", F.lit(f"round{r}"), "part", "bin"))
        if before is not None and packed.select("part", "bin").distinct().count() >= before:
            return _named(out.unionByName(left.select(*_COLUMNS, "container", F.lit(False).alias("certified"))), id_col)
        done = F.col("certified") | (F.col("fill") >= capacity * keep_fill)
        out = out.unionByName(packed.filter(done).select(*_COLUMNS, "container", F.col("certified")))
        left = packed.filter(~done).select(*_COLUMNS, "container")
        n, before = left.agg(F.count(F.lit(1)), F.countDistinct("container")).first()
        if not n:
            return _named(out, id_col)
        r += 1


def _named(out: DataFrame, id_col: str) -> DataFrame:
    return out.withColumnRenamed("id", id_col).withColumnRenamed("size", "n_tokens")


def packing_report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row ``(items, tokens, containers, bound, gap, certified_items)`` of a result of :func:`pack_documents`: no packing has fewer
    than ``bound`` containers, by the sizes of all items, of which there are no more different ones than the capacity."""
    sizes = packed.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toPandas()
    bound = lower_bound(sizes["n_tokens"].to_numpy(dtype=np.int64), capacity, sizes["n"].to_numpy(dtype=np.int64)) if len(sizes) else 0
    sums = packed.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"), F.countDistinct("container").alias("containers"), F.count(F.when(F.col("certified"), 1)).alias("certified_items"))
    return sums.select("items", "tokens", "containers", F.lit(bound).cast("bigint").alias("bound"), (F.col("containers") - bound).alias("gap"), "certified_items")
