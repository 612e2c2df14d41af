"""Sinks: partitioned tables by default, and per-file writers for parity with file-based tools."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.offsets import joined_text


def write_table(df: DataFrame, path: str, by: list[str] | None = None, rows_per_file: int = 1_000_000, kind: str = "parquet") -> None:
    w = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (w.partitionBy(*by) if by else w).format(kind).save(path)


def write_manifest(df: DataFrame, path: str) -> bool:
    """Rows that aren't all null, as JSON lines under ``path``; nothing is written if there are none."""
    filled = F.lit(False)
    for c in df.columns:
        filled = filled | F.col(c).isNotNull()
    kept = df.filter(filled)
    if kept.limit(1).count() == 0:
        return False
    kept.write.mode("overwrite").json(path)
    return True


def flatten_manifest(df: DataFrame, nested: str) -> DataFrame:
    """Entries of an array, or an array of arrays, of structs; null ones go. Deeper nesting is left aside."""
    kind = df.schema[nested].dataType.simpleString()
    items = F.flatten(nested) if kind.startswith("array<array<") else F.col(nested)
    return df.select(F.explode(items).alias("x")).filter("x is not null").select("x.*")


def count_items(df: DataFrame, nested: str) -> DataFrame:
    """``df`` with ``items``: how many entries of its array, or array of arrays, of structs aren't null."""
    kind = df.schema[nested].dataType.simpleString()
    items = F.flatten(nested) if kind.startswith("array<array<") else F.col(nested)
    return df.withColumn("items", F.coalesce(F.size(F.filter(items, lambda x: x.isNotNull())), F.lit(0)))


def write_files(df: DataFrame, path: str, content: str) -> None:
    """One file per row, from the executors: ``path`` and ``content`` name the columns. Folders are made as needed; a
    retried task writes the same again."""

    def put(rows: Iterable) -> None:
        for r in rows:
            p = Path(r[path])
            p.parent.mkdir(parents=True, exist_ok=True)
            data = r[content]
            p.write_bytes(bytes(data)) if isinstance(data, (bytes, bytearray)) else p.write_text(data, encoding="utf-8")

    df.select(path, content).foreachPartition(put)


def offsets_content(offsets: str) -> F.Column:
    """Nested offsets as an indented JSON array, letters as they are."""
    return F.to_json(F.transform(offsets, lambda o: F.struct(o["text"].alias("text"), o["start_time"].alias("start_time"), o["end_time"].alias("end_time"))), {"pretty": "true", "ignoreNullFields": "false"})


def explorer_manifest(segments: DataFrame) -> DataFrame:
    """``(audio_filepath, duration, text)`` of segments ``(wav_path, offsets)``: the last end as duration, the texts joined."""
    return segments.select(F.col("wav_path").alias("audio_filepath"), F.element_at("offsets", -1)["end_time"].alias("duration"), joined_text(F.col("offsets")).alias("text"))


def array_manifest(df: DataFrame, path: str) -> bool:
    """Rows that aren't all null as one JSON array in a file of the driver, row by row; nothing is written if there are none."""
    filled = F.lit(False)
    for c in df.columns:
        filled = filled | F.col(c).isNotNull()
    rows = df.filter(filled).select(F.to_json(F.struct(*df.columns)).alias("j")).toLocalIterator()
    first = next(rows, None)
    if first is None:
        return False
    with open(path, "w", encoding="utf-8") as f:
        f.write("[\n" + first["j"])
        for r in rows:
            f.write(",\n" + r["j"])
        f.write("\n]\n")
    return True


def tsv_content(offsets: str) -> F.Column:
    """Lines ``start<TAB>end<TAB>text`` of nested offsets."""
    line = lambda o: F.concat(o["start_time"].cast("string"), F.lit("\t"), o["end_time"].cast("string"), F.lit("\t"), F.coalesce(o["text"], F.lit("")), F.lit("\n"))
    return F.array_join(F.transform(offsets, line), "")


def push_batches(records: list[dict], send: Callable[[list[dict]], bool], size: int = 10) -> int:
    """Records sent in batches until one fails; the number sent. For driver-sized logs."""
    sent = 0
    for a in range(0, len(records), size):
        if not send(records[a : a + size]):
            break
        sent += len(records[a : a + size])
    return sent


def write_counts(rows: DataFrame, path: str) -> None:
    """``(word, counts)`` as JSON lines, letters as they are."""
    rows.select(F.to_json(F.struct("word", "counts")).alias("value")).write.mode("overwrite").text(path)

