"""The queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators.periods import to_ms
from ..runtime import materialize, table
from .encoding import restore_encoding
from .groups import assign_splits, mixed_groups
from .leaks import find_leaks
from .lookalike import latin_look, look_alike_classes, look_alike_pairs, unify
from .overlap import copy_pairs, cross_split_copies, overlap_report
from .packing import pack_documents, packing_report
from .pieces import split_recordings


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = split_recordings(table(spark, d, "utt_offsets"))
    return pieces.filter("oversized").select("utt_id").distinct()


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_recordings(table(spark, d, "utt_offsets"))


def p1_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the pieces of each recording: their span, their length, the time neighbours share, and that every row
    is in some piece."""
    source = table(spark, d, "utt_offsets")
    p = split_recordings(source)
    order = W.partitionBy("utt_id").orderBy("start_ms", "end_ms")
    step = p.withColumn("shared", F.lag("end_ms").over(order) - F.col("start_ms")).withColumn("first", F.lag("end_ms").over(order).isNull())
    step = step.withColumn("lo", F.min("start_ms").over(W.partitionBy("utt_id")))
    of = step.groupBy("utt_id").agg(
        F.bool_or("oversized").alias("oversized"),
        F.min("start_ms").alias("first_ms"),
        F.max("end_ms").alias("last_ms"),
        F.bool_and(F.col("end_ms") - F.col("start_ms") <= 30_000).alias("within_limit"),
        F.bool_and(F.col("first") | (F.col("shared") == 2000) | (F.col("start_ms") == F.col("lo"))).alias("shares_overlap"),
        F.sum("n_items").alias("items"),
    )
    spans = source.select("utt_id", "pos", "text", to_ms(F.col("start_time")).alias("s"), to_ms(F.col("end_time")).alias("e")).filter("utt_id is not null and s is not null and e > s").distinct()
    rows = spans.groupBy("utt_id").agg(F.count(F.lit(1)).alias("n"))
    return of.join(rows, "utt_id").select("utt_id", "oversized", "first_ms", "last_ms", "within_limit", "shares_overlap", (F.col("items") >= F.col("n")).alias("all_rows"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return look_alike_pairs(table(spark, d, "manifest"), "row_id", "text").select(F.col("a").alias("row_id_a"), F.col("b").alias("row_id_b"))


def p2_unified(spark: SparkSession, d: str) -> DataFrame:
    return unify(table(spark, d, "manifest").select("row_id", "text"), {"text": "text_form"}).select("row_id", "text_form")


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    return look_alike_classes(table(spark, d, "manifest"), "row_id", "text")


def p2_looks(spark: SparkSession, d: str) -> DataFrame:
    """The consistent form with its remaining look-alikes turned into Latin: unification leaves the look of every text."""
    forms = unify(table(spark, d, "manifest").select("row_id", "text"), {"text": "form"})
    look = F.pandas_udf(lambda s: pd.Series([None if t is None else latin_look(t) for t in s], dtype=object), "string")
    return forms.select("row_id", F.md5(look("form")).alias("look"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return copy_pairs(*cross_split_copies(table(spark, d, "manifest"))).select(F.col("a").alias("row_id_a"), F.col("b").alias("row_id_b"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap_report(*cross_split_copies(table(spark, d, "manifest"), keep=["speaker"]), "speaker").drop("mean_coverage")


def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    return overlap_report(*cross_split_copies(table(spark, d, "manifest"), keep=["speaker"]), "speaker").select("split", "speaker", "mean_coverage")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return mixed_groups(table(spark, d, "manifest"))


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    return assign_splits(table(spark, d, "manifest"), table(spark, d, "split_targets"))


def p5_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the new splits: every row has one, groups are whole, and the shares are met within a hundredth."""
    targets = table(spark, d, "split_targets")
    got = materialize(assign_splits(table(spark, d, "manifest"), targets))
    whole = got.groupBy("group_id").agg(F.countDistinct("new_split").alias("k"))
    n_rows, (n_groups, most) = got.count(), whole.agg(F.count(F.lit(1)), F.max("k")).first()
    per = targets.join(got.groupBy(F.col("new_split").alias("split")).agg(F.count(F.lit(1)).alias("n")), "split", "left")
    near = F.abs(F.coalesce("n", F.lit(0)) / n_rows - F.col("share")) < 0.01
    return per.select("split", F.lit(n_rows).cast("bigint").alias("n_rows"), F.lit(n_groups).cast("bigint").alias("n_groups"), F.lit(most == 1).alias("groups_whole"), near.alias("near_share"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents")).filter("n_pieces > 1").select("doc_id").distinct()


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents"))


def p6_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the containers: the bytes and tokens of each document add up, only large ones are divided, and no
    container of its pieces is over-full."""
    packed = materialize(pack_documents(table(spark, d, "documents")))
    fill = packed.groupBy("container").agg((F.sum("n_tokens") <= 2048).alias("fits"))
    return packed.join(fill, "container").groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("byte_length").cast("bigint").alias("n_bytes"), (F.max("n_pieces") > 1).alias("divided"), F.bool_and("fits").alias("fits"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return packing_report(pack_documents(table(spark, d, "documents")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).filter("run_words >= 12").select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return restore_encoding(table(spark, d, "documents")).filter("restored_affected").select("doc_id")


def p8_restored(spark: SparkSession, d: str) -> DataFrame:
    r = restore_encoding(table(spark, d, "documents").select("doc_id", "text"))
    return r.filter("restored_affected").select("doc_id", "restored_text", F.array_join("restored_chains", ",").alias("chains"), "restored_lost")


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_pieces, p1_checks, p2_found, p2_unified, p2_classes, p2_looks, p4_found, p4_report, p4_coverage, p5_found, p5_splits, p5_checks,
        p6_found, p6_containers, p6_checks, p6_report, p7_found, p7_leaks, p8_found, p8_restored,
    )
}
