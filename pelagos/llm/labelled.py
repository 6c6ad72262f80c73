"""Bounded samples of labelled documents, for operators that learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, limit: int) -> DataFrame:
    """(label, text) of at most ``limit`` labelled ids of each class, taken in the order of a hash of their ids.

    Only the chosen ids, at most twice ``limit``, are broadcast to the scan of the documents; texts come whole. Of rows that
    repeat an id, one is learned: the least text under the least label. Rows without an id or a label are not learned from;
    null texts count as empty. So there are at most twice ``limit`` rows, whatever the tables hold.
    """
    able = labels.where(may_learn & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("label")).where("label IN (0, 1)")
    once = able.groupBy("doc_id").agg(F.min("label").alias("label"))
    picked = [once.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit) for k in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))
    found = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text"))
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")
