"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embedding_dedup, exact_dedup, packing, pieces, pii, quality, simhash, toxicity, url_filter
from .common import save


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.checked(docs).withColumn("n_entities", F.size("entities"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_links(_table(spark, sf_dir, "embeddings"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{chat.TRAP}' AS text")
    nodes = save(chat.chain(turns.unionByName(trap)))
    return chat.digests(chat.format_paths(nodes))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rules_table(spark))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), with_ids=False)


def chat_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as trees that branch: the best root-to-leaf paths of each."""
    nodes = save(chat.reply_trees(_table(spark, sf_dir, "conversations")))
    return chat.digests(chat.format_paths(nodes, chat.TOP), ("leaf", "rank")).withColumn("rank", F.col("rank").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_toxicity, op3_packing, op4_simhash, op5_embeddings, op6_exact_dedup, op7_chat, op8_quality, op9_url_filter, op10_pieces, chat_reply_trees)
}
ORACLE_SQL = {"op6_exact_dedup": exact_dedup.ORACLE_SQL, "op7_chat": chat.ORACLE_SQL, "op9_url_filter": url_filter.ORACLE_SQL, "chat_reply_trees": chat.TREES_SQL}
