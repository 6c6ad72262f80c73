"""A corpus pipeline: quality, exact copies, near copies, personal data, packing.

Each stage reads what its predecessor kept, written as Parquet; all but the last return the columns of documents.
In every stage null texts count as empty, rows without an id are treated like others, other columns are not read, and an
empty table gives an empty one. Rows are told apart by their place, not by their id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagos.llm import exact_dedup, near_dedup, packing, pii, quality
from pelagos.llm.common import Tables, keyed

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, scores at its threshold or above; repeated rows alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, F.lit(True))
    return quality.score(docs.select(*COLUMNS), model).where(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row: that with the smallest id, or one without an id where none has any."""
    rows = keyed(docs.select(*COLUMNS), "row")
    key = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row").alias("key")
    gone = exact_dedup.copies(rows.select(key, "text"), "key").select("key.row")
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 or more of their five-word shingles, and those that such pairs link, one row: that with
    the smallest id, or one without an id where none has any. Fingerprints through BK-trees find candidates, bands those
    whose fingerprints lie farther apart."""
    return near_dedup.first_of_near(docs.select(*COLUMNS))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced under the session's key (else one of this run); n_chars follows the new text, and is
    null where that is. Repeated rows are replaced alike."""
    return pii.checked(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in windows; repeated rows are packed as often as they come."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("pii", replace_personal_data),
    ("packing", pack),
]

#: A learned model, fingerprints and tokens: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, held = Tables(), Tables()
    for _, stage in STAGES[:-1]:
        docs = held.save(stage(spark, docs, sf_dir))
        before.drop(*[df for df, _ in before.held])
        before, held = held, Tables()
    return STAGES[-1][1](spark, docs, sf_dir)
