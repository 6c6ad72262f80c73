"""What the operators share: tables in the shared folder, Arrow settings, Arrow-batch helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only by local sessions where spark.checkpoint.dir is unset, as in tests on one machine.
LOCAL_SCRATCH = "/tmp/checkpoints"


def scratch(spark: SparkSession) -> str:
    """A fresh folder name below the folder that all executors share; a cluster has to name one in spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set")
        base = LOCAL_SCRATCH
    return f"{base.rstrip('/')}/pelagos-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str) -> tuple:
    """(file system, path) as the JVM has them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    files, at = _files(df.sparkSession, path)
    files.deleteOnExit(at)  # takes only what is there already
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def save(df: DataFrame) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again; the table goes when the application ends.

    This cuts the lineage: what an expensive or iterative step made survives the loss of executors, and
    later joins see a plain scan, so that adaptive execution may split both of their sides.
    """
    return _write(df)[0]


class Tables:
    """Tables of one job, written as by ``save``: they go when the block ends, or before by ``drop``.

    What a block returns must not read them: it is written by ``save``.
    """

    def __init__(self) -> None:
        self.held: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*[df for df, _ in self.held])

    def save(self, df: DataFrame) -> DataFrame:
        self.held.append(_write(df))
        return self.held[-1][0]

    def drop(self, *gone: DataFrame) -> None:
        for df, path in [h for h in self.held if any(h[0] is g for g in gone)]:
            files, at = _files(df.sparkSession, path)
            files.delete(at, True)
        self.held = [h for h in self.held if not any(h[0] is g for g in gone)]


def _scan(df: DataFrame) -> bool:
    """Whether df is rows of one table of files, chosen and reshaped one by one."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation" and "parquet" in node.toString().lower()


def keyed(docs: DataFrame, name: str = "_row") -> DataFrame:
    """docs with a column that tells all rows apart and is the same whenever the plan runs again, also elsewhere.

    It is a row's place in its Parquet file (two digests of the file's path, 96 bits, and the row's number), so nothing
    is written. What is no plain scan is written first.
    """
    docs = docs if _scan(docs) else save(docs)
    path = F.col("_metadata.file_path")
    return docs.withColumn(name, F.struct(F.xxhash64(path).alias("file"), F.hash(path).alias("part"), F.col("_metadata.row_index").alias("at")))


def arrow(spark: SparkSession) -> SparkSession:
    """Batches for Python workers are bounded in rows and, by the engine, in bytes: texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded size."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema, strict=True)], schema=schema
    )


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A batch's texts; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]
