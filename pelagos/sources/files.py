"""Files of any store that Spark reaches: listing, a ledger of what was seen, copies, targets.

What is done to files is done by the driver through Hadoop's file systems; listings are DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, modified, size) of files; their contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def unseen(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger (path, modified) does not have as they are now: new ones and changed ones."""
    return found.join(ledger.select("path", "modified").distinct(), ["path", "modified"], "left_anti")


def noted(ledger: DataFrame, found: DataFrame, now: str) -> DataFrame:
    """The ledger with the files that were taken."""
    return ledger.unionByName(unseen(found, ledger).select("path", "modified", F.to_timestamp(F.lit(now)).alias("seen")), allowMissingColumns=True)


def _at(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.exists(where)


def copied(spark: SparkSession, source: str, target: str, move: bool = False, replace: bool = False) -> None:
    """Copies or moves a file or folder, between stores if need be. A target that is there is an error unless it may be replaced."""
    (a, p), (b, q) = _at(spark, source), _at(spark, target)
    if b.exists(q):
        if not replace:
            raise FileExistsError(target)
        b.delete(q, True)
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a, p, b, q, move, spark._jsparkSession.sessionState().newHadoopConf()):
        raise OSError(f"not copied: {source}")


def removed(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.delete(where, True)


def written(df: DataFrame, path: str, fmt: str = "json", compression: str | None = "gzip", mode: str = "errorifexists") -> None:
    """A table as files of a format, compressed unless told otherwise."""
    writer = df.write.mode(mode)
    (writer.option("compression", compression) if compression else writer).format(fmt).save(path)


def versioned(spark: SparkSession, path: str) -> str:
    """path, or the first of path.1, path.2 and so on that is free."""
    at, n = path, 0
    while exists(spark, at):
        n += 1
        at = f"{path}.{n}"
    return at


def rows(df: DataFrame) -> Iterator[Row]:
    """One row after another; the driver holds one partition at a time."""
    return df.toLocalIterator(prefetchPartitions=False)
