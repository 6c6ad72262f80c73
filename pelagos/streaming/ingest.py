"""Incremental loads: new files only, duplicates dropped, the queue's states folded from events (S7, R-1 to R-6, R-11, R-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, schema: str, fmt: str = "json", glob: str | None = None) -> DataFrame:
    """New files of a folder as a stream; what was read is in the checkpoint of the query that reads it."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def distinct_events(df: DataFrame, keys: list[str], time: str, late: str = "10 minutes") -> DataFrame:
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def counted(df: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts by event-time window; rows later than ``late`` are not counted."""
    return df.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def load_new(df: DataFrame, target: str, checkpoint: str, keys: list[str], day: str | None = None) -> None:
    """Appends what is there now, each key once however often it is loaded: a batch is joined against the target.

    ``day`` names a column that is part of the key, such as the date received: the target is partitioned by it, and only the
    batch's days are read, so that a load costs the same however much there is. One load of a target runs at a time.
    """

    def append(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates(keys)
        spark = batch.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(target)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            held = spark.read.schema(batch.schema).parquet(target)
            if day:
                held = held.where(F.col(day).isin([r[0] for r in batch.select(day).distinct().collect()]))
            fresh = fresh.join(held.select(*keys), keys, "left_anti")
        (fresh.write.partitionBy(day) if day else fresh.write).mode("append").parquet(target)

    df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ledger_state(events: DataFrame, item: str = "item", at: str = "at", now: str | None = None, lease_seconds: int = 3600) -> DataFrame:
    """(item, status, since): each item's last event; a lock older than its lease and a delay that is over are UNLOCKED."""
    last = events.groupBy(item).agg(F.max_by(F.struct("status", F.col(at).alias("since"), "release"), F.struct(at, "status")).alias("last")).select(item, "last.*")
    clock = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    expired = (F.col("status") == "LOCKED") & (F.unix_seconds(clock) - F.unix_seconds(F.col("since").cast("timestamp")) > lease_seconds)
    released = (F.col("status") == "DELAYED_RELEASE") & (F.col("release").cast("timestamp") <= clock)
    return last.select(item, F.when(expired | released, "UNLOCKED").otherwise(F.col("status")).alias("status"), "since")
