"""The store of observations: provenance joins, inserts, finalizing batches, derived facts (F9, F10, J1-J3, J17, A9, A15, A17, M8, M9, R-13, S29, W15).

Tables are replaced, not changed in place: each function gives the table that should follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import changes


def with_payload(obs: DataFrame, data: DataFrame, keys: list[str]) -> DataFrame:
    """Observations with their stored records, one to one by key."""
    return obs.join(data, keys)


def of_source(rows: DataFrame, sources: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that came from one of the sources; the date in the key prunes partitions. Columns of sources are not added."""
    return rows.join(sources.select(*keys).distinct(), keys, "left_semi")


def looked_up(table: DataFrame, **key: object) -> DataFrame:
    """The rows with exactly these values; null is a value here."""
    for name, value in key.items():
        table = table.where(F.col(name).eqNullSafe(F.lit(value)))
    return table


def in_state(items: DataFrame, status: str, before: str | None = None, since: str = "since") -> DataFrame:
    """Items of a status, if given those that have it since then or longer, oldest first."""
    found = items.where(F.col("status") == status)
    return (found.where(F.col(since) <= F.to_timestamp(F.lit(before))) if before else found).orderBy(since)


def inserted(table: DataFrame, rows: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """table and the rows; what these lack or leave null takes the default."""
    for name, value in (defaults or {}).items():
        rows = rows.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in rows.columns else F.lit(value))
    return table.unionByName(rows, allowMissingColumns=True).select(*table.columns)


def load_counts(offered: DataFrame, held: DataFrame, keys: list[str], valid: Column) -> DataFrame:
    """(created, skipped, errors): new keys, keys that are held or repeat, rows that are not valid."""
    known = held.select(*keys).distinct().withColumn("_held", F.lit(True))
    marked = offered.withColumn("_valid", F.coalesce(valid, F.lit(False))).join(known, keys, "left")
    per = marked.groupBy(*keys).agg(F.count(F.when(F.col("_valid"), 1)).alias("n"), F.count(F.when(~F.col("_valid"), 1)).alias("bad"), F.max("_held").alias("held"))
    new = F.when(F.col("held").isNull() & (F.col("n") > 0), 1).otherwise(0)
    return per.agg(F.coalesce(F.sum(new), F.lit(0)).alias("created"), F.coalesce(F.sum(F.col("n") - new), F.lit(0)).alias("skipped"), F.coalesce(F.sum("bad"), F.lit(0)).alias("errors"))


def test_summary(results: DataFrame, key: str) -> DataFrame:
    """(key, tests): a map from test to the version and result of its last run that is not stale."""
    last = results.where(~F.col("is_stale")).groupBy(key, "test_name").agg(F.max_by(F.struct("version", "result"), F.struct("test_date", "version", "result")).alias("last"))
    return last.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("test_name", "last")))).alias("tests"))


def promoted(elements: DataFrame) -> DataFrame:
    """Working flags become the flags; where there is none the old flag stays."""
    return elements.withColumn("quality", F.coalesce("working_quality", "quality")).withColumn("working_quality", F.lit(None).cast(elements.schema["working_quality"].dataType))


def facts(records: DataFrame) -> DataFrame:
    """What is searched by: level (UNKNOWN if there is none), time, position as text with five decimals, platform."""
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    point = F.when(both, F.format_string("POINT (%.5f %.5f)", F.col("longitude"), F.col("latitude")))
    return records.select("record_id", F.coalesce("level", F.lit("UNKNOWN")).alias("level"), F.col("time").alias("obs_time"), point.alias("location"), "platform_id")


def finalized(working: DataFrame, batch: DataFrame, obs: DataFrame, batch_key: str, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(obs, working, batch) after the working rows of the batches have become observations: those that are there already
    by key are not added again, so a second run changes nothing. The batches are COMPLETE."""
    mine = working.join(batch.select(batch_key), batch_key, "left_semi")
    new = mine.dropDuplicates(keys).join(obs.select(*keys), keys, "left_anti")
    rest = working.join(batch.select(batch_key), batch_key, "left_anti")
    return obs.unionByName(new.select(*obs.columns)), rest, batch.withColumn("status", F.lit("COMPLETE"))


def factored(metadata: DataFrame, dimension: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(metadata, dimension): metadata (key, record_id, name, value) that a dimension row (key, name, value) lacks goes there,
    by the least record that has it; what then agrees with the dimension is not kept with the records."""
    offered = metadata.groupBy(key, "name").agg(F.min_by("value", "record_id").alias("value"))
    missing = offered.join(dimension.select(key, "name"), [key, "name"], "left_anti")
    whole = dimension.select(key, "name", "value").unionByName(missing)
    agreed = whole.select(key, "name", F.col("value").alias("_of"))
    kept = metadata.join(agreed, [key, "name"], "left").where(~F.col("value").eqNullSafe(F.col("_of"))).select(*metadata.columns)
    return kept, whole


def filled_columns(df: DataFrame) -> DataFrame:
    """df without the columns that are null throughout; one pass of counts, which alone come to the driver."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])


def next_free(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """(keys, free): the smallest index from 0 that is not used."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(index)) - 1
    used = df.where(F.col(index) >= 0).select(*keys, index).distinct().withColumn("_place", place)
    return used.groupBy(*keys).agg(F.coalesce(F.min(F.when(F.col(index) != F.col("_place"), F.col("_place"))), F.count(F.lit(1)).cast("int")).alias("free"))


def path_set(elements: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Elements with those of ``new`` set: all values at a place give way to the new ones."""
    return changes.deleted(elements, new.select(*keys).distinct(), keys).unionByName(new.select(*elements.columns))


def path_append(elements: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Elements with those of ``new`` as further values of their places; a single value becomes one of several."""
    last = elements.groupBy(*keys).agg((F.max("value_idx") + 1).alias("_next"))
    order = [F.col("value_idx")] + [F.col(c) for c in elements.columns if c not in (*keys, "value_idx")]
    placed = new.join(last, keys, "left").withColumn("value_idx", (F.coalesce("_next", F.lit(0)) + F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast(elements.schema["value_idx"].dataType))
    return elements.unionByName(placed.select(*elements.columns))
