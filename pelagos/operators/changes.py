"""Changes to tables as new tables: upsert, update, delete, escaping, hashes, reviewer edits.

Parquet has no rows to lock: each function gives the table that should replace the old one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, DateType, MapType, StructType, TimestampNTZType, TimestampType


def updated(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """table with the columns that ``changes`` has for a key; a null there is a value too. One row a key in ``changes``."""
    columns = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, F.struct(*columns).alias("_new"))
    pick = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns]
    return table.join(new, keys, "left").select(*pick)


def upserted(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """table without the keys in ``changes``, and ``changes``: columns that these lack are null."""
    return deleted(table, changes, keys).unionByName(changes, allowMissingColumns=True).select(*table.columns)


def deleted(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        raise ValueError("a key is needed to delete by")
    return table.join(gone.select(*keys), keys, "left_anti").select(*table.columns)


def touched(before: DataFrame, after: DataFrame, keys: list[str], now: Column, modified: str = "modified") -> DataFrame:
    """after with ``modified`` set to now in rows that are new or in which any other column has another value, and kept in others."""
    rest = [c for c in after.columns if c not in (*keys, modified)]
    old = before.select(*keys, F.struct(*[F.col(c) for c in rest]).alias("_old"), F.col(modified).alias("_when"))
    same = F.col("_old").isNotNull() & F.col("_old").eqNullSafe(F.struct(*[F.col(c) for c in rest]))
    return after.join(old, keys, "left").withColumn(modified, F.when(same, F.col("_when")).otherwise(now)).select(*dict.fromkeys([*after.columns, modified]))


def newest(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key, the last in order: what upserts on a conflict leave behind."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]))
    return events.withColumn("_place", place).where("_place = 1").drop("_place")


def copy_text(column: str, kind: DataType) -> Column:
    """A value as a bulk load of text takes it: null is \\N, control signs are escaped, bytes hex, times UTC."""
    c = F.col(column)
    if isinstance(kind, BooleanType):
        out = F.when(c, "t").otherwise("f")
    elif isinstance(kind, BinaryType):
        out = F.concat(F.lit("\\\\x"), F.lower(F.hex(c)))
    elif isinstance(kind, TimestampType | TimestampNTZType):
        out = F.date_format(c, "yyyy-MM-dd HH:mm:ss'Z'")
    elif isinstance(kind, DateType):
        out = F.date_format(c, "yyyy-MM-dd")
    else:
        out = F.to_json(c) if isinstance(kind, StructType | ArrayType | MapType) else c.cast("string")
        for raw, name in (("\\", "\\"), ("\r", "r"), ("\t", "t"), ("\n", "n"), ("\b", "b"), ("\f", "f"), ("\v", "v")):
            out = F.replace(out, F.lit(raw), F.lit("\\" + name))
    return F.when(c.isNull(), F.lit("\\N")).otherwise(out)


def copy_lines(table: DataFrame) -> DataFrame:
    """(line): the columns in order, with tabs between."""
    return table.select(F.concat_ws("\t", *[copy_text(f.name, f.dataType) for f in table.schema.fields]).alias("line"))


def record_hashes(elements: DataFrame) -> DataFrame:
    """(record_id, record_hash): the same for records with the same values, whatever the order of their names and values.

    Each value is hashed, and a record's hashes are sorted: a group is as large as one record.
    """
    columns = ["set_type", "set_idx", "level_idx", "scope", "name", "value_num", "value_txt", "units", "quality", "uncertainty"]
    one = F.sha1(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    return elements.groupBy("record_id").agg(F.sha1(F.concat_ws("", F.sort_array(F.collect_list(one)))).alias("record_hash"))


def edited(elements: DataFrame, actions: DataFrame, place: list[str]) -> tuple[DataFrame, DataFrame]:
    """(elements, refused): edits of values and flags by place, in ``action_idx`` order, the last of each kind counts.

    ``actions``: record_hash, place, action_idx, kind (set_value, set_flag), new_value. Actions on a record whose hash
    is another by now are refused, and no action of theirs is applied.
    """
    current = record_hashes(elements)
    seen = actions.join(current.withColumnRenamed("record_hash", "_now"), "record_id", "left")
    good = seen.where(F.col("record_hash") == F.col("_now"))
    refused = seen.where(~F.coalesce(F.col("record_hash") == F.col("_now"), F.lit(False))).drop("_now")
    last = lambda k: F.max_by(F.when(F.col("kind") == k, F.struct("new_value")), F.when(F.col("kind") == k, F.col("action_idx")))
    per = good.groupBy(*place).agg(last("set_value").alias("_value"), last("set_flag").alias("_flag"))
    per = per.select(*[F.col(c).alias(f"_at_{c}") for c in place], "_value", "_flag")
    condition = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in place])
    joined = elements.join(per, condition, "left")
    text = F.when(F.col("_value").isNotNull(), F.col("_value.new_value")).otherwise(F.col("value_txt"))
    number = F.when(F.col("_value").isNotNull(), F.col("_value.new_value").try_cast("double")).otherwise(F.col("value_num"))
    flag = F.when(F.col("_flag").isNotNull(), F.col("_flag.new_value").try_cast("int")).otherwise(F.col("working_quality"))
    return joined.withColumns({"value_txt": text, "value_num": number, "working_quality": flag}).select(*elements.columns), refused
