"""Nested observation records from JSON, as long-format elements and levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUPS = ("metadata", "coordinates", "parameters")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(record_idx, body variant, malformed): each file is a record, an array of records, or a record a line."""
    files = spark.read.text(path, wholetext=True)
    first = F.regexp_extract("value", r"^\s*([^\n]*)", 1)
    lined = first.startswith("{") & F.try_parse_json(first).isNotNull()  # the first line is a record by itself
    whole = files.where(~lined).select(F.col("value"), F.try_parse_json("value").alias("v"))
    broken = whole.where("v is null").select(F.col("value"))
    lines = files.where(lined).select(F.explode(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")).alias("value")).union(broken)
    lines = lines.select(F.try_parse_json("value").alias("body"), F.when(F.try_parse_json("value").isNull(), F.col("value")).alias("malformed"))
    kind = F.schema_of_variant("v")
    many = whole.where("v is not null").select(F.explode(F.when(kind.startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>")).otherwise(F.array("v"))).alias("body"), F.lit(None).cast("string").alias("malformed"))
    return many.unionByName(lines)


def _object(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "map<string,variant>"), F.create_map().cast("map<string,variant>"))


def _values(e: Column) -> Column:
    """A scalar, an object with _value, a list, or an object with _values: always an array of elements."""
    listed = F.coalesce(F.try_variant_get(e, "$._values", "array<variant>"), F.when(F.schema_of_variant(e).startswith("ARRAY"), F.try_variant_get(e, "$", "array<variant>")))
    return F.coalesce(listed, F.array(e))


def elements(records: DataFrame, id_col: str = "record_id", body: str = "body") -> DataFrame:
    """One row per value: record, where it is (set_type, set_idx, level_idx; null at the top), scope, name, value_idx,
    value_num, value_txt, units, quality, working_quality, uncertainty. Subrecords are taken to one level of depth."""
    top = records.select(F.col(id_col).alias("record_id"), F.lit(None).cast("string").alias("set_type"), F.lit(None).cast("int").alias("set_idx"), F.lit(None).cast("int").alias("level_idx"), F.col(body).alias("node"))
    sets = records.select(F.col(id_col).alias("record_id"), F.explode(_object(F.col(body), "$._subrecords")).alias("set_type", "by_idx"))
    sets = sets.select("record_id", "set_type", F.explode(_object(F.col("by_idx"), "$")).alias("set_idx", "held"))
    rows = F.coalesce(F.try_variant_get("held", "$._records", "array<variant>"), F.try_variant_get("held", "$", "array<variant>"))
    levels = sets.select("record_id", "set_type", F.col("set_idx").try_cast("int").alias("set_idx"), F.posexplode(rows).alias("level_idx", "node"))
    nodes = top.unionByName(levels)
    scoped = nodes.select("record_id", "set_type", "set_idx", "level_idx", F.explode(F.array(*[F.struct(F.lit(g).alias("scope"), _object(F.col("node"), f"$._{g}").alias("held")) for g in GROUPS])).alias("g"))
    named = scoped.select("record_id", "set_type", "set_idx", "level_idx", F.col("g.scope").alias("scope"), F.explode("g.held").alias("name", "e"))
    each = named.select("record_id", "set_type", "set_idx", "level_idx", "scope", "name", F.posexplode(_values(F.col("e"))).alias("value_idx", "e"))
    is_object = F.schema_of_variant("e").startswith("OBJECT")
    raw = F.when(is_object, F.try_variant_get("e", "$._value", "string")).otherwise(F.try_variant_get("e", "$", "string"))
    meta = lambda n, t: F.coalesce(F.try_variant_get("e", f"$._metadata.{n}", t), F.try_variant_get("e", f"$._metadata.{n}._value", t))
    return each.select(
        "record_id", "set_type", "set_idx", "level_idx", "scope", "name", "value_idx", raw.try_cast("double").alias("value_num"), raw.alias("value_txt"), meta("Units", "string").alias("units"),
        meta("Quality", "int").alias("quality"), meta("WorkingQuality", "int").alias("working_quality"), meta("Uncertainty", "double").alias("uncertainty"),
    )


def levels(found: DataFrame, names: list[str]) -> DataFrame:
    """Elements as one row a level, one column a name: the first value there, else that of the record (inherited)."""
    own = found.where("value_idx = 0")
    wide = own.where("level_idx is not null").groupBy("record_id", "set_type", "set_idx", "level_idx").pivot("name", names).agg(F.first("value_num", ignorenulls=True))
    above = own.where("level_idx is null").groupBy("record_id").agg(*[F.first(F.when(F.col("name") == n, F.col("value_num")), ignorenulls=True).alias(f"top_{n}") for n in names])
    return wide.join(above, "record_id", "left").select("record_id", "set_type", "set_idx", "level_idx", *[F.coalesce(n, f"top_{n}").alias(n) for n in names])
