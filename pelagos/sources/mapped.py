"""Columnar observations (as NetCDF variables by index) as elements by a mapping, and records as columns.

A table has one row an index with a column a variable; ``attributes`` are those of the file or of a variable. A mapping is
a list of dicts:

    {"name": "Temperature", "scope": "parameters", "source": "var:TEMP_ADJUSTED|var:TEMP", "quality": "var:TEMP_QC",
     "units": "attribute:TEMP.units", "separator": ";", "map": {"A": "x"}, "order": 1}

Sources are tried in order; those that the table does not have are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, units


def _source(df: DataFrame, source: str, attributes: dict[str, str]) -> Column | None:
    kind, _, name = source.partition(":")
    if kind == "var" and name in df.columns:
        return F.col(name).cast("string")
    if kind in ("attribute", "globalvar") and name in attributes:
        return F.lit(str(attributes[name]))
    if kind == "value":
        return F.lit(name)
    return None


def value(df: DataFrame, sources: str, attributes: dict[str, str]) -> Column:
    """The first source that is there and not empty; NaN and blank texts are empty."""
    known = [c for s in sources.split("|") if (c := _source(df, s.strip(), attributes)) is not None]
    return F.coalesce(*[F.when(~F.trim(c).isin("", "NaN"), F.trim(c)) for c in known], F.lit(None).cast("string"))


def _mapped(several: Column, known: dict[str, str]) -> Column:
    return F.transform(several, lambda x: text.mapped(F.trim(x), known))


def elements(df: DataFrame, record: str, index: str, mapping: list[dict], attributes: dict[str, str] | None = None, set_type: str = "PROFILE") -> DataFrame:
    """df as elements in long format: one level a row; mapped names in scope ``metadata`` belong to the record, once each."""
    attributes, parts = attributes or {}, []
    for rule in sorted(mapping, key=lambda m: m.get("order", 0)):
        v = value(df, rule["source"], attributes)
        several = F.split(v, rule["separator"]) if rule.get("separator") else F.array(v)
        if rule.get("map"):
            several = _mapped(several, rule["map"])
        flag = value(df, rule["quality"], attributes).try_cast("int") if rule.get("quality") else F.lit(None).cast("int")
        unit = value(df, rule["units"], attributes) if rule.get("units") else F.lit(None).cast("string")
        top = rule["scope"] == "metadata"
        part = df.select(
            F.col(record).alias("record_id"), *([F.lit(None).cast("string").alias("set_type"), F.lit(None).cast("int").alias("set_idx"), F.lit(None).cast("int").alias("level_idx")] if top else [F.lit(set_type).alias("set_type"), F.lit(0).alias("set_idx"), F.col(index).cast("int").alias("level_idx")]),
            F.lit(rule["scope"]).alias("scope"), F.lit(rule["name"]).alias("name"), unit.alias("units"), flag.alias("quality"), F.posexplode(several).alias("value_idx", "value_txt"),
        ).where("value_txt is not null")
        parts.append(part.groupBy([c for c in part.columns if c not in ("value_txt", "units", "quality")]).agg(F.min("value_txt").alias("value_txt"), F.first("units").alias("units"), F.first("quality").alias("quality")) if top else part)
    whole = reduce(DataFrame.unionByName, parts)
    return whole.withColumns({"value_num": F.col("value_txt").try_cast("double"), "working_quality": F.lit(None).cast("int"), "uncertainty": F.lit(None).cast("double")})


def columns(found: DataFrame, names: dict[str, str], codes: dict[str, dict[str, int]] | None = None, fill: float = -9999.9) -> DataFrame:
    """Elements as one row a level with a column a variable, for a file sink: {variable: name}. Numbers take the fill value where
    there is none; names in ``codes`` become codes with -128; a variable without any value is left out by the caller."""
    own = found.where("level_idx is not null and value_idx = 0")
    made = []
    for variable, name in names.items():
        here = F.col("name") == name
        if codes and variable in codes:
            made.append(units.coded(F.first(F.when(here, F.col("value_txt")), ignorenulls=True), codes[variable], -128).alias(variable))
        else:
            made.append(F.coalesce(F.first(F.when(here, F.col("value_num")), ignorenulls=True), F.lit(fill)).alias(variable))
    return own.groupBy("record_id", "set_type", "set_idx", "level_idx").agg(*made)


def sensors(variables: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """(variable, sensor): variables (variable, sensor_name, parameter) with their sensors' keys. New files list sensors by name
    (sensor, sensor_type, serial); old ones name them at each variable, and the type is told by the variable's beginning."""
    key = lambda kind, serial: F.concat_ws("_", F.lit("SENSOR"), F.upper(kind), serial)
    if listed is not None:
        return variables.join(listed, variables.sensor_name == listed.sensor, "left").select("variable", F.when(F.col("sensor").isNotNull(), key(F.col("sensor_type"), F.col("serial"))).alias("sensor"))
    kind = F.when(F.col("variable").rlike("^(TEMP|CNDC|PSAL|PRES)"), "CTD").when(F.col("variable").startswith("DOXY"), "DOXY").when(F.col("variable").rlike("^(CHLA|BBP|TURB)"), "OPTICS").otherwise("OTHER")
    return variables.select("variable", F.when(F.col("sensor_name").isNotNull(), key(kind, F.col("sensor_name"))).alias("sensor"))


def shown(found: DataFrame) -> DataFrame:
    """(record_id, line_no, line): a record as text for people: its own elements, then a line a level with tabs between names in
    order. Lines are made and numbered where the rows are."""
    label = F.concat_ws("", F.col("name"), F.lit("="), F.coalesce("value_txt", F.lit("-")), F.when(F.col("units").isNotNull(), F.concat(F.lit(" "), F.col("units"))), F.when(F.coalesce("working_quality", "quality") > 0, F.concat(F.lit(" ["), F.coalesce("working_quality", "quality").cast("string"), F.lit("]"))))
    own = found.where("level_idx is null").select("record_id", F.lit(0).alias("part"), F.lit("").alias("set_type"), F.lit(0).alias("set_idx"), F.lit(0).alias("level_idx"), F.concat_ws(" ", F.rpad("scope", 11, " "), label).alias("line"))
    per = found.where("level_idx is not null").groupBy("record_id", "set_type", "set_idx", "level_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("scope", "name", "value_idx", label.alias("label")))), lambda x: x["label"]), "\t").alias("line"))
    levels = per.select("record_id", F.lit(1).alias("part"), "set_type", "set_idx", "level_idx", F.concat(F.col("set_type"), F.lit("/"), F.col("set_idx").cast("string"), F.lit("/"), F.col("level_idx").cast("string"), F.lit(" "), F.col("line")).alias("line"))
    place = Window.partitionBy("record_id").orderBy("part", "set_type", "set_idx", "level_idx", "line")
    return own.unionByName(levels).select("record_id", F.row_number().over(place).alias("line_no"), "line")


def wire(working: DataFrame) -> DataFrame:
    """(record_id, body): what a reviewer is sent of each working record (record_id, record_hash, actions, record): the parts in
    bytes, each after its length of four bytes, the highest first."""
    part = lambda c: (lambda b: F.concat(F.unhex(F.lpad(F.hex(F.octet_length(b)), 8, "0")), b))(F.encode(F.coalesce(F.col(c).cast("string"), F.lit("")), "UTF-8"))
    return working.select("record_id", F.concat(*[part(c) for c in ("record_id", "record_hash", "actions", "record")]).alias("body"))
