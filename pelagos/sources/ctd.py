"""Casts of a hand-held CTD: CSV of metadata lines, a lone %, a header and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

# The columns of raw and of processed files.
RAW = ("Time (Seconds)", "Pressure (Decibar)", "Temperature (Celsius)", "Conductivity (MicroSiemens per Centimeter)")
PROCESSED = (
    "Pressure (Decibar)", "Depth (Meter)", "Temperature (Celsius)", "Conductivity (MicroSiemens per Centimeter)",
    "Specific conductance (MicroSiemens per Centimeter)", "Salinity (Practical Salinity Scale)",
    "Sound velocity (Meters per Second)", "Density (Kilograms per Cubic Meter)",
)
NEEDED = ("% File name", "% Cast time (UTC)", "% Cast data")
_CALIBRATED = tuple(f"% {x} calibration date" for x in ("Electronics", "Conductivity", "Temperature", "Pressure"))


def _fields(line: Column) -> Column:
    """Fields of a line of CSV; quotes around a field go, a quoted comma does not part fields."""
    parts = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(parts, lambda x: F.replace(F.regexp_replace(F.trim(x), '^"|"$', ""), F.lit('""'), F.lit('"')))


def calibration_date(c: Column) -> Column:
    return F.date_format(text.time_in(c, ["yyyy-MM-dd", "M/d/yyyy"]), "yyyy-MM-dd")


def cast_minutes(c: Column) -> Column:
    return text.minutes_since_1950(F.try_to_timestamp(c, F.lit("M/d/yyyy H:mm")))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, metadata map, header, rows array<array<string>>, minutes, problem): one row a file, ``problem`` null if it is sound."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.split("value", "\r\n|\r|\n").alias("l"))
    files = files.withColumn("at", F.array_position(F.transform("l", lambda x: F.regexp_replace(x, r"[\s,]+$", "")), "%").cast("int"))
    head = F.when(F.col("at") > 1, F.slice("l", 1, F.col("at") - 1)).otherwise(F.array().cast("array<string>"))
    meta = F.transform(head, lambda x: _fields(x))
    entries = F.transform(meta, lambda f: F.struct(f[0].alias("key"), F.coalesce(F.try_element_at(f, F.lit(2)), F.lit("")).alias("value")))
    distinct = F.map_concat(F.map_from_entries(F.filter(entries, lambda e: F.lit(False))), F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"]))))
    body = F.when(F.col("at") > 0, F.slice("l", F.col("at") + 2, F.greatest(F.size("l") - F.col("at") - 1, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    blank = F.array_position(F.transform(F.col("body"), lambda x: F.trim(x)), "").cast("int")
    out = files.withColumns({"metadata": distinct, "header": F.when(F.col("at") > 0, _fields(F.try_element_at("l", F.col("at") + 1))), "body": body}).withColumn("blank", blank)
    data = F.when(F.col("blank") > 0, F.slice("body", 1, F.col("blank") - 1)).otherwise(F.col("body"))
    out = out.withColumn("rows", F.transform(data, lambda x: _fields(x)))
    after = (F.col("blank") > 0) & F.exists(F.slice("body", F.greatest("blank", F.lit(1)), F.size("body") + 1), lambda x: F.trim(x) != "")
    kind = F.try_element_at("metadata", F.lit("% Cast data"))
    allowed = F.when(kind == "Raw", F.array(*map(F.lit, RAW))).otherwise(F.array(*map(F.lit, PROCESSED)))
    missing = F.filter(F.array(*map(F.lit, NEEDED)), lambda k: ~F.map_contains_key("metadata", k))
    out = out.withColumn("minutes", cast_minutes(F.try_element_at("metadata", F.lit("% Cast time (UTC)"))))
    dated = lambda k: F.coalesce(F.try_element_at("metadata", F.lit(k)), F.lit(""))
    bad_dates = [(dated(k) != "") & calibration_date(dated(k)).isNull() for k in _CALIBRATED]
    problem = (
        F.when(F.coalesce(F.col("at"), F.lit(0)) == 0, "no header").when(F.size(missing) > 0, F.concat(F.lit("missing "), missing[0]))
        .when(F.col("header").isNull() | (F.size(F.array_except("header", allowed)) > 0), "unknown column")
        .when(F.exists("rows", lambda r: F.size(r) != F.size("header")), "columns differ").when(after, "text after data").when(F.col("minutes").isNull(), "bad cast time")
    )
    for bad in bad_dates:
        problem = problem.when(bad, "bad calibration date")
    return out.select("path", "metadata", "header", "rows", "minutes", problem.alias("problem"))


def levels(files: DataFrame) -> DataFrame:
    """(path, minutes, level_idx, one double a known column) of the sound files."""
    each = files.where("problem is null").select("path", "minutes", "header", F.posexplode("rows").alias("level_idx", "r"))
    value = lambda n: F.try_element_at("r", F.array_position("header", n).cast("int")).try_cast("double")
    return each.select("path", "minutes", "level_idx", *[F.when(F.array_contains("header", n), value(n)).alias(n) for n in dict.fromkeys(RAW + PROCESSED)])
