"""Values with standard deviations as structs, and tolerant comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def measured(value: Column, sd: Column | float = 0.0) -> Column:
    sd = F.lit(sd) if isinstance(sd, float | int) else sd
    return F.struct(value.cast("double").alias("value"), F.coalesce(sd.cast("double"), F.lit(0.0)).alias("sd"))


def _made(value: Column, variance: Column) -> Column:
    return F.struct(value.alias("value"), F.sqrt(variance).alias("sd"))


def add(a: Column, b: Column) -> Column:
    return _made(a["value"] + b["value"], a["sd"] * a["sd"] + b["sd"] * b["sd"])


def subtract(a: Column, b: Column) -> Column:
    return _made(a["value"] - b["value"], a["sd"] * a["sd"] + b["sd"] * b["sd"])


def multiply(a: Column, b: Column) -> Column:
    return _made(a["value"] * b["value"], F.pow(b["value"] * a["sd"], 2) + F.pow(a["value"] * b["sd"], 2))


def divide(a: Column, b: Column) -> Column:
    q = F.try_divide(a["value"], b["value"])
    return _made(q, F.pow(F.try_divide(a["sd"], b["value"]), 2) + F.pow(F.try_divide(q * b["sd"], b["value"]), 2))


def power(a: Column, exponent: float) -> Column:
    return _made(F.pow(a["value"], F.lit(exponent)), F.pow(exponent * F.pow(a["value"], F.lit(exponent - 1)) * a["sd"], 2))


def root(a: Column) -> Column:
    return power(a, 0.5)


def sine(a: Column) -> Column:
    return _made(F.sin(a["value"]), F.pow(F.cos(a["value"]) * a["sd"], 2))


def cosine(a: Column) -> Column:
    return _made(F.cos(a["value"]), F.pow(F.sin(a["value"]) * a["sd"], 2))


def radians(a: Column) -> Column:
    return _made(F.radians(a["value"]), F.pow(F.radians(a["sd"]), 2))


def arctangent(y: Column, x: Column) -> Column:
    """Of y / x, by quadrant."""
    square = F.pow(x["value"], 2) + F.pow(y["value"], 2)
    return _made(F.atan2(y["value"], x["value"]), F.try_divide(F.pow(x["value"] * y["sd"], 2) + F.pow(y["value"] * x["sd"], 2), F.pow(square, 2)))


def scaled(value: Column, digits: Column) -> Column:
    """value times ten to the power of -digits, known to half of its last place: a uniform distribution's deviation."""
    unit = F.pow(F.lit(10.0), -digits.cast("double"))
    return F.struct((value * unit).alias("value"), (unit / 2 / F.sqrt(F.lit(3.0))).alias("sd"))


def at_least_sd(a: Column, sd: float) -> Column:
    return F.struct(a["value"].alias("value"), F.greatest(a["sd"], F.lit(sd)).alias("sd"))


def close(a: Column, b: Column, sd: Column | None = None) -> Column:
    """Within two standard deviations if there are any, else within a relative 1e-9."""
    near = F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.abs(b))
    return near if sd is None else near | (F.abs(a - b) <= 2 * sd)


def at_least(a: Column, b: Column) -> Column:
    return (a >= b) | close(a, b)


def at_most(a: Column, b: Column) -> Column:
    return (a <= b) | close(a, b)
