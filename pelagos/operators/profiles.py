"""Tests on ordered levels or fixes (W1-W9, W11-W15): one window, one sort per series."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.uncertainty import at_least, at_most


def _window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def neighbours(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """df with v1, v2, v3: the value before, here and after."""
    w = _window(keys, order)
    return df.withColumns({"v1": F.lag(value).over(w), "v2": F.col(value), "v3": F.lead(value).over(w)})


def spike_value() -> Column:
    return F.abs(F.col("v2") - (F.col("v1") + F.col("v3")) / 2) - F.abs(F.col("v1") - F.col("v3")) / 2


def gradient_value() -> Column:
    return F.abs(F.col("v2") - (F.col("v1") + F.col("v3")) / 2)


def _limits(exact: bool):
    """(at least, at most), tolerant of rounding errors or, if exact, as plain SQL compares."""
    return (operator.ge, operator.le) if exact else (at_least, at_most)


def spikes(df: DataFrame, keys: list[str], order: list[str], value: str, spike: float, gradient: float | None = None, exact: bool = False) -> DataFrame:
    """Flagged levels with a ``code``: spike, or gradient where there is no spike. Null neighbours are not tested. Values a
    rounding error below a limit reach it, unless ``exact``."""
    least, _ = _limits(exact)
    code = F.when(least(spike_value(), F.lit(float(spike))), "spike")
    if gradient is not None:
        code = code.when(least(gradient_value(), F.lit(float(gradient))), "gradient")
    return neighbours(df, keys, order, value).withColumn("code", code).where("code is not null")


def spikes_of_several(df: DataFrame, keys: list[str], order: list[str], values: str, spike: float, gradient: float | None = None) -> DataFrame:
    """As ``spikes``, where a level has several values (an array): a level is flagged only if each choice of one value of
    the level before, of its own and of the level after is a spike (or gradient). Levels beside one without values are not tested."""
    bent = lambda a, b, c: F.abs(b - (a + c) / 2)

    def each(least: float, value) -> Column:
        return F.forall("v1", lambda a: F.forall("v2", lambda b: F.forall("v3", lambda c: at_least(value(a, b, c), F.lit(float(least))))))

    code = F.when(each(spike, lambda a, b, c: bent(a, b, c) - F.abs(a - c) / 2), "spike")
    if gradient is not None:
        code = code.when(each(gradient, bent), "gradient")
    full = (F.size("v1") > 0) & (F.size("v2") > 0) & (F.size("v3") > 0)
    return neighbours(df, keys, order, values).where(full).withColumn("code", code).where("code is not null")


def end_spikes(df: DataFrame, keys: list[str], order: list[str], value: str, down: float, up: float, top: bool = True) -> DataFrame:
    """The first (or last) level of each series where it differs from the next to it by ``down`` or less, or ``up`` or more."""
    w = _window(keys, order)
    edge = F.lag(order[-1]).over(w).isNull() if top else F.lead(order[-1]).over(w).isNull()
    beside = F.lead(value).over(w) if top else F.lag(value).over(w)
    step = F.col("value_here") - F.col("beside")
    found = df.withColumns({"edge": edge, "value_here": F.col(value), "beside": beside}).where("edge")
    return found.withColumn("step", step).where(at_most(F.col("step"), F.lit(float(down))) | at_least(F.col("step"), F.lit(float(up)))).drop("edge", "value_here", "beside")


def decreasing(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Levels whose value is below the last one that there was (monotonic depth, density inversion)."""
    last = F.last(value, ignorenulls=True).over(_window(keys, order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("previous", last).where(F.col(value) < F.col("previous"))


def inversions(df: DataFrame, keys: list[str], order: list[str], depth: str, value: str, step: float = 0.1, gap: float = 50.0, deepest_first: float = 75.0, cold: float = 4.0, exact: bool = False) -> DataFrame:
    """Extrema that have an opposite one within ``gap`` metres above, below ``deepest_first`` and before a cold level. Bends a
    rounding error short of ``step`` reach it, unless ``exact``."""
    w = _window(keys, order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    kept = df.where(F.col(depth) > deepest_first).withColumn("was_cold", F.max((F.col(value) < cold).cast("int")).over(so_far)).where("was_cold = 0")
    seen = neighbours(kept, keys, order, value).withColumn("bend", F.col("v2") - (F.col("v1") + F.col("v3")) / 2)
    least, most = _limits(exact)
    kind = F.when(least(F.col("bend"), F.lit(step)), 1).when(most(F.col("bend"), F.lit(-step)), -1)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    marked = seen.withColumn("kind", kind)
    for sign, name in ((1, "high"), (-1, "low")):
        marked = marked.withColumn(name, F.last(F.when(F.col("kind") == sign, F.col(depth)), ignorenulls=True).over(before))
    other = F.when(F.col("kind") == 1, F.col("low")).when(F.col("kind") == -1, F.col("high"))
    return marked.withColumn("opposite", other).where(F.col(depth) - F.col("opposite") <= gap).drop("was_cold", "high", "low")


def speeds(df: DataFrame, keys: list[str], order: list[str], time: str, lat: str, lon: str) -> DataFrame:
    """df with metres, seconds and speed since the series' fix before; no speed without time between."""
    w = _window(keys, order)
    seconds = (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lag(time).over(w).cast("timestamp"))) / 1e6
    metres = geo.haversine(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon))
    return df.withColumns({"metres": metres, "seconds": seconds}).withColumn("speed", F.when(F.col("seconds") > 0, F.col("metres") / F.col("seconds")))


def constant(df: DataFrame, keys: list[str], value: str, least: int = 2) -> DataFrame:
    """Series of at least so many values that are all the same."""
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("value"), F.max(value).alias("top")).where((F.col("n") >= least) & (F.col("value") == F.col("top"))).drop("top")


def stale(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df with is_stale: false for the latest run of each key only."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("is_stale", F.row_number().over(newest) > 1)


def series(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, low, high, values): a series as one array in order, nulls left out, with its range; for one chart, so a group
    is as large as a series."""
    found = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.sort_array(F.collect_list(F.struct(*order, value))).alias("held"))
    return found.select(*keys, "low", "high", F.col(f"held.{value}").alias("values"))


def direction(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, direction): I where most steps of a series go up, D where most go down, null where neither."""
    step = F.signum(F.col(value) - F.lag(value).over(_window(keys, order)))
    total = F.sum("_step")
    return df.withColumn("_step", step).groupBy(*keys).agg(F.when(total > 0, "I").when(total < 0, "D").alias("direction"))
