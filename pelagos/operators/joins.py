"""Joins: identification, ranges, overrides, duplicates, anti joins."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from ..session import cut


def identify(records: DataFrame, known: DataFrame, identifiers: list[str], record_key: str, known_key: str, at: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """(record_key, known_key) where any identifier agrees and the time is within service: one equi-join each, not an OR."""
    parts = []
    for name in identifiers:
        hit = records.where(F.col(name).isNotNull()).alias("r").join(known.where(F.col(name).isNotNull()).alias("k"), F.col(f"r.{name}") == F.col(f"k.{name}"))
        if at:
            hit = hit.where(text.in_service(F.col(f"r.{at}"), F.col(f"k.{start}"), F.col(f"k.{end}")))
        parts.append(hit.select(F.col(f"r.{record_key}").alias(record_key), F.col(f"k.{known_key}").alias(known_key)))
    return reduce(DataFrame.union, parts).distinct()


def classify(records: DataFrame, matches: DataFrame, record_key: str, known_key: str) -> DataFrame:
    """(record_key, n_candidates, candidates, outcome) with outcome no_record, one or many."""
    found = matches.groupBy(record_key).agg(F.count(F.lit(1)).alias("n_candidates"), F.sort_array(F.collect_set(known_key)).alias("candidates"))
    joined = records.select(record_key).join(found, record_key, "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))
    return joined.withColumn("outcome", F.when(F.col("n_candidates") == 0, "no_record").when(F.col("n_candidates") == 1, "one").otherwise("many"))


def terminal(links: DataFrame, key: str, to: str) -> DataFrame:
    """(key, terminal): where following ``to`` ends. Pointers double each round; a cycle ends where the rounds do."""
    out = cut(links.select(F.col(key).alias("k"), F.col(to).alias("t")))
    for _ in range(max(1, out.count()).bit_length()):
        step = out.where("t is not null").select(F.col("k").alias("k2"), F.col("t").alias("t2"))
        moved = out.join(step, out.t == step.k2, "left").select("k", F.coalesce("t2", "t").alias("t"), F.col("t2").isNotNull().alias("moved"))
        moved = cut(moved)
        out = moved.select("k", "t")
        if moved.where("moved").isEmpty():
            break
    return out.select(F.col("k").alias(key), F.coalesce("t", "k").alias("terminal"))


def in_bands(df: DataFrame, bands: DataFrame, value: str, small: int = 10_000) -> DataFrame:
    """df with its bands, low < value <= high (bands: band, low, high); values in no band go.

    At most ``small`` bands are broadcast. More are dealt into cells as wide as the widest band, each band lies in two
    cells at most, and values meet the bands of their own cell alone.
    """
    inside = (F.col(value) > F.col("low")) & (F.col(value) <= F.col("high"))
    if bands.limit(small + 1).count() <= small:
        return df.join(F.broadcast(bands), inside)
    width = bands.agg(F.max(F.col("high") - F.col("low")).alias("w")).first().w or 1
    cell = lambda c: F.floor(F.col(c) / F.lit(float(width))).cast("long")
    dealt = bands.withColumn("_cell", F.explode(F.sequence(cell("low"), cell("high"))))
    return df.withColumn("_cell", cell(value)).join(dealt, "_cell").where(inside).drop("_cell")


def around(df: DataFrame, grid: DataFrame, key: str, lat: str, lon: str, per_degree: int, low: str, high: str, reach: int = 1, sd: float = 0.0) -> DataFrame:
    """(key, low, high, n_cells): the range of a gridded model (cell_lat, cell_lon, low, high) in the cells within reach of each
    position, across the date line; reach grows by what ``sd`` degrees of the position's uncertainty span, twice. The grid is
    joined by cell, so it may be of any size; rows without a cell there are left out."""
    reach += math.ceil(2 * sd * per_degree)
    near = df.select(key, F.explode(geo.cells_around(F.col(lat), F.col(lon), per_degree, reach)).alias("c")).select(key, "c.*")
    return near.join(grid, ["cell_lat", "cell_lon"]).groupBy(key).agg(F.min(low).alias("low"), F.max(high).alias("high"), F.count(F.lit(1)).alias("n_cells"))


def overridden(df: DataFrame, base: DataFrame, special: DataFrame, on: list[str], key: str, column: str) -> DataFrame:
    """df with ``column``: the special rule for (on, key) if there is one, else the base rule for ``on``."""
    s = special.select(*on, key, F.col(column).alias("special"))
    return df.join(base, on, "left").join(s, [*on, key], "left").withColumn(column, F.coalesce("special", column)).drop("special")


def near_pairs(df: DataFrame, key: str, id_col: str, time: str, seconds: int, lat: str | None = None, lon: str | None = None, metres: float | None = None) -> DataFrame:
    """(a, b) with a < b of one key, at most so many seconds and metres apart. Ids are unique.

    Each row looks into its own time bin and the next, and within its own at greater ids only: a pair is found once, and
    nothing has to be made distinct. All rows of a key within one bin meet each other, as the pairs among them are the result.
    """
    at = F.unix_seconds(F.col(time).cast("timestamp"))
    base = df.select(F.col(key).alias("key"), F.col(id_col).alias("id"), F.unix_micros(F.col(time).cast("timestamp")).alias("at"), F.floor(at / seconds).alias("bin"), *([F.col(lat).alias("lat"), F.col(lon).alias("lon")] if lat else []))
    left = base.withColumn("own", F.col("bin")).withColumn("bin", F.explode(F.array("bin", F.col("bin") + 1))).alias("l")
    right = base.alias("r")
    once = (F.col("l.own") != F.col("bin")) | (F.col("l.id") < F.col("r.id"))
    pairs = left.join(right, ["key", "bin"]).where(once & (F.col("l.id") != F.col("r.id")) & (F.abs(F.col("l.at") - F.col("r.at")) <= seconds * 1_000_000))
    if lat:
        pairs = pairs.where(geo.haversine(F.col("l.lat"), F.col("l.lon"), F.col("r.lat"), F.col("r.lon")) <= metres)
    return pairs.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b"))


def dequeue(queue: DataFrame, locked: DataFrame, queue_col: str, name_col: str, order: list) -> DataFrame:
    """The first item of each queue whose name is not locked; items without a name are never blocked."""
    free = queue.join(locked.select(F.col(name_col).alias("held")).distinct(), F.col(name_col) == F.col("held"), "left_anti")
    return free.withColumn("place", F.row_number().over(Window.partitionBy(queue_col).orderBy(*order))).where("place = 1").drop("place")


def not_yet(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(done.select(*keys), keys, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias("pk")), F.col(child_key) == F.col("pk"), "left_anti").where(F.col(child_key).isNotNull())


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def batches(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """df with batch_no: batches of at most ``size`` rows within each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("batch_no", F.floor((place - 1) / size).cast("long"))
