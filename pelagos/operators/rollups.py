"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("UNLOCKED", "LOCKED", "DELAYED_RELEASE", "COMPLETE", "ERROR")


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def pivoted(df: DataFrame, key: str, column: str, values: list[str]) -> DataFrame:
    """One row a key, one zero-filled count a value: conditional counts, so one shuffle of partial sums."""
    return df.groupBy(key).agg(*[F.count(F.when(F.col(column) == v, 1)).alias(v) for v in values])


def latest(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    last = F.max_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("last")).select(*keys, "last.*")


def extent(df: DataFrame, key: str, depth: Column) -> DataFrame:
    """(key, min_depth, max_depth, obs_type): OTHER without depths, SURFACE at zero, AT_DEPTH at one depth, else PROFILE."""
    out = df.groupBy(key).agg(F.min(depth).alias("min_depth"), F.max(depth).alias("max_depth"))
    kind = F.when(F.col("max_depth").isNull(), "OTHER").when(F.col("max_depth") == 0, "SURFACE").when(F.col("min_depth") == F.col("max_depth"), "AT_DEPTH").otherwise("PROFILE")
    return out.withColumn("obs_type", kind)


def bounds(df: DataFrame, key: str, time: str, lat: str | None = None, lon: str | None = None, depth: str | None = None) -> DataFrame:
    """(key, first and last time, n, and the box and depths if asked for)."""
    found = [F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count(F.lit(1)).alias("n")]
    for column, low, high in ((lat, "south", "north"), (lon, "west", "east"), (depth, "min_depth", "max_depth")):
        if column:
            found += [F.min(column).alias(low), F.max(column).alias(high)]
    return df.groupBy(key).agg(*found)


def parameter_sets(df: DataFrame, key: str, name: str, level: Column | None = None) -> DataFrame:
    """(key, names, n): the sorted distinct names; with ``level`` (null or zero: at the surface) also surface and profile, apart."""
    every = [F.array_sort(F.collect_set(name)).alias("names"), F.count(F.lit(1)).alias("n")]
    if level is not None:
        below = F.coalesce(level, F.lit(0)) > 0
        every += [F.array_sort(F.collect_set(F.when(~below, F.col(name)))).alias("surface"), F.array_sort(F.collect_set(F.when(below, F.col(name)))).alias("profile")]
    return df.groupBy(key).agg(*every)


def group_key(*parts: Column, unknown: str = "?") -> Column:
    """One digest for equal parts: records of one platform and the same parameters are worked on together. A missing part counts
    as unknown."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit(unknown)) for p in parts]))


def batch_outcome(df: DataFrame, key: str, review: Column, changed: Column) -> DataFrame:
    """(key, outcome_rank, n_review): 2 if any record wants a review, 1 if any was changed, else 0."""
    rank = F.when(review, 2).when(changed, 1).otherwise(0)
    return df.groupBy(key).agg(F.max(rank).alias("outcome_rank"), F.count(F.when(review, 1)).alias("n_review"))


def total(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def gridded(df: DataFrame, cells: list[str], value: str) -> DataFrame:
    """(cells, n, least, most)."""
    return df.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))


def outcome(review: Column, changed: Column) -> Column:
    """Review if any test wants it, else modified if any test ran."""
    return F.when(F.bool_or(review), "MANUAL_REVIEW").when(F.bool_or(changed), "MODIFIED").otherwise("PASS")


def verdict(identical: Column, a_better: Column, b_better: Column, compatible: Column, conflict: Column, probable: float = 0.8, improbable: float = 0.2) -> Column:
    """How two records compare, from the counts of how their elements do. Thresholds are cut to whole numbers."""
    alike = identical + a_better + b_better + compatible
    least = lambda share: F.floor((alike + conflict) * share)
    disputed = F.when(alike >= least(probable), "PROBABLE_MATCH").when(alike >= least(improbable), "IMPROBABLE_MATCH").otherwise("NO_MATCH")
    mixed = (compatible > 0) | ((a_better > 0) & (b_better > 0))
    return F.when(conflict > 0, disputed).when(mixed, "DISJOINT_MATCH").when(b_better > 0, "B_IS_SUPERSET").when(a_better > 0, "A_IS_SUPERSET").otherwise("IDENTICAL")


def worst_quality(flags: Column) -> Column:
    """The worst of 9, 4, 3, 2; 1 if all are 1 or 5; else 0."""
    has = lambda f: F.array_contains(flags, f)
    return F.when(has(9), 9).when(has(4), 4).when(has(3), 3).when(has(2), 2).when((F.size(flags) > 0) & F.forall(flags, lambda f: f.isin(1, 5)), 1).otherwise(0)


def ideal(elements: Column, value: str = "value", quality: str = "quality") -> Column:
    """The element to use of several: the first that is good (1, 5), else a fold in order over 2, 3, 4, 0, 9 in which an
    unflagged one replaces a bad one and a bad one an unflagged one."""
    good = F.try_element_at(F.filter(elements, lambda e: e[quality].isin(1, 5)), F.lit(1))
    rank = F.create_map(*[F.lit(x) for x in (2, 0, 3, 1, 4, 2, 0, 2, 9, 3)])
    place = lambda e: F.coalesce(F.try_element_at(rank, e[quality]), F.lit(4))
    swap = lambda a, e: a[quality].isin(0, 4) & e[quality].isin(0, 4) & (a[quality] != e[quality])
    rest = F.reduce(F.slice(elements, 2, F.greatest(F.size(elements), F.lit(1))), F.try_element_at(elements, F.lit(1)), lambda a, e: F.when((place(e) < place(a)) | swap(a, e), e).otherwise(a))
    return F.coalesce(good, rest)[value]
