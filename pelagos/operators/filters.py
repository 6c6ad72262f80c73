"""Filter dictionaries, projections and orders as Columns."""

from __future__ import annotations

from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {"=": eq, "==": eq, "<>": ne, "!=": ne, "<": lt, "<=": le, ">": gt, ">=": ge}


def predicate(column: str, wanted: object) -> Column:
    """A value (equal; None: is null), or (value, operator), or (value, operator, null also passes)."""
    c = F.col(column)
    if wanted is None:
        return c.isNull()
    if not isinstance(wanted, tuple):
        return c == F.lit(wanted)
    value, op, *tolerant = wanted
    op = op.upper().strip()
    if op == "IN":
        test = c.isin(list(value)) if value else F.lit(False)
    elif op in ("LIKE", "NOT LIKE"):
        test = c.like(value) if op == "LIKE" else ~c.like(value)
    elif value is None:
        test = c.isNull() if op in ("=", "==", "IS") else c.isNotNull()
    else:
        test = _COMPARE[op](c, F.lit(value))
    return (c.isNull() | test) if tolerant and tolerant[0] else test


def compiled(filters: dict[str, object], join: str = "AND") -> Column:
    """All (or, joined by OR, any) of the filters; no filters pass every row."""
    tests = [predicate(c, w) for c, w in filters.items()]
    return reduce(and_ if join.upper() == "AND" else or_, tests) if tests else F.lit(True)


def scan(df: DataFrame, filters: dict[str, object] | None = None, join: str = "AND", fields: list[str] | None = None, keys: tuple[str, ...] = (), order: list[str | tuple[str, bool]] | None = None) -> DataFrame:
    """Filter, project (fields and keys, or all) and order ((column, descending) or column)."""
    out = df.where(compiled(filters or {}, join))
    if fields is not None:
        out = out.select(*dict.fromkeys([*keys, *fields]))
    if order:
        out = out.orderBy(*[F.col(o[0]).desc() if isinstance(o, tuple) and o[1] else F.col(o[0] if isinstance(o, tuple) else o).asc() for o in order])
    return out


def has_value(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def is_numeric(c: Column) -> Column:
    return c.try_cast("double").isNotNull()


def is_integer(c: Column) -> Column:
    return c.try_cast("bigint").isNotNull() & ~c.cast("string").contains(".")


def is_iso_datetime(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string")).isNotNull()


def eligible(value: Column, quality: Column, allow_dubious: bool = False) -> Column:
    """A value is tested if it is there and has no flag yet (or, if allowed, is dubious)."""
    flag = F.coalesce(quality, F.lit(0))
    return has_value(value) & (flag.isin(0, 3) if allow_dubious else flag == 0)


def file_state(seen: Column, processed: Column, errored: Column) -> Column:
    return F.when(~seen, "NOT_PRESENT").when(processed, "PROCESSED").when(errored, "ERRORED").otherwise("UNPROCESSED")


def permitted(wanted: Column, held: Column) -> Column:
    """Any wanted permission is held; ``__any__`` opens to all, ``__admin__`` holds everything."""
    return F.arrays_overlap(wanted, held) | F.array_contains(wanted, "__any__") | F.array_contains(held, "__admin__")
