"""Text, paths, dates and lists."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def composed(c: Column) -> Column:
    """In normal form C. Spark has no such function; whole Arrow arrays go through Python, so use it where marks may be loose."""

    @F.arrow_udf("string")
    def nfc(texts: pa.Array) -> pa.Array:
        return pa.array([t and unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())

    return nfc(c)


def no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def from_fixed(c: Column) -> Column:
    """Text of a fixed number of bytes, without the zeros that fill it."""
    return F.regexp_replace(F.decode(c, "UTF-8"), "\\x00+$", "")


def to_fixed(c: Column, size: int) -> Column:
    """The first ``size`` bytes of a text, filled up with zeros."""
    return F.rpad(F.substring(F.encode(c, "UTF-8"), 1, size), size, F.lit(b"\x00"))


def percent(c: Column) -> Column:
    """Percent-encoded: letters, digits and _.-~/ stay."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def json_bytes(c: Column) -> Column:
    """Bytes as text that JSON can hold."""
    return F.base64(c)


def in_zone(c: Column, zone: str) -> Column:
    """The clock of a zone at a time in UTC."""
    return F.from_utc_timestamp(c, zone)


def without_keys(c: Column, *names: str) -> Column:
    return F.map_filter(c, lambda k, _: ~k.isin(*names))


def same_structure(a: Column, b: Column) -> Column:
    """Equal values all the way down; the order of keys does not matter, that of lists does. Arguments are JSON texts."""
    whole = lambda c: F.to_json(F.try_parse_json(c))  # noqa: E731  variants hold keys in order
    return whole(a).eqNullSafe(whole(b))


def normalise(c: Column, compose: bool = False) -> Column:
    """Line ends to LF, tabs and wide spaces to a space, dashes to one, no control signs, runs of spaces to one, trimmed; composed if asked for."""
    c = F.regexp_replace(composed(c) if compose else c, "\r\n?", "\n")
    c = F.regexp_replace(c, "[\\t  -   　]", " ")
    c = F.regexp_replace(c, "[‐-―−]", "-")
    c = F.regexp_replace(c, "[\\x00-\\x09\\x0b-\\x1f\\x7f]", "")
    return F.trim(F.regexp_replace(c, " {2,}", " "))


def path(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "/{2,}", "/"), "^/|/$", "")


def split_clean(c: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(c, pattern), lambda x: F.trim(x)), lambda x: x != "")


def file_name(c: Column) -> Column:
    safe = F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_")  # ASCII: characters are bytes
    reserved = F.upper(F.substring_index(safe, ".", 1)).rlike(r"^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$")
    return F.substring(F.when(reserved | (safe == ""), F.concat(F.lit("_"), safe)).otherwise(safe), 1, 255)


def template(pattern: Column, values: Column) -> Column:
    """``%{key}`` replaced from a map of strings."""
    return F.aggregate(F.map_entries(values), pattern, lambda s, e: F.replace(s, F.concat(F.lit("%{"), e["key"], F.lit("}")), F.coalesce(e["value"], F.lit(""))))


def in_language(texts: Column, language: str, default: str = "en") -> Column:
    return F.coalesce(F.try_element_at(texts, F.lit(language)), F.try_element_at(texts, F.lit("und")), F.try_element_at(texts, F.lit(default)))


def display(time: Column, lat: Column, lon: Column, depth: Column) -> Column:
    part = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}:"), c.cast("string")))
    return F.concat_ws(" ", part("T", time), part("Y", lat), part("X", lon), part("Z", depth))


def iso_time(c: Column) -> Column:
    return F.try_to_timestamp(c)


def time_in(c: Column, formats: list[str]) -> Column:
    """The first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def compact_time(c: Column) -> Column:
    """Dates of 8, 10, 12 or 14 digits."""
    return F.coalesce(*[F.when(F.length(c) == len(f), F.try_to_timestamp(c, F.lit(f))) for f in ("yyyyMMdd", "yyyyMMddHH", "yyyyMMddHHmm", "yyyyMMddHHmmss")])


def time_since(value: Column, unit: str, epoch: str) -> Column:
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}[unit.rstrip("s")]
    return F.timestamp_micros((F.unix_micros(F.to_timestamp(F.lit(epoch))) + F.round(value * seconds * 1_000_000)).cast("long"))


def minutes_since_1950(c: Column) -> Column:
    return F.floor((F.unix_micros(c.cast("timestamp")) + F.lit(631_152_000_000_000)) / 60_000_000).cast("long")


def in_service(at: Column, start: Column, end: Column) -> Column:
    """Inclusive; an open end is no bound."""
    return (start.isNull() | (start <= at)) & (end.isNull() | (at <= end))


def same_values(a: Column, b: Column) -> Column:
    return F.forall(a, lambda x: F.array_contains(b, x)) & F.forall(b, lambda x: F.array_contains(a, x))


def mapped(c: Column, known: dict[str, str]) -> Column:
    """What a value is called elsewhere, found without case; others stay."""
    names = F.create_map(*[F.lit(x) for k, v in known.items() for x in (k.lower(), v)])
    return F.coalesce(F.try_element_at(names, F.lower(c)), c)


def found_at(body: Column, path: str, kind: str = "string") -> Column:
    """What a JSON text holds at a path such as ``coordinates/Depth/0``; null where it has none, or nothing of that kind."""
    steps = "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in path.strip("/").split("/"))
    return F.try_variant_get(F.try_parse_json(body), f"${steps}", kind)
