"""Distances and boxes on the sphere (N9, N10), bounding boxes of a search (J12), grid cells (J9), polygons."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_M = 6_371_000.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def within_box(lat: Column, lon: Column, at_lat: Column, at_lon: Column, metres: float) -> Column:
    """In the box around a point that holds all within the distance; across the date line, all longitudes near a pole."""
    span = metres / RADIUS_M * 180 / 3.141592653589793
    wide = F.when(F.abs(at_lat) + span >= 89.9, F.lit(180.0)).otherwise(F.degrees(F.asin(F.sin(F.radians(F.lit(span))) / F.cos(F.radians(at_lat)))))
    apart = F.abs(lon - at_lon)
    return (F.abs(lat - at_lat) <= span) & (F.least(apart, 360 - apart) <= wide)


def cell(coordinate: Column, per_degree: int) -> Column:
    return F.floor(coordinate * per_degree).cast("long")


def in_polygon(lat: Column, lon: Column, ring: list[tuple[float, float]]) -> Column:
    """Even-odd rule over the ring's edges, as (lat, lon); points on an edge may fall on either side."""
    crossings = [
        ((F.lit(a[0]) > lat) != (F.lit(b[0]) > lat)) & (lon < (b[1] - a[1]) * (lat - a[0]) / F.lit(b[0] - a[0]) + a[1])
        for a, b in zip(ring, ring[1:] + ring[:1]) if a[0] != b[0]
    ]
    return sum((c.cast("int") for c in crossings), F.lit(0)) % 2 == 1


def any_box(lat: Column, lon: Column, boxes: list[tuple[float, float, float, float]]) -> Column:
    """In one of the boxes (south, west, north, east); a box whose west is beyond its east crosses the date line."""
    tests = [lat.between(s, n) & (lon.between(w, e) if w <= e else (lon >= w) | (lon <= e)) for s, w, n, e in boxes]
    return reduce(or_, tests) if tests else F.lit(False)


def geometry(lat: Column, lon: Column, lat_sd: Column, lon_sd: Column) -> Column:
    """A position as text: a point, or what one standard deviation spans: a line if one coordinate is exact, else a box."""
    n = lambda c: F.format_string("%.5f", c)
    west, east, south, north = (n(c) for c in (lon - lon_sd, lon + lon_sd, lat - lat_sd, lat + lat_sd))
    at = lambda x, y: F.concat(x, F.lit(" "), y)
    has = lambda sd: F.coalesce(sd > 0, F.lit(False))
    box = F.concat(F.lit("POLYGON (("), at(west, south), F.lit(", "), at(east, south), F.lit(", "), at(east, north), F.lit(", "), at(west, north), F.lit(", "), at(west, south), F.lit("))"))
    line = lambda a, b: F.concat(F.lit("LINESTRING ("), a, F.lit(", "), b, F.lit(")"))
    return F.when(has(lat_sd) & has(lon_sd), box).when(has(lat_sd), line(at(n(lon), south), at(n(lon), north))).when(has(lon_sd), line(at(west, n(lat)), at(east, n(lat)))).otherwise(F.concat(F.lit("POINT ("), at(n(lon), n(lat)), F.lit(")")))


def cells_around(lat: Column, lon: Column, per_degree: int, reach: int = 1) -> Column:
    """An array of (cell_lat, cell_lon): the cells within reach of a position; columns of cells go round the sphere."""
    at_lat, at_lon, round_ = cell(lat, per_degree), cell(lon, per_degree), 360 * per_degree
    steps = F.array(*[F.lit(k).cast("long") for k in range(-reach, reach + 1)])
    wrapped = lambda x: F.pmod(x + F.lit(round_ // 2), F.lit(round_)) - F.lit(round_ // 2)
    return F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct((at_lat + i).alias("cell_lat"), wrapped(at_lon + j).alias("cell_lon")))))
