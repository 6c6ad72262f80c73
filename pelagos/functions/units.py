"""Unit expressions: parsed on the driver, converted as linear Columns."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Factor to SI base units, shift, and dimensions.
BASE = {"m": (1.0, 0.0, {"L": 1}), "s": (1.0, 0.0, {"T": 1}), "kg": (1.0, 0.0, {"M": 1}), "g": (1e-3, 0.0, {"M": 1}), "K": (1.0, 0.0, {"K": 1}), "A": (1.0, 0.0, {"I": 1}), "mol": (1.0, 0.0, {"N": 1}), "cd": (1.0, 0.0, {"J": 1}), "rad": (1.0, 0.0, {}), "1": (1.0, 0.0, {})}
DERIVED = {
    "°C": (1.0, 273.15, {"K": 1}), "degC": (1.0, 273.15, {"K": 1}), "Celsius": (1.0, 273.15, {"K": 1}), "degree": (0.017453292519943295, 0.0, {}), "degrees": (0.017453292519943295, 0.0, {}),
    "Pa": (1.0, 0.0, {"M": 1, "L": -1, "T": -2}), "bar": (1e5, 0.0, {"M": 1, "L": -1, "T": -2}), "N": (1.0, 0.0, {"M": 1, "L": 1, "T": -2}), "J": (1.0, 0.0, {"M": 1, "L": 2, "T": -2}), "W": (1.0, 0.0, {"M": 1, "L": 2, "T": -3}),
    "Hz": (1.0, 0.0, {"T": -1}), "V": (1.0, 0.0, {"M": 1, "L": 2, "T": -3, "I": -1}), "S": (1.0, 0.0, {"M": -1, "L": -2, "T": 3, "I": 2}), "mhos": (1.0, 0.0, {"M": -1, "L": -2, "T": 3, "I": 2}),
    "L": (1e-3, 0.0, {"L": 3}), "l": (1e-3, 0.0, {"L": 3}), "min": (60.0, 0.0, {"T": 1}), "h": (3600.0, 0.0, {"T": 1}), "d": (86400.0, 0.0, {"T": 1}), "day": (86400.0, 0.0, {"T": 1}), "t": (1000.0, 0.0, {"M": 1}),
    "psu": (1e-3, 0.0, {}), "0/00": (1e-3, 0.0, {}), "%": (1e-2, 0.0, {}), "kt": (1852 / 3600, 0.0, {"L": 1, "T": -1}), "knot": (1852 / 3600, 0.0, {"L": 1, "T": -1}),
}
_SI = {
    "Hz": ({"T": -1}, "hertz becquerel Bq"), "N": ({"M": 1, "L": 1, "T": -2}, "newton"), "Pa": ({"M": 1, "L": -1, "T": -2}, "pascal"), "J": ({"M": 1, "L": 2, "T": -2}, "joule"), "W": ({"M": 1, "L": 2, "T": -3}, "watt"),
    "C": ({"I": 1, "T": 1}, "coulomb"), "V": ({"M": 1, "L": 2, "T": -3, "I": -1}, "volt"), "F": ({"M": -1, "L": -2, "T": 4, "I": 2}, "farad"), "ohm": ({"M": 1, "L": 2, "T": -3, "I": -2}, "Ω"), "S": ({"M": -1, "L": -2, "T": 3, "I": 2}, "siemens mho"),
    "Wb": ({"M": 1, "L": 2, "T": -2, "I": -1}, "weber"), "T": ({"M": 1, "T": -2, "I": -1}, "tesla"), "H": ({"M": 1, "L": 2, "T": -2, "I": -2}, "henry"), "lm": ({"J": 1}, "lumen"), "lx": ({"J": 1, "L": -2}, "lux"),
    "Gy": ({"L": 2, "T": -2}, "gray Sv sievert"), "kat": ({"N": 1, "T": -1}, "katal"), "m": ({"L": 1}, "metre meter"), "s": ({"T": 1}, "second sec"), "K": ({"K": 1}, "kelvin"), "A": ({"I": 1}, "ampere"), "mol": ({"N": 1}, "mole"), "cd": ({"J": 1}, "candela"), "rad": ({}, "radian sr steradian"),
}
_OTHERS = {
    "L": {"nmile": 1852.0, "nautical_mile": 1852.0, "ft": 0.3048, "foot": 0.3048, "feet": 0.3048, "inch": 0.0254, "yd": 0.9144, "yard": 0.9144, "mile": 1609.344, "fathom": 1.8288, "au": 149_597_870_700.0},
    "T": {"minute": 60.0, "hour": 3600.0, "hr": 3600.0, "week": 604_800.0, "year": 31_556_925.9747}, "M": {"gram": 1e-3, "kilogram": 1.0, "tonne": 1000.0, "pound": 0.45359237, "ounce": 0.028349523125},
    "": {"arcmin": 0.0002908882086657216, "arcsec": 4.84813681109536e-06, "percent": 1e-2, "ppm": 1e-6, "ppb": 1e-9, "ppt": 1e-12, "ppth": 1e-3, "count": 1.0, "dimensionless": 1.0, "turn": 6.283185307179586},
}
_PRESSURE = {"psi": 6894.757293168361, "atm": 101_325.0, "mmHg": 133.322387415, "torr": 101_325 / 760}
DERIVED |= {n: (1.0, 0.0, dims) for symbol, (dims, names) in _SI.items() for n in [symbol, *names.split()] if n not in BASE}
DERIVED |= {n: (f, 0.0, {d: 1} if d else {}) for d, some in _OTHERS.items() for n, f in some.items()}
DERIVED |= {n: (f, 0.0, {"M": 1, "L": -1, "T": -2}) for n, f in _PRESSURE.items()}
DERIVED |= {"°F": (5 / 9, 459.67 * 5 / 9, {"K": 1}), "degF": (5 / 9, 459.67 * 5 / 9, {"K": 1}), "litre": (1e-3, 0.0, {"L": 3}), "liter": (1e-3, 0.0, {"L": 3}), "ha": (1e4, 0.0, {"L": 2}), "eV": (1.602176634e-19, 0.0, {"M": 1, "L": 2, "T": -2})}
PREFIX = {"Y": 1e24, "Z": 1e21, "E": 1e18, "P": 1e15, "T": 1e12, "G": 1e9, "M": 1e6, "k": 1e3, "h": 1e2, "da": 1e1, "d": 1e-1, "c": 1e-2, "m": 1e-3, "u": 1e-6, "µ": 1e-6, "μ": 1e-6, "n": 1e-9, "p": 1e-12, "f": 1e-15, "a": 1e-18}
LOGS = {"lg": 10.0, "ln": 2.718281828459045, "lb": 2.0}
_LOG = re.compile(r"\s*(?:(\d+(?:\.\d+)?)\s+)?(lg|ln|lb)\(re:?\s+(.+)\)\s*")
_TOKEN = re.compile(r"\s*(0/00|\d+(?:\.\d*)?(?:[eE][-+]?\d+)?|[^\W\d_]+|[°%][^\W\d_]*|\^|\*\*|[-+]\d+|[./*()@])")


@dataclass(frozen=True)
class Unit:
    scale: float
    shift: float
    dims: tuple[tuple[str, int], ...]
    #: (base, how much of a logarithm a unit is), for levels above the reference that scale and dims tell.
    log: tuple[float, float] | None = None

    def times(self, other: Unit, sign: int = 1) -> Unit:
        dims = dict(self.dims)
        for k, v in other.dims:
            dims[k] = dims.get(k, 0) + sign * v
        return Unit(self.scale * other.scale**sign, 0.0, tuple(sorted((k, v) for k, v in dims.items() if v)))

    def to_power(self, n: int) -> Unit:
        return self if n == 1 else Unit(self.scale**n, 0.0, tuple((k, v * n) for k, v in self.dims if v * n))


def _simple(name: str) -> Unit:
    table = BASE | DERIVED
    if name in table:
        scale, shift, dims = table[name]
        return Unit(scale, shift, tuple(sorted(dims.items())))
    for p in sorted(PREFIX, key=len, reverse=True):
        rest = name[len(p) :]
        if name.startswith(p) and rest in table and rest != "1" and not table[rest][1]:
            scale, _, dims = table[rest]
            return Unit(PREFIX[p] * scale, 0.0, tuple(sorted(dims.items())))
    raise ValueError(f"unknown unit: {name}")


def parse(text: str) -> Unit:
    """Products (space, dot, star), quotients, exponents (``m2``, ``m^2``, ``s-1``), brackets, numbers, ``@`` shifts;
    logarithms to a reference, such as ``0.1 lg(re 1 mW)``."""
    if m := _LOG.fullmatch(text):
        of = parse(m[3])
        return Unit(of.scale, of.shift, of.dims, (LOGS[m[2]], float(m[1] or 1)))
    tokens, at = [], 0
    while at < len(text.rstrip()):
        if not (m := _TOKEN.match(text, at)):
            raise ValueError(f"not a unit: {text}")
        tokens.append((m[1], m.start(1) == at))
        at = m.end()
    if not tokens:
        raise ValueError("empty unit")
    place = 0

    def peek() -> tuple[str, bool] | None:
        return tokens[place] if place < len(tokens) else None

    def factor() -> Unit:
        nonlocal place
        token, _ = tokens[place]
        place += 1
        if token == "(":
            unit = product()
            if not peek() or peek()[0] != ")":
                raise ValueError(f"not a unit: {text}")
            place += 1
        elif re.match(r"[\d]", token) and token != "0/00":
            unit = Unit(float(token), 0.0, ())
        elif re.match(r"[^\W\d_]|°|%|0/00", token):
            unit = _simple(token)
        else:
            raise ValueError(f"not a unit: {text}")
        if (t := peek()) and t[0] in ("^", "**"):
            place += 1
            unit = unit.to_power(int(tokens[place][0]))
            place += 1
        elif t and t[1] and re.fullmatch(r"[-+]?\d+", t[0]) and not unit.dims == () or (t and t[1] and re.fullmatch(r"[-+]\d+", t[0])):
            place += 1
            unit = unit.to_power(int(t[0]))
        return unit

    def product() -> Unit:
        nonlocal place
        unit = factor()
        while (t := peek()) and t[0] not in (")", "@"):
            sign = 1
            if t[0] in (".", "*", "/"):
                sign = -1 if t[0] == "/" else 1
                place += 1
            unit = unit.times(factor(), sign)
        return unit

    unit = product()
    if (t := peek()) and t[0] == "@":
        unit = Unit(unit.scale, float(tokens[place + 1][0]) * unit.scale, unit.dims)
        place += 2
    if place != len(tokens):
        raise ValueError(f"not a unit: {text}")
    return unit


def valid(text: str) -> bool:
    try:
        parse(text)
    except (ValueError, IndexError):
        return False
    return True


def compatible(a: str, b: str) -> bool:
    return valid(a) and valid(b) and parse(a).dims == parse(b).dims


def convert(value: Column, source: str | None, target: str | None) -> Column:
    """Unchanged where a unit is missing or both are the same; unlike dimensions are an error."""
    if not source or not target or source == target:
        return value
    a, b = parse(source), parse(target)
    if a.dims != b.dims:
        raise ValueError(f"{source} and {target} are not compatible")
    if not a.log and not b.log:
        return (value * a.scale + (a.shift - b.shift)) / b.scale
    plain = F.pow(F.lit(a.log[0]), value * a.log[1]) * a.scale if a.log else value * a.scale + a.shift
    return F.log(plain / b.scale) / F.log(F.lit(b.log[0])) / b.log[1] if b.log else (plain - b.shift) / b.scale


def factors(spark: SparkSession, units: list[str]) -> DataFrame:
    """(unit, scale, shift, dims) of the units that parse, for joins by unit."""
    rows = [(u, p.scale, p.shift, " ".join(f"{k}{v}" for k, v in p.dims)) for u in sorted(set(units)) if valid(u) for p in [parse(u)]]
    return spark.createDataFrame(rows, "unit string, scale double, shift double, dims string")


def speed_limit(text: Column, default: float = 40.0) -> Column:
    """Metres per second from texts such as ``40 km h-1``; a bare number is m s-1."""
    number = F.regexp_extract(text, r"^\s*([-+]?\d+(?:\.\d+)?)", 1).try_cast("double")
    unit = F.trim(F.regexp_extract(text, r"^\s*[-+]?\d+(?:\.\d+)?\s*(.*)$", 1))
    known = F.create_map(*[x for u in ("m s-1", "km h-1", "kt", "knot", "cm s-1") for x in (F.lit(u), F.lit(parse(u).scale))])
    return F.coalesce(number * F.when(unit == "", F.lit(1.0)).otherwise(F.try_element_at(known, unit)), F.lit(default))


def all_in(values: Column, able: Column, source: str, target: str) -> Column:
    """An array of values in another unit, null where the array ``able`` says false or null."""
    both = F.arrays_zip(values.alias("v"), able.alias("a"))
    return F.transform(both, lambda x: F.when(x["a"], convert(x["v"], source, target)))


def coded(value: Column, codes: dict, fill: int | float) -> Column:
    """A value's code; the fill value where it is null or unknown."""
    known = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(F.try_element_at(known, value), F.lit(fill))


def rounded(value: Column, digits: int) -> Column:
    """As SQL engines round doubles: the scaled double goes to the nearest whole number, halves away from zero, and keeps its
    sign. Spark's round takes the shortest decimal text of the value instead, where more values are halves."""
    scale = float(10**digits)
    whole = F.signum(value) * F.round(F.abs(value) * scale)
    return F.when(F.abs(whole) < float("inf"), whole / scale).otherwise(value)


def filled(value: Column, fill: float = -9999.9) -> Column:
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(fill))
