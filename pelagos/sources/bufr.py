"""BUFR messages of editions 3 and 4, by tables that the caller gives (S20, S20a-S20d).

Tables are data, not code: ``B`` is {descriptor: (name, units, scale, reference, width)}, ``D`` {descriptor: [descriptors]},
descriptors being six digits. A message is decoded by one task; one that cannot be read is a row with ``malformed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TableB = dict[str, tuple[str, str, int, int, int]]
TableD = dict[str, list[str]]
#: (subset, path of replications, place, descriptor, value)
Found = tuple[int, tuple[int, ...], int, str, float | str | None]


class Bits:
    def __init__(self, data: bytes) -> None:
        self.value, self.left = int.from_bytes(data, "big"), 8 * len(data)

    def take(self, width: int) -> int:
        if width > self.left:
            raise ValueError("the data section is cut off")
        self.left -= width
        return self.value >> self.left & (1 << width) - 1


def sections(message: bytes) -> tuple[dict[str, int], list[str], int, bool, bytes]:
    """(header, unexpanded descriptors, subsets, compressed, data) of a message."""
    if message[:4] != b"BUFR" or message[7] not in (3, 4):
        raise ValueError("not a BUFR message of edition 3 or 4")
    total, edition = int.from_bytes(message[4:7], "big"), message[7]
    if len(message) < total or message[total - 4 : total] != b"7777":
        raise ValueError("the message is cut off")
    size = int.from_bytes(message[8:11], "big")
    one = message[8 : 8 + size]
    at = 8 + size
    if edition == 4:
        header = {"edition": 4, "centre": int.from_bytes(one[4:6], "big"), "category": one[10], "subcategory": one[11], "master": one[13], "local": one[14]}
        optional = one[9] & 0x80
    else:
        header = {"edition": 3, "centre": one[5], "category": one[8], "subcategory": one[9], "master": one[10], "local": one[11]}
        optional = one[7] & 0x80
    if optional:
        at += int.from_bytes(message[at : at + 3], "big")
    size = int.from_bytes(message[at : at + 3], "big")
    three = message[at : at + size]
    pairs = [int.from_bytes(three[i : i + 2], "big") for i in range(7, size - 1, 2)]
    names = [f"{p >> 14}{p >> 8 & 63:02d}{p & 255:03d}" for p in pairs]
    at += size
    size = int.from_bytes(message[at : at + 3], "big")
    return header, names, int.from_bytes(three[4:6], "big"), bool(three[6] & 0x40), message[at + 4 : at + size]


class Message:
    """Walks the descriptors of one message; replications are followed as the data tells."""

    def __init__(self, message: bytes, b: TableB, d: TableD) -> None:
        self.header, self.names, self.subsets, self.compressed, data = sections(message)
        self.b, self.d, self.bits = b, d, Bits(data)

    def values(self) -> list[Found]:
        out: list[Found] = []
        for subset in [-1] if self.compressed else range(self.subsets):
            self.wider, self.scaled, self.signs, self.more = 0, 0, 0, 0
            self.out, self.place = out, 0
            self._walk(self.names, subset, ())
        return sorted(out, key=lambda f: (f[0], f[2]))

    def _put(self, subset: int, path: tuple[int, ...], name: str, values: list) -> None:
        for k, v in enumerate(values):
            self.out.append((k if self.compressed else subset, path, self.place, name, v))
        self.place += 1

    def _numbers(self, width: int) -> list[int | None]:
        """A number a subset, or the one there is; all bits set: missing."""
        none = (1 << width) - 1
        if not self.compressed:
            return [None if (v := self.bits.take(width)) == none and width > 1 else v]
        low, size = self.bits.take(width), self.bits.take(6)
        if not size:
            return [None if low == none and width > 1 else low] * self.subsets
        steps = [self.bits.take(size) for _ in range(self.subsets)]
        return [None if s == (1 << size) - 1 else low + s for s in steps]

    def _texts(self, width: int) -> list[str | None]:
        def read(bits: int) -> str | None:
            raw = self.bits.take(bits).to_bytes(bits // 8, "big")
            return None if raw.strip(b"\xff") == b"" else raw.decode("latin-1").strip(" \x00")

        if not self.compressed:
            return [read(width)]
        base, size = read(width), self.bits.take(6)
        return [read(8 * size) for _ in range(self.subsets)] if size else [base] * self.subsets

    def _element(self, name: str, subset: int, path: tuple[int, ...]) -> list:
        if name not in self.b:
            raise ValueError(f"{name} is in no table")
        _, unit, scale, reference, width = self.b[name]
        if unit.startswith("CCITT"):
            values: list = self._texts(self.signs or width)
        else:
            coded = unit.upper().startswith(("CODE", "FLAG")) or name.startswith("031")
            if not coded:
                scale, width = scale + self.scaled + self.more, width + self.wider + (10 * self.more + 2) // 3 * (self.more > 0)
                reference *= 10**self.more
            values = [None if v is None else (v + reference) / 10**scale if scale > 0 else float((v + reference) * 10**-scale) for v in self._numbers(width)]
        self._put(subset, path, name, values)
        return values

    def _walk(self, names: list[str], subset: int, path: tuple[int, ...]) -> None:
        at = 0
        while at < len(names):
            name = names[at]
            at += 1
            x, y = int(name[1:3]), int(name[3:])
            if name[0] == "0":
                self._element(name, subset, path)
            elif name[0] == "3":
                if name not in self.d:
                    raise ValueError(f"{name} is in no table")
                self._walk(self.d[name], subset, path)
            elif name[0] == "1":
                times = y
                if not y:
                    counted = self._element(names[at], subset, path)
                    at += 1
                    if any(v != counted[0] for v in counted) or counted[0] is None:
                        raise ValueError("replications of compressed subsets differ")
                    times = int(counted[0])
                part = names[at : at + x]
                at += x
                for k in range(times):
                    self._walk(part, subset, (*path, k))
            else:
                self._operator(x, y, subset, path)

    def _operator(self, x: int, y: int, subset: int, path: tuple[int, ...]) -> None:
        if x == 1:
            self.wider = y - 128 if y else 0
        elif x == 2:
            self.scaled = y - 128 if y else 0
        elif x == 5:
            self._put(subset, path, f"205{y:03d}", self._texts(8 * y))
        elif x == 7:
            self.more = y
        elif x == 8:
            self.signs = 8 * y
        else:
            raise ValueError(f"operator 2{x:02d}{y:03d} is not known")


def kind(names: list[str], known: dict[str, list[str]], d: TableD) -> str | None:
    """Which known type a message is: the one with the same descriptors, else the one whose expanded descriptors share the longest
    subsequence with its own, at least half of them."""
    def whole(some: list[str]) -> list[str]:
        return [y for x in some for y in (whole(d[x]) if x in d else [x])]

    if same := next((k for k, v in known.items() if v == names), None):
        return same
    mine, best = whole(names), (0.0, None)
    for k, v in known.items():
        other = whole(v)
        row = [0] * (len(other) + 1)
        for a in mine:
            new = [0]
            for j, b in enumerate(other):
                new.append(row[j] + 1 if a == b else max(row[j + 1], new[j]))
            row = new
        best = max(best, (2 * row[-1] / max(1, len(mine) + len(other)), k), key=lambda p: p[0])
    return best[1] if best[0] >= 0.5 else None


SCHEMA = "path string, message_idx int, subset int, set_idx int, level_idx int, depth int, place int, descriptor string, name string, units string, value_num double, value_txt string, malformed string"
_ARROW = pa.schema([("path", pa.string()), *((n, pa.int32()) for n in ("message_idx", "subset", "set_idx", "level_idx", "depth", "place")), ("descriptor", pa.string()), ("name", pa.string()), ("units", pa.string()), ("value_num", pa.float64()), ("value_txt", pa.string()), ("malformed", pa.string())])


def messages(data: bytes) -> Iterator[bytes]:
    """The messages of a file, whatever stands around them; the last may be cut off."""
    at = data.find(b"BUFR")
    while at >= 0:
        size = int.from_bytes(data[at + 4 : at + 7], "big")
        yield data[at : at + max(size, 8)]
        at = data.find(b"BUFR", at + max(size, 4))


def decoded(files: DataFrame, b: TableB, d: TableD, content: str = "content") -> DataFrame:
    """One row a value of each message in files (path, content): where it stands (subset; the first replication as set_idx with
    the step in it as level_idx, null outside; how deep), its descriptor, name, units, and number or text. Missing values are null.

    A file is one row and so in one task, as are its messages; files are dealt out by Spark. Null contents have none.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for path, data in zip(batch.column("path").to_pylist(), batch.column(content).to_pylist()):
                for n, message in enumerate(messages(data or b"")):
                    rows: list[tuple] = []
                    try:
                        for subset, steps, place, name, v in Message(message, b, d).values():
                            label, unit = b[name][:2] if name in b else (None, None)
                            rows.append((path, n, subset, 0 if steps else None, steps[0] if steps else None, len(steps), place, name, label, unit, v if isinstance(v, float) else None, v if isinstance(v, str) else None, None))
                    except (ValueError, IndexError) as wrong:
                        rows = [(path, n, *[None] * 10, f"{type(wrong).__name__}: {wrong}")]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return files.select("path", content).mapInArrow(run, SCHEMA)

#: Descriptors of year, month, day, hour, minute, second, and those of a platform's region, number and buoy.
CLOCK = ("004001", "004002", "004003", "004004", "004005", "004006")
REGION, BLOCK, BUOY, STATION = "001003", "001001", "001005", "001002"
#: Kelvin to degrees: what instructions may ask for instead of the table's units.
KELVIN = 273.15


def elements(found: DataFrame, instructions: dict[str, dict], set_type: str = "PROFILE") -> DataFrame:
    """Decoded values as elements in long format, by instructions: {descriptor: {"do": ..., "scope", "name", "units", "map"}}.

    do: ``set`` (an element of the level, or of the record where there is none), ``record`` (of the record wherever it stands),
    ``noop`` (left out), ``error`` (the record is refused: none of its values comes). Descriptors without an instruction
    are left out, as are missing values. ``map`` turns codes into texts. A value met again at the same place is a further value.
    Dates that are there down to the day give a Time, numbers of stations and buoys a WMOID. A record is a subset of a message.
    """
    good = found.where("malformed is null").withColumn("record_id", F.concat_ws("|", "path", "message_idx", "subset"))
    refused = [k for k, v in instructions.items() if v["do"] == "error"]
    if refused:
        good = good.join(good.where(F.col("descriptor").isin(refused)).select("record_id").distinct(), "record_id", "left_anti")
    text = F.coalesce("value_txt", F.col("value_num").cast("string"))
    parts = []
    for descriptor, rule in instructions.items():
        if rule["do"] not in ("set", "record"):
            continue
        value, number = text, F.col("value_num")
        if rule.get("map"):
            known = F.create_map(*[F.lit(x) for k, v in rule["map"].items() for x in (str(k), str(v))])
            value, number = F.try_element_at(known, number.cast("int").cast("string")), F.lit(None).cast("double")
        elif rule.get("units") == "degC":
            number = F.round(number - KELVIN, 6)
            value = number.cast("string")
        top = F.col("level_idx").isNull() | F.lit(rule["do"] == "record")
        own = lambda c, t, top=top: F.when(~top, F.col(c)).cast(t)
        parts.append(good.where(F.col("descriptor") == descriptor).select(
            "record_id", F.when(~top, F.lit(set_type)).alias("set_type"), F.when(~top, F.lit(0)).alias("set_idx"), own("level_idx", "int").alias("level_idx"), F.lit(rule["scope"]).alias("scope"), F.lit(rule["name"]).alias("name"), "place",
            number.alias("value_num"), value.alias("value_txt"), F.lit(rule.get("units")).cast("string").alias("units")))
    at = {c: F.max(F.when(F.col("descriptor") == c, F.col("value_num"))).cast("int") for c in (*CLOCK, REGION, BLOCK, BUOY, STATION)}
    tops = good.where(F.col("descriptor").isin(*at)).groupBy("record_id").agg(*[v.alias(f"d{c}") for c, v in at.items()])
    clock = [F.col(f"d{c}") for c in CLOCK[:3]] + [F.coalesce(f"d{c}", F.lit(0)) for c in CLOCK[3:]]
    time = F.date_format(F.try_make_timestamp(*clock), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    buoy = F.concat(F.coalesce(F.col(f"d{REGION}").cast("string"), F.lit("")), F.lpad(F.col(f"d{BUOY}").cast("string"), 5, "0"))
    station = F.concat(F.lpad(F.col(f"d{BLOCK}").cast("string"), 2, "0"), F.lpad(F.col(f"d{STATION}").cast("string"), 3, "0"))
    null = lambda t: F.lit(None).cast(t)
    for scope, name, value in (("coordinates", "Time", time), ("metadata", "WMOID", F.coalesce(buoy, station))):
        parts.append(tops.select("record_id", null("string").alias("set_type"), null("int").alias("set_idx"), null("int").alias("level_idx"), F.lit(scope).alias("scope"), F.lit(name).alias("name"), F.lit(-1).alias("place"), null("double").alias("value_num"), value.alias("value_txt"), null("string").alias("units")))
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    order = Window.partitionBy("record_id", "set_type", "set_idx", "level_idx", "scope", "name").orderBy("place")
    placed = whole.where("value_txt is not null").withColumn("value_idx", (F.row_number().over(order) - 1).cast("int"))
    return placed.select("record_id", "set_type", "set_idx", "level_idx", "scope", "name", "value_idx", "value_num", "value_txt", "units", null("int").alias("quality"), null("int").alias("working_quality"), null("double").alias("uncertainty"))
