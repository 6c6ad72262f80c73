"""Messages, columnar tables, files: made here, read back."""

import pytest
from pyspark.sql import functions as F

from pelagos.sources import bufr, files, mapped

B = {"001001": ("BLOCK", "NUMERIC", 0, 0, 7), "001011": ("SHIP", "CCITT IA5", 0, 0, 72), "005001": ("LATITUDE", "DEGREE", 5, -9000000, 25), "007062": ("DEPTH", "M", 1, 0, 17), "022043": ("TEMPERATURE", "K", 2, 0, 15), "031001": ("COUNT", "NUMERIC", 0, 0, 8), "002002": ("TYPE", "CODE TABLE", 0, 0, 4)}
D = {"301099": ["001011", "005001"], "306099": ["101000", "031001", "306098"], "306098": ["007062", "022043"]}


def _bits(parts):
    text = "".join(f"{v:0{w}b}" for v, w in parts)
    return int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")


def message(names, parts, subsets=1, compressed=False):
    body = _bits(parts)
    one = bytes([0, 0, 22, 0, 0, 7, 0, 0, 0, 0, 31, 0, 4, 29, 0]) + bytes(7)
    three = b"".join((int(n[0]) << 14 | int(n[1:3]) << 8 | int(n[3:])).to_bytes(2, "big") for n in names)
    three = (7 + len(three)).to_bytes(3, "big") + b"\0" + subsets.to_bytes(2, "big") + bytes([0xC0 if compressed else 0x80]) + three
    four = (4 + len(body)).to_bytes(3, "big") + b"\0" + body
    whole = one + three + four + b"7777"
    return b"BUFR" + (8 + len(whole)).to_bytes(3, "big") + b"\x04" + whole


def _text(s, size):
    return int.from_bytes(s.ljust(size).encode(), "big"), 8 * size


PROFILE = message(["001001", "301099", "002002", "306099"], [(62, 7), _text("CGDX", 9), (9000000 + 4412345, 25), (15, 4), (3, 8), (0, 17), (28515, 15), (100, 17), (28000, 15), (250, 17), ((1 << 15) - 1, 15)])


def test_a_profile_is_read():
    got = bufr.Message(PROFILE, B, D).values()
    assert [(s, p, n, v) for s, p, _, n, v in got] == [
        (0, (), "001001", 62.0), (0, (), "001011", "CGDX"), (0, (), "005001", 44.12345), (0, (), "002002", None), (0, (), "031001", 3.0),
        (0, (0,), "007062", 0.0), (0, (0,), "022043", 285.15), (0, (1,), "007062", 10.0), (0, (1,), "022043", 280.0), (0, (2,), "007062", 25.0), (0, (2,), "022043", None)]


def test_subsets_compressed_and_not():
    plain = message(["001001", "022043"], [(1, 7), (27300, 15), (2, 7), (27400, 15), (127, 7), (27500, 15)], 3)
    packed = message(["001001", "022043"], [(1, 7), (2, 6), (0, 2), (1, 2), (3, 2), (27300, 15), (8, 6), (0, 8), (100, 8), (200, 8)], 3, True)
    strip = lambda m: [(s, n, v) for s, _, _, n, v in bufr.Message(m, B, D).values()]
    assert strip(plain) == strip(packed) == [(0, "001001", 1.0), (0, "022043", 273.0), (1, "001001", 2.0), (1, "022043", 274.0), (2, "001001", None), (2, "022043", 275.0)]


def test_operators():
    got = bufr.Message(message(["201132", "202129", "022043", "201000", "202000", "022043", "205003", "208002", "001011", "207001", "022043"], [(285151, 19), (28515, 15), _text("abc", 3), _text("XY", 2), (285155, 19)]), B, D).values()
    assert [v for *_, v in got] == [285.151, 285.15, "abc", "XY", 285.155]
    with pytest.raises(ValueError, match="not known"):
        bufr.Message(message(["222000"], [(0, 8)]), B, D).values()


def test_files_of_messages(spark):
    broken, unknown = PROFILE[:-6], message(["009009"], [(1, 8)])
    rows = [("a", b"junk" + PROFILE + b"\r\n\x03" + PROFILE), ("b", unknown + PROFILE), ("c", broken), ("d", None), ("e", b"")]
    got = bufr.decoded(spark.createDataFrame(rows, "path string, content binary"), B, D).collect()
    bad = {(r.path, r.message_idx): r.malformed for r in got if r.malformed}
    assert set(bad) == {("b", 0), ("c", 0)} and "009009" in bad["b", 0] and "cut off" in bad["c", 0]
    assert {(r.path, r.message_idx) for r in got if not r.malformed} == {("a", 0), ("a", 1), ("b", 1)}
    levels = sorted((r.level_idx, r.value_num) for r in got if r.path == "b" and r.name == "DEPTH")
    assert levels == [(0, 0.0), (1, 10.0), (2, 25.0)]


def test_values_become_elements(spark):
    b = B | {c: (n, "NUMERIC", 0, 0, w) for c, n, w in (("004001", "YEAR", 12), ("004002", "MONTH", 4), ("004003", "DAY", 6), ("004004", "HOUR", 5), ("001005", "BUOY", 17), ("001003", "REGION", 3))}
    whole = message(["004001", "004002", "004003", "004004", "001003", "001005", "002002", "306099"], [(2024, 12), (2, 4), (29, 6), (6, 5), (4, 3), (123, 17), (3, 4), (2, 8), (0, 17), (28515, 15), (100, 17), (28000, 15)])
    found = bufr.decoded(spark.createDataFrame([("a", whole + PROFILE)], "path string, content binary"), b, D)
    rules = {"007062": {"do": "set", "scope": "coordinates", "name": "Depth", "units": "m"}, "022043": {"do": "set", "scope": "parameters", "name": "Temperature", "units": "degC"}, "002002": {"do": "record", "scope": "metadata", "name": "Type", "map": {3: "drifter"}}, "031001": {"do": "noop"}, "001011": {"do": "error"}}
    got = sorted(((r.record_id, r.level_idx if r.level_idx is not None else -1, r.name, r.value_txt, r.units) for r in bufr.elements(found, rules).collect()))
    assert got == [("a|0|0", -1, "Time", "2024-02-29T06:00:00Z", None), ("a|0|0", -1, "Type", "drifter", None), ("a|0|0", -1, "WMOID", "400123", None), ("a|0|0", 0, "Depth", "0.0", "m"), ("a|0|0", 0, "Temperature", "12.0", "degC"), ("a|0|0", 1, "Depth", "10.0", "m"), ("a|0|0", 1, "Temperature", "6.85", "degC")]


def test_types_of_messages():
    known = {"profile": ["001001", "301099", "306099"], "surface": ["001001", "022043"]}
    assert bufr.kind(["001001", "022043"], known, D) == "surface"
    assert bufr.kind(["001001", "001011", "005001", "002002", "306099"], known, D) == "profile"
    assert bufr.kind(["009009"], known, D) is None


def test_mapping_of_columns(spark):
    df = spark.createDataFrame([("r", 0, 4.5, None, "1", "a;B"), ("r", 1, float("nan"), 3.0, "2", None)], "id string, n int, TEMP_ADJUSTED double, TEMP double, TEMP_QC string, PI string")
    rules = [
        {"name": "Temperature", "scope": "parameters", "source": "var:TEMP_ADJUSTED|var:TEMP|var:GONE", "quality": "var:TEMP_QC", "units": "attribute:TEMP.units"},
        {"name": "Investigator", "scope": "metadata", "source": "var:PI", "separator": ";", "map": {"b": "Bea"}}, {"name": "Title", "scope": "metadata", "source": "globalvar:title"}, {"name": "None", "scope": "metadata", "source": "var:NO"},
    ]
    got = sorted((r.name, r.level_idx, r.value_idx, r.value_txt, r.units, r.quality) for r in mapped.elements(df, "id", "n", rules, {"TEMP.units": "degC", "title": "T"}).collect())
    assert got == [("Investigator", None, 0, "a", None, None), ("Investigator", None, 1, "Bea", None, None), ("Temperature", 0, 0, "4.5", "degC", 1), ("Temperature", 1, 0, "3.0", "degC", 2), ("Title", None, 0, "T", None, None)]
    found = mapped.elements(df, "id", "n", rules, {"TEMP.units": "degC"})
    assert sorted(tuple(r)[3:] for r in mapped.columns(found, {"TEMP": "Temperature", "SAL": "Salinity"}).collect()) == [(0, 4.5, -9999.9), (1, 3.0, -9999.9)]
    assert [r.line for r in mapped.shown(found).orderBy("line_no").collect()][-2:] == ["PROFILE/0/0 Temperature=4.5 degC [1]", "PROFILE/0/1 Temperature=3.0 degC [2]"]


def test_sensors(spark):
    variables = spark.createDataFrame([("TEMP", "s1"), ("DOXY", "s2"), ("X", None)], "variable string, sensor_name string")
    assert {tuple(r) for r in mapped.sensors(variables).collect()} == {("TEMP", "SENSOR_CTD_s1"), ("DOXY", "SENSOR_DOXY_s2"), ("X", None)}
    listed = spark.createDataFrame([("s1", "ctd", "77")], "sensor string, sensor_type string, serial string")
    assert {tuple(r) for r in mapped.sensors(variables, listed).collect()} == {("TEMP", "SENSOR_CTD_77"), ("DOXY", None), ("X", None)}


def test_wire(spark):
    body = bytes(mapped.wire(spark.createDataFrame([("r1", "é", None, "{}")], "record_id string, record_hash string, actions string, record string")).first().body)
    parts, at = [], 0
    while at < len(body):
        n = int.from_bytes(body[at : at + 4], "big")
        parts.append(body[at + 4 : at + 4 + n].decode())
        at += 4 + n
    assert parts == ["r1", "é", "", "{}"]


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, said in (("a.txt", "one"), ("b.txt", "two"), ("c.csv", "x")):
        (tmp_path / "in" / name).write_text(said)
    found = files.listed(spark, str(tmp_path / "in"), "*.txt")
    assert sorted(r.size for r in found.collect()) == [3, 3]
    ledger = files.noted(spark.createDataFrame([], "path string, modified timestamp, seen timestamp"), found, "2024-01-01")
    assert files.unseen(found, ledger).count() == 0 and files.noted(ledger, found, "2024-01-02").count() == 2
    files.copied(spark, str(tmp_path / "in" / "a.txt"), str(tmp_path / "out" / "a.txt"))
    with pytest.raises(FileExistsError):
        files.copied(spark, str(tmp_path / "in" / "b.txt"), str(tmp_path / "out" / "a.txt"))
    files.copied(spark, str(tmp_path / "in" / "b.txt"), str(tmp_path / "out" / "a.txt"), move=True, replace=True)
    assert (tmp_path / "out" / "a.txt").read_text() == "two" and not files.exists(spark, str(tmp_path / "in" / "b.txt"))
    assert files.versioned(spark, str(tmp_path / "out" / "a.txt")).endswith("a.txt.1") and files.removed(spark, str(tmp_path / "out"))
    files.written(spark.range(3), str(tmp_path / "gz"))
    assert any(p.name.endswith(".json.gz") for p in (tmp_path / "gz").iterdir())
    assert [r.id for r in files.rows(spark.range(3))] == [0, 1, 2] and F is not None
