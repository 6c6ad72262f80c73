import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pelagos.operators import changes, compare
from pelagos.sources import ctd, framed

ELEMENTS = "record_id string, set_type string, set_idx int, level_idx int, scope string, name string, value_idx int, value_num double, value_txt string, units string, quality int, working_quality int, uncertainty double"


def element(record, name, value, scope="parameters", at=(None, None, None), idx=0, sd=None):
    number = float(value) if isinstance(value, int | float) else None
    return (record, *at, scope, name, idx, number, None if value is None else str(value), None, None, None, sd)


def test_tables(spark):
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None), (9, "z")], "k int, s string")
    assert {tuple(r) for r in changes.updated(table, new, ["k"]).collect()} == {(1, "a", 1), (2, None, 2), (3, "c", 3)}
    assert {tuple(r) for r in changes.upserted(table, new, ["k"]).collect()} == {(1, "a", 1), (2, None, None), (3, "c", 3), (9, "z", None)}
    with pytest.raises(ValueError):
        changes.deleted(table, new, [])


def test_copy_lines(spark):
    df = spark.sql("SELECT 'a\\\\b\\tc\\nd' AS s, CAST(NULL AS INT) AS n, true AS t, X'0AFF' AS b, TIMESTAMP '2020-01-02 03:04:05' AS ts, DATE '2020-01-02' AS d, array(1, 2) AS l")
    assert changes.copy_lines(df).first().line == "a\\\\b\\tc\\nd\t\\N\tt\t\\\\x0aff\t2020-01-02 03:04:05Z\t2020-01-02\t[1,2]"


def test_edits_need_the_hash(spark):
    found = spark.createDataFrame([element("r", "T", 1.0), element("r", "S", 2.0), element("q", "T", 3.0)], ELEMENTS)
    hashes = {r.record_id: r.record_hash for r in changes.record_hashes(found).collect()}
    assert hashes == {r.record_id: r.record_hash for r in changes.record_hashes(found.orderBy(F.desc("value_num"))).collect()}
    place = ["record_id", "set_type", "set_idx", "level_idx", "scope", "name", "value_idx"]
    rows = [(hashes["r"], "r", None, None, None, "parameters", "T", 0, 1, "set_value", "7"), (hashes["r"], "r", None, None, None, "parameters", "T", 0, 2, "set_flag", "4"), ("old", "q", None, None, None, "parameters", "T", 0, 1, "set_value", "8")]
    actions = spark.createDataFrame(rows, "record_hash string, record_id string, set_type string, set_idx int, level_idx int, scope string, name string, value_idx int, action_idx int, kind string, new_value string")
    after, refused = changes.edited(found, actions, place)
    assert {(r.record_id, r["name"]): (r.value_num, r.working_quality) for r in after.collect()} == {("r", "T"): (7.0, 4), ("r", "S"): (2.0, None), ("q", "T"): (3.0, None)}
    assert refused.count() == 1


def test_compared_records(spark):
    def record(name, temps, lat=1.0, depths=(10, 20)):
        out = [element(name, "Latitude", lat, "coordinates")]
        for s, values in enumerate(temps):
            for i, (d, v) in enumerate(zip(depths, values)):
                at = ("PROFILE", s, i)
                out += [element(name, "Depth", d + 100 * (v >= 50), "coordinates", at), element(name, "Temperature", v, "parameters", at)]
        return out

    rows = record("a", [(1, 2), (51, 52)]) + record("b", [(51, 52), (1, 2)]) + record("c", [(1, 2)]) + record("d", [(3, 4), (53, 54)], 9.0) + [element("e", "X", 1, idx=0), element("e", "X", 2, idx=1), element("f", "X", 2, idx=0), element("f", "X", 1, idx=1), element("f", "Y", "t")]
    pairs = spark.createDataFrame([(1, "a", "b"), (2, "a", "c"), (3, "a", "d"), (4, "e", "f"), (5, "no", "ne")], "pair_id int, a string, b string")
    got = {r.pair_id: r for r in compare.verdicts(pairs, spark.createDataFrame(rows, ELEMENTS)).collect()}
    assert got[1].verdict == "IDENTICAL" and got[1].identical == 9
    assert got[2].conflict == 2 and got[2].a_better == 2 and got[2].verdict == "PROBABLE_MATCH"  # 7 of 9 reach 0.8 cut to 7
    assert got[3].conflict == 5 and got[3].identical == 4 and got[3].verdict == "IMPROBABLE_MATCH"
    assert got[4].verdict == "B_IS_SUPERSET" and got[5].verdict == "IDENTICAL"


@pytest.mark.parametrize("n", [0, 1, 127, 128, 16384, 2**40 + 3])
def test_numbers(n):
    assert framed.read_number(b"\x00" + framed.number(n), 1) == (n, 1 + len(framed.number(n)))


@pytest.mark.parametrize("compression", ["", "LZMA", "LZMA2CRC4", "LZMACRC8", "ZLIB9", "BZ2"])
def test_binary_round_trip(spark, tmp_path, compression):
    records = spark.createDataFrame([(i, '{"_metadata":{"i":%d}}' % i) for i in range(200)], "i int, j string").withColumn("body", F.parse_json("j")).withColumn("file", F.lit("f"))
    (tmp_path / "a.ocp2").write_bytes(framed.encoded(records, "file", compression=compression).first().content)
    (tmp_path / "b.ocp2").write_bytes(b"\xff\xff nothing")
    got = framed.read_binary(spark, str(tmp_path))
    numbers = got.where("body is not null").select(F.variant_get("body", "$._metadata.i", "int").alias("i")).collect()
    assert sorted(r.i for r in numbers) == list(range(200))
    assert got.where("malformed is not null").count() == 1


def test_yaml_and_bulletins(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("%YAML 1.1\n---\n_metadata:\n  a: 1\n...\n---\n_metadata: {b: [\n...\n---\nx: 2020-01-01\n")
    got = framed.read_yaml(spark, str(tmp_path)).orderBy("message_idx").collect()
    assert [r.malformed is None for r in got] == [True, False, True] and json.loads(got[2].body.toJson())["x"] == "2020-01-01"
    message = b"BUFR" + (21).to_bytes(3, "big") + b"\x04" + b"KKYY =\nABCD12"
    (tmp_path / "g.bin").write_bytes(b"\r\r\nISXX02 CWOW 231200 RRA\r\r\n" + message + b"\r\n\x03junk line\nKKYY 1 2\n3=\nSOVX01 CWOW 231201\nJJVV 5")
    rows = [(r.header, r.kind, bytes(r.message)) for r in framed.read_bulletins(spark, str(tmp_path), "*.bin").orderBy("message_idx").collect()]
    assert rows == [("ISXX02 CWOW 231200 RRA", "BUFR", message), ("ISXX02 CWOW 231200 RRA", None, b"junk line"), ("ISXX02 CWOW 231200 RRA", "KKYY", b"KKYY 1 2\n3="), ("SOVX01 CWOW 231201", "JJVV", b"JJVV 5")]


def test_casts(spark, tmp_path):
    head = '% Device,CC1\n% File name,"x, 1"\n% Cast time (UTC),7/4/2021 13:05\n% Cast data,Raw\n% Pressure calibration date,{0}\n%\n'
    columns = "Time (Seconds),Pressure (Decibar)\n"
    (tmp_path / "a.csv").write_text(head.format("2020-01-02") + columns + "0,1.5\n1,2.5\n\n")
    (tmp_path / "b.csv").write_text(head.format("soon") + columns + "0,1\n")
    (tmp_path / "c.csv").write_text(head.format("") + columns + "0\n")
    (tmp_path / "d.csv").write_text(head.format("") + "Depth (Meter)\n0\n")
    (tmp_path / "e.csv").write_text(head.format("") + columns + "0,1\n\nmore\n")
    (tmp_path / "f.csv").write_text("% Device,CC1\n")
    files = ctd.read_files(spark, str(tmp_path)).cache()
    assert {r.path[-5]: r.problem for r in files.collect()} == {"a": None, "b": "bad calibration date", "c": "columns differ", "d": "unknown column", "e": "text after data", "f": "no header"}
    rows = ctd.levels(files).orderBy("level_idx").collect()
    assert [r["Pressure (Decibar)"] for r in rows] == [1.5, 2.5] and rows[0]["Depth (Meter)"] is None
    assert rows[0].minutes == (datetime(2021, 7, 4, 13, 5) - datetime(1950, 1, 1)).total_seconds() / 60 and files.where("problem is null").first().metadata["% File name"] == "x, 1"
