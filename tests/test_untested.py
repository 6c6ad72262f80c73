"""Functions without a query: bands by cells, permissions, streams, cron, fixed text, Arrow text, bathymetry by reach."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pelagos.functions import cron, geo, text, units
from pelagos.operators import filters, joins, suites
from pelagos.streaming import ingest


def test_bands_by_cells_equal_bands_broadcast(spark):
    values = spark.range(300).select((F.col("id") / 3 - 20).alias("v"))
    bands = spark.createDataFrame([("a", -5.0, 10.0), ("b", 9.5, 9.6), ("c", 60.0, 79.0), ("d", -100.0, -19.0)], "band string, low double, high double")
    rows = lambda df: sorted((r.v, r.band) for r in df.collect())
    assert rows(joins.in_bands(values, bands, "v", small=1)) == rows(joins.in_bands(values, bands, "v"))


def test_pairs_are_found_once(spark):
    rows = [(i, "p" if i % 3 else "q", datetime(2024, 1, 1, 0, (i * 7) % 60, i % 60)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, key string, t timestamp")
    got = [tuple(r) for r in joins.near_pairs(df, "key", "id", "t", 600).collect()]
    want = {(a, b) for a, k, t in rows for b, j, u in rows if a < b and k == j and abs((t - u).total_seconds()) <= 600}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("expression, now, due", [
    ("*/15 * * * *", "2024-01-01 00:00:30", "2024-01-01 00:15:00"), ("0 0 * * *", "2024-01-01 00:00:00", "2024-01-02 00:00:00"), ("@daily", "2024-02-28 23:59:59", "2024-02-29 00:00:00"),
    ("30 4 1,15 * 5", "2024-01-01 05:00:00", "2024-01-05 04:30:00"), ("0 12 * JAN-MAR MON", "2024-03-26 00:00:00", "2025-01-06 12:00:00"), ("5-10/2 1 * * 7", "2024-01-06 00:00:00", "2024-01-07 01:05:00"),
    ("0 0 29 2 *", "2024-03-01 00:00:00", "2028-02-29 00:00:00"), ("0 0 31 2 *", "2024-01-01 00:00:00", None),
])
def test_cron(expression, now, due):
    assert cron.Cron(expression).after(datetime.fromisoformat(now)) == (due and datetime.fromisoformat(due))


def test_cron_hash_and_errors():
    a, b = cron.Cron("H H * * *", "one"), cron.Cron("H H * * *", "one")
    assert a.sets == b.sets and all(len(s) == 1 for s in a.sets[:2])
    for bad in ("* * * *", "61 * * * *", "5-1 * * * *", "*/0 * * * *", "x * * * *"):
        with pytest.raises(ValueError):
            cron.Cron(bad)


def test_fixed_text(spark):
    r = spark.createDataFrame([("añb",), ("x" * 9,), (None,)], "s string").select(text.to_fixed(F.col("s"), 6).alias("b"), text.from_fixed(text.to_fixed(F.col("s"), 6)).alias("t")).collect()
    assert [x.b and bytes(x.b) for x in r] == ["añb".encode() + b"\0\0", b"xxxxxx", None] and [x.t for x in r] == ["añb", "xxxxxx", None]


def test_composed_text_is_normal(spark):
    r = spark.createDataFrame([("é\t a–b",), (None,)], "s string").select(text.normalise(F.col("s"), compose=True).alias("t")).collect()
    assert [x.t for x in r] == ["é a-b", None]


def test_cells_go_round_the_sphere(spark):
    grid = spark.createDataFrame([(0, -180, 1.0), (0, 179, 5.0), (3, 179, 9.0)], "cell_lat long, cell_lon long, height double").withColumn("top", F.col("height"))
    at = spark.createDataFrame([(1, 0.5, 179.5)], "id long, lat double, lon double")
    got = lambda **k: joins.around(at, grid, "id", "lat", "lon", 1, "height", "top", **k).first()
    assert tuple(got()) == (1, 1.0, 5.0, 2) and tuple(got(sd=0.6)) == (1, 1.0, 9.0, 3)
    assert geo is not None


def test_permissions(spark):
    r = spark.createDataFrame([(1, ["read"], ["edit", "read"]), (2, [], ["read"]), (3, ["x"], ["__any__"]), (4, ["__admin__"], ["read"])], "id long, held array<string>, wanted array<string>")
    assert [x.id for x in r.where(filters.permitted(F.col("wanted"), F.col("held"))).orderBy("id").collect()] == [1, 3, 4]


def test_streams_count_and_drop_repeats(spark, tmp_path):
    rows = "\n".join(f'{{"k": {i % 4}, "t": "2024-01-01T00:{i % 4:02d}:00Z"}}' for i in range(12))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(rows)
    events = ingest.stream(spark, str(tmp_path / "in"), "k long, t timestamp")
    for name, df in (("once", ingest.distinct_events(events, ["k"], "t")), ("counts", ingest.counted(events, "t", "2 minutes", "10 minutes"))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append" if name == "once" else "complete").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.table("once").count() == 4 and sorted(r.n for r in spark.table("counts").collect()) == [6, 6]


def test_loads_by_day(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, ids in enumerate(((1, 2, 2), (2, 3))):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(f'{{"id": {i}, "day": "2024-01-0{i}"}}' for i in ids))
        ingest.load_new(ingest.stream(spark, str(tmp_path / "in"), "id long, day string"), str(tmp_path / "out"), str(tmp_path / "cp"), ["id", "day"], "day")
    got = spark.read.schema("id long, day string").parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_runs_of_many_suites_are_cut(spark):
    schema = "record_id long, set_type string, set_idx int, level_idx int, scope string, name string, value_idx int, value_num double, value_txt string, units string, quality int, working_quality int, uncertainty double"
    rows = [(1, "PROFILE", 0, i, "coordinates", "Depth", 0, float(v), str(v), None, None, None, None) for i, v in enumerate((1, 3, 2, 4))]
    run = suites.run(spark.createDataFrame(rows, schema), [suites.Suite(f"s{k}", suites.increasing()) for k in range(4)])
    assert [(r.test_name, r.level_idx) for r in run[1].collect()] == [("s0", 2)]
    assert sorted((r.test_name, r.result) for r in run[2].collect()) == [("s0", "F"), ("s1", "P"), ("s2", "P"), ("s3", "P")]


@pytest.mark.parametrize("value, a, b, want", [
    (1, "nmile", "m", 1852), (212, "°F", "°C", 100), (1, "atm", "dbar", 10.1325), (1, "mho cm-1", "S m-1", 100), (2, "kilogram", "gram", 2000), (1, "uF", "F", 1e-6), (30, "0.1 lg(re 1 mW)", "W", 1), (2, "W", "0.1 lg(re 1 mW)", 33.0103),
    (1, "lg(re 1 mW)", "0.1 lg(re 1 mW)", 10), (3, "lb(re 1 Pa)", "Pa", 8), (100, "ppm", "%", 0.01),
])
def test_more_units(spark, value, a, b, want):
    assert spark.range(1).select(units.convert(F.lit(float(value)), a, b)).first()[0] == pytest.approx(want, rel=1e-5)


def test_logarithms_keep_their_dimensions():
    assert units.compatible("0.1 lg(re 1 mW)", "W") and not units.compatible("lg(re 1 mW)", "Pa") and not units.valid("lg(re 1 foo)") and not units.valid("smbar")


def test_suites_are_registered_once_and_agree_on_an_order():
    name = "a suite of the tests"
    made = suites.suite(name, "2.0", order="time")(suites.increasing())
    try:
        assert suites.REGISTRY[name] is made and made.version == "2.0"
        with pytest.raises(ValueError, match="there is"):
            suites.suite(name)(suites.increasing())
        other = suites.Suite("b", suites.increasing(), order="depth")
        assert suites.agreed_order([made, suites.Suite("c", suites.increasing())]) == "time" and suites.agreed_order([]) is None
        with pytest.raises(ValueError, match="different orders"):
            suites.agreed_order([made, other])
    finally:
        suites.REGISTRY.pop(name)
