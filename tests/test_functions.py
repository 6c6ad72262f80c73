import duckdb
import pytest
from pyspark.sql import functions as F

from pelagos.functions import geo, ocean, text, uncertainty, units
from pelagos.operators import joins, profiles, rollups
from pelagos.sources import records
from pelagos.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("value, a, b, want", [(100, "m s-1", "km h-1", 360), (1, "km2", "m2", 1e6), (27, "°C", "K", 300.15), (27, "°C m-1", "K m-1", 27), (1000, "hPa", "kPa", 100), (1, "dbar", "Pa", 10000), (36, "hPa h-1", "Pa s-1", 1), (1000, "umol L-1", "mol L-1", 0.001)])
def test_units(spark, value, a, b, want):
    assert one(spark, units.convert(F.lit(float(value)), a, b)) == pytest.approx(want)


def test_bad_units():
    assert not units.valid("foobarmonkeyhat") and not units.valid("smbar")
    assert not units.compatible("m", "°C") and not units.compatible("m s-2", "m s")


def test_sea_water(spark):
    """Published check values of the 1983 algorithms."""
    assert one(spark, ocean.density(F.lit(35.0), F.lit(5.0), F.lit(10000.0))) == pytest.approx(1069.48914, abs=1e-4)
    assert one(spark, ocean.depth(F.lit(10000.0), F.lit(30.0))) == pytest.approx(9712.653, abs=1e-2)
    assert one(spark, ocean.freezing_point(F.lit(40.0), F.lit(500.0))) == pytest.approx(-2.588567, abs=1e-5)
    assert one(spark, ocean.freezing_point(F.lit(3.0), F.lit(0.0))) is None


def test_geo(spark):
    assert one(spark, geo.haversine(F.lit(0.0), F.lit(179.0), F.lit(0.0), F.lit(-179.0))) == pytest.approx(222389.85, abs=1)
    square = [(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0)]
    assert one(spark, geo.in_polygon(F.lit(5.0), F.lit(5.0), square)) and not one(spark, geo.in_polygon(F.lit(5.0), F.lit(15.0), square))


def test_tolerance_and_speed_limits(spark):
    assert one(spark, uncertainty.at_least(F.lit(2.0 - 1e-12), F.lit(2.0)))
    assert one(spark, units.speed_limit(F.lit("36 km h-1"))) == pytest.approx(10) and one(spark, units.speed_limit(F.lit("fast"))) == 40


def test_rounding_is_that_of_the_sql(spark):
    """lat of event 5337 is -17.955, which scales to a little less than 1795.5; a small negative value keeps its sign."""
    values = [-18 + 45.0 / 1000, 2.675, 1.005, 0.125, -0.125, -0.001, 0.0, 1e300, 1e308, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.x for r in df.select(F.format_string("%.5f", units.rounded(F.col("v"), 2)).alias("x")).collect()][:7]
    want = [duckdb.execute("SELECT printf('%.5f', round(?::DOUBLE, 2))", [v]).fetchone()[0] for v in values][:7]
    assert got == want and got[0] == "-17.95000"
    got = [r.x for r in df.select(units.rounded(F.col("v"), 2).alias("x")).collect()]
    want = [duckdb.execute("SELECT round(?::DOUBLE, 2)", [v]).fetchone()[0] for v in values]
    assert list(map(repr, got)) == list(map(repr, want))


def test_service_is_inclusive(spark):
    t = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, text.in_service(t("2016-12-31 23:59:59"), t("2016-01-01"), t("2016-12-31 23:59:59")))
    assert not one(spark, text.in_service(t("2017-01-01"), t("2016-01-01"), t("2016-12-31 23:59:59")))


@pytest.mark.parametrize("series, codes", [((10, 15, 10), ["spike"]), ((10, 15, 20), []), ((10, 12, 10), ["spike"]), ((0, 30, 30), ["gradient"]), ((0, 12, 0), ["spike"]), ((10, None, 10), [])])
def test_spikes(spark, series, codes):
    df = spark.createDataFrame([("a", i, None if v is None else float(v)) for i, v in enumerate(series)], "k string, i int, v double")
    assert [r.code for r in profiles.spikes(df, ["k"], ["i"], "v", 2, 10).collect()] == codes


def test_records(spark, tmp_path):
    levels = ",".join(f'{{"_coordinates":{{"C3":{{"_value":{d},"_metadata":{{"Units":"m","Uncertainty":5}}}}}}}}' for d in (10, 20, 30, 40, 50))
    (tmp_path / "a.json").write_text(f'[{{"_metadata":{{"M1":"abc","M6":null,"M9":[1,2]}},"_coordinates":{{"C1":{{"_value":1.5,"_metadata":{{"Units":"degree"}}}}}},"_subrecords":{{"PROFILE":{{"0":{{"_records":[{levels}]}}}}}}}}]')
    (tmp_path / "b.json").write_text('{"_parameters":{"P1":{"_values":[1,{"_value":2}]}}}\nnot json\n')
    read = records.read_json(spark, str(tmp_path))
    assert read.where("malformed is not null").count() == 1
    found = records.elements(read.where("body is not null").withColumn("record_id", F.monotonically_increasing_id()))
    assert [r.value_num for r in found.where("name = 'C3'").orderBy("level_idx").collect()] == [10, 20, 30, 40, 50]
    assert found.where("name = 'P1'").count() == 2 and found.where("name = 'M9'").count() == 2
    wide = records.levels(found, ["C3", "C1"]).collect()
    assert len(wide) == 5 and all(r.C1 == 1.5 for r in wide)


def test_ideal(spark):
    def pick(*pairs):
        rows = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(q).alias("quality")) for v, q in pairs])
        return one(spark, rollups.ideal(rows))

    assert pick((1, 3), (2, 1), (3, 5)) == 2 and pick((1, 9), (2, 3), (3, 2)) == 3 and pick((1, 0), (2, 4)) == 2


def test_near_pairs(spark):
    df = spark.createDataFrame([(i, "k", s) for i, s in enumerate((0, 899, 1800, 1801, 5000))], "id int, k string, s int").withColumn("t", F.timestamp_seconds("s"))
    assert {tuple(r) for r in joins.near_pairs(df, "k", "id", "t", 900).collect()} == {(0, 1), (2, 3)}


def test_loading_twice_changes_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"k":1}\n{"k":1}\n{"k":2}\n')
    for turn in range(2):
        ingest.load_new(ingest.stream(spark, str(tmp_path / "in"), "k long"), str(tmp_path / "out"), str(tmp_path / f"c{turn}"), ["k"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_ledger(spark):
    rows = [("a", "LOCKED", "2020-01-01 00:00:00", None), ("b", "DELAYED_RELEASE", "2020-01-01 00:00:00", "2020-01-01 02:00:00"), ("c", "LOCKED", "2020-01-01 00:30:00", None), ("c", "UNLOCKED", "2020-01-01 00:00:00", None)]
    events = spark.createDataFrame(rows, "item string, status string, at string, release string").withColumns({"at": F.to_timestamp("at"), "release": F.to_timestamp("release")})
    got = {r.item: r.status for r in ingest.ledger_state(events, now="2020-01-01 01:10:00").collect()}
    assert got == {"a": "UNLOCKED", "b": "DELAYED_RELEASE", "c": "LOCKED"}
