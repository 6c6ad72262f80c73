import pytest

from pelagos.operators import suites
from test_changes import ELEMENTS, element


def profile(record, lat=45.0, lon=-40.0, **series):
    out = [element(record, "Latitude", lat, "coordinates"), element(record, "Longitude", lon, "coordinates"), element(record, "Time", "2020-01-01T00:00:00Z", "coordinates")]
    for name, values in series.items():
        scope = "coordinates" if name == "Depth" else "parameters"
        out += [element(record, name, v, scope, ("PROFILE", 0, i)) for i, v in enumerate(values) if v is not None]
    return out


def found(spark, suite, rows):
    return sorted(((r.record_id, r.level_idx, r["name"], r.code, r.flag) for r in suite(spark.createDataFrame(rows, ELEMENTS)).collect()), key=lambda g: (g[0], -1 if g[1] is None else g[1], g[2], g[3]))


def test_required(spark):
    rows = profile("a") + [element("b", "Latitude", 1.0, "coordinates"), element("b", "Time", None, "coordinates")]
    got = found(spark, suites.required({"Latitude": "lat_missing", "Time": "time_missing"}), rows)
    assert got == [("b", None, "Time", "time_missing", 19)]


def test_ranges_and_regions(spark):
    ring = [(0.0, -10.0), (0.0, 10.0), (10.0, 10.0), (10.0, -10.0)]
    rules = [("Temperature", -2, 30, None), ("Temperature", 10, 40, ring)]
    rows = profile("a", Temperature=[-3.0, 5.0, 35.0]) + profile("b", 5.0, 0.0, Temperature=[5.0, 35.0]) + [element("c", "Temperature", 99.0)]
    got = found(spark, suites.ranges(rules), rows)
    assert [(r, i) for r, i, *_ in got] == [("a", 0), ("a", 2), ("b", 0)] and {g[3:] for g in got} == {("outside_parameter_ranges", 13)}


@pytest.mark.parametrize("suite, series, want", [
    (suites.increasing(), {"Depth": [1.0, 3.0, 2.0, None, 4.0]}, [(2, "Depth", "not_increasing")]),
    (suites.envelopes([("Temperature", 0, 50, 0, 20), ("Temperature", 50, 100, 0, 10)]), {"Depth": [10.0, 50.0, 51.0], "Temperature": [21.0, 15.0, 15.0]}, [(0, "Temperature", "outside_envelope"), (2, "Temperature", "outside_envelope")]),
    (suites.freezing, {"Depth": [1.0, 2.0], "Temperature": [-2.5, -1.0], "PracticalSalinity": [35.0, 35.0]}, [(0, "Temperature", "below_freezing")]),
    (suites.density_inversions, {"Depth": [1.0, 2.0, 3.0], "Temperature": [5.0, 15.0, 4.0], "PracticalSalinity": [35.0, 35.0, 35.0]}, [(1, "Temperature", "density_inversion")]),
    (suites.spikes({"Temperature": (2, 10, -10, 10)}), {"Temperature": [20.0, 5.0, 9.0, 5.0, 5.0]}, [(0, "Temperature", "top_spike"), (1, "Temperature", "spike"), (2, "Temperature", "spike")]),
    (suites.constant("Temperature"), {"Temperature": [5.0, 5.0]}, [(0, "Temperature", "constant_profile"), (1, "Temperature", "constant_profile")]),
    (suites.inversions, {"Depth": [80.0, 90.0, 100.0, 110.0, 120.0], "Temperature": [9.0, 8.0, 9.0, 8.0, 8.0]}, [(2, "Temperature", "temperature_inversion"), (3, "Temperature", "temperature_inversion"), (4, "Temperature", "temperature_inversion")]),
])
def test_profiles(spark, suite, series, want):
    assert [g[1:4] for g in found(spark, suite, profile("a", **series))] == want


def test_vocabulary(spark):
    terms = spark.createDataFrame([("T", ["parameters"], False, "K", "decimal", 0.0, 400.0, None), ("M", ["metadata"], True, None, "integer", None, None, ["1", "2"])], "name string, groups array<string>, many boolean, unit string, data_type string, low double, high double, allowed array<string>")
    rows = [element("a", "T", 500.0), element("b", "T", "x"), element("c", "M", 3, "metadata"), element("d", "M", 1), element("e", "Z", 1), element("f", "T", 1.0), element("f", "T", 2.0, idx=1), element("g", "T", None), element("h", "M", 2, "metadata")]
    rows += [(*element("i", "T", 1.0)[:9], "m", None, None, None), (*element("j", "T", 1.0)[:9], "°C", None, None, None), (*element("k", "T", 1.0)[:9], "zzz", None, None, None)]
    want = [("a", "ontology_greater_than_range", 14), ("b", "ontology_invalid_decimal", 20), ("c", "ontology_value_not_allowed", 14), ("d", "ontology_invalid_group", 20), ("f", "ontology_multi_not_allowed", 20), ("f", "ontology_multi_not_allowed", 20), ("i", "ontology_invalid_units", 21), ("k", "units_invalid_unit_string", 21)]
    got = found(spark, suites.vocabulary(terms, ("K", "°C", "m")), rows)
    assert [(g[0], *g[3:]) for g in got] == want
    assert ("e", None, "Z", "ontology_undefined_element", 20) in found(spark, suites.vocabulary(terms, ("K",), True), rows)


def test_bathymetry(spark):
    cells = spark.createDataFrame([(45, -40, -100.0), (5, 0, 20.0)], "cell_lat long, cell_lon long, height double")
    rows = profile("a", 45.5, -39.5, Depth=[50.0, 119.0, 121.0]) + [element("a", "SeaDepth", 130.0)] + profile("b", 5.5, 0.5) + profile("c", 80.0, 0.0)
    assert found(spark, suites.bathymetry(cells, 1), rows) == [("a", None, "SeaDepth", "sounding_bathymetry_mismatch", 14), ("a", 2, "Depth", "depth_too_deep", 14), ("b", None, "Latitude", "position_above_sea_level", 14)]


def test_run_sees_flags_and_skips_what_is_done(spark):
    rows = profile("a", Depth=[1.0, 2.0, 3.0], Temperature=[5.0, 50.0, 5.0]) + profile("b", Temperature=[50.0])
    elements = suites.reset(spark.createDataFrame(rows, ELEMENTS))
    order = [suites.Suite("range", suites.ranges([("Temperature", -2, 40, None)])), suites.Suite("spike", suites.spikes({"Temperature": (2, 10, -90, 90)}))]
    after, findings, results = suites.run(elements, order)
    assert [(r.record_id, r.code) for r in findings.orderBy("record_id").collect()] == [("a", "outside_parameter_ranges"), ("b", "outside_parameter_ranges")]
    assert {(r.record_id, r.test_name): r.result for r in results.collect()} == {("a", "range"): "F", ("b", "range"): "F", ("a", "spike"): "P", ("b", "spike"): "P"}
    assert after.count() == len(rows) and after.where("working_quality = 13").count() == 2
    assert [r.code for r in suites.run(elements, order[::-1])[1].where("record_id = 'a'").orderBy("code").collect()] == ["spike"]
    done = spark.createDataFrame([("a", "range", False), ("b", "range", True)], "record_id string, test_name string, is_stale boolean")
    assert {r.record_id for r in suites.run(elements, order[:1], done)[1].collect()} == {"b"}


def test_units_are_made_one(spark):
    rows = [(*element("a", "T", 300.15)[:9], "K", None, None, None), (*element("a", "T", 1.0, idx=1)[:9], "°C", None, None, None)]
    got = suites.in_units(spark.createDataFrame(rows, ELEMENTS), {"T": "°C"}, ("K", "°C")).orderBy("value_idx").collect()
    assert [round(r.value_num, 6) for r in got] == [27.0, 1.0]
