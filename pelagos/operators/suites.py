"""Quality suites over the long format of elements, run in order; each sees the flags that those before it wrote (2.8, F16).

A suite gives findings: the place of an element, a code, and a flag (null: for review only). All windows and groups are
keyed by record, so one exchange by record_id serves the suites of a run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import session
from ..functions import geo, ocean, units
from ..functions.uncertainty import at_least
from ..sources import records
from . import filters, joins, profiles

PLACE = ("record_id", "set_type", "set_idx", "level_idx", "scope", "name", "value_idx")
SERIES = ["record_id", "set_type", "set_idx"]
LEVEL = [*SERIES, "level_idx"]
OUTSIDE, WRONG, MISSING, UNKNOWN, BAD_UNITS = 13, 14, 19, 20, 21


@dataclass(frozen=True)
class Suite:
    name: str
    find: Callable[[DataFrame], DataFrame]
    version: str = "1.0"
    tags: tuple[str, ...] = ()
    #: The order of records that the suite needs, if any.
    order: str | None = None


#: Suites by name, as registered.
REGISTRY: dict[str, Suite] = {}


def suite(name: str, version: str = "1.0", tags: tuple[str, ...] = (), order: str | None = None) -> Callable[[Callable[[DataFrame], DataFrame]], Suite]:
    """Registers a function from elements to findings as a suite; a name is taken once."""

    def add(find: Callable[[DataFrame], DataFrame]) -> Suite:
        if name in REGISTRY:
            raise ValueError(f"there is a suite {name}")
        REGISTRY[name] = Suite(name, find, version, tags, order)
        return REGISTRY[name]

    return add


def agreed_order(suites: list[Suite]) -> str | None:
    """The one order that suites of a run need; two that differ are an error."""
    wanted = sorted({s.order for s in suites if s.order})
    if len(wanted) > 1:
        raise ValueError(f"suites want different orders: {', '.join(wanted)}")
    return wanted[0] if wanted else None


def tested(elements: DataFrame, dubious: bool = False) -> DataFrame:
    """Values that are there and not flagged yet (or, if allowed, dubious)."""
    return elements.where(filters.eligible(F.col("value_txt"), F.col("working_quality"), dubious))


def _found(df: DataFrame, code: Column | str, flag: int | None, scope: str | None = None, name: str | None = None) -> DataFrame:
    code = F.lit(code) if isinstance(code, str) else code
    fixed = {k: F.lit(v) for k, v in (("scope", scope), ("name", name)) if v}
    if name:
        fixed["value_idx"] = F.lit(0)
    return df.select(*[fixed.get(c, F.col(c)).alias(c) for c in PLACE], code.alias("code"), F.lit(flag).cast("int").alias("flag"))


def in_units(elements: DataFrame, preferred: dict[str, str], spoken: tuple[str, ...]) -> DataFrame:
    """elements with value_num in the preferred unit of its name, from any of the units ``spoken``; others stay as they are."""
    value = F.col("value_num")
    for name, target in preferred.items():
        for source in spoken:
            if source != target and units.compatible(source, target):
                value = F.when((F.col("name") == name) & (F.col("units") == source), units.convert(F.col("value_num"), source, target)).otherwise(value)
    return elements.withColumn("value_num", value)


def _top(elements: DataFrame, name: str) -> Column:
    mine = (F.col("name") == name) & F.col("level_idx").isNull() & (F.col("value_idx") == 0)
    return F.max(F.when(mine, F.col("value_num"))).over(Window.partitionBy("record_id"))


def required(names: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    """Records without a coordinate: {name: code}."""

    def find(elements: DataFrame) -> DataFrame:
        here = elements.where("level_idx is null and scope = 'coordinates'")
        held = elements.groupBy("record_id").agg(F.lit(1).alias("_")).drop("_").join(
            here.where(filters.has_value(F.col("value_txt"))).groupBy("record_id").agg(F.collect_set("name").alias("names")), "record_id", "left")
        missing = [held.where(~F.coalesce(F.array_contains("names", n), F.lit(False))).select("record_id", F.lit(None).cast("string").alias("set_type"), F.lit(None).cast("int").alias("set_idx"), F.lit(None).cast("int").alias("level_idx"), F.lit("coordinates").alias("scope"), F.lit(n).alias("name"), F.lit(0).alias("value_idx"), F.lit(c).alias("code"), F.lit(MISSING).alias("flag")) for n, c in names.items()]
        return reduce(DataFrame.unionByName, missing)

    return find


def vocabulary(terms: DataFrame, spoken: tuple[str, ...] = (), strict: bool = False) -> Callable[[DataFrame], DataFrame]:
    """Elements against ``terms`` (name, groups, many, unit, data_type, low, high, allowed): unknown names (if strict),
    groups, repeated values, units, types, ranges, allowed values. The first rule that a value breaks is reported."""

    def find(elements: DataFrame) -> DataFrame:
        df = elements.join(terms, "name", "left").withColumn("n_values", F.count(F.lit(1)).over(Window.partitionBy(*LEVEL, "scope", "name")))
        pairs = [f"{a}|{b}" for a in spoken for b in spoken if units.compatible(a, b)]
        known = F.col("units").isin([u for u in spoken if units.valid(u)])
        agree = F.concat_ws("|", "units", "unit").isin(pairs) | (F.col("units") == F.col("unit"))
        kind, v = F.col("data_type"), F.col("value_txt")
        wrong = (
            F.when(kind.isin("dateTimeStamp", "date") & ~filters.is_iso_datetime(v), "ontology_invalid_datetime")
            .when((kind == "integer") & ~filters.is_integer(v), "ontology_invalid_integer").when((kind == "decimal") & ~filters.is_numeric(v), "ontology_invalid_decimal")
        )
        rule = F.when(F.col("groups").isNull(), F.lit("ontology_undefined_element") if strict else F.lit(None).cast("string"))
        rule = rule.when(F.size("groups").cast("int") > 0, F.when(~F.exists("groups", lambda g: F.col("scope").startswith(g) | g.startswith(F.col("scope"))), "ontology_invalid_group"))
        value = F.when((F.col("n_values") > 1) & ~F.coalesce("many", F.lit(True)), "ontology_multi_not_allowed").when(F.col("units").isNotNull() & ~known, "units_invalid_unit_string")
        value = value.when(F.col("units").isNotNull() & F.col("unit").isNotNull() & ~agree, "ontology_invalid_units").when(wrong.isNotNull(), wrong)
        value = value.when(F.col("value_num") < F.col("low"), "ontology_lower_than_range").when(F.col("value_num") > F.col("high"), "ontology_greater_than_range")
        value = value.when((F.size("allowed") > 0) & ~F.array_contains("allowed", v), "ontology_value_not_allowed")
        code = F.coalesce(rule, F.when(F.col("groups").isNotNull() & filters.has_value(v), value))
        units_wrong = F.col("code").isin("units_invalid_unit_string", "ontology_invalid_units")
        out = _found(df.withColumn("_code", code).where("_code is not null"), F.col("_code"), UNKNOWN)
        return out.withColumn("flag", F.when(units_wrong, BAD_UNITS).when(F.col("code").endswith("range") | (F.col("code") == "ontology_value_not_allowed"), WRONG).otherwise(F.col("flag")))

    return find


def ranges(rules: list[tuple[str, float | None, float | None, list[tuple[float, float]] | None]]) -> Callable[[DataFrame], DataFrame]:
    """(name, low, high, ring): a ring of (lat, lon) makes a regional rule, which the later the rule overrides others."""

    def find(elements: DataFrame) -> DataFrame:
        df = elements.withColumns({"_lat": _top(elements, "Latitude"), "_lon": _top(elements, "Longitude")})
        ordered = [r for r in rules if r[3] is None] + [r for r in rules if r[3] is not None]
        broken = F.lit(None).cast("boolean")
        for name, low, high, ring in ordered:
            where = F.col("name") == name
            if ring:
                where = where & geo.in_polygon(F.col("_lat"), F.col("_lon"), ring)
            below = F.lit(False) if low is None else ~at_least(F.col("value_num"), F.lit(float(low)))
            above = F.lit(False) if high is None else ~at_least(F.lit(float(high)), F.col("value_num"))
            broken = F.when(F.coalesce(where, F.lit(False)), below | above).otherwise(broken)
        return _found(tested(df).where("_lat is not null and _lon is not null").where(broken), "outside_parameter_ranges", OUTSIDE)

    return find


def _levels(elements: DataFrame, *names: str) -> DataFrame:
    return records.levels(tested(elements, True), list(names))


def _pressure() -> Column:
    """Pressure, else from depth and latitude."""
    return F.coalesce("Pressure", ocean.pressure(F.col("Depth"), F.coalesce("Latitude", F.lit(45.0))))


def envelopes(bands: list[tuple[str, float, float, float, float]]) -> Callable[[DataFrame], DataFrame]:
    """(name, above this depth, down to and with this one, low, high)."""

    def find(elements: DataFrame) -> DataFrame:
        df, out = _levels(elements, "Depth", *dict.fromkeys(b[0] for b in bands)), []
        for name in dict.fromkeys(b[0] for b in bands):
            bad = F.lit(False)
            for _, top, bottom, low, high in reversed([b for b in bands if b[0] == name]):
                bad = F.when((F.col("Depth") > top) & (F.col("Depth") <= bottom), ~F.col(name).between(low, high)).otherwise(bad)
            out.append(_found(df.where(bad), "outside_envelope", OUTSIDE, "parameters", name))
        return reduce(DataFrame.unionByName, out)

    return find


def increasing(name: str = "Depth") -> Callable[[DataFrame], DataFrame]:
    return lambda e: _found(profiles.decreasing(_levels(e, name), SERIES, ["level_idx"], name), "not_increasing", OUTSIDE, "coordinates", name)


def freezing(elements: DataFrame) -> DataFrame:
    """Water below its freezing point, tested where it is salt and not above zero."""
    t, s = F.col("Temperature"), F.col("PracticalSalinity")
    df = _levels(elements, "Temperature", "PracticalSalinity", "Pressure", "Depth", "Latitude")
    return _found(df.where(s.between(26, 35) & (t <= 0) & (t < ocean.freezing_point(s, _pressure()))), "below_freezing", OUTSIDE, "parameters", "Temperature")


def density_inversions(elements: DataFrame) -> DataFrame:
    df = _levels(elements, "Temperature", "PracticalSalinity", "Pressure", "Depth", "Latitude")
    df = df.withColumn("density", ocean.density(F.col("PracticalSalinity"), F.col("Temperature") * ocean.T68_PER_T90, _pressure()))
    return _found(profiles.decreasing(df, SERIES, ["level_idx"], "density"), "density_inversion", OUTSIDE, "parameters", "Temperature")


def spikes(limits: dict[str, tuple[float, float, float, float]]) -> Callable[[DataFrame], DataFrame]:
    """{name: (spike, gradient, most at the ends down, up)}."""

    def find(elements: DataFrame) -> DataFrame:
        df, out = _levels(elements, *limits), []
        for name, (spike, gradient, down, up) in limits.items():
            out.append(_found(profiles.spikes(df, SERIES, ["level_idx"], name, spike, gradient), F.col("code"), OUTSIDE, "parameters", name))
            for top in (True, False):
                out.append(_found(profiles.end_spikes(df, SERIES, ["level_idx"], name, down, up, top), "top_spike" if top else "bottom_spike", OUTSIDE, "parameters", name))
        return reduce(DataFrame.unionByName, out)

    return find


def spikes_of_several(limits: dict[str, tuple[float, float]]) -> Callable[[DataFrame], DataFrame]:
    """{name: (spike, gradient)} over all values of an element: only what no choice among them explains is flagged."""

    def find(elements: DataFrame) -> DataFrame:
        out = []
        for name, (spike, gradient) in limits.items():
            own = tested(elements, True).where((F.col("name") == name) & F.col("level_idx").isNotNull() & F.col("value_num").isNotNull())
            held = own.groupBy(*LEVEL).agg(F.transform(F.sort_array(F.collect_list(F.struct("value_idx", "value_num"))), lambda x: x["value_num"]).alias("values"))
            out.append(_found(profiles.spikes_of_several(held, SERIES, ["level_idx"], "values", spike, gradient), F.col("code"), OUTSIDE, "parameters", name))
        return reduce(DataFrame.unionByName, out)

    return find


def _record(df: DataFrame, code: Column | str, flag: int | None = None) -> DataFrame:
    """Findings on whole records."""
    code = F.lit(code) if isinstance(code, str) else code
    kinds = {"record_id": F.col("record_id"), "set_idx": F.lit(None).cast("int"), "level_idx": F.lit(None).cast("int"), "value_idx": F.lit(0)}
    return df.select(*[kinds.get(c, F.lit(None).cast("string")).alias(c) for c in PLACE], code.alias("code"), F.lit(flag).cast("int").alias("flag"))


def _tops(elements: DataFrame, *names: str) -> DataFrame:
    """(record_id, one column of text a name): the first values of whole records."""
    own = elements.where(F.col("level_idx").isNull() & (F.col("value_idx") == 0))
    return own.groupBy("record_id").agg(*[F.first(F.when(F.col("name") == n, F.col("value_txt")), ignorenulls=True).alias(n) for n in names])


def station(platforms: DataFrame, identifiers: list[str], uuid: str = "PlatformUUID", needed: tuple[str, ...] = ()) -> Callable[[DataFrame], DataFrame]:
    """Which platform a record is of. platforms: (platform_uuid, name, value), an identifier a row. A record that names a
    platform must name a known one; else its identifiers must lead to one platform, and not to none or several, which are
    reported as incomplete where one of the ``needed`` identifiers is missing."""

    def find(elements: DataFrame) -> DataFrame:
        own = _tops(elements, uuid, *identifiers)
        known = platforms.select(F.col("platform_uuid").alias(uuid)).distinct().withColumn("_known", F.lit(True))
        named = own.where(F.col(uuid).isNotNull()).join(known, uuid, "left").where("_known is null")
        rest = own.where(F.col(uuid).isNull())
        pairs = rest.select("record_id", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in identifiers])).alias("i")).select("record_id", "i.*").where("value is not null")
        hits = pairs.join(platforms, ["name", "value"]).groupBy("record_id").agg(F.count_distinct("platform_uuid").alias("n"))
        judged = rest.join(hits, "record_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        without = reduce(lambda a, b: a & b, [F.col(n).isNull() for n in identifiers])
        incomplete = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in needed], F.lit(False))
        code = F.when(without, "station_no_id").when((F.col("n") == 0) & incomplete, "station_incomplete").when(F.col("n") == 0, "station_no_record").when(F.col("n") > 1, "station_many_records")
        return _record(named, "station_bad_uuid").unionByName(_record(judged.withColumn("_code", code).where("_code is not null"), F.col("_code")))

    return find


def top_speed(platform: str = "PlatformUUID", most: float = 40.0, own: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """Records reached from their platform's fix before at more than ``most`` metres a second, or its own limit (own:
    platform, top_speed; null: not tested)."""

    def find(elements: DataFrame) -> DataFrame:
        fixes = _tops(elements, platform, "Time", "Latitude", "Longitude").select("record_id", F.col(platform).alias("platform"), F.try_to_timestamp("Time").alias("time"), F.col("Latitude").try_cast("double").alias("lat"), F.col("Longitude").try_cast("double").alias("lon"))
        fixes = fixes.where("platform is not null and time is not null and lat is not null and lon is not null")
        limit = F.lit(float(most))
        if own is not None:
            fixes = fixes.join(own.withColumn("_own", F.lit(True)), "platform", "left")
            limit = F.when(F.col("_own"), F.col("top_speed")).otherwise(limit)
        return _record(profiles.speeds(fixes, ["platform"], ["time", "record_id"], "time", "lat", "lon").where(F.col("speed") > limit), "speed_too_fast", OUTSIDE)

    return find


def mandatory_review(platforms: DataFrame, platform: str = "PlatformUUID") -> Callable[[DataFrame], DataFrame]:
    """Records of the platforms that are always reviewed. platforms: (platform_uuid)."""
    return lambda e: _record(_tops(e, platform).join(platforms.select(F.col("platform_uuid").alias(platform)).distinct(), platform, "left_semi"), "manual_review_required")


def duplicates(compared: Callable[[DataFrame, DataFrame], DataFrame], platform: str = "PlatformUUID", seconds: int = 900, metres: float = 5000.0) -> Callable[[DataFrame], DataFrame]:
    """The later of two records of one platform that lie near each other in time and space and match. ``compared`` takes
    pairs (pair_id, a, b) and elements and gives (pair_id, verdict)."""

    def find(elements: DataFrame) -> DataFrame:
        fixes = _tops(elements, platform, "Time", "Latitude", "Longitude").withColumns({"time": F.try_to_timestamp("Time"), "lat": F.col("Latitude").try_cast("double"), "lon": F.col("Longitude").try_cast("double")})
        near = joins.near_pairs(fixes.where(F.col(platform).isNotNull()), platform, "record_id", "time", seconds, "lat", "lon", metres)
        pairs = near.select(F.concat_ws("|", "a", "b").alias("pair_id"), "a", "b")
        judged = pairs.join(compared(pairs, elements), "pair_id").where("verdict != 'NO_MATCH'")
        sure = F.col("verdict").isin("IDENTICAL", "A_IS_SUPERSET", "B_IS_SUPERSET")
        code = F.when(F.bool_or(sure), "working_duplicate_record_found").otherwise("working_potential_duplicate_record_found")
        return _record(judged.groupBy(F.col("b").alias("record_id")).agg(code.alias("code")), F.col("code"))

    return find


def inversions(elements: DataFrame) -> DataFrame:
    """Temperatures from the first inversion down."""
    df = _levels(elements, "Temperature", "Depth")
    first = profiles.inversions(df, SERIES, ["level_idx"], "Depth", "Temperature").groupBy(*SERIES).agg(F.min("level_idx").alias("_from"))
    return _found(df.join(first, SERIES).where("level_idx >= _from and Temperature is not null"), "temperature_inversion", OUTSIDE, "parameters", "Temperature")


def constant(name: str) -> Callable[[DataFrame], DataFrame]:
    def find(elements: DataFrame) -> DataFrame:
        df = _levels(elements, name)
        return _found(df.join(profiles.constant(df, SERIES, name).select(*SERIES), SERIES).where(F.col(name).isNotNull()), "constant_profile", None, "parameters", name)

    return find


def bathymetry(cells: DataFrame, per_degree: int, share: float = 0.1) -> Callable[[DataFrame], DataFrame]:
    """Positions on land, soundings unlike the model, depths below the bottom. ``cells``: cell_lat, cell_lon, height
    (metres, negative in the sea). An equi-join by cell: no size of the grid is assumed."""

    def find(elements: DataFrame) -> DataFrame:
        top = elements.where("level_idx is null and value_idx = 0").groupBy("record_id").agg(*[F.first(F.when(F.col("name") == n, F.col("value_num")), ignorenulls=True).alias(n) for n in ("Latitude", "Longitude")])
        at = top.withColumns({"cell_lat": geo.cell(F.col("Latitude"), per_degree), "cell_lon": geo.cell(F.col("Longitude"), per_degree)})
        model = at.join(cells, ["cell_lat", "cell_lon"]).select("record_id", (-F.col("height")).alias("_sea"))
        df = tested(elements, True).join(model, "record_id")
        land = df.where((F.col("name") == "Latitude") & F.col("level_idx").isNull() & (F.col("_sea") <= 0))
        sounding = df.where((F.col("name") == "SeaDepth") & (F.col("_sea") > 0) & (F.abs(F.col("value_num") - F.col("_sea")) > 2 * share * F.col("_sea")))
        deep = df.where((F.col("name") == "Depth") & (F.col("_sea") > 0) & (F.col("value_num") - F.col("_sea") > 2 * share * F.col("_sea")))
        return _found(land, "position_above_sea_level", WRONG).unionByName(_found(sounding, "sounding_bathymetry_mismatch", WRONG)).unionByName(_found(deep, "depth_too_deep", WRONG))

    return find


def reset(elements: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """elements with working_quality taken from quality for the records in ``keep``, else cleared: what a run starts with."""
    if keep is None:
        return elements.withColumn("working_quality", F.lit(None).cast("int"))
    marked = elements.join(keep.select("record_id").distinct().withColumn("_keep", F.lit(True)), "record_id", "left")
    return marked.withColumn("working_quality", F.when(F.col("_keep") & (F.col("quality") > 0), F.col("quality"))).drop("_keep")


def _written(elements: DataFrame, findings: DataFrame) -> DataFrame:
    """elements with the findings' flags; of several at one place the highest."""
    flags = findings.where("flag is not null").groupBy(*PLACE).agg(F.max("flag").alias("_flag"))
    right = flags.select(*[F.col(c).alias(f"_{c}") for c in PLACE], "_flag")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE])
    return elements.join(right, same, "left").withColumn("working_quality", F.coalesce("_flag", "working_quality")).select(*elements.columns)


def run(elements: DataFrame, suites: list[Suite], done: DataFrame | None = None, cut: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(elements with flags, findings, results): suites in order, each over the flags of those before it.

    ``done`` (record_id, test_name, is_stale) are results that stand: their records are skipped by that suite. ``cut``
    writes a table between suites, to keep plans short; without it tables are written where there are more than two. A result is F with findings, else P.
    """
    found, results = [], []
    cut = cut or (session.cut if len(suites) > 2 else lambda df: df)
    for suite in suites:
        todo = elements
        if done is not None:
            todo = elements.join(done.where((F.col("test_name") == suite.name) & ~F.col("is_stale")).select("record_id"), "record_id", "left_anti")
        mine = cut(suite.find(todo).withColumns({"test_name": F.lit(suite.name), "version": F.lit(suite.version)}))
        failed = mine.select("record_id").distinct().withColumn("result", F.lit("F"))
        results.append(todo.select("record_id").distinct().join(failed, "record_id", "left").select("record_id", F.lit(suite.name).alias("test_name"), F.lit(suite.version).alias("version"), F.coalesce("result", F.lit("P")).alias("result")))
        found.append(mine)
        elements = cut(_written(elements, mine))
    return elements, reduce(DataFrame.unionByName, found), reduce(DataFrame.unionByName, results)
