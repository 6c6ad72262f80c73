"""More registered queries: the store, the queue, suites on whole records, functions on values and texts, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cron, geo, ocean, text, uncertainty, units
from ..functions.uncertainty import measured
from ..operators import changes, compare, filters, profiles, queue, rollups, store, suites
from ..sources import mapped, records
from .catalogue import _FIXES, _LINES, _elements, _fixes, _lines, _t, query

_NOW = "timestamp'2024-01-20 00:00:00'"


def _items(spark, d) -> DataFrame:
    """Orders as a queue: the customer's country is the queue, the customer the unique name."""
    status = F.when(F.col("o_orderstatus") == "O", "UNLOCKED").when(F.col("o_orderkey") % 5 == 0, "LOCKED").when(F.col("o_orderstatus") == "F", "COMPLETE").otherwise("ERROR")
    return _t(spark, d, "orders").select(
        F.col("o_orderkey").alias("item"), (F.col("o_custkey") % 7).cast("string").alias("queue"), F.lit(None).cast("string").alias("subqueue"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey").cast("string")).alias("unique_name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), F.col("o_orderdate").cast("timestamp").alias("created"), status.alias("status"), F.lit(None).cast("string").alias("locked_by"),
        F.col("o_orderdate").cast("timestamp").alias("since"), F.lit(None).cast("timestamp").alias("release"), (F.col("o_orderkey") % 2).cast("int").alias("level"),
    )


_ITEMS = """(SELECT o_orderkey AS item, CAST(o_custkey % 7 AS VARCHAR) AS queue, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS unique_name, CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority, o_orderdate AS created,
  CASE WHEN o_orderstatus = 'O' THEN 'UNLOCKED' WHEN o_orderkey % 5 = 0 THEN 'LOCKED' WHEN o_orderstatus = 'F' THEN 'COMPLETE' ELSE 'ERROR' END AS status, o_orderdate AS since, o_orderkey % 2 AS level FROM orders)"""


@query(f"""WITH i AS {_ITEMS}, f AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY priority DESC, created, item) AS place FROM i WHERE status = 'UNLOCKED' AND level <= 0
  AND NOT EXISTS (SELECT 1 FROM i h WHERE h.status = 'LOCKED' AND h.unique_name = i.unique_name AND h.queue = i.queue))
  SELECT i.item, i.queue, CASE WHEN f.item IS NULL THEN i.status ELSE 'LOCKED' END AS status, CASE WHEN f.item IS NOT NULL THEN 'w1' END AS locked_by FROM i LEFT JOIN f ON f.item = i.item AND f.place = 1""")
def dequeue_lock(spark, d):
    return queue.dequeued(_items(spark, d), F.expr(_NOW), "w1")[0].select("item", "queue", "status", "locked_by")


@query(f"""WITH i AS {_ITEMS}, n AS (SELECT c_custkey AS item, CAST(c_custkey % 7 AS VARCHAR) AS queue, CAST(c_custkey AS VARCHAR) AS unique_name FROM customer)
  SELECT item, status, priority FROM i UNION ALL SELECT -1 - item, 'UNLOCKED', 0 FROM n WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.queue = n.queue AND i.unique_name = n.unique_name AND status NOT IN ('COMPLETE', 'ERROR'))""")
def enqueue(spark, d):
    new = _t(spark, d, "customer").select((-1 - F.col("c_custkey")).alias("item"), (F.col("c_custkey") % 7).cast("string").alias("queue"), F.col("c_custkey").cast("string").alias("unique_name"))
    return queue.enqueued(_items(spark, d), new, F.expr(_NOW)).select("item", "status", "priority")


@query(f"""WITH i AS {_ITEMS}, e AS (SELECT event_id % 1500 AS item, CASE event_type WHEN 'click' THEN 'lock' WHEN 'view' THEN 'complete' WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'escalate' ELSE 'release' END AS kind, ts FROM events),
  l AS (SELECT item, max_by(kind, (ts, kind)) AS kind, sum(CASE kind WHEN 'escalate' THEN 1 ELSE 0 END) AS steps FROM e GROUP BY 1)
  SELECT i.item, CASE WHEN kind IS NULL OR (status IN ('COMPLETE', 'ERROR') AND kind <> 'release') THEN status ELSE CASE kind WHEN 'lock' THEN 'LOCKED' WHEN 'complete' THEN 'COMPLETE' WHEN 'fail' THEN 'ERROR' ELSE 'UNLOCKED' END END AS status,
    CAST(CASE WHEN kind IS NULL OR (status IN ('COMPLETE', 'ERROR') AND kind <> 'release') THEN level ELSE level + steps END AS INT) AS level FROM i LEFT JOIN l USING (item)""")
def queue_fold(spark, d):
    kind = F.create_map(*[F.lit(x) for x in ("click", "lock", "view", "complete", "error", "fail", "purchase", "escalate")])
    events = _t(spark, d, "events").select((F.col("event_id") % 1500).alias("item"), F.coalesce(F.try_element_at(kind, F.col("event_type")), F.lit("release")).alias("kind"), F.col("ts").cast("timestamp").alias("at"))
    return queue.folded(_items(spark, d), events).select("item", "status", "level")


@query(f"SELECT item FROM {_ITEMS} WHERE status NOT IN ('COMPLETE', 'ERROR') OR since > TIMESTAMP '1998-01-01' - INTERVAL 30 DAY")
def queue_retention(spark, d):
    return queue.retained(_items(spark, d), F.expr("timestamp'1998-01-01 00:00:00'")).select("item")


@query(f"SELECT queue, status, count(*) AS n, row_number() OVER (PARTITION BY queue ORDER BY count(*) DESC, status) AS place FROM {_ITEMS} GROUP BY 1, 2")
def queue_listing(spark, d):
    return queue.listing(_items(spark, d)).select("queue", "status", "n", F.col("place").cast("long").alias("place"))


@query("SELECT o_orderkey AS item, o_orderstatus AS step, CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'P' THEN 'F' END AS next FROM orders")
def step_progression(spark, d):
    steps = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit("w").alias("workflow"), F.lit(s).alias("step"), F.lit(n).alias("order")) for s, n in (("F", 30), ("O", 10), ("P", 20))])))
    done = _t(spark, d, "orders").select(F.col("o_orderkey").alias("item"), F.lit("w").alias("workflow"), F.col("o_orderstatus").alias("step"))
    return queue.next_step(done, steps).select("item", "step", "next")


@query("SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'ABANDON' WHEN event_type = 'error' OR user_id % 4 = 1 THEN 'RETRY' ELSE 'FAIL' END AS outcome FROM events")
def retry_classes(spark, d):
    code = F.try_element_at(F.array(*[F.lit(c) for c in ("08006", "40001", "22P02", "23505")]), (F.col("user_id") % 4 + 1).cast("int"))
    return _t(spark, d, "events").select("event_id", queue.on_error(code, F.col("event_type") == "error").alias("outcome"))


@query("SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY user_id, ts, event_id) AS place FROM events")
def review_order(spark, d):
    return queue.reviewed_in_order(_t(spark, d, "events").withColumn("batch", F.col("event_type")), "user_id", "ts", "event_id").select("event_id", F.col("place").cast("long").alias("place"))


@query(f"SELECT item FROM {_ITEMS} WHERE status = 'LOCKED' AND since <= TIMESTAMP '1996-01-01'")
def locked_since(spark, d):
    return store.in_state(_items(spark, d), "LOCKED", "1996-01-01 00:00:00").select("item")


@query("SELECT o_orderkey, o_totalprice, n FROM orders JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1) USING (o_orderkey)")
def obs_payload(spark, d):
    data = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return store.with_payload(_t(spark, d, "orders").select("o_orderkey", "o_totalprice"), data, ["o_orderkey"])


@query("SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def source_children(spark, d):
    sources = _t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return store.of_source(_t(spark, d, "lineitem"), sources, ["l_orderkey"]).select("l_orderkey", "l_partkey", "l_suppkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_custkey = (SELECT min(o_custkey) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')")
def provenance_lookup(spark, d):
    orders = _t(spark, d, "orders")
    first = orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").agg(F.min("o_custkey")).first()[0]
    return store.looked_up(orders, o_orderstatus="F", o_orderpriority="1-URGENT", o_custkey=first).select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, CASE WHEN c_custkey < 0 THEN 'SUPPLIER' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer UNION ALL SELECT -1 - s_suppkey, 'SUPPLIER', CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE 0 END FROM supplier")
def insert_defaults(spark, d):
    table = _t(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_mktsegment", "c_acctbal")
    rows = _t(spark, d, "supplier").select((-1 - F.col("s_suppkey")).cast("long").alias("c_custkey"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("c_acctbal"))
    return store.inserted(table, rows, {"c_mktsegment": "SUPPLIER", "c_acctbal": 0.0})


@query("""WITH o AS (SELECT l_partkey AS k, l_quantity > 5 AS ok FROM lineitem), g AS (SELECT k, count(*) FILTER (ok) AS n, count(*) FILTER (NOT ok) AS bad, k IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AS held FROM o GROUP BY 1)
  SELECT CAST(sum(CASE WHEN NOT held AND n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS created, CAST(sum(n - CASE WHEN NOT held AND n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS skipped, CAST(sum(bad) AS BIGINT) AS errors FROM g""")
def load_counters(spark, d):
    lines = _t(spark, d, "lineitem")
    held = lines.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("k"))
    return store.load_counts(lines.select(F.col("l_partkey").alias("k"), "l_quantity"), held, ["k"], F.col("l_quantity") > 5)


@query("SELECT user_id, list_sort(list(event_type || ':' || last)) AS tests FROM (SELECT user_id, event_type, max_by(CAST(event_id % 3 AS VARCHAR), (ts, event_id % 3)) AS last FROM events WHERE event_id % 4 <> 0 GROUP BY 1, 2) GROUP BY 1")
def tests_by_record(spark, d):
    version = (F.col("event_id") % 3).cast("string")
    runs = _t(spark, d, "events").select("user_id", F.col("event_type").alias("test_name"), version.alias("version"), version.alias("result"), F.col("ts").alias("test_date"), (F.col("event_id") % 4 == 0).alias("is_stale"))
    held = store.test_summary(runs, "user_id")
    return held.select("user_id", F.array_sort(F.transform(F.map_entries("tests"), lambda e: F.concat(e["key"], F.lit(":"), e["value"]["result"]))).alias("tests"))


@query("SELECT doc_id, coalesce(toxic, quality, 0) AS quality FROM documents LEFT JOIN (SELECT doc_id, min(quality) AS quality, min(CASE WHEN toxic = 1 THEN 4 END) AS toxic FROM labels GROUP BY 1) USING (doc_id)")
def flag_promotion(spark, d):
    flags = _t(spark, d, "labels").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.min(F.when(F.col("toxic") == 1, 4)).alias("working_quality"))
    return store.promoted(_t(spark, d, "documents").select("doc_id").join(flags, "doc_id", "left")).select("doc_id", F.coalesce("quality", F.lit(0)).alias("quality"))


@query(f"SELECT event_id AS record_id, CASE WHEN event_id % 3 = 0 THEN 'UNKNOWN' ELSE event_type END AS level, CASE WHEN event_id % 11 <> 0 THEN printf('POINT (%.5f %.5f)', lon, round(lat, 2)) END AS location FROM ({_FIXES})")
def derived_facts(spark, d):
    fixes = _fixes(spark, d).select(F.col("event_id").alias("record_id"), F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("level"), F.col("ts").alias("time"), units.rounded(F.col("lat"), 2).alias("latitude"), F.when(F.col("event_id") % 11 != 0, F.col("lon")).alias("longitude"), F.col("user_id").alias("platform_id"))
    return store.facts(fixes).select("record_id", "level", "location")


@query("SELECT o_orderkey, 'done' AS origin FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderstatus <> 'F' AND o_custkey % 2 = 0")
def finalize_batch(spark, d):
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 2).alias("batch"))
    obs = orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("done").alias("origin"))
    batch = spark.range(1).select(F.lit(0).cast("long").alias("batch"), F.lit("IN_REVIEW").alias("status"))
    return store.finalized(orders.withColumn("origin", F.lit("new")), batch, obs, "batch", ["o_orderkey"])[0]


@query("""WITH m AS (SELECT user_id, event_type AS name, event_id AS record_id, CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR) AS value FROM events), w AS (SELECT user_id, name, min_by(value, record_id) AS whole FROM m GROUP BY 1, 2)
  SELECT user_id, name, record_id, value FROM m JOIN w USING (user_id, name) WHERE value <> CASE WHEN name = 'click' AND user_id % 2 = 0 THEN '1' ELSE whole END""")
def metadata_factoring(spark, d):
    events = _t(spark, d, "events")
    held = events.select("user_id", F.col("event_type").alias("name"), F.col("event_id").alias("record_id"), F.floor(F.col("value") / 10).cast("long").cast("string").alias("value"))
    known = events.where("user_id % 2 = 0").select("user_id", F.lit("click").alias("name"), F.lit("1").alias("value")).distinct()
    return store.factored(held, known, "user_id")[0].select("user_id", "name", "record_id", "value")


@query("SELECT l_orderkey, CAST(CASE WHEN count(*) = max(k) + 1 THEN count(*) ELSE min(CASE WHEN k <> place THEN place END) END AS INT) AS free FROM (SELECT l_orderkey, k, row_number() OVER (PARTITION BY l_orderkey ORDER BY k) - 1 AS place FROM (SELECT DISTINCT l_orderkey, CAST(l_quantity % 4 AS INT) AS k FROM lineitem)) GROUP BY 1")
def first_free_index(spark, d):
    used = _t(spark, d, "lineitem").select("l_orderkey", (F.col("l_quantity") % 4).cast("int").alias("k"))
    return store.next_free(used, ["l_orderkey"], "k").select("l_orderkey", F.col("free").cast("int").alias("free"))


@query(f"SELECT l_orderkey AS record_id, level AS level_idx, 'Flag' AS name, CASE WHEN l_orderkey % 5 = 0 THEN 'set' ELSE l_returnflag END AS value_txt FROM {_LINES} UNION ALL SELECT l_orderkey, level, 'Tax', CAST(l_tax AS VARCHAR) FROM {_LINES}")
def path_set(spark, d):
    found = _elements(_lines(spark, d), "l_orderkey", "level", [("parameters", "Flag", "l_returnflag"), ("parameters", "Tax", "l_tax")])
    new = found.where("name = 'Flag' AND record_id % 5 = 0").withColumn("value_txt", F.lit("set"))
    return store.path_set(found, new, ["record_id", "level_idx", "name"]).select("record_id", "level_idx", "name", "value_txt")


@query(f"SELECT l_orderkey AS record_id, level AS level_idx, 0 AS value_idx, l_returnflag AS value_txt FROM {_LINES} UNION ALL SELECT l_orderkey, level, 1, 'more' FROM {_LINES} WHERE l_orderkey % 5 = 0")
def path_append(spark, d):
    found = _elements(_lines(spark, d), "l_orderkey", "level", [("parameters", "Flag", "l_returnflag")])
    new = found.where("record_id % 5 = 0").withColumn("value_txt", F.lit("more"))
    return store.path_append(found, new, ["record_id", "level_idx", "name"]).select("record_id", "level_idx", "value_idx", "value_txt")


@query("SELECT p_partkey, p_name FROM part")
def null_columns_dropped(spark, d):
    return store.filled_columns(_t(spark, d, "part").select("p_partkey", F.lit(None).cast("string").alias("gone"), "p_name"))


@query("SELECT user_id, min(value) AS low, max(value) AS high, md5(string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY ts, event_id)) AS digest FROM events GROUP BY 1")
def series_ranges(spark, d):
    made = profiles.series(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value")
    return made.select("user_id", "low", "high", F.md5(F.array_join(F.transform("values", lambda v: F.round(v * 100).cast("long").cast("string")), ",")).alias("digest"))


@query("SELECT user_id, CASE WHEN sum(s) > 0 THEN 'I' WHEN sum(s) < 0 THEN 'D' END AS direction FROM (SELECT user_id, sign(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS s FROM events) GROUP BY 1")
def series_direction(spark, d):
    return profiles.direction(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value")


_SEVERAL = f"WITH v AS (SELECT l_orderkey, level, l_quantity AS a, CASE WHEN level % 2 = 0 THEN l_quantity * 2 ELSE l_quantity END AS a2 FROM {_LINES}), x AS (SELECT *, lag(a) OVER w AS p, lead(a) OVER w AS n, lag(a2) OVER w AS p2, lead(a2) OVER w AS n2 FROM v WINDOW w AS (PARTITION BY l_orderkey ORDER BY level))"
_CHOICES = [(p, b, n) for p in ("p", "p2") for b in ("a", "a2") for n in ("n", "n2")]
_ALL = lambda least, minus: " AND ".join(f"(abs({b} - ({p} + {n}) / 2){f' - abs({p} - {n}) / 2' if minus else ''}) >= {least}" for p, b, n in _CHOICES)


@query(f"{_SEVERAL} SELECT l_orderkey AS record_id, level AS level_idx, CASE WHEN {_ALL(8, True)} THEN 'spike' ELSE 'gradient' END AS code FROM x WHERE p IS NOT NULL AND n IS NOT NULL AND (({_ALL(8, True)}) OR ({_ALL(12, False)}))")
def spike_multi_value(spark, d):
    lines = _lines(spark, d)
    found = _elements(lines, "l_orderkey", "level", [("parameters", "Load", "l_quantity")])
    more = found.where("level_idx % 2 = 0").withColumns({"value_idx": F.lit(1), "value_num": F.col("value_num") * 2})
    run = suites.run(found.unionByName(more), [suites.Suite("spikes", suites.spikes_of_several({"Load": (8, 12)}))])
    return run[1].select("record_id", "level_idx", "code")


def _fix_elements(spark, d, identifiers: bool = False) -> DataFrame:
    """Events as whole records of a platform with time, place and identifiers."""
    fixes = _fixes(spark, d)
    held = [("metadata", "PlatformUUID", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("u"), "user_id"))), ("metadata", "WMOID", F.when(F.col("event_id") % 4 != 0, F.col("user_id").cast("string"))), ("metadata", "Call", F.when(F.col("event_id") % 8 != 0, F.col("event_type")))] if identifiers else [("metadata", "PlatformUUID", F.concat(F.lit("u"), "user_id"))]
    held += [("coordinates", "Time", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")), ("coordinates", "Latitude", F.col("lat").cast("string")), ("coordinates", "Longitude", F.col("lon").cast("string")), ("parameters", "Value", F.col("value").cast("string"))]
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), F.lit(n).alias("name"), v.alias("v")) for s, n, v in held])).alias("e")
    null = lambda t: F.lit(None).cast(t)
    return fixes.select(F.col("event_id").alias("record_id"), each).where("e.v is not null").select("record_id", null("string").alias("set_type"), null("int").alias("set_idx"), null("int").alias("level_idx"), "e.scope", "e.name", F.lit(0).alias("value_idx"), F.col("e.v").try_cast("double").alias("value_num"), F.col("e.v").alias("value_txt"), null("string").alias("units"), null("int").alias("quality"), null("int").alias("working_quality"), null("double").alias("uncertainty"))


@query("""WITH i AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS u, CASE WHEN event_id % 4 <> 0 THEN user_id END AS w, CASE WHEN event_id % 8 <> 0 THEN event_type END AS c FROM events),
  n AS (SELECT *, (SELECT count(DISTINCT p.k) FROM (SELECT c_custkey AS k, c_custkey AS w, NULL AS c FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 7, NULL, 'click') p WHERE p.w = i.w OR p.c = i.c) AS n FROM i)
  SELECT event_id AS record_id, CASE WHEN u IS NOT NULL THEN 'station_bad_uuid' WHEN w IS NULL AND c IS NULL THEN 'station_no_id' WHEN n = 0 AND w IS NULL THEN 'station_incomplete' WHEN n = 0 THEN 'station_no_record' ELSE 'station_many_records' END AS code
  FROM n WHERE (u IS NOT NULL AND NOT (u % 2 = 0 AND u IN (SELECT c_custkey FROM customer)) AND u <> 7) OR (u IS NULL AND n <> 1)""")
def station_suite(spark, d):
    even = _t(spark, d, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("u"), "c_custkey").alias("platform_uuid"), F.lit("WMOID").alias("name"), F.col("c_custkey").cast("string").alias("value"))
    platforms = even.unionByName(spark.range(1).select(F.lit("u7").alias("platform_uuid"), F.lit("Call").alias("name"), F.lit("click").alias("value")))
    run = suites.run(_fix_elements(spark, d, True), [suites.Suite("station_check", suites.station(platforms, ["WMOID", "Call"], needed=("WMOID",)))])
    return run[1].select("record_id", "code")


@query(f"""WITH f AS (SELECT *, lag(lat) OVER w AS la, lag(lon) OVER w AS lo, lag(ts) OVER w AS t FROM ({_FIXES}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (SELECT event_id, user_id, 2 * 6371000.0 * atan2(sqrt(x), sqrt(1 - x)) / (epoch_us(ts) - epoch_us(t)) * 1e6 AS speed FROM (SELECT *, pow(sin(radians(lat - la) / 2), 2) + cos(radians(la)) * cos(radians(lat)) * pow(sin(radians(lon - lo) / 2), 2) AS x FROM f WHERE ts > t))
  SELECT event_id AS record_id, 'speed_too_fast' AS code FROM s WHERE speed > CASE WHEN user_id % 3 = 0 THEN 900 WHEN user_id % 3 = 1 THEN 1e30 ELSE 40 END""")
def speed_suite(spark, d):
    own = _t(spark, d, "events").select("user_id").distinct().where("user_id % 3 < 2").select(F.concat(F.lit("u"), "user_id").alias("platform"), F.when(F.col("user_id") % 3 == 0, F.lit(900.0)).alias("top_speed"))
    return suites.run(_fix_elements(spark, d), [suites.Suite("speed_check", suites.top_speed(own=own))])[1].select("record_id", "code")


@query("SELECT event_id AS record_id, 'manual_review_required' AS code, NULL::INT AS flag FROM events WHERE user_id % 5 = 0")
def mandatory_suite(spark, d):
    flagged = _t(spark, d, "events").where("user_id % 5 = 0").select(F.concat(F.lit("u"), "user_id").alias("platform_uuid"))
    return suites.run(_fix_elements(spark, d), [suites.Suite("mandatory_review", suites.mandatory_review(flagged))])[1].select("record_id", "code", "flag")


@query("""WITH e AS (SELECT user_id, event_id, ts, CAST(value AS VARCHAR) AS v FROM events), n AS (SELECT a.event_id AS a, b.event_id AS b FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_id < b.event_id AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 3600000000)
  SELECT DISTINCT b AS record_id, 'working_potential_duplicate_record_found' AS code FROM n""")
def dupe_suite(spark, d):
    found = _fix_elements(spark, d)
    here = F.when(F.col("name").isin("Latitude", "Longitude"), "10").otherwise(F.col("value_txt"))
    found = found.withColumns({"value_txt": here, "value_num": here.try_cast("double")})
    run = suites.run(found, [suites.Suite("duplicate_check", suites.duplicates(compare.verdicts, seconds=3600))])
    return run[1].select("record_id", "code")


@query(f"SELECT event_id, CASE WHEN user_id % 4 = 0 THEN printf('POINT (%.5f %.5f)', lon, y) WHEN user_id % 4 = 1 THEN printf('LINESTRING (%.5f %.5f, %.5f %.5f)', lon, y - 0.25, lon, y + 0.25) WHEN user_id % 4 = 2 THEN printf('LINESTRING (%.5f %.5f, %.5f %.5f)', lon - 0.5, y, lon + 0.5, y) ELSE printf('POLYGON ((%.5f %.5f, %.5f %.5f, %.5f %.5f, %.5f %.5f, %.5f %.5f))', lon - 0.5, y - 0.25, lon + 0.5, y - 0.25, lon + 0.5, y + 0.25, lon - 0.5, y + 0.25, lon - 0.5, y - 0.25) END AS place FROM (SELECT *, round(lat, 1) AS y FROM ({_FIXES}))")
def point_geometry(spark, d):
    k = F.col("user_id") % 4
    return _fixes(spark, d).select("event_id", geo.geometry(F.round("lat", 1), F.col("lon"), F.when(k.isin(1, 3), F.lit(0.25)), F.when(k.isin(2, 3), F.lit(0.5))).alias("place"))


@query("SELECT event_id, round(sin(value), 9) AS sine, round(abs(cos(value)) * 0.1, 9) AS sine_sd, round(sqrt(abs(value)), 9) AS root, round(radians(value), 9) AS angle, round(radians(0.1), 9) AS angle_sd, round(atan2(value, 2.0), 9) AS arc, round(sqrt(0.04 * 0.1 * 0.1 * 100 / 1.0) * 1.0 / (4 + value * value) * 1.0, 9) AS arc_sd FROM events")
def sigma_trigonometry(spark, d):
    a, two = measured(F.col("value"), 0.1), measured(F.lit(2.0), 0.0)
    s, r, g, t = uncertainty.sine(a), uncertainty.root(measured(F.abs("value"), 0.0)), uncertainty.radians(a), uncertainty.arctangent(a, two)
    n = lambda c: F.round(c, 9)
    return _t(spark, d, "events").select("event_id", n(s["value"]).alias("sine"), n(s["sd"]).alias("sine_sd"), n(r["value"]).alias("root"), n(g["value"]).alias("angle"), n(g["sd"]).alias("angle_sd"), n(t["value"]).alias("arc"), n(t["sd"]).alias("arc_sd"))


@query("SELECT user_id, md5(string_agg(CASE WHEN event_type <> 'error' THEN CAST(CAST(round((value + 273.15) * 100) AS BIGINT) AS VARCHAR) ELSE '-' END, ',' ORDER BY ts, event_id)) AS digest FROM events GROUP BY 1")
def values_in_units(spark, d):
    held = _t(spark, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", "value", (F.col("event_type") != "error").alias("able")))).alias("h"))
    made = units.all_in(F.col("h.value"), F.col("h.able"), "°C", "K")
    return held.select("user_id", F.md5(F.array_join(F.transform(made, lambda v: F.coalesce(F.round(v * 100).cast("long").cast("string"), F.lit("-"))), ",")).alias("digest"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE -128 END AS phase, CASE WHEN event_id % 5 = 0 THEN -9999.9 ELSE value END AS value FROM events")
def phase_codes(spark, d):
    return _t(spark, d, "events").select("event_id", units.coded(F.col("event_type"), {"click": 1, "view": 2}, -128).alias("phase"), units.filled(F.when(F.col("event_id") % 5 != 0, F.col("value"))).alias("value"))


@query("SELECT event_id, round(event_id * pow(10.0, -(user_id % 3)), 9) AS value, round(pow(10.0, -(user_id % 3)) / 2 / sqrt(3.0), 9) AS sd FROM events")
def scale_factors(spark, d):
    s = uncertainty.scaled(F.col("event_id").cast("double"), F.col("user_id") % 3)
    return _t(spark, d, "events").select("event_id", F.round(s["value"], 9).alias("value"), F.round(s["sd"], 9).alias("sd"))


@query("SELECT doc_id, md5(nfc_normalize(replace(text, chr(233), 'e' || chr(769)))) AS digest FROM documents")
def composed_text(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(text.composed(F.replace("text", F.lit("\u00e9"), F.lit("e\u0301")))).alias("digest"))


@query("SELECT page_id, replace(replace(url_encode(url), '%2F', '/'), '%7E', '~') AS encoded FROM pages")
def percent_encoded(spark, d):
    return _t(spark, d, "pages").select("page_id", text.percent(F.col("url")).alias("encoded"))


@query("SELECT o_orderkey, strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m-%d %H') AS there FROM orders")
def zoned_times(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", F.date_format(text.in_zone(F.col("o_orderdate").cast("timestamp"), "Asia/Tokyo"), "yyyy-MM-dd HH").alias("there"))


@query("SELECT n_nationkey, base64(encode(n_name)) AS held, n_name AS back FROM nation")
def json_safe_bytes(spark, d):
    held = _t(spark, d, "nation").select("n_nationkey", text.json_bytes(F.encode("n_name", "UTF-8")).alias("held"), text.from_fixed(text.to_fixed(F.col("n_name"), 30)).alias("back"))
    return held


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events")
def nan_to_null(spark, d):
    v = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return _t(spark, d, "events").select("event_id", text.no_nan(v).alias("value"))


@query("SELECT event_id, strftime(time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes', '%Y-%m-%d %H:%M') AS quarter, strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M') AS midnight FROM events")
def cron_next(spark, d):
    at = F.col("ts").cast("timestamp")
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    return _t(spark, d, "events").select("event_id", show(cron.next_run(at, "*/15 * * * *")).alias("quarter"), show(cron.next_run(at, "@daily")).alias("midnight"))


@query("SELECT o_orderkey, 1 AS n_keys, o_orderkey % 2 = 0 AS same FROM orders")
def structures(spark, d):
    held = F.create_map(F.lit("a"), F.col("o_orderkey"), F.lit("b"), F.col("o_custkey"))
    a = F.concat(F.lit('{"x": 1, "y": [1, {"p": 2, "q": 3}], "z": '), (F.col("o_orderkey") % 2).cast("string"), F.lit("}"))
    return _t(spark, d, "orders").select("o_orderkey", F.size(text.without_keys(held, "b")).alias("n_keys"), text.same_structure(a, F.lit('{"z":0,"y":[1,{"q":3,"p":2}],"x":1}')).alias("same"))


@query("SELECT o_orderkey, 1 + o_orderkey % 2 AS n_values, CASE WHEN o_orderkey % 3 = 0 THEN 'm' END AS units, CAST(o_custkey AS DOUBLE) AS first FROM orders")
def json_elements(spark, d):
    unit = F.when(F.col("o_orderkey") % 3 == 0, F.lit(', "_metadata": {"Units": "m"}')).otherwise("")
    one = F.concat(F.lit('{"_value": '), F.col("o_custkey").cast("string"), unit, F.lit("}"))
    body = F.concat(F.lit('{"_parameters": {"Depth": '), F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit("["), one, F.lit(", 5]"))).otherwise(one), F.lit("}}"))
    found = records.elements(_t(spark, d, "orders").select("o_orderkey", F.parse_json(body).alias("body")), "o_orderkey")
    own = F.col("value_idx") == 0
    return found.groupBy(F.col("record_id").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_values"), F.max(F.when(own, F.col("units"))).alias("units"), F.max(F.when(own, F.col("value_num"))).alias("first"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 9 WHEN o_orderkey % 4 = 1 THEN 3 WHEN o_orderkey % 4 = 2 THEN 1 ELSE 0 END AS worst, CASE WHEN o_orderkey % 4 = 2 THEN 'y' ELSE 'x' END AS best FROM orders")
def quality_of_several(spark, d):
    pick = lambda *values: F.try_element_at(F.array(*[F.lit(v) for v in values]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    flags = F.array(pick(2, 3, 5, 0), pick(9, 9, 1, 0))
    flags = F.when(F.col("o_orderkey") % 4 == 1, F.array(F.lit(3), F.lit(2))).otherwise(flags)
    held = F.array(F.struct(F.lit("x").alias("value"), pick(2, 3, 9, 0).alias("quality")), F.struct(F.lit("y").alias("value"), pick(9, 3, 1, 0).alias("quality")))
    return _t(spark, d, "orders").select("o_orderkey", rollups.worst_quality(flags).alias("worst"), rollups.ideal(held).alias("best"))


@query("SELECT l_orderkey AS record_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS changed FROM lineitem GROUP BY 1")
def record_hash(spark, d):
    found = _elements(_lines(spark, d), "l_orderkey", "level", [("parameters", "Flag", "l_returnflag"), ("parameters", "Tax", "l_tax")])
    other = found.withColumn("value_txt", F.when(F.col("record_id") % 2 == 1, F.concat("value_txt", F.lit("!"))).otherwise(F.col("value_txt")))
    a, b = changes.record_hashes(found), changes.record_hashes(other).withColumnRenamed("record_hash", "then")
    counts = found.where("name = 'Flag'").groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))
    return a.join(b, "record_id").join(counts, "record_id").select("record_id", "n", F.when(F.col("record_hash") != F.col("then"), F.col("n")).otherwise(0).alias("changed"))


@query(f"SELECT l_orderkey AS record_id, level AS level_idx, CASE WHEN l_orderkey % 10 = 0 THEN 'edited' ELSE l_returnflag END AS value_txt, CASE WHEN l_orderkey % 10 = 0 THEN 4 END AS working_quality FROM {_LINES}")
def reviewer_edits(spark, d):
    found = _elements(_lines(spark, d), "l_orderkey", "level", [("parameters", "Flag", "l_returnflag")])
    hashes = changes.record_hashes(found).withColumn("record_hash", F.when(F.col("record_id") % 20 != 15, F.col("record_hash")).otherwise("stale"))
    place = ["record_id", "set_type", "set_idx", "level_idx", "scope", "name", "value_idx"]
    some = found.where("record_id % 10 = 0 OR record_id % 20 = 15").select(*place).join(hashes, "record_id")
    steps = [("set_value", "first", 0), ("set_value", "edited", 1), ("set_flag", "4", 2)]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("new_value"), F.lit(i).alias("action_idx")) for k, v, i in steps])).alias("e")
    return changes.edited(found, some.select(*place, "record_hash", each).select(*place, "record_hash", "e.*"), place)[0].select("record_id", "level_idx", "value_txt", "working_quality")


@query("""SELECT doc_id, regexp_replace(lang || '/' || source || '.txt', '[^A-Za-z0-9._-]', '_', 'g') AS file_name, '[' || lang || '] ' || doc_id || ' %{c}' AS header, CASE WHEN doc_id % 2 = 0 THEN 'bonjour' ELSE 'any' END AS said,
  'T:' || lang || ' Z:' || doc_id AS shown, doc_id % 3 = 0 AS same FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL""")
def text_functions(spark, d):
    said = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("fr"), F.lit("bonjour"), F.lit("und"), F.lit("any"))).otherwise(F.create_map(F.lit("und"), F.lit("any"), F.lit("en"), F.lit("hello")))
    held = F.create_map(F.lit("a"), F.col("lang"), F.lit("b"), F.col("doc_id").cast("string"))
    none = F.lit(None).cast("double")
    return _t(spark, d, "documents").where("lang is not null and source is not null").select(
        "doc_id", text.file_name(F.concat("lang", F.lit("/"), "source", F.lit(".txt"))).alias("file_name"), text.template(F.lit("[%{a}] %{b} %{c}"), held).alias("header"), text.in_language(said, "fr").alias("said"),
        text.display(F.col("lang"), none, none, F.col("doc_id")).alias("shown"), text.same_values(F.array(F.lit(0), F.col("doc_id") % 3), F.array(F.lit(0))).alias("same"),
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS parsed, strftime(TIMESTAMP '1950-01-01' + INTERVAL 1 DAY * (o_orderkey % 1000), '%Y-%m-%d') AS since, o_custkey % 10 = 0 AS allowed FROM orders")
def time_functions(spark, d):
    shown = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
    have = F.when(F.col("o_custkey") % 10 == 0, F.array(F.lit("read"), F.lit("edit"))).otherwise(F.array(F.lit("read")))
    return _t(spark, d, "orders").select("o_orderkey", F.date_format(text.time_in(shown, ["yyyy/MM/dd", "dd.MM.yyyy"]), "yyyyMMdd").alias("parsed"), F.date_format(text.time_since((F.col("o_orderkey") % 1000).cast("double"), "days", "1950-01-01 00:00:00"), "yyyy-MM-dd").alias("since"), F.array_contains(have, "edit").alias("allowed"))


@query("SELECT event_id, abs(value - 50) <= 2 * 5 AS close, abs(value - 50) <= 1e-9 * greatest(value, 50) AS equal FROM events")
def tolerant_compare(spark, d):
    v = F.col("value")
    return _t(spark, d, "events").select("event_id", uncertainty.close(v, F.lit(50.0), F.lit(5.0)).alias("close"), uncertainty.close(v, F.lit(50.0)).alias("equal"))


@query(f"""WITH x AS (SELECT l_orderkey AS record_id, level AS level_idx, l_quantity AS v FROM {_LINES}) SELECT record_id, level_idx, 'outside_parameter_ranges' AS code FROM x WHERE v < 5 OR v > 45""")
def range_suite(spark, d):
    found = _elements(_lines(spark, d), "l_orderkey", "level", [("parameters", "Load", "l_quantity")])
    top = found.select("record_id").distinct().select("record_id", F.explode(F.array(F.lit("Latitude"), F.lit("Longitude"))).alias("name"))
    null = lambda t: F.lit(None).cast(t)
    tops = top.select("record_id", null("string").alias("set_type"), null("int").alias("set_idx"), null("int").alias("level_idx"), F.lit("coordinates").alias("scope"), "name", F.lit(0).alias("value_idx"), F.lit(1.0).alias("value_num"), F.lit("1").alias("value_txt"), null("string").alias("units"), null("int").alias("quality"), null("int").alias("working_quality"), null("double").alias("uncertainty"))
    return suites.run(found.unionByName(tops), [suites.Suite("range_check", suites.ranges([("Load", 5, 45, None)]))])[1].select("record_id", "level_idx", "code")


@query(f"WITH x AS (SELECT l_orderkey AS record_id, level AS level_idx, l_quantity - 25 AS t, 30 AS s, l_extendedprice / 1000 AS p FROM {_LINES}) SELECT record_id, level_idx, 'below_freezing' AS code FROM x WHERE t <= 0 AND t < -0.0575 * s + 1.710523e-3 * pow(s, 1.5) - 2.154996e-4 * s * s - 7.53e-4 * p")
def freezing_suite(spark, d):
    lines = _lines(spark, d).withColumns({"t": F.col("l_quantity") - 25, "s": F.lit(30), "p": F.col("l_extendedprice") / 1000})
    found = _elements(lines, "l_orderkey", "level", [("parameters", "Temperature", "t"), ("parameters", "PracticalSalinity", "s"), ("coordinates", "Pressure", "p")])
    return suites.run(found, [suites.Suite("freezing_point_check", suites.freezing)])[1].select("record_id", "level_idx", "code")


@query("SELECT o_orderkey, least(128.0, 0.25 * pow(2, o_orderkey % 12)) AS seconds FROM orders")
def poll_waits(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", queue.wait(F.col("o_orderkey") % 12).alias("seconds"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'NEW' END AS c_mktsegment, CASE WHEN c_custkey % 2 = 1 OR c_custkey % 10 = 4 THEN 'now' ELSE 'then' END AS modified FROM customer")
def modified_dates(spark, d):
    table = _t(spark, d, "customer").select("c_custkey", "c_mktsegment", F.lit("then").alias("modified"))
    after = table.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("NEW"))
    return changes.touched(table.where("c_custkey % 10 != 4"), after, ["c_custkey"], F.lit("now"))


@query(f"""SELECT l_orderkey AS record_id, level AS level_idx, 'Load' AS name, CASE WHEN level % 2 = 0 THEN l_tax ELSE l_quantity END AS value_num, CAST(l_linestatus = 'F' AS INT) AS quality, 'kg' AS units FROM {_LINES}
  UNION ALL SELECT DISTINCT l_orderkey, NULL::INT, 'Title', NULL, NULL, NULL FROM lineitem""")
def columnar_mapping(spark, d):
    table = _lines(spark, d).select("l_orderkey", "level", F.when(F.col("level") % 2 == 1, F.col("l_quantity")).alias("LOAD_ADJUSTED"), F.col("l_tax").alias("LOAD"), F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("LOAD_QC"))
    rules = [{"name": "Load", "scope": "parameters", "source": "var:LOAD_ADJUSTED|var:LOAD", "quality": "var:LOAD_QC", "units": "attribute:LOAD.units"}, {"name": "Title", "scope": "metadata", "source": "globalvar:title"}]
    return mapped.elements(table, "l_orderkey", "level", rules, {"LOAD.units": "kg", "title": "lines"}).select("record_id", "level_idx", "name", "value_num", "quality", "units")


@query("SELECT event_id, 'SENSOR_' || CASE WHEN event_type IN ('click', 'view') THEN 'CTD' ELSE 'OTHER' END || '_' || user_id AS sensor FROM events")
def sensor_keys(spark, d):
    named = F.when(F.col("event_type").isin("click", "view"), F.lit("TEMP")).otherwise(F.col("event_type"))
    held = _t(spark, d, "events").select(F.concat_ws("|", named, "event_id").alias("variable"), F.col("user_id").cast("string").alias("sensor_name"))
    return mapped.sensors(held).select(F.substring_index("variable", "|", -1).cast("long").alias("event_id"), "sensor")


@query(f"SELECT l_orderkey AS record_id, count(*) + 1 AS n_lines, md5(string_agg('PROFILE/0/' || level || ' Flag=' || l_returnflag || CASE WHEN l_linestatus = 'F' THEN ' [4]' ELSE '' END, chr(10) ORDER BY level)) AS digest FROM {_LINES} GROUP BY 1")
def record_lines(spark, d):
    found = _elements(_lines(spark, d), "l_orderkey", "level", [("parameters", "Flag", "l_returnflag"), ("parameters", "State", "l_linestatus")])
    flags = found.where("name = 'State' AND value_txt = 'F'").select("record_id", "level_idx", F.lit(4).alias("flag"))
    held = found.where("name = 'Flag'").join(flags, ["record_id", "level_idx"], "left").withColumn("working_quality", F.col("flag")).select(*found.columns)
    top = held.where("level_idx = 1").withColumns({"level_idx": F.lit(None).cast("int"), "set_type": F.lit(None).cast("string"), "set_idx": F.lit(None).cast("int"), "name": F.lit("Title"), "scope": F.lit("metadata")})
    lines = mapped.shown(held.unionByName(top)).groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("h"))
    return lines.select("record_id", F.size("h").cast("long").alias("n_lines"), F.md5(F.array_join(F.slice(F.col("h.line"), 2, 100_000), "\n")).alias("digest"))
