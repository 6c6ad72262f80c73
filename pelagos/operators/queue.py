"""The work queue as tables: entries, locks, a status machine over events, retention, steps (O2, O5-O7, R-1 to R-5, R-7 to R-9, M7).

items: item, queue, subqueue, unique_name, priority, created, status, locked_by, since, release, level. A single writer
replaces the table; there are no row locks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import changes

ENDED = ("COMPLETE", "ERROR")
#: What an event makes of an item's status; escalations change the level and unlock.
AFTER = {"lock": "LOCKED", "renew": "LOCKED", "release": "UNLOCKED", "delay": "DELAYED_RELEASE", "complete": "COMPLETE", "fail": "ERROR", "escalate": "UNLOCKED", "descalate": "UNLOCKED"}


def enqueued(items: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """items and new ones, unlocked, at priority 0 and level 0 unless they say otherwise. A name that an open item has in the
    same queue is not entered again."""
    default = {"priority": 0, "level": 0}
    rows = new.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in new.columns else F.lit(v) for k, v in default.items()} | {"status": F.lit("UNLOCKED"), "created": now, "since": now})
    held = items.where(~F.col("status").isin(*ENDED) & F.col("unique_name").isNotNull()).select("queue", "unique_name").distinct()
    named = rows.where("unique_name is not null").dropDuplicates(["queue", "unique_name"]).join(held, ["queue", "unique_name"], "left_anti")
    return items.unionByName(named.unionByName(rows.where("unique_name is null")), allowMissingColumns=True).select(*items.columns)


def dequeued(items: DataFrame, now: Column, worker: str, subqueue: str | None = None, max_level: int = 0) -> tuple[DataFrame, DataFrame]:
    """(items with the locks written, what was taken): of each queue the free item of the highest priority, the oldest first;
    an item whose name another locked one of its queue has waits."""
    free = items.where((F.col("status") == "UNLOCKED") & (F.col("level") <= max_level))
    if subqueue is not None:
        free = free.where(F.col("subqueue") == subqueue)
    held = items.where((F.col("status") == "LOCKED") & F.col("unique_name").isNotNull()).select("queue", "unique_name").distinct()
    able = free.join(held, ["queue", "unique_name"], "left_anti")
    first = F.row_number().over(Window.partitionBy("queue").orderBy(F.desc("priority"), "created", "item"))
    taken = able.withColumn("_place", first).where("_place = 1").drop("_place").withColumns({"status": F.lit("LOCKED"), "locked_by": F.lit(worker), "since": now}).select(*items.columns)
    return changes.updated(items, taken.select("item", "status", "locked_by", "since"), ["item"]), taken


def folded(items: DataFrame, events: DataFrame) -> DataFrame:
    """items after events (item, kind, at): the last of each decides the status, each escalation counts in the level. After
    an item has ended only a release opens it again."""
    step = F.when(F.col("kind") == "escalate", 1).when(F.col("kind") == "descalate", -1).otherwise(0)
    last = events.where(F.col("kind").isin(*AFTER)).groupBy("item").agg(F.max_by("kind", F.struct("at", "kind")).alias("_kind"), F.max("at").alias("_at"), F.sum(step).alias("_steps"))
    after = F.create_map(*[F.lit(x) for pair in AFTER.items() for x in pair])
    open_ = ~F.col("status").isin(*ENDED) | (F.col("_kind") == "release")
    use = F.col("_kind").isNotNull() & open_
    return items.join(last, "item", "left").withColumns({
        "level": F.when(use, F.greatest(F.lit(0), F.col("level") + F.col("_steps"))).otherwise(F.col("level")).cast(items.schema["level"].dataType),
        "since": F.when(use, F.col("_at")).otherwise(F.col("since")), "status": F.when(use, after[F.col("_kind")]).otherwise(F.col("status")),
    }).select(*items.columns)


def retained(items: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """items without those that have ended so many days ago or more."""
    return items.where(~F.col("status").isin(*ENDED) | (F.col("since") > now - F.expr(f"INTERVAL {days} DAYS")))


def next_step(done: DataFrame, steps: DataFrame) -> DataFrame:
    """(item, workflow, step, next): the step after an item's in its workflow's order; null where it ends."""
    order = Window.partitionBy("workflow").orderBy("order", "step")
    after = steps.withColumn("next", F.lead("step").over(order)).select("workflow", "step", "next")
    return done.join(after, ["workflow", "step"], "left").select("item", "workflow", "step", "next")


def on_error(code: Column, transient: Column) -> Column:
    """What becomes of an item that failed: tried again, given up because the store is gone, or an error."""
    return F.when(code.startswith("08"), "ABANDON").when(transient | code.isin("40001", "40P01"), "RETRY").otherwise("FAIL")


def wait(attempt: Column, first: float = 0.25, most: float = 128.0) -> Column:
    """Seconds until a queue that was empty so many times in a row is asked again: doubled each time, up to the most."""
    return F.least(F.lit(most), F.lit(first) * F.pow(F.lit(2.0), F.least(attempt, F.lit(60))))


def listing(items: DataFrame) -> DataFrame:
    """(queue, status, n, oldest, place): statuses of each queue, the largest first."""
    counts = items.groupBy("queue", "status").agg(F.count(F.lit(1)).alias("n"), F.min("since").alias("oldest"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("queue").orderBy(F.desc("n"), "status")))


def reviewed_in_order(df: DataFrame, platform: str, time: str, key: str) -> DataFrame:
    """df with the place at which a reviewer gets each row of its batch: by platform, then time, nulls last."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy("batch").orderBy(F.asc_nulls_last(platform), F.asc_nulls_last(time), key)))
