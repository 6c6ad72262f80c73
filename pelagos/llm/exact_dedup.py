"""Exact duplicates by deterministic block naming.

A text is cut into fixed-size blocks. Distinct blocks are sorted and get integer names, equal names exactly for
equal blocks; then adjacent pairs of names are named in turn until each text has one name. Two texts are equal if
and only if they have the same number of blocks and the same last name: nothing rests on a hash being free of
collisions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables, save

#: Characters in a block.
BLOCK = 4096
#: Runs of these count as one space.
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _blocks(text: Column, block: int) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(found)


def _named(distinct: DataFrame, *keys: str) -> DataFrame:
    """Sorted within its partitions, each distinct row gets the integer of its place."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def block_digest(block: Column) -> Column:
    return F.xxhash64(block)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, digest: Callable[[Column], Column] = block_digest) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Null texts count as empty; empty texts equal each other. Of equal texts the row with the smallest id stays; rows
    without an id come after all others; of rows that repeat an id, one stays. Other columns of docs are not read.

    The blocks' text is shuffled once, combined before it: a block that many documents hold leaves a task once. The
    documents find their blocks' names by a 64-bit digest of the block, which is a key and no identity: should two
    distinct blocks share one (``digest`` is a parameter), the blocks themselves are joined instead. Rounds: the logarithm of the longest text's
    blocks; a text that has its name takes no part in later ones.
    """
    with Tables() as t:
        rows, judged = _grouped(docs, id_col, text_col, block, digest, t)
    return rows.join(judged, "row").select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id_col): the rows that exact_groups does not keep, written; none of the job's other tables stays."""
    with Tables() as t:
        rows, judged = _grouped(docs, id_col, text_col, block, block_digest, t, t.save)
        return save(rows.join(judged.where("not kept"), "row").select(F.col("id").alias(id_col)))


def _grouped(docs: DataFrame, id_col: str, text_col: str, block: int, digest: Callable[[Column], Column], t: Tables, last: Callable[[DataFrame], DataFrame] = save) -> tuple[DataFrame, DataFrame]:
    """(rows, judged): (row, id, sha, ...) and (row, keep_id, group_size, kept), written by ``last``."""
    text = normalised(F.col(text_col))
    rows = last(
        docs.select(F.col(id_col).alias("id"), text.alias("t"))
        .select("id", F.sha2(F.col("t").cast("binary"), 256).alias("sha"), F.transform(_blocks(F.col("t"), block), lambda b: digest(b)).alias("digests"))
        .select("id", "sha", "digests", F.monotonically_increasing_id().alias("row"))
    )
    whole = docs.select(F.explode(_blocks(text, block)).alias("block")).select(digest(F.col("block")).alias("digest"), "block")
    names = t.save(_named(whole.distinct(), "block").select("digest", "name"))
    places = rows.select("row", F.size("digests").alias("n"), F.posexplode("digests").alias("pos", "digest"))
    if names.groupBy("digest").count().where("count > 1").limit(1).count():
        full = t.save(_named(whole.distinct(), "block").drop("digest"))
        spelt = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
            "id", F.sha2(F.col("t").cast("binary"), 256).alias("sha"), _blocks(F.col("t"), block).alias("b")
        )
        rows = last(spelt.select("id", "sha", "b", F.monotonically_increasing_id().alias("row")))
        places = rows.select("row", F.size("b").alias("n"), F.posexplode("b").alias("pos", "block"))
        level = t.save(places.join(full, "block").select("row", "n", "pos", "name"))
    else:
        level = t.save(places.join(names, "digest").select("row", "n", "pos", "name"))
    t.drop(names)
    level = level.withColumn("left", F.col("n"))
    done = [level.where("left = 1").select("row", "n", "name")]
    longest = level.agg(F.max("n")).first()[0] or 1
    while longest > 1:
        pairs = t.save(
            level.where("left > 1")
            .groupBy("row", "n", (F.col("pos").bitwiseAND(F.lit(-2)) / 2).cast("int").alias("pos"), F.ceil(F.col("left") / 2).cast("int").alias("left"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
            )
        )
        found = t.save(_named(pairs.select("a", "b").distinct(), "a", "b"))
        level = t.save(pairs.join(found, ["a", "b"]).select("row", "n", "pos", "name", "left"))
        t.drop(pairs, found)
        done.append(level.where("left = 1").select("row", "n", "name"))
        longest = -(-longest // 2)
    named = done[0]
    for more in done[1:]:
        named = named.union(more)
    named = t.save(named.join(rows.select("row", "id"), "row"))
    first = F.min(F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("id"), F.col("row").alias("row"))).alias("first")
    groups = t.save(named.groupBy("n", "name").agg(first, F.count(F.lit(1)).alias("group_size")))
    judged = last(
        named.join(groups, ["n", "name"]).select(
            named.row, F.col("first.id").alias("keep_id"), "group_size", (named.row == F.col("first.row")).alias("kept")
        )
    )
    return rows, judged


ORACLE_SQL = r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""
