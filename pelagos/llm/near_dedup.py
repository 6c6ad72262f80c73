"""Near-duplicates by the shingles they share: SimHash fingerprints through BK-trees and MinHash bands find candidates,
exact Jaccard similarity decides.

Documents whose fingerprints lie within RADIUS bits, directly or through others, are candidates of each other. At the
similarity asked for, fingerprints differ in 10 of 64 bits on average and a radius to reach all pairs would be 18, where a
BK-tree follows almost every edge (random fingerprints differ in 32 bits, 4 being the deviation) and shards by agreeing
parts shrink to three bits: work that grows with the square. So bands find the pairs that lie farther apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, arrow, keyed, save, texts
from .graph import components
from .simhash import _LOWER, SEED, _edges, links, majority

SHINGLE, SIMILAR = 5, 0.8
#: Bits that fingerprints of candidates differ in at most, and parts that these are cut into to be dealt.
RADIUS, PARTS = 4, 6
#: A pair of similarity s shares no band with a probability of (1 - s ** ROWS) ** BANDS: 3 in a million at 0.8.
BANDS, ROWS = 32, 5
#: Members of a bucket that one task compares; fuller buckets are dealt to several tasks.
TILE = 2000
#: Bits of the map that tells which texts travel: 4 MB at most.
SIEVE = 1 << 24
_draw = np.random.default_rng(SEED)
_FACTORS, _SHIFTS = _draw.integers(0, 1 << 32, (2, BANDS * ROWS, 1), np.uint32)
_FACTORS |= np.uint32(1)
_MIX = _draw.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = _draw.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def grams(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; a text of fewer words is one shingle."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest = xxhash.xxh64_intdigest
    w = np.fromiter([digest(x, SEED) for x in words], np.uint64, len(words))
    n = len(w) - shingle + 1
    h = np.zeros(n, np.uint64)
    for k in range(shingle):
        h += (w[k : k + n] ^ w[k : k + n] >> np.uint64(31)) * _POWERS[k]
    h ^= h >> np.uint64(29)
    h *= _POWERS[-1]
    return np.unique(h ^ h >> np.uint64(32))


def bands(found: np.ndarray) -> np.ndarray:
    """BANDS numbers as signed longs, each from ROWS minima over all shingles."""
    low = found.astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        np.minimum(least, (low[at : at + 2048] * _FACTORS + _SHIFTS).min(axis=1), out=least)
    mixed = (least.reshape(BANDS, ROWS).astype(np.uint64) * _MIX).sum(axis=1, dtype=np.uint64) * _MIX[:, 0]
    return (mixed ^ mixed >> np.uint64(30)).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays without repeats."""
    both = np.concatenate((a, b))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def bucket_links(members: list[tuple[int, np.ndarray]], similar: float = SIMILAR) -> list[tuple[int, int]]:
    """Links that connect what the similar pairs of (row, shingles) connect.

    By size, a member is compared with those of each group until one is similar. Members too short for all that follow are left.
    """
    groups: list[list[tuple[int, np.ndarray]]] = []
    out = []
    for row, found in sorted(members, key=lambda m: (len(m[1]), m[0])):
        joined, others = [(row, found)], []
        for group in groups:
            if len(group[0][1]) < similar * len(found):
                group = [m for m in group if len(m[1]) >= similar * len(found)]
            hit = next((m[0] for m in reversed(group) if similarity(m[1], found) >= similar), None)
            if hit is not None:
                out.append((hit, row))
                joined += group
            elif group:
                others.append(group)
        joined.sort(key=lambda m: len(m[1]))
        groups = [*others, joined]
    return out


def _signed(rows: DataFrame, shingle: int) -> DataFrame:
    """(row, id, same, bands, fp): ``same`` is equal where all shingles are; a band's number also tells the band; ``fp`` is the
    SimHash fingerprint of the distinct shingles as a signed long."""
    kinds = {n: rows.schema[n].dataType.simpleString() for n in ("row", "id")}

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            made = [grams(t, shingle) for t in texts(batch)]
            same = pa.array([blake2b(g.tobytes(), digest_size=16).digest() for g in made], pa.binary())
            dealt = pa.ListArray.from_arrays(
                np.arange(0, BANDS * len(made) + 1, BANDS, dtype=np.int32), pa.array(np.concatenate([bands(g) for g in made]) if made else np.zeros(0, np.int64))
            )
            fp = pa.array(np.array([majority(g) for g in made], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), same, dealt, fp], names=["row", "id", "same", "bands", "fp"])

    return rows.select("row", "id", "text").mapInArrow(run, f"row {kinds['row']}, id {kinds['id']}, same binary, bands array<long>, fp long")


def _sieved(rows: DataFrame, some: DataFrame) -> DataFrame:
    """rows without most of those whose ``row`` is not in some: a bitmap of SIEVE bits, broadcast, tells without a shuffle.

    None that is in some goes. With many more than SIEVE / 8 of them, most of the others pass, too.
    """
    bit = F.pmod(F.xxhash64("row"), F.lit(SIEVE))
    mask = F.expr("shiftleft(1L, cast(_bit & 63 AS int))")
    words = some.select(bit.alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word")).agg(F.bit_or(mask).alias("_mask"))
    found = rows.withColumn("_bit", bit).withColumn("_at", F.shiftright("_bit", 6)).join(F.broadcast(words), F.col("_at") == F.col("_word"))
    return found.where(F.col("_mask").bitwiseAND(mask) != 0).drop("_bit", "_at", "_word", "_mask")


def fingerprint_buckets(classes: DataFrame, t: Tables) -> DataFrame:
    """(node, band): those classes (node, fp) that are not alone, with one number for all that their fingerprints connect."""
    fps = t.save(classes.groupBy("fp").agg(F.count(F.lit(1)).alias("m")))
    roots = components(t.save(links(fps.select("fp"), t, RADIUS, PARTS)))
    of = fps.join(roots, fps.fp == roots.node, "left").where("m > 1 or root is not null").select("fp", F.xxhash64(F.coalesce("root", "fp")).alias("band"))
    return classes.join(of, "fp").select("node", "band")


def _links(rows: DataFrame, classes: DataFrame, shingle: int, similar: float, tile: int, t: Tables) -> DataFrame:
    places = t.save(fingerprint_buckets(classes, t)).unionByName(classes.select("node", F.explode("bands").alias("band")))
    full = places.groupBy("band").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("a"), F.max("node").alias("z")
    ).where("m > 1")
    # Buckets of the same members are one.
    once = t.save(full.groupBy("m", "x", "a", "z").agg(F.min("band").alias("band")).select("m", "band"))
    own = F.pmod(F.xxhash64("node", "band"), "g")
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), F.col("g") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    dealt = t.save(
        places.join(once, "band").withColumn("g", F.ceil(F.col("m") / tile)).withColumn("own", own)
        .select("node", F.explode(F.transform(tiles, lambda k: F.struct("band", k.i.alias("i"), k.j.alias("j")))).alias("k"))
        .groupBy("node").agg(F.collect_list("k").alias("dealt"))
    )
    keys = ["band", "i", "j"]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        at = None
        for batch in found:
            edges: list[tuple[int, int]] = []
            for *key, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at:
                    edges += bucket_links(held, similar)
                    held, at = [], key
                held.append((node, grams(text or "", shingle)))
            yield _edges(edges)
        yield _edges(bucket_links(held, similar))

    several = t.save(classes.select("node", "first.row").join(dealt, "node"))
    spelt = _sieved(rows, several).join(several, "row").select(F.explode("dealt").alias("k"), "node", "text")
    sent = spelt.select("k.*", "node", "text").repartition(*keys).sortWithinPartitions(*keys, "node").select(*keys, "node", "text")
    return sent.mapInArrow(run, "src long, dst long").distinct()


def copies(
    docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similar: float = SIMILAR, tile: int = TILE
) -> DataFrame:
    """(row_col): the rows of docs, as told apart by that column, that go so that one of each component of documents linked
    by a Jaccard similarity of ``similar`` or more stays.

    The row with the smallest id stays; rows without an id come after all others; of rows that repeat an id, one stays.
    Shingles are sets of ASCII-lower-cased words. Null texts count as empty; texts without a word equal each other. An
    empty table gives none. Other columns are not read. The result is written; none of the job's other tables stays.

    Documents of the same shingles are one before anything is compared. Only texts in buckets of several travel, to
    equal buckets once.
    """
    arrow(docs.sparkSession)
    rows = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = F.min(F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("id"), F.col("row").alias("row"))).alias("first")
    with Tables() as t:
        signed = t.save(_signed(rows, shingle))
        classes = t.save(signed.groupBy("same").agg(first, F.first("bands").alias("bands"), F.first("fp").alias("fp")).withColumn("node", F.monotonically_increasing_id()))
        roots = components(t.save(_links(rows, classes, shingle, similar, tile, t)))
        least = classes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
        # Those that go are fewer than those that stay: a smaller table to join.
        return save(signed.select("row").join(least.select("first.row"), "row", "left_anti").withColumnRenamed("row", row_col))


def first_of_near(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similar: float = SIMILAR, tile: int = TILE
) -> DataFrame:
    """The rows of docs without ``copies``; all columns are kept (one named _row is replaced)."""
    held = keyed(docs)
    return held.join(copies(held, "_row", id_col, text_col, shingle, similar, tile), "_row", "left_anti").drop("_row")
