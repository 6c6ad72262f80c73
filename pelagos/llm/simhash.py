"""Near-duplicates by SimHash fingerprints, linked through BK-trees.

Fingerprints at most ``radius`` bits apart agree in all but ``radius`` of any ``parts`` parts. So the distinct
fingerprints are dealt into shards by each choice of ``parts - radius`` parts; each shard holds one BK-tree, whose
children are keyed by their integer Hamming distance to the parent and whose search follows only the edges within
the radius. A tree for all fingerprints, broadcast, would mean collecting the fingerprints of all documents and work
that grows with their square; shards keep every link (some choice of parts agrees) and grow with the input.

A shard of more than ``full`` fingerprints is dealt again, by parts of the bits in which its members may still differ:
two of them differ in at most ``radius`` bits of those, so some choice of the new parts agrees as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, arrow, save, texts
from .graph import components

SHINGLE, RADIUS, PARTS, SEED = 3, 2, 4, 42
#: A shard with more fingerprints than this is dealt again.
FULL = 2000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LANES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the 64-bit hashes; no hashes give zero.

    Eight lanes of a word count eight bits at once; 255 hashes fit before a lane would overflow.
    """
    n = len(hashes)
    if not n:
        return 0
    h = np.zeros(-(-n // 255) * 255, np.uint64)
    h[:n] = hashes
    h = h.reshape(-1, 255)
    out = 0
    for shift in range(8):
        sums = ((h >> np.uint64(shift)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in range(8):
            if counts[byte] * 2 > n:
                out |= 1 << (8 * byte + shift)
    return out


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles, repeats included; without a word, zero."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    if len(words) <= shingle:
        return digest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    return majority(np.fromiter([digest(line[a:b], SEED) for a, b in zip(starts, stops)], np.uint64, len(starts)))


class BKTree:
    """Children are keyed by their Hamming distance to the parent; equal values are held once."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (value ^ node[0]).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def near(self, value: int, radius: int) -> Iterator[int]:
        stack = [self.root] if self.root else []
        while stack:
            held, children = stack.pop()
            d = (value ^ held).bit_count()
            if d <= radius:
                yield held
            if len(children) <= 2 * radius + 1:
                stack += [c for k, c in children.items() if d - radius <= k <= d + radius]
            else:
                stack += [children[k] for k in range(d - radius, d + radius + 1) if k in children]


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what the shard's values connect, at most one for each value."""
    tree, top = BKTree(), {}

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    for v in values:
        top.setdefault(v, v)
        for other in tree.near(v, radius):
            a, b = find(v), find(other)
            if a != b:
                top[max(a, b)] = min(a, b)
                out.append((v, other))
        tree.add(v)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id_col, fp): one row per row of docs; fp is the fingerprint as a signed long."""
    arrow(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            fp = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp)], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _finer(mask: int, radius: int, parts: int) -> list[int]:
    """Masks that also fix all but ``radius`` of ``parts`` parts of the bits that mask leaves free; none if these are too few."""
    free = [b for b in range(64) if not mask >> b & 1]
    if len(free) < parts:
        return []
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    bits = [sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:])]
    return [mask | sum(chosen) for chosen in combinations(bits, parts - radius)]


def shards(classes: DataFrame, radius: int, parts: int, full: int, t: Tables) -> DataFrame:
    """(mask, shard, fp): each pair of fingerprints within the radius is in some shard, and no shard that can be dealt
    again has more than ``full`` members. Only counts are gathered, combined before; full shards are few, and their
    members are told by a join that adaptive execution splits."""
    masks = _finer(0, radius, parts)
    held = classes.select("fp", F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask")).withColumn("shard", F.col("fp").bitwiseAND(F.col("mask")))
    done: DataFrame | None = None
    while finer := {m: found for m in masks if (found := _finer(m, radius, parts))}:
        able = held.where(F.col("mask").isin([_signed(m) for m in finer]))
        over = t.save(able.groupBy("mask", "shard").count().where(F.col("count") > full).select("mask", "shard"))
        if not over.limit(1).count():
            break
        rest = held.join(over, ["mask", "shard"], "left_anti")
        done = rest if done is None else done.unionByName(rest)
        masks = [m for m in masks if m in finer]
        known = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)).cast("long"), F.array(*[F.lit(_signed(f)).cast("long") for f in finer[m]]))])
        held = t.save(
            held.join(over, ["mask", "shard"], "left_semi").select("fp", F.explode(known[F.col("mask")]).alias("mask")).withColumn("shard", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
        )
        masks = sorted({f for m in masks for f in finer[m]})
    return held if done is None else done.unionByName(held)


def links(classes: DataFrame, t: Tables, radius: int = RADIUS, parts: int = PARTS, full: int = FULL) -> DataFrame:
    """(src, dst): links between distinct fingerprints that connect all that lie within the radius."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in found:
            mask, shard, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(fp):
                continue
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (shard[1:] != shard[:-1])) + 1
            edges: list[tuple[int, int]] = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)]):
                key = (mask[a], shard[a])
                if key != at:
                    if len(held) > 1:
                        edges += shard_links(held, radius)
                    held, at = [], key
                held += fp[a:b].view(np.uint64).tolist()
            yield _edges(edges)
        if len(held) > 1:
            yield _edges(shard_links(held, radius))

    dealt = shards(classes, radius, parts, full, t).select("mask", "shard", "fp").repartition("mask", "shard").sortWithinPartitions("mask", "shard", "fp")
    return dealt.mapInArrow(run, "src long, dst long").distinct()


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0].copy()), pa.array(a[:, 1].copy())], names=["src", "dst"])


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, parts: int = PARTS, full: int = FULL,
) -> DataFrame:
    """One row per row of docs: id_col, fingerprint (16 hex digits), component_id (the smallest id reachable).

    Null and empty texts have fingerprint zero, which links like any other. Rows without an id take part; a component
    of such rows alone has no id. Repeated rows stay repeated. Other columns of docs are not read.

    Copies are one fingerprint before anything is linked (combined before the shuffle). Only fingerprints travel.
    """
    held = save(fingerprints(docs, id_col, text_col, shingle).withColumnRenamed(id_col, "id"))
    with Tables() as t:
        classes = t.save(held.groupBy("fp").agg(F.min("id").alias("least")))
        roots = components(t.save(links(classes, t, radius, parts, full)))
        placed = t.save(classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
        ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        of = save(placed.join(ids, "root").select("fp", "component_id"))
    return held.join(of, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
