"""Near-duplicate vectors by lattice hashing.

In each of several tables, blocks of a random projection to eight dimensions each are decoded to their E8 lattice points:
together the vector's cell. A vector is a member of its own cell and asks the members of its own cell and of those beside
it. Every pair that meets is verified by its cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from . import lattice
from .common import Tables, arrow, save
from .graph import components

COSINE = 0.9


class Hashing(NamedTuple):
    """Tables, blocks of a table, cells beside a vector's own that it asks, and the projection's scale."""

    tables: int
    blocks: int
    beside: int
    scale: float


#: One for inputs of any size, so that whether two vectors are linked follows from these two alone. Two unrelated vectors of
#: 64 dimensions meet with a probability of about 5e-6 in a table; pairs at a cosine of exactly 0.9 meet in some table with a
#: probability of about 0.99, closer ones almost surely.
HASHING = Hashing(10, 3, 32, 0.45)
HASHINGS = ((None, HASHING),)
#: Bits of the map that tells which cells have members: 4 MB.
SIEVE = 1 << 25
#: Members and askers of a cell that one task compares at most; fuller cells are dealt to several tasks.
CELL = 4096
#: Rows and columns that are compared at once, pairs that are placed at once, and pairs of small cells taken together.
_TILE, _PAIRS, _TOGETHER = 512, 50_000, 20_000


@cache
def _tables(dims: int, how: Hashing) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([20, dims])
    wide = 8 * how.blocks
    return draw.normal(size=(wide * how.tables, dims)) * how.scale, draw.integers(1, 1 << 62, (how.tables, wide)) * 2 + 1


def _beside(y: np.ndarray, how: Hashing, odd: np.ndarray) -> np.ndarray:
    """Keys by (vector, place) in one table: those of the nearest cells, by the distances of all blocks together."""
    rank = np.arange(1, 2 + how.beside)
    # By distance in each block, others are no farther than a pair of ranks whose product is larger.
    left, right = np.nonzero(np.multiply.outer(rank, rank) <= len(rank))
    none = np.zeros((len(y), 1), np.int64)
    total, extra = None, None
    for k in range(how.blocks):
        part = odd[8 * k : 8 * k + 8]
        own, order, more = lattice.beside(y[:, 8 * k : 8 * k + 8], how.beside)
        by = np.argsort(more, axis=1)
        order, more = np.take_along_axis(order, by, 1), np.concatenate([none, np.take_along_axis(more, by, 1)], axis=1)
        steps = ((2 * lattice.SHORTEST).astype(np.int64) * part).sum(axis=1)
        mixed = ((2 * own).astype(np.int64) * part).sum(axis=1)[:, None] + np.concatenate([none, steps[order]], axis=1)
        if total is None:
            total, extra = mixed, more
            continue
        sums = extra[:, left] + more[:, right]
        best = np.concatenate([none, np.argsort(sums[:, 1:], axis=1)[:, : how.beside] + 1], axis=1)  # the first is always the own cell
        total, extra = np.take_along_axis(total, left[best], 1) + np.take_along_axis(mixed, right[best], 1), np.take_along_axis(sums, best, 1)
    return total


def keys(unit: np.ndarray, how: Hashing) -> np.ndarray:
    """Cells by (vector, table, place); place 0 is the vector's own cell, the others those that it asks besides."""
    planes, odd = _tables(unit.shape[1], how)
    wide = 8 * how.blocks
    out = np.empty((len(unit), how.tables, 1 + how.beside), np.int64)
    for at in range(0, len(unit), 4096):
        y = unit[at : at + 4096] @ planes.T
        for t in range(how.tables):
            mixed = _beside(y[:, wide * t : wide * (t + 1)], how, odd[t])
            mixed ^= (mixed.view(np.uint64) >> np.uint64(29)).view(np.int64)
            out[at : at + 4096, t] = mixed // 16 * 16 + t  # the last digits name the table
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


class _Cells:
    """Rows of several whole cells, a cell's members before those that only ask."""

    def __init__(self, key: np.ndarray, node: np.ndarray, n: np.ndarray, asks: np.ndarray, own: np.ndarray, unit: np.ndarray, how: Hashing) -> None:
        self.key, self.node, self.n, self.asks, self.own, self.unit, self.how = key, node, n, asks, own, unit, how
        # Of each vector, in the order of nodes, whatever the number of cells: a row of it, links, what it is joined with.
        _, self.first, self.vector = np.unique(node, return_index=True, return_inverse=True)
        self.gained, self.parent = np.zeros(len(self.first), np.int64), np.arange(len(self.first))
        self.held, self.known = np.empty((len(self.first), how.tables, 1 + how.beside), np.int64), np.zeros(len(self.first), bool)
        self.hit = np.zeros(len(self.first), bool)

    def _keys(self, rows: np.ndarray) -> np.ndarray:
        """Of these rows' vectors, each computed once."""
        at = self.vector[rows]
        new = np.unique(at[~self.known[at]])
        if len(new):
            self.held[new], self.known[new] = keys(self.unit[self.first[new]], self.how), True
        return self.held[at]

    def pairs(self, q: np.ndarray, m: np.ndarray) -> None:
        """Counts and joins pairs that are alike: q asks, m is a member of the same cell.

        A pair may meet in several tables, and in either one's cell; it is counted in the first table where it meets, there
        in the lesser cell if each asks the other's, and once. All of that follows from the two vectors' keys.
        """
        used, at = np.unique(np.concatenate([q, m]), return_inverse=True)
        cells = self._keys(used)
        for a in range(0, len(q), _PAIRS):
            i, j = at[: len(q)][a : a + _PAIRS], at[len(q) :][a : a + _PAIRS]
            key = self.key[used[i]]
            n = key % 16
            first = n.copy()
            for t in range(n.max()):
                left = np.flatnonzero((first == n) & (n > t))
                met = (cells[i[left], t] == cells[j[left], t, :1]).any(axis=1) | (cells[j[left], t] == cells[i[left], t, :1]).any(axis=1)
                first[left[met]] = t
            own_i, own_j = cells[i, n, 0], cells[j, n, 0]
            there, back = (cells[i, n] == own_j[:, None]).any(axis=1), (cells[j, n] == own_i[:, None]).any(axis=1)
            place = np.where(there & back, np.minimum(own_i, own_j), np.where(there, own_j, own_i))
            counted = (first == n) & (place == key)
            for x, y in ((used[i], used[j]), (used[j], used[i])):
                np.add.at(self.gained, self.vector[x[counted]], self.n[y[counted]])
        self.hit[self.vector[used]] = True
        self._join(self.vector[q], self.vector[m])

    def _join(self, q: np.ndarray, m: np.ndarray) -> None:
        while True:
            a, b = self.parent[q], self.parent[m]
            if np.array_equal(a, b):
                return
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.parent[self.parent], self.parent):
                self.parent = up

    def _fit(self, q: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.asks[q] & (self.node[q] != self.node[m]) & (~self.own[q] | (self.node[q] < self.node[m]))

    def _verified(self, q: np.ndarray, m: np.ndarray, cosine: float) -> None:
        """Of these pairs, those that are alike, computed in one way whatever the cell's size."""
        alike = np.zeros(len(q), bool)
        for a in range(0, len(q), _TOGETHER):
            i, j = q[a : a + _TOGETHER], m[a : a + _TOGETHER]
            alike[a : a + _TOGETHER] = np.einsum("ij,ij->i", self.unit[i], self.unit[j]) >= cosine
        if alike.any():
            self.pairs(q[alike], m[alike])

    def few(self, q: np.ndarray, m: np.ndarray, cosine: float) -> None:
        """Pairs of small cells, one by one."""
        for a in range(0, len(q), _TOGETHER):
            i, j = q[a : a + _TOGETHER], m[a : a + _TOGETHER]
            fit = self._fit(i, j)
            self._verified(i[fit], j[fit], cosine)

    def many(self, rows: slice, members: int, cosine: float) -> None:
        """A cell of many rows, tile by tile."""
        for a in range(rows.start, rows.stop, _TILE):
            for b in range(rows.start, rows.start + members, _TILE):
                q, m = np.nonzero(self.unit[a : min(a + _TILE, rows.stop)] @ self.unit[b : min(b + _TILE, rows.start + members)].T >= cosine - 1e-9)
                q, m = q + a, m + b
                fit = self._fit(q, m)
                self._verified(q[fit], m[fit], cosine)

    def links(self, member: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, links counted here, a node that it is linked with here, the same for all it reaches here)."""
        cuts = np.flatnonzero(np.diff(self.key)) + 1
        starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(self.key)]))
        members = np.add.reduceat(member.astype(np.int64), starts)
        size = stops - starts
        large = members * size > _TOGETHER
        for a, z, k in zip(starts[large].tolist(), stops[large].tolist(), members[large].tolist()):
            self.many(slice(a, z), k, cosine)
        each = np.where(large, 0, members)  # how many members each row of a cell meets
        per = np.repeat(each, size)
        q = np.repeat(np.arange(len(self.key)), per)
        at = np.arange(len(q)) - np.repeat(np.cumsum(per) - per, per)
        self.few(q, np.repeat(np.repeat(starts, size), per) + at, cosine)
        used = np.flatnonzero(self.hit)
        node = self.node[self.first]
        return node[used], self.gained[used], node[self.parent[used]]


def near_links(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, how: Hashing | None = None, cell: int = CELL,
) -> DataFrame:
    """One row per row of vectors: id_col, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as do rows without an
    id; vectors of different length don't link. An id may have any type that has an order. Other columns of vectors are not
    read. Equal vectors are one class (combined before the shuffle) that counts as often as it comes; links are counted,
    never listed. ``how`` is HASHING, if it is not given, whatever the number of rows. A cell of more than ``cell`` members is
    dealt out: its members and those who ask them to a square of tasks.
    """
    spark = arrow(vectors.sparkSession)
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    of, width = (np.float32, 4) if single else (np.float64, 8)
    v = F.col(vector_col).cast("array<float>" if single else "array<double>")
    peak = F.array_max(F.transform(v, lambda x: F.abs(x)))
    sound = F.col(id_col).isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & (peak > 0) & (peak < float("inf"))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"), F.coalesce(sound, F.lit(False)).alias("sound"))
    with Tables() as t:
        classes = t.save(rows.where("sound").groupBy("v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).withColumn("node", F.monotonically_increasing_id()))
        found = t.save(_found(classes, how or HASHING, cosine, cell, of, width, t))
        counted = found.groupBy("node").agg(F.sum("gained").alias("gained"))
        roots = components(found.select(F.col("node").alias("src"), F.col("root").alias("dst"))).withColumnRenamed("node", "at")
        placed = t.save(
            classes.join(counted, "node", "left").join(roots, F.col("node") == F.col("at"), "left").select(
                "v", "least", (F.coalesce("gained", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")
            )
        )
        first = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        judged = save(placed.join(first, "root").select("v", "n_links", "component_id"))
    linked = rows.where("sound").join(judged, "v").select("id", "n_links", "component_id")
    alone = rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _found(classes: DataFrame, how: Hashing, cosine: float, cell: int, of: type, width: int, t: Tables) -> DataFrame:
    """(node, gained, root): for each cell's vectors that have a link there, how many are counted there and what joins them."""

    def spread(found: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        for batch in found:
            lists = batch.column("v").to_pylist()
            for dims in sorted({len(x) for x in lists}):
                rows = [i for i, x in enumerate(lists) if len(x) == dims]
                raw = np.array([lists[i] for i in rows], of)
                got = keys(_unit(raw.astype(np.float64)), how if whole else how._replace(beside=0))
                if not whole:
                    yield pa.RecordBatch.from_arrays([pa.array(got[:, :, 0].ravel())], names=["key"])
                    continue
                # Places of a table that come to one cell are one; a cell without members is not asked.
                got = got.reshape(len(rows) * how.tables, -1)
                once = np.ones(got.shape, bool)
                for k in range(1, got.shape[1]):
                    once[:, k] = (got[:, :k] != got[:, k : k + 1]).all(axis=1)
                bit = got[:, 1:] >> 4 & (SIEVE - 1)
                once[:, 1:] &= (sieve[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
                at, place = np.nonzero(once)
                index = pa.array(at // how.tables)
                some = batch.take(pa.array(rows))
                packed = pa.array([r.tobytes() for r in raw], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[once]), pa.array(place == 0), some.column("node").take(index), some.column("n").take(index), packed.take(index)], names=["key", "own", "node", "n", "vector"]
                )

    members = classes.select("v").mapInArrow(lambda found: spread(found, False), "key long")
    filled = t.save(members.groupBy("key").count())
    full = filled.where(F.col("count") > cell).select("key", F.ceil(F.col("count") / cell).cast("int").alias("parts"))
    sieve = _sieve(filled)
    met = classes.select("v", "node", "n").mapInArrow(lambda found: spread(found, True), "key long, own boolean, node long, n long, vector binary")
    if full.limit(1).count():
        # In tile (i, j) those whose home is i ask the members whose home is j.
        parts = F.coalesce("parts", F.lit(1))
        homed = met.join(full, "key", "left").withColumn("parts", parts).withColumn("home", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        each = F.sequence(F.lit(0), F.col("parts") - 1)
        asking = F.transform(each, lambda j: F.struct(F.col("home").alias("i"), j.alias("j"), F.lit(True).alias("asks"), (F.col("own") & (j == F.col("home"))).alias("member")))
        asked = F.transform(F.filter(each, lambda i: F.col("own") & (i != F.col("home"))), lambda i: F.struct(i.alias("i"), F.col("home").alias("j"), F.lit(False).alias("asks"), F.lit(True).alias("member")))
        met = homed.select("key", "own", "node", "n", "vector", F.explode(F.concat(asking, asked)).alias("k")).select("key", "k.*", "own", "node", "n", "vector")
    else:
        met = met.select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("asks"), F.col("own").alias("member"), "own", "node", "n", "vector")
    order = ["key", "i", "j", "length"]
    dealt = met.withColumn("length", F.length("vector")).repartition("key", "i", "j").sortWithinPartitions(*order, F.desc("member"))

    def solved(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        lengths = rows.column("length").to_numpy()
        for length in np.unique(lengths).tolist():
            some = rows.filter(pa.array(lengths == length))
            key, i, j, asks, member, own, node, n = (some.column(c).to_numpy() for c in ("key", "i", "j", "asks", "member", "own", "node", "n"))
            unit = _unit(np.frombuffer(b"".join(some.column("vector").to_pylist()), of).reshape(-1, length // width).astype(np.float64))
            for a, z in _runs(i, j):
                made = _Cells(key[a:z], node[a:z], n[a:z], asks[a:z], own[a:z], unit[a:z], how).links(member[a:z], cosine)
                if len(made[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["node", "gained", "root"])

    def link(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        many = 0
        for batch in found:
            held.append(batch)
            many += batch.num_rows
            if many < 2 * cell:
                continue
            rows = pa.Table.from_batches(held)
            last = _cuts(rows)[-1]
            if last:
                yield from solved(rows.slice(0, last))
            rest = rows.slice(last)
            if rest.num_rows >= 2 * cell and not rest.column("member")[-1].as_py():
                # Members came first: they stay, and those who asked go.
                yield from solved(rest)
                stay = rest.filter(rest.column("member"))
                rest = stay.set_column(stay.schema.get_field_index("asks"), stay.schema.field("asks"), pa.array(np.zeros(stay.num_rows, bool)))
            held, many = rest.combine_chunks().to_batches(), rest.num_rows
        if many:
            yield from solved(pa.Table.from_batches(held))

    return dealt.mapInArrow(link, "node long, gained long, root long")


def _sieve(filled: DataFrame) -> np.ndarray:
    """Bits of the cells in filled, eight a byte, by a part of the key; of fixed size."""
    bit = F.shiftright("key", 4).bitwiseAND(SIEVE - 1)
    words = filled.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftright(key, 4) & 63 AS int))")).alias("mask")).toArrow()
    out = np.zeros(SIEVE >> 6, "<i8")
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    return out.view(np.uint8)


def _runs(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of rows of the same tile."""
    cuts = (np.flatnonzero((np.diff(i) != 0) | (np.diff(j) != 0)) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(i)]))


def _cuts(rows: pa.Table) -> list[int]:
    """Where cells, tiles and lengths begin."""
    some = [rows.column(c).to_numpy() for c in ("key", "i", "j", "length")]
    new = np.zeros(rows.num_rows, bool)
    for c in some:
        new[1:] |= c[1:] != c[:-1]
    return [0, *np.flatnonzero(new).tolist()]
