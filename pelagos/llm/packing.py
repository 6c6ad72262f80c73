"""Packing documents into token windows by best-fit decreasing."""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import arrow, batches, save, texts

WINDOW, END_ID, VOCABULARY = 2048, 1, "word_bpe_49k.json"
#: Pieces that are packed together. A task holds no more of them; the next lot starts with no open window.
LOT = 100_000
#: Distinct strings whose ids a worker remembers.
REMEMBERED = 500_000
#: White space on which str.split and the tokenizer may disagree, and marks of control strings.
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]|<\\|")


def _odd(text: str) -> bool:
    if text.isascii():
        return "<|" in text or any(c in text for c in "\x0b\x0c\x1c\x1d\x1e\x1f")
    return _ODD.search(text) is not None


@cache
def _ends_alone(c: str) -> bool:
    """Whether a mark after the character is a token of its own: the character's normal form is one letter or digit."""
    return c.isalnum() and len(n := unicodedata.normalize("NFC", c)) == 1 and len(n.lower()) == 1


def _plain(word: str) -> tuple[str, str]:
    """(string, full stop or comma or nothing) with the same ids in all: the tokenizer lower-cases, and takes a mark
    after a letter or digit for itself. Letters beyond the Latin ones are left to it."""
    end = word[-1] if word[-1] in ".," and len(word) > 1 and _ends_alone(word[-2]) else ""
    core = word[:-1] if end else word
    return (core.lower() if core.isascii() or (max(core) < "ɐ" and "İ" not in core) else core), end


class CapacityTree:
    """Open windows by remaining capacity: finds the tightest window that holds a piece.

    Leaf c counts the open windows with c tokens left, an inner node those below it.
    """

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        node = self.size + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest open window with at least ``need`` left; it is no longer open."""
        count, node = self.count, self.size + need
        while not count[node]:
            while node & 1:
                node >>= 1
                if not node:
                    return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf of this depth
                return None
        while node < self.size:
            node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.size
        while node:
            count[node] -= 1
            node >>= 1
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """(window number, offset) for each length from 1 to window, and how many windows there are."""
    tree, where, offset, used = CapacityTree(window), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        left, at = tree.take(n) or (window, used)
        used += at == used
        where[i], offset[i] = at, window - left
        if left > n:
            tree.put(left - n, at)
    return where, offset, used


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    White space separates what the tokenizer looks at, so a text's ids are those of its parts, which are
    remembered. Texts with unusual white space or marks of control strings go through the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves, by code
        others = iter(range(256, 512))
        self.signs = [chr(b) if b in shown else chr(next(others)) for b in range(256)]
        self.known: dict[str, bytes] = {}

    def _raw(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(parts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Encodes the strings as one text, which is much faster, and deals its ids out by where they come from."""
        encoded = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
        starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) + 1)))
        from_ = np.array(encoded.offsets, np.int64).reshape(-1, 2)[:, 0]
        cuts = (4 * np.searchsorted(from_, starts)).tolist()
        ids = np.array(encoded.ids, "<u4").tobytes()
        self.known.update(zip(new, [ids[a:b] for a, b in zip(cuts, cuts[1:])]))

    def encode(self, found: list[str]) -> list[bytes]:
        parts = [None if _odd(t) else t.split() for t in found]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = set().union(*[p for p in parts if p]).difference(known)
        tokenize = self.model.tokenize
        simple = [w for w in new if w.isalpha() and w.islower() and w.isascii()]  # the larger part
        known.update((w, array("I", [x.id for x in tokenize(w)]).tobytes()) for w in simple)
        new = list(new.difference(simple))
        plain = [_plain(w) for w in new]
        cores = list({c for c, _ in plain}.union((".", ",")).difference(known))
        rest = []
        for c in cores:
            if c.isalpha() and (c.isascii() or max(c) < "ɐ") and c.islower():  # one word for the model, as bytes
                seen = c if c.isascii() else "".join([self.signs[b] for b in c.encode()])
                known[c] = array("I", [x.id for x in tokenize(seen)]).tobytes()
            else:
                rest.append(c)
        for at in range(0, len(rest), 500):
            self._learn(rest[at : at + 500])
        known.update((w, known[c] + known[end] if end else known[c]) for w, (c, end) in zip(new, plain))
        get = self.known.__getitem__
        return [self._raw([t])[0] if p is None else b"".join(map(get, p)) for t, p in zip(found, parts)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """One for each vocabulary and worker; vocabulary names a public file or is a path."""
    if vocabulary not in _ENCODERS:
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[vocabulary] = Encoder(vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary))
    return _ENCODERS[vocabulary]


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID,
    vocabulary: str = VOCABULARY, lot: int = LOT, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, padded_to.

    Documents longer than the window are first cut into full windows; what is left of each is placed, longest
    first, into the tightest open window. A sequence is padded to the window, unless its tokens are a power of two:
    then to nothing (padded_to = sequence_tokens). Null and empty texts are the end id alone. Repeated rows are packed
    as often as they come. Null ids are kept. with_ids adds the pieces' ids (binary, little-endian unsigned 32-bit).

    Pieces, not texts, are written and dealt into lots of at most about ``lot``, however the documents were partitioned: a
    task packs one, so memory is bounded. A lot leaves few windows unfilled, whatever the size of the whole.
    """
    arrow(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    fields = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, padded_to long" + ", ids binary" * with_ids

    plain = fields[: fields.index(", sequence_id")] + ", ids binary" * with_ids

    def shape(found: str, key: pa.DataType) -> pa.Schema:
        return pa.schema([("id", key), *((f.split()[0], pa.binary() if "binary" in f else pa.int64()) for f in found.split(", "))])

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = int(end_id).to_bytes(4, "little")
        for batch in found:
            held = []
            for key, ids in zip(batch.column("id").to_pylist(), encoder(vocabulary).encode(texts(batch))):
                ids += tail
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    held.append((key, start, len(part) // 4, zlib.crc32(part), total) + ((part,) if with_ids else ()))
            yield from batches(iter(held), shape(plain, batch.column("id").type))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, schema = TaskContext.get().partitionId() << 36, [], None
        for batch in found:
            schema = schema or shape(fields, batch.column("id").type)
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= 2 * lot:
                rows, used = place(held[:lot], first)
                held = held[lot:]
                yield from batches(rows, schema)
                first += used
        if held:
            yield from batches(place(held, first)[0], schema)

    def place(held: list[tuple], first: int) -> tuple[Iterator[tuple], int]:
        lengths = np.array([p[2] for p in held], np.int64)
        where, offset, used = best_fit_decreasing(lengths, window)
        filled = np.bincount(where, weights=lengths, minlength=used).astype(np.int64)
        padded = np.where(filled & (filled - 1) == 0, filled, window)
        rows = (p[:5] + (first + w, o, f, q) + p[5:] for p, w, o, f, q in zip(held, where.tolist(), offset.tolist(), filled[where].tolist(), padded[where].tolist()))
        return rows, used

    pieces = save(docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(cut, f"id {kind}, {plain}"))
    packed = pieces.repartition(max(1, -(-pieces.count() // lot))).mapInArrow(run, f"id {kind}, {fields}")
    return packed.withColumnRenamed("id", id_col)
