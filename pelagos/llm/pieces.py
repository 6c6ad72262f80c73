"""N-best segmentation into SentencePiece pieces, and decoding.

A text is escaped as the model does it (a space in front, spaces as U+2581) and cut where no piece can cross: before
each run of spaces and around line feeds. Each part is a piece lattice of its own. Forward Viterbi scores are exact
heuristics for a backward A* search, so paths leave the agenda in the order of their scores. The N best segmentations
of the text differ from the best in the parts whose second-best path costs least.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from heapq import heappop, heappush, nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, texts

MODEL, BEST = "piece_bpe_32k.model", 4
SPACE = "▁"
#: Characters that no piece holds cost this much more than the model's least likely piece.
UNKNOWN = 10.0
#: A part as a run of spaces and what follows, or a line feed.
_PART = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
REMEMBERED = 250_000
#: Parts up to this length are solved together.
_TOGETHER = 32


class Pieces:
    """A model's pieces: (id, score) by piece, bytes by id, and the paths of parts that a worker remembers."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.piece: dict[str, tuple[int, float]] = {}
        self.bytes, self.surface = [0] * 256, []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
                self.surface.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.surface.append(b"")
            else:
                self.piece[p] = i, sp.get_score(i)
                self.surface.append(p.replace(SPACE, " ").encode())
        crossing = [p for p in self.piece if "\n" in p or SPACE in p.lstrip(SPACE)]
        if crossing:
            raise ValueError(f"pieces that cross parts: {crossing[:3]}")
        self.longest = max(map(len, self.piece), default=1)
        real = [s for _, s in self.piece.values() if s > -1e8]
        self.unknown = min(real, default=0.0) - UNKNOWN
        self.starts = {p[:k] for p in self.piece for k in range(1, len(p) + 1)}
        self._trie()
        self.forget()

    def forget(self) -> None:
        """Parts have numbers; by number, the ids of the best path, its score, and how much more the second costs."""
        self.known: dict[str, int] = {}
        self.several: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = {}
        self.of: list[bytes] = []
        self.score, self.gap, self.width = (np.zeros(REMEMBERED + 1, t) for t in (float, float, np.int64))

    def _trie(self) -> None:
        """A trie of the pieces as a table of its steps: a step's key is the state that it leaves and the character, its slot
        a mix of the key or one of the next. ``ends`` has the piece's id by state, or -1, ``worth`` its score."""
        state = {"": 0}
        for p in sorted(self.starts, key=lambda p: (len(p), p)):
            state[p] = len(state)
        self.ends, self.worth = np.full(len(state), -1), np.full(len(state), -np.inf)
        for p, (i, x) in self.piece.items():
            self.ends[state[p]], self.worth[state[p]] = i, x
        slots = 1 << (8 * len(state)).bit_length()
        self.mask = np.int64(slots - 1)
        self.steps, self.next, self.tries = np.full(slots, -1), np.zeros(slots, np.int64), 1
        for p, to in state.items():
            if p:
                key = state[p[:-1]] << 21 | ord(p[-1])
                at, tried = int(self._slot(np.array([key]))[0]), 1
                while self.steps[at] >= 0:
                    at, tried = (at + 1) & int(self.mask), tried + 1
                self.steps[at], self.next[at], self.tries = key, to, max(self.tries, tried)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key * np.int64(0x2545F4914F6CDD1D)
        return (mixed ^ mixed >> np.int64(32)) & self.mask

    def _step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next states; 0 where the trie has none."""
        key = state << 21 | code
        at = self._slot(key)
        out = np.where(self.steps[at] == key, self.next[at], 0)
        for k in range(1, self.tries):
            left = np.flatnonzero((out == 0) & (self.steps[(at + k - 1) & self.mask] >= 0))
            if not len(left):
                break
            more = (at[left] + k) & self.mask
            out[left] = np.where(self.steps[more] == key[left], self.next[more], 0)
        return out

    def lattice(self, part: str) -> tuple[list[list[tuple[int, object, float]]], list[float]]:
        """(edges by end, forward scores): an edge is (start, id or tuple of byte ids, score)."""
        n, starts, piece = len(part), self.starts, self.piece
        ends: list[list[tuple[int, object, float]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                p = part[i:j]
                if p not in starts:
                    break
                if (hit := piece.get(p)) is not None:
                    ends[j].append((i, hit[0], hit[1]))
            if part[i] not in piece:
                ends[i + 1].append((i, tuple(self.bytes[b] for b in part[i].encode("utf-8", "replace")), self.unknown))
        forward = [0.0] * (n + 1)
        for j in range(1, n + 1):
            forward[j] = max(forward[i] + s for i, _, s in ends[j])
        return ends, forward

    def best(self, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best paths as (score, ids), best first. Of equal scores the hypothesis made last goes on first: always the same.

        A hypothesis stands at a position and offers its best edge; the next best is offered when it is taken, so the
        agenda grows by two for each step.
        """
        ends, forward = self.lattice(part)
        sorted_: dict[int, list[tuple[float, int, object, float]]] = {}

        def edges(at: int) -> list[tuple[float, int, object, float]]:
            if at not in sorted_:
                sorted_[at] = sorted(((forward[i] + s, -i, p, s) for i, p, s in ends[at]), key=lambda e: (-e[0], e[1]))
            return sorted_[at]

        out: list[tuple[float, tuple[int, ...]]] = []
        agenda: list[tuple] = []
        count = 0
        heappush(agenda, (-forward[-1], count, len(part), 0, 0.0, None))
        while agenda and len(out) < n:
            _, _, at, k, behind, tail = heappop(agenda)
            if at == 0:
                ids: list[int] = []
                while tail:
                    ids.extend(tail[0] if isinstance(tail[0], tuple) else (tail[0],))
                    tail = tail[1]
                out.append((behind, tuple(ids)))
                continue
            offered = edges(at)
            if k + 1 < len(offered):
                count += 1
                heappush(agenda, (-(offered[k + 1][0] + behind), -count, at, k + 1, behind, tail))
            _, start, p, s = offered[k]
            count += 1
            heappush(agenda, (-(forward[-start] + s + behind), -count, -start, 0, behind + s, (p, tail)))
        return out

    def _best_known(self, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        if (part, n) not in self.several:
            if len(self.several) > REMEMBERED // 10:
                self.several.clear()
            self.several[part, n] = self.best(part, n)
        return self.several[part, n]

    def learn(self, new: list[str]) -> None:
        """Remembers the best paths of parts. Those of one length are solved together, forward and backward: the second
        best path of a part is the best one through an edge that the best doesn't take."""
        groups: dict[int, list[str]] = {}
        for part in new:
            groups.setdefault(len(part), []).append(part)
        for length, some in groups.items():
            if length > _TOGETHER or not self.piece:
                for part in some:
                    found = self.best(part, 2)
                    self._keep([part], [np.array(found[0][1], "<u4").tobytes()], [found[0][0]], [found[0][0] - found[1][0] if len(found) > 1 else np.inf])
                continue
            for at in range(0, len(some), 2048):
                self._together(some[at : at + 2048], length)

    def _keep(self, parts: list[str], ids: list[bytes], score, gap) -> None:
        a, b = len(self.of), len(self.of) + len(parts)
        if b > len(self.score):
            self.score, self.gap, self.width = (np.resize(x, 2 * b) for x in (self.score, self.gap, self.width))
        self.known.update(zip(parts, range(a, b)))
        self.of += ids
        self.score[a:b], self.gap[a:b], self.width[a:b] = score, gap, [len(i) for i in ids]

    def _together(self, parts: list[str], length: int) -> None:
        """Scores by part, start and piece length, the longest first; then forward and backward over all parts at once."""
        n, most = len(parts), min(length, self.longest)
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).astype(np.int64)
        score = np.full((n, length + most, most), -np.inf)  # by end and most - piece length
        ids = np.full((n, length + most, most), -1)
        row, start = np.repeat(np.arange(n), length), np.tile(np.arange(length), n)
        state = np.zeros(n * length, np.int64)
        strange = np.zeros(n, bool)
        for k in range(1, most + 1):
            inside = start + k <= length
            row, start, state = row[inside], start[inside], state[inside]
            state = self._step(state, codes[row, start + k - 1])
            on = state > 0
            if k == 1:
                known = np.zeros(n * length, bool)
                known[on] = self.ends[state[on]] >= 0
                strange = ~known.reshape(n, length).all(axis=1)
            row, start, state = row[on], start[on], state[on]
            whole = self.ends[state] >= 0
            r, e = row[whole], start[whole] + k
            score[r, e, most - k], ids[r, e, most - k] = self.worth[state[whole]], self.ends[state[whole]]
        forward, backward = np.full((n, most + length + 1), -np.inf), np.full((n, length + most + 1), -np.inf)
        forward[:, most], backward[:, length] = 0, 0  # forward has places before the first
        chosen = np.zeros((n, length + 1), np.int64)
        for j in range(1, length + 1):
            sums = forward[:, j : j + most] + score[:, j]
            chosen[:, j] = sums.argmax(axis=1)
            forward[:, most + j] = sums[np.arange(n), chosen[:, j]]
        place = np.arange(most)
        for i in range(length - 1, -1, -1):
            backward[:, i] = (backward[:, i + most - place] + score[:, i + most - place, place]).max(axis=1)
        at, taken, rows = np.full(n, length), np.full((n, length), -1, np.int64), np.arange(n)
        through = np.full((n, length + 1, most), -np.inf)
        for j in range(1, length + 1):
            through[:, j] = forward[:, j : j + most] + score[:, j] + backward[:, j : j + 1]
        while (left := np.flatnonzero(at > 0)).size:
            j, c = at[left], chosen[rows[left], at[left]]
            begin = np.maximum(j - (most - c), 0)
            taken[left, begin] = ids[left, j, c]
            through[left, j, c] = -np.inf
            at[left] = begin
        second = through.reshape(n, -1).max(axis=1)
        best = forward[:, most + length]
        fine = np.flatnonzero(~strange)
        flat = taken[fine]
        there = flat >= 0
        whole, ends = flat[there].astype("<u4").tobytes(), (4 * np.cumsum(there.sum(axis=1))).tolist()
        packed = [whole[a:z] for a, z in zip([0, *ends], ends)]
        self._keep([parts[k] for k in fine.tolist()], packed, best[fine], best[fine] - second[fine])
        for k in np.flatnonzero(strange).tolist():
            found = self.best(parts[k], 2)
            self._keep([parts[k]], [np.array(found[0][1], "<u4").tobytes()], [found[0][0]], [found[0][0] - found[1][0] if len(found) > 1 else np.inf])

    def encode(self, text: str, n: int = BEST) -> list[tuple[float, bytes]]:
        """The n best segmentations of a whole text as (score, ids); an empty text has one, without ids."""
        return self.encode_all([text], n)[0]

    def encode_all(self, said: list[str], n: int = BEST) -> list[list[tuple[float, bytes]]]:
        """encode() of several texts, whose new parts are solved together."""
        every = [_PART.findall((" " + t).replace(" ", SPACE)) if t else [] for t in said]
        if len(self.known) > REMEMBERED:
            self.forget()
        self.learn(sorted({p for parts in every for p in parts}.difference(self.known)))
        return [self._paths(parts, n) if parts else [(0.0, b"")] for parts in every]

    def _paths(self, parts: list[str], n: int) -> list[tuple[float, bytes]]:
        at = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        best, score = b"".join(map(self.of.__getitem__, at.tolist())), float(self.score[at].sum())
        gaps = self.gap[at]
        less = np.flatnonzero(gaps <= np.partition(gaps, n - 2)[n - 2]) if 1 < n <= len(gaps) else np.arange(len(gaps))
        turn = [i for i in nsmallest(n - 1, less.tolist(), key=gaps.__getitem__) if gaps[i] < np.inf]
        if not turn:
            return [(score, best)]
        turn.sort()
        paths = [self._best_known(parts[i], n) for i in turn]
        ends = np.cumsum(self.width[at])
        cuts = [(int(ends[i] - self.width[at[i]]), int(ends[i])) for i in turn]
        # The n least sums over the parts: of the parts so far, only the n best can go on.
        sums: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        for p in paths:
            sums = nsmallest(n, ((more + p[0][0] - p[k][0], (*pick, k)) for more, pick in sums for k in range(len(p))))
        out = []
        for more, pick in sums:
            spelt, done = [], 0
            for (a, b), p, k in zip(cuts, paths, pick):
                spelt += [best[done:a], np.array(p[k][1], "<u4").tobytes()]
                done = b
            out.append((score - more, b"".join([*spelt, best[done:]])))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of a segmentation: pieces joined, byte pieces as the bytes they stand for, without the first space."""
        whole = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        return whole.removeprefix(" ")


_PIECES: dict[str, Pieces] = {}


def pieces(model: str = MODEL) -> Pieces:
    """One for each model and worker; model names a public file or is a path."""
    if model not in _PIECES:
        import os

        import public_tokenizers

        _PIECES[model] = Pieces(model if os.path.sep in model else public_tokenizers.path(model))
    return _PIECES[model]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = BEST, model: str = MODEL, with_ids: bool = True) -> DataFrame:
    """One row per row of docs: id_col, n_pieces, scores and ids_crc32 of the n best, best first, and round_trip.

    scores: the sums of the pieces' scores. round_trip: whether decoding the best gives the text again (a text that
    itself holds U+2581 decodes to spaces). Null texts count as empty: one segmentation without pieces. Repeated rows
    stay. with_ids adds ``ids``: the n best as arrays of piece ids. Nothing is shuffled; texts are taken whole.
    """
    arrow(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    fields = "n_pieces long, scores array<double>, ids_crc32 array<long>, round_trip boolean" + ", ids array<array<int>>" * with_ids

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for batch in found:
            said = texts(batch)
            got = p.encode_all(said, n)
            columns = [
                batch.column("id"), pa.array([len(g[0][1]) // 4 for g in got], pa.int64()), pa.array([[s for s, _ in g] for g in got], pa.list_(pa.float64())),
                pa.array([[zlib.crc32(i) for _, i in g] for g in got], pa.list_(pa.int64())), pa.array([p.decode(g[0][1]) == t for g, t in zip(got, said)], pa.bool_()),
            ]
            if with_ids:
                columns.append(pa.array([[np.frombuffer(i, "<u4").astype(np.int32) for _, i in g] for g in got], pa.list_(pa.list_(pa.int32()))))
            yield pa.RecordBatch.from_arrays(columns, names=["id", *(f.split()[0] for f in fields.split(", "))])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {fields}").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """encoded with a column ``decoded``: the text of the array of piece ids in ids_col; null stays null."""

    @F.pandas_udf("string")
    def text(ids):
        p = pieces(model)
        return ids.map(lambda a: None if a is None else p.decode(np.asarray(a, "<u4").tobytes()))

    return encoded.withColumn("decoded", text(F.col(ids_col)))
