"""Toxicity: a support vector machine on a gapped subsequence string kernel, with Nyström landmarks.

A document is scored by its most toxic word (a sentence or text is the set of its words; runs of single signs, such as
a spelt-out insult, are one word). The kernel of two words sums, over all triples of characters, the products of their
decayed occurrences: each occurrence counts DECAY to the power of the stretch it spans, gaps included. So inserted
characters and changed endings lower a likeness but don't end it.

A linear machine on Nyström features is a weighted sum of kernels with the landmarks, and that sum is linear in the
triples. So the trained machine is folded into one table of triple weights, and scoring a word needs no landmark.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, texts
from .labelled import remainder, sample

#: Labelled documents of each class that are learned from, at most.
LEARNED = 1000
LANDMARKS, DECAY, SPAN, LONGEST = 192, 0.6, 7, 24
SIGNS = 64
#: Words that are tried as seeds of toxic vocabulary, and from which kernel on words are alike.
CANDIDATES, LIKE = 160, (0.5, 0.65, 0.99)
THRESHOLD = 0.7
REMEMBERED = 400_000
_SPELT = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_ENDS = re.compile(r"^[\W_]+|[\W_]+$")
_CODES = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")} | {"^": 62, "$": 63}


def units(text: str) -> set[str]:
    """The distinct words of a text, lower-cased, and its spelt-out runs."""
    low = text.lower()
    found = set(low.split())
    found.update(m.replace(" ", "").replace("\t", "") for m in _SPELT.findall(low))
    return found


def _windows(word: str) -> list[str]:
    """The word without the signs at its ends, between marks for its ends; a long one as windows that overlap by half."""
    core = _ENDS.sub("", word)
    if not core:
        return []
    core = f"^{core}$"
    return [core] if len(core) <= LONGEST else [core[i : i + LONGEST] for i in range(0, len(core) - LONGEST // 2, LONGEST // 2)]


@cache
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    found = [(i, j, k) for i in range(length) for j in range(i + 1, length) for k in range(j + 1, min(length, i + SPAN))]
    at = np.array(found, np.int64).reshape(-1, 3)
    return at, (DECAY ** (at[:, 2] - at[:, 0] + 1)).astype(np.float32)


def _coded(words: list[str]) -> np.ndarray:
    return np.array([[_CODES.get(c, 0) or (27 if c.isdigit() else 28 + ord(c) % 34) for c in w] for w in words], np.int64)


def _by_length(words: list[str], most: int = 4000) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """(places, triples of each word, their weights, norms) for words of one length; too short ones are left out."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) >= 3:
            groups.setdefault(len(w), []).append(i)
    for length, places in groups.items():
        at, weight = _triples(length)
        step = max(1, most * 56 // len(weight))
        for a in range(0, len(places), step):
            some = places[a : a + step]
            codes = _coded([words[i] for i in some])
            keys = (codes[:, at[:, 0]] * SIGNS + codes[:, at[:, 1]]) * SIGNS + codes[:, at[:, 2]]
            order = np.argsort(keys, axis=1)
            flat = (np.take_along_axis(keys, order, 1) + np.arange(len(some))[:, None] * SIGNS**3).ravel()
            starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
            squares = np.add.reduceat(weight[order].ravel(), starts) ** 2
            norms = np.sqrt(np.bincount(flat[starts] // SIGNS**3, weights=squares, minlength=len(some)))
            yield some, keys, weight, norms


def _values(parts: list[str], table: np.ndarray) -> np.ndarray:
    value = np.zeros(len(parts))
    for places, keys, weight, norms in _by_length(parts):
        value[places] = (table[keys] @ weight) / norms
    return value


def margins(words: Iterable[str], table: np.ndarray, bias: float) -> list[float]:
    """The machine's margin for each word: the largest of its windows'; below all others without one."""
    parts, owner = [], []
    words = list(words)
    for i, w in enumerate(words):
        for x in _windows(w):
            parts.append(x)
            owner.append(i)
    value = _values(parts, table)
    out = np.full(len(words), -np.inf)
    np.maximum.at(out, owner, value)
    return (out + bias).tolist()


class Landmarks:
    """Nyström features of words: kernels with the landmarks times the inverse root of the landmarks' own."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.slot, rows = np.zeros(SIGNS**3, np.int64), {}
        for places, keys, weight, norms in _by_length(words):
            for i, k, n in zip(places, keys, norms):
                rows[i] = (k, weight / n)
        used = np.unique(np.concatenate([k for k, _ in rows.values()])) if rows else np.zeros(0, np.int64)
        self.used, self.slot[used] = used, np.arange(1, len(used) + 1)
        self.phi = np.zeros((len(used) + 1, len(words)), np.float32)
        for i, (k, w) in rows.items():
            np.add.at(self.phi[:, i], self.slot[k], w)
        gram = self.phi.T.astype(np.float64) @ self.phi
        size, axes = np.linalg.eigh(gram)
        keep = size > 1e-4
        self.root = axes[:, keep] / np.sqrt(size[keep])

    def kernels(self, words: list[str]) -> np.ndarray:
        kernel = np.zeros((len(words), len(self.words)))
        for places, keys, weight, norms in _by_length(words, 400):
            kernel[places] = np.einsum("nck,c->nk", self.phi[self.slot[keys]], weight, optimize=True) / norms[:, None]
        return kernel

    def features(self, words: list[str]) -> np.ndarray:
        return self.kernels(words) @ self.root

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """The table of triple weights that a linear machine on the features comes to."""
        table = np.zeros(SIGNS**3, np.float32)
        table[self.used] = (self.phi @ (self.root @ weights))[1:]
        return table


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """(weights, bias) of a linear machine with squared hinge loss, by Newton steps on the primal; y is -1 or 1.

    The loss is quadratic as long as the same rows are within the margin, so steps end when these no longer change.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3

    def loss(v: np.ndarray) -> float:
        short = np.maximum(0, 1 - y * (x @ v))
        return float(v @ ridge @ v + (cost * short * short).sum())

    for _ in range(rounds):
        near = y * (x @ w) < 1
        part, weight = x[near], cost[near]
        best = np.linalg.solve(ridge + (part * weight[:, None]).T @ part, (part * (weight * y[near])[:, None]).sum(axis=0))
        step, rate = best - w, 1.0
        while rate > 1e-3 and loss(w + rate * step) > loss(w):
            rate /= 2
        w = w + rate * step
        if np.array_equal(near, y * (x @ w) < 1):
            break
    return w[:-1], float(w[-1])


def _core(words: Iterable[str]) -> set[str]:
    return {x for w in words for x in _windows(w) if len(x) >= 5}


def _witnesses(texts_: list[tuple[int, set[str]]], clean: Counter, toxic: Counter, bags: list[list[str]]) -> tuple[set[str], list[str]]:
    """(witnesses, seeds): seeds are words whose likes are in many toxic texts and in few clean ones.

    Greedily, each seed covers the most toxic texts that none covers yet. The words of toxic texts that are like a
    seed, and that no clean text has, are the witnesses. A word that is in toxic texts by chance has no such likes.
    """
    offered = [w for w, _ in sorted(toxic.items(), key=lambda p: (-p[1], p[0]))[:CANDIDATES]]
    marks = Landmarks(offered)

    def like(words: list[str]) -> np.ndarray:
        kernel = marks.kernels(words)
        return np.hstack([kernel >= least for least in LIKE])

    every, usual = sorted(toxic), sorted(clean)
    near, hits = like(every), np.zeros(len(LIKE) * len(offered))
    at = {w: i for i, w in enumerate(every)}
    covers = np.array([near[[at[w] for w in bag]].any(axis=0) for bag in bags])
    near_clean, place = like(usual), {w: i for i, w in enumerate(usual)}
    calm = [ws for y, ws in texts_ if not y and ws]
    for ws in calm:
        hits += near_clean[[place[w] for w in ws]].any(axis=0)
    telling = covers.mean(axis=0) >= 4 * hits / len(calm)
    left, seeds = np.ones(len(bags), bool), []
    while len(seeds) < 2 * CANDIDATES // 3:
        gain = covers[left].sum(axis=0) * telling
        if gain.max(initial=0) < (max(2, len(bags) // 100) if seeds else 1):
            break
        seeds.append(int(gain.argmax()))
        left &= ~covers[:, seeds[-1]]
    alone = [i + (len(LIKE) - 1) * len(offered) for i, w in enumerate(offered) if toxic[w] >= max(3, len(bags) // 20)]
    chosen = near[:, seeds + alone].any(axis=1)
    named = [offered[i % len(offered)] for i in seeds + alone]
    return {w for w, c in zip(every, chosen.tolist()) if c}, list(dict.fromkeys(named))


def learn(rows: list[tuple[int, list[str]]]) -> tuple[np.ndarray, float, float, float]:
    """(table, bias, slope, shift) from (label, words); score = logistic(slope * margin + shift).

    A sentence's label says that some word of it is toxic, or none. So the words of toxic texts that no clean text has
    are candidates; those whose likes recur across toxic texts, and not across clean ones, are its witnesses.
    Clean words that score highest are taken up as negatives in turn. Without both labels nothing is learned: all
    scores are low.
    """
    texts_ = [(y, _core(w)) for y, w in rows]
    clean = Counter(w for y, ws in texts_ if not y for w in ws)
    toxic = Counter(w for y, ws in texts_ if y for w in ws if w not in clean)
    bags = [[w for w in ws if w in toxic] for y, ws in texts_ if y]
    bags = [b for b in bags if b]
    if not clean or not bags:  # nothing tells the classes apart
        return np.zeros(SIGNS**3, np.float32), -1.0, 4.0, 0.0
    positive_set, seeds = _witnesses(texts_, clean, toxic, bags)
    positive = seeds + sorted(positive_set.difference(seeds), key=lambda w: (-toxic[w], w))
    usual = [w for w, _ in sorted(clean.items(), key=lambda p: (-p[1], p[0]))]
    draw = np.random.default_rng(5)
    negative = usual[:3000] + [usual[i] for i in sorted(draw.choice(np.arange(min(3000, len(usual)), len(usual)), min(4000, max(len(usual) - 3000, 0)), replace=False).tolist())]
    half = LANDMARKS // 2
    marks = Landmarks(sorted({*positive[:half], *negative[:: max(1, len(negative) // half)][:half]}))
    for turn in range(3):
        p, n = sorted(positive_set), sorted(set(negative))
        x, y = marks.features(p + n), np.array([1.0] * len(p) + [-1.0] * len(n))
        weights, bias = svm(x, y, np.array([4.0 * min(toxic[w], 100) for w in p] + [float(min(clean[w], 50)) for w in n]))
        table = marks.folded(weights)
        if turn == 2:
            break
        value = dict(zip(usual, _values(usual, table)))
        negative += sorted(usual, key=lambda w: (-value[w], w))[:1500]
    most = np.array([max((_values(sorted(ws), table) + bias).tolist(), default=-1.0) for _, ws in texts_])
    slope, shift = _logistic(most, np.array([y for y, _ in rows], float))
    return table, bias, slope, shift


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps; classes count alike, with a small penalty on the slope."""
    w = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        g, h = w * (p - y), w * p * (1 - p) + 1e-9
        grad = np.array([g @ x + 0.05 * a, g.sum()])
        hess = np.array([[h @ (x * x) + 0.05, h @ x], [h @ x, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
    return float(max(a, 0.1)), float(b)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, limit: int = LEARNED) -> tuple[np.ndarray, float, float, float]:
    """The driver gets the distinct words of at most twice ``limit`` whole documents."""
    arrow(docs.sparkSession)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            words = ["\n".join(sorted(units(t))) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), pa.array(words, pa.string())], names=["label", "words"])

    got = sample(docs, labels, "toxic", may_learn, limit).mapInArrow(run, "label int, words string").distinct().toArrow()
    rows = sorted(zip(got.column("label").to_pylist(), got.column("words").to_pylist()))
    return learn([(int(y), w.split("\n")) for y, w in rows])


_known: dict[str, float] = {}
#: Of which model they are.
_of: list[str | None] = [None]


def score(docs: DataFrame, model: tuple[np.ndarray, float, float, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score from 0 to 1, worst_word): one row per row of docs, over all words of each text.

    Null texts count as empty; a text without words of three characters or more has a low score. The model is of fixed
    size (2^18 weights of 4 bytes), broadcast once; workers remember the margins of a bounded number of words.
    """
    spark = arrow(docs.sparkSession)
    held = spark.sparkContext.broadcast((uuid.uuid4().hex, *model))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, table, bias, slope, shift = held.value
        if _of[0] != name:
            _of[0] = name
            _known.clear()
        for batch in found:
            bags = [units(t) for t in texts(batch)]
            if len(_known) > REMEMBERED:
                _known.clear()
            new = list(set().union(*bags).difference(_known))
            _known.update(zip(new, margins(new, table, bias)))
            worst = [max(b, key=_known.__getitem__, default=None) for b in bags]
            most = np.array([-3.0 if w is None else max(_known[w], -3.0) for w in worst])
            out = 1 / (1 + np.exp(-np.clip(slope * most + shift, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out), pa.array(worst, pa.string())], names=["id", "score", "worst_word"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double, worst_word string").withColumnRenamed("id", id_col)


def judged(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Null and empty texts get the lowest score. Rows without an id are scored and not held out; their id may have any type.
    Repeated rows are scored alike, as often as they come. Other columns are not read. Without labels of both classes all
    scores are low; an empty table gives no rows.
    """
    fold = remainder(F.col("doc_id"), folds)
    scored = score(docs, fit(docs, labels, fold != held))
    return scored.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
