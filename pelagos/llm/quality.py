"""Quality classifier: hashed word n-gram logistic regression, learned with follow-the-regularised-leader updates."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import arrow, texts
from .hashing import SIZE, features
from .labelled import remainder, sample

#: Labelled documents of each class that are learned from, at most.
LEARNED = 2000
PASSES = 4
THRESHOLD = 0.3


class Ftrl:
    """Follow the regularised leader, per coordinate, with L1 and L2 terms."""

    def __init__(self, size: int = SIZE, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n, self.bias = np.zeros(size), np.zeros(size), [0.0, 0.0]

    def _at(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def _bias(self) -> float:
        return -self.bias[0] / ((self.beta + self.bias[1] ** 0.5) / self.alpha + self.l2)

    def learn(self, numbers: np.ndarray, values: np.ndarray, label: int, weight: float = 1.0) -> None:
        z, n = self.z[numbers], self.n[numbers]
        w, b = self._at(z, n), self._bias()
        g0 = weight * (1 / (1 + np.exp(-np.clip(w @ values + b, -35, 35))) - label)
        g = g0 * values
        self.z[numbers] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[numbers] = n + g * g
        self.bias[0] += g0 - ((self.bias[1] + g0 * g0) ** 0.5 - self.bias[1] ** 0.5) / self.alpha * b
        self.bias[1] += g0 * g0

    def model(self) -> tuple[np.ndarray, float]:
        return self._at(self.z, self.n).astype(np.float32), self._bias()


def learn(rows: list[tuple[int, np.ndarray, np.ndarray]], passes: int = PASSES) -> tuple[np.ndarray, float]:
    """(weights, bias) from (label, numbers, values). No rows: all weights are zero.

    Good documents count twice what bad ones do in all: what the model knows nothing of is rather kept.
    """
    ftrl, order = Ftrl(), np.random.default_rng(7)
    ones = sum(r[0] for r in rows)
    weight = [len(rows) / (2 * max(len(rows) - ones, 1)), len(rows) / max(ones, 1)]
    for _ in range(passes):
        for i in order.permutation(len(rows)).tolist():
            y, numbers, values = rows[i]
            ftrl.learn(numbers, values, y, weight[y])
    return ftrl.model()


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, limit: int = LEARNED) -> tuple[np.ndarray, float]:
    """Features are made where the documents are; the driver gets those of at most twice ``limit`` documents."""
    arrow(docs.sparkSession)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            made = [features(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").cast(pa.int32()), pa.array([m[0].astype(np.int32).tobytes() for m in made], pa.binary()), pa.array([m[1].astype(np.float32).tobytes() for m in made], pa.binary())],
                names=["label", "numbers", "values"],
            )

    got = sample(docs, labels, "quality", may_learn, limit).mapInArrow(run, "label int, numbers binary, values binary").toArrow()
    columns = [got.column(c).to_pylist() for c in got.column_names]
    rows = sorted(zip(*columns), key=lambda r: (zlib.crc32(r[1]), *r))
    return learn([(int(r[0]), np.frombuffer(r[1], np.int32), np.frombuffer(r[2], np.float32).astype(np.float64)) for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """docs with a column ``score`` from 0 to 1 (a column of that name is replaced); every row stays.

    A text's score is a sparse dot product over all its features. Null texts count as empty; empty texts get the
    bias alone. The model is of fixed size (2^18 weights of 4 bytes), broadcast once.
    """
    spark = arrow(docs.sparkSession)
    docs = docs.drop("score")
    held = spark.sparkContext.broadcast(model)
    schema, at = StructType([*docs.schema.fields, StructField("score", DoubleType())]), docs.columns.index(text_col)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = held.value
        for batch in found:
            made = [features(t) for t in [x or "" for x in batch.column(at).to_pylist()]]
            x = np.array([float(weights[n] @ v) if len(n) else 0.0 for n, v in made])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(x + bias, -35, 35))))], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Null texts count as empty, and empty ones get the bias's score. Rows without an id are scored and not held out; their
    id may have any type. Repeated rows are scored alike, as often as they come. Other columns are not read. Without
    labels of both classes all scores are alike; an empty table gives no rows.
    """
    may_learn = remainder(F.col("doc_id"), folds) != held
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, may_learn))
    return scored.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
