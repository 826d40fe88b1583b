"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each class is a Gaussian over transformed statistics of the whole text. Its covariance is
shrunk towards the covariance pooled over both classes and towards a multiple of the
identity. A score is the logistic of the difference of the two log densities, each a
Mahalanobis distance through a Cholesky factor that is computed once.

Contract. NULL text is empty text and is scored like any other. Rows without a label, or
with a NULL one, teach nothing; a document with several labels counts with its largest.
If one class has no labelled rows every score is the share of the other class, 0.5 without
any label. Repeated rows and ties get equal scores. Other columns are left alone.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.llm.common import map_batches, texts, with_batch_column

FEATURES = (
    "words", "word_length", "distinct_words", "same_as_last", "windows_repeated", "lines_repeated",
    "upper", "digits", "symbols", "exclaims", "punctuation", "other_ascii", "words_with_symbols",
)
RATES = slice(2, None)
"""Statistics between 0 and 1, which are spread out by a logarithm of the odds."""

SYMBOL = re.compile(rb"[#*$%&|<>]")
UPPER, DIGIT, EXCLAIM, POINT = (bytes(range(65, 91)), bytes(range(48, 58)), b"!", b".,;:?-'\"()")
PLAIN = bytes(range(97, 123)) + UPPER + DIGIT + POINT + b" \t\n\r\x0b\x0c!" + bytes(range(128, 256))


def statistics(text: bytes) -> list[float]:
    """Plain statistics of one text, in the order of ``FEATURES``."""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    if not n:
        return [0.0] * len(FEATURES)
    lines = [line for line in text.split(b"\n") if line.strip()]
    count = lambda chars: size - len(text.translate(None, chars))
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = sum(c for c in windows.values() if c > 1)
    marks = len(SYMBOL.findall(text))
    return [
        float(n),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        repeated / n,
        1 - len(set(lines)) / len(lines),
        count(UPPER) / size,
        count(DIGIT) / size,
        marks / size,
        count(EXCLAIM) / size,
        count(POINT) / size,
        len(text.translate(None, PLAIN)) / size,
        min(1.0, marks / n),
    ]


def transformed(rows: list[list[float]]) -> np.ndarray:
    """Counts by logarithm, rates by log odds with a floor of one in two hundred."""
    x = np.array(rows, float).reshape(len(rows), len(FEATURES))
    x[:, :2] = np.log1p(x[:, :2])
    rate = np.clip(x[:, RATES], 0, 1)
    x[:, RATES] = np.log((rate + 0.005) / (1 - rate + 0.005))
    return x


def feature_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, features array<double>) of every whole text."""
    kind = docs.schema[key].dataType

    def run(batch: pa.RecordBatch) -> dict:
        x = transformed([statistics(t) for t in texts(batch, text)])
        offsets = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
        return {"features": pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))}

    schema = T.StructType([T.StructField(key, kind), T.StructField("features", T.ArrayType(T.DoubleType()))])
    return map_batches(docs.select(key, text), run, schema)


@dataclass
class Discriminant:
    """Two Gaussians: means, inverses of Cholesky factors, half log determinants, log prior odds."""

    means: np.ndarray
    factors: np.ndarray
    halves: np.ndarray
    odds: float
    share: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(x), self.share)
        logs = [
            -0.5 * np.square((x - self.means[c]) @ self.factors[c].T).sum(1) - self.halves[c] for c in (0, 1)
        ]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.odds, -500, 500)))


def fit(features: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", shrink: float = 0.05, flat: float = 0.02) -> Discriminant:
    """Fit on all rows of ``features`` with a label; moments are summed where the rows are.

    ``shrink`` is the weight of the pooled covariance, ``flat`` that of the identity. What
    comes to the driver is one row per class.
    """
    p = len(FEATURES)
    known = labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias("_label"))
    rows = features.join(known, key).select((F.col("_label") > 0).cast("int").alias("c"), F.col("features").alias("x"))
    cells = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(p)] + [
        F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i + 1)
    ]
    sums = {r["c"]: r for r in rows.groupBy("c").agg(F.count("*").alias("n"), *cells).collect()}
    if len(sums) < 2:
        share = 0.5 if not sums else float(next(iter(sums)))
        return Discriminant(np.zeros((2, p)), np.zeros((2, p, p)), np.zeros(2), 0.0, share)
    n = np.array([sums[c]["n"] for c in (0, 1)], float)
    means = np.array([[sums[c][f"s{i}"] for i in range(p)] for c in (0, 1)]) / n[:, None]
    squares = np.array([[[sums[c][f"s{max(i, j)}_{min(i, j)}"] for j in range(p)] for i in range(p)] for c in (0, 1)])
    own = squares / n[:, None, None] - np.einsum("ci,cj->cij", means, means)
    pooled = (n[:, None, None] * own).sum(0) / n.sum()
    factors, halves = [], []
    for c in (0, 1):
        s = (1 - shrink) * own[c] + shrink * pooled
        s = (1 - flat) * s + flat * max(np.trace(pooled) / p, 1e-6) * np.eye(p)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        halves.append(np.log(np.diag(low)).sum())
    return Discriminant(means, np.array(factors), np.array(halves), float(np.log(n[1] / n[0])))


def score_features(features: DataFrame, model: Discriminant, key: str = "doc_id", out: str = "score") -> DataFrame:
    """(key, score) from stored features."""

    def run(batch: pa.RecordBatch) -> dict:
        column = batch.column(batch.schema.get_field_index("features"))
        return {out: pa.array(model.score(column.flatten().to_numpy().reshape(len(column), -1)))}

    schema = T.StructType([T.StructField(key, features.schema[key].dataType), T.StructField(out, T.DoubleType())])
    return map_batches(features, run, schema)


def with_score(docs: DataFrame, model: Discriminant, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of every whole text."""
    return with_batch_column(
        docs, out, T.DoubleType(), lambda batch: pa.array(model.score(transformed([statistics(t) for t in texts(batch, text)])))
    )


def good(score: Column, threshold: float = 0.7) -> Column:
    return score >= threshold
