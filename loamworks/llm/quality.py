"""Quality scores by regularised quadratic discriminant analysis (operator 6).

A text becomes ``len(NAMES)`` statistics, transformed to be near normal. Each
class gets a mean and a covariance that is shrunk towards the pooled one and
towards a multiple of the identity. The score is the logistic function of the
difference of the log densities and priors; the Mahalanobis distances use the
inverse Cholesky factors, computed once and kept in the model.

Labels are learnt from a bounded sample of labelled rows, about
``SAMPLE_ROWS`` chosen by a hash of the id; every text is scored whole.

Cases: a null or empty text has the statistics of zero words and is scored
like any other; rows of a null label or id are not learnt from; with fewer
than two classes the score is the share of label 1, 0.5 without labels; labels
of a document that disagree count each, a repeated one once; repeated rows have equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_pass, fold_bucket, table, text_of

FOLDS, HELD_OUT = 3, 1
SAMPLE_ROWS = 12_000
#: Labels that are broadcast.
MOST_BROADCAST = 3 * SAMPLE_ROWS
#: Weights of the pooled covariance and of the identity.
POOLED, IDENTITY = 0.15, 0.02
NAMES = (
    "log words", "word length", "upper", "digits", "marks", "bangs", "bars", "other signs", "stops", "commas",
    "lines", "distinct words", "repeats", "capital words", "signed words", "distinct lines", "high bytes",
)
_CLASS = np.zeros((256, 9))
_CLASS[65:91, 0] = 1
_CLASS[48:58, 1] = 1
_CLASS[[ord(c) for c in "#$%&*"], 2] = 1
_CLASS[ord("!"), 3] = 1
_CLASS[ord("|"), 4] = 1
_CLASS[[ord(c) for c in "@^~_=+<>{}[]\\/\"'();:?-"], 5] = 1
_CLASS[ord("."), 6] = 1
_CLASS[ord(","), 7] = 1
_CLASS[128:192, 8] = 1  # continuation bytes


def statistics(text: str) -> list[float]:
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS
    words = data.split()
    n, size = len(words), max(len(data), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
    few = max(n, 1)
    capitals = sum(map(bytes.isupper, words))
    signed = n - sum(map(bytes.isalnum, (w.rstrip(b".,") for w in words)))
    root = math.sqrt
    return [
        math.log1p(n), math.log1p(size / few), root(counts[0] / size), root(counts[1] / size), root(counts[2] / size),
        root(counts[3] / size), root(counts[4] / size), root(counts[5] / size), root(counts[6] / few),
        root(counts[7] / few), math.log1p(100 * data.count(b"\n") / few), root(len(set(words)) / few) * math.log1p(few),
        root(repeats / few), root(capitals / few), root(signed / few), len(set(lines)) / max(len(lines), 1),
        root(counts[8] / size),
    ]


class Model:
    """Means, inverse Cholesky factors and constants of the two classes."""

    def __init__(self, n: np.ndarray, total: np.ndarray, outer: np.ndarray):
        """n, sums and sums of outer products by class."""
        self.flat = None
        if n.sum() == 0 or (n < 2).any():
            self.flat = float(n[1] / n.sum()) if n.sum() else 0.5
            return
        d = total.shape[1]
        mean = total / n[:, None]
        cov = [outer[k] / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]
        pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
        # Scale to unit pooled variance first, so that the identity is fair to all statistics.
        self.scale = 1 / np.sqrt(np.maximum(np.diag(pooled), 1e-8))
        self.mean = mean * self.scale
        s = np.outer(self.scale, self.scale)
        self.inverse, self.constant = [], []
        for k in (0, 1):
            own = s * ((1 - POOLED - IDENTITY) * cov[k] + POOLED * pooled) + IDENTITY * np.eye(d)
            factor = np.linalg.cholesky(own)
            self.inverse.append(np.linalg.inv(factor))
            self.constant.append(math.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(x), self.flat)
        log = [
            c - 0.5 * ((((x * self.scale) - m) @ f.T) ** 2).sum(1)
            for c, m, f in zip(self.constant, self.mean, self.inverse, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learns from documents with labels (0 or 1), of which a bounded sample is used."""
    own = labels.select(F.col("doc_id").alias("label_id"), F.col(label_col).cast("int").alias("y"))
    own = own.filter("label_id IS NOT NULL AND y IN (0, 1)")
    share = min(1.0, SAMPLE_ROWS / max(own.count(), 1))
    own = own.filter(F.pmod(F.xxhash64(F.col("label_id").cast("string"), F.lit(6)), F.lit(1 << 30)) < int(share * (1 << 30)))
    own = own.distinct()
    # About SAMPLE_ROWS, or twice as many where labels disagree; more than that, left to chance, are joined by a shuffle.
    side = F.broadcast(own) if own.count() <= MOST_BROADCAST else own
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.join(side, F.col("doc_id") == F.col("label_id")).select("text", "y")
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, outer = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(0)]).reshape(-1, d)
            y = batch.column(1).to_numpy()
            for k in (0, 1):
                own = x[y == k]
                n[k] += len(own)
                total[k] += own.sum(0)
                outer[k] += own.T @ own
        flat = np.concatenate([n, total.ravel(), outer.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["k", "v"])

    sums = arrow_pass(rows, run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
    v = np.zeros(2 + 2 * d + 2 * d * d)
    for r in sums:
        v[r.k] = r.v
    return Model(v[:2], v[2 : 2 + 2 * d].reshape(2, d), v[2 + 2 * d :].reshape(2, d, d))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score and predicted of every row; the columns of keep follow."""
    narrow = docs.select(F.col(id_col).alias("__row_id"), text_of(text_col).alias("__row_text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)]).reshape(-1, len(NAMES))
            score = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), *batch.columns[2:]],
                ["doc_id", "score", "predicted", *keep],
            )

    kinds = dict(narrow.dtypes)
    more = "".join(f", `{c}` {kinds[c]}" for c in keep)
    return arrow_pass(narrow, run, f"doc_id {kinds['__row_id']}, score double, predicted int{more}")


def training(labels: DataFrame) -> DataFrame:
    return labels.filter(fold_bucket("doc_id", FOLDS) != HELD_OUT)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs, training(table(spark, sf_dir, "labels"))))
    held = F.coalesce(fold_bucket("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
