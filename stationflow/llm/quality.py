"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each text gives a vector of statistics, transformed to be nearly normal. Each class has a mean and a covariance,
shrunk first towards the pooled covariance, then towards a multiple of the identity. A score compares the classes'
log-densities: Mahalanobis distances by Cholesky factors that are worked out once, and log-determinants.

The fit needs sums only (count, sum, sum of products for each class), which Spark adds up over all training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import bounded_batches, id_and_text, lower_ascii, pieces, stored, utf8, words_of

#: Weight of the pooled covariance, and then of the identity. Besides, the pooled one counts as that of ROWS rows of
#: each class, which matters for a class with few.
POOLED, ROUND, ROWS = 0.1, 0.02, 50

_SPACE = np.ones(256, bool)
_SPACE[0x09:0x0E] = _SPACE[0x20] = False


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


CLASSES = {
    "upper": _flags(bytes(range(65, 91))), "lower": _flags(bytes(range(97, 123))), "digit": _flags(b"0123456789"),
    "space": ~_SPACE, "stop": _flags(b"."), "comma": _flags(b","), "bang": _flags(b"!?"), "bar": _flags(b"|<>{}[]=_/\\~^"),
    "sign": _flags(b"#$%&*+@"), "quote": _flags(b"\"'`:;()-"), "wide": _flags(bytes(range(0xC0, 256))),
}
FEATURES = [*CLASSES, "chars", "words", "lines", "word_length", "word_spread", "distinct", "distinct_pairs", "top_word", "capital", "marked", "long_word", "line_repeat"]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _distinct(values: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how often its commonest one comes."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.append(True, (v[1:] != v[:-1]) | (r[1:] != r[:-1])) if len(v) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, r[at], np.diff(np.append(at, len(v))).astype(float))
    return np.bincount(r[at], minlength=n).astype(float), most


def statistics(column: pa.Array) -> np.ndarray:
    """FEATURES of each text; an empty text has all shares 0."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    words = words_of(data, offsets, _SPACE, lower_ascii())
    lines = words_of(data, offsets, ~_flags(b"\n"))
    size = np.diff(offsets).astype(float)
    count, line_count = np.diff(words.first).astype(float), np.diff(lines.first).astype(float)
    some, at_least = np.maximum(size, 1), np.maximum(count, 1)
    length = (words.end - words.start).astype(float)
    total = np.bincount(words.row, length, minlength=n)
    squares = np.bincount(words.row, length**2, minlength=n)
    mean = total / at_least
    distinct, most = _distinct(words.hash, words.row, n)
    same = words.row[1:] == words.row[:-1]
    pairs = words.hash[1:] * np.uint64(0x9E3779B97F4A7C15) + words.hash[:-1]
    distinct_pairs, _ = _distinct(pairs[same], words.row[1:][same], n)
    distinct_lines, _ = _distinct(lines.hash, lines.row, n)
    first, last = data[words.start], data[words.end - 1]
    share = lambda flags: np.bincount(words.row, flags, minlength=n) / at_least
    columns = [np.sqrt(_per_row(flags[data], offsets) / some) for flags in CLASSES.values()]
    columns += [
        np.log1p(size), np.log1p(count), np.log1p(line_count), np.log1p(mean), np.log1p(np.maximum(squares / at_least - mean**2, 0)),
        distinct / at_least, distinct_pairs / np.maximum(count - 1, 1), np.sqrt(most / at_least),
        np.sqrt(share((first >= 65) & (first <= 90))), np.sqrt(share(CLASSES["sign"][last] | CLASSES["bang"][last])),
        np.sqrt(share(length > 20)), np.sqrt(1 - distinct_lines / np.maximum(line_count, 1)),
    ]
    return np.stack(columns, axis=1)


def statistics_table(docs: DataFrame) -> DataFrame:
    """doc_id and features of every row."""
    bounded_batches(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = statistics(batch.column("text"))
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], ["doc_id", "features"])

    return id_and_text(docs).mapInArrow(measure, "doc_id long, features array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Of classes 0 and 1: prior's logarithm, mean, inverse Cholesky factor, log-determinant; features are scaled first."""

    centre: np.ndarray
    scale: np.ndarray
    prior: np.ndarray
    mean: np.ndarray
    inverse: np.ndarray
    logdet: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = [p - 0.5 * (((z - m) @ i.T) ** 2).sum(axis=1) - 0.5 * d for p, m, i, d in zip(self.prior, self.mean, self.inverse, self.logdet, strict=True)]
        return density[1] - density[0]


def discriminant(n: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float, rounded: float, rows: float) -> Discriminant | None:
    """From the classes' counts, sums and sums of products. None if there are no rows; a class without rows has the other's spread."""
    if not n.sum():
        return None
    centre = sums.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(products.sum(axis=0)) / n.sum() - centre**2, 1e-9))
    width = len(centre)
    mean = np.stack([(s / c - centre) / scale if c else np.zeros(width) for c, s in zip(n, sums, strict=True)])
    spread = np.stack([((p - np.outer(s, s) / c) / np.outer(scale, scale)) if c else np.zeros((width, width)) for c, s, p in zip(n, sums, products, strict=True)])
    common = spread.sum(axis=0) / n.sum()
    inverse, logdet = [], []
    for c, s in zip(n, spread, strict=True):
        own = (s + rows * common) / (c + rows) if c else common
        own = (1 - pooled) * own + pooled * common
        own = (1 - rounded) * own + rounded * max(np.trace(own) / width, 1e-6) * np.eye(width)
        factor = np.linalg.cholesky(own)
        inverse.append(np.linalg.inv(factor))
        logdet.append(2 * np.log(np.diag(factor)).sum())
    return Discriminant(centre, scale, np.log((n + 1) / (n.sum() + 2)), mean, np.stack(inverse), np.array(logdet))


def held_out(doc_id="doc_id"):
    """Rows that no model learns from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def fit(features: DataFrame, labels: DataFrame, pooled: float = POOLED, rounded: float = ROUND, rows: float = ROWS) -> Discriminant | None:
    """Rows of features with a label 0 or 1 that are not held out; a row counts once for each of its labels."""
    width = len(FEATURES)
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    labelled = features.where(~held_out()).join(known, "doc_id").select("quality", "features")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            x = np.asarray(batch.column("features").flatten()).reshape(-1, width)
            kind = np.asarray(batch.column("quality"))
            for k in (0, 1):
                own = x[kind == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        at = np.arange(total.shape[1], dtype=np.int32)
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(total[k])], ["quality", "place", "value"])

    # One row for each class and cell, however many rows there are.
    sums = labelled.mapInArrow(add, "quality int, place int, value double").groupBy("quality", "place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((2, 1 + width + width * width))
    for r in sums:
        total[r["quality"], r["place"]] = r["value"]
    return discriminant(total[:, 0], total[:, 1 : 1 + width], total[:, 1 + width :].reshape(2, width, width), pooled, rounded, rows)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs; null and empty texts are scored by their statistics,
    and without any label to learn from all scores are 0.5.

    The score is the logistic of the log-density difference over the number of features, as statistics
    of one text are not independent and the plain difference would round to 0 or 1. Its side of 0.5 stays the same.
    """
    spark = docs.sparkSession
    features = stored(statistics_table(docs), "statistics")
    model = spark.sparkContext.broadcast(fit(features, labels))
    width = len(FEATURES)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("features").flatten()).reshape(-1, width)
            odds = model.value.log_odds(x) / width if model.value else np.zeros(len(x))
            p = 0.5 * (1 + np.tanh(odds / 2))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = features.mapInArrow(score, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
