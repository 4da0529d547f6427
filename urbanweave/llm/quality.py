"""Quality classifier: regularised quadratic discriminant analysis over transformed statistics of whole texts.

Each text gives :data:`STATISTICS` (shares of kinds of bytes, word lengths, repetition, ...), transformed so that they are roughly normal within
a class. For each class the mean and the covariance come from sums over *all* labelled training rows: every task adds up its own
rows, Spark adds the sums, and the driver sees two small matrices whatever the input. Covariances are shrunk towards the pooled
covariance and its diagonal. A score is the logistic of the difference of the two log densities plus the log prior odds;
Mahalanobis distances use inverse Cholesky factors that are computed once with the model.

Labels, language, source and id are no statistics. The texts are never shuffled, only their statistics are.

Defined cases: null and empty texts have the statistics of an empty text and get a score like any other; a row without id can't be
labelled but is scored; labels other than 0 and 1 are left out; an id labelled twice counts twice, repeated rows count as often
as they occur; with fewer than two training rows in either class every score is the share of label 1 (0.5 without labels); empty
tables give empty tables. Columns of the documents are passed by position, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanweave.llm.kernels import BROAD, Flat, distinct_in_owner, lists, pieces
from urbanweave.llm.shared import fresh

STATISTICS = ["log_bytes", "mean_word", "upper", "digit", "stop", "mark", "symbol", "non_ascii", "distinct", "repeated", "short", "long", "word_marks",
              "log_line", "capital_words", "sentence"]


def _bytes_in(*groups: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for g in groups for c in g]] = True
    return out


_UPPER = _bytes_in("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _bytes_in("0123456789")
_STOP = _bytes_in(".,;:'\"()-")
_MARK = _bytes_in("!?")
_SYMBOL = _bytes_in("#$%&*+/<=>@[\\]^_`{|}~")
_LETTER = _UPPER | _bytes_in("abcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Angular transform of a share, steadied for short texts."""
    return np.arcsin(np.sqrt(np.clip((part + 0.25) / (whole + 1.0), 0, 1)))


def statistics(flat: Flat) -> np.ndarray:
    """A row of :data:`STATISTICS` for each text of a piece."""
    first, raw = flat.first, flat.raw

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return np.diff(sums[first]).astype(float)

    size = np.diff(first).astype(float)
    words = flat.words(BROAD)
    n, owner = words.counts.astype(float), words.owner()
    hashes, lengths = words.hashes(), words.end - words.start

    def words_with(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=len(flat)).astype(float)

    same = np.zeros(len(words), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    distinct = np.bincount(owner[distinct_in_owner(owner, hashes)], minlength=len(flat)).astype(float)
    letters = count(_LETTER[raw])
    tail = raw[np.maximum(words.end - 1, 0)] if len(words) else np.empty(0, np.uint8)
    two = raw[np.minimum(words.start + 1, len(raw) - 1)] if len(words) else np.empty(0, np.uint8)
    shouted = _UPPER[raw[words.start]] & _UPPER[two] & (lengths > 1) if len(words) else np.empty(0, bool)
    lines = count(raw == 10) + 1
    return np.stack([
        np.log1p(size), np.log1p(letters / np.maximum(n, 1)), _share(count(_UPPER[raw]), letters), _share(count(_DIGIT[raw]), size),
        _share(count(_STOP[raw]), size), _share(count(_MARK[raw]), size), _share(count(_SYMBOL[raw]), size), _share(count(raw >= 128), size),
        _share(distinct, n), _share(words_with(same), n), _share(words_with(lengths <= 3), n), _share(words_with(lengths >= 12), n),
        _share(words_with(~_LETTER[tail] & ~_DIGIT[tail]), n), np.log1p(n / lines), _share(words_with(shouted), n), _share(words_with(tail == 46), n),
    ], axis=1)


@dataclass
class Discriminant:
    """Two Gaussians: for each class the mean, the inverse Cholesky factor of its covariance, and the log determinant."""

    prior: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    logs: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        density = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.factors[k].T
            density.append(-0.5 * np.einsum("ij,ij->i", z, z) - 0.5 * self.logs[k])
        odds = density[1] - density[0] + np.log(self.prior / (1 - self.prior))
        # the Gaussians are too sure far from both classes; a root keeps the order and leaves a graded score
        odds = np.sign(odds) * (np.sqrt(1 + 2 * np.abs(odds)) - 1)
        return 1 / (1 + np.exp(-odds))


def discriminant(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, pooled_share: float = 0.1,
                 diagonal_share: float = 0.05) -> Discriminant:
    """The model from counts (2), sums (2, d) and sums of outer products (2, d, d)."""
    total = counts.sum()
    if counts.min() < 2:
        return Discriminant(float(counts[1] / total) if total else 0.5)
    means = sums / counts[:, None]
    own = squares / counts[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (own * counts[:, None, None]).sum(axis=0) / total
    factors, logs = [], []
    for k in (0, 1):
        mixed = (1 - pooled_share) * own[k] + pooled_share * pooled
        mixed = (1 - diagonal_share) * mixed + diagonal_share * np.diag(np.diag(pooled)) + 1e-6 * np.eye(len(mixed))
        lower = np.linalg.cholesky(mixed)
        factors.append(np.linalg.inv(lower))
        logs.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(float(counts[1] / total), means, np.stack(factors), np.array(logs))


def document_statistics(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, x)`` of every document with an id."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, flat in pieces(batch.column(1)):
                x = statistics(flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(flat)), lists(x.ravel(), np.full(len(x), x.shape[1]))], names=["doc", "x"])

    known = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long"), F.col(text).cast("string"))
    return known.mapInArrow(measure, "doc long, x array<double>")


_PAIRS = [(i, j) for i in range(len(STATISTICS)) for j in range(i, len(STATISTICS))]


def label_sums(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column] | None = None, doc: str = "doc_id", text: str = "text",
               label_doc: str = "doc_id", label: str = "quality") -> DataFrame:
    """For each label the number of rows, the sums of the statistics, and those of the products of each pair of them.

    Spark adds them up: a second Python worker in each task would take as much memory again.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(label_doc).cast("long").alias("label_doc"), F.col(label).cast("int").alias("label"))
    if learn is not None:
        known = known.where(learn(F.col("label_doc")))
    met = document_statistics(docs, doc, text).join(known, F.col("doc") == F.col("label_doc"))
    sums = [f"sum(x[{i}])" for i in range(len(STATISTICS))] + [f"sum(x[{i}] * x[{j}])" for i, j in _PAIRS]
    return met.groupBy("label").agg(F.count(F.lit(1)), *map(F.expr, sums))


def fit(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column] | None = None, doc: str = "doc_id", text: str = "text",
        label_doc: str = "doc_id", label: str = "quality") -> Discriminant:
    """Learn from all labelled rows, or from those whose id meets ``learn``."""
    width = len(STATISTICS)
    counts, sums, squares = np.zeros(2), np.zeros((2, width)), np.zeros((2, width, width))
    for k, n, *values in label_sums(docs, labels, learn, doc, text, label_doc, label).collect():  # two rows
        counts[k], sums[k] = n, values[:width]
        for (i, j), value in zip(_PAIRS, values[width:], strict=True):
            squares[k, i, j] = squares[k, j, i] = value
    return discriminant(counts, sums, squares)


def score(docs: DataFrame, model: Discriminant, keep: Sequence[str], text: str = "text", name: str = "score") -> DataFrame:
    """Columns ``keep`` of every document and its score."""
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(name, T.DoubleType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(statistics(flat)) for _, flat in pieces(batch.column(len(batch.columns) - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(scores) if scores else np.empty(0))], names=schema.names)

    return docs.select(*keep, F.col(text).cast("string").alias(fresh(docs, "__text"))).mapInArrow(measure, schema)


def keep_good(docs: DataFrame, model: Discriminant, text: str = "text", least: float = 0.3) -> DataFrame:
    """The documents, in their own columns, whose score is at least ``least``."""
    name = fresh(docs, "__score")
    return score(docs, model, docs.columns, text, name).where(F.col(name) >= least).drop(name)
