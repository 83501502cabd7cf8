"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics (log sizes, log odds of character classes,
word repetition). Per class, mean and covariance come from exact sums over all training rows;
the covariance is shrunk towards its own diagonal and a floor, and its Cholesky factor is kept.
The score is the posterior of label 1 from the two Mahalanobis log densities and the class shares.

Nothing but the text enters a score. Null and empty texts have the statistics of an empty text and a
score like any other. Rows with a null id score too, but are never trained on. A label other
than 0 or 1 is left out; a document labelled more than once counts once per label row. Repeated rows
score alike. If one class has no training rows every score is the other class (1 or 0); without any
labels every score is 0.5. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import SLICE_CHARS, narrow, text_bytes, whole_text
from tidemill.llm.words import mix, row_of, split_words, word_hashes

SHRINK = 0.05  # weight of the diagonal in a class covariance
FLOOR = 1e-3   # added to every variance
EDGE = 2e-3    # keeps log odds finite
THRESHOLD = 0.3
FOLDS = 5      # ids whose crc32 is divisible by this are held out

# Character classes by byte: lower, upper, beyond ASCII, digit, space, line end, exclamation, bar, symbol, stop, other.
_KINDS = np.full(256, 10, np.int64)
for _k, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "", "0123456789", " \t\v\f\r", "\n", "!", "|",
                             "#$%&*@^~=+<>_\\/", ".,;:?")):
    _KINDS[[ord(c) for c in _chars]] = _k
_KINDS[128:] = 2
N_KINDS = 11
# The shares of an ordinary text, which a short text's shares are drawn to as if it went on for so much longer.
USUAL = np.array([0.78, 0.02, 0.02, 0.003, 0.15, 0.005, 0.0005, 0.0005, 0.0005, 0.02, 0.002])
USUAL_LENGTH, USUAL_SPREAD, USUAL_AGAIN, USUAL_FRESH, USUAL_MARKED = 6.0, 9.0, 0.01, 0.8, 0.12
MORE_BYTES, MORE_WORDS = 100.0, 16.0
N_STATISTICS = N_KINDS + 7


def _odds(share: np.ndarray) -> np.ndarray:
    return np.log((share + EDGE) / (1 - share + EDGE))


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics of each row of a byte array, one row per text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(owner * N_KINDS + _KINDS[data], minlength=n * N_KINDS).reshape(n, N_KINDS)
    starts, ends, first = split_words(data, offsets)
    words = np.diff(first)
    hashes = word_hashes(data, starts, ends)
    of = row_of(first)
    count = lambda flags: np.bincount(of, weights=flags, minlength=n)
    lengths = ends - starts
    again = np.zeros(len(of), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    pair = np.zeros(len(of), bool)
    pair[2:] = (hashes[2:] == hashes[:-2]) & (of[2:] == of[:-2])
    keys = mix(hashes ^ mix(of.astype(np.uint64)))
    order = np.argsort(keys)
    fresh = np.zeros(len(of), bool)
    if len(of):
        keys = keys[order]
        fresh[order] = np.concatenate([[True], keys[1:] != keys[:-1]])
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    share = lambda total, usual: (total + MORE_WORDS * usual) / (words + MORE_WORDS)
    mean = share(count(lengths), USUAL_LENGTH)
    spread = np.maximum(share(count(lengths.astype(float) ** 2), USUAL_LENGTH ** 2 + USUAL_SPREAD) - mean ** 2, 0)
    return np.column_stack([
        _odds((kinds + MORE_BYTES * USUAL) / (sizes + MORE_BYTES)[:, None]),
        np.log1p(sizes), np.log(mean), np.log1p(np.sqrt(spread)), _odds(share(count(again), USUAL_AGAIN)),
        _odds(share(count(pair), USUAL_AGAIN)), _odds(share(count(fresh), USUAL_FRESH)),
        _odds(share(count(_KINDS[last] >= 6), USUAL_MARKED))])


def _measured(texts: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(texts)
    cuts = [0, *(np.flatnonzero(np.diff(offsets[1:] // SLICE_CHARS)) + 1).tolist(), len(texts)]
    parts = [measure(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in zip(cuts, cuts[1:]) if b > a]
    return np.concatenate(parts) if parts else np.zeros((0, N_STATISTICS))


@dataclass(frozen=True)
class Model:
    """What a score needs: per class the mean, the inverse Cholesky factor and the log determinant; log share of 1 over 0."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_odds: float
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logs = [-0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(1) - 0.5 * self.log_dets[c] for c in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.log_odds, -500, 500)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x array<double>): the statistics of every whole text."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def of(texts: pa.Array) -> pa.Array:
        x = _measured(texts)
        offsets = np.arange(len(x) + 1, dtype=np.int32) * N_STATISTICS
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))

    return whole_text(docs, id_col, text_col).select("id", of("text").alias("x"))


def held_out(id_col: Column) -> Column:
    """Ids that no model learns from: crc32 of the id as text is divisible by 5; null ids too."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit(measured: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """The model of all labelled rows outside the held-out fold, from one pass of exact sums."""
    known = narrow(labels, id=id_col, label=label_col).where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    rows = measured.join(known, "id").select(F.col("label").cast("int").alias("label"), "x")
    d = N_STATISTICS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label = np.asarray(batch.column(0))
            x = np.asarray(batch.column(1).flatten()).reshape(-1, d)
            for c in (0, 1):
                z = x[label == c]
                total[c] += np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
        place = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "value"])

    # A fixed number of rows per task, and of sums: two classes, their counts, sums and products.
    parts = rows.mapInArrow(sums, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(2 * (1 + d + d * d))
    for r in parts:
        total[r.place] = r.value
    total = total.reshape(2, -1)
    n = total[:, 0]
    if (n == 0).any():
        nothing = np.zeros(0)
        return Model(nothing, nothing, nothing, 0.0, 0.5 if not n.any() else float(n[1] > 0))
    means, factors, log_dets = [], [], []
    for c in (0, 1):
        mean = total[c, 1:1 + d] / n[c]
        cov = total[c, 1 + d:].reshape(d, d) / n[c] - np.outer(mean, mean)
        cov = (1 - SHRINK) * cov + SHRINK * np.diag(np.diag(cov)) + FLOOR * np.eye(d)
        chol = np.linalg.cholesky(cov)
        means.append(mean)
        factors.append(np.linalg.inv(chol))
        log_dets.append(2 * np.log(np.diag(chol)).sum())
    return Model(np.array(means), np.array(factors), np.array(log_dets), float(np.log(n[1] / n[0])))


def scored(measured: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(id, held_out, score, predicted) of measured documents."""

    @F.arrow_udf(T.DoubleType())
    def of(x: pa.Array) -> pa.Array:
        return pa.array(model.score(np.asarray(x.flatten()).reshape(-1, N_STATISTICS)))

    rows = measured.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), of("x").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keeps(model: Model, text: Column) -> Column:
    """Whether a text's score reaches the threshold: a filter that needs no join."""

    @F.arrow_udf(T.DoubleType())
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(_measured(texts)))

    return of(F.coalesce(text.cast("string"), F.lit(""))) >= THRESHOLD
