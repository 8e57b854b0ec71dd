"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a covariance of the transformed statistics. The covariance is
shrunk towards the pooled one and towards its own mean variance; its Cholesky factor is
computed once and travels with the model. A score is the logistic of the difference of
the two log densities, each a Mahalanobis distance and a log determinant.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from daystar.llm.tables import stored

#: Statistics of a text, in the order of `statistics`.
STATISTICS = (
    "log_words",
    "word_length",
    "upper_letters",
    "digits",
    "punctuation",
    "marked_words",
    "repeated_neighbours",
    "distinct_words",
    "top_word",
    "repeated_lines",
)

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0xC0)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
# Marks that prose has after a word, or within it.
_PROSE = np.isin(_BYTES, list(b" \t\n\r\x0b\x0c.,;:'\"-()"))
_MARK = ~(_LETTER | _DIGIT | _PROSE) & (_BYTES < 0x80)


def _log_odds(part, whole, usual=0.05, weight=10):
    """A share as log odds, as if `weight` more items had the usual share.

    Finite for every count; a text of a few words stays near what is usual.
    """
    return np.log((part + weight * usual) / (max(whole - part, 0) + weight * (1 - usual)))


def statistics(text):
    """Transformed statistics of a whole text; an empty one gives a finite vector too.

    Shares enter as smoothed log odds, lengths as logarithms, so that short texts lie near
    the middle and the classes are closer to normal.
    """
    words = text.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    letters, digits = int(counts[_LETTER].sum()), int(counts[_DIGIT].sum())
    marks = int(counts[_MARK].sum())
    seen = Counter(words)
    repeats = sum(map(eq, words, words[1:]))
    lines = [line for line in text.split("\n") if line]
    marked = sum(times for word, times in seen.items() if not word[-1].isalnum())
    return (
        np.log1p(n),
        np.log1p(letters / n) if n else 1.8,
        _log_odds(int(counts[_UPPER].sum()), letters, weight=40),
        _log_odds(digits, letters + digits, weight=40),
        _log_odds(marks, letters + marks, weight=40),
        _log_odds(marked, n, usual=0.15),
        _log_odds(repeats, n),
        np.log((len(seen) + 10) / (n**0.8 + 10)),
        _log_odds(max(seen.values(), default=1) - 1, n),
        _log_odds(len(lines) - len(set(lines)), len(lines)),
    )


def statistics_column(text="text"):
    """Array of the statistics of a text column; a null text counts as empty."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def measured(column):
        return column.map(lambda value: np.array(statistics(value)))

    return measured(F.coalesce(F.col(text), F.lit("")))


def matrix(rows):
    return np.array(list(rows), dtype=np.float64).reshape(len(rows), len(STATISTICS))


@dataclass(frozen=True)
class Model:
    """What scoring needs: per class the mean, the Cholesky factor and the log prior."""

    means: np.ndarray
    factors: np.ndarray
    log_priors: np.ndarray

    def log_odds(self, x):
        """Log density of class 1 less that of class 0, priors included."""
        both = []
        for mean, factor, prior in zip(self.means, self.factors, self.log_priors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            both.append(prior - 0.5 * (z * z).sum(axis=0) - np.log(np.diag(factor)).sum())
        return both[1] - both[0]

    def scores(self, x):
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -500, 500)))


def _moments(measured, statistics, label):
    """Per class: number, sums and products of the statistics, added up by Spark.

    A task turns what it reads into one block of sums per class, so all labelled rows
    count, no sample is needed, and the driver gets a few hundred numbers at any size.
    """
    size = len(STATISTICS)
    block = 1 + size + size * size

    def partial(batches):
        sums = np.zeros((2, block))
        for batch in batches:
            x = matrix(batch.column(0).to_pylist())
            y = np.array(batch.column(1).to_pylist())
            for k in (0, 1):
                own = x[y == k]
                sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(2 * block)), pa.array(sums.ravel())], names=["cell", "value"]
        )

    cells = (
        measured.select(statistics, F.col(label).cast("int"))
        .mapInArrow(partial, "cell long, value double")
        .groupBy("cell")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    sums = np.zeros(2 * block)
    for row in cells:
        sums[row.cell] = row.value
    sums = sums.reshape(2, block)
    return sums[:, 0], sums[:, 1 : size + 1], sums[:, size + 1 :].reshape(2, size, size)


def fit(measured, statistics="statistics", label="quality", shrink=0.3, ridge=0.1, prior=None):
    """Fit the discriminant on all rows of `measured` (columns `statistics`, `label` 0 or 1).

    `shrink` moves each class covariance towards the pooled one, `ridge` towards its mean
    variance (and adds a hundredth of that to the diagonal, so a statistic that never
    varies in a class cannot dominate). `prior` weighs the classes, by number of rows where it
    is not given. Rows with a null label
    are left out; a class without rows takes the other's place, so all scores are 0.5; no
    rows at all give 0.5 too. Repeated rows count as often as they occur.
    """
    n, sums, products = _moments(measured.where(F.col(label).isin(0, 1)), statistics, label)
    size = len(STATISTICS)
    if not n.all():
        factor = np.eye(size)
        return Model(np.zeros((2, size)), np.stack([factor, factor]), np.zeros(2))
    means = sums / n[:, None]
    own = [products[k] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    factors = []
    for covariance in own:
        shrunk = (1 - shrink) * covariance + shrink * pooled
        # By statistic: correlations fade, variances stay.
        shrunk = (1 - ridge) * shrunk + ridge * np.diag(np.diag(shrunk))
        shrunk += np.eye(size) * (0.01 * np.trace(shrunk) / size + 1e-6)
        factors.append(np.linalg.cholesky(shrunk))
    return Model(means, np.stack(factors), np.log(n / n.sum() if prior is None else prior))


def score_column(model, statistics):
    """Score of class 1, 0 to 1, of a column of statistics."""

    @F.pandas_udf(DoubleType())
    def score(column):
        return pd.Series(model.scores(matrix(column)))

    return score(statistics)


def held_out(doc_id="doc_id"):
    """True for the third of documents that training never sees; a null id is held out."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    return F.coalesce(fold == 1, F.lit(True))


def measure(docs):
    """doc_id and statistics of every row: the narrow table that labels are joined to.

    Written, so texts are measured once and never shuffled.
    """
    return stored(docs.select("doc_id", statistics_column().alias("statistics")), "statistics")


def train(measured, labels, **settings):
    """Fit on the measured documents that may be learned from.

    Labels are joined once per document: of several labels of one id the lowest counts.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    return fit(measured.join(known, "doc_id"), **settings)


def classify(docs, labels, **settings):
    """doc_id, held_out, score and predicted (1: score of 0.5 or more) per row of `docs`.

    Null and empty texts are scored by their statistics like others; an empty table gives
    no rows; other columns are never read.
    """
    measured = measure(docs)
    model = train(measured, labels, **settings)
    scored = measured.select(
        "doc_id",
        held_out().alias("held_out"),
        score_column(model, F.col("statistics")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs, labels, **settings):
    """Rows of `docs`, all columns, without those that the classifier rejects."""
    model = train(measure(docs), labels, **settings)
    return docs.where(score_column(model, statistics_column()) >= 0.5)
