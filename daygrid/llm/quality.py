"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import per_row

#: Weight of the pooled diagonal in a class covariance.
SHRINKAGE = 0.05
#: Rows of the pooled covariance that count beside a class's own; few rows span no covariance.
POOLED_ROWS = 20
#: Rows of a class below which it has no covariance, so no discriminant is fitted.
LEAST_ROWS = 2

STATISTICS = (
    "log_bytes upper punctuation symbols exclamations bars digits herdan repeats lines word_length "
    "runs"
).split()

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LOWER = (_CODES >= 97) & (_CODES <= 122)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_PRINT = (_CODES > 32) & (_CODES < 127)
_OTHER = _PRINT & ~_UPPER & ~_LOWER & ~_DIGIT
_PROSE = np.isin(_CODES, [ord(c) for c in ".,;:'\"()-?!"])
_SYMBOL = _OTHER & ~_PROSE
_SPACE = np.isin(_CODES, [9, 10, 11, 12, 13, 32])


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text: logarithms, and arc sines of shares."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    lines = data.split(b"\n")
    inked = max(1, int(counts[~_SPACE].sum()))
    n = max(1, len(words))
    letters = max(1, int(counts[_UPPER].sum() + counts[_LOWER].sum()))
    codes = np.frombuffer(data, dtype=np.uint8)
    runs = int((codes[1:] == codes[:-1]).sum()) if len(codes) > 1 else 0
    shares = [
        counts[_UPPER].sum() / letters,
        counts[_OTHER].sum() / inked,
        counts[_SYMBOL].sum() / inked,
        counts[33] / inked,
        counts[124] / inked,
        counts[_DIGIT].sum() / inked,
    ]
    tail = [
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
    ]
    spread = np.log1p(len(set(words))) / np.log1p(n)
    arc = lambda share: float(np.arcsin(np.sqrt(share)))
    return [
        float(np.log1p(len(data))),
        *map(arc, shares),
        float(spread),
        *map(arc, tail),
        float(np.log1p(inked / n)),
        arc(runs / max(1, len(data))),
    ]


def held_out(id_col: Column) -> Column:
    """Whether a row's label is never learned from: crc32 of the id as text, remainder 1 by 3."""
    remainder = F.crc32(id_col.cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


@dataclass
class Discriminant:
    """Class log-densities by Mahalanobis distance; factors are computed once at fitting."""

    prior: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: np.ndarray | None = None
    #: Inverses of the Cholesky factors, lower triangular like these.
    factors: np.ndarray | None = None
    log_dets: np.ndarray | None = None

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        if self.centre is None:
            return np.full(len(rows), self.prior)
        x = (rows - self.centre) / self.scale
        logs = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            z = factor @ (x - mean).T
            logs.append(-0.5 * (z * z).sum(axis=0) - 0.5 * log_det)
        odds = logs[1] - logs[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _discriminant(moments: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> Discriminant:
    n0, n1 = (moments[k][0] if k in moments else 0 for k in (0, 1))
    prior = (n1 + 1) / (n0 + n1 + 2)
    if min(n0, n1) < LEAST_ROWS:
        return Discriminant(prior)
    total = n0 + n1
    centre = (moments[0][1] + moments[1][1]) / total
    second = (moments[0][2] + moments[1][2]) / total - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(second), 1e-8))
    means, covariances = [], []
    for k in (0, 1):
        n, first, outer = moments[k]
        mean = first / n
        means.append((mean - centre) / scale)
        covariances.append((outer / n - np.outer(mean, mean)) / np.outer(scale, scale))
    pooled = (n0 * covariances[0] + n1 * covariances[1]) / total
    target = np.diag(np.maximum(np.diag(pooled), 1e-3))
    covariances = [
        (moments[k][0] * c + POOLED_ROWS * pooled) / (moments[k][0] + POOLED_ROWS)
        for k, c in enumerate(covariances)
    ]
    factors = [np.linalg.cholesky((1 - SHRINKAGE) * c + SHRINKAGE * target) for c in covariances]
    log_dets = [2 * np.log(np.diag(f)).sum() for f in factors]
    inverses = [np.tril(np.linalg.inv(f)) for f in factors]
    return Discriminant(prior, centre, scale, np.array(means), np.array(inverses), np.array(log_dets))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Discriminant:
    """Discriminant of all labelled rows that aren't held out. ``labels`` has doc_id and quality.

    Moments are sums that Spark makes on all rows; two vectors and matrices of fixed size
    reach the driver. Labels other than 0 and 1 and null ids teach nothing. An id with
    repeated equal labels counts once, one with both labels teaches both. With fewer than
    LEAST_ROWS rows of either label no discriminant is fitted and every row scores the prior.
    """

    def make(batch):
        return {"doc_id": batch.column(0), "x": [statistics(t) for t in batch.column(1).to_pylist()]}

    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int"))
        .where("doc_id is not null and quality in (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .distinct()
    )
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    source = source.where("doc_id is not null").where(~held_out(F.col("doc_id")))
    rows = per_row(source, "doc_id long, x array<double>", make).join(marks, "doc_id")
    width = len(STATISTICS)
    x = [F.col("x")[i] for i in range(width)]
    cells = [(i, j) for i in range(width) for j in range(i, width)]
    sums = (
        rows.groupBy("quality")
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(c) for c in x]).alias("first"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in cells]).alias("second"),
        )
        .collect()
    )
    moments = {}
    for row in sums:
        outer = np.zeros((width, width))
        for (i, j), value in zip(cells, row["second"], strict=True):
            outer[i, j] = outer[j, i] = value
        moments[row["quality"]] = (row["n"], np.array(row["first"]), outer)
    return _discriminant(moments)


def score(docs: DataFrame, model: Discriminant, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts are scored too, as
    texts of no words. Rows that repeat are scored each and alike, also without an id; an empty table
    gives an empty result. Other columns are not read.
    """

    def make(batch):
        rows = np.array([statistics(t) for t in batch.column(1).to_pylist()])
        return {"doc_id": batch.column(0), "score": model.scores(rows)}

    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return per_row(source, "doc_id long, score double", make).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Discriminant, text_col: str = "text") -> DataFrame:
    """Rows whose text scores 0.5 or more, all rows if no discriminant was fitted; all columns stay."""
    if model.centre is None:
        return docs

    @F.pandas_udf("double")
    def probability(texts):
        import pandas as pd

        return pd.Series(model.scores(np.array([statistics(t) for t in texts]).reshape(len(texts), -1)))

    small = F.col(f"`{text_col}`")
    return docs.where(probability(small) >= 0.5)
