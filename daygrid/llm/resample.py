"""Target-distribution importance resampling over hashed word n-grams.

Separators of a text are collapsed to single spaces. An overlapped regular expression with
boundary lookarounds then finds the span of every n-gram directly, and its bytes' CRC names the
bucket. A bucket's gain is the logarithm of how much more often the target has it; a
document's weight is its mean gain, and Gumbel noise from its id makes the draw.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrid.llm.common import free_names, per_row, staged

#: Buckets, the draw's share in percent, the fewest words of a drawn document, the noise's seed.
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024

# Fixed value: bytes that part words once A-Z are lower-cased; bytes of other letters are above.
_SEPARATORS = re.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _gram_pattern(n: int) -> regex.Pattern:
    """Spans of ``n`` words: begin and end at a space or the text's edge."""
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (n - 1))


class NgramHasher:
    """Buckets of all n-grams of ``least`` to ``most`` words, repeats included."""

    def __init__(self, buckets: int = BUCKETS, least: int = 1, most: int = 1):
        if not 1 <= least <= most or buckets < 1:
            raise ValueError("one bucket and one word at least")
        self.buckets = buckets
        self.patterns = [_gram_pattern(n) for n in range(least, most + 1)]
        self.type = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def hashed(self, text: str | None) -> tuple[int, np.ndarray]:
        """(words, bucket of every feature) of a whole text."""
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        line = _SEPARATORS.sub(b" ", data).strip(b" ")
        if not line:
            return 0, np.zeros(0, self.type)
        parts = [
            np.fromiter(
                (crc32(line[m.start() : m.end()]) % self.buckets for m in p.finditer(line, overlapped=True)),
                self.type,
            )
            for p in self.patterns
        ]
        return line.count(b" ") + 1, np.concatenate(parts)


def hashed_features(docs: DataFrame, hasher: NgramHasher, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, n_words, n_features, buckets) of every row; buckets are packed integers."""

    def make(batch):
        made = [hasher.hashed(t) for t in batch.column(1).to_pylist()]
        return {
            "doc_id": batch.column(0),
            "n_words": [n for n, _ in made],
            "n_features": [len(b) for _, b in made],
            "buckets": [b.tobytes() for _, b in made],
        }

    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return per_row(source, "doc_id long, n_words long, n_features long, buckets binary", make)


def bucket_counts(features: DataFrame, hasher: NgramHasher) -> np.ndarray:
    """Features a bucket over all rows. Every task adds its own up; as many sums as there are
    buckets reach the driver, whatever the input."""
    size, kind = hasher.buckets, hasher.type

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_buffer(), dtype=kind), minlength=size)
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    sums = (
        features.where("n_features > 0")
        .select("buckets")
        .mapInArrow(tally, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    counts = np.zeros(size, dtype=np.int64)
    for row in sums.collect():
        counts[row.bucket] = row.n
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+m) / ((s+1)(T+m)))) of each of the m buckets."""
    m, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * float(all_s + m) / (float(s + 1) * float(all_t + m))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the id alone."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gains: np.ndarray, hasher: NgramHasher, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of hashed features."""
    kind = hasher.type

    def weight(packed) -> int:
        own = np.frombuffer(packed.as_buffer(), dtype=kind)
        return int(gains[own].sum()) // len(own) if len(own) else 0

    def make(batch):
        weights = [weight(packed) for packed in batch.column(3)]
        ids = batch.column(0).to_pylist()
        return {
            "doc_id": batch.column(0),
            "n_words": batch.column(1),
            "n_features": batch.column(2),
            "weight": weights,
            "score": [w + noise(i, seed) for w, i in zip(weights, ids, strict=True)],
        }

    return per_row(features, "doc_id long, n_words long, n_features long, weight long, score long", make)


def with_ranks(rows: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """Adds ``rank``: 1, 2, 3... over the highest ``percent`` of eligible rows, null for others.

    Scores are whole thousandths of logarithms, some 100,000 different ones at the most
    whatever the input, so counts by score fit the driver and tell where a score's ranks begin.
    Rows are numbered within their score only; the noise spreads copies over all scores.
    """
    counts = rows.where(eligible).groupBy("score").agg(F.count("*").alias("n")).collect()
    drawn = percent * sum(r.n for r in counts) // 100
    starts, before = [], 0
    for row in sorted(counts, key=lambda r: -r.score):
        if before >= drawn:
            break
        starts.append((row.score, before))
        before += row.n
    none = F.lit(None).cast("long")
    if not starts:
        return rows.withColumn("rank", none)
    low = F.col("score") >= starts[-1][0]
    begins = rows.sparkSession.createDataFrame(starts, "score long, ranks_before long")
    order = [F.col("doc_id").asc_nulls_last(), "n_features", "weight"]
    place = F.col("ranks_before") + F.row_number().over(W.partitionBy("score").orderBy(*order))
    top = rows.where(eligible & low).join(begins, "score").withColumn("place", place)
    top = top.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")).cast("long"))
    rest = rows.where(~(eligible & low)).withColumn("rank", none)
    return top.select(*rest.columns).unionByName(rest)


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    hasher: NgramHasher | None = None,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs``, drawn towards ``target``.

    Null and empty texts have no features and weight 0. Rows that repeat are rows of their own;
    ties of score go to the smaller doc_id. A null doc_id takes its noise from the empty text and
    comes after all others of its score. Without documents the result is empty, without target
    texts every gain compares with an even spread. Other columns are not read.
    """
    hasher = hasher or NgramHasher()
    features = staged(hashed_features(docs, hasher, id_col, text_col), "ngrams")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(f"`{target_col}`").alias("text"))
    gains = bucket_gains(
        bucket_counts(features, hasher), bucket_counts(hashed_features(wanted, hasher), hasher)
    )
    rows = staged(scored(features, gains, hasher, seed), "scores")
    ranked = with_ranks(rows, F.col("n_words") >= least_words, percent)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; an id that comes several times is drawn
    with all its rows, rows without an id are not."""
    ranks = importance_ranks(docs, target, id_col=id_col, **options)
    (name,) = free_names(docs, "drawn")
    drawn = ranks.where("rank is not null").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(drawn, F.col(f"`{id_col}`").cast("long") == F.col(name), "left_semi")
