"""Token counts with a whole-token shortcut."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import WordCache, per_row
from daygrid.llm.subwords import vocabulary

LIMIT = 4096


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings proven, by merging each alone, to encode as one token."""
    model = vocabulary(path)
    return frozenset(piece for piece in model.ids if model.merge(piece) == [piece])


class Counter:
    """Counts a text's tokens: pre-tokens that are whole tokens count one, the rest is merged."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.model = vocabulary(path)
        self.whole = whole
        self.by_unit = WordCache(self._merged, 600_000)
        self.by_chunk = WordCache(self._chunk, 400_000)

    def _merged(self, unit: str) -> int:
        ids = self.model.ids
        return sum(1 if s in ids else len(s.encode("utf-8")) for s in self.model.merge(unit))

    def _chunk(self, chunk: str) -> int:
        whole = self.whole
        return sum(1 if u in whole else self.by_unit[u] for u in self.model.units(chunk))

    def count(self, text: str) -> int:
        return sum(map(self.by_chunk.__getitem__, self.model.chunks(text)))


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; a null text is empty.

    The proof is made once, before the job; its result is bounded by the vocabulary and goes
    to every task. Whole texts are counted; rows that repeat give rows that repeat.
    """
    whole = whole_tokens(path)
    shared = docs.sparkSession.sparkContext.broadcast(whole)

    def make(batch):
        if path not in _counters:
            _counters[path] = Counter(path, shared.value)
        count = _counters[path].count
        texts = [t or "" for t in batch.column(1).to_pylist()]
        tokens = [count(t) for t in texts]
        return {
            "doc_id": batch.column(0),
            "n_bytes": [len(t) if t.isascii() else len(t.encode("utf-8")) for t in texts],
            "n_tokens": tokens,
            "over_limit": [n > LIMIT for n in tokens],
        }

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return per_row(source, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", make)
