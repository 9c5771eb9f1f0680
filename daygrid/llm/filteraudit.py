"""Interaction audit of document filters by count-weighted decision diagrams.

Every document has a mask of the filters it fails. Masks are counted by part, and a part's
counts become a decision diagram with one level a filter. All orders of the filters are visited
by swaps of two adjacent levels; in each order the path on which every filter passes tells what
a step removes and keeps.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import per_row, staged

#: The audited filters, by the bit of their failure.
FILTERS = "ABCDE"
_COPY = 1 << FILTERS.index("E")
_CAPITALS = bytes(range(65, 91))
_SYMBOLS = re.compile(rb"[#$%&*|]")
#: A row without an id counts as the one with the greatest id.
_NO_ID = (1 << 63) - 1

Weight = tuple[int, ...]


def text_failures(text: str | None) -> int:
    """Bits of the filters A to D that a whole text fails."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    failed = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * capitals > 2 * len(text),
        _SYMBOLS.search(data) is not None,
    )
    return sum(1 << bit for bit, fails in enumerate(failed) if fails)


class Diagram:
    """Decision diagram over failure masks whose nodes carry summed weights.

    ``levels[k]`` lists the nodes of the k-th filter of ``order`` as (pass child, fail child);
    children are places in the next level, after the last level in ``leaves``. Nodes with equal
    children are one. ``weights[k]`` are the nodes' sums.
    """

    def __init__(self, filters: int, weights: dict[int, Weight], width: int):
        self.order = list(range(filters))
        none = (0,) * width
        leaves: dict[Weight, int] = {}
        # The first filter of the order is the highest digit of a place.
        masks = [sum(1 << f for f in range(filters) if place >> (filters - 1 - f) & 1) for place in range(1 << filters)]
        below = [leaves.setdefault(weights.get(mask, none), len(leaves)) for mask in masks]
        self.weights: list[list[Weight]] = [[] for _ in range(filters)] + [list(leaves)]
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(filters)]
        for k in reversed(range(filters)):
            nodes: dict[tuple[int, int], int] = {}
            below = [
                nodes.setdefault((below[i], below[i + 1]), len(nodes)) for i in range(0, len(below), 2)
            ]
            self._set_level(k, list(nodes))
        self.root = below[0]

    def _set_level(self, k: int, nodes: list[tuple[int, int]]) -> None:
        under = self.weights[k + 1]
        self.levels[k] = nodes
        self.weights[k] = [tuple(a + b for a, b in zip(under[p], under[f])) for p, f in nodes]

    def swap(self, k: int) -> None:
        """Exchanges the filters of levels k and k + 1; all other levels stay."""
        lower = self.levels[k + 1]
        nodes: dict[tuple[int, int], int] = {}
        upper = []
        for passed, failed in self.levels[k]:
            (pp, pf), (fp, ff) = lower[passed], lower[failed]
            upper.append((nodes.setdefault((pp, fp), len(nodes)), nodes.setdefault((pf, ff), len(nodes))))
        self._set_level(k + 1, list(nodes))
        self.levels[k] = upper
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]

    def all_pass_path(self) -> list[tuple[int, Weight, Weight]]:
        """(filter, kept, removed) of every step of the present order."""
        steps, node = [], self.root
        for k, name in enumerate(self.order):
            passed, failed = self.levels[k][node]
            steps.append((name, self.weights[k + 1][passed], self.weights[k + 1][failed]))
            node = passed
        return steps


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places whose swaps with the next one lead through all orders of n things."""
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1)  # the last thing goes to the front
        step = next(inner, None)
        if step is None:
            return
        yield step + 1
        yield from range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step


def audit_part(filters: Sequence[str], weights: dict[int, Weight]) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)
    of every step of every order, from the (all, good, toxic) weights of the masks."""
    n = len(filters)
    diagram = Diagram(n, weights, 3)
    paths = [("".join(filters[f] for f in diagram.order), diagram.all_pass_path())]
    for k in adjacent_swaps(n):
        diagram.swap(k)
        paths.append(("".join(filters[f] for f in diagram.order), diagram.all_pass_path()))
    fails, alone, shapley = {}, {}, dict.fromkeys(range(n), 0)
    for _, steps in paths:
        for at, (name, _, removed) in enumerate(steps):
            shapley[name] += removed[0]
            if at == 0:
                fails[name] = removed[0]
            if at == n - 1:  # all others pass
                alone[name] = removed[0]
    return [
        (order, at + 1, kept[0], out[0], fails[name] - out[0], alone[name], out[1], out[2], shapley[name])
        for order, steps in paths
        for at, (name, kept, out) in enumerate(steps)
    ]


_STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def audit(masks: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """All orders' steps for each part of ``masks`` (part, mask, good, toxic), one row a document.

    Masks are counted before the shuffle, so a part is never more than 2^filters rows.
    """
    names = [field.split()[0] for field in _STEPS.split(", ")]
    counted = masks.groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.sum(F.col("good").cast("long")).alias("good"),
        F.sum(F.col("toxic").cast("long")).alias("toxic"),
    )
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
        for batch in batches:
            for part, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                weights = {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in found}
                rows = [(part, *row) for row in audit_part(filters, weights)]
                columns = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return parts.select("part", "m").mapInArrow(run, _STEPS)


def failure_masks(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", part_col="source"
) -> DataFrame:
    """(part, mask, good, toxic) of every document.

    Copies are known by their texts' SHA-256. The first id of a text is a minimum that combines
    before the shuffle, and is joined back by id and text, so a large group of copies is spread
    over all tasks.
    """

    def make(batch):
        texts = batch.column(2).to_pylist()
        return {
            "id": batch.column(0),
            "part": batch.column(1),
            "named": batch.column(3),
            "mask": [text_failures(t) for t in texts],
            "digest": [sha256((t or "").encode("utf-8", "surrogatepass")).digest() for t in texts],
        }

    source = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{id_col}`").isNotNull().alias("named"),
    )
    schema = "id long, part string, named boolean, mask int, digest binary"
    rows = staged(per_row(source, schema, make), "masks")
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
        .where("good or toxic")
    )
    joined = rows.join(firsts, ["id", "digest"], "left").join(marks, "id", "left")
    copied = F.when(F.col("first").isNull(), F.col("mask").bitwiseOR(F.lit(_COPY))).otherwise(F.col("mask"))
    return joined.select(
        "part",
        copied.alias("mask"),
        (F.coalesce("good", F.lit(False)) & F.col("named")).alias("good"),
        (F.coalesce("toxic", F.lit(False)) & F.col("named")).alias("toxic"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", part_col="source") -> DataFrame:
    """One row per part, order of the five filters and step, zeros included.

    Null texts are empty, null parts the empty string. A text's smallest id keeps it; rows that
    repeat it with this id keep it too. A null id comes after all others, and rows without an
    id are copies of each other only where a row with an id has their text. Labels: an id is
    good or toxic if one of its rows says 1; null and other values say nothing. An empty table
    has no parts and so no rows; other columns are not read.
    """
    return audit(failure_masks(docs, labels, id_col, text_col, part_col))
