"""Packing into sequences: length combinations weighted by non-negative least squares."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.common import ROWS, WordCache, staged

WINDOW = 4096
#: Tokens of a length unit: combinations are of lengths rounded up to units, cuts are between them.
UNIT = 16
UNITS = WINDOW // UNIT
END_ID = 2
#: Gain below which the least-squares solution isn't improved further.
TOLERANCE = 1e-6

#: Parts that the tokenizer's own splitting keeps apart, in lower-case texts of Latin-1 letters;
#: apostrophes belong to contractions and are left to the tokenizer, like all other characters.
_PART = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is
    printable and no space, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class TokenBytes:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.by_part = WordCache(self._part, 800_000)
        self.by_chunk = WordCache(self._chunk, 400_000)

    def _part(self, part: str) -> bytes:
        """A lower-case part goes to the tokenizer's merges directly."""
        if not part.isascii():
            part = "".join([self.letters[b] for b in part.encode("utf-8")])
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(part)])

    def _chunk(self, chunk: str) -> bytes:
        lowered = chunk.lower()
        parts = _PART.findall(lowered)
        if sum(map(len, parts)) == len(lowered) and "<|" not in chunk:
            return b"".join([self.by_part[p] for p in parts])
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """White space is dropped by the tokenizer and nothing joins across it, so what lies
        between is encoded by itself."""
        spaced = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.by_chunk.__getitem__, spaced.split(" ")))


@lru_cache(maxsize=2)
def token_bytes(path: str) -> TokenBytes:
    return TokenBytes(path)


def _lengths(path: str):
    """Windows and rests of documents, numbered within each task by their length in units."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("crc", pa.int64()),
            ("doc_tokens", pa.int64()), ("units", pa.int32()), ("unit_crcs", pa.binary()),
            ("task", pa.int32()), ("number", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(path).encode
        end = np.array([END_ID], dtype="<u4").tobytes()
        task = TaskContext.get().partitionId()
        numbers = [0] * (UNITS + 1)
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    data = encode(text or "") + end
                    total = len(data) // 4
                    for start in range(0, total, WINDOW):
                        piece = data[4 * start : 4 * (start + WINDOW)]
                        length = len(piece) // 4
                        units = -(-length // UNIT)
                        # A rest may be cut later; checksums of its units give those of its parts.
                        step = 4 * UNIT
                        crcs = b"".join(
                            crc32(piece[at : at + step]).to_bytes(4, "little")
                            for at in (range(0, len(piece), step) if units < UNITS else ())
                        )
                        rows.append(
                            (doc_id, start, length, crc32(piece), total, units, crcs, task, numbers[units])
                        )
                        numbers[units] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                    schema=schema,
                )

    return run


def combinations_filling(lengths: list[int], window: int = UNITS) -> list[tuple[int, ...]]:
    """Shallow combinations of the lengths that add up to the window.

    They hold one or two lengths, each any number of times, or three different ones.
    """
    have = set(lengths)
    made: set[tuple[int, ...]] = set()
    for a in have:
        for times in range(1, window // a + 1):
            rest = window - times * a
            if rest == 0:
                made.add((a,) * times)
            else:
                for b in range(1, min(a - 1, rest) + 1):
                    if b in have and rest % b == 0:
                        made.add((a,) * times + (b,) * (rest // b))
    for a, b in combinations(sorted(have, reverse=True), 2):
        c = window - a - b
        if 0 < c < b and c in have:
            made.add((a, b, c))
    return sorted(made, reverse=True)


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by an active set of columns."""
    columns = a.shape[1]
    x, active = np.zeros(columns), np.zeros(columns, dtype=bool)
    for _ in range(3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= TOLERANCE * max(1.0, np.abs(b).max()):
            break
        active[best] = True
        while True:
            chosen = np.nonzero(active)[0]
            solved = np.linalg.lstsq(a[:, chosen], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[chosen] = solved
                break
            low = solved <= 0
            step = np.min(x[chosen][low] / np.maximum(x[chosen][low] - solved[low], 1e-300))
            x[chosen] += step * (solved - x[chosen])
            drop = chosen[(x[chosen] <= 1e-12) & low]
            active[drop if len(drop) else chosen[low]] = False
            x[~active] = 0
    return x


@dataclass
class Plan:
    """Where the i-th piece of a length goes: parts of combinations, then the rest's stream."""

    #: By length: rows (first number, first sequence, pieces of this length in a sequence, first slot).
    parts: dict[int, np.ndarray]
    #: By length: number from which pieces go to the stream, and the stream position of that one.
    stream: dict[int, tuple[int, int]]
    stream_sequence: int


def make_plan(histogram: dict[int, int]) -> Plan:
    """Sequences for a histogram of lengths in units; its size doesn't depend on the counts."""
    left = dict(histogram)
    taken = dict.fromkeys(histogram, 0)
    parts: dict[int, list[tuple[int, int, int, int]]] = {q: [] for q in histogram}
    sequence = 0
    lengths = sorted(q for q, n in histogram.items() if n and q < UNITS)
    patterns: list[tuple[tuple[int, ...], int]] = []
    if histogram.get(UNITS):
        patterns.append(((UNITS,), histogram[UNITS]))
    shallow = combinations_filling(lengths)
    if shallow:
        row_of = {q: r for r, q in enumerate(lengths)}
        a = np.zeros((len(lengths), len(shallow)))
        for column, combination in enumerate(shallow):
            for q in combination:
                a[row_of[q], column] += 1
        target = np.array([histogram[q] for q in lengths], dtype=np.float64)
        repeats = non_negative_least_squares(a / target.max(), target / target.max())
        order = np.argsort(-repeats, kind="stable")
        patterns += [(shallow[k], int(round(repeats[k]))) for k in order if repeats[k] > 0]
    for combination, wanted in patterns:
        need = {q: combination.count(q) for q in combination}
        times = min(wanted, *(left[q] // m for q, m in need.items()))
        if times <= 0:
            continue
        slot = 0
        for q, m in need.items():
            parts[q].append((taken[q], sequence, m, slot))
            taken[q] += m * times
            left[q] -= m * times
            slot += m
        sequence += times
    stream, position = {}, 0
    for q in sorted(left, reverse=True):
        if left[q]:
            stream[q] = (taken[q], position)
            position += q * left[q]
    arrays = {q: np.array(p, dtype=np.int64).reshape(-1, 4) for q, p in parts.items()}
    return Plan(arrays, stream, sequence)


_SHIFT: dict[int, list[list[int]]] = {}


def _shift(crc: int, size: int) -> int:
    """What a checksum becomes when ``size`` zero bytes follow, by tables of a linear map."""
    if size not in _SHIFT:
        base = crc32(bytes(size))
        images = []
        for bit in range(32):
            # crc32(data, start) continues a checksum; the part that depends on it is linear.
            images.append(crc32(bytes(size), 1 << bit) ^ base)
        tables = []
        for byte in range(4):
            table = [0] * 256
            for value in range(1, 256):
                low = value & -value
                table[value] = table[value ^ low] ^ images[8 * byte + low.bit_length() - 1]
            tables.append(table)
        _SHIFT[size] = tables
    t = _SHIFT[size]
    return t[0][crc & 255] ^ t[1][crc >> 8 & 255] ^ t[2][crc >> 16 & 255] ^ t[3][crc >> 24]


def joined_crc(crcs: list[int], sizes: list[int]) -> int:
    """Checksum of parts put together, from their own checksums and sizes in bytes."""
    total = 0
    for crc, size in zip(crcs, sizes, strict=True):
        total = _shift(total, size) ^ crc
    return total


def _place(plan: Plan):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for units, rows in batch.groupby("units"):
                units = int(units)
                number = rows["number"].to_numpy()
                first, position = plan.stream.get(units, (np.iinfo(np.int64).max, 0))
                packed = number < first
                parts = plan.parts[units]
                if packed.any():
                    here, n = rows[packed], number[packed]
                    at = np.searchsorted(parts[:, 0], n, "right") - 1
                    start, sequence, m, slot = parts[at].T
                    out.append(_rows(here, sequence + (n - start) // m, slot + (n - start) % m))
                if not packed.all():
                    here = rows[~packed]
                    begin = position + (number[~packed] - first) * units
                    inside = begin % UNITS
                    whole = inside + units <= UNITS
                    sequence = plan.stream_sequence + begin // UNITS
                    out.append(_rows(here[whole], sequence[whole], inside[whole]))
                    out.extend(_cut(here[~whole], sequence[~whole], inside[~whole]))
            if out:
                yield pd.concat(out)[names]

    return run


def _rows(rows: pd.DataFrame, sequence, slot) -> pd.DataFrame:
    kept = rows[["doc_id", "start", "length", "doc_tokens"]]
    return kept.assign(ids_crc32=rows["crc"], sequence_id=sequence, slot=slot)


def _cut(rows: pd.DataFrame, sequences, insides) -> Iterator[pd.DataFrame]:
    """Both parts of pieces that the end of a stream's window cuts, between two units."""
    for row, sequence, inside in zip(rows.itertuples(), sequences, insides, strict=True):
        crcs = np.frombuffer(row.unit_crcs, dtype="<u4").tolist()
        sizes = [4 * UNIT] * (len(crcs) - 1) + [4 * (row.length - UNIT * (len(crcs) - 1))]
        cut = UNITS - int(inside)
        head = UNIT * cut
        yield pd.DataFrame(
            {
                "doc_id": pd.array([row.doc_id] * 2, dtype="Int64"),
                "start": [row.start, row.start + head],
                "length": [head, row.length - head],
                "doc_tokens": row.doc_tokens,
                "ids_crc32": [joined_crc(crcs[:cut], sizes[:cut]), joined_crc(crcs[cut:], sizes[cut:])],
                "sequence_id": [sequence, sequence + 1],
                "slot": [inside, 0],
            }
        )


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece.

    A document is its ids and END_ID; a null or empty text is END_ID alone. Full windows are
    cut off first and are sequences of their own. The rests are counted by length in units, a
    histogram of at most UNITS numbers, for which combinations that fill a window are weighted
    by non-negative least squares and rounded down to what is there. What they leave is packed
    greedily in one stream that is cut where a window ends. Pieces get their sequence from
    their number among those of their length, which tasks count for themselves and a sum over
    tasks completes, so no length is any one task's. Rows that repeat are documents of their
    own; a null doc_id stays null.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = staged(
        source.mapInArrow(
            _lengths(path),
            "doc_id long, start long, length int, crc long, doc_tokens long, units int, "
            "unit_crcs binary, task int, number long",
        ),
        "pieces",
    )
    counts = pieces.groupBy("units", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("units").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("units", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = {
        row["units"]: row["n"] for row in counts.groupBy("units").agg(F.sum("n").alias("n")).collect()
    }
    plan = make_plan(histogram)
    placed = (
        pieces.join(firsts, ["units", "task"])
        .select(
            "doc_id", "start", "length", "crc", "doc_tokens", "units", "unit_crcs",
            (F.col("number") + F.col("first")).alias("number"),
        )
        .mapInPandas(
            _place(plan),
            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
            "sequence_id long, slot long",
        )
    )
    ahead = Window.partitionBy("sequence_id").orderBy("slot")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        (F.sum("length").over(ahead) - F.col("length")).alias("offset"),
    )
