"""Exact substring dedup: repeated windows found by suffix sorting at content-chosen anchors.

A window of ``length`` bytes is assigned to its anchor, the gram of bytes within it whose hash
is least (rightmost of equals). The anchor depends on the window's bytes alone, so equal windows
have equal anchors at equal places, and only anchors whose bytes come twice in the corpus can
have repeated windows. The text after such anchors, and the text before them read backwards,
is sorted within each group of equal anchors: shallow by multikey quicksort over words of eight
bytes, deep by blind tries. Two windows are equal exactly if they share enough on both sides.

An anchor with many fragments is sorted in chunks, each a task's work. Of every class of equal
windows a chunk names one by its digest, and digests that several chunks name join the chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import ROWS, free_names, per_batch, staged

#: Bytes of a window where nothing else is said.
LENGTH = 400
#: Window starts of a text that are looked at together.
_PART = 1 << 19
_LOW = (1 << 24) - 1
#: Bytes that the sort by words looks at before tries take over.
SHALLOW = 32
#: Fragments that are sorted together in one go, and the most of an anchor in a chunk on average:
#: some 17 MB of text for a task.
BATCH_FRAGMENTS = 20_000
CHUNK_FRAGMENTS = 25_000

_rng = np.random.default_rng(20_240_611)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Windows:
    """The length of the windows whose repeats go, and of the grams that anchor them."""

    length: int = LENGTH

    def __post_init__(self):
        if self.length < 12:
            raise ValueError("windows have 12 bytes at least")

    @property
    def gram(self) -> int:
        """The greatest power of two within a third of a window."""
        return 1 << ((self.length // 3).bit_length() - 1)

    @property
    def grams(self) -> int:
        return self.length - self.gram + 1


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at every place, by doubling the length hashed."""
    h, size = _VALUES[data], 1
    while size < gram:
        h = h[: len(h) - size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def anchors(data: bytes, size: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first start, last start) of the runs of windows with the same anchor."""
    found: list[tuple[np.ndarray, ...]] = []
    length, grams = size.length, size.grams
    windows = len(data) - length + 1
    codes = np.frombuffer(data, dtype=np.uint8)
    for begin in range(0, max(0, windows), _PART):
        n = min(_PART, windows - begin)
        h = _gram_hashes(codes[begin : begin + n + length - 1], size.gram)
        places = np.arange(len(h), dtype=np.uint64)
        keys = (h & ~np.uint64(_LOW)) | (np.uint64(_LOW) - places)
        padded = np.full(-(-len(keys) // grams) * grams, np.iinfo(np.uint64).max)
        padded[: len(keys)] = keys
        blocks = padded.reshape(-1, grams)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[:n], ahead[grams - 1 : grams - 1 + n])
        first = np.concatenate([[0], np.nonzero(least[1:] != least[:-1])[0] + 1])
        last = np.concatenate([first[1:] - 1, [n - 1]])
        at = (np.uint64(_LOW) - (least[first] & np.uint64(_LOW))).astype(np.int64)
        found.append((h[at].view(np.int64), at + begin, first + begin, last + begin))
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _fragment_counts(data: bytes, size: Windows) -> tuple[list[int], list[int]]:
    """Anchors of a text and how many fragments each has here, counting equal ones up to two."""
    h, _, lo, hi = anchors(data, size)
    if not len(h):
        return [], []
    hashes, which, times = np.unique(h, return_inverse=True, return_counts=True)
    counts = np.ones(len(hashes), dtype=np.int64)
    order = np.argsort(which, kind="stable")
    ends = np.cumsum(times)
    for k in np.nonzero(times > 1)[0]:
        own = order[ends[k] - times[k] : ends[k]]
        counts[k] = max(2, len({xxhash.xxh3_128_digest(data[lo[i] : hi[i] + size.length]) for i in own}))
    return hashes.tolist(), counts.tolist()


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # a[:low] is common, a[:high] isn't
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def blind_trie_order(strings: list[bytes], rows: list[int]) -> tuple[list[int], list[int]]:
    """Rows in the order of their strings, and for each the common prefix with the one before.

    Branches hold only the depth where strings part and the byte they part by; a string goes
    down by these bytes without comparing, meets some leaf, and its common prefix with that
    leaf's string tells where it belongs.
    """
    root: list = [None, [rows[0]]]  # leaf: [None, rows]; branch: [depth, {byte: node}]
    for row in rows[1:]:
        text = strings[row]
        node = root
        while node[0] is not None:
            byte = text[node[0]] if node[0] < len(text) else -1
            children = node[1]
            node = children.get(byte) or next(iter(children.values()))
        other = strings[node[1][0]]
        depth = _common(text, other)
        if depth == len(text) == len(other):
            node[1].append(row)
            continue
        parent, node, byte = None, root, 0
        while node[0] is not None and node[0] < depth:
            byte = text[node[0]]
            parent, node = node, node[1][byte]
        mine = text[depth] if depth < len(text) else -1
        if node[0] == depth:
            node[1][mine] = [None, [row]]
            continue
        theirs = other[depth] if depth < len(other) else -1
        branch = [depth, {theirs: node, mine: [None, [row]]}]
        if parent is None:
            root = branch
        else:
            parent[1][byte] = branch
    order: list[int] = []
    shared: list[int] = []
    stack: list[tuple[int, list]] = [(0, root)]
    while stack:
        above, node = stack.pop()
        if node[0] is None:
            order.extend(node[1])
            shared.append(above)
            shared.extend([len(strings[node[1][0]])] * (len(node[1]) - 1))
        else:
            depth = node[0]
            children = sorted(node[1].items())
            for k in range(len(children) - 1, -1, -1):
                stack.append((depth if k else above, children[k][1]))
    return order, shared


def multikey_quicksort(words: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by group and words, and where rows begin that differ from those before.

    Every segment parts its rows by the median of three words into less, equal and greater;
    only the equal part goes on to the next word. All open segments are parted in one step.
    """
    n, width = words.shape
    order = np.argsort(groups, kind="stable")
    part = groups[order]
    starts = np.nonzero(np.concatenate([[True], part[1:] != part[:-1]]))[0]
    depth = np.zeros(len(starts), dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[starts] = True
    sizes = np.diff(np.append(starts, n))
    while True:
        is_open = (sizes > 1) & (depth < width)
        starts, sizes, depth = starts[is_open], sizes[is_open], depth[is_open]
        if not len(starts):
            return order, new
        segment = np.repeat(np.arange(len(starts)), sizes)
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        word = words[order[places], depth[segment]]
        first = ends - sizes
        pivot = np.sort(word[np.stack([first, first + sizes // 2, ends - 1])], axis=0)[1]
        side = 1 + (word > pivot[segment]).astype(np.int64) - (word < pivot[segment])
        key = 3 * segment + side
        moved = np.argsort(key, kind="stable")
        order[places] = order[places[moved]]
        key = key[moved]
        begins = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
        depth = depth[key[begins] // 3] + (key[begins] % 3 == 1)
        sizes = np.diff(np.append(begins, len(key)))
        starts = places[begins]
        new[starts] = True


def deep_shallow_order(strings: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, string), and for each place the common prefix with the one before it;
    -1 where a group begins."""
    n = len(strings)
    head = b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings)
    words = np.frombuffer(head, dtype=">u8").reshape(n, -1).astype(np.uint64)
    order, new = multikey_quicksort(words, groups)
    starts = np.append(np.nonzero(new)[0], n)
    shared = np.full(n, -1, dtype=np.int64)
    for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if end - begin > 1:
            rows, common = blind_trie_order(strings, order[begin:end].tolist())
            order[begin:end] = rows
            shared[begin:end] = common
    for at in starts[1:-1].tolist():
        a, b = order[at - 1], order[at]
        shared[at] = _common(strings[a], strings[b]) if groups[a] == groups[b] else -1
    shared[0] = -1
    return order, shared


def window_classes(
    groups: np.ndarray, texts: list[bytes], before: np.ndarray, last: np.ndarray, length: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bytes before the anchor, rows, class) of the windows of fragments. Windows are equal
    exactly if they have equal bytes before the anchor and are of one class.

    A text begins ``before`` bytes ahead of its anchor; its windows start at 0 to ``last``.
    """
    n = len(texts)
    front = [t[b:] for t, b in zip(texts, before.tolist(), strict=True)]
    rear = [t[:b][::-1] for t, b in zip(texts, before.tolist(), strict=True)]
    sides = []
    for strings in (front, rear):
        order, shared = deep_shallow_order(strings, groups)
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        sides.append((place, shared))
    (front_place, front_shared), (rear_place, rear_shared) = sides
    least = before - last
    for back in range(int(least.min()), int(before.max()) + 1):
        rows = np.nonzero((least <= back) & (back <= before))[0]
        if len(rows):
            ahead = np.cumsum(front_shared < length - back)[front_place[rows]]
            behind = np.cumsum(rear_shared < back)[rear_place[rows]]
            yield back, rows, ahead * (n + 1) + behind


def repeated_runs(
    groups: np.ndarray, texts: list[bytes], before: np.ndarray, last: np.ndarray, parted: np.ndarray, length: int
):
    """((row, first, last) runs of window starts that another window of the group equals,
    (row, start, alone) of one window of every class in groups that are ``parted``).

    ``alone`` windows have no equal here; of the others the first of a class stands for all.
    """
    runs: list[tuple[np.ndarray, np.ndarray]] = []
    named: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for back, rows, classes in window_classes(groups, texts, before, last, length):
        order = np.argsort(classes, kind="stable")
        same = classes[order][1:] == classes[order][:-1]
        hit = np.zeros(len(rows), dtype=bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        runs.append((rows[hit], before[rows[hit]] - back))
        firsts = order[np.concatenate([[True], ~same])]
        firsts = firsts[parted[rows[firsts]]]
        named.append((rows[firsts], before[rows[firsts]] - back, ~hit[firsts]))
    rows, starts = (np.concatenate(c) for c in zip(*runs, strict=True))
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + 1)])[: len(rows)]
    begins = np.nonzero(new)[0]
    ends = np.append(begins[1:], len(rows))[: len(begins)] - 1
    return (rows[begins], starts[begins], starts[ends]), tuple(np.concatenate(c) for c in zip(*named, strict=True))


_FOUND = "k1 long, k2 long, h long, begin long, before int, last int, chunks int, fragment binary"
_SORTED = "k1 long, k2 long, begin long, end long, w1 long, w2 long"


def _columns(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names
    )


def _hash_step(batch: pa.RecordBatch, size: Windows) -> pa.RecordBatch:
    made = [_fragment_counts(t.encode("utf-8"), size) for t in batch.column(2).to_pylist()]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(1),
            pa.array([m[0] for m in made], pa.list_(pa.int64())),
            pa.array([m[1] for m in made], pa.list_(pa.int64())),
        ],
        ["k1", "k2", "hs", "ns"],
    )


def _fragment_step(batch: pa.RecordBatch, size: Windows) -> pa.RecordBatch:
    """Fragments of repeated anchors. Of fragments that come again in their own text one goes on;
    all of them are repeated, and a row without a fragment says so."""
    types = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.binary()]
    rows: list[tuple] = []
    for k1, k2, text, keys, chunks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        data = text.encode("utf-8")
        chunks_of = dict(zip(keys, chunks, strict=True))
        seen: dict[tuple[int, bytes], tuple[int, int]] = {}
        again: set[tuple[int, bytes]] = set()
        for h, a, lo, hi in zip(*(c.tolist() for c in anchors(data, size)), strict=True):
            if h not in chunks_of:
                continue
            fragment = data[lo : hi + size.length]
            key = (h, xxhash.xxh3_128_digest(fragment))
            if key not in seen:
                seen[key] = (lo, hi)
                rows.append((k1, k2, h, lo, a - lo, hi - lo, chunks_of[h], fragment))
                continue
            rows.append((k1, k2, h, lo, a - lo, hi - lo, 0, None))
            if key not in again:
                again.add(key)
                first, end = seen[key]
                rows.append((k1, k2, h, first, a - lo, end - first, 0, None))
    return _columns(rows, types, [part.split()[0] for part in _FOUND.split(", ")])


def _sort_step(batches: Iterator[pa.RecordBatch], size: Windows) -> Iterator[pa.RecordBatch]:
    """From fragments in the order of anchor and chunk: spans of repeated windows, and digests of
    the different windows of anchors in several chunks. Digests of windows that have no equal in
    their chunk come with their place, the others without."""
    names = [part.split()[0] for part in _SORTED.split(", ")]
    types = [pa.int64()] * 6

    def sort(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        pairs = np.array([(r[2], r[3]) for r in rows])
        groups = np.unique(pairs, axis=0, return_inverse=True)[1].ravel()
        texts, begin = [r[8] for r in rows], np.array([r[4] for r in rows])
        parted = np.array([r[7] > 1 for r in rows])
        found, named = repeated_runs(
            groups, texts, np.array([r[5] for r in rows]), np.array([r[6] for r in rows]), parted, size.length
        )
        yield _columns(
            [
                (rows[i][0], rows[i][1], int(begin[i]) + f, int(begin[i]) + e + size.length, None, None)
                for i, f, e in zip(*(c.tolist() for c in found), strict=True)
            ],
            types, names,
        )
        out = []
        for i, start, alone in zip(*(c.tolist() for c in named), strict=True):
            digest = xxhash.xxh3_128_intdigest(texts[i][start : start + size.length])
            words = (digest & (2**64 - 1)) - 2**63, (digest >> 64) - 2**63
            at = int(begin[i]) + start
            place = (rows[i][0], rows[i][1], at, at + size.length) if alone else (None,) * 4
            out.append((*place, *words))
            if len(out) >= 50_000:
                yield _columns(out, types, names)
                out = []
        yield _columns(out, types, names)

    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(rows) >= BATCH_FRAGMENTS and row[2:4] != rows[-1][2:4]:
                yield from sort(rows)
                rows = []
            rows.append(row)
    if rows:
        yield from sort(rows)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that spans cover."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def _kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for begin, end in runs:
        parts.append(data[at:begin])
        at = end
    return b"".join([*parts, data[at:]])


def repeated_spans(texts: DataFrame, length: int = LENGTH, chunk_fragments: int = CHUNK_FRAGMENTS) -> DataFrame:
    """Spans (k1, k2, begin, end) of repeated windows of different ``texts`` (k1, k2, text).

    Texts are known by two 64-bit hashes; a text that stands in several rows is one here.
    """
    size = Windows(length)
    long_texts = texts.where(F.octet_length("text") >= length)
    listed = per_batch(
        long_texts, "k1 long, k2 long, hs array<long>, ns array<long>", lambda b: _hash_step(b, size), ROWS
    )
    found = listed.select("k1", "k2", F.explode(F.arrays_zip("hs", "ns")).alias("p")).select(
        "k1", "k2", F.col("p.hs").alias("h"), F.col("p.ns").alias("n")
    )
    found = staged(found.groupBy("h", "k1", "k2").agg(F.max("n").alias("n")), "anchors")
    sizes = found.groupBy("h").agg(F.sum("n").alias("fragments")).where("fragments > 1")
    chunks = F.ceil(F.col("fragments") / chunk_fragments).cast("int")
    wanted = (
        found.join(sizes, "h")
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("h", chunks.alias("chunks"))).alias("p"))
        .select("k1", "k2", F.col("p.h").alias("hs"), F.col("p.chunks").alias("chunks"))
    )
    once = long_texts.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    fragments = staged(
        per_batch(
            once.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "hs", "chunks"),
            _FOUND, lambda b: _fragment_step(b, size), ROWS // 4,
        ),
        "fragments",
    )
    sure = fragments.where("fragment is null").select(
        "k1", "k2", "begin", (F.col("begin") + F.col("last") + length).alias("end")
    )
    found = (
        fragments.where("fragment is not null")
        .withColumn("chunk", F.pmod(F.xxhash64("k1", "k2", "begin"), F.col("chunks")).cast("int"))
        .select("k1", "k2", "h", "chunk", "begin", "before", "last", "chunks", "fragment")
        .repartition("h", "chunk")
        .sortWithinPartitions("h", "chunk")
        .mapInArrow(lambda batches: _sort_step(batches, size), _SORTED)
    )
    found = staged(found, "sorted")
    digests = found.where("w1 is not null")
    often = digests.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    across = digests.where("k1 is not null").join(often, ["w1", "w2"])
    spans = ["k1", "k2", "begin", "end"]
    return (
        sure.unionByName(found.where("w1 is null").select(*spans)).unionByName(across.select(*spans))
    )


def _cut_step(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for k1, k2, text, begins, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        data = text.encode("utf-8")
        runs = merged(list(zip(begins, ends, strict=True)))
        kept = _kept(data, runs)
        removed = len(data) - len(kept)
        # A cut may part a character; its bytes that stay are no text.
        rows.append((k1, k2, removed, len(runs), sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    types = [pa.int64()] * 4 + [pa.string(), pa.string()]
    return _columns(rows, types, ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept"])


def text_cuts(texts: DataFrame, length: int = LENGTH, chunk_fragments: int = CHUNK_FRAGMENTS) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept_sha256, kept) of every text (k1, k2, text) that loses
    bytes. A text of a window or more that several rows have is removed whole."""
    spans = repeated_spans(texts, length, chunk_fragments)
    lists = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "end")).alias("s"))
    once = (
        texts.where(F.octet_length("text") >= length)
        .groupBy("k1", "k2")
        .agg(F.first("text").alias("text"), F.count("*").alias("n"))
    )
    copied = F.col("n") > 1
    begins = F.when(copied, F.array(F.lit(0).cast("long"))).otherwise(F.col("s.begin"))
    ends = F.when(copied, F.array(F.octet_length("text").cast("long"))).otherwise(F.col("s.end"))
    cut = once.join(lists, ["k1", "k2"], "left").where(copied | F.col("s").isNotNull())
    return per_batch(
        cut.select("k1", "k2", "text", begins.alias("begins"), ends.alias("ends")),
        "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept string",
        _cut_step, ROWS,
    )


def _keyed(docs: DataFrame, text_col: str, length: int, key: str) -> DataFrame:
    """``docs`` with the two hashes of a text as the struct ``key``; null texts are empty."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.withColumn(
        key, F.struct(F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(length), text).alias("k2"))
    )


def _texts(keyed: DataFrame, text_col: str, key: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    return keyed.select(F.col(f"{key}.k1").alias("k1"), F.col(f"{key}.k2").alias("k2"), text)


def removal_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    chunk_fragments: int = CHUNK_FRAGMENTS,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is left) for every row.

    A byte is removed if a window of ``length`` bytes over it also starts anywhere else, in its
    own document or another. Null texts are empty; texts under ``length`` bytes keep everything.
    Rows that repeat are documents of their own and so copies of each other; a null id is an id
    like others. An empty table gives an empty result. Other columns are not read. The hash is
    that of the bytes that are left; the text lacks bytes of characters that a cut parts.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    keyed = _keyed(rows, "text", length, "key")
    cuts = text_cuts(_texts(keyed, "text", "key"), length, chunk_fragments)
    cuts = cuts.select(F.struct("k1", "k2").alias("key"), "n_removed", "n_spans", "kept_sha256", "kept")
    joined = keyed.join(cuts, "key", "left")
    return joined.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", F.sha2(F.col("text").cast("binary"), 256)).alias("kept_sha256"),
        F.coalesce("kept", "text").alias("text"),
    )


def without_repeats(
    docs: DataFrame, text_col: str = "text", length: int = LENGTH, chunk_fragments: int = CHUNK_FRAGMENTS
) -> DataFrame:
    """``docs`` with repeated bytes taken out of the texts; all rows and other columns stay,
    whatever their names, repeated rows and null ids too.

    Null texts stay null, texts under ``length`` bytes and an empty table stay as they are. Bytes
    of a character that a cut parts are left out as well.
    """
    key, kept = free_names(docs, "key", "kept")
    keyed = _keyed(docs, text_col, length, key)
    cuts = text_cuts(_texts(keyed, text_col, key), length, chunk_fragments).select(
        F.struct("k1", "k2").alias(key), F.col("kept").alias(kept)
    )
    text = F.coalesce(F.col(kept), F.col(f"`{text_col}`"))
    joined = keyed.join(cuts, key, "left").withColumn(text_col, text)
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
