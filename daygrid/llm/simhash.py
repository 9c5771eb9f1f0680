"""SimHash near-duplicates: a byte-position inverted index with count filtering."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import per_row, staged
from daygrid.llm.components import components

SEED = 42
SHINGLE = 3
#: Two fingerprints that differ in MOST_BITS bits or fewer share at least 8 - MOST_BITS bytes.
MOST_BITS = 2
#: Members up to which a posting's pairs are tallied one by one; larger ones go by bit flips.
POSTING_PAIRS = 16
_BLOCK = 65_536


def text_fingerprint(text: str | None) -> int:
    """SimHash of word shingles as a signed 64-bit number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    width = min(SHINGLE, len(words))
    first, last = starts[: len(words) - width + 1], ends[width - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), _BLOCK):
        a, b = first[at : at + _BLOCK].tolist(), last[at : at + _BLOCK].tolist()
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b, strict=True)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    set_bits = (2 * ones > len(first)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark_col: str | None = None
) -> DataFrame:
    """(doc_id, fp) of every row, and its mark if named; whole texts, null texts are empty ones."""

    def make(batch):
        made = {
            "doc_id": batch.column(0),
            "fp": [text_fingerprint(t) for t in batch.column(1).to_pylist()],
        }
        return made | {"mark": batch.column(2)} if mark_col else made

    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    if mark_col:
        columns.append(F.col(mark_col).alias("mark"))
    return per_row(docs.select(*columns), "doc_id long, fp long" + ", mark long" * bool(mark_col), make)


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(255)


def _postings(fps: DataFrame) -> DataFrame:
    """Index entries: four byte positions out of two of four blocks, and the values there.

    Two differing bits touch two of the four two-byte blocks at most, so fingerprints that
    link agree on one of the six pairs of blocks and meet under that entry.
    """
    fp = F.col("fp")
    blocks = [F.shiftrightunsigned(fp, 16 * b).bitwiseAND(0xFFFF) for b in range(4)]
    entries = [
        F.struct(F.lit(k).alias("place"), (F.shiftleft(blocks[i], 16).bitwiseOR(blocks[j])).alias("value"))
        for k, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.place", "e.value")


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints whose components are those of all links.

    Under an entry with few members, pairs are formed in the join that tallies their shared
    positional bytes, keeps those with the guaranteed minimum and verifies the bits. Members
    of crowded entries are expanded once each to their 64 one-bit neighbours and themselves:
    two of them link exactly if they share one of these values, and no value has more than
    65 members. So no group's pairs are enumerated and no link is lost.
    """
    postings = _postings(fps)
    sizes = postings.groupBy("place", "value").agg(F.count("*").alias("members")).where("members > 1")
    small = sizes.where(F.col("members") <= POSTING_PAIRS).drop("members")
    crowded = sizes.where(F.col("members") > POSTING_PAIRS).drop("members")
    met = postings.join(small, ["place", "value"])
    left, right = met.alias("l"), met.alias("r")
    shared = sum(
        (_byte(F.col("l.fp"), p) == _byte(F.col("r.fp"), p)).cast("int") for p in range(8)
    )
    pairs = left.join(
        right,
        (F.col("l.place") == F.col("r.place"))
        & (F.col("l.value") == F.col("r.value"))
        & (F.col("l.fp") < F.col("r.fp"))
        & (shared >= 8 - MOST_BITS)
        & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= MOST_BITS),
    ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    dense = postings.join(crowded, ["place", "value"]).select("fp").distinct()
    masks = F.array(*[F.lit(np.array(1 << b, dtype="<u8").view("<i8").item()) for b in range(64)], F.lit(0))
    flips = F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))
    stars = (
        dense.select("fp", F.explode(flips).alias("near"))
        .groupBy("near")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    )
    return pairs.unionByName(stars).where("a != b")


def _rooted(prints: DataFrame) -> DataFrame:
    """(fp, first_id, root) of every distinct fingerprint: its least doc_id and its component."""
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fp")
    roots = components(fingerprint_links(distinct.select("fp")))
    return distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id.

    Texts link at MOST_BITS or fewer differing bits; texts without words have fingerprint 0
    and link like others. Rows that repeat, also with one doc_id, are rows of their own. A
    null doc_id gets its row, but is never a component's id while the component has another.
    Columns of ``docs`` other than the two named ones are not read.
    """
    prints = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    rooted = _rooted(prints)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` but for all but one of each component; all columns stay.

    The row with the component's id stays; of its rows that repeat that id, one does. An id may
    come in several components with texts of its own, so a row is known by its id and its text's
    hash. Rows with a null id count as rows of their own, after all others.
    """
    key, mark = "__key", "__mark"
    while {key, mark} & {name.lower() for name in docs.columns}:
        key, mark = key + "_", mark + "_"
    spare = F.lit(1 << 62) + F.monotonically_increasing_id()
    keyed = docs.withColumn(key, F.coalesce(F.col(f"`{id_col}`").cast("long"), spare))
    keyed = keyed.withColumn(mark, F.xxhash64(F.col(f"`{text_col}`")))
    prints = staged(fingerprints(keyed, key, text_col, mark), "fingerprints")
    # A fingerprint's least id is enough: the component's least id is one of these.
    rooted = _rooted(prints).withColumnRenamed("first_id", "doc_id")
    firsts = prints.join(rooted, ["fp", "doc_id"])
    keep = (
        firsts.groupBy("root")
        .agg(F.min(F.struct("doc_id", "mark")).alias("one"))
        .select(F.col("one.doc_id").alias(key), F.col("one.mark").alias(mark))
    )
    return keyed.join(keep, [key, mark], "left_semi").dropDuplicates([key, mark]).drop(key, mark)
