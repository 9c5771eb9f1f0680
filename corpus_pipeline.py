"""From documents to packed training sequences: quality, near-duplicates, repeats, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm import packing, quality, simhash, suffixes
from daygrid.llm.common import read_table, scratch_tables, staged_in_place_of
from daygrid.llm.queries import WORDS, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled ones among them, doesn't reject."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return simhash.keep_one(docs)


#: Bytes of a repeated passage that goes: 50 words of three letters and a space. Nearly all
#: passages of over 50 words are longer, and few sentences are.
PASSAGE = 200


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of PASSAGE bytes or more that also stand elsewhere, with their
    new lengths. Null texts stay null; all rows and columns stay."""
    cut = suffixes.without_repeats(docs, length=PASSAGE)
    if "n_chars" not in cut.columns:
        return cut
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return cut.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs, tokenizer_path(WORDS))


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("suffixes", suffix_stage),
    ("packing", packing_stage),
]

#: SQL can't express tokenizing and fingerprints; a test holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents; each one's result is written and read again, and what came
    before it is deleted. The last one's stays until `common.drop_scratch`."""
    docs, begun = read_table(spark, sf_dir, "documents"), len(scratch_tables())
    for name, stage in STAGES:
        docs = staged_in_place_of(stage(spark, docs, sf_dir), f"stage-{name}", begun)
    return docs
