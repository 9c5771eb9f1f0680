"""The registered queries of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daygrid.llm import (
    ann, filteraudit, packing, pages, pieces, quality, resample, secretscan, simhash, suffixes,
    tokencount, vectordedup, warc,
)
from daygrid.llm.common import read_table, scratch_path

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    """Where the public tokenizers' package has a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectordedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "pages")
    return pages.extract(table, pages.fit_weights(table))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_report(read_table(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.dedup_records(read_table(spark, sf_dir, "pages")), path)
    return warc.resolve_revisits(warc.read_archives(spark, path, payloads=False))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(WORDS))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.filter_audit(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance_ranks(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan_report(read_table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_quality, op2_simhash, op3_vector_dedup, op4_main_text, op5_suffix_dedup, op6_pieces,
        op7_neighbours, op8_warc, op9_token_counts, op10_packing, op11_filter_audit, op12_resample,
        op13_secrets,
    )
}

_OP3 = """
WITH RECURSIVE valid AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), found AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, f.component_id, e.vec_id = f.component_id AS kept
FROM embeddings e JOIN found f USING (vec_id) LEFT JOIN counts c USING (vec_id)
"""

_OP8 = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hexed
  FROM pages
), bits AS (
  SELECT *, list_transform(range(8), lambda g: list_sum(list_transform(range(5), lambda d:
    ((strpos('0123456789abcdef', substr(hexed, (5 * g + d + 1)::INT, 1)) - 1) << (16 - 4 * d)::INT)))::BIGINT) AS words
  FROM hashed
), named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (1 + ((words[(i // 4 + 1)::INT] >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest
  FROM bits
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM named WINDOW w AS (PARTITION BY payload_digest)
"""

_OP11 = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (doc_id > first_id)::INT AS mask,
    coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic
  FROM texts LEFT JOIN marks USING (doc_id)
), counts AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask
), letters AS (SELECT unnest(range(5)) AS f), orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT array_to_string(list_transform(o, lambda f: substr('ABCDE', (f + 1)::INT, 1)), '') AS filter_order,
    step, (1 << o[step])::INT AS own,
    coalesce(list_sum(list_transform(o[1:step - 1], lambda f: (1 << f)::INT)), 0)::INT AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), results AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER ((mask & (own | earlier)) = 0) AS kept,
    sum(n) FILTER ((mask & own) <> 0 AND (mask & earlier) = 0) AS removed,
    sum(n) FILTER ((mask & own) <> 0 AND (mask & earlier) <> 0) AS redundant,
    sum(n) FILTER (mask = own) AS unique_fails,
    sum(good) FILTER ((mask & own) <> 0 AND (mask & earlier) = 0) AS good_lost,
    sum(toxic) FILTER ((mask & own) <> 0 AND (mask & earlier) = 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
  coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM results
"""

# DuckDB has no CRC: the usual table of 256 remainders is made by rule, and every distinct word's
# bytes go through it once.
_OP12 = """
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)
    ORDER BY i) AS tab
  FROM (SELECT unnest(range(256)) AS i)
), split AS (
  SELECT 0 AS side, doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
  UNION ALL SELECT 1, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
), used AS (
  SELECT side, id, word, count(*) AS n FROM (SELECT side, id, unnest(words) AS word FROM split) GROUP BY ALL
), hexed AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM used)), hashed AS (
  SELECT word, xor(list_reduce(range(len(x) // 2), lambda c, k:
    xor(c >> 8, tab[(xor(c, ('0x' || substr(x, (2 * k + 1)::INT, 2))::BIGINT) & 255) + 1]), 4294967295), 4294967295)
    % 10000 AS bucket
  FROM hexed, crc_table
), placed AS (SELECT side, id, bucket, n FROM used JOIN hashed USING (word)), sums AS (
  SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM placed GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0) AS alls, coalesce(sum(t), 0) AS allt FROM sums), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (alls + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * (allt + 10000)::DOUBLE)))::BIGINT AS gain
  FROM sums, totals
), weights AS (
  SELECT id, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS total FROM placed JOIN gains USING (bucket)
  WHERE side = 0 GROUP BY id
), scores AS (
  SELECT doc_id, coalesce(n, 0) AS n_features,
    coalesce((total - (total % n + n) % n) // n, 0) AS weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN weights ON doc_id = id
), noisy AS (
  SELECT doc_id, n_features, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM scores
), placed_docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn
  FROM noisy WHERE n_features >= 20
)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  (CASE WHEN place <= drawn THEN place END)::BIGINT AS rank
FROM noisy LEFT JOIN placed_docs USING (doc_id)
"""

#: Statements for what SQL can express; the other queries are tested against brute force.
ORACLE = {
    "op3_vector_dedup": _OP3,
    "op8_warc": _OP8,
    "op11_filter_audit": _OP11,
    "op12_resample": _OP12,
}
