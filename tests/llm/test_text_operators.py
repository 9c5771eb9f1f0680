"""Quality, SimHash, suffixes, pieces, token counts and packing against brute force."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from daygrid.llm import packing, pieces, quality, simhash, suffixes, tokencount
from daygrid.llm.components import components
from daygrid.llm.queries import PIECES, REGISTRY, WORDS, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, units int"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def hard_texts():
    rng = random.Random(5)
    made = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [made(rng.randint(300, 900)) for _ in range(4)]
    texts = [None, "", " ", "a" * 3000, "a" * 1200, "ab" * 900, "x" * 399, "x" * 400, "<s> 😀\x00▁▁ <|endoftext|>"]
    for _ in range(30):
        parts = [rng.choice([made(rng.randint(0, 700)), rng.choice(shared)]) for _ in range(rng.randint(1, 5))]
        texts.append("".join(parts))
    texts += texts[20:23] + [texts[25][:500] + "z" + texts[25][500:], "word " * 60_000]
    return texts


@pytest.fixture(scope="module")
def hard(spark):
    """Null ids, repeated rows, empty and long texts, columns whose names clash with inner ones."""
    rows = [(i, t, "en", "s", len(t or ""), i, 7) for i, t in enumerate(hard_texts())]
    rows += [rows[9], (None, "lonely text", None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(empty, labels)
    for frame in (
        quality.score(empty, model),
        quality.keep_good(empty, model),
        simhash.near_duplicates(empty),
        simhash.keep_one(empty),
        suffixes.removal_report(empty),
        suffixes.without_repeats(empty),
        pieces.encode_decode(empty, tokenizer_path(PIECES)),
        tokencount.count_tokens(empty, tokenizer_path(PIECES)),
        packing.pack(empty, tokenizer_path(WORDS)),
    ):
        assert frame.collect() == []


def test_quality_learns_and_holds_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels))
    held = scored.join(labels, "doc_id").where("held_out")
    right = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.97
    for row in scored.limit(50).collect():
        assert row.held_out == (crc32(str(row.doc_id).encode()) % 3 == 1)


def brute_statistics(text):
    """The document statistics by plain loops over characters and words."""
    text = text or ""
    data = text.encode()
    words, lines = re.findall(rb"[^ \t-\r]+", data), data.split(b"\n")
    upper, lower = len(re.findall(rb"[A-Z]", data)), len(re.findall(rb"[a-z]", data))
    inked = max(1, sum(c not in b" \t\n\x0b\x0c\r" for c in data))
    n = max(1, len(words))
    marks = [c for c in data if 32 < c < 127 and not chr(c).isalnum()]
    shares = [
        upper / max(1, upper + lower),
        len(marks) / inked,
        sum(chr(c) not in ".,;:'\"()-?!" for c in marks) / inked,
        data.count(b"!") / inked,
        data.count(b"|") / inked,
        len(re.findall(rb"[0-9]", data)) / inked,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        1 - len(set(lines)) / len(lines),
        sum(a == b for a, b in zip(data, data[1:], strict=False)) / max(1, len(data)),
    ]
    arcs = [math.asin(math.sqrt(s)) for s in shares]
    herdan = math.log1p(len(set(words))) / math.log1p(n)
    return [math.log1p(len(data)), *arcs[:6], herdan, *arcs[6:8], math.log1p(inked / n), arcs[8]]


def brute_scores(texts, labels):
    """Scores of {id: text} from {id: label}, with whole covariance matrices and no factors."""
    x = {i: np.array(brute_statistics(t)) for i, t in texts.items()}
    learned = {k: [x[i] for i, q in labels.items() if q == k and i in x and crc32(str(i).encode()) % 3 != 1] for k in (0, 1)}
    everything = np.array(learned[0] + learned[1])
    centre, scale = everything.mean(axis=0), np.sqrt(np.maximum(everything.var(axis=0), 1e-8))
    z = {k: (np.array(rows) - centre) / scale for k, rows in learned.items()}
    n = {k: len(rows) for k, rows in z.items()}
    own = {k: np.cov(rows.T, bias=True) for k, rows in z.items()}
    pooled = (n[0] * own[0] + n[1] * own[1]) / (n[0] + n[1])
    prior = (n[1] + 1) / (n[0] + n[1] + 2)
    logs = []
    for k in (0, 1):
        mixed = (n[k] * own[k] + quality.POOLED_ROWS * pooled) / (n[k] + quality.POOLED_ROWS)
        target = np.diag(np.maximum(np.diag(pooled), 1e-3))
        covariance = (1 - quality.SHRINKAGE) * mixed + quality.SHRINKAGE * target
        inverse, log_det = np.linalg.inv(covariance), np.linalg.slogdet(covariance)[1]
        mean = z[k].mean(axis=0)
        logs.append({i: -0.5 * ((v - centre) / scale - mean) @ inverse @ ((v - centre) / scale - mean) - 0.5 * log_det for i, v in x.items()})
    odds = {i: logs[1][i] - logs[0][i] + math.log(prior / (1 - prior)) for i in x}
    return {i: 1 / (1 + math.exp(-max(-700, min(700, o)))) for i, o in odds.items()}


def test_quality_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    expected = brute_scores(texts, labels)
    rows = REGISTRY["op1_quality"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for row in rows:
        assert abs(row.score - expected[row.doc_id]) < 1e-9
        assert row.predicted == int(row.score >= 0.5)


def test_quality_of_hard_texts(spark, hard):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score(hard, quality.fit(hard, labels)).collect()
    assert len(rows) == hard.count()
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5) for row in rows)
    assert quality.keep_good(hard, quality.fit(hard, labels)).columns == hard.columns


def test_quality_of_few_labels(spark):
    rng = random.Random(8)
    prose = lambda: " ".join("".join(rng.choice("etaoinsr") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 200))) + "."
    noise = lambda: " ".join(rng.choice(["BUY", "NOW!!!", "$$$", "9999", "||", "WIN"]) for _ in range(rng.randint(60, 200)))
    ids = [i for i in range(1000) if crc32(str(i).encode()) % 3 != 1]
    for good, bad in ((15, 40), (40, 15), (2, 40), (2, 2)):
        rows = [(i, prose() if k % 2 else noise()) for k, i in enumerate(ids[:200])]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        marked = [(i, 1) for i in ids[1:200:2][:good]] + [(i, 0) for i in ids[:200:2][:bad]]
        labels = spark.createDataFrame(marked, "doc_id long, quality int")
        kept = {r.doc_id for r in quality.keep_good(docs, quality.fit(docs, labels)).collect()}
        wanted = set(ids[1:200:2])
        assert len(kept ^ wanted) <= (0 if min(good, bad) > 2 else 10), (good, bad, len(kept & wanted), len(kept - wanted))
    # Labels of one side or none fit nothing, and nothing is dropped.
    for marked in ([(i, 0) for i in ids[:40]], [(ids[0], 1)] + [(i, 0) for i in ids[1:40]]):
        model = quality.fit(docs, spark.createDataFrame(marked, "doc_id long, quality int"))
        assert quality.keep_good(docs, model).count() == 200


def expected_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_labels(n, linked):
    labels = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if labels[j] < labels[i] and linked(i, j):
                    labels[i], changed = labels[j], True
    return labels


def test_simhash_equals_brute_force(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    ids = sorted(texts)
    prints = [expected_fingerprint(texts[i]) for i in ids]
    labels = least_labels(len(ids), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in REGISTRY["op2_simhash"](spark, SF_DIR).collect()}
    assert got == {i: (f"{prints[k]:016x}", ids[labels[k]]) for k, i in enumerate(ids)}


def test_crowded_postings_lose_no_link(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    values = {base}
    while len(values) < 300:
        value = base
        for _ in range(rng.randint(1, 6)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.fingerprint_links(frame)).collect()}
    labels = least_labels(len(values), lambda i, j: (values[i] ^ values[j]).bit_count() <= 2)
    groups = {}
    for k, label in enumerate(labels):
        groups.setdefault(label, set()).add(signed[k])
    got = {}
    for value in signed:
        got.setdefault(roots.get(value, value), set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_keep_one(spark, hard):
    kept = simhash.keep_one(hard)
    assert kept.columns == hard.columns
    found = simhash.near_duplicates(hard.where("doc_id is not null"))
    # The lonely row without an id is a component of its own.
    assert kept.count() == found.select("component_id").distinct().count() + 1


def test_keep_one_of_ids_that_come_again_with_other_texts(spark):
    one, other, third = "a b c d e f", "quite another text than that", "and a third one of its own"
    rows = [(5, one), (6, one), (7, one), (5, other), (8, other), (5, other), (9, third), (None, other), (None, None), (5, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((tuple(r) for r in simhash.keep_one(frame).collect()), key=repr)
    # The texts without words are one component, named by its only id.
    assert kept == sorted([(5, one), (5, other), (9, third), (5, "")], key=repr)


def test_keep_one_leaves_a_column_of_its_key_name(spark):
    rows = spark.createDataFrame([(1, "a b c", "x"), (2, "a b c", "y")], "doc_id long, text string, __key string")
    assert [tuple(r) for r in simhash.keep_one(rows).collect()] == [(1, "a b c", "x")]


def test_scratch_tables_go(spark):
    """Rounds replace each other, the pipeline leaves its result, and no session setting changes."""
    import os

    import corpus_pipeline
    from daygrid.llm import common

    before = dict(spark.conf.getAll)
    begun = common.scratch_tables()
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert components(pairs).count() == 41
    made = common.scratch_tables()[len(begun):]
    assert len(made) == 1 and os.path.isdir(made[0])
    result = corpus_pipeline.run(spark, SF_DIR)
    made = common.scratch_tables()[len(begun) + 1 :]
    assert len(made) == 1 and "stage-packing" in made[0] and result.count()
    common.drop_scratch(spark, common.scratch_tables()[len(begun):])
    assert common.scratch_tables() == begun and not os.path.exists(made[0])
    assert dict(spark.conf.getAll) == before


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 3)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1100)}}


def brute_removal(texts, size=suffixes.LENGTH):
    counts = Counter()
    datas = [(t or "").encode() for t in texts]
    for data in datas:
        counts.update(data[i : i + size] for i in range(len(data) - size + 1))
    out = []
    for data in datas:
        covered = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - size + 1):
            if counts[data[i : i + size]] > 1:
                covered[i : i + size] = True
        edges = np.diff(np.concatenate([[0], covered.astype(int)]))
        kept = np.frombuffer(data, dtype=np.uint8)[~covered].tobytes()
        out.append(
            (len(data), int(covered.sum()), int((edges == 1).sum()), sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"))
        )
    return out


@pytest.mark.parametrize(("length", "chunk_fragments"), [(400, 1000), (400, 3), (200, 1000), (200, 1), (13, 40)])
def test_suffixes_equal_brute_force(spark, length, chunk_fragments):
    texts = hard_texts()[:-1]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    report = suffixes.removal_report(frame, length=length, chunk_fragments=chunk_fragments)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in report.collect()}
    assert got == dict(enumerate(brute_removal(texts, length)))


def test_an_anchor_of_many_texts_goes_in_chunks(spark):
    """One passage in all texts, and edges that some share: chunks find what one task would."""
    rng = random.Random(9)
    made = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, edge = made(700), made(90)
    texts = [made(300) + (edge if k % 5 == 0 else "") + passage + made(200) for k in range(120)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    report = suffixes.removal_report(frame, chunk_fragments=10)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in report.collect()}
    assert got == dict(enumerate(brute_removal(texts)))


def test_multikey_quicksort_orders_groups_and_words():
    rng = np.random.default_rng(3)
    for n, high in ((1, 2), (2, 2), (500, 2), (500, 40), (4000, 3)):
        words = rng.integers(0, high, (n, 4)).astype(np.uint64)
        groups = rng.integers(0, 5, n)
        order, new = suffixes.multikey_quicksort(words, groups)
        rows = [(groups[i], *words[i]) for i in order]
        assert rows == sorted(rows) and sorted(order) == list(range(n))
        assert new.tolist() == [k == 0 or rows[k] != rows[k - 1] for k in range(n)]


@pytest.mark.parametrize("name", ["key", "kept", "__kept", "__copied", "__k1", "__k2", "__text", "k1", "KEPT_", "h"])
def test_suffixes_leave_columns_of_any_name(spark, name):
    shared = "a passage that stands in both texts, " * 6
    rows = [(1, "one " + shared, "x"), (2, "two " + shared, "y"), (3, None, None)]
    frame = spark.createDataFrame(rows, f"doc_id long, text string, `{name}` string")
    got = sorted(tuple(r) for r in suffixes.without_repeats(frame, length=100).collect())
    assert [(r[0], r[2]) for r in got] == [(1, "x"), (2, "y"), (3, None)] and got[2][1] is None
    assert got[0][1] == "one" and got[1][1] == "two"


def test_the_pipeline_removes_passages_of_over_fifty_words(spark):
    """Planted passages go from all documents that hold them, others stay as they are."""
    import corpus_pipeline

    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(51, 70)) for _ in range(8)]
    rows = [(i, f"{prose(120)} {passages[i % 8]} {prose(90)}") for i in range(40)]
    short = prose(20)
    rows += [(100 + i, f"{prose(150)} {short} {prose(40)}") for i in range(30)]
    frame = spark.createDataFrame([(*r, "en", "s", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.suffix_stage(spark, frame, SF_DIR).collect()}
    for i, text in rows:
        if i >= 100:
            assert got[i].text == text
            continue
        before, after = text.split(passages[i % 8])
        # Windows reach over the passage's ends only where the texts around it are equal too.
        assert got[i].text.startswith(before[:-4]) and got[i].text.endswith(after[4:])
        assert len(got[i].text) <= len(before) + len(after) and got[i].n_chars == len(got[i].text)


def test_suffix_query_equals_brute_force(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text)
        for r in REGISTRY["op5_suffix_dedup"](spark, SF_DIR).collect()
    }
    assert got == dict(zip(texts, brute_removal(texts.values()), strict=True))


def test_suffixes_of_hard_rows(spark, hard):
    assert suffixes.removal_report(hard).count() == hard.count()
    cut = suffixes.without_repeats(hard)
    assert cut.columns == hard.columns and cut.count() == hard.count()


def test_blind_trie_sorts():
    rng = random.Random(1)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(200)]
    order, shared = suffixes.deep_shallow_order(strings, np.zeros(200, dtype=np.int64))
    assert [strings[i] for i in order] == sorted(strings)
    assert shared[1:].tolist() == [
        suffixes._common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)
    ]


def sentencepiece_expected(texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    out = []
    for text in texts:
        ids = library.encode(text or "")
        joined = ",".join(map(str, ids)).encode()
        decoded = library.decode(ids) if ids else ""
        out.append((len(ids), sha256(joined).hexdigest(), sha256(decoded.encode()).hexdigest()))
    return out


def test_pieces_equal_the_library(spark, documents, hard):
    for frame in (documents, hard):
        texts = [r.text for r in frame.collect()]
        rows = pieces.encode_decode(frame, tokenizer_path(PIECES)).collect()
        assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows] == sentencepiece_expected(texts)


def test_pieces_of_random_strings():
    import sentencepiece

    path = tokenizer_path(PIECES)
    library, codec = sentencepiece.SentencePieceProcessor(model_file=path), pieces.codec(path)
    count = tokencount.Counter(path, tokencount.whole_tokens(path)).count
    rng = random.Random(3)
    parts = [*codec.model.ids][:4000] + list("aeth \n\t'.,²!é😀ß_09▁中\x00　")
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        ids = library.encode(text)
        assert codec.encode(text) == ids and count(text) == len(ids)
        assert codec.decode(ids) == library.decode(ids)
    assert codec.decode([3 + 0xE2, 3 + 0x82, 3 + 0x41]) == library.decode([3 + 0xE2, 3 + 0x82, 3 + 0x41])


def test_token_counts_equal_the_library(spark, documents, hard):
    for frame in (documents, hard):
        texts = [r.text or "" for r in frame.collect()]
        rows = tokencount.count_tokens(frame, tokenizer_path(PIECES)).collect()
        expected = [n for n, _, _ in sentencepiece_expected(texts)]
        assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in rows] == [
            (len(t.encode()), n, n > 4096) for t, n in zip(texts, expected, strict=True)
        ]


def check_packing(frame, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(WORDS))
    expected = Counter()
    for row in frame.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, packing.END_ID]
        expected[(row.doc_id, np.array(ids, dtype="<u4").tobytes())] += 1
    ids_of = {}
    for doc_id, data in expected:
        ids_of.setdefault(doc_id, []).append(data)
    covered = Counter()
    for row in rows:
        parts = [d[4 * row.start : 4 * (row.start + row.length)] for d in ids_of[row.doc_id]]
        assert row.ids_crc32 in [crc32(p) for p in parts]
        covered[row.doc_id] += row.length
    totals = Counter()
    for (doc_id, data), times in expected.items():
        totals[doc_id] += times * len(data) // 4
    assert covered == totals
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    return sum(packing.WINDOW - sum(n for _, n in p) for p in sequences.values()), len(sequences)


def test_packing(spark, documents, hard):
    for frame in (documents, hard):
        padding, sequences = check_packing(frame, packing.pack(frame, tokenizer_path(WORDS)).collect())
        assert padding <= 0.02 * packing.WINDOW * sequences + packing.WINDOW


def test_word_ids_equal_the_library():
    codec = packing.token_bytes(tokenizer_path(WORDS))
    rng = random.Random(0)
    letters = "aetThßÀé 's 'll \n\t\r.,!$%x012²½'`́İſ\x1c\x85中😀ABC×÷_"
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        text += rng.choice(["", "", "<|endoftext|>x"])
        ids = codec.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(text), dtype="<u4").tolist() == ids


def test_least_squares_finds_exact_mixes():
    a = np.array([[1.0, 0, 2], [0, 1, 1], [0, 0, 1]])
    x = packing.non_negative_least_squares(a, a @ np.array([3.0, 0, 2]))
    assert np.allclose(x, [3, 0, 2], atol=1e-6)


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = [r for r in corpus_pipeline.quality_stage(spark, docs, SF_DIR).collect()]
    scores = {r.doc_id: r.predicted for r in REGISTRY["op1_quality"](spark, SF_DIR).collect()}
    assert {r.doc_id for r in good} == {i for i, p in scores.items() if p == 1}
    good.sort(key=lambda r: r.doc_id)
    prints = [expected_fingerprint(r.text) for r in good]
    labels = least_labels(len(good), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    single = [r for k, r in enumerate(good) if labels[k] == k]
    removed = brute_removal([r.text for r in single], corpus_pipeline.PASSAGE)
    kept = {r.doc_id: text for r, (*_, text) in zip(single, removed, strict=True)}
    frame = spark.createDataFrame(single, docs.schema)
    cut = corpus_pipeline.suffix_stage(spark, frame, SF_DIR)
    assert cut.columns == docs.columns
    for row in cut.collect():
        assert row.text == kept[row.doc_id]
        assert row.n_chars == len(row.text)
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in single}
    check_packing(cut, rows)
