"""Filter audit, importance resampling and secret scan against SQL and brute force."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from itertools import permutations
from zlib import crc32

import pytest
from compare import differences, duckdb_views

from daygrid.llm import filteraudit, resample, secretscan
from daygrid.llm.queries import ORACLE, REGISTRY

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, id long, mask int, found string, rank int, score string, n long"


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, copies, repeated rows, empty and long texts, names that clash with inner ones."""
    rng = random.Random(4)
    words = ["Ape", "bee", "cat$", "DOG", "é😀x", "e1", "f-g", "H\x00i", "\x1c", "ſ", "\x85z"]
    texts = [None, "", " \n\t\x0b\x0c\r", "a" * 9000, "A b " * 300, "x|y " * 150_000]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(0, 400))) for _ in range(40)]
    texts += [texts[10], texts[10], texts[11], texts[1]]
    rows = [(i, t, rng.choice(["s", "t", None, ""]), 7, 3, "f", 2, "s", 1) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, texts[12], "s", 1, 1, "", 1, "", 1), (None, "alone", "s", 1, 1, "", 1, "", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_resample"])
def test_query_equals_oracle(spark, name):
    assert differences(REGISTRY[name](spark, SF_DIR), duckdb_views(SF_DIR), ORACLE[name]) == []


def brute_mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    bits = [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    ]
    return sum(1 << i for i, b in enumerate(bits) if b)


def brute_audit(rows, good, toxic):
    """rows: (id, text, part)."""
    parts = {}
    late = 1 << 63
    for doc_id, text, part in rows:
        text, key = text or "", late if doc_id is None else doc_id
        copied = any((late if i is None else i) < key and (t or "") == text for i, t, _ in rows)
        parts.setdefault(part or "", []).append((brute_mask(text) | 16 * copied, doc_id in good, doc_id in toxic))
    out = set()
    for part, docs in parts.items():
        shapley, lines = Counter(), []
        for order in permutations(range(5)):
            left, gone = docs, []
            for step, f in enumerate(order, 1):
                fails = [d for d in left if d[0] >> f & 1]
                left = [d for d in left if not d[0] >> f & 1]
                shapley[f] += len(fails)
                lines.append((
                    "".join("ABCDE"[i] for i in order), step, f, len(left), len(fails),
                    sum(d[0] >> f & 1 for d in gone), sum(d[0] == 1 << f for d in docs),
                    sum(d[1] for d in fails), sum(d[2] for d in fails),
                ))
                gone = gone + fails
        out |= {(part, o, s, *more, shapley[f]) for o, s, f, *more in lines}
    return out


def test_audit_of_hard_rows_equals_brute_force(spark, hard):
    labels = spark.createDataFrame(
        [(3, 1, 0), (3, 0, 1), (9, 1, None), (10, 0, 1), (None, 1, 1), (9, None, 1), (777, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = {tuple(r) for r in filteraudit.filter_audit(hard, labels).collect()}
    rows = [(r.doc_id, r.text, r.source) for r in hard.collect()]
    assert got == brute_audit(rows, {3, 9}, {3, 9, 10})


def test_diagram_swaps_visit_every_order():
    rng = random.Random(2)
    for n in (1, 2, 3, 5):
        names = "ABCDE"[:n]
        weights = {m: tuple(rng.randint(0, 5) for _ in range(3)) for m in range(1 << n) if rng.random() < 0.8}
        got = {(row[0], row[1]): row[2:4] for row in filteraudit.audit_part(names, weights)}
        assert len(got) == n * math.factorial(n)
        for order in permutations(range(n)):
            before = 0
            for step, f in enumerate(order, 1):
                removed = sum(w[0] for m, w in weights.items() if m >> f & 1 and not m & before)
                before |= 1 << f
                kept = sum(w[0] for m, w in weights.items() if not m & before)
                assert got["".join(names[i] for i in order), step] == (kept, removed)


def test_diagram_merges_equal_nodes():
    diagram = filteraudit.Diagram(5, {m: (1, 0, 0) for m in range(32)}, 3)
    assert [len(level) for level in diagram.levels] == [1] * 5
    for k in filteraudit.adjacent_swaps(5):
        diagram.swap(k)
        assert [len(level) for level in diagram.levels] == [1] * 5


def brute_ranks(rows, target, least=1, most=1, buckets=10_000):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}

    def features(text):
        words = word.findall((text or "").translate(lower))
        grams = [
            " ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)
        ]
        return len(words), [crc32(g.encode()) % buckets for g in grams]

    made = [(i, *features(t)) for i, t in rows]
    s = Counter(b for _, _, f in made for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in s
    }
    out = []
    for i, words, found in made:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(able[: 10 * len(able) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize(("least", "most", "buckets"), [(1, 1, 10_000), (1, 3, 100_000)])
def test_resampling_of_hard_rows_equals_brute_force(spark, hard, least, most, buckets):
    target = ["Ape bee bee", None, "", "DOG é😀x", "h\x00i \x1c"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    hasher = resample.NgramHasher(buckets, least, most)
    got = resample.importance_ranks(hard, frame, hasher=hasher).collect()
    wanted = brute_ranks([(r.doc_id, r.text) for r in hard.collect()], target, least, most, buckets)
    assert Counter(map(tuple, got)) == wanted
    ranks = sorted(r.rank for r in got if r.rank is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_drawn_documents_keep_their_columns(spark, hard):
    target = spark.createDataFrame([("ape bee",)], "text string")
    drawn = resample.resampled(hard, target)
    ids = {r.doc_id for r in resample.importance_ranks(hard, target).where("rank is not null").collect()}
    assert drawn.columns == hard.columns and {r.doc_id for r in drawn.collect()} == ids - {None}
    named = resample.resampled(hard.withColumnRenamed("n", "drawn"), target)
    assert named.columns[-1] == "drawn" and {r.doc_id for r in named.collect()} == ids - {None}


def test_empty_tables(spark, empty, hard):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    target = spark.createDataFrame([], "text string")
    assert filteraudit.filter_audit(empty, labels).collect() == []
    assert resample.importance_ranks(empty, target).collect() == []
    assert secretscan.scan_report(empty).collect() == []
    assert resample.importance_ranks(hard, target).count() == hard.count()


def brute_base(text):
    spans = []
    assign = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, (pattern, group, least) in enumerate(
        [(assign, 2, 12), (r"AKIA[A-Z0-9]+", 0, 18), (r"[0-9a-f]+", 0, 16)]
    ):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m.group(group)) >= least:
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def report(spans):
    return ",".join(f"{secretscan.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_texts():
    rng = random.Random(6)
    parts = ["password", "Token", "api_key", "SECRET", "AKIA", "AKIAAKIA", "0123456789abcdef", "=", ": ", "\"", "'",
             " ", "  ", "\n", "abcdefABCDEF1234", "é😀", "x9", "Z" * 9, "+", "${a}", "f\"", "(", ")", "<", ">", "b=", "]", "["]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return [None, "", "token: secret: abcdefghijklmnop", "toKen=" + "a" * 20, *texts]


def test_base_spans_equal_brute_force(spark):
    texts = secret_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in secretscan.scan_report(frame).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        base, row = brute_base(text or ""), rows[i]
        counts = Counter(k for _, k, _ in base)
        assert (row.n_assign, row.n_access, row.n_hex) == (counts[0], counts[1], counts[2])
        assert row.base_sha256 == sha256(report(base).encode()).hexdigest()
        listed = row.spans.split(",") if row.spans else []
        assert [s for s in listed if not s.startswith("literal:")] == [s for s in report(base).split(",") if s]
        assert listed == sorted(listed, key=lambda s: (int(s.split(":")[1]), secretscan.KINDS.index(s.split(":")[0])))


def test_secret_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in REGISTRY["op13_secrets"](spark, SF_DIR).collect()}
    assert set(rows) == set(docs)
    for i, text in docs.items():
        base = brute_base(text or "")
        assert rows[i].base_sha256 == sha256(report(base).encode()).hexdigest()
        assert set(report(base).split(",")) <= set(rows[i].spans.split(","))


SECRET = "q8#Lm2vX"
FOUND = [
    f'pwd = "{SECRET}"',
    f'{{"password": "{SECRET}", "user": "bob"}}',
    f'BASE = "{SECRET}"\nself.db_password = BASE',
    f'a = "{SECRET}"\nb = a\nc = b\nauth_token = c',
    f'db.part = "{SECRET}"\nauth_token = other.part',
    f'password: str = "{SECRET}"',
    f'String password = "{SECRET}";',
    f'var password string = "{SECRET}"',
    f'char password[] = "{SECRET}";',
    f'password := `{SECRET}`',
    f"const apiSecret = '{SECRET}';",
    f'$password = "{SECRET}";',
    f'"token" => "{SECRET}"',
    f'os.environ["DB_PASSWORD"] = "{SECRET}"',
    f"export DB_PASSWD={SECRET}\n",
    f"X={SECRET}\nexport DB_PASSWD=$X\n",
    f"password: {SECRET}\nuser: x",
    f"spring.datasource.password={SECRET}",
    f"<password>{SECRET}</password>",
    f'<add key="DbPassword" value="{SECRET}"/>',
    f"define('DB_PASSWORD', '{SECRET}');",
    f'password = PW\nPW = "{SECRET}"',
    f'config = \'{{"password": "{SECRET}"}}\'',
    f'token: secret: "{SECRET}"\npasswd = (\n  "{SECRET}"\n)',
    f'connect(host="h", password="{SECRET}")',
]
CLEAN = [
    "a = b\nb = a\npassword = a + b",
    "Password: required. The token: something here, secret = unknown",
    'token_count = "a81jf93kf"',
    f'password = getPassword("{SECRET}")',
    'password = "changeme-1234"',
    'password = "<your password 1A>"',
    'password = ""',
    f'if password == "{SECRET}": pass',
    "max_tokens = 4096000000",
    'public_key = "Kd93jf!a8QKd93jf!a8Q"',
    'user = "Kd93jf!a8QKd93jf!a8Q"',
    'password_url = "https://h/p?a=81jf93kf"',
    "The key: it was 9 years ago, the author = J0hn.",
]


@pytest.mark.parametrize("text", FOUND)
def test_literals_that_reach_sensitive_names(text):
    found = {text[s:e] for s, k, e in secretscan.secret_spans(text) if k == 3}
    assert found == {SECRET}


@pytest.mark.parametrize("text", CLEAN)
def test_other_literals_are_left_alone(text):
    assert [s for s in secretscan.secret_spans(text) if s[1] == 3] == []


def test_secrets_in_pieces():
    text = 'part1 = "Zx81kQ9w"\npart2 = "77hhTTq2"\nclient_secret = part1 + part2\n'
    assert [text[s:e] for s, _, e in secretscan.secret_spans(text)] == ["Zx81kQ9w", "77hhTTq2"]
    text = 'k = "abc12"\nsecret = f"{k}9Zq!{k}"'
    assert [text[s:e] for s, _, e in secretscan.secret_spans(text)] == ["abc12", "9Zq!"]
    text = 'é = "é😀"\npwd = "' + SECRET + '"'
    assert [text[s:e] for s, _, e in secretscan.secret_spans(text)] == [SECRET]


def test_constants_that_double_end():
    text = "a0 = 'Zx81kQ9w'\n" + "".join(f"a{i + 1} = a{i} + a{i}\n" for i in range(3000)) + "pwd = a3000\n"
    assert [text[s:e] for s, _, e in secretscan.secret_spans(text)] == ["Zx81kQ9w"]


def test_rows_that_clash_repeat_or_lack_ids(spark, hard):
    rows = secretscan.scan_report(hard).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in hard.collect())
