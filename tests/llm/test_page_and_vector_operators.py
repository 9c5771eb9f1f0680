"""Main text, WARC archives, vector near-duplicates and neighbours against brute force."""

import base64
import hashlib
import re
from html import unescape

import numpy as np
import pandas as pd
import pytest
from compare import differences, duckdb_views

from daygrid.llm import ann, pages, vectordedup, warc
from daygrid.llm.common import scratch_path
from daygrid.llm.queries import ORACLE, REGISTRY

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, digest string"


def article(html):
    inner = html[html.index("<article>") + 9 : html.index("</article>")]
    blocks = (unescape(re.sub(r"<[^>]+>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(" ".join(b.split()) for b in blocks if b.strip())


def test_main_text_equals_articles(spark):
    table = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    html = {r.page_id: r.html for r in table.collect()}
    rows = REGISTRY["op4_main_text"](spark, SF_DIR).collect()
    assert {r.page_id: r.text for r in rows} == {i: article(h) for i, h in html.items()}
    assert all(r.n_chars == len(r.text) for r in rows)
    # Pages that don't mark their article give the same text with the weights of those that do.
    weights = pages.fit_weights(table)
    for page in html.values():
        bare = page.replace("<article>", "<div>").replace("</article>", "</div>")
        assert pages.main_text(bare, weights) == article(page)


def test_main_text_leaves_other_matter_out():
    html = """<html><head><title>T</title><script>if (a < b) "</p>"</script></head><body>
    <header class="site-header"><a href=/>Home</a></header><div id="cookie-notice"><p>We use cookies here</p></div>
    <main><header><h1>The   title</h1></header><p>First &amp; <b>best</b>
    words&nbsp;here<br>again.</p><aside><p>Read also this</p></aside><div class='ad'>Buy now</div>
    <form><p>Your name</p></form><!-- <p>hidden</p> --><ul><li>One</li><li>Two</ul><p>Last words
    </main><section class="comments"><p>A comment of a reader, long enough to count as text.</p></section>
    <footer>&copy; us</footer></body></html>"""
    text = pages.main_text(html, dict(pages.PRIOR))
    assert text == "The title\nFirst & best words here again.\nOne\nTwo\nLast words"


def test_main_text_in_elements_whose_names_speak_against_it():
    words = "<p>Some words of a long paragraph that the page is about.</p>"
    line = "Some words of a long paragraph that the page is about."
    weights = dict(pages.PRIOR)
    menu = "<div class=sidebar><p>Words of the side column that belong to no text.</p></div>"
    for page in (
        f'<body class="overflow-hidden">{words}',
        f'<body style="display:none" hidden>{words}',
        f'<main class="overflow-hidden">{words}</main>{menu}',
        f'<article id="hidden-figures" data-x="hidden">{words}</article>',
        f'<div class="layout with-sidebar"><article>{words}</article>{menu}</div>',
        f'<div class="page header-fixed"><article>{words}</article></div><footer>us</footer>',
        f'<div class="layout with-sidebar">{words}</div><div class=footer><p>All rights</p></div>',
        f"<form action=/><aside><main>{words}</main></aside></form><p>All rights</p>",
        f"<form action=/>{words}</form>",
        f'<div class="page"><article>{words}</article></div><div class=related><article>{menu}</article></div>',
        f'<div class="with-sidebar"><article>{words}</article><aside><article><p>Read that</p></article></aside></div>',
        f"<article>{words}<div class='ad'>Buy now, all of it must go</div></article>",
        f"<article>{words}<div hidden><p>Not to be seen</p></div><p style='display: none'>Nor this</p></article>",
    ):
        assert pages.main_text(page, weights) == line, page
    for name in ("id=discussion", 'id="social-media-study"', 'class="search"'):
        page = f"<article>{words}<section {name}><h2>More</h2>{words}</section>{words}</article>"
        assert pages.main_text(page, weights) == f"{line}\nMore\n{line}\n{line}", page


OTHER_MATTER = [
    '<div class="comment">{}</div>', '<article class="comment">{}</article>', '<div id="disqus_thread">{}</div>',
    '<div class="notice">{}</div>', '<div class="alert alert-info">{}</div>', '<div class="cookie-bar">{}</div>',
    '<div class="advertising">{}</div>', '<div class="promotion">{}</div>', '<div class="banner">{}</div>',
    '<div class="related">{}</div>', '<ins class="adsbygoogle">{}</ins>', '<ol class="commentlist"><li>{}</li></ol>',
    '<span class="advert">{}</span>', '<div class="commentThread">{}</div>', '<section class="comments">{}</section>',
    '<section class="reply">{}</section>', '<div id="newsletter-box">{}</div>', '<ul class="breadcrumbs"><li>{}</ul>',
]


@pytest.mark.parametrize("box", OTHER_MATTER)
def test_main_text_without_comments_notices_and_adverts(box):
    """Within an article, beside one, and on pages that mark none."""
    first = "The first words of a long paragraph that the page is about."
    last = "And the last words of it, which come after what has to go."
    matter = box.format("Words of a reader or a seller that belong to no article, said at some length.")
    weights = dict(pages.PRIOR)
    for page in (
        f"<body><article><p>{first}</p>{matter}<p>{last}</p></article>",
        f"<body><article><p>{first}</p><p>{last}</p></article>{matter}",
        f"<body><main><article><p>{first}</p><p>{last}</p></article>{matter}</main>",
        f"<body><div><p>{first}</p>{matter}<p>{last}</p></div>",
        f"<body><p>{first}</p><p>{last}</p>{matter}",
    ):
        assert pages.main_text(page, weights) == f"{first}\n{last}", page


def test_inline_boxes_keep_their_words():
    page = "<article><p>One <span class=x>two <span>three</span> four</span> <ins>five</ins> six</p><p>Seven</p></article>"
    assert pages.main_text(page, dict(pages.PRIOR)) == "One two three four five six\nSeven"
    assert pages.main_text("<p><b>one</b> <i>two</i>three</p> <p>four</p>", dict(pages.PRIOR)) == "one twothree\nfour"


def test_main_text_of_long_and_deep_pages():
    weights = dict(pages.PRIOR)
    cells = "".join(f"<tr><td>first {k}<td>second {k}" for k in range(600))
    terms = "".join(f"<dt>term {k}<dd>meaning {k}" for k in range(600))
    for rows in (f"<table>{cells}<tr><td><div>inner</div></table>", f"<dl>{terms}<dd><div>inner</div></dl>"):
        page = f"<div id=page><article>{rows}<p>The last words</p></article></div>"
        text = pages.main_text(page, weights).split("\n")
        assert len(text) == 1202 and text[-2:] == ["inner", "The last words"]
    deep = "<div>" * 700
    page = f"{deep}<nav><p>Other matter</p></nav><article><p>The text</p></article><aside><p>More of it</p></aside>"
    assert pages.main_text(page, weights) == "The text"
    for nested in ("<div>" * 50_000 + "</nav>" * 50_000, "<dd><div class=ad>" * 50_000, "<article><aside>" * 30_000):
        assert pages.main_text(f"{nested}<p>deep words</p>", weights) in ("deep words", "")
    # A table in a cell closes no cell around it.
    page = "<article><table><tr><td class=ad><table><tr><td>Buy<tr><td>now</table>all<td>Text of the cell</table></article>"
    assert pages.main_text(page, weights) == "Text of the cell"


def test_main_text_of_hard_pages(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "just words", None), (4, "u", "<p" * 2000, "")]
    rows += [(5, "u", "<div>" * 3000 + "<p>deep words</p>", "x"), (6, "u", "<p title='a>b' x=\">\">one</p" , "x")]
    rows += [rows[2]]
    frame = spark.createDataFrame(rows, PAGES)
    got = [(r.page_id, r.text) for r in pages.extract(frame, pages.fit_weights(frame)).collect()]
    assert got[:3] == [(1, ""), (2, ""), (None, "just words")] and len(got) == len(rows)
    assert dict(got)[5] == "deep words" and dict(got)[6].startswith("one")
    assert pages.extract(frame.limit(0), dict(pages.PRIOR)).collect() == []


def archived(spark, frame):
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.dedup_records(frame), path)
    return warc.resolve_revisits(warc.read_archives(spark, path))


def expected_records(rows):
    """Of rows with equal html the one with the largest id is the response; repeats revisit it."""
    best = {}
    for page_id, _, html, _ in rows:
        html = html or ""
        best[html] = max(best.get(html, -(2**63)), -(2**63) if page_id is None else page_id)
    out, done = [], set()
    for page_id, _, html, _ in rows:
        html = html or ""
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = best[html] == (-(2**63) if page_id is None else page_id) and html not in done
        if first:
            done.add(html)
        out.append((page_id, len(data), digest, "response" if first else "revisit", None if first or best[html] == -(2**63) else best[html]))
    return sorted(out, key=repr)


def test_warc_round_trip(spark):
    rows = [(i, f"http://h/{i}", ["<p>same</p>", "WARC/1.1\r\n\r\nx", "é\r\n\r\n", None, ""][i % 5], "d") for i in range(40)]
    rows += [rows[0], (None, None, "<p>same</p>", None), (None, "u\r\nX: y", "only", None), (50, "u", "x" * 300_000, "")]
    rows += [rows[39]]
    got = [tuple(r) for r in archived(spark, spark.createDataFrame(rows, PAGES)).collect()]
    assert sorted(got, key=repr) == expected_records(rows)
    assert archived(spark, spark.createDataFrame([], PAGES)).collect() == []


def test_statements(spark):
    connection = duckdb_views(SF_DIR)
    for name, sql in ORACLE.items():
        assert differences(REGISTRY[name](spark, SF_DIR), connection, sql) == []


def clustered(n=900, width=16):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, width))
    x = rng.standard_normal((n, width))
    near = rng.random(n) < 0.5
    x[near] = centres[rng.integers(0, 12, near.sum())] + 0.06 * rng.standard_normal((near.sum(), width))
    x[::50] = x[7]
    return x


SPECIAL = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0], []]


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, [float(v) for v in x], 0, i) for i, x in enumerate(clustered())]
    rows += [(2000 + i, v, 0, 0) for i, v in enumerate(SPECIAL)]
    rows += [rows[3], (None, rows[3][1], None, None)]
    schema = "vec_id long, embedding array<float>, label int, cid long"
    return spark.createDataFrame(rows, schema)


def test_vector_links_equal_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(vectordedup, "BLOCK", 64)
    monkeypatch.setattr(vectordedup, "PER_CELL", 100)
    rows = [r for r in vectors.collect() if r.embedding and len(r.embedding) == 16]
    rows = [r for r in rows if all(v is not None and np.isfinite(v) for v in r.embedding) and any(r.embedding)]
    x = np.array([r.embedding for r in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    ids = np.array([10**9 if r.vec_id is None else r.vec_id for r in rows])
    label = ids.copy()
    for _ in range(50):
        label = np.minimum(label, np.where(linked, label[None, :], 10**9).min(axis=1))
    expected = sorted(zip(ids.tolist(), linked.sum(axis=1).tolist(), label.tolist(), strict=True))
    got = [r for r in vectordedup.near_duplicates(vectors).collect()]
    main = [r for r in got if r.vec_id is None or r.vec_id < 2000]
    assert sorted((10**9 if r.vec_id is None else r.vec_id, r.n_links, r.component_id) for r in main) == expected
    rest = [r for r in got if r.vec_id is not None and r.vec_id >= 2000]
    assert len(rest) == len(SPECIAL)
    assert all((r.n_links, r.component_id, r.kept) == (0, r.vec_id, True) for r in rest)


def test_links_across_cells_are_found(spark, monkeypatch):
    """In the plane, where neighbours of far centroids link, as many pairs as by brute force."""
    monkeypatch.setattr(vectordedup, "PER_CELL", 100)
    turns = np.linspace(0, 2 * np.pi, 300, endpoint=False)
    x = np.column_stack([np.cos(turns), np.sin(turns)])
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    linked = x @ x.T >= 0.9
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectordedup.near_duplicates(frame).collect()}
    assert found == {i: (int(linked[i].sum()) - 1, 0) for i in range(300)}


def test_vectors_travel_in_blocks(spark, monkeypatch):
    """Vectors that don't cluster: rows grow with the pairs of blocks, not with vectors times blocks."""
    monkeypatch.setattr(vectordedup, "BLOCK", 100)
    monkeypatch.setattr(vectordedup, "PER_CELL", 150)
    made, tasks = [], vectordedup._tasks

    def counted(*args):
        made.append(tasks(*args))
        return made[-1]

    monkeypatch.setattr(vectordedup, "_tasks", counted)
    x = np.random.default_rng(9).standard_normal((900, 24))
    x[450:] = x[:450] + 0.05 * x[450:]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectordedup.near_duplicates(frame).collect()}
    assert found == {i: (1, i % 450) for i in range(900)}
    assert made[0].count() < 900


def test_links_at_the_threshold(spark, monkeypatch):
    """Cosines that single precision can't tell from the threshold, within and across cells."""
    monkeypatch.setattr(vectordedup, "PER_CELL", 50)
    rng = np.random.default_rng(11)
    x, away = rng.standard_normal((2, 200, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosines = 0.9 + np.where(np.arange(200) % 2, 1e-10, -1e-10)
    y = cosines[:, None] * x + np.sqrt(1 - cosines**2)[:, None] * away
    rows = [(i, (v * 10.0 ** (i % 7)).tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectordedup.near_duplicates(frame).collect()}
    assert found == {i: (i % 2, i % 200 if i % 2 else i) for i in range(400)}


def test_labels_of_chains_and_groups():
    chain = np.eye(4000, dtype=bool) | np.eye(4000, k=1, dtype=bool)
    assert all((labels == 0).all() for labels in vectordedup._spanning(chain))
    two = np.array([[0, 0, 1], [1, 1, 0], [0, 0, 1]], dtype=bool)
    assert [labels.tolist() for labels in vectordedup._spanning(two)] == [[0, 1, 0], [1, 1, 0]]


def test_neighbours_reach_recall(spark, vectors, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    monkeypatch.setattr(ann, "QUERIES", 20)
    x = np.array([r.embedding for r in vectors.where("vec_id < 900").dropDuplicates(["vec_id"]).orderBy("vec_id").collect()])
    got = {}
    for row in ann.nearest(vectors.where("vec_id < 900").dropDuplicates(["vec_id"])).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    assert set(got) == set(range(0, 900, 20))
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        scores = x @ x[q]
        for _, vec_id, score in rows:
            assert vec_id != q and abs(score - scores[vec_id]) < 1e-9
        scores[q] = -np.inf
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        floor = np.sort(scores)[-20]
        hits += sum(score >= floor - 1e-12 for _, _, score in rows)
    assert hits / (20 * len(got)) >= 0.9


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_neighbour_query_reaches_recall(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    found = {}
    for row in REGISTRY["op7_neighbours"](spark, sf_dir).collect():
        found.setdefault(row.query_id, []).append(row.score)
    asked = np.nonzero(ids % 20 == 0)[0]
    assert set(found) == set(ids[asked].tolist())
    hits = 0
    for q in asked:
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += sum(np.array(found[ids[q]]) >= np.sort(scores)[-20] - 1e-12)
    assert hits / (20 * len(asked)) >= 0.95


def test_equal_vectors_have_equal_products():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((501, 61))
    x[rng.permutation(501)[:200]] = x[3]
    rows, products = ann._inner_products(x, x[5], 250, np.linalg.norm(x, axis=1).max())
    same = (x[rows] == x[3]).all(axis=1)
    assert same.sum() in (0, (x == x[3]).all(axis=1).sum()) and len(set(products[same])) <= 1
    best = np.argsort(-(x @ x[5]), kind="stable")[:20]
    assert set(best) <= set(rows.tolist())


def test_copies_take_nothing_from_recall():
    """A block where a third of the rows are one vector; the queries are those nearest to it."""
    x = np.random.default_rng(3).standard_normal((6000, 64))
    x[::3] = x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = np.arange(6000)
    left = pd.DataFrame({"vec_id": rows * 7, "row": rows, "v": list(x)})
    asked = np.append(rows[rows % 3 > 0][np.argsort(-(x[rows % 3 > 0] @ x[0]))[:100]], [0, 3])
    found = ann._search(20)(left, left.iloc[asked])
    assert len(found) == 20 * len(asked)
    recalls = []
    for q in asked:
        scores = x @ x[q]
        scores[q] = -np.inf
        mine = found[found["query_row"] == q]
        assert set(mine["vec_id"]).isdisjoint([q * 7]) and mine["vec_id"].is_unique
        assert np.allclose(mine["score"], scores[mine["vec_id"] // 7])
        recalls.append((mine["score"] >= np.sort(scores)[-20] - 1e-9).mean())
        if scores.max() > 1 - 1e-9:  # of copies the smallest ids
            assert sorted(mine["vec_id"]) == [r * 7 for r in rows[::3] if r != q][:20]
    assert np.mean(recalls) >= 0.99 and min(recalls) >= 0.8, (np.mean(recalls), min(recalls))


def test_neighbours_of_hard_rows(spark, vectors):
    few = vectors.where("vec_id >= 2000 or vec_id is null or vec_id in (0, 3, 20)")
    rows = ann.nearest(few).collect()
    assert {r.query_id for r in rows} <= {0, 20} and len(rows) == 6
    assert ann.nearest(vectors.limit(0)).collect() == []
    assert vectordedup.near_duplicates(vectors.limit(0)).collect() == []
