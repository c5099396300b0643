"""Search, archives, pages, suffixes, the n-gram join and the pipeline: brute force, round trips, odd rows."""

import hashlib
import io
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adloom.llm import components, curves, html_blocks, ngram_join, queries, suffixes, warc
from adloom.llm.workspace import Workspace
from compare import difference, duck

# --- search


def brute_nearest(ids, vectors, queries_, k=5):
    unit = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
    out = {}
    for q in queries_:
        score = unit @ unit[ids.index(q)]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(score[i], 12), ids[i]))
        out[q] = [ids[i] for i in order[:k]]
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_nearest_reaches_its_recall(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    expected = brute_nearest(ids, vectors, [i for i in ids if i % 50 == 0])
    found = defaultdict(list)
    for r in sorted(queries.QUERIES["op1_hilbert_neighbours"](spark, folder).collect(), key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append(r.vec_id)
        v, w = vectors[ids.index(r.query_id)], vectors[ids.index(r.vec_id)]
        assert r.score == pytest.approx(v @ w / np.linalg.norm(v) / np.linalg.norm(w), abs=1e-12)
    assert found.keys() == expected.keys() and all(len(v) == 5 for v in found.values())
    assert np.mean([len(set(found[q]) & set(expected[q])) / 5 for q in expected]) >= 0.9


def test_nearest_with_equal_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [1.0, 0.0, 0.5], "x") for i in range(0, 40)] + [(i, rng.normal(size=3).tolist(), "x") for i in range(40, 60)]
    rows += [(60, None, "x"), (61, [0.0, 0.0, 0.0], "x"), (62, [1.0, None, 0.0], "x"), (63, [float("nan"), 1.0, 1.0], "x")]
    rows += [(64, [float("inf"), 1.0, 1.0], "x"), (65, [1.0, 2.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (3, [1.0, 0.0, 0.5], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    got = defaultdict(list)
    for r in sorted(curves.nearest(df, F.col("vec_id") % 10 == 0, share=2.0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r.vec_id)
    assert got[0] == [1, 2, 3, 4, 5] and got[10] == [0, 1, 2, 3, 4] and 60 not in got
    good = [r for r in rows[:60]]
    assert dict(got) == brute_nearest([r[0] for r in good], np.array([r[1] for r in good]), [i for i in range(0, 60, 10)])
    few = curves.nearest(df.where("vec_id in (0, 1)"), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 1)]
    assert curves.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_nearest_within_a_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 64))
    vectors /= np.sqrt((vectors**2).sum(1, keepdims=True))
    group = rng.permutation(3000)[:1000]  # a third of the rows, within far less than a cell
    vectors[group] = vectors[group[0]] + 1e-6 * rng.normal(size=(1000, 64))
    unit = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
    asked = {int(i) for i in group[:25]}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in curves.nearest(df, F.col("vec_id").isin(*asked)).collect():
        found[r.query_id].add(r.vec_id)
    near = []
    for q in asked:  # the distance of unit vectors orders as the cosine does, with more digits
        gap = ((unit[group] - unit[q]) ** 2).sum(1)
        near.append(len(found[q] & {int(group[i]) for i in np.argsort(gap)[1:6]}) / 5)
    assert np.mean(near) >= 0.9


def test_hilbert_neighbours_are_neighbours():
    for d, bits in ((2, 5), (3, 3), (4, 2)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * d)).reshape(d, -1).T
        keys = curves.hilbert_keys(cells, bits)
        order = np.argsort(keys)
        assert (keys[order] == np.arange(len(keys))).all()
        assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


# --- archives


def test_archives_agree_with_sql(spark, data):
    assert difference(queries.QUERIES["op3_warc_zstd"](spark, data), duck(data), queries.ORACLES["op3_warc_zstd"]) is None


def test_archives_of_odd_pages(spark):
    big, tie = "é<p>" * 50_000, "x" * 100
    rows = [(5, "u", tie), (3, None, tie), (9, "u", tie), (1, "u", "x" * 99), (2, "u", "x" * 99), (4, "a\r\nb", None), (None, "u", "q" * 200)]
    rows += [(6, "u", ""), (7, "u", big), (7, "u", big), (8, "u", big)]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, digest string, first int")
    got = sorted(((r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to, r.payload_bytes) for r in warc.warc_round_trip(df).collect()), key=str)
    assert Counter(got) == Counter(
        [(3, "response", None, 100), (5, "revisit", 3, 100), (9, "revisit", 3, 100), (1, "response", None, 99), (2, "response", None, 99)]
        + [(4, "response", None, 0), (6, "response", None, 0), (-1, "response", None, 200)]
        + [(7, "response", None, 250_000)] * 2
        + [(8, "revisit", 7, 250_000)]
    )
    assert warc.warc_round_trip(df.limit(0)).count() == 0


def test_archives_are_plain_zstd_with_a_leading_dictionary(spark, data):
    space = Workspace(spark, "test-warc")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    manifest = space.stage(warc.write_archives(pages, f"{space.folder}/a", archive_bytes=20_000), "manifest")
    paths = [re.sub("^file:/+", "/", r.path) for r in manifest.collect()]
    assert len(paths) > 1 and sum(r.records for r in manifest.collect()) == pages.count()
    raw = open(paths[0], "rb").read()
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little")
    records = [warc.parse_record(x) for x in warc.read_frames(io.BytesIO(raw), piece=100)]
    assert records and all(r["error"] is None for r in records)
    full = warc.read_archives(spark, manifest).where("record_type = 'response'").select("page_id", F.decode("payload", "utf-8").alias("html"))
    assert full.join(pages, ["page_id", "html"]).count() == full.count()
    with pytest.raises(ValueError):
        list(warc.read_frames(io.BytesIO(raw[:-3])))


def test_bad_records_are_named():
    good = warc.build_record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest())
    assert warc.parse_record(good)["payload"] == b"abc" and warc.parse_record(good)["error"] is None
    for bad in (b"", good[:-1], good + b"x", good.replace(b"abc", b"abd"), good.replace(b"WARC/1.1", b"HTTP/1.1"), good.replace(b"WARC-Date", b"X-Date")):
        assert warc.parse_record(bad)["error"]


# --- pages


def test_chain_on_held_out_layouts():
    chain = html_blocks.trained()
    right = []
    for html, labels in html_blocks.labelled_pages(150, seed=77):
        blocks = html_blocks.blocks_of(html)
        assert len(blocks) == len(labels)
        right += (chain.labels(html_blocks.features(blocks)) == np.array(labels)).tolist()
    assert np.mean(right) > 0.98


def test_features_are_those_of_the_whole_block():
    texts = ["w" * 399 + " " + "1" * 400, "W" * 300 + " w", "w" * 300 + " Copyright us", "w" * 300]
    rows = html_blocks.features(html_blocks.blocks_of("".join(f"<p>{t}</p>" for t in texts)))[:, -html_blocks.TEXT_FEATURES :]
    assert rows[:, 10].tolist() == [0, 0, 1, 0]  # copyright
    assert rows[:, 11].tolist() == [1, 0, 0, 0]  # digits
    assert rows[:, 13].tolist() == [0, 0, 0, 0]  # capitals


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    chain = html_blocks.Chain(rng.normal(size=(html_blocks.SIZE, 2)), rng.normal(size=(2, 2)) * 2, rng.normal(size=2))
    x = rng.normal(size=(8, html_blocks.SIZE))
    s = x @ chain.weights

    def value(path):
        return chain.begin[path[0]] + sum(s[i, l] for i, l in enumerate(path)) + sum(chain.change[a, b] for a, b in zip(path, path[1:]))

    best = max(np.ndindex(*[2] * 8), key=value)
    assert tuple(chain.labels(x)) == best


def article_text(html: str) -> str:
    """The article of a page of the tables, cut out by its tags."""
    import html as entities

    body = re.search(r"<article>(.*)</article>", html, re.S)[1]
    parts = [" ".join(entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(x for x in parts if x)


def test_every_page_keeps_its_article(spark):
    chain = html_blocks.trained()
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "html").collect()
    assert [r.page_id for r in pages if html_blocks.main_text(r.html, chain) != article_text(r.html)] == []


def test_articles_without_a_container():
    chain = html_blocks.trained()
    two = "<p>A first paragraph of some words here.</p><p>Another paragraph follows with more words in it.</p>"
    both = "A first paragraph of some words here.\n\nAnother paragraph follows with more words in it."
    around = f'<body><nav><a href="/">Home</a><a href="/a">About</a></nav>{two}<footer><p>&copy; us 2024</p></footer></body>'
    for page in (f"<body>{two}</body>", two, around, f'<div id="content">{two}</div>'):
        assert html_blocks.main_text(page, chain) == both, page
    assert html_blocks.main_text("Only text without any tag, some words long.", chain) == "Only text without any tag, some words long."
    short = '<nav><a href="/">Home</a></nav><div id="content"><p>Short one.</p><p>This is a longer paragraph that has more words.</p></div>'
    assert html_blocks.main_text(f"<html><body>{short}</body></html>", chain).startswith("Short one.\n\nThis")


def test_extract_keeps_columns_of_its_names(spark):
    df = spark.createDataFrame([(1, "<article><p>Some words of a text here.</p></article>", "KEEP", 7)], "page_id long, html string, text string, n_chars long")
    row = html_blocks.extract(df, html_blocks.trained()).first()
    assert (row.text, row.n_chars, row._text, row._n_chars) == ("KEEP", 7, "Some words of a text here.", 26)


def test_pages_of_the_table(spark, data):
    rows = queries.QUERIES["op4_html_crf"](spark, data).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article_text(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_markup_of_all_kinds():
    html = """<!DOCTYPE html><html><head><title>T</title></head><body><nav><a href="/x">Home</a></nav><article><h1>A &amp; B</h1>
    <p>One <b>bold</b>
    word &eacute; &#233; 1 < 2<br>next<p title="a > b">Two</p><script>if (a < b) "</p>"</script><style>p{}</style><!-- <p>no</p> -->
    <ul><li>x<li>y</ul></article><footer>&copy; us</footer><p unclosed"""
    texts = [b.text for b in html_blocks.blocks_of(html)]
    assert texts == ["Home", "A & B", "One bold word é é 1 < 2 next", "Two", "x", "y", "© us"]


def test_pages_that_leave_out_the_end_of_the_head(spark):
    head = '<!DOCTYPE html><html><head>\n<meta charset="utf-8"><title>No text</title><style>p{}</style><noscript><link href="x"></noscript><script>var a = "<p>";</script>\n'
    main = "<nav><a href='/x'>Home</a></nav><article><h1>A title of the page</h1><p>Some words of the main text, which go on for a while.</p></article><footer>&copy; us</footer>"
    whole = f"{head}</head><body>{main}</body></html>"
    pages = [whole, f"{head}<body>{main}</body></html>", f"{head}{main}", f"{head}{main}</body></html>", f"{head}<noscript><p>none<body>{main}"]
    blocks = [[b.text for b in html_blocks.blocks_of(p)] for p in pages]
    assert blocks == [["Home", "A title of the page", "Some words of the main text, which go on for a while.", "© us"]] * 5
    df = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    out = {r.page_id: r for r in html_blocks.extract(df, html_blocks.trained()).collect()}
    assert {r.text for r in out.values()} == {"A title of the page\n\nSome words of the main text, which go on for a while."}
    one = {"<head><title>T</title>Text <b>here</b>": ["Text here"], "<head><title>T</title></body>Text": ["Text"], "<head><template><p>no</p><body>no</template><title>T</title></head>Text": ["Text"]}
    one |= {"<head><meta><frameset><p>Text": ["Text"], "<html><head><link><br>Text": ["Text"], "<body><p>a</p><head><p>b": ["a", "b"]}
    assert {p: [b.text for b in html_blocks.blocks_of(p)] for p in one} == one


def test_odd_pages(spark):
    chain = html_blocks.trained()
    rows = [(1, None), (2, ""), (3, "<p>"), (4, "<article><p>" + "Some words here. " * 50_000), (None, "<article><p>A text of an article.</p></article>")]
    df = spark.createDataFrame([(i, "u", h, "z") for i, h in rows], "page_id long, url string, html string, blocks string")
    out = {r.page_id: r for r in html_blocks.extract(df, chain).collect()}
    assert out[1].text == out[2].text == out[3].text == "" and out[1].n_chars == 0
    assert out[4].n_chars == 16 * 50_000 + 49_999 and out[None].text == "A text of an article."
    assert html_blocks.extract(df.limit(0), chain).count() == 0


# --- suffixes


def brute_repeats(texts, length=400):
    count = Counter()
    raws = [(i, (t or "").encode()) for i, t in texts]
    for _, raw in raws:
        count.update(raw[s : s + length] for s in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - length + 1):
            if count[raw[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int(((~gone[:-1]) & gone[1:]).sum()) + int(gone[0]) if len(raw) else 0
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def got_repeats(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df).collect())


def test_repeats_of_the_table(spark, docs, texts):
    assert got_repeats(docs) == brute_repeats(texts.items())


def test_planted_and_odd_repeats(spark):
    rng = np.random.default_rng(5)

    def prose(n):
        return "".join(rng.choice(list("abcdefghij éü"), n))

    shared, other = prose(700), prose(399)
    edge = prose(400)
    rows = [(i, prose(rng.integers(0, 900)) + shared[i % 5 : 600 + 10 * (i % 8)] + prose(rng.integers(0, 900))) for i in range(40)]
    rows += [(100 + i, prose(300) + other + prose(300)) for i in range(4)] + [(110 + i, prose(30) + edge + prose(30)) for i in range(2)]
    rows += [(120, "ab" * 700), (121, "x" * 399), (122, "y" * 400), (123, "z" * 401), (124, None), (125, ""), (None, shared), (126, prose(5000))]
    rows += [(127, shared), (127, shared), (127, other)]
    df = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, k string")
    assert got_repeats(df) == brute_repeats(rows)
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_repeats_are_handed_out_as_spans_and_text(spark):
    rng = np.random.default_rng(11)

    def prose(n):
        return "".join(rng.choice(list("abcdefghij "), n))

    shared, short = prose(500), " ".join(["plain"] * 4 + [prose(5) for _ in range(51)])[:399]
    rows = [(1, "one " + shared + " two"), (2, shared + prose(40)), (3, "é" + "ö" * 300 + "z"), (4, "x" + "ö" * 300), (7, None)]
    rows += [(5, prose(100) + "," + short + "," + prose(100)), (6, prose(100) + ";" + short + ";" + prose(100))]
    got = {r.doc_id: r for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(x) for x in got[1].spans] == [(4, 504)] and got[1].kept_text == "one  two"
    assert [tuple(x) for x in got[2].spans] == [(0, 500)] and got[2].kept_text == rows[1][1][500:]
    assert got[3].kept_text == "éz" and got[4].kept_text == "x"
    for i, text in rows[4:]:  # a passage of over 50 words, but of fewer than 400 bytes, stays
        assert got[i].spans == [] and got[i].kept_text == (text or "") and not got[i].has_repeats
    for i, text in rows:
        raw, kept, at = (text or "").encode(), b"", 0
        for low, high in got[i].spans:
            kept, at = kept + raw[at:low], high
        kept += raw[at:]
        assert hashlib.sha256(kept).hexdigest() == got[i].kept_sha256 and got[i].n_bytes - got[i].n_removed == len(kept)


def test_a_cut_character_is_marked_in_the_text_alone(spark):
    same = "ö" * 10 + "a" * 395  # 415 bytes, and the first byte of "ö" and "ü"
    rows = [(1, "b" + same + "ö"), (2, "c" + same + "ü")]
    for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        raw = rows[r.doc_id - 1][1].encode()
        assert [tuple(x) for x in r.spans] == [(1, len(raw) - 1)] and r.n_removed == 416
        assert r.kept_text == "bc"[r.doc_id - 1] + "\ufffd"
        assert r.kept_sha256 == hashlib.sha256(raw[:1] + raw[-1:]).hexdigest()


def test_long_texts_are_cut_without_effect_on_anchors(monkeypatch):
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 100, 6000).astype(np.uint8)
    starts = np.array([0, 1500, 1500, 1800, 6000])
    whole = suffixes.anchors(raw, starts)
    monkeypatch.setattr(suffixes, "PIECE", 500)
    assert all((a == b).all() for a, b in zip(whole, suffixes.anchors(raw, starts), strict=True))


def test_loser_tree_merges_and_knows_the_shared_prefixes():
    rng = np.random.default_rng(4)
    strings = sorted({bytes(rng.integers(97, 99, rng.integers(1, 30)).astype(np.uint8)) for _ in range(500)})
    runs = [[] for _ in range(7)]
    for s in strings:
        for r in rng.choice(7, rng.integers(1, 3), replace=False):
            runs[r].append((s, False))
    blobs = [suffixes.front_code(r) for r in runs]
    merged = list(suffixes.LoserTree([suffixes.read_run(b) for b in blobs]))
    flat = sorted(s for r in runs for s, _ in r)
    assert [s for _, s, _ in merged] == flat
    assert [n for n, _, _ in merged[1:]] == [suffixes.shared_prefix(a, b) for a, b in zip(flat, flat[1:])]
    best = dict(suffixes.longest_shared(iter(suffixes.LoserTree([suffixes.read_run(b) for b in blobs])), None, None))
    count = Counter(flat)
    for i, s in enumerate(strings):
        near = [suffixes.shared_prefix(s, strings[j]) for j in (i - 1, i + 1) if 0 <= j < len(strings)]
        assert best[s] == (len(s) if count[s] > 1 else max(near))


# --- n-gram join


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))) if w else frozenset())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return Counter((rows[i][0], len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i in range(len(rows)))


def got_components(df, **kw):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df, **kw).collect())


def planted(seed, groups=6, copies=25, n=40):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choice(vocabulary, 25).tolist()
    rows = []
    for g in range(groups):
        base = rng.choice(vocabulary, n * (1 + g)).tolist()
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.integers(0, 1 + len(base) // 20)):
                text[rng.integers(len(text))] = rng.choice(vocabulary)
            rows.append(text)
    rows += [[*rng.choice(vocabulary, rng.integers(3, 60)).tolist(), *passage] for _ in range(60)]
    rows += [rng.choice(vocabulary[:4], rng.integers(1, 7)).tolist() for _ in range(40)]
    order = rng.permutation(len(rows))
    return [(int(i), " ".join(rows[j])) for i, j in enumerate(order)]


@pytest.mark.parametrize("size, percent, block", [(4, 85, 2000), (5, 80, 2000), (5, 80, 12)])
def test_join_finds_every_link(spark, size, percent, block):
    rows = planted(size + block)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_components(df, size=size, percent=percent, block=block) == brute_components(rows, size, percent)


def test_join_of_the_table(spark, docs, texts):
    assert got_components(docs, size=4, percent=85) == brute_components(list(texts.items()), 4, 85)


def test_join_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "ONE"), (None, "one"), (6, "a b c"), (7, "a b d"), (8, "w " * 50_000), (9, "x y z"), (9, "x y z"), (None, None)]
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, node string, _key int")
    assert got_components(df, size=4, percent=85) == brute_components(rows, 4, 85)
    kept = ngram_join.keep_first(df, size=4, percent=85)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("1 2 3 4 6 7 8 9 None".split())
    assert ngram_join.near_duplicates(df.limit(0)).count() == 0 and ngram_join.keep_first(df.limit(0)).count() == 0


def test_tree_reaches_every_point_that_can_link():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, rng.integers(1, 80)).astype(np.uint64)) for _ in range(400)]
    sets += [np.unique(np.concatenate([s[2:], rng.integers(0, 1 << 63, 2).astype(np.uint64)])) for s in sets[:200]]
    sizes = np.array([len(s) for s in sets])
    points = ngram_join.points_of([ngram_join.packed_point(s) for s in sets], sizes)
    tree = ngram_join.RTree(points, sizes)
    for i in range(0, 600, 7):
        found = set(tree.order[tree.search(points[i], int(sizes[i]), 85)].tolist())
        wanted = {
            j for j in range(600) if np.minimum(points[i], points[j]).sum() >= ngram_join.needed(sizes[i], sizes[j], 85) and 100 * min(sizes[i], sizes[j]) >= 85 * max(sizes[i], sizes[j])
        }
        assert found == wanted


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(500, 500)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.components(df, Workspace(spark, "test"), "c").collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 180)}


# --- the pipeline


def test_pipeline_stages(spark, data, docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line spread", "n-gram join", "decontamination", "sentencepiece"]
    space, now, sizes = Workspace(spark, "test-pipeline"), docs, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, now = now, space.stage(stage(spark, now, data), f"s{i}")
        sizes.append(now.count())
        if name != "sentencepiece":
            assert now.dtypes == docs.dtypes
        if name == "line spread":
            assert sizes[-1] == sizes[-2]
        if name == "n-gram join":
            rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
            firsts = {c for _, _, c in brute_components(rows, 5, 80)}
            assert {r.doc_id for r in now.select("doc_id").collect()} == firsts
    assert sizes[0] <= docs.count() and sizes[-1] == sizes[-2] and sizes[2] < sizes[1]
    assert queries.QUERIES["pipeline"](spark, data).count() == sizes[-1]
