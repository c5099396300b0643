"""Line spread, toxicity, quality, decontamination and tokens: odd rows, brute force, round trips, held-out accuracy."""

import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adloom.llm import decontaminate, ftrl, line_spread, mil, pieces, queries, sampling, words
from compare import difference, duck

ODD = "doc_id long, text string, source string, key string, _key string, score double"


def odd_rows(spark):
    long = "word " * 60_000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "A short one."), (5, "A short one."), (None, "No id at all."), (None, None)]
    return spark.createDataFrame([(i, t, None if i == 2 else f"s{i}", "k", "u", 0.5) for i, t in rows], ODD)


def test_words_are_those_of_the_pattern():
    texts = ["Foo bar\nfoo", None, "", "x\x0by\x0cz\x1cq", "É é  E", "a" * 3000, " lead"]
    hashes, at = words.word_hashes(pa.array(texts))
    flat = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in flat]
    by_word = dict(zip([w for ws in flat for w in ws], hashes.tolist(), strict=True))
    assert len(set(by_word.values())) == len(by_word)
    assert [by_word[w] for ws in flat for w in ws] == hashes.tolist()


def test_long_texts_are_cut_without_effect(monkeypatch):
    text = pa.array(["abc de " * 500, "x " * 300])
    whole = words.word_hashes(text)
    monkeypatch.setattr(words, "PIECE", 64)
    cut = words.word_hashes(text)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


# --- line spread


def test_line_spread_agrees_with_sql(spark, data):
    for name in ("op5_line_spread",):
        assert difference(queries.QUERIES[name](spark, data), duck(data), queries.ORACLES[name]) is None


def test_line_spread_counts_sites_near_the_threshold(spark):
    body = "A line of its own, number {}, that is long enough to be most of the text here and stays."
    rows = []
    for line, sites in (("just enough", 10), ("one too few", 9), ("many", 40)):
        rows += [(line, s) for s in range(sites)] + [(line, 0)] * 30
    docs = spark.createDataFrame([(i, f"{body.format(i)}\n {line} ", f"s{s}") for i, (line, s) in enumerate(rows)], "doc_id long, text string, source string")
    out = line_spread.drop_boilerplate(docs).collect()
    kept = {line for (line, _), r in zip(rows, sorted(out, key=lambda r: r.doc_id), strict=True) if r.n_removed == 0}
    assert kept == {"one too few"}


def test_line_spread_leaves_copies_and_odd_rows(spark):
    copies = spark.createDataFrame([(i, "a copy\nof one text", f"s{i}") for i in range(30)], "doc_id long, text string, source string")
    assert {r.text for r in line_spread.drop_boilerplate(copies).collect()} == {"a copy\nof one text"}
    odd = odd_rows(spark)
    out = line_spread.drop_boilerplate(odd)
    assert out.columns == [*odd.columns, "n_lines", "n_removed"]
    assert sorted(map(str, out.select(*odd.columns).collect())) == sorted(map(str, odd.collect()))
    assert line_spread.drop_boilerplate(odd.limit(0)).count() == 0


def test_pipeline_cuts_boilerplate_that_is_most_of_a_page(spark):
    import corpus_pipeline

    notice = "A long notice that every one of the sites shows below its pages, far longer than the pages are."
    rows = [(i, f"Own {i}.\n{notice}", "en", f"s{i % 12}", 0) for i in range(24)]
    rows += [(100 + i, "a copy\nof one text", "en", f"s{i}", 0) for i in range(30)]
    rows += [(200, f"{notice}\nOnce more.", "en", None, 0), (0, "a copy\nof one text", "en", "s1", 0), (201, None, "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = [(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.boilerplate(spark, docs, "").collect()]
    expected = [(i, f"Own {i}.", len(f"Own {i}.")) for i in range(24)] + [(i, "a copy\nof one text", 18) for i in [0, *range(100, 130)]]
    expected += [(200, "Once more.", 10), (201, None, None)]
    assert sorted(out, key=str) == sorted(expected, key=str)


# --- models


def held_out(spark, data, name):
    rows = queries.QUERIES[name](spark, data).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    return {r.doc_id: r for r in rows}


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.1"


def test_quality_on_held_out_documents(spark, larger):
    rows = held_out(spark, larger, "op2_quality_attention")
    known = [(r.quality, rows[r.doc_id]) for r in spark.read.parquet(f"{larger}/labels.parquet").collect()]
    right = [q == r.predicted for q, r in known if r.held_out]
    assert np.mean(right) > 0.97


def test_toxicity_on_held_out_documents(spark, larger):
    rows = held_out(spark, larger, "op6_toxicity_ftrl")
    known = [(r.toxic, rows[r.doc_id]) for r in spark.read.parquet(f"{larger}/labels.parquet").collect()]
    scored = [(t, r.predicted) for t, r in known if r.held_out]
    assert np.mean([p for t, p in scored if t]) > 0.75
    assert np.mean([p for t, p in scored if not t]) < 0.01


def test_models_on_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (4, 0), (2, None), (None, 1)], "doc_id long, y int")
    for module in (ftrl, mil):
        odd = odd_rows(spark).withColumn("score", F.lit("own"))
        model = module.train(odd, labels, "y", F.lit(True))
        out = module.score(odd, model).collect()
        assert len(out) == odd.count() and all(0 <= r._score <= 1 and r.score == "own" for r in out)
        assert len({r._score for r in out if not (r.text or "").strip()}) == 1
        assert module.score(odd.limit(0), model).count() == 0
        nothing = module.train(odd.limit(0), labels, "y", F.lit(True))
        assert all(0 <= r._score <= 1 for r in module.score(odd, nothing).collect())


def test_ftrl_agrees_with_a_plain_loop():
    rng = np.random.default_rng(3)
    known = np.arange(0, 400, 10)
    samples = [np.unique(rng.integers(0, len(known), 12)).astype(np.int32) for _ in range(60)]
    labels = np.array([float(7 in s or rng.random() < 0.1) for s in samples])
    s = ftrl.Settings(l1=0.4, rows=60)
    z, n = Counter(), Counter()

    def weight(i):
        pull = 0.0 if i == len(known) else s.l1
        if abs(z[i]) <= pull:
            return 0.0
        return -(z[i] - (pull if z[i] > 0 else -pull)) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)

    for step in range(s.passes):
        for k in np.random.default_rng(step).permutation(len(samples)):
            at = [*samples[k], len(known)]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - labels[k]
            for i in at:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    model = ftrl.fit(samples, labels, known, s)
    expected = {known[i]: weight(i) for i in range(len(known)) if weight(i)}
    assert dict(zip(model.where.tolist(), model.weights.tolist())) == pytest.approx(expected, rel=1e-5) and 0 < len(expected) < len(known)
    assert model.intercept == pytest.approx(weight(len(known)))


def test_sample_of_repeated_ids_is_fixed(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, y int")
    rows = [(1, "b"), (1, "a"), (1, "c"), (2, None), (2, "x"), (3, "y")]
    found = set()
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        found.add(tuple(sorted(map(tuple, sampling.labelled(docs, labels, "y", F.lit(True), 10).collect()))))
    assert len(found) == 1 and [r[0] for r in found.pop()] == [1, 2]


def test_attention_gradients_are_right():
    rng = np.random.default_rng(0)
    x, begin, y = rng.normal(size=(7, mil.FEATURES)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])
    model = mil.fit(x, np.array([3, 1, 3]), y, mil.Settings(steps=2))
    p = model.parts

    def loss(p):
        z = mil._forward(p, x, begin)["logit"]
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))

    for name, d in mil._gradients(p, x, begin, y).items():
        step = {**p, name: p[name] + 1e-6 * np.ones_like(p[name])}
        assert (loss(step) - loss(p)) / 1e-6 == pytest.approx(np.sum(d), rel=1e-3, abs=1e-6)


# --- decontamination


ITEM = "The quick train from Paris covers 300 km in 2 hours, while Alice walks 5 km to the old station near the river."


def leaked(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, bench).collect()}


def test_templates_catch_new_numbers_and_names(spark):
    changed = ITEM.replace("300", "450").replace("2 hours", "7 hours").replace("Alice", "Robert").replace("Paris", "Lyon")
    found = leaked(spark, [f"Before it. {ITEM} After it.", f"Some words. {changed}", ITEM.upper(), "Nothing of it here at all, only other words."])
    assert {k[0] for k in found} >= {0, 1}
    assert 3 not in {k[0] for k in found}
    assert found[(0, 0)].n_changed == 0 and found[(1, 0)].n_changed >= 3


def test_a_copy_in_any_case_is_found(spark):
    accents = "Élodie part de Genève à 8 h et rejoint Zoé à Orléans après 3 heures de route, où elle dîne avec Noël près du marché."
    changed = ITEM.replace("300", "450").replace("5 km", "9 km")
    texts = [ITEM.upper(), ITEM.lower(), f"BEFORE IT. {changed.upper()} AFTER IT.", accents.upper(), accents.lower(), ITEM.replace("Paris", "Lyon").replace("Alice", "Karl").lower()]
    found = leaked(spark, [*texts, "PARIS 12 LYON"], [ITEM, accents, "Say: Paris 12 Lyon", ": 12 Paris"])
    assert found.keys() == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)}
    assert all(r.n_found == r.n_windows for r in found.values())
    assert found[(0, 0)].n_changed == 0 and found[(2, 0)].n_changed == 2


def test_names_that_open_sentences_are_slots_too(spark):
    item = "Tom has 5 apples. Anna has 7 apples. Tom gives Anna 2 apples. How many apples does Anna have?"

    def swapped(tom, anna, *numbers):
        return f"{tom} has {numbers[0]} apples. {anna} has {numbers[1]} apples. {tom} gives {anna} {numbers[2]} apples. How many apples does {anna} have?"

    assert swapped("Tom", "Anna", 5, 7, 2) == item
    texts = [item, swapped("Ben", "Eva", 3, 9, 4), f"Words before it. {swapped('Ben', 'Eva', 7, 9, 4)} And after.", swapped("Mary Ann Lee", "Eva", 3, 9, 4)]
    texts += ["Ben sells 3 pears. Eva likes 9 plums. Ben meets Eva 4 times. How many plums does Eva like?", "Tom is here. How many apples does Anna have?"]
    texts += ["Ben has 3 apples. Eva has 9 apples. Karl gives Hugo 4 apples. How many apples does Gina have?"]
    found = leaked(spark, texts, [item])
    assert {k[0] for k in found} == {0, 1, 2, 3}
    assert {(r.n_windows, r.n_found) for k, r in found.items() if k[0] in (0, 1)} == {(15, 15)}
    assert found[(0, 0)].n_changed == 0 and found[(1, 0)].n_changed == 5
    full = leaked(spark, ["Well. Tom has 5 apples", "Anna Smith has 5 apples", "Anna Smith eats 5 apples"], ["Anna Smith has 7 apples"])
    assert {k[0] for k in full} == {0, 1}


def test_inconsistent_slots_do_not_count(spark):
    item = "Alice gives Bob apples and Alice takes plums from Bob then Alice meets Bob and Alice leaves Bob."
    ok = item.replace("Alice", "Carol").replace("Bob", "David")
    names = iter("Carol David Erik Frank Gina Hugo Ivan Jane Karl".split())
    mixed = re.sub("Alice|Bob", lambda m: next(names), item)
    found = leaked(spark, [f"So: {ok}", f"So: {mixed}"], [f"So: {item}"])
    assert {k[0] for k in found} == {0}


def test_decontamination_of_odd_rows(spark):
    odd = odd_rows(spark)
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "A short one."), (None, "No id at all."), (4, "12 34")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd, bench).collect()} == {(5, 3)}
    kept = decontaminate.drop_leaks(odd, bench)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "None", "None"]
    assert decontaminate.leaks(odd.limit(0), bench).count() == 0
    assert decontaminate.leaks(odd, bench.limit(0)).count() == 0


def brute_templates(text):
    """Tokens and slot values, word by word."""
    out, before = [], None
    for m in re.finditer(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text):
        w, gap = m[0], text[:1] and text[(before.end() if before else 0) : m.start()]
        opening = before is None or bool(re.search(r"[.!?:\n]", gap))
        upper = len(re.findall("[A-Z]", w))
        proper = len(w.encode()) > 1 and ((w[0] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" and upper == 1) or ("À" <= w[0] <= "Þ" and upper == 0))
        low = re.sub("[A-Z]", lambda x: x[0].lower(), w)
        kind = "N" if re.search("[0-9]", w) else "P" if proper and not opening else "L"
        if kind == "L" and before is not None and re.search("[0-9]", before[0]) and low in decontaminate.UNITS:
            kind = "U"
        if out and kind in "NP" and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1] + " " + low)
        else:
            out.append((kind, low))
        before = m
    return [(k if k != "L" else f"={v}", "" if k == "L" else v) for k, v in out]


def brute_windows(text):
    t = brute_templates(text)
    n = min(5, len(t))
    found = [t[i : i + n] for i in range(len(t) - n + 1)] if t else []
    return [(tuple(k for k, _ in w), tuple(v for _, v in w)) for w in found if any(not v for _, v in w)]


def test_decontamination_agrees_with_brute_force(spark, data, texts):
    from collections import Counter, defaultdict

    bench = {r.item_id: r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    items = {i: brute_windows(t) for i, t in bench.items()}
    assert all(len(brute_templates(t)) >= 5 for t in bench.values())
    by_key = defaultdict(set)
    for i, ws in items.items():
        for k, v in ws:
            by_key[k].add((i, v))
    expected = set()
    for d, t in texts.items():
        met = defaultdict(set)
        for k, v in set(brute_windows(t)):
            for i, iv in by_key[k]:
                met[i].add((k, iv, v))
        for i, rows in met.items():
            meets = defaultdict(Counter)
            for _, iv, v in rows:
                for a, b in zip(iv, v, strict=True):
                    if a:
                        meets[a][b] += 1
            total = len({k for k, _ in items[i]})
            # Ties between values are settled by hashes there, so a slot counts as consistent here if any best value fits.
            best = {a: {b for b in c if c[b] == max(c.values())} for a, c in meets.items()}
            best = {a: {a} if a in meets[a] else bs for a, bs in best.items()}
            good = {k for k, iv, v in rows if all(not a or b in best[a] for a, b in zip(iv, v, strict=True))}
            if len(good) >= 0.8 * total:
                expected.add((d, i))
    found = {(r.doc_id, r.item_id) for r in queries.QUERIES["op7_decontaminate_templates"](spark, data).collect()}
    assert found == expected and found


# --- tokens


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)


def test_ids_are_those_of_the_library(texts):
    sp = library()
    codec = pieces.Codec(pieces.Vocabulary(open(pieces.DEFAULT_MODEL, "rb").read()))
    odd = ["", " ", "   ", " a  b ", "a\n\n  b\t", "<s>x</s><0x0A>", "日本語😀 x́", "zz" * 300, "▁ x", "a" * 999, "1234567890 " * 9]
    for t in [*odd, *texts.values()]:
        ids = np.frombuffer(codec.encode(t), np.int32).tolist()
        assert ids == sp.encode(t), t[:80]
        assert codec.decode(ids) == sp.decode(ids)


def test_streaming_commits_within_a_bounded_window(monkeypatch):
    codec = pieces.Codec(pieces.Vocabulary(open(pieces.DEFAULT_MODEL, "rb").read()))
    widest = []
    commit = codec.commit
    monkeypatch.setattr(codec, "commit", lambda out, base, before, *a: widest.append(len(before)) or commit(out, base, before, *a))
    text = "thisisalongstretchwithoutanyspace" * 200
    assert codec.stream("▁" + text) == library().encode(text)
    assert len(widest) > 20 and max(widest) <= codec.v.longest + 8


def test_documents_go_through_the_streaming_pass(monkeypatch):
    codec = pieces.Codec(pieces.Vocabulary(open(pieces.DEFAULT_MODEL, "rb").read()))
    commit, done, widest = codec.commit, [], []

    def counted(out, base, before, total, live):
        after = commit(out, base, before, total, live)
        done.append(after[0] > base)
        widest.append(len(before) - 1)
        return after

    monkeypatch.setattr(codec, "commit", counted)
    sp = library()
    import duckdb

    for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall():
        assert np.frombuffer(codec.encode(t), np.int32).tolist() == sp.encode(t)
    assert sum(done) > 5000 and max(widest) <= codec.v.longest + 8


def test_unigram_paths_are_the_best(monkeypatch):
    """Against all segmentations, with scores of pieces given here."""
    codec = pieces.Codec(pieces.Vocabulary(open(pieces.DEFAULT_MODEL, "rb").read()))
    rng = np.random.default_rng(1)
    names = ["a", "b", "ab", "ba", "aba", "bb", "abab"]
    codec.v.unigram, codec.v.longest = True, 4
    codec.v.scores = dict(zip(names, rng.uniform(-5, -1, len(names)), strict=True))
    codec.v.ids = {n: i for i, n in enumerate(names)}
    codec.starts = pieces._tree(names)

    def best(t):
        if not t:
            return 0.0, ()
        return max((codec.v.scores[t[:k]] + best(t[k:])[0], (names.index(t[:k]), *best(t[k:])[1])) for k in range(1, 5) if t[:k] in names and len(t) >= k)

    for n in range(1, 12):
        text = "".join(rng.choice(list("ab"), n))
        assert codec.stream(text) == list(best(text)[1])
    long = "".join(rng.choice(list("ab"), 300))
    cut = codec.stream(long)
    whole, total = [None], [0.0]
    for end in range(1, len(long) + 1):
        ways = [(total[end - len(n)] + codec.v.scores[n], n) for n in names if len(n) <= end and long[end - len(n) : end] == n]
        score, name = max(ways)
        whole.append(name)
        total.append(score)
    assert sum(codec.v.scores[names[i]] for i in cut) == pytest.approx(total[-1])
    assert "".join(names[i] for i in cut) == long


def test_encode_and_decode_tables(spark):
    odd = odd_rows(spark)
    model = pieces.read_model(spark, pieces.DEFAULT_MODEL)
    coded = pieces.encode(odd, model)
    back = pieces.decode(coded, model, text="again").collect()
    assert pieces.decode(coded, model).collect()[0]._text == back[0].again
    clash = pieces.encode(odd.withColumn("ids", F.lit("own")), model).collect()
    assert {r.ids for r in clash} == {"own"} and [r._ids for r in clash] == [r.ids for r in coded.collect()]
    assert all(r.again == r.text for r in back) and len(back) == odd.count()
    assert next(r.ids for r in back if r.doc_id == 2) == [] and next(r.ids for r in back if r.doc_id == 1) is None
    assert pieces.encode(odd.limit(0), model).count() == 0


def test_every_document_round_trips(spark, data):
    assert all(r.round_trip for r in queries.QUERIES["op8_sentencepiece_viterbi"](spark, data).collect())


def test_a_worker_holds_little_besides_its_batch():
    # What stays in a worker's memory from one stage to the next, and what a slice of text unfolds to.
    assert sum(x.nbytes for x in words.powers(words.PIECE + 1)) <= 16 << 20
    assert 2 * pieces.REMEMBERED * 200 <= 160 << 20
    texts = pa.array(["the quick brown fox jumps " * 200] * 1000)
    model = ftrl.Model(22, 0.0, np.arange(10, dtype=np.int32), np.ones(10, np.float32))
    parts = [p.column(0) for p in words.slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", ftrl.SCORED)]
    model.scores(parts[0])
    tracemalloc.start()
    scores = np.concatenate([model.scores(p) for p in parts])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    assert np.array_equal(scores, model.scores(texts))
