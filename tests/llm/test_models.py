"""Search, mixing, language, toxicity, pages, licences and the pipeline."""

import math
import random
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loadbay.llm import bigru, language, licences, maintext, mixing, registry, topk, toxicity
from tests_llm_util import SF


# search -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("block,sample,head", [(8192, 4096, 16), (4, 25, 3)])
def test_search_matches_all_products(spark, block, sample, head):
    rng = np.random.default_rng(2)
    vecs = {i: rng.normal(0, 0.2, 12).astype(np.float32).tolist() for i in range(300)}
    vecs.update({300 + i: vecs[7] for i in range(30)})                   # ties
    vecs[41] = vecs[41][:5]                                              # short: padded
    rows = list(vecs.items()) + [(900, None), (920, [float("nan")] * 12), (940, [float("inf")] * 12),
                                 (960, [None] * 12), (None, vecs[1]), (980, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    got = [tuple(r) for r in topk.top_k(df, block=block, sample=sample, head=head).collect()]
    ints = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v in vecs.items()}
    want = []
    for q in (i for i in ints if i % 20 == 0):
        s = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:20]
        want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    assert sorted(got) == sorted(want)


def test_search_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(few).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(few.where("false")).count() == 0


def test_search_prunes():
    rng = np.random.default_rng(1)
    q = rng.integers(-9, 9, (5, 8)).astype(float)
    floor = np.full(5, 1e9)
    block = {"ids": np.arange(5), "q": q, "qr": q, "turn": np.eye(8), "floor": floor, "k": 3, "head": 4}
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([9]), pa.array([[1] * 8])], ["vec_id", "v"])
    assert sum(b.num_rows for b in topk.scan(block, iter([batch]))) == 0


def test_search_reads_on_after_short_vectors():
    # one task may be dealt several files: short vectors first, then long ones again
    import pyarrow as pa
    rng = np.random.default_rng(2)
    q = rng.integers(-9, 9, (5, 8)).astype(float)
    block = {"ids": np.arange(5), "q": q, "qr": q, "turn": np.eye(8), "floor": np.full(5, 50.0), "k": 3, "head": 4}
    batches = [pa.RecordBatch.from_arrays([pa.array(range(at, at + 200)), pa.array((v * np.ones((200, 8), int)).tolist())],
                                          ["vec_id", "v"]) for at, v in ((1000, 0), (2000, 1))]
    batches.append(pa.RecordBatch.from_arrays([pa.array(range(10, 15)), pa.array((9 * q.astype(int)).tolist())],
                                              ["vec_id", "v"]))
    got = {(i, v) for b in topk.scan(block, iter(batches))
           for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert {(i, 10 + i) for i in range(5)} <= got


# mixing -----------------------------------------------------------------------------------------

def test_raking_meets_the_targets(spark):
    rng = random.Random(1)
    cells = [(f"s{s}", lang, t, float(rng.randint(1, 1000))) for s in range(6) for lang in ("en", "de", "fr")
             for t in ("prose", "legal")]
    df = spark.createDataFrame(cells, "_source string, _lang string, _topic string, w double")
    got = mixing.rake(df).toPandas()
    total = got.w.sum()
    for col, power in (("_source", .7), ("_lang", .7), ("_topic", .9)):
        share = got.groupby(col).w.sum() / total
        goal = share ** power / (share ** power).sum()
        np.testing.assert_allclose((got.w * got.factor).groupby(got[col]).sum() / total, goal, rtol=1e-9)


def test_mixing_takes_nulls_and_clashing_columns(spark, documents):
    rows = [(i, "word " * (i % 7 + 1), None if i % 5 == 0 else "en", None if i % 3 == 0 else "s1") for i in range(200)]
    rows += [(None, None, None, None), (500, "", "xx", "s9"), rows[1]]
    docs = documents(rows).withColumn("factor", F.lit(1)).withColumn("s", F.lit(2)).withColumn("w", F.lit(3))
    out = mixing.mixed(docs)
    assert out.columns[:len(docs.columns)] == docs.columns
    got = out.collect()
    assert 60 < len(got) < 160 and all(0 < r.mix_prob <= 1 <= r.mix_weight for r in got)
    assert mixing.mixed(docs.where("false")).count() == 0
    named = docs.withColumns({c: F.lit("own") for c in ("_source", "_u", "_mix_factor", "mix_topic")})
    again = mixing.mixed(named)
    assert again.columns == [*named.columns[:-1], "mix_topic", "mix_prob", "mix_weight"]
    kept = again.collect()
    assert all((r._source, r._u, r._mix_factor) == ("own",) * 3 for r in kept)
    assert sorted((r.doc_id or -1, r.mix_topic) for r in kept) == sorted((r.doc_id or -1, r.mix_topic) for r in got)


# language ---------------------------------------------------------------------------------------

def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() / got.count() > 0.97


def test_language_strange_rows(documents):
    rows = [(i, "the cat and the dog sat there" if i % 2 else "der hund und die katze sitzen dort", "en" if i % 2 else "de")
            for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 34 !?", "en"), (None, "the dog", "en"), (103, "x", None)]
    got = {r.doc_id: r for r in language.languages(documents(rows).withColumn("letters", F.lit(0))).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert got[None].lang_pred == "en" and not got[None].held_out and got[103].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.languages(documents([(1, "a", None)])).collect()} == {"und"}
    assert language.languages(documents(rows).where("false")).count() == 0


def test_pairwise_machines_decide_within_a_family():
    x = np.eye(4, dtype=np.float32)[np.arange(400) % 4]
    lang = [("de", "en", "fr", "es")[i % 4] for i in range(400)]
    model = language.fit(x, lang)
    assert model["families"] == ["germanic", "romance"] and len(model["within"]) == 2
    got, score = language.predict(model, x)
    assert [model["langs"][i] for i in got] == lang and score.min() > 0.5


# toxicity ---------------------------------------------------------------------------------------

def test_network_gradient():
    p = {k: v.astype(np.float64) for k, v in bigru.init(1, np.zeros(bigru.WORDS), np.zeros(bigru.GRAMS)).items()}
    word, gram, bounds = np.array([3, 9, 4]), np.array([1, 2, 3, 1, 5, 6]), np.array([0, 2, 3, 6])
    win, d = np.array([[0, 1], [2, -1], [1, -1]]), np.array([1.0, -2.0])
    x = bigru.embed(p, word, gram, bounds)
    g = bigru.backward(p, x, bigru.forward(p, x, win, slice(0, 2), keep=True)[1], d, word, gram, bounds)
    for k, v in p.items():
        at = {"Ew": (9, 2), "Ec": (1, 3)}.get(k) or tuple(np.array(v.shape) // 2)
        old, side = v[at], []
        for e in (1e-2, -1e-2):
            v[at] = old + e
            side.append(bigru.forward(p, bigru.embed(p, word, gram, bounds), win, slice(0, 2)) @ d)
        v[at] = old
        assert abs((side[0] - side[1]) / 2e-2 - g[k][at]) < 1e-4


def test_every_overlapping_window_is_scored():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    p = bigru.init(2, rng.normal(size=bigru.WORDS), rng.normal(size=bigru.GRAMS))
    sizes = [0, 1, 5, 23, 24, 25, 40, 41, 130]
    texts = [" ".join("".join(rng.choice(list("abcde"), 4)) for _ in range(n)) for n in sizes]
    word, gram, bounds, code, starts = toxicity.encode(pa.array(texts))
    x = bigru.embed(p, word, gram, bounds)
    text, first, logit = toxicity.scan(p, x, code, starts)
    assert [(text == i).sum() for i in range(len(sizes))] == [max(1, n - toxicity.STEPS + 1) for n in sizes]
    again = toxicity.scan(p, x, code, starts, batch=1)[2]
    np.testing.assert_allclose(logit, again, rtol=1e-4, atol=1e-5)
    for i, n in enumerate(sizes):
        own = code[starts[i]:starts[i + 1]]
        score, share = np.zeros(n), np.zeros(n)
        for k in range(0, n, toxicity.CORE):          # a block alone, with its context
            lo, hi = max(0, k - toxicity.CONTEXT), min(n, k + toxicity.CORE + toxicity.CONTEXT)
            end = min(n, k + toxicity.CORE)
            forth = bigru.states(p, x, own[lo:end, None], "f")[k - lo:, 0]
            back = bigru.states(p, x, own[k:hi, None], "b")[:end - k, 0]
            score[k:end], share[k:end] = bigru.attended(p, forth, back)
        for j, got in zip(first[text == i], logit[text == i]):
            w = np.exp(score[j:j + toxicity.STEPS])
            want = (w @ share[j:j + toxicity.STEPS]) / w.sum() if n else 0.0
            assert got == pytest.approx(want + p["bo"][0], rel=1e-4, abs=1e-5)
    short = toxicity.sequences(code, starts, np.array([4]), np.array([-toxicity.CONTEXT]), toxicity.STEPS + 2 * toxicity.CONTEXT)
    core = slice(toxicity.CONTEXT, toxicity.CONTEXT + toxicity.STEPS)
    assert bigru.forward(p, x, short, core)[0] == pytest.approx(logit[text == 4][0], rel=1e-4)


def test_toxic_words_are_learned_and_held_out_rows_found(spark, documents):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(500):
        w = [rng.choice(vocab) for _ in range(rng.randint(3, 150))]
        if i % 4 == 0:
            w[rng.randrange(len(w))] = rng.choice(["vilest", "vilely", "vileness"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(None, " ".join(vocab[:9])), (900, None), (901, ""), (902, "!?"), rows[0]]
    labels += [(None, 1), (3, None), (905, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = documents(rows).withColumn("held_out", F.lit("x"))
    got = toxicity.score(docs, lab).collect()
    held = [r for r in got if r.held_out and r.doc_id < 500]
    assert len(got) == len(rows) and len(held) > 60
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    left = toxicity.without_toxic(docs, lab)
    assert left.columns == docs.columns and {None, 900, 901} <= {r.doc_id for r in left.collect()}
    none = toxicity.score(docs, lab.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score(docs.where("false"), lab).count() == 0


# pages ------------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><script>if (a<b) document.write("<p>no</p>")</script>
<style>p{}</style></head><body class="post-template"><header class="site-header"><a href="/">Home</a><p>Our slogan stands here.</p></header>
<nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for you and us. <button>OK</button></p></div>
<main><article><h1>A &amp; B&nbsp;title</h1><p>First   paragraph with <b>bold<br>and</b> <a href=q>a link</a>, long enough to read.
<p>Second one.<div class="advertisement">Buy this great thing now, it is very cheap today.</div>
<blockquote>Quoted &lt;words&gt;.</blockquote><ul><li>First point made<li>Second point made</ul>
<form><label>Mail</label><input name=m><textarea>hint</textarea></form><!-- <p>hidden</p> -->
<section class="comments"><h2>Comments</h2><article><p>I like this article very much, thank you for it.</p></article></section>
</article></main><aside><p>Read also this other long story about many things.</p></aside>
<footer><p>&copy; 2020 Someone, all of it is ours and none of it is yours.</p></footer></body></html>"""


def test_main_text():
    assert maintext.main_text(PAGE).split("\n\n") == [
        "A & B title", "First paragraph with bold and a link, long enough to read.", "Second one.",
        "Quoted <words>.", "First point made", "Second point made"]


OTHER = """<body><div id="wrapper" class="has-sidebar"><div class="top-bar">Call us <a href=t>now</a></div>
<div role="navigation"><a href=1>News</a> | <a href=2>Sport</a></div>
<div id="content"><div class="post-header"><h1>Plain title</h1></div><p>A first paragraph of the story, with some words in it.</p>
<p class="notice">This site is going to be closed for repairs on Sunday from nine to five, so please come back on Monday.</p>
<h2>Part</h2><p>Short.</p><table><tr><td>Cell one</td><td>Cell two</td></tr></table><p>The last paragraph ends the story here.</p>
<div class="share-buttons">Share this story with all of your friends today</div>
<div class="related-posts"><h3>Related</h3><p>Another story that you may like to read as well, about the same thing.</p></div></div>
<div id="comments"><h3>3 replies</h3><div class="comment"><p>What a nice story that was, I will read it again tomorrow.</p></div></div>
<div class="sidebar"><p>About the author, who lives somewhere and writes a lot of stories.</p></div></div>
<div id="footer"><p>All rights reserved by the company that runs this site.</p></div></body>"""


def test_main_text_of_odd_tags():
    long = "Some text stands here, and it is long enough."
    for page in (f"""<article><p class="x"">{long}</p><div class="y">{long}</div></article>""",
                 f"<article><p title=don't>{long}</p><p>{long}</p></article>",
                 f"""<article><p title="a > b">{long}</p><p>{long}</article>""",
                 f"""<article></i></nav><p>{long}</p></b><p title = 'it"s'>{long}"""):
        assert maintext.main_text(page) == f"{long}\n\n{long}"
    deep = maintext.main_text("<div>Words and words. " * 50000)       # no tag is ever closed
    assert deep.count("Words and words.") == 50000
    assert maintext.main_text("<font>" * 50000 + f"<p>{long}</p></b>" * 5000).count(long) == 5000


def test_main_text_without_article_tags():
    assert maintext.main_text(OTHER).split("\n\n") == [
        "Plain title", "A first paragraph of the story, with some words in it.", "Part", "Short.", "Cell one", "Cell two",
        "The last paragraph ends the story here."]


def test_pages_strange_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "plain words only, without any markup in them at all."),
            (3, "w", "<p>Never closed, and a stray </div></b> tag & an < sign in a long enough text"),
            (4, "x", "<script>never ends <p>text</p>"), (5, "y", "<div>" * 3000 + "deep text in here, enough words to keep."), ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r for r in maintext.extract(df).collect()}
    assert got[1].text == got[2].text == got[4].text == "" and got[1].n_chars == 0
    assert got[None].text.startswith("plain words") and got[5].text.startswith("deep text")
    assert got[3].text == "Never closed, and a stray tag & an < sign in a long enough text"
    assert maintext.extract(df.where("false")).count() == 0


def test_minimum_cut_is_minimal():
    rng = random.Random(9)
    for _ in range(60):
        n = rng.randint(1, 7)
        gain = [rng.uniform(-4, 4) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 3)) for a in range(n) for b in range(a + 1, n) if rng.random() < .5]

        def cut(side):
            return (sum(g for g, s in zip(gain, side) if g > 0 and not s) - sum(g for g, s in zip(gain, side) if g < 0 and s)
                    + sum(c for a, b, c in edges if side[a] != side[b]))
        best = min(cut([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cut(maintext.min_cut(gain, edges)) == pytest.approx(best)


# licences ---------------------------------------------------------------------------------------

def test_licences(documents):
    s = licences.SENTENCES
    mit = "\n\n".join([s["mit_name"], "Copyright (c) 2020 Some One", s["mit_grant"], s["mit_notice"]])
    wrapped = textwrap.fill(s["bsd_grant"], 60)
    bsd = "\n".join([s["bsd_grant"], "* " + s["bsd_source"], "* " + s["bsd_binary"]])
    rows = [(1, mit), (2, bsd + "\n" + s["bsd_names"]), (3, bsd), (4, "words. Licensed under CC BY-NC 4.0. More"),
            (5, "no notice, but a licence and permission"), (6, None), (7, ""), (8, s["mit_notice"]),
            (None, "x\nRELEASED under the MIT   License!\n" + s["apache2_ref"]), (9, "# " + wrapped)]
    got = {r.doc_id: r for r in licences.licences(documents(rows).withColumn("s", F.lit(1))).collect()}
    assert [got[i].licenses for i in (1, 2, 3, 4, 5, 6, 7, 8, None)] == [
        "MIT", "BSD-3-Clause", "BSD-2-Clause", "CC-BY-NC-4.0", "", "", "", "", "MIT,Apache-2.0"]
    assert got[9].sentence_ids == "<bsd_grant>" and got[4].n_licenses == 1
    plan = licences.licences(documents(rows))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert licences.licences(documents(rows).where("false")).count() == 0


def test_hints_need_no_space_of_the_raw_text(documents):
    notice = licences.SENTENCES["unlicense"]
    rows = [(i, notice.replace("public domain", f"public{gap}domain")) for i, gap in enumerate(("\n", "  ", " \n ", "-"))]
    got = licences.licences(documents(rows)).collect()
    assert [r.licenses for r in got] == ["Unlicense"] * 4


def test_every_known_sentence_has_a_hint_and_its_own_form():
    import re
    forms = [tuple(licences.pieces(x)) for x in licences.SENTENCES.values()]
    assert len(set(forms)) == len(forms) and all(re.search(licences.HINTS, " ".join(f)) for f in forms)
    used = set(re.findall(r"<(\w+)>", "".join(p for _, p in licences.RULES)))
    assert used == set(licences.SENTENCES)


FORMS = {
    "plain": lambda t: t,
    "in a text": lambda t: f"Some words here.\n{t}\nAnd some more words.",
    "after a sentence": lambda t: f"Some words here. {t}{'' if t[-1] in '.:' else '.'} And more.",
    "wrapped": lambda t: textwrap.fill(t, 40),
    "wrapped, behind a copyright line": lambda t: "Copyright (c) 2020 Some One\n" + textwrap.fill(t, 50),
    "wrapped, behind a paragraph": lambda t: "Copyright 2020 X, all of it\n\n" + textwrap.fill(t, 60) + "\n\nMore words",
    "comment": lambda t: "#!/bin/sh\n#\n# Copyright (C) 2021 X\n#\n" + textwrap.fill(t, 50, initial_indent="# ", subsequent_indent="# ") + "\n#\n",
    "block comment": lambda t: "/*\n * (c) X\n *\n" + textwrap.fill(t, 50, initial_indent=" * ", subsequent_indent=" * ") + "\n */",
    "carriage returns": lambda t: textwrap.fill(t, 45).replace("\n", "\r\n") + "\r\n\r\nMore.",
}


@pytest.mark.parametrize("form", FORMS)
def test_every_known_sentence_is_recognised(documents, form):
    names = list(licences.SENTENCES)
    rows = [(i, FORMS[form](licences.SENTENCES[n])) for i, n in enumerate(names)]
    got = {names[r.doc_id]: r.sentence_ids for r in licences.licences(documents(rows)).collect()}
    assert got == {n: f"<{n}>" for n in names}


@pytest.mark.parametrize("width", [40, 60, 72, 10_000])
def test_whole_notices_give_their_licence(documents, width):
    s, w = licences.SENTENCES, lambda t: textwrap.fill(t, width)
    mit = "\n\n".join(["Copyright (c) 2020 X", w(s["mit_grant"]), w(s["mit_notice"])])
    apache = "\n\n".join(["Copyright 2020 X", w(s["apache2_notice"] + " " + s["apache2_copy"]), w(s["apache2_as_is"] + " " + s["apache2_see"])])
    gpl3 = "\n\n".join([w(s["gpl3_notice"]), w(s["gpl_purpose"] + " " + s["gpl_see"]), w(s["gpl_received"])])
    gpl2 = "\n\n".join([w(s["gpl2_notice"]), w(s["gpl_purpose"] + "  " + s["gpl_see"]), w(s["gpl_received"])])
    isc = "ISC License\n\nCopyright (c) 2020, X\n\n" + w(s["isc_grant"])
    bsd = "\n\n".join([w(s["bsd_grant"]), "1. " + w(s["bsd_source"]), "2. " + w(s["bsd_binary"]), "3. " + w(s["bsd_names"])])
    texts = {"MIT": mit, "Apache-2.0": apache, "GPL-3.0-or-later": gpl3, "GPL-2.0-or-later": gpl2, "ISC": isc,
             "MPL-2.0": w(s["mpl2_notice"])}
    rows = list(enumerate([*texts.values(), bsd]))
    got = {r.doc_id: r.licenses for r in licences.licences(documents(rows)).collect()}
    assert [got[i] for i, _ in rows[:-1]] == list(texts)


# pipeline ---------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    from test_text_dedup import plain_classes, plain_hits, plain_lines
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = corpus_pipeline.cut(stage(spark, docs, SF))
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if name != "mixing":
            assert docs.columns == columns
        if name == "line_dedup":
            import hashlib
            assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in after.items()} == {
                i: s for i, _, _, s in plain_lines(before)}
            assert docs.where("n_chars <> length(text)").count() == 0
        elif name == "near_duplicates":
            assert set(after) == {i for i, c in plain_classes(before).items() if i == c}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {r[0] for r in plain_hits(before, items) if not r[-1]}
        kept[name] = len(after)
        assert after
    assert kept["toxicity"] < 200 and kept["mixing"] < kept["decontamination"]
    assert set(registry.QUERIES) >= {"pipeline", "op1_topk", "op10_substring_dedup"}
