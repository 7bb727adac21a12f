"""Lines, near duplicates, passages and benchmark windows against plain Python."""

import collections
import hashlib
import random
import re
import time
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loadbay.llm import decontaminate, line_dedup, minhash, passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghiäé") for _ in range(rng.randint(2, 7))) for _ in range(n))


def strange(rows):
    """The rows again with the cases every operator must take."""
    return rows + [(None, "no id, but words enough to be a text of its own"), (9001, None), (9002, ""),
                   (9003, "\n\n \t\n"), (9004, "?! ... 　"), rows[0]]


# lines --------------------------------------------------------------------------------------

def plain_lines(rows):
    key = lambda s: low(s.strip(" \t\n\x0b\x0c\r"))
    where = collections.defaultdict(set)
    for i, t in rows:
        if i is not None:
            for s in (t or "").split("\n"):
                where[key(s)].add(i)
    out = []
    for i, t in rows:
        kept, gone = [], 0
        for s in (t or "").split("\n"):
            d = where[key(s)]
            if i is not None and len(key(s)) >= 40 and len(d) >= 5 and i != max(d):
                gone += 1
            else:
                kept.append(s)
        n = gone + len(kept)
        out.append((i, n, gone, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(3)
    hot = ["  Ä line that very many of the documents hold, with Capitals ", "x" * 39, "y" * 40, "é" * 40]
    rows = []
    for i in range(400):
        body = [sentence(rng, 12) for _ in range(rng.randint(0, 4))]
        body += rng.sample(hot, rng.randint(0, 3)) * rng.randint(1, 3)
        rng.shuffle(body)
        rows.append((i, "\n".join(body)))
    rows += [(1000 + i, ("Only in four documents, " * 3) + str(i // 4)) for i in range(8)]
    return strange(rows)


@pytest.mark.parametrize("partitions", [1, 3, 31])
def test_lines_match_plain_python(spark, documents, settings, line_rows, partitions):
    # many partitions: the hot lines' runs cross several of them
    settings(shuffle__partitions=str(partitions), adaptive__coalescePartitions__enabled="false")
    got = line_dedup.line_dedup(documents(line_rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_lines(line_rows)


def test_lines_keep_columns_and_use_bitmaps(spark, documents, line_rows):
    docs = documents(line_rows).withColumn("keep", F.lit(1)).withColumn("th", F.lit(2))
    out = line_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(line_rows)
    got = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in out.collect() if r.doc_id}
    want = {i: s for i, _, _, s in plain_lines(line_rows) if i}
    assert got == want
    maps = line_dedup.line_bitmaps(docs)
    assert "text" not in maps.columns and maps.agg(F.max(F.length("keep"))).first()[0] < 40


def test_line_workers_hold_a_slice_not_a_batch():
    import tracemalloc

    import pyarrow as pa

    from loadbay.llm import tokens

    rng = random.Random(8)
    texts = ["\n".join(sentence(rng, 10) for _ in range(40)) for _ in range(200)] * 20
    n, size = len(texts), sum(len(t.encode()) for t in texts)
    assert size > 5 * (tokens.SLICE_BYTES >> 1)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array(texts), pa.array(range(n)), pa.nulls(n, pa.binary())], ["doc_id", "text", "th", "k"])
    for work, most in ((line_dedup._keys(line_dedup.MIN_CHARS), 64), (line_dedup._rewrite, 4)):
        tokens._powers.clear()
        tracemalloc.start()
        rows = sum(b.num_rows for b in work(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= n and peak < most << 20, peak


def test_lines_empty_table(documents):
    assert line_dedup.line_dedup(documents([]).where("false")).count() == 0


# near duplicates ------------------------------------------------------------------------------

def plain_classes(rows, threshold=0.8, k=5):
    bags = {}
    for i, t in rows:
        w = WORD.findall(low(t))
        if w and i is not None:
            bags[i] = collections.Counter(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1)))
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(bags, 2):
        if sum((bags[a] & bags[b]).values()) >= threshold * sum((bags[a] | bags[b]).values()):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(5)
    rows = [(i, sentence(rng, rng.randint(1, 120))) for i in range(60)]
    base = sentence(rng, 150).split(" ")
    for i in range(200, 330):            # copies around a base, many just above or below 0.8
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = sentence(rng, 1)
        rows.append((i, " ".join(w)))
    rows += [(400 + i, "Same, WORDS here!" if i % 2 else "same words here") for i in range(6)]
    rows += [(500, "la " * 300 + sentence(random.Random(1), 20)), (501, "la " * 310 + sentence(random.Random(1), 20)),
             (502, "la " * 100 + sentence(random.Random(1), 20))]
    return strange(rows)


def test_near_classes_match_all_pairs(documents, near_rows):
    got = minhash.near_classes(documents(near_rows)).collect()
    assert len(got) == len(near_rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == plain_classes(near_rows)
    assert [r.class_id for r in got if r.doc_id is None] == [None]


def settled(spark, rows, **options):
    """Classes and number of links when all rows are one knot without links."""
    ids = [(i, min(i for i, _ in rows), i) for i, _ in rows]
    texts = spark.createDataFrame([(i, t, max(1, len(WORD.findall(low(t))) - 4)) for i, t in rows],
                                  "doc_id long, text string, size long")
    links = minhash.block_links(spark.createDataFrame(ids, "rep long, head long, label long"),
                                texts, spark.createDataFrame([], "a long, b long"), 0.8, **options)
    return {r.node: r.label for r in minhash.components(links).collect()}, links.count()


@pytest.mark.parametrize("options", [{}, {"block": 20}, {"block_bytes": 3000}])
def test_knots_are_settled_in_blocks(spark, near_rows, options):
    rows = [(i, t) for i, t in dict(near_rows).items() if i is not None and 200 <= i < 330]
    got, links = settled(spark, rows, **options)
    plain = plain_classes(rows)
    assert got == {i: c for i, c in plain.items() if list(plain.values()).count(c) > 1}
    assert links <= 6 * len(rows)          # also in blocks of three texts


def test_links_stay_as_many_as_texts(spark):
    """2000 near copies of a few texts in many blocks: links by texts, not by pairs of blocks."""
    rng = random.Random(9)
    bases = [sentence(rng, 60).split(" ") for _ in range(5)]
    rows = []
    for i in range(2000):
        w = list(rng.choice(bases))
        w[rng.randrange(len(w))] = f"w{i}"
        rows.append((i, " ".join(w)))
    got, links = settled(spark, rows, block=64)
    assert len(got) == 2000 and len(set(got.values())) == 5
    assert links <= 4 * len(rows)


def test_signatures_estimate_weighted_similarity():
    import numpy as np
    a, b = {1: 5, 2: 1, 3: 40, 4: 2}, {1: 3, 2: 1, 3: 64, 9: 7}
    text = np.array([0] * 4 + [1] * 4)
    item = np.array([*a, *b], np.uint64)
    sig = minhash.signatures(text, item, np.array([*a.values(), *b.values()]), 2, 16384)
    low_, high = sum(min(a.get(x, 0), b.get(x, 0)) for x in {*a, *b}), sum(max(a.get(x, 0), b.get(x, 0)) for x in {*a, *b})
    assert abs((sig[0] == sig[1]).mean() - low_ / high) < 0.015


def test_one_per_class_keeps_the_least(documents, near_rows):
    docs = documents(near_rows).withColumn("rep", F.lit("x")).withColumn("label", F.lit("y"))
    out = minhash.one_per_class(docs)
    want = plain_classes(near_rows)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {i for i, c in want.items() if i == c} | {None}


def test_near_empty(documents):
    assert minhash.near_classes(documents([]).where("false")).count() == 0


# passages -------------------------------------------------------------------------------------

def test_planted_passages_are_found_and_others_left(documents):
    rng = random.Random(8)
    passage = [sentence(rng, 60) for _ in range(3)]
    halves = [sentence(rng, 30) for _ in range(2)]
    rows = [(i, sentence(rng, rng.randint(1, 400))) for i in range(40)]
    for n, p in enumerate(passage):
        for i in range(4):
            w = p.split(" ")
            if n == 1:
                w[20 + i] = "changed"                       # fuzzy: a word replaced, one left out
                del w[40]
            rows.append((100 + 10 * n + i, f"{sentence(rng, 80)} {' '.join(w)} {sentence(rng, 90)}"))
    # both halves of a passage alone in earlier documents
    rows += [(50, sentence(rng, 9) + " " + halves[0]), (51, halves[1] + " " + sentence(rng, 9)),
             (60, sentence(rng, 30) + " " + " ".join(halves)), (61, " ".join(halves) + " " + sentence(rng, 30))]
    got = {r.doc_id: r for r in passages.passage_classes(documents(strange(rows))).collect()}
    for n in range(3):
        assert {got[100 + 10 * n + i].class_id for i in range(4)} == {100 + 10 * n}
        span = max(got[100 + 10 * n + 1].passages, key=lambda s: s.matched)
        assert 55 <= span.end - span.begin <= 66 and abs(span.begin - 80) <= 3
    assert got[61].class_id == got[60].class_id == 60
    clean = [i for i in [*range(1, 40), 50, 51, 9001, 9002, 9003, 9004] if got[i].class_id != i]
    assert not clean and got[None].class_id is None


@pytest.mark.parametrize("partitions", [1, 29])
def test_seed_matches_go_to_the_first_holder(spark, documents, settings, partitions):
    settings(shuffle__partitions=str(partitions), adaptive__coalescePartitions__enabled="false")
    text = sentence(random.Random(2), 100)
    got = passages.matches(documents([(i, text) for i in range(7, 57)]))
    per_doc = {r.doc: (r.n, r.src) for r in got.groupBy("doc").agg(F.count("*").alias("n"), F.max("src").alias("src"))
               .join(got.groupBy("doc").agg(F.min("src").alias("lo")), "doc").where("lo = src").collect()}
    assert set(per_doc) == set(range(8, 57)) and len({v for v in per_doc.values()}) == 1


def test_chains_follow_order_and_gap_costs():
    import numpy as np
    x, y = np.array([0, 10, 20, 200]), np.array([5, 15, 2, 205])
    paths = passages.chain(x, y, np.array([8, 8, 8, 8]))
    assert paths[0] == [0, 1] and [2] in paths and [3] in paths


def test_passages_joined_by_a_chain_are_reported_apart(documents):
    rng = random.Random(12)
    one, two = sentence(rng, 60), sentence(rng, 60)
    docs = [" ".join([sentence(rng, 30), one, sentence(rng, 60), two, sentence(rng, 30)]) for _ in range(2)]
    rows = {r.doc_id: r for r in passages.passage_classes(documents(list(enumerate(docs, 1)))).collect()}
    a, b = (low(t).split(" ") for t in docs)
    runs = [i for i in range(1, len(a) - 49) if a[i:i + 50] == b[i:i + 50] and a[i - 1:i + 50] != b[i - 1:i + 50]]
    assert len(runs) == 2 and rows[2].class_id == 1 and rows[2].n_passages == 2 and rows[1].n_links == 1
    for i, got in zip(runs, rows[2].passages):
        assert abs(got.begin - i) <= 1 and abs(got.end - got.begin - 60) <= 2 and got.matched >= 60


def test_every_occurrence_of_a_passage_is_reported(spark, documents, settings):
    settings(shuffle__partitions="3", adaptive__coalescePartitions__enabled="false",
             execution__arrow__maxRecordsPerBatch="7")
    rng = random.Random(13)
    line = sentence(rng, 60)
    own = " ".join([line, sentence(rng, 40), line, sentence(rng, 40), line])
    rows = [(1, own), (2, sentence(rng, 20) + " " + own), (3, sentence(rng, 200)), (None, own)]
    got = {r.doc_id: r for r in passages.passage_classes(documents(rows + rows[:1])).collect()}

    def places(r):
        return {(s.src, round(s.begin, -1)) for s in r.passages}

    assert places(got[1]) == {(1, 100), (1, 200)} and got[1].n_links == 1 and got[1].n_passages >= 2
    assert places(got[2]) == {(1, 20), (1, 120), (1, 220)} and (got[2].class_id, got[2].n_links) == (1, 1)
    assert got[3].passages is None and (got[3].class_id, got[3].n_links, got[3].n_passages) == (3, 0, 0)


@pytest.mark.parametrize("stars", [0, 1, 3])
def test_later_holders_of_a_seed_are_compared_too(documents, monkeypatch, stars):
    """Every seed of the passage is first held by a piece too short to share it with."""
    monkeypatch.setattr(passages, "STARS", stars, raising=False)
    rng = random.Random(21)
    whole = sentence(rng, 120).split(" ")
    pieces = [whole[i:i + 32] for i in range(0, 90, 4)]
    rows = [(i, " ".join([sentence(rng, 40), *p, sentence(rng, 40)])) for i, p in enumerate(pieces, 1)]
    other = [*whole[:60], "changed", *whole[61:]]
    rows += [(50 + i, " ".join([sentence(rng, 30), *w, sentence(rng, 30)])) for i, w in enumerate((whole, whole, other))]
    rows += [(90, sentence(rng, 300)), (91, None), (None, rows[-1][1])]
    got = {r.doc_id: r for r in passages.passage_classes(documents(rows + rows[:2])).collect()}
    assert got[51].class_id == got[52].class_id == got[50].class_id
    for doc in (51, 52):
        long = [p for p in got[doc].passages if p.src >= 50 and p.end - p.begin >= 115]
        assert long and all(abs(p.begin - 30) <= 3 for p in long)
    assert got[51].n_links >= 1 and got[90].class_id == 90 and got[90].passages is None


def test_stretches_are_those_of_brute_force():
    import numpy as np
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        p, q = (np.cumsum(rng.integers(1, 4, n) * (rng.random(n) < .4) + 1) for _ in range(2))

        def fits(s, e):
            spans = p[e] - p[s] + 1, q[e] - q[s] + 1
            return min(spans) >= 10 and e - s + 1 >= .8 * max(spans) - 1e-9

        got = passages.stretches(p, q, 10, .8)
        assert bool(got) == any(fits(s, e) for s in range(n) for e in range(s, n))
        assert all(fits(s, e) for s, e in got) and all(x[1] < y[0] for x, y in zip(got, got[1:]))


# benchmark windows ------------------------------------------------------------------------------

def plain_hits(docs, items, size=10):
    wins = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall(low(t))
        n = min(size, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            wins[tuple(w[p:p + n])].add(i)
    out = []
    for i, t in docs:
        w, hit, found = WORD.findall(low(t)), set(), set()
        for g, ids in wins.items():
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p:p + len(g)]) == g:
                    hit |= set(range(p, p + len(g)))
                    found |= ids
        names = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_windows_match_plain_python(spark, documents, block):
    rng = random.Random(4)
    items = [(i, sentence(rng, rng.randint(1, 25))) for i in range(12)]
    items += [(12, None), (13, "?!"), (14, items[3][1]), (3, items[3][1]), (None, "lost words")]
    rows = []
    for i in range(40):
        w = sentence(rng, 30).split(" ")
        part = items[rng.randrange(12)][1].split(" ")
        w[10:10] = part[rng.randint(0, 3):]
        rows.append((i, ", ".join(w).upper() if i % 3 == 0 else "  ".join(w)))
    rows = strange(rows)[:-1]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.digest(decontaminate.find_items(documents(rows), bench, block_bytes=block))
    want = plain_hits(rows, [x for x in items if x[0] is not None])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_spans_point_into_the_original(spark, documents):
    item = "one two three four five six seven eight nine ten"
    text = "Ä «start»: " + item.upper().replace(" ", " -- ") + "! end"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = decontaminate.find_items(documents([(5, text)]), bench).first()
    assert [text[s.begin:s.end] for s in row.spans] == [item.upper().replace(" ", " -- ")]
    left = decontaminate.without_leaks(documents([(5, text), (6, "clean"), (None, None)]), bench)
    assert {r.doc_id for r in left.collect()} == {6, None}


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_leaks_go_by_text_whatever_the_id(spark, documents, block):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item), (2, sentence(random.Random(1), 20))], "item_id long, text string")
    rows = [(None, f"so {item}"), (None, "clean, without an id"), (7, item), (7, "clean, with the same id"), (8, None)]
    df = documents(rows).withColumn("_hit", F.lit("own")).withColumn("th", F.lit(1))
    left = decontaminate.without_leaks(df, bench, block_bytes=block)
    assert left.columns == df.columns
    assert sorted([(r.doc_id, r.text, r._hit, r.th) for r in left.collect()], key=repr) == sorted(
        [(*r, "own", 1) for r in rows if r[1] is None or "clean" in r[1]], key=repr)


def test_line_dedup_leaves_clashing_columns(documents):
    line = "a line that many documents hold, of more than forty characters"
    df = documents([(i, f"{line}\n{i}") for i in range(6)]).withColumns(
        {c: F.lit(c) for c in ("keep_map", "_id", "_th", "th", "pos")})
    got = line_dedup.without_repeats(df)
    assert got.columns == df.columns
    assert {(r.text, r.keep_map, r._id, r._th, r.th, r.pos) for r in got.collect()} == {
        (f"{i}" if i < 5 else f"{line}\n5", "keep_map", "_id", "_th", "th", "pos") for i in range(6)}


def test_no_items_or_documents(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_items(documents([(1, "a b")]), none).first().n_hit == 0
    assert decontaminate.find_items(documents([]).where("false"), none).count() == 0


def test_line_sql_agrees_on_strange_rows(documents, line_rows):
    rows = [r for r in line_rows if r[0] is not None]
    con = duckdb.connect()
    con.register("documents", documents(rows).toPandas())
    assert sorted((tuple(r) for r in con.execute(
        f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({line_dedup.SQL})").fetchall()), key=repr) == plain_lines(rows)


def test_texts_that_go_round_make_few_chains(documents):
    import pyarrow as pa
    for text in ("the " * 3000, "la le lu " * 1000, "a b c d e f g h i j " * 300):
        seed, *_ = passages.seeds(*passages.T.buffer(pa.array([text])))
        assert len(seed) <= 2 * 3000 / passages.ROUND + 10
    rng = random.Random(3)
    rows = [(1, sentence(rng, 30) + " the" * 400), (2, "the " * 120 + sentence(rng, 30)), (3, "x " + "the " * 70)]
    got = passages.passage_classes(documents(rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 2: 1, 3: 1}
    for doc, first, last in ((2, 0, 120), (3, 1, 71)):
        covered = set()
        for p in next(r.passages for r in got if r.doc_id == doc):
            covered |= set(range(p.begin, p.end))
        assert covered >= set(range(first, last))


def test_passages_reach_beyond_the_first_cut(documents, monkeypatch):
    rng = random.Random(12)
    long = sentence(rng, 900).split(" ")
    other = list(long)
    for k in range(40, 900, 37):
        other[k] = f"x{k}"
    rows = [(1, sentence(rng, 60) + " " + " ".join(long) + " " + sentence(rng, 50)),
            (2, sentence(rng, 20) + " " + " ".join(other) + " " + sentence(rng, 70))]
    want = sorted(map(tuple, passages.passages(documents(rows)).collect()))
    monkeypatch.setattr(passages, "PAD", 150)
    assert sorted(map(tuple, passages.passages(documents(rows)).collect())) == want
    assert any(r[3] - r[2] > 850 for r in want)


def test_ends_are_searched_in_time_in_proportion_to_their_length():
    """Words left out every 40 words: each step looks at what follows it, not at all that is left."""
    def spent(n):
        a = np.arange(n, dtype=np.uint64)
        b = a[a % np.uint64(40) != np.uint64(39)]
        took = []
        for _ in range(3):
            began = time.process_time()
            p, q = passages._reach(a, b)
            took.append(time.process_time() - began)
            assert (a[p] == b[q]).all() and len(p) == len(b)
        return min(took)

    assert spent(160_000) < 6 * spent(40_000)


def test_common_words_and_diagonals_are_those_of_plain_tables(monkeypatch):
    rng = np.random.default_rng(7)

    def grown(row, x, b):
        out = [0]
        for j, y in enumerate(b):
            out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
        return out

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a.tolist():
            row = grown(row, x, b.tolist())
        return row[-1]

    def furthest(a, b):
        score = best = far = 0
        for k, (x, y) in enumerate(zip(a, b), 1):
            score += 1 if x == y else -2
            if score > best:
                best, far = score, k
            if best - score > passages.DROP:
                break
        return far

    for cells, long in ((1 << 26, 4096), (1 << 26, 4), (90, 4096)):
        monkeypatch.setattr(passages, "CELLS", cells)
        monkeypatch.setattr(passages, "LONG", long)
        for _ in range(150):
            a, b = (rng.integers(0, rng.integers(1, 20), rng.integers(0, 40)).astype(np.uint64) for _ in range(2))
            p, q = passages._common(a, b)
            assert (a[p] == b[q]).all() and (np.diff(p) > 0).all() and (np.diff(q) > 0).all()
            assert len(p) == longest(a, b)
    for _ in range(300):
        a = rng.integers(0, 9, rng.integers(0, 900)).astype(np.uint64)
        b = np.where(rng.random(len(a)) < rng.choice([0.02, 0.1, 0.3]), a + np.uint64(1), a)[:len(a) - int(rng.integers(0, 2)) or None]
        assert passages._diagonal(a, b) == furthest(a.tolist(), b.tolist())
