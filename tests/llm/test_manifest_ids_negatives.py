"""Merkle manifest, token id shards and hard negatives against plain Python."""

import glob
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from loadbay.llm import merkle, negatives, registry, tokenfile
from loadbay.session import fresh_path

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- Merkle manifest ----------------------------------------------------------

def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_manifest(rows, arity=16, every=5):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def leaf(d, t, l, s, n):
        return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (d, s, l, n, t)))

    def climb(nodes, at):
        """(top, siblings of node ``at`` level by level)."""
        sib = []
        while len(nodes) > 1:
            a = at // arity * arity
            sib.append((nodes[a:at], nodes[at + 1:a + arity]))
            nodes = [h("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
            at //= arity
        return nodes[0], sib

    def lower(t):
        return t and "".join(c.lower() if c.isascii() else c for c in t)
    sources = {}
    for d, t, l, s, n in rows:
        hit = d is not None and zlib.crc32(str(d).encode()) % every == 0
        sources.setdefault(s, []).append((d, leaf(d, t, l, s, n), leaf(d, lower(t), l, s, n) if hit else None))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    tops = [climb([x[1] for x in sources[s]], 0)[0] for s in names]
    out = []
    for i, s in enumerate(names):
        for j, (d, leaf_, bad) in enumerate(sources[s]):
            _, low = climb([x[1] for x in sources[s]], j)
            root, high = climb(tops, i)
            node = bad or leaf_
            for a, b in low + high:
                node = h("".join(a) + node + "".join(b))
            proof = h("".join("".join(a) + "".join(b) for a, b in low + high))
            out.append((d, leaf_, tops[i], root, proof, node, node == root))
    return sorted(out, key=repr)


def spark_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def manifest_of(df, **options):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
                   for r in merkle.manifest(df, **options).collect()), key=repr)


def some_rows(n, seed=1):
    r = random.Random(seed)
    return [(i, r.choice(["Ab C", "é\nX", "", None, "zz" * 50]), r.choice(["en", None]),
             r.choices(["hot", "b", "", None, "é"], [8, 2, 1, 1, 1])[0], r.choice([None, 3])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 300])
def test_manifest_is_the_plain_one(spark, n):
    rows = some_rows(n)
    assert manifest_of(spark_docs(spark, rows)) == plain_manifest(rows)


@pytest.mark.parametrize("arity,block", [(2, 3), (3, 7), (16, 5)])
def test_manifest_with_small_partitions(spark, arity, block):
    rows = some_rows(200, seed=arity)
    assert manifest_of(spark_docs(spark, rows), arity=arity, block=block) == plain_manifest(rows, arity)


def test_manifest_of_odd_rows(spark):
    rows = [(None, "A", "en", "s", 1), (None, None, None, None, None), (5, "X", "en", "s", 1), (5, "X", "en", "s", 1),
            (5, "Y", "en", "s", 1), (-7, "Q", "en", "s", None), (None, "A", "en", "s", 1)]
    df = spark_docs(spark, rows).selectExpr("*", "1 AS part", "2 AS tree", "3 AS idx", "'x' AS leaf", "0 AS total")
    assert manifest_of(df) == plain_manifest(rows)
    assert manifest_of(spark_docs(spark, [])) == []


def test_only_tampered_texts_fail(spark):
    got = manifest_of(spark_docs(spark, [(i, "Text", "en", "s", 4) for i in range(100)]))
    assert {r[0] for r in got if not r[6]} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0}


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_missing_coordinates_are_minimal(arity):
    """Each coordinate is needed by a proof, and is neither held nor derivable; none is absent."""
    for n in (1, 2, 15, 16, 17, 40, 300):
        for low, high in {(0, 0), (0, n - 1), (n // 3, n // 2), (n - 1, n - 1), (n // 2, min(n - 1, n // 2 + 20))}:
            want, have, m, level = set(), set(range(low, high + 1)), n, 0
            while m > 1:
                need = {x for i in have for x in range(i // arity * arity, min((i // arity + 1) * arity, m))}
                want |= {(level, x) for x in need - have}
                have, m, level = {i // arity for i in have}, -(-m // arity), level + 1
            got = list(merkle.missing(low, high, n, arity))
            assert sorted(got) == sorted(want) and len(got) == len(set(got))


# --- token id shards ----------------------------------------------------------

NASTY = ["", None, " ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \nb", "a  b", "a  b", "a 　 b", "\n\n x  ",
         "it's we'll  DON'T 's", "a <|endoftext|> b<|endoftext|>c", "#", "# # ##", "é è  ü​ x", "a ᠎b", "\t\ta\t b",
         "日本 語 テ  キスト", "x" * 5000, "word " * 3000, "1 2  3,4 .5", "a \x1cb \x85c", "﻿ b ﻿c", "😀 😀  👍🏽"]


def plain_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [2]


def unpack(raw):
    return np.frombuffer(raw, "<u2").tolist()


def test_pieces_give_the_ids_of_the_whole_text():
    got = tokenfile.Coder(TOKENIZER).encode(NASTY)
    assert [unpack(x) for x in got] == [plain_ids(t) for t in NASTY]
    rng = random.Random(3)
    texts = ["".join(rng.choice([" ", " ", "  ", "\n", "a", "Be", "'s", "1", "é", ",", " ", "\x1f", "日", "#"])
                     for _ in range(60)) for _ in range(300)]
    assert [unpack(x) for x in tokenfile.Coder(TOKENIZER).encode(texts)] == [plain_ids(t) for t in texts]


def test_many_words_at_once():
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abéÄ.#'1<|>日") for _ in range(rng.randint(1, 9))) for _ in range(9000))
    text += " <|endoftext|> x<|endoftext|>y <|endoftext|>z"
    assert unpack(tokenfile.Coder(TOKENIZER).encode([text])[0]) == plain_ids(text)


def test_pieces_beyond_the_kept_ones(monkeypatch):
    monkeypatch.setattr(tokenfile, "KEPT", 3)
    own = tokenfile.Coder(TOKENIZER)
    assert [unpack(x) for _ in range(2) for x in own.encode(NASTY)] == [plain_ids(t) for t in NASTY * 2]
    assert len(own.inner) <= 3


def test_a_word_is_kept_once_whatever_marks_follow_it():
    own = tokenfile.Coder(TOKENIZER)
    texts = ["so once, word word, word! (twice", "so two.\nlines two.\nlines (twice word."]
    for _ in range(2):
        assert [unpack(x) for x in own.encode(texts)] == [plain_ids(t) for t in texts]
    assert {"word", "two.\nlines", "(twice"} == own.inner.keys()
    assert own.encode([]) == [] and [unpack(x) for x in own.encode([None, ""])] == [[2], [2]]


def test_every_latin_letter_and_mark():
    letters = [chr(c) for c in range(33, 0x250)]
    text = " ".join(a + b + c for a, b, c in zip(letters, letters[7:] + letters[:7], letters[90:] + letters[:90]))
    text += "".join(f" x{m} é{m}{m} don't{m} 's{m} a1{m}" for m in tokenfile._MARKS)
    assert unpack(tokenfile.Coder(TOKENIZER).encode([text])[0]) == plain_ids(text)


def test_other_tokenizers_encode_whole_texts():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    want = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids + [2] for t in NASTY]
    assert [unpack(x) for x in tokenfile.Coder(path).encode(NASTY)] == want


def test_other_tokenizer_and_wide_end_id():
    own = tokenfile.Coder(public_tokenizers.path("byte_bpe_50k.json"), end=70_000)
    assert np.frombuffer(own.encode(["a"])[0], "<u4").tolist() == plain_ids("a")[:-1] + [70_000]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 40_000])
def test_perfect_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(-2 ** 63, 2 ** 63 - 1, n))
    slots = tokenfile.PerfectHash.build(keys.view(np.uint64)).slots(keys.view(np.uint64))
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_absent_keys_are_not_found():
    keys = list(range(0, 20_000, 2))
    raw = tokenfile.seal([b"\2\0"] * len(keys), keys, 2) + b"\n"
    seg = tokenfile.segments(raw)[0]
    assert (seg.find(np.array(keys)) == np.arange(len(keys))).all()
    assert (seg.find(np.arange(1, 20_000, 2)) == -1).all()


def write(spark, rows, **options):
    path = fresh_path(spark, "ids")
    tokenfile.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), path, TOKENIZER, **options)
    return path


@pytest.mark.parametrize("limit", [tokenfile.SEGMENT_BYTES, 40])
def test_shards_are_raw_ids_in_key_order(spark, limit):
    texts = dict(enumerate(NASTY))
    rows = [(k, t) for k, t in texts.items()]
    random.Random(1).shuffle(rows)
    path = write(spark, rows, limit=limit)
    want, start, flat = [], 0, []
    for k, t in sorted(rows):
        ids = plain_ids(t)
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        flat += ids
    got = tokenfile.read_digest(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want
    # the files hold them as they are, readable without this package's reader
    raw = []
    for f in sorted(glob.glob(path.removeprefix("file:") + "/part-*")):
        data = open(f, "rb").read()
        for s in tokenfile.segments(data):
            raw += np.frombuffer(data[s.start:s.start + 2 * len(s.ids)], "<u2").tolist()
    assert raw == flat


def test_keyed_access(spark):
    rows = [(k, f"text {k} of many") for k in range(0, 900, 3)] + [(None, "no key"), (30, "twice"), (30, "twice")]
    path = write(spark, rows, limit=300)
    asked = spark.createDataFrame([(k,) for k in (0, 3, 4, 30, 30, 897, 5000, -1, None)], "doc_id long")
    got = sorted((r["doc_id"], r["ids"]) for r in tokenfile.lookup(spark, path, asked).collect())
    want = sorted((k, plain_ids(t)) for k, t in rows if k in (0, 3, 30, 897))
    assert got == want


def test_ids_of_odd_tables(spark):
    rows = [(None, "b"), (None, None), (7, "x"), (7, "x"), (7, "y"), (-3, ""), (2 ** 62, "z" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS start", "3 AS ids_crc32")
    got = tokenfile.token_ids(df, TOKENIZER).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, -3, 7, 7, 7, 2 ** 62]
    sizes = [r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [sum(sizes[:i]) for i in range(len(sizes))]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == sorted((k or 0, len(plain_ids(t))) for k, t in rows)
    assert tokenfile.token_ids(df.limit(0), TOKENIZER).collect() == []


def test_query_token_ids(spark):
    got = {r["doc_id"]: r for r in registry.QUERIES["op12_token_ids"](spark, SF).collect()}
    start = 0
    docs = sorted(pq.read_table(f"{SF}/documents.parquet").select(["doc_id", "text"]).to_pylist(), key=lambda r: r["doc_id"])
    assert len(got) == len(docs)
    for d in docs:
        ids, r = plain_ids(d["text"]), got[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# --- hard negatives -----------------------------------------------------------

def plain_negatives(rows, every=100, k=5, m=5):
    use = []
    for i, v, l in rows:
        if i is None or v is None or l is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((i, (l + 1) % 10 if i % 7 == 0 else l, [int(np.floor(256.0 * float(x))) for x in v]))
    out = []
    for i, l, v in use:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, lab) for j, lab, w in use if j != i)
        for s, j, _ in [x for x in scored if x[2] == l][:k]:
            hits = [x for x in scored if x[2] != l and 80 * -s <= 100 * -x[0] <= 100 * -s][:m]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(hits)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 AS a", "2 AS block", "3 AS `column`", "4 AS score")
    got = negatives.mine(df, **options).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(map(tuple, got.collect()))


def vectors(n, dim, labels, seed, integers=False):
    r = np.random.default_rng(seed)
    v = r.integers(-2, 3, (n, dim)).astype(np.float32) if integers else r.normal(size=(n, dim)).astype(np.float32)
    hot = r.random(n) < 0.4
    return [(i, v[i].tolist(), 1 if hot[i] else int(r.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"block": 64, "anchor_block": 2}, {"steps": ()}, {"steps": (99, 97, 90), "block": 100}])
@pytest.mark.parametrize("integers", [False, True])
def test_negatives_are_the_plain_ones(spark, options, integers):
    rows = vectors(600, 12, 4, 7, integers)
    assert mined(spark, rows, **options) == plain_negatives(rows) != []


def test_negatives_of_odd_rows(spark):
    rows = vectors(300, 8, 3, 5, True)
    rows += [(400, None, 1), (500, [float("nan")] * 8, 1), (600, [1.0, None], 1), (700, [1.0] * 8, None), (None, [1.0] * 8, 1),
             (800, [], 2), (900, [0.0] * 8, 1), (1000, [1.0, 2.0], 1), (1001, [1.0, 2.0], 1), (1002, [1.0, 2.0], 0),
             (1003, [float("inf")], 1)]
    rows += [(2000 + i, [1.0, 0.5], i % 2) for i in range(150)]                     # one large group of equal vectors
    assert mined(spark, rows, block=50) == plain_negatives(rows)
    assert mined(spark, []) == [] == mined(spark, [(1, [1.0], 1)]) == mined(spark, [(100, [1.0], 1)])


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = [(100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 2), (2, [1.0, 0.0], 2)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_large_components_stay_exact(spark):
    big = float(1 << 20)
    rows = [(100, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big, 0.9921875], 2), (3, [big, 1.0], 2), (4, [3e38, 1.0], 3)]
    got = mined(spark, rows[:4])
    assert got == plain_negatives(rows[:4]) and got[0][4] == (1 << 56) + 65536


def test_index_leaves_out_only_what_cannot_reach():
    r = np.random.default_rng(0)
    q, y = r.normal(size=(40, 24)), r.normal(size=(500, 24))
    exact = q @ y.T
    for quantile in (0.5, 0.9, 0.999):
        floor = np.quantile(exact, quantile, axis=1)
        index = negatives.Index(y, float((floor / np.linalg.norm(q, axis=1)).min()))
        a, b = index.pairs(q, floor, np.ones(exact.shape, bool))
        found = np.zeros(exact.shape, bool)
        found[a, b] = True
        assert found[exact >= floor[:, None]].all() and found.mean() < 1.05 - quantile + 0.35
        assert sum(len(rows) for _, _, rows, *_ in index.lists) <= 3 * 500
    assert sum((inside != 0).sum() for *_, inside, _, _ in index.lists) < 0.9 * y.size


def test_links_of_a_dense_group_are_read_once_not_once_a_round(spark, monkeypatch):
    from loadbay.llm import components as C
    rows = []

    def counted(df, key="cut"):
        out = cut(df, key)
        rows.append(out.count())
        return out
    cut = C.cut
    monkeypatch.setattr(C, "cut", counted)
    g = 150
    dense = [(i, j) for i in range(g) for j in range(i + 1, g)]
    chain = [(1000 + i, 1001 + i) for i in range(60)]
    tail = [(g - 1, 1060), (5, 5), (None, 3), (7, 6)]
    links = spark.createDataFrame(dense + chain + tail, "a long, b long")
    labels = {r.node: r.label for r in C.components(links).collect()}
    assert labels == {n: 0 for n in [*range(g), *range(1000, 1061)]}
    # links in both directions would be twice as many rows; nodes are g + 61
    assert sum(rows) < len(dense) + 20 * (g + 61)
