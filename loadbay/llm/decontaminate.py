"""Benchmark decontamination with an Aho-Corasick automaton over words.

Items and documents are normalised alike: A-Z lower-cased, cut into words. The patterns are
windows of ten item words (a shorter item is one window); the automaton's alphabet is the
items' words, so a match is always of whole words. One scan of a document finds every
occurrence of every window, and the words' places map it back to the original text, where the
operator reports it as character spans.

The items are the query set: they are read in blocks of bounded text (``BLOCK_BYTES``),
and each block's automaton is built once per Python worker. Results of several blocks are
merged per document.

Defined cases: null has no words; an item without words has no window; items that repeat count
once per item_id; rows without a doc_id are scanned like any other, rows that share a doc_id each
by its own text. An empty table on either side is fine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import tokens as T

WINDOW = 10
BLOCK_BYTES = 2 << 20
_built: dict[int, object] = {}


class Windows:
    """An automaton over the windows of items; its letters are the items' words, numbered."""

    def __init__(self, items: Iterable[tuple[int, str]], window: int = WINDOW):
        items = list(items)
        h, text, _, _ = T.words(*T.buffer(pa.array([t for _, t in items], pa.large_string())))
        self.words = np.unique(h)
        number = np.searchsorted(self.words, h) + 1
        bounds = np.searchsorted(text, np.arange(len(items) + 1))
        found: dict[tuple, tuple[int, set]] = {}
        for (item, _), lo, hi in zip(items, bounds[:-1], bounds[1:]):
            w = tuple(number[lo:hi].tolist())
            size = min(window, len(w))
            for i in range(len(w) - size + 1 if w else 0):
                found.setdefault(w[i:i + size], (size, set()))[1].add(item)
        self.shortest = min(map(len, found), default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, value in found.items():
            self.automaton.add_word(pattern, value)
        if found:
            self.automaton.make_automaton()

    def scan(self, h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, dict[int, set]]:
        """Which words are hit, and the items found by text. Only runs of item words that are
        long enough for a window are fed to the automaton."""
        hit = np.zeros(len(h) + 1, np.int64)
        items: dict[int, set] = {}
        if self.shortest and len(h):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            known = self.words[at] == h
            same = known[1:] & known[:-1] & (text[1:] == text[:-1])
            first = np.flatnonzero(known & np.r_[True, ~same])
            last = np.flatnonzero(known & np.r_[~same, True]) + 1
            long = last - first >= self.shortest
            for lo, hi in zip(first[long].tolist(), last[long].tolist()):
                for end, (size, ids) in self.automaton.iter(tuple((at[lo:hi] + 1).tolist())):
                    hit[lo + end + 1 - size] += 1
                    hit[lo + end + 1] -= 1
                    items.setdefault(int(text[lo]), set()).update(ids)
        return np.cumsum(hit[:-1]) > 0, items


SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _automaton(shared, window: int) -> Windows:
    """The automaton of a block of items, built once per Python worker."""
    key = id(shared.value)
    if key not in _built:
        _built.clear()
        _built[key] = (Windows(shared.value, window), shared.value)
    return _built[key][0]


def _scanner(shared, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _automaton(shared, window)
        for batch in T.slices(batches, "text"):
            data, off = T.buffer(batch.column("text"))
            h, text, begin, end = T.words(data, off)
            hit, found = windows.scan(h, text)
            n = batch.num_rows
            spans: list[list] = [[] for _ in range(n)]
            edges = np.r_[hit & np.r_[True, ~hit[:-1] | (text[1:] != text[:-1])], False] if len(hit) else hit
            stops = np.r_[hit & np.r_[~hit[1:] | (text[1:] != text[:-1]), True], False] if len(hit) else hit
            if hit.any():                                    # bytes to characters of the text
                heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                for a, b in zip(np.flatnonzero(edges), np.flatnonzero(stops)):
                    base = heads[off[text[a]]]
                    spans[text[a]].append({"begin": int(heads[begin[a]] - base), "end": int(heads[end[b]] - base)})
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("th"),
                pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                pa.array(np.bincount(text[hit], minlength=n).astype(np.int64)), pa.array(spans, SPANS),
                pa.array([sorted(found.get(i, ())) for i in range(n)], pa.list_(pa.int64()))],
                ["doc_id", "th", "n_words", "n_hit", "spans", "items"])
    return run


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and hit words of several blocks of items, per document."""
    for batch in batches:
        n_hit, merged = [], []
        for text, all_spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            out: list[list[int]] = []
            for s in sorted((s["begin"], s["end"]) for part in all_spans for s in part):
                if out and s[0] <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], s[1])
                else:
                    out.append(list(s))
            body = text.as_py() or ""
            n_hit.append(len(T.words(*T.buffer(pa.array([body[b:e] for b, e in out], pa.large_string())))[0]))
            merged.append([{"begin": b, "end": e} for b, e in out])
        keep = ["doc_id", "th", "n_words", "items"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in keep[:3]] + [
                pa.array(n_hit, pa.int64()),
                pa.array(merged, SPANS),
                batch.column("items")],
            [*keep[:3], "n_hit", "spans", "items"])


OUT = ("doc_id long, th long, n_words long, n_hit long,"
       " spans array<struct<begin: int, end: int>>, items array<long>")


def _blocks(items: DataFrame, block_bytes: int) -> list:
    """The items as broadcasts, each block's share bounded by block_bytes."""
    bench = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "item_id IS NOT NULL AND text IS NOT NULL")
    size = bench.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = 1 + size // block_bytes
    shares = [bench.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b) if n > 1 else bench for b in range(n)]
    sc = items.sparkSession.sparkContext
    return [sc.broadcast([(r.item_id, r.text) for r in share.toLocalIterator()]) for share in shares]


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, spans in the original text, items found."""
    return _found(docs, _blocks(items, block_bytes), window).drop("th")


def _found(docs: DataFrame, blocks: list, window: int) -> DataFrame:
    """``find_items`` with th, a hash of the text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("th"))
    parts = [rows.mapInArrow(_scanner(held, window), OUT) for held in blocks]
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    found = every.groupBy("doc_id", "th").agg(
        F.first("n_words").alias("n_words"), F.collect_list("spans").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = rows.alias("r").join(
        found.alias("f"), F.expr("r.doc_id <=> f.doc_id AND r.th <=> f.th")).selectExpr(
        "r.doc_id", "r.text", "r.th", "f.n_words", "f.spans", "f.items")
    return joined.mapInArrow(_merge, OUT)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: counts, item digest, verdict."""
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def _clean(shared, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _automaton(shared, window)
        for batch in T.slices(batches, "text"):
            h, text, _, _ = T.words(*T.buffer(batch.column("text")))
            hit, _ = windows.scan(h, text)
            clean = np.bincount(text[hit], minlength=batch.num_rows) == 0
            if clean.any():
                yield batch.filter(pa.array(clean))
    return run


def without_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the rows whose text holds a window of an item, with or without a doc_id; the
    texts stay where they are when the items are one block."""
    blocks = _blocks(items, block_bytes)
    if len(blocks) == 1:
        return docs.mapInArrow(_clean(blocks[0], window), docs.schema)
    hit = _found(docs, blocks, window).where("n_hit > 0").select(
        F.col("doc_id").alias("_hit"), F.col("th").alias("_th")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"])
                     & (F.xxhash64(docs["text"]) == hit["_th"]), "left_anti")


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
gram AS (
  SELECT row_no, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT row_no, gram.n, p, item_id FROM gram JOIN win ON gram.n = win.n AND gram.g = win.g),
hits AS (
  SELECT row_no, count(DISTINCT q) AS n_hit
  FROM (SELECT row_no, unnest(range(p, p + n)) AS q FROM occ) GROUP BY row_no),
names AS (
  SELECT row_no, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM (SELECT DISTINCT row_no, item_id FROM occ) GROUP BY row_no)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (row_no) LEFT JOIN names USING (row_no)
"""
