"""Token ids in binary shards with a keyed index over them.

Documents are range-partitioned by doc_id and sorted; every task encodes its own stretch and writes one
shard file through Spark's committed file output, so a retried or lost task leaves nothing behind. A
shard is a row of segments, each holding

    ids      one document's ids after the other, each ended by the end id, little-endian, 2 bytes an id
             where the vocabulary fits, else 4
    keys     doc_id of every document, int64
    ends     ids in the segment up to and with each document, uint32
    hash     the bits of a minimal perfect hash function over the distinct keys
    marks    a 32-bit fingerprint of the key in every slot of that function, uint32
    docs     the first document of the key in every slot, uint32
    trailer  sizes of all parts, fixed length

and one line feed. The function maps n keys onto 0..n-1 without storing them: level by level, keys that fall
on a bit of their own take it, the others go on to the next, smaller level; a key's slot is the number
of bits set before its own. Keyed access is therefore a few bit probes, one fingerprint, one offset.

Encoding cuts a text before each space that a visible character follows; the pattern of byte-level
tokenizers always splits there, so a batch of texts encodes each piece once and lays the ids out by number. Pieces
found more than once in a batch are kept for later ones, as many as ``KEPT``; others are encoded again. A new piece
that is a word of Latin letters, perhaps with marks after it, goes to the tokenizer's model at once, without the pattern. The ids equal those of the whole text
(tested). Tokenizers of another kind encode whole texts.

Defined cases: a null or empty text is the end id alone; rows without a doc_id come first, have no key, and are
reached by position only; rows that share a doc_id are written next to each other by a hash of their text and
then by the text, and the key leads to all of them; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import array
import json
import os
import re
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadbay.llm import tokens as T
from loadbay.session import cut, fresh_path

END = 2
SEGMENT_BYTES = 4 << 20    # ids of a segment, or one document
BATCH_BYTES = 4 << 20      # of text encoded at once, or one document
KEPT = 300_000             # encoded pieces a worker keeps; decides speed only
GAMMA = 2.0                # bits a key at each level of the hash function
MAGIC = b"LBIDSEG1"
TRAILER = struct.Struct("<8sIIIIQQQ")      # magic, width, documents without key, documents, keys, levels, hash words, ids
DIGEST = "part long, segment int, doc int, doc_id long, first long, n_tokens long, ids_crc32 long"
U = np.uint64

# --- encoding -----------------------------------------------------------------

# What may be white space to the tokenizer is not a place to cut before; longer pieces are always right.
_DARK = r"\s᠎​﻿"
_RUN = re.compile(f" (?![^{_DARK}])")
_CUT = re.compile(f" (?=[^{_DARK}])")
_LATIN = "^[A-Za-zªµºÀ-ÖØ-öø-\u024f]+$"          # the letters below U+0250
_MARKS = ".,;:!?%&#*()[]{}+=-_/\\|~$@^\""       # no apostrophe, which may begin a word's ending; no <, >
# the letters that stand for bytes in a byte-level vocabulary: those that print stand for themselves
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {**{b: b for b in _PRINTED}, **{b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}}
_SHOWN = {b: c for b, c in _LETTERS.items() if b != 10}     # of words, one a line
_coders: dict[tuple, Coder] = {}


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


class Coder:
    """Encodes texts with a tokenizer file of the tokenizers library."""

    def __init__(self, path: str, end: int = END):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else 4
        self.kind = {2: "H", 4: "I"}[self.width]
        self.end = self.pack([end])
        about = json.loads(self.tokenizer.to_str())
        split = about["pre_tokenizer"] or {}
        self.cuts = (about["model"]["type"] == "BPE" and about["normalizer"] is None and split.get("type") == "ByteLevel"
                     and split.get("use_regex", True) and not split.get("add_prefix_space"))
        self.model = self.tokenizer.model
        self.marks: dict[str, bytes] = {}           # runs of marks after a word
        self.inner: dict[str, bytes] = {}           # pieces after a space, found more than once in a batch

    def pack(self, ids: list[int]) -> bytes:
        out = array.array(self.kind, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters, each with a space before it."""
        ids: list[int] = []
        at = [0]
        shown = "\n ".join(["", *words]).encode().decode("latin-1").translate(_SHOWN).split("\n")[1:]
        for tokens in map(self.model.tokenize, shown):
            ids += [t.id for t in tokens]
            at.append(len(ids) * self.width)
        raw = self.pack(ids)
        return [raw[x:y] for x, y in pairwise(at)]

    def _plain(self, pieces: list[str]) -> list[bytes]:
        return [self.pack(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _inner(self, names: list[str], latin: np.ndarray, times: np.ndarray) -> list[bytes]:
        """Ids of pieces that stand ``times`` times in a batch, each with a space before it."""
        found = list(map(self.inner.get, names))
        lacking = np.flatnonzero((times > 0) & np.fromiter((x is None for x in found), bool, len(found)))
        for kind, coded in ((True, self._words), (False, lambda pieces: self._plain([" " + p for p in pieces]))):
            own = lacking[latin[lacking] == kind].tolist()
            for n, ids in zip(own, coded([names[n] for n in own])):
                found[n] = ids
        often = lacking[times[lacking] > 1][:max(0, KEPT - len(self.inner))].tolist()
        self.inner.update((names[n], found[n]) for n in often)
        return [x or b"" for x in found]

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of every text with the end id, packed."""
        column = pc.fill_null((texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string()), "")
        texts = _strings(column)
        if not texts or not self.cuts:
            return [ids + self.end for ids in self._plain(texts)]
        if len(self.marks) > KEPT:
            self.marks.clear()
        if any(map(_RUN.search, texts)):
            cuts = pa.array(map(_CUT.split, texts), pa.list_(pa.large_string()))
        else:
            cuts = pc.split_pattern(column, " ")
        ends = cuts.offsets.to_numpy().astype(np.int64)
        first = ends[:-1]
        pieces = cuts.flatten()
        heads = self._plain(_strings(pieces.take(pa.array(first))))
        # each distinct piece as a word and the marks after it, or as a whole with no marks
        pieces = pieces.dictionary_encode()
        at, whole = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary
        words = pc.utf8_rtrim(whole, _MARKS)
        latin = pc.match_substring_regex(words, _LATIN)
        words = pc.if_else(latin, words, whole).dictionary_encode()
        word = words.indices.to_numpy().astype(np.int64)
        marks = (pc.binary_length(whole).to_numpy() - pc.binary_length(words.dictionary).to_numpy()[word])
        marked = np.flatnonzero(marks)
        runs = [p[-n:] for p, n in zip(_strings(whole.take(pa.array(marked))), marks[marked].tolist())]
        number = {run: n for n, run in enumerate(dict.fromkeys(runs), 1)}
        tail = np.zeros(len(whole), np.int64)
        tail[marked] = [number[run] for run in runs]
        lacking = [run for run in number if run not in self.marks]
        self.marks.update(zip(lacking, self._plain(lacking)))
        inside = np.ones(len(at), bool)
        inside[first] = False
        kinds = np.zeros(len(words.dictionary), bool)
        kinds[word] = latin.to_numpy(zero_copy_only=False)
        coded = [*self._inner(_strings(words.dictionary), kinds, np.bincount(word[at[inside]], minlength=len(kinds))),
                 b"", *map(self.marks.get, number), *heads, self.end]
        # two of these for each piece, one for each end, in the order of the texts
        use = np.stack([word[at], len(kinds) + tail[at]], axis=1)
        use[first] = np.c_[len(kinds) + 1 + len(number) + np.arange(len(texts)), np.full(len(texts), len(kinds))]
        use = np.insert(use.ravel(), 2 * ends[1:], len(coded) - 1)
        packed = pa.array(coded, pa.large_binary()).take(pa.array(use))
        _, stops, data = packed.buffers()
        stops = np.frombuffer(stops, np.int64, len(packed) + 1, packed.offset * 8)[2 * ends + np.arange(len(ends))]
        raw = data.to_pybytes()
        return [raw[x:y] for x, y in pairwise(stops.tolist())]


def coder(path: str, end: int = END) -> Coder:
    if (path, end) not in _coders:
        _coders[path, end] = Coder(path, end)
    return _coders[path, end]


# --- the minimal perfect hash function ----------------------------------------

def _spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (T.mix(keys + T.mix(np.array([level + 1], np.uint64))) % U(size)).astype(np.int64)


def marks(keys: np.ndarray) -> np.ndarray:
    return (T.mix(keys ^ U(0x6A09E667F3BCC909)) >> U(32)).astype(np.uint32)


class PerfectHash:
    """Maps the distinct 64-bit keys it was built from onto 0..n-1."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.n = int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], keys.astype(np.uint64)
        while len(left):
            size = -(-max(64, int(GAMMA * len(left))) // 64) * 64
            spot = _spot(left, len(sizes), size)
            own = np.bincount(spot, minlength=size) == 1
            sizes.append(size)
            bits.append(own)
            left = left[~own[spot]]
        packed = np.packbits(np.concatenate(bits), bitorder="little") if bits else np.zeros(0, np.uint8)
        return cls(sizes, packed.view("<u8").astype(np.uint64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key; -1 or any slot for keys it was not built from."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            spot = _spot(keys[todo], level, size) + base
            word, bit = self.words[spot >> 6], (spot & 63).astype(np.uint64)
            hit = ((word >> bit) & U(1)).astype(bool)
            below = np.bitwise_count(word & ((U(1) << bit) - U(1))).astype(np.int64)
            out[todo[hit]] = (self.before[spot >> 6] + below)[hit]
            todo, base = todo[~hit], base + size
        return out


# --- segments -----------------------------------------------------------------

def seal(ids: list[bytes], keys: list[int | None], width: int) -> bytes:
    """One segment of documents in ascending key order, those without key first."""
    no_key = sum(k is None for k in keys)
    own = np.array(keys[no_key:], np.int64)
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    distinct = own[first].view(np.uint64)
    function = PerfectHash.build(distinct)
    slot = function.slots(distinct)
    mark, doc = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    mark[slot], doc[slot] = marks(distinct), first + no_key
    ends = np.cumsum([len(x) // width for x in ids]).astype("<u4")
    parts = [*ids, np.r_[np.zeros(no_key, np.int64), own].astype("<i8").tobytes(), ends.tobytes(),
             np.array(function.sizes, "<u8").tobytes(), function.words.astype("<u8").tobytes(), mark.tobytes(),
             doc.tobytes(), TRAILER.pack(MAGIC, width, no_key, len(keys), len(distinct), len(function.sizes),
                                         len(function.words), int(ends[-1]) if len(ends) else 0)]
    return b"".join(parts)


class Segment:
    """Keyed access to a sealed segment that ends at byte ``stop`` of ``data``."""

    def __init__(self, data, stop: int):
        magic, self.width, self.no_key, self.n, n_keys, levels, words, n_ids = TRAILER.unpack_from(
            data, stop - TRAILER.size)
        if magic != MAGIC:
            raise ValueError("not a token id segment")
        at = stop - TRAILER.size - (8 * self.n + 4 * self.n + 8 * levels + 8 * words + 8 * n_keys)
        self.start = at - n_ids * self.width

        def take(kind, count):
            nonlocal at
            got = np.frombuffer(data, kind, count, at)
            at += got.nbytes
            return got
        self.ids = np.frombuffer(data, f"<u{self.width}", n_ids, self.start)
        self.keys, self.ends = take("<i8", self.n), take("<u4", self.n).astype(np.int64)
        sizes = take("<u8", levels).tolist()
        self.function = PerfectHash(sizes, take("<u8", words).astype(np.uint64))
        self.mark, self.doc = take("<u4", n_keys), take("<u4", n_keys).astype(np.int64)
        self.begins = np.r_[0, self.ends[:-1]] if self.n else self.ends

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First document of every key, -1 where the segment has none."""
        keys = np.asarray(keys, np.int64).view(np.uint64)
        slot = self.function.slots(keys)
        if not len(self.mark):
            return slot
        good = (slot >= 0) & (self.mark[slot] == marks(keys))
        return np.where(good, self.doc[slot], -1)


def segments(data) -> list[Segment]:
    """All segments of a shard, in order."""
    out, stop = [], len(data)
    while stop > 0:
        out.append(Segment(data, stop - 1))
        stop = out[-1].start
    return out[::-1]


def _pack(path: str, end: int, limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_path = coder(path, end)
        ids, keys, size = [], [], 0
        for batch in T.slices(batches, "text", BATCH_BYTES):
            new = with_path.encode(batch.column("text"))
            for key, doc in zip(batch.column("doc_id").to_pylist(), new):
                if size and size + len(doc) > limit:
                    yield pa.RecordBatch.from_arrays([pa.array([seal(ids, keys, with_path.width)], pa.binary())], ["s"])
                    ids, keys, size = [], [], 0
                ids.append(doc)
                keys.append(key)
                size += len(doc)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([seal(ids, keys, with_path.width)], pa.binary())], ["s"])
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int = END, limit: int = SEGMENT_BYTES) -> None:
    """Write the shards of docs (doc_id, text) into the folder ``path``."""
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("_h", F.xxhash64("text"))
               .repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h"))
    # the text writer puts a row's bytes down as they are, and one line feed
    (ordered.mapInArrow(_pack(tokenizer, end, limit), "s binary").select(F.col("s").cast("string"))
     .write.option("maxRecordsPerFile", 0).text(path))


def shards(spark: SparkSession, path: str) -> DataFrame:
    """part (number of the shard in key order), content."""
    number = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^part-(\d+)", 1).cast("long")
    return spark.read.format("binaryFile").load(path).select(number.alias("part"), "content")


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of the shards, found through its key."""
    for batch in batches:
        for part, content in zip(batch.column("part").to_pylist(), batch.column("content")):
            before = 0
            for number, seg in enumerate(segments(content.as_buffer()) if content.is_valid else []):
                own = seg.keys[seg.no_key:]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
                nth = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
                found = seg.find(own)
                if (found < 0).any():
                    raise ValueError(f"shard {part}: a document is not in the index")
                doc = np.r_[np.arange(seg.no_key), found + nth]
                begin, end = seg.begins[doc], seg.ends[doc]
                raw = memoryview(seg.ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), end.tolist())]
                no_key = np.arange(seg.n) < seg.no_key
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(seg.n, part, np.int64)), pa.array(np.full(seg.n, number, np.int32)),
                    pa.array(doc.astype(np.int32)), pa.array(seg.keys, mask=no_key), pa.array(before + begin),
                    pa.array(end - begin), pa.array(crc, pa.int64())],
                    ["part", "segment", "doc", "doc_id", "first", "n_tokens", "ids_crc32"])
                before += len(seg.ids)


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards at ``path``."""
    docs = cut(shards(spark, path).mapInArrow(_digest, DIGEST), "ids")
    # one row per shard
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (docs.groupBy("part").agg(F.sum("n_tokens").alias("size"))
               .select(F.col("part").alias("_part"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")))
    return (docs.join(offsets, F.col("part") == F.col("_part"))
            .select("doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id, ids: the ids (with the end id) of each document whose key is in ``keys`` (doc_id); repeated
    keys are asked for once, absent ones give no row. Keys are routed by the shards' key ranges, of which the
    driver holds two numbers a shard; only shards that are asked anything meet their keys."""
    ranges = shards(spark, path).mapInArrow(_range, "part long, low long, high long").collect()
    ranges = sorted((r["part"], r["low"], r["high"]) for r in ranges)
    part, low, high = (np.array(x, np.int64) for x in zip(*ranges)) if ranges else [np.zeros(0, np.int64)] * 3

    def route(batches):
        for batch in batches:
            key = batch.column("doc_id").to_numpy()
            a, b = np.searchsorted(high, key, "left"), np.searchsorted(low, key, "right")
            n = np.maximum(b - a, 0)
            at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array(part[at]), pa.array(np.repeat(key, n))], ["part", "doc_id"])

    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    return (shards(spark, path).groupBy("part")
            .cogroup(asked.mapInArrow(route, "part long, doc_id long").groupBy("part"))
            .applyInArrow(_fetch, "doc_id long, ids array<long>"))


def _range(batches):
    for batch in batches:
        for part, content in zip(batch.column("part").to_pylist(), batch.column("content")):
            own = [s.keys[s.no_key:] for s in segments(content.as_buffer())]
            own = [k for k in own if len(k)]
            if own:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.int64()) for x in (part, own[0][0], own[-1][-1])], ["part", "low", "high"])


def _fetch(shard: pa.Table, asked: pa.Table) -> pa.Table:
    out = []
    key = asked.column("doc_id").to_numpy() if asked.num_rows else np.zeros(0, np.int64)
    for content in shard.column("content") if len(key) else []:
        for seg in segments(content.as_buffer()):
            for k, doc in zip(key.tolist(), seg.find(key).tolist()):
                while 0 <= doc < seg.n and seg.keys[doc] == k:
                    out.append((k, seg.ids[seg.begins[doc]:seg.ends[doc]].tolist()))
                    doc += 1
    return pa.table({"doc_id": pa.array([k for k, _ in out], pa.int64()),
                     "ids": pa.array([x for _, x in out], pa.list_(pa.int64()))})


def token_ids(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from shards written into the shared folder."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token_ids")
    write_ids(docs, path, tokenizer, end)
    return read_digest(spark, path)
