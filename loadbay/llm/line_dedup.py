"""Line de-duplication that returns bitmaps instead of text.

Every line long enough becomes a row (hash of its key, document, position). The rows are
range-partitioned by (hash, document) and sorted inside a partition by hash, then document
from the largest down, then position, so a reader streaming over a partition meets the
occurrence to keep first and all others after it. A hash that a large share of the documents
holds spans many partitions; only the first and last run of a partition can do so. Those
runs leave one summary row each (two per partition at most) and are settled from the
summaries. What leaves the operator is, per changed document, a compressed bitmap with one bit
per line.

Defined cases: a null or empty text is one empty line. Rows without a doc_id take no part
and keep their lines. Rows that share a doc_id are one document for counting; each keeps a
bitmap of its own text. An empty table gives no bitmap. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import tokens as T
from loadbay.session import cut

MIN_CHARS = 40
MIN_DOCS = 5
KEY_BYTES = 1 << 18        # of text whose lines are hashed at once: some 130 bytes of arrays for each
REWRITE_BYTES = 1 << 20    # of text that is a list of Python strings at once
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
ROW = "h1 long, h2 long, doc_id long, th long, pos int, n_lines int"
SETTLED = ROW + ", kind int, n_docs long, top long"
DROP, OPEN, SUMMARY = 1, 0, 2


def lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, position, first, end) of every line, stripped; a text of n breaks has n + 1."""
    breaks = np.flatnonzero(data == 10)
    text = np.r_[np.searchsorted(off, breaks, "right") - 1, np.arange(len(off) - 1)]
    begin, end = np.r_[breaks + 1, off[:-1]], None
    order = np.lexsort((begin, text))
    text, begin = text[order], begin[order]
    last = np.r_[text[1:] != text[:-1], True] if len(text) else np.zeros(0, bool)
    end = np.where(last, off[text + 1], np.r_[begin[1:] - 1, 0][:len(begin)])
    first_of = np.flatnonzero(np.r_[True, last[:-1]]) if len(text) else np.zeros(0, int)
    pos = np.arange(len(text)) - np.repeat(first_of, np.diff(np.r_[first_of, len(text)]))
    solid = np.flatnonzero(~BLANK[data])                  # strip: first and last solid byte
    a, b = np.searchsorted(solid, begin), np.searchsorted(solid, end) - 1
    some = b >= a
    first = np.where(some, solid[np.minimum(a, max(len(solid) - 1, 0))] if len(solid) else 0, begin)
    stop = np.where(some, (solid[np.maximum(b, 0)] if len(solid) else 0) + 1, first)
    return text, pos, first, stop


def _keys(min_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text", KEY_BYTES):
            data, off = T.buffer(batch.column("text"))
            text, pos, begin, end = lines(data, off)
            n_lines = np.bincount(text, minlength=batch.num_rows)
            heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]     # code points before a byte
            long = heads[end] - heads[begin] >= min_chars
            text, pos, begin, end = text[long], pos[long], begin[long], end[long]
            low = T.LOWER[data] + T.U(1)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            ths = batch.column("th").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                pa.array(T.span_hashes(low, begin, end).view(np.int64)),
                pa.array(T.span_hashes(low, begin, end, 0xC2B2AE3D27D4EB4F).view(np.int64)),
                pa.array(ids[text]), pa.array(ths[text]), pa.array(pos.astype(np.int32)),
                pa.array(n_lines[text].astype(np.int32))],
                ["h1", "h2", "doc_id", "th", "pos", "n_lines"])
    return run


class _Run:
    """One hash's rows as they stream by, largest document first."""

    def __init__(self, key, first: bool, min_docs: int):
        self.key, self.open, self.min_docs = key, first, min_docs
        self.docs, self.top, self.last, self.held = 0, None, None, []

    def feed(self, rows: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """rows: columns of ROW. Returns what can be settled already."""
        doc = rows[2]
        if self.top is None:
            self.top = int(doc[0])
        new = np.r_[doc[0] != self.last if self.docs else True, doc[1:] != doc[:-1]]
        self.docs, self.last = self.docs + int(new.sum()), int(doc[-1])
        if self.open:                                    # may have begun a partition earlier
            return [(rows, OPEN)]
        self.held.append(rows)
        return self.settle() if self.docs >= self.min_docs else []

    def settle(self) -> list[tuple[np.ndarray, int]]:
        out = [(r[:, r[2] != self.top], DROP) for r in self.held]
        self.held = []
        return out

    def close(self, edge: bool) -> tuple[list[tuple[np.ndarray, int]], bool]:
        """What is left, and whether other partitions need a summary."""
        if self.docs < self.min_docs and not self.open and not edge:
            self.held = []
        return [(r, OPEN) for r in self.held], self.open or edge


def _stream(min_docs: int):
    names = ["h1", "h2", "doc_id", "th", "pos", "n_lines", "kind", "n_docs", "top"]

    def pack(rows: np.ndarray, kind: int, n_docs=None, top=None) -> pa.RecordBatch:
        n = rows.shape[1]
        cols = [pa.array(c) for c in rows[:4]] + [pa.array(c.astype(np.int32)) for c in rows[4:6]]
        cols += [pa.array(np.full(n, kind, np.int32)), pa.array([n_docs] * n, pa.int64()),
                 pa.array([top] * n, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names)

    def summary(run: _Run) -> pa.RecordBatch:
        row = np.array([[run.key[0]], [run.key[1]], [run.top], [0], [0], [0]], np.int64)
        return pack(row, SUMMARY, run.docs, run.top)

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: _Run | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                             for i in range(6)])
            cuts = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
            bounds = np.r_[0, cuts, rows.shape[1]]
            begin = 0
            if run is not None and run.key == (rows[0, 0], rows[1, 0]):
                yield from (pack(*x) for x in run.feed(rows[:, :bounds[1]]) if x[0].size)
                if len(bounds) == 2:
                    continue
                begin = 1
            if run is not None:                          # the next hash has come
                rest, edge = run.close(edge=False)
                yield from (pack(*x) for x in rest if x[0].size)
                if edge:
                    yield summary(run)
            first = run is None
            if first:
                run = _Run((rows[0, 0], rows[1, 0]), True, min_docs)
                yield from (pack(*x) for x in run.feed(rows[:, :bounds[1]]) if x[0].size)
                if len(bounds) == 2:
                    continue
                yield summary(run)
                begin = 1
            # whole runs inside the batch: all but the last one
            if len(bounds) - 1 - begin > 1:
                part = rows[:, bounds[begin]:bounds[-2]]
                at = bounds[begin:-2] - bounds[begin]
                new = np.r_[True, (part[2, 1:] != part[2, :-1])]
                new[at] = True
                docs = np.add.reduceat(new.astype(np.int64), at)
                size = np.diff(np.r_[at, part.shape[1]])
                drop = np.repeat(docs >= min_docs, size) & (part[2] != np.repeat(part[2, at], size))
                if drop.any():
                    yield pack(part[:, drop], DROP)
            run = _Run((rows[0, -1], rows[1, -1]), False, min_docs)
            yield from (pack(*x) for x in run.feed(rows[:, bounds[-2]:]) if x[0].size)
        if run is not None:
            rest, _ = run.close(edge=True)
            yield from (pack(*x) for x in rest if x[0].size)
            yield summary(run)
    return stream


def _bitmap(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, gone = [], []
        for n, drop in zip(batch.column("n_lines").to_pylist(), batch.column("drop").to_pylist()):
            bits = np.ones(n, np.uint8)
            bits[drop] = 0
            gone.append(int(n - bits.sum()))
            maps.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("th"),
             batch.column("n_lines").cast(pa.int64()), pa.array(gone, pa.int64()),
             pa.array(maps, pa.binary())], ["doc_id", "th", "n_lines", "n_dropped", "keep"])


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, th (hash of the text), n_lines, n_dropped, keep (zlib of packed bits) for every
    text that loses a line."""
    rows = (docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
            .withColumn("th", F.xxhash64("text")))
    ranged = (rows.mapInArrow(_keys(min_chars), ROW)
              .repartitionByRange("h1", "h2", F.desc("doc_id"))
              .sortWithinPartitions("h1", "h2", F.desc("doc_id"), "th", "pos"))
    streamed = cut(ranged.mapInArrow(_stream(min_docs), SETTLED), "lines")
    # two summaries per range partition at most, whatever the input holds
    totals = (streamed.where(F.col("kind") == SUMMARY).groupBy("h1", "h2")
              .agg(F.sum("n_docs").alias("all_docs"), F.max("top").alias("keeper"))
              .where(F.col("all_docs") >= min_docs))
    settled = (streamed.where(F.col("kind") == OPEN).join(F.broadcast(totals), ["h1", "h2"])
               .where("doc_id < keeper"))
    drops = (streamed.where(F.col("kind") == DROP).select("doc_id", "th", "n_lines", "pos")
             .unionByName(settled.select("doc_id", "th", "n_lines", "pos")))
    # a document's own line positions: as many as the document has lines
    grouped = drops.groupBy("doc_id", "th", "n_lines").agg(F.collect_set("pos").alias("drop"))
    return grouped.mapInArrow(
        _bitmap, "doc_id long, th long, n_lines long, n_dropped long, keep binary")


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, name: str = "keep_map") -> DataFrame:
    """The rows of docs with a last column ``name``; null where every line stays."""
    b = bitmaps.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"),
                       F.col("keep").alias(name))
    return (docs.join(b, (docs["doc_id"] == b["_id"]) & (F.xxhash64(docs["text"]) == b["_th"]), "left")
            .select(docs["*"], b[name]))


def kept_text(text: str | None, keep: bytes | None) -> str:
    """The text with only the lines whose bit is set."""
    text = text or ""
    if keep is None:
        return text
    rows = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    return "\n".join(r for r, k in zip(rows, bits) if k)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, gone, sha = [], [], []
        for text, keep in zip(batch.column("text"), batch.column("keep_map")):
            text, keep = text.as_py() or "", keep.as_py()
            left = kept_text(text, keep)
            n.append(text.count("\n") + 1)
            sha.append(hashlib.sha256(left.encode()).hexdigest())
            if keep is None:
                gone.append(0)
            else:
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n[-1]]
                gone.append(int(n[-1] - bits.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(sha, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row of docs: doc_id, n_lines, n_dropped, kept_sha256."""
    joined = with_bitmaps(docs.select("doc_id", "text"), line_bitmaps(docs, min_chars, min_docs))
    return joined.mapInArrow(
        _digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def _rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches, "text", REWRITE_BYTES):
        names = batch.schema.names[:-1]                  # the last column is the map
        at, keep = names.index("text"), batch.column(len(names))
        out = [None if t is None else kept_text(t, k)
               for t, k in zip(batch.column(at).to_pylist(), keep.to_pylist())]
        columns = batch.columns[:-1]
        columns[at] = pa.array(out, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names)


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the repeated lines gone from text; every row and column stays."""
    fresh = f"keep_{uuid.uuid4().hex}"                   # docs may have any names
    joined = with_bitmaps(docs, line_bitmaps(docs, min_chars, min_docs), fresh)
    return joined.mapInArrow(_rewrite, docs.schema)


SQL = """
WITH lines AS (
  SELECT d.doc_id, d.row_no, u.pos, string_split(coalesce(d.text, ''), chr(10))[u.pos] AS line
  FROM (SELECT doc_id, text, row_number() OVER () AS row_no FROM documents) d,
       LATERAL (SELECT unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) AS pos) u),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[ \\x09-\\x0D]+|[ \\x09-\\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, common.k IS NOT NULL AND doc_id < keeper AS gone
  FROM keyed LEFT JOIN common ON keyed.k = common.k)
SELECT doc_id, count(*) AS n_lines, sum(CAST(gone AS INT))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row_no
"""
