"""Near-duplicate classes by BagMinHash signatures over word shingles with multiplicities.

A text is the multiset of its five-word shingles. Each shingle owns Poisson processes of
points (time, component, level) on the weight axis, discretised to integers and arranged in
dyadic blocks (0,1], (1,2], (2,4], (4,8] ...: a block's rate is its width, so a shingle of
weight w starts about log2(w) processes and not w. A point counts when its level is at most
the weight. A component's signature is its earliest counted point; two texts share it with
probability equal to their weighted Jaccard similarity. All shingles of a slice of texts draw
their first points together, then only those whose next point could still beat the latest
component of their text, until none can.

Texts with equal words are one node (copies never meet in pairs). Nodes that share a band meet
in that band's bucket: every member is checked against the bucket's least member, never all
against all. Only buckets whose members are then still in different classes are settled
exactly, in blocks of bounded size and with regard to the classes known so far (see ``block_links``).
A link is an exact multiset overlap, sum of minima over sum of maxima, at or above the threshold.

Defined cases: texts of fewer than five words are one shingle; texts without words (null and
empty ones too) are classes of their own; rows without a doc_id come back with a null class;
rows that share a doc_id are one document. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadbay.llm import tokens as T
from loadbay.llm.components import components
from loadbay.session import cut

WORDS = 5
SIMILARITY = 0.8
COMPONENTS = 96
ROWS = 4                       # components in a band
BLOCK = 1024                   # texts in a block of the exact comparison, at most about ...
BLOCK_BYTES = 1 << 20          # ... and about so many bytes of text
U = np.uint64


def _draw(x: np.ndarray, block: np.ndarray, k: np.ndarray) -> np.ndarray:
    return T.mix(x + T.mix((block.astype(np.uint64) << U(32)) + k.astype(np.uint64) + U(1)))


def signatures(text: np.ndarray, item: np.ndarray, weight: np.ndarray, n: int,
               size: int = COMPONENTS) -> np.ndarray:
    """n x size matrix of the earliest points' times; inf where a text has no shingle."""
    best = np.full((n, size), np.inf)
    if not len(text):
        return best
    # one process per dyadic block that begins below the weight
    blocks = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    row = np.repeat(np.arange(len(text)), blocks)
    block = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    text, item, weight = text[row], item[row], weight[row]
    width = np.where(block < 2, 1, 1 << np.maximum(block - 1, 0))
    below = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    clock = np.zeros(len(row))
    k = 0
    flat = best.reshape(-1)
    while len(text):
        r = _draw(item, block, np.full(len(item), k))
        u = ((r >> U(16)).astype(np.float64) + 1.0) * 2.0 ** -48
        clock = clock - np.log(u) / width
        place = text * size + ((r & U(0xFFFF)) * U(size) >> U(16)).astype(np.int64)
        counts = np.ones(len(text), bool)
        wide = below + width > weight              # the weight ends inside the block: thin
        if wide.any():
            level = (T.mix(r[wide] ^ U(0xA5A5A5A5A5A5A5A5)) % width[wide].astype(np.uint64)).astype(np.int64)
            counts[wide] = below[wide] + level + 1 <= weight[wide]
        np.minimum.at(flat, place[counts], clock[counts])
        alive = clock < best.max(axis=1)[text]
        text, item, weight, block = text[alive], item[alive], weight[alive], block[alive]
        width, below, clock = width[alive], below[alive], clock[alive]
        k += 1
    return best


def bags(batch: pa.RecordBatch, column: str, k: int = WORDS):
    """(text index, shingle, count) of a batch, and per text two hashes of its word sequence."""
    h, text, _, _ = T.words(*T.buffer(batch.column(column)))
    at, s = T.shingles(h, text, k)
    ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
    whole = [T.span_hashes(h, ends[:-1], ends[1:], base) for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
    return T.counted(text[at], s), whole, ends[1:] > ends[:-1]


def _sign(size: int, rows: int, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text"):
            n = batch.num_rows
            (text, item, weight), whole, some = bags(batch, "text", k)
            sig = T.mix(signatures(text, item, weight, n, size).view(np.uint64))
            band = np.zeros((n, size // rows), np.uint64)
            for j in range(rows):
                band = T.mix(band + sig[:, j::rows][:, :size // rows])
            band = T.mix(band + np.arange(size // rows, dtype=np.uint64)).view(np.int64)
            ends = np.arange(n + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(whole[0].view(np.int64)),
                pa.array(whole[1].view(np.int64)), pa.array(some),
                pa.array(np.bincount(text, weight, n).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends * (size // rows)), pa.array(band.reshape(-1)))],
                ["doc_id", "k1", "k2", "some", "size", "bands"])
    return run


def overlap(batches: Iterable[pa.RecordBatch], k: int = WORDS) -> Iterator[pa.RecordBatch]:
    """a, b, similarity from text_a and text_b."""
    for batch in T.slices(T.slices(batches, "text_a"), "text_b"):
        n = batch.num_rows
        (ta, sa, wa), _, _ = bags(batch, "text_a", k)
        (tb, sb, wb), _, _ = bags(batch, "text_b", k)
        t, s, w = np.r_[ta, tb], np.r_[sa, sb], np.r_[wa, wb].astype(np.float64)
        order = np.lexsort((s, t))
        t, s, w = t[order], s[order], w[order]
        twin = np.flatnonzero((t[1:] == t[:-1]) & (s[1:] == s[:-1]))
        low = np.bincount(t[twin], np.minimum(w[twin], w[twin + 1]), n)
        total = np.bincount(t, w, n)
        sim = np.where(total > low, low / np.maximum(total - low, 1e-300), 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(sim)], ["a", "b", "sim"])


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, k: int = WORDS) -> DataFrame:
    """(a, b, sim) of the pairs at or above the threshold. Neither side is assumed small or even:
    both joins are between two exchanges, so a text with very many partners is split."""
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        return overlap(batches, k)
    return joined.mapInArrow(run, "a long, b long, sim double").where(F.col("sim") >= threshold)


def near_classes(docs: DataFrame, threshold: float = SIMILARITY, k: int = WORDS,
                 size: int = COMPONENTS, rows: int = ROWS) -> DataFrame:
    """One row per row of docs: doc_id, class_id (least doc_id of its class), copy_of (least
    doc_id with the same words)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut(base.mapInArrow(
        _sign(size, rows, k), "doc_id long, k1 long, k2 long, some boolean, size long, bands array<long>"),
        "signed")
    usable = signed.where("some AND doc_id IS NOT NULL")
    nodes = cut(usable.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.min("size").alias("size"), F.min("bands").alias("bands")), "nodes")
    members = cut(nodes.select("rep", F.explode("bands").alias("band")), "bands")
    heads = cut(members.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("n"))
                .where("n > 1").drop("n"), "heads")
    shared = cut(members.join(heads, "band"), "shared")
    first = cut(shared.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b"))
                .distinct(), "pairs")
    near = shared.select("rep").distinct()
    texts = cut(base.join(near, base["doc_id"] == near["rep"], "left_semi"), "texts")
    links = cut(verified(first, texts, threshold, k), "links")
    labels = components(links)
    # buckets whose members the stars left in different classes are settled exactly
    split = cut(shared.join(labels, shared["rep"] == labels["node"], "left").select(
        "band", "head", "rep", F.coalesce("label", "rep").alias("label")), "split")
    open_ = (split.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where("lo <> hi").select("band"))
    rest = cut(split.join(open_, "band", "left_semi").select("rep", "head", "label").distinct(), "rest")
    sizes = nodes.select(F.col("rep").alias("doc_id"), "size")
    links = block_links(rest, texts.join(sizes, "doc_id"), links.select("a", "b"), threshold, k)
    labels = components(links)
    classed = (nodes.select("k1", "k2", "rep")
               .join(labels, F.col("rep") == labels["node"], "left").drop("node")
               .select("k1", "k2", "rep", F.coalesce("label", "rep").alias("label")))
    return (signed.select("doc_id", "k1", "k2", "some")
            .join(classed, ["k1", "k2"], "left")
            .select("doc_id",
                    F.when(F.expr("doc_id IS NULL"), None).when(F.col("some"), F.col("label"))
                    .otherwise(F.col("doc_id")).alias("class_id"),
                    F.when(F.expr("doc_id IS NULL"), None).when(F.col("some"), F.col("rep"))
                    .otherwise(F.col("doc_id")).alias("copy_of")))


def block_links(rest: DataFrame, texts: DataFrame, links: DataFrame, threshold: float, k: int = WORDS,
                block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``links`` (a, b) and what else joins classes among texts whose buckets touch.

    rest: rep, head, label (class by ``links``); texts: doc_id, text, size (shingles with multiplicity).
    Texts connected through buckets form a knot. Sizes of near copies differ by less than the threshold allows,
    so a knot is first dealt into steps of that ratio, where only neighbours can hold links, and a step into
    blocks of bounded size. First every block is settled in itself. Then come rounds: neighbouring blocks in
    pairs, pairs of pairs, and so on; after each round classes are joined anew, and two blocks meet only if they
    hold more than one class between them. A task computes all overlaps as matrix products and returns one
    link for two classes it joins, as few as join them all, none inside a class. So links stay about as many
    as texts. The work for texts that share buckets without being near copies stays quadratic inside a step
    and its neighbour (in matrix products, not in rows).
    """
    rest = cut(rest, "rest")
    knots = cut(components(rest.select(F.col("rep").alias("a"), F.col("head").alias("b"))), "knots")
    label = rest.select(F.col("rep").alias("node"), "label").distinct()
    unit = max(-math.log(threshold), 1e-6) * (1 + 1e-9)
    members = cut(
        knots.withColumnRenamed("label", "knot").join(label, "node")
        .join(texts.select(F.col("doc_id").alias("node"), "size", F.octet_length("text").alias("bytes")), "node")
        .withColumn("step", F.floor(F.log("size") / unit).cast("long")), "members")
    deal = cut(members.groupBy("knot", "step").agg(F.greatest(
        F.ceil(F.count("*") / block), F.ceil(F.sum("bytes") / block_bytes)).cast("long").alias("n_blocks")), "deal")
    # blocks of a knot, numbered from its smallest texts up
    before = Window.partitionBy("knot").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    deal = deal.withColumn("first", F.coalesce(F.sum("n_blocks").over(before), F.lit(0)))
    dealt = cut(members.join(deal, ["knot", "step"]).select(
        "node", "knot", "step", "label", (F.col("first") + F.pmod(F.xxhash64("node"), "n_blocks")).alias("block")), "dealt")
    body = texts.select(F.col("doc_id").alias("_node"), "text")

    def with_text(df):
        return df.join(body, F.col("node") == F.col("_node")).drop("_node")

    def settle(found, dealt):
        """Links with their classes to links and classes of all."""
        merged = components(found.select(F.col("la").alias("a"), F.col("lb").alias("b")))
        merged = merged.select(F.col("node").alias("_label"), F.col("label").alias("_to"))
        return cut(dealt.join(merged, F.col("label") == F.col("_label"), "left").select(
            "node", "knot", "step", "block", F.coalesce("_to", "label").alias("label")), "dealt")

    found = cut(with_text(dealt).groupBy("knot", "block").applyInPandas(
        lambda pdf: _joined(pdf, None, threshold, k), LINK), "found")
    links, dealt = [links.select("a", "b"), found.select("a", "b")], settle(found, dealt)
    most = dealt.agg(F.max("block")).first()[0] or 0
    for level in range(int(most).bit_length()):
        blocks = cut(dealt.groupBy("knot", "step", "block").agg(
            F.min("label").alias("low"), F.max("label").alias("high")), "blocks")
        other = blocks.select("knot", F.col("step").alias("step_b"), F.col("block").alias("block_b"),
                              F.col("low").alias("low_b"), F.col("high").alias("high_b"))
        near = blocks.withColumn("step_b", F.explode(F.array(F.col("step"), F.col("step") + 1)))
        one, two = F.shiftright("block", level), F.shiftright("block_b", level)
        pairs = cut(near.join(other, ["knot", "step_b"])
                    .where((F.col("block") < F.col("block_b")) & (one != two) & (F.shiftright(one, 1) == F.shiftright(two, 1)))
                    .where(F.least("low", "low_b") < F.greatest("high", "high_b"))
                    .select("knot", "block", "block_b"), "pairs")
        sides = pairs.select("*", F.lit(0).alias("side"), F.col("block").alias("mine")).unionByName(
            pairs.select("*", F.lit(1).alias("side"), F.col("block_b").alias("mine")))
        rows = with_text(dealt.select("knot", F.col("block").alias("mine"), "node", "label")
                         .join(sides, ["knot", "mine"]).select("knot", "block", "block_b", "side", "node", "label"))
        found = cut(rows.groupBy("knot", "block", "block_b").applyInPandas(
            lambda pdf: _joined(pdf, pdf["side"].to_numpy(), threshold, k), LINK), "found")
        if not found.isEmpty():
            links.append(found.select("a", "b"))
            dealt = settle(found, dealt)
    return cut(reduce(DataFrame.unionByName, links), "links")


LINK = "a long, b long, la long, lb long"


def _joined(pdf, side: np.ndarray | None, threshold: float, k: int):
    """(a, b, and their classes): a link for every two classes (column label) that near copies among the rows join, as few
    as join them all; with ``side``, only near copies on different sides count."""
    import pandas as pd
    n = len(pdf)
    node, label = pdf["node"].to_numpy(), pdf["label"].to_numpy()
    batch = pa.RecordBatch.from_arrays([pa.array(pdf["text"], pa.large_string())], ["text"])
    (text, item, weight), _, _ = bags(batch, "text", k)
    # a multiset as a set: occurrence 0, 1, 2 ... of a shingle are different tokens
    row = np.repeat(np.arange(len(text)), weight)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(weight) - weight, weight)
    token, text = T.mix(item[row] + T.mix(nth.astype(np.uint64))), text[row]
    size = np.bincount(text, minlength=n).astype(np.float64)
    _, code, times = np.unique(token, return_inverse=True, return_counts=True)
    wanted = times[code] > 1
    number = np.cumsum(times > 1) - 1
    code, text = number[code[wanted]], text[wanted]
    one = np.arange(n) if side is None else np.flatnonzero(side == 0)
    two = one if side is None else np.flatnonzero(side == 1)
    shared = np.zeros((len(one), len(two)), np.float32)
    order = np.argsort(code, kind="stable")
    code, text = code[order], text[order]
    for begin in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        lo, hi = np.searchsorted(code, [begin, begin + 4096])
        part = np.zeros((n, 4096), np.float32)
        part[text[lo:hi], code[lo:hi] - begin] = 1
        shared += part[one] @ part[two].T
    total = size[one, None] + size[None, two] - shared
    near = (shared > 0) & (shared >= threshold * total * (1 - 1e-12)) & (label[one, None] != label[None, two])
    x, y = np.nonzero(near)
    x, y = one[x], two[y]
    # one pair of texts for two classes, then as few as join what they join
    low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
    _, pick = np.unique(np.stack([low, high]), axis=1, return_index=True) if len(x) else (None, np.zeros(0, np.int64))
    top = {}

    def find(c):
        while top.get(c, c) != c:
            top[c] = top.get(top[c], top[c])
            c = top[c]
        return c
    keep = []
    for i in pick.tolist():
        p, q = find(int(low[i])), find(int(high[i]))
        if p != q:
            top[q] = p
            keep.append(i)
    keep = np.array(keep, np.int64)
    return pd.DataFrame({"a": node[x[keep]], "b": node[y[keep]], "la": low[keep], "lb": high[keep]})


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of every class: the one with the least doc_id; rows without a
    doc_id stay."""
    gone = near_classes(docs, **options).where("class_id <> doc_id").select(
        F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
