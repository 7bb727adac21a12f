"""Toxicity of whole texts: the most toxic of all overlapping windows of words.

The network (``bigru``) is trained on the driver from a bounded sample of labelled rows, at most
``SAMPLE`` toxic and twice as many clean texts, whole texts, rows outside the held-out fifth
only. A text's label says that some window is toxic, so training alternates between choosing each
text's highest windows and fitting them, and ends when the loss on training texts set aside no
longer falls.

Executors score every window of ``STEPS`` words, at every word. The recurrent states do not depend on the
window: a text is read once in blocks of ``CORE`` words, each direction with ``CONTEXT`` words before its
block. A window's logit is the attention-weighted mean over its words, so running totals of weights
and of weighted shares give the logits of all windows at once.

Defined cases: texts without words (null and empty too) are scored as one empty window; rows
without a doc_id are scored, are not held out and are never learned from; labels that are null are
ignored, of several labels the highest counts; without labels of both classes every score is 0.
Very long texts are scored in slices of windows. Only doc_id and text (and the labels' doc_id and
toxic) are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import bigru
from loadbay.llm import tokens as T

STEPS = 24                 # words of a window
CORE, CONTEXT = 40, 8      # words of a block, and words read before it in either direction
APART = 12                 # windows chosen in training lie in different stretches of so many words
LIMIT = 12.0               # of an attention score, so that running totals stay exact enough
SAMPLE = 800
FOLDS, HELD_OUT = 5, 0
EPOCHS = 8
CHECKED = 5                # one text in so many chooses epoch and scale
PATIENCE = 2               # epochs without a better one before training ends
U = np.uint64


def fold(doc_id, folds: int):
    """crc32 of the id as text, modulo folds."""
    return F.pmod(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")), F.lit(folds))


def encode(texts: pa.Array):
    """Distinct words of a slice with their buckets and trigrams, the words of all texts as numbers of these,
    and where each text begins."""
    data, off = T.buffer(texts)
    h, text, begin, end = T.words(data, off)
    values, where, code = np.unique(h, return_index=True, return_inverse=True)
    b, e = begin[where], end[where]
    size = e - b                                     # one trigram per byte, padded by boundaries
    bounds = np.r_[0, np.cumsum(size)]
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size) + np.repeat(b, size)
    low = np.r_[T.LOWER[data] + U(1), U(0)]
    first = np.repeat(b, size) == at
    last = np.repeat(e, size) == at + 1
    gram = T.mix(np.where(first, U(0), low[at - 1]) << U(20) | low[at] << U(10) | np.where(last, U(0), low[at + 1]))
    starts = np.searchsorted(text, np.arange(len(texts) + 1))
    return (values % U(bigru.WORDS)).astype(np.int64), (gram % U(bigru.GRAMS)).astype(np.int64), bounds, code, starts


def sequences(code: np.ndarray, starts: np.ndarray, owner: np.ndarray, first: np.ndarray, steps: int) -> np.ndarray:
    """(steps x count) numbers of the words from ``first`` on of each owner; -1 outside the text."""
    at = first[None, :] + np.arange(steps)[:, None]
    inside = (at >= 0) & (at < np.diff(starts)[owner][None, :])
    out = np.full(at.shape, -1, np.int32)
    out[inside] = code[(at + starts[owner][None, :])[inside]]
    return out


def scan(p, x: np.ndarray, code: np.ndarray, starts: np.ndarray, batch: int = 4096):
    """(text, first word, logit) of every window of every text; one window for a text without words."""
    n_words = np.diff(starts)
    blocks = -(-n_words // CORE)
    owner = np.repeat(np.arange(len(n_words)), blocks)
    first = (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * CORE
    weight, share = np.zeros(len(code)), np.zeros(len(code))
    for i in range(0, len(owner), batch):
        o, f = owner[i:i + batch], first[i:i + batch]
        forth = bigru.states(p, x, sequences(code, starts, o, f - CONTEXT, CORE + CONTEXT), "f")[CONTEXT:]
        back = bigru.states(p, x, sequences(code, starts, o, f, CORE + CONTEXT), "b")[:CORE]
        score, part = bigru.attended(p, forth, back)
        at = f[None, :] + np.arange(CORE)[:, None]
        inside = at < n_words[o][None, :]
        place = (at + starts[o][None, :])[inside]
        weight[place], share[place] = np.exp(np.clip(score[inside], -LIMIT, LIMIT)), part[inside]
    total = np.r_[0.0, np.cumsum(weight)]
    above = np.r_[0.0, np.cumsum(weight * share)]
    count = np.maximum(n_words - STEPS + 1, 1)
    text = np.repeat(np.arange(len(n_words)), count)
    begin = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    low = starts[text] + begin
    high = np.minimum(low + STEPS, starts[text + 1])
    mass = total[high] - total[low]
    logit = np.where(mass > 0, (above[high] - above[low]) / np.where(mass > 0, mass, 1), 0.0) + float(p["bo"][0])
    return text, begin, logit


def logits(p, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, logit) of every window."""
    word, gram, bounds, code, starts = encode(texts)
    x = bigru.embed(p, word, gram, bounds) if len(word) else np.zeros((1, bigru.DW + bigru.DC), np.float32)
    text, _, logit = scan(p, x, code, starts)
    return text, logit


def highest(owner: np.ndarray, logit: np.ndarray, n: int) -> np.ndarray:
    best = np.full(n, -np.inf)
    np.maximum.at(best, owner, logit)
    return best


def gathered(texts: list[str], y: np.ndarray, piece: int = 1 << 20):
    """``encode`` of many texts in pieces of bounded size, with one numbering of the words, and the
    log odds of word and trigram buckets by the texts that hold them."""
    parts, counts = [], {n: np.zeros((2, n)) for n in (bigru.WORDS, bigru.GRAMS)}
    whole = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    first = 0
    for batch in T.slices([whole], "text", piece):
        word, gram, bounds, code, starts = encode(batch.column("text"))
        pairs = np.unique(np.repeat(np.arange(batch.num_rows), np.diff(starts)) * np.int64(max(len(word), 1)) + code)
        t, c = pairs // max(len(word), 1), pairs % max(len(word), 1)
        size = np.diff(bounds)[c]
        flat = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(bounds[c], size)
        for n, bucket, text in ((bigru.WORDS, word[c], t), (bigru.GRAMS, gram[flat], np.repeat(t, size))):
            seen = np.unique(text * n + bucket)
            toxic = y[first + seen // n]
            counts[n] += [np.bincount(seen % n, toxic, n), np.bincount(seen % n, 1 - toxic, n)]
        parts.append((word, gram, bounds, code, np.diff(starts)))
        first += batch.num_rows
    # a word is its bucket and its trigrams
    numbers: dict[tuple, int] = {}
    words, grams, codes, sizes = [], [], [], []
    for word, gram, bounds, local, n_words in parts:
        code = np.zeros(len(word), np.int64)
        for i, w in enumerate(word.tolist()):
            g = gram[bounds[i]:bounds[i + 1]]
            key = (w, g.tobytes())
            if key not in numbers:
                numbers[key] = len(words)
                words.append(w)
                grams.append(g)
            code[i] = numbers[key]
        codes.append(code[local])
        sizes.append(n_words)
    bounds = np.r_[0, np.cumsum([len(g) for g in grams])].astype(np.int64)
    odds = [np.log((c[0] + 2) / (y.sum() + 4)) - np.log((c[1] + 2) / ((1 - y).sum() + 4)) for c in counts.values()]
    return (np.array(words, np.int64), np.concatenate(grams) if grams else np.zeros(0, np.int64), bounds,
            np.concatenate(codes), np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int64), odds)


def _calibrated(best: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """(slope, offset, mean loss) of a logistic fit of the texts' highest logits."""
    mid, unit = best.mean(), max(best.std(), 1e-6)
    x, slope, offset = (best - mid) / unit, 0.0, 0.0
    for _ in range(200):
        q = bigru.sigmoid(slope * x + offset)
        w, e = np.maximum(q * (1 - q), 1e-3), q - y
        m = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        ds, do = np.linalg.solve(m, [(e * x).sum() + 1e-2 * slope, e.sum() + 1e-2 * offset])
        slope, offset = slope - 0.5 * ds, offset - 0.5 * do
    slope, offset = slope / unit, offset - slope * mid / unit
    slope = max(slope, 1e-3)
    q = np.clip(bigru.sigmoid(slope * best + offset), 1e-6, 1 - 1e-6)
    return float(slope), float(offset), float(-np.mean(np.where(y > 0, np.log(q), np.log(1 - q))))


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11):
    """(network, slope, offset): a text's score is the sigmoid of slope * highest logit + offset.

    One text in ``CHECKED`` (by a hash of the text, so that copies stay together) is not fitted: these
    texts choose the epoch and the logistic scale, so that a network that has learned its texts by
    heart is not taken for a good one. With too few of them all texts serve for both."""
    y = labels.astype(np.float32)
    aside = np.array([zlib.crc32(t.encode()) % CHECKED == 0 for t in texts])
    if min(y[aside].sum(), (1 - y[aside]).sum(), y[~aside].sum(), (1 - y[~aside]).sum()) < 10:
        aside[:] = False
    held = aside if aside.any() else ~aside
    checked, checked_y = [t for t, c in zip(texts, held) if c], y[held]
    texts, y = [t for t, c in zip(texts, aside) if not c], y[~aside]
    word, gram, bounds, code, starts, (w_odds, g_odds) = gathered(texts, y)
    kept, least, best_at = None, np.inf, 0
    p = bigru.init(seed, w_odds, g_odds)
    adam, rng = bigru.Adam(p, 0.01), np.random.default_rng(seed)
    core = slice(CONTEXT, CONTEXT + STEPS)
    for epoch in range(epochs):
        if epoch:
            owner, first, value = scan(p, bigru.embed(p, word, gram, bounds), code, starts)
        else:                                              # first choice: windows around the most telling words
            owner = np.repeat(np.arange(len(texts)), np.diff(starts))
            first = np.maximum(np.arange(len(code)) - starts[owner] - STEPS // 2, 0)
            value = w_odds[word[code]]
        order = np.lexsort((-value, first // APART, owner))
        o, f = owner[order], first[order]
        peak = order[np.r_[True, (o[1:] != o[:-1]) | (f[1:] // APART != f[:-1] // APART)]] if len(order) else order
        order = peak[np.lexsort((-value[peak], owner[peak]))]
        head = np.r_[True, owner[order][1:] != owner[order][:-1]] if len(order) else np.zeros(0, bool)
        rank = np.arange(len(order)) - np.repeat(np.flatnonzero(head), np.diff(np.r_[np.flatnonzero(head), len(order)]))
        take = order[rank < np.where(y[owner[order]] > 0, 1, 3)]
        own, win = owner[take], sequences(code, starts, owner[take], first[take] - CONTEXT, STEPS + 2 * CONTEXT)
        pos, neg = (y[own] > 0).sum(), (y[own] == 0).sum()
        weight = np.where(y[own] > 0, 1.0, pos / max(1, neg)).astype(np.float32)
        turn = np.arange(len(take))
        for _ in range(2):
            rng.shuffle(turn)
            for i in range(0, len(turn), 192):
                some = turn[i:i + 192]
                here, back = np.unique(win[:, some], return_inverse=True)
                back = back.reshape(win[:, some].shape)
                shift = int(len(here) > 0 and here[0] < 0)          # padding
                here, local = here[shift:], back - shift
                if not len(here):
                    continue
                size = np.diff(bounds)[here]
                g_at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(bounds[here], size)
                part = word[here], gram[g_at], np.r_[0, np.cumsum(size)]
                x = bigru.embed(p, *part)
                out, cache = bigru.forward(p, x, local, core, keep=True)
                d = (bigru.sigmoid(out) - y[own[some]]) * weight[some] / len(some)
                adam.step(p, bigru.backward(p, x, cache, d.astype(np.float32), *part))
        best = []
        for batch in T.slices([pa.RecordBatch.from_arrays([pa.array(checked, pa.large_string())], ["text"])], "text"):
            best.append(highest(*logits(p, batch.column("text")), batch.num_rows))
        slope, offset, loss = _calibrated(np.concatenate(best).astype(np.float64), checked_y)
        if loss < least:
            kept, least, best_at = ({k: v.copy() for k, v in p.items()}, slope, offset), loss, epoch
        elif epoch - best_at >= PATIENCE:
            break
    return kept


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """The model, or None where a class has no labelled text. The sample: per class the rows with
    the smallest hash of doc_id, ``sample`` at most for toxic and twice that for clean ones."""
    known = (labels.select(F.col("doc_id").cast("long").alias("l_id"), "toxic")
             .where(F.expr("l_id IS NOT NULL AND toxic IN (0, 1)")).where(fold("l_id", FOLDS) != HELD_OUT)
             .groupBy("l_id").agg(F.max("toxic").cast("int").alias("toxic")))
    texts = []
    for toxic, most in ((1, sample), (0, 2 * sample)):
        ids = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("l_id"), "l_id").limit(most)
        texts.append(docs.select(F.col("doc_id").cast("long").alias("d_id"), "text")
                     .join(F.broadcast(ids), F.col("d_id") == F.col("l_id")))
    rows = (texts[0].unionByName(texts[1]).groupBy("l_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
            .orderBy("l_id").limit(3 * sample).collect())       # bounded by the sample
    y = np.array([r.toxic for r in rows])
    if not len(y) or y.min() == y.max():
        return None
    return train([r.text or "" for r in rows], y)


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, sample))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text", 1 << 20):
            if model.value is None:
                s = np.zeros(batch.num_rows)
            else:
                p, slope, offset = model.value
                owner, value = logits(p, batch.column("text"))
                s = bigru.sigmoid(slope * highest(owner, value, batch.num_rows).astype(np.float64) + offset)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s),
                 pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs without the texts predicted toxic; the texts stay where they are."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, sample))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text", 1 << 20):
            if model.value is not None:
                p, slope, offset = model.value
                owner, value = logits(p, batch.column("text"))
                s = slope * highest(owner, value, batch.num_rows).astype(np.float64) + offset
                batch = batch.filter(pa.array(s < 0))
            if batch.num_rows:
                yield batch
    return docs.mapInArrow(run, docs.schema)
