"""Language of whole texts: family first, then one against one within the family.

Features are hashed character n-grams (1 to 3 bytes of the lower-cased text, everything that is
not part of a word a single kind of gap), square roots of relative frequencies, scaled to length
one. Linear support vector machines with squared hinge loss are fitted on the driver on a bounded
sample: about ``PER_LANG`` whole texts of each language, chosen by a hash of doc_id. One machine
per family against the rest picks the family; within it, one machine for each pair of languages
votes.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows without a doc_id
are predicted, are not held out and are never learned from; null languages are not learned;
without any labelled text every prediction is ``und``; a language code not in the list below is a
family of its own. Only doc_id, text and (for learning) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.llm import tokens as T
from loadbay.llm.toxicity import fold

SIZE = 1024                # hashed features
PER_LANG = 2000
FOLDS, HELD_OUT = 3, 1
ROWS = 2048                # rows of a slice, for the dense feature matrix
U = np.uint64
# ISO 639-1 codes by family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nl nb nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indo-aryan": "as bn gu hi mr ne pa sd si ur",
    "semitic": "am ar he mt",
    "turkic": "az kk ky tk tr tt ug uz",
    "uralic": "et fi hu",
    "sinitic": "yue zh",
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def features(texts: pa.Array) -> np.ndarray:
    """(rows, SIZE) float32."""
    data, off = T.buffer(texts)
    n, rows = len(data), len(texts)
    out = np.zeros((rows, SIZE), np.float32)
    if not n:
        return out
    c = np.where(T.IN_WORD[data], T.LOWER[data], U(32)).astype(np.uint32)
    c[(data >= 48) & (data <= 57)] = 32
    text = np.repeat(np.arange(rows), np.diff(off))
    code = c.copy()
    total = np.zeros(rows * SIZE, np.int64)
    for k in range(1, 4):
        if k > 1:
            code = code[:-1] * np.uint32(263) + c[k - 1:]
        m = len(code)
        if m <= 0:
            break
        h = (code + np.uint32(k)) * np.uint32(2654435761) >> np.uint32(22)
        inside = text[:m] == text[k - 1:]
        inside &= c[:m] != 32 if k == 1 else (c[:m] != 32) | (c[k - 1:] != 32)
        total += np.bincount(text[:m][inside] * SIZE + h[inside].astype(np.int64), minlength=rows * SIZE)
    out = np.sqrt(total.reshape(rows, SIZE)).astype(np.float32)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)


def svm(x: np.ndarray, y: np.ndarray, cost: float = 8.0, steps: int = 250) -> np.ndarray:
    """Weights (with a last one for the constant) of linear machines, one per column of y (+1, -1):
    accelerated gradient steps on |w|^2 / 2 + cost * mean squared hinge, classes weighted evenly."""
    x = np.c_[x, np.ones(len(x), np.float32)]
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    share = np.where(y > 0, 0.5 / np.maximum((y > 0).sum(axis=0), 1), 0.5 / np.maximum((y < 0).sum(axis=0), 1))
    share = (share * cost * 10).astype(np.float32)
    top = np.ones(x.shape[1], np.float32)
    for _ in range(20):
        top = x.T @ (x @ top) / len(x)
        norm = float(np.linalg.norm(top))
        top /= max(norm, 1e-9)
    rate = 1.0 / (1.0 + 2 * norm * float(share.max()) * len(x))
    look, last = w, w
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ look))
        grad = look - 2 * x.T @ (share * y * slack)
        w = look - rate * grad
        look = w + (t / (t + 3)) * (w - last)
        last = w
    return w


def fit(x: np.ndarray, lang: list[str]) -> dict:
    langs = sorted(set(lang))
    family = {v: FAMILY.get(v, v) for v in langs}
    families = sorted(set(family.values()))
    of = np.array([families.index(family[v]) for v in lang])
    who = np.array([langs.index(v) for v in lang])
    model = {"langs": langs, "families": families, "first": None, "within": {}}
    if len(families) > 1:
        model["first"] = svm(x, np.where(of[:, None] == np.arange(len(families)), 1.0, -1.0).astype(np.float32))
    for f, name in enumerate(families):
        own = [i for i, v in enumerate(langs) if family[v] == name]
        pairs = [(a, b) for i, a in enumerate(own) for b in own[i + 1:]]
        machines = []
        for a, b in pairs:
            use = (who == a) | (who == b)
            machines.append(svm(x[use], np.where(who[use] == a, 1.0, -1.0)[:, None].astype(np.float32)))
        model["within"][f] = (own, pairs, np.concatenate(machines, axis=1) if machines else None)
    return model


def predict(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into langs, score between 0 and 1) of every row."""
    n = len(x)
    x = np.c_[x, np.ones(n, np.float32)]
    lang, score = np.zeros(n, np.int64), np.ones(n)
    fam = np.zeros(n, np.int64)
    if model["first"] is not None:
        m = (x @ model["first"]).astype(np.float64)
        fam = m.argmax(axis=1)
        others = np.where(np.arange(m.shape[1]) == fam[:, None], -np.inf, m).max(axis=1)
        score = 1 / (1 + np.exp(-2 * (m[np.arange(n), fam] - others)))
    for f, (own, pairs, w) in model["within"].items():
        at = np.flatnonzero(fam == f)
        lang[at] = own[0]
        if w is None or not len(at):
            continue
        m = (x[at] @ w).astype(np.float64)
        votes, sums = np.zeros((len(at), len(own))), np.zeros((len(at), len(own)))
        for j, (a, b) in enumerate(pairs):
            a, b = own.index(a), own.index(b)
            votes[:, a] += m[:, j] > 0
            votes[:, b] += m[:, j] <= 0
            sums[:, a] += m[:, j]
            sums[:, b] -= m[:, j]
        best = (votes + 0.49 * np.tanh(sums)).argmax(axis=1)
        lang[at] = np.array(own)[best]
        score[at] *= 1 / (1 + np.exp(-2 * sums[np.arange(len(at)), best] / max(1, len(own) - 1)))
    return lang, score


def _pieces(batches):
    for batch in T.slices(batches, "text"):
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def learn(docs: DataFrame, per_lang: int = PER_LANG) -> dict | None:
    """The model. The sample: of each language the rows whose hashed doc_id falls below per_lang
    over the language's rows, about per_lang of them."""
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
             .where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
             .where(fold("doc_id", FOLDS) != HELD_OUT))
    counts = known.groupBy("lang").count().collect()             # as many rows as languages
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, per_lang / r["count"]))])
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = features(batch.column("text")).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["doc_id", "lang", "x"])

    rows = (known.where(unit < share[F.col("lang")])
            .mapInArrow(run, "doc_id long, lang string, x binary").collect())   # bounded by the sample
    rows.sort(key=lambda r: (r.doc_id, r.lang, r.x))
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float16).reshape(len(rows), SIZE)
    return fit(x.astype(np.float32), [r.lang for r in rows]) if rows else None


def languages(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """Per row of docs: doc_id, held_out, lang_pred, score."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, per_lang))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in _pieces(batches):
            n = batch.num_rows
            some = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            names, score = np.full(n, "und", object), np.zeros(n)
            if m is not None:
                lang, s = predict(m, features(batch.column("text")))
                names[some] = np.array(m["langs"], object)[lang[some]]
                score[some] = s[some]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       "text", F.expr("coalesce(text RLIKE '\\\\p{L}', false)").alias("letters"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
