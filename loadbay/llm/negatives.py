"""Hard negatives by threshold joins over inverted indexes of bounded blocks (after L2AP).

Rows are dealt into blocks of about ``BLOCK``, anchors into blocks of their own; a cell joins one of each. Every cell
builds an inverted index of its rows: dimensions stand in the order of the anchors' energy, lowest first, and a
row's leading dimensions are left out of the index as long as their length times that of any anchor stays
below its threshold (Cauchy-Schwarz: those dimensions alone cannot reach it). The anchors meet the index
stripe by stripe from the last dimension down; after each stripe, pairs whose partial score plus the product of
the two remaining lengths is below the anchor's threshold are dropped. What survives is scored in integers.

Positives: one block of rows gives each anchor a first threshold, its ``POSITIVES``-th best score there; inside a cell
it rises as better rows are found. Negatives: each positive opens a window from LOW to HIGH per cent of its score.
A pass over the rows uses a threshold near the top of the windows; windows whose best ``NEGATIVES`` of all cells
together lie above it are done, the others go into the next pass with a lower one (``STEPS``), the last time with
the window's own lower end. So no pass loses a row, and most anchors never reach the low thresholds.

What a cell returns is bounded by its anchors, not by its rows. Blocks of anchors times rows are the work there is
(a stated query set against all rows); neither a hot label nor a group of equal vectors grows a cell.

Defined cases: rows without vec_id or label, and vectors that are null or hold a null or non-finite component, take
no part; an empty vector is all zeros, a shorter one counts as padded with zeros; ties go to the smaller
vec_id; repeated rows are rows of their own, also as anchors, and rows that share the anchor's vec_id are
never its positives or negatives; a window of a negative score is empty; no anchors or no rows, no result. Scores
are exact as long as they fit into 64 bits. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadbay.session import cut

SCALE = 256
EVERY = 100                # anchors: vec_id divisible by this
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100        # a window, in per cent of the positive's score
STEPS = (95, 88)           # lower ends of the passes before the last, in per cent of the positive's score
BLOCK = 8192               # rows of a cell
ANCHORS = 4096             # anchors of a cell
STRIPE = 8                 # dimensions of a stripe
CELLS = 1 << 22            # pairs looked at together
NEVER = np.iinfo(np.int64).min
FOUND = pa.schema([("a", pa.int64()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def prepared(rows: DataFrame, scale: int = SCALE, flip: int = 7, labels: int = 10) -> DataFrame:
    """vec_id, label (moved on by one, modulo ``labels``, where ``flip`` divides vec_id), v of the rows that take part."""
    ok = F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND NOT exists(embedding,"
                " x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    label = F.col("label").cast("long")
    return rows.select("vec_id", "label", "embedding").where(ok).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % flip == 0, (label + 1) % labels).otherwise(label).alias("label"), v.alias("v"))


# --- one cell -----------------------------------------------------------------

def exact(q: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise products of integer matrices, in integers."""
    return np.einsum("ij,ij->i", q, y)


def integers(v: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list array as int64, padded with zeros."""
    size = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy().astype(np.int64)
    out = np.zeros((len(v), dim), np.int64)
    row = np.repeat(np.arange(len(v)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def leading(x: np.ndarray) -> np.ndarray:
    """Lengths of the first 0, 1, 2, ... coordinates of every row."""
    out = np.zeros((len(x), x.shape[1] + 1))
    np.sqrt(np.cumsum(x ** 2, axis=1), out=out[:, 1:])
    return out


class Index:
    """Inverted index of rows by stripes of dimensions, without the leading dimensions of a row
    that cannot reach ``reach``, the least threshold divided by its anchor's length."""

    def __init__(self, y: np.ndarray, reach: float, stripe: int = STRIPE):
        lead = leading(y)
        self.n, self.length = len(y), lead[:, -1]
        left_out = (lead[:, 1:] * (1 + 1e-9) < reach).sum(axis=1)
        self.lists = []                                            # last stripe first
        for to in range(y.shape[1], 0, -stripe):
            at = max(0, to - stripe)
            rows = np.flatnonzero(left_out < to)
            rest = np.maximum(at, left_out[rows])                  # dimensions still open after this stripe
            inside = y[rows, at:to] * (np.arange(at, to) >= left_out[rows, None])
            self.lists.append((at, to, rows, inside, rest, lead[rows, rest]))

    def pairs(self, q: np.ndarray, floor: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) of the allowed pairs that may score their anchor's floor or more."""
        q_lead = leading(q)
        alive, seen = allowed.copy(), np.zeros(self.n, bool)
        score = np.zeros(alive.shape)
        for at, to, rows, inside, rest, length in self.lists:
            act, keep = np.flatnonzero(alive.any(axis=1)), alive[:, rows].any(axis=0)
            rows, inside, rest, length = rows[keep], inside[keep], rest[keep], length[keep]
            if not len(rows):
                continue
            seen[rows] = True
            here = np.ix_(act, rows)
            part = score[here] + q[act, at:to] @ inside.T
            score[here] = part
            slack = 1e-9 * (1 + q_lead[act, -1:] * self.length[rows])
            alive[here] &= part + q_lead[act][:, rest] * length + slack >= floor[act, None]
        alive[:, ~seen] = False                # no indexed dimension: below every threshold
        return np.nonzero(alive)


def best(key: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best (score, then smaller id) of every key, key by key."""
    order = np.lexsort((ids, -score, key))
    key = key[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return order[np.arange(len(key)) - np.repeat(start, np.diff(np.r_[start, len(key)])) < k]


def cell(a: dict[str, np.ndarray], y: dict[str, np.ndarray], k: int, same: bool) -> tuple[np.ndarray, ...]:
    """The best k rows in every window of a block of anchors, among a block of rows.

    a: vec_id, label, v of the anchors; owner (ascending), low and high of their windows. y: vec_id,
    label, v. Returns positions of windows, positions of rows, scores.
    """
    owner, low, high = a["owner"], a["low"].copy(), a["high"]
    q, v = a["v"].astype(np.float64), y["v"].astype(np.float64)
    order = np.argsort((q ** 2).sum(axis=0), kind="stable")
    q, v = q[:, order], v[:, order]
    q_length = np.sqrt((q ** 2).sum(axis=1))
    got = (np.zeros(0, np.int64),) * 3
    step = int(np.clip(CELLS // max(1, len(q)), 64, 2048))
    for begin in range(0, len(v), step):
        own = slice(begin, begin + step)
        floor = np.full(len(q), np.inf)
        np.minimum.at(floor, owner, np.where(low == NEVER, -np.inf, low.astype(np.float64)))
        allowed = (a["label"][:, None] == y["label"][None, own]) == same
        allowed &= (a["vec_id"][:, None] != y["vec_id"][None, own]) & (floor < np.inf)[:, None]
        asks = allowed.any(axis=1)
        if not asks.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(q_length > 0, floor / q_length, np.where(floor > 0, np.inf, -np.inf))[asks].min()
        who, row = Index(v[own], reach).pairs(q, floor, allowed)
        score = np.concatenate([got[2][:0], *(exact(a["v"][who[i:i + 65536]], y["v"][begin + row[i:i + 65536]])
                                              for i in range(0, len(who), 65536))])
        # a pair counts in every window of its anchor that its score lies in
        left, right = np.searchsorted(owner, who, "left"), np.searchsorted(owner, who, "right")
        each = right - left
        pair = np.repeat(np.arange(len(who)), each)
        window = np.repeat(left - np.cumsum(each) + each, each) + np.arange(each.sum())
        inside = (score[pair] >= low[window]) & (score[pair] <= high[window])
        pair, window = pair[inside], window[inside]
        window, row, score = (np.r_[x, z] for x, z in zip(got, (window, row[pair] + begin, score[pair])))
        keep = best(window, y["vec_id"][row], score, k)
        window, row, score = got = window[keep], row[keep], score[keep]
        # the lower end of a window that is full here rises to its last score
        last = np.flatnonzero(np.r_[window[1:] != window[:-1], len(window) > 0])
        full = last[np.bincount(window, minlength=len(low))[window[last]] >= k]
        low[window[full]] = np.maximum(low[window[full]], score[full])
    return got


def _cell(k: int, same: bool):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return FOUND.empty_table()
        lists = [t.column("v").combine_chunks() for t in (anchors, rows)]
        dim = max(1, *(int(np.diff(x.offsets.to_numpy()).max()) for x in lists))
        y = {"vec_id": rows.column("vec_id").to_numpy(), "label": rows.column("label").to_numpy(),
             "v": integers(lists[1], dim)}
        # long rows first, so that thresholds rise early; where labels must agree, label by label
        length = (y["v"].astype(np.float64) ** 2).sum(axis=1)
        turn = np.lexsort((y["vec_id"], -length, y["label"] if same else np.zeros(len(length))))
        y = {c: x[turn] for c, x in y.items()}
        windows = anchors.column("windows").combine_chunks()
        owner = np.repeat(np.arange(anchors.num_rows), np.diff(windows.offsets.to_numpy()))
        name, low, high = windows.flatten().flatten()
        window, row, score = cell(
            {"vec_id": anchors.column("vec_id").to_numpy(), "label": anchors.column("label").to_numpy(),
             "v": integers(lists[0], dim), "owner": owner, "low": low.to_numpy(), "high": high.to_numpy()}, y, k, same)
        a = anchors.column("a").to_numpy()[owner[window]]
        return pa.table([pa.array(a), name.take(pa.array(window)), pa.array(y["vec_id"][row]), pa.array(score)],
                        schema=FOUND)
    return run


# --- the passes ---------------------------------------------------------------

def search(anchors: DataFrame, rows: DataFrame, k: int, same: bool, blocks: int, columns: list[int]) -> DataFrame:
    """a, window, vec_id, score, rank: the k best rows in every window of every anchor.

    anchors: a, vec_id, label, v, block, windows; rows: vec_id, label, v, column. Each block of anchors
    meets each block of rows in a cell of its own.
    """
    asked = anchors.withColumn("column", F.explode(F.sequence(F.lit(columns[0]), F.lit(columns[-1]))))
    spread = (rows.where(F.col("column").between(columns[0], columns[-1]))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    found = asked.groupBy("block", "column").cogroup(spread.groupBy("block", "column")).applyInArrow(
        _cell(k, same), "a long, window int, vec_id long, score long")
    order = Window.partitionBy("a", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def share(score: str, percent: int, up: bool) -> Column:
    """``percent`` per cent of a non-negative integer column, rounded up or down, without overflow."""
    return F.expr(f"({score} div 100) * {percent} + (({score} % 100) * {percent} + {99 if up else 0}) div 100")


def mine(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         scale: int = SCALE, low: int = LOW, high: int = HIGH, steps: tuple[int, ...] = STEPS,
         block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    kept = cut(prepared(rows, scale).withColumn("a", F.monotonically_increasing_id()), "vectors")
    size = kept.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("m")).first()
    # blocks of rows are smaller where the table is, so that every core has one
    cores = kept.sparkSession.sparkContext.defaultParallelism
    n_columns = max(1, -(-size["n"] // block), min(cores, -(-size["n"] // 1024)))
    n_blocks = max(1, -(-size["m"] // anchor_block))
    dealt = kept.withColumn("column", F.pmod(F.xxhash64("a"), F.lit(n_columns)).cast("int"))
    anchors = cut(kept.where(F.col("vec_id") % every == 0)
                  .withColumn("block", F.pmod(F.xxhash64(F.lit(1), "a"), F.lit(n_blocks)).cast("int")), "anchors")
    every_column = list(range(n_columns))

    def window(at, upto, name=F.lit(0)):
        return F.struct(name.cast("int").alias("window"), at.alias("low"), upto.alias("high"))

    # positives: first thresholds from one block of rows, then all blocks
    whole = window(F.lit(NEVER), F.lit(np.iinfo(np.int64).max))
    first = anchors.withColumn("windows", F.array(whole))
    if n_columns > 1:
        seen = search(first, dealt, positives, True, n_blocks, [0])
        known = cut(seen.where(F.col("rank") == positives).select(F.col("a").alias("_a"), "score"), "thresholds")
        at = F.coalesce("score", F.lit(NEVER))
        first = anchors.join(known, F.col("a") == F.col("_a"), "left").withColumn(
            "windows", F.array(window(at, F.lit(np.iinfo(np.int64).max)))).drop("_a", "score")
    found = search(first, dealt, positives, True, n_blocks, every_column)
    ids = anchors.select(F.col("a").alias("_a"), F.col("vec_id").alias("anchor_id"))
    pairs = cut(found.join(ids, F.col("a") == F.col("_a")).select(
        "a", F.col("rank").alias("window"), "anchor_id", F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")

    open_ = pairs.where("positive_score >= 0").select("a", "window", F.col("positive_score").alias("top"))
    parts = []
    for step in (*[s for s in steps if s > low], low):
        windows = open_.groupBy(F.col("a").alias("_a")).agg(F.collect_list(window(
            share("top", step, True), share("top", high, False), F.col("window"))).alias("windows"))
        asked = anchors.join(windows, F.col("a") == F.col("_a")).drop("_a")
        got = cut(search(asked, dealt, negatives, False, n_blocks, every_column), "negatives")
        if step == low:
            parts.append(got)
            break
        full = got.where(F.col("rank") == negatives).select("a", "window")
        parts.append(got.join(full, ["a", "window"], "left_semi"))
        open_ = cut(open_.join(full, ["a", "window"], "left_anti"), "open")
        if open_.isEmpty():
            break
    mined = reduce(DataFrame.unionByName, parts)
    return mined.join(pairs, ["a", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
