"""Exact largest inner products of integer vectors.

Candidates are range-partitioned by length, longest first. Queries come in blocks of bounded size
(``BLOCK`` rows), each scanned against every candidate. Vectors are rotated by the right singular
vectors of a bounded sample, so the first ``HEAD`` coordinates carry most of a product; what the
others can add is bounded by the lengths of the two remainders (Cauchy-Schwarz). A task walks its
candidates in chunks (by falling length within a file, of which it may be dealt several), drops queries whose bound |q||x| is below their twentieth
best so far, drops pairs whose partial sum plus remainder bound is, and computes the rest exactly
in integers. The twentieth best starts from the longest candidates of all, scored beforehand. Any
rotation gives the same results; the sample only decides how much is pruned.

Defined cases: vectors that are null, empty, or hold a null or non-finite component, and rows
without vec_id, take no part; a shorter vector counts as padded with zeros; ties go to the smaller
vec_id; repeated rows are rows of their own (rows that share the query's vec_id are all skipped);
no queries or candidates, no rows. Only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadbay.session import cut

K = 20
EVERY = 20                 # queries: vec_id divisible by this
SCALE = 64
BLOCK = 8192               # queries scanned at once
SAMPLE = 4096              # vectors the rotation is fitted on, and longest candidates scored first
HEAD = 16


def integers(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (floor of scale times each component) and norm2 of the vectors that take part."""
    ok = F.expr("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND NOT exists(embedding,"
                " x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(ok)
            .select("vec_id", v.alias("v"))
            .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))


def matrix(v: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list array as float64 (exact for these integers), padded with zeros."""
    v = v.cast(pa.large_list(pa.int64()))
    size = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy()
    if (size == dim).all():
        return flat.reshape(-1, dim).astype(np.float64)
    out = np.zeros((len(v), dim))
    row = np.repeat(np.arange(len(v)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class Best:
    """The k best (score, smaller id first) of each query among what was added."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k, self.limit = floor.copy(), k, 4 * k * max(len(floor), 64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, q, ids, score) -> None:
        self.parts.append((q, ids, score))
        self.size += len(q)
        if self.size > self.limit:
            self.compact()

    def compact(self):
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, ids, score = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
        kth = rank == self.k - 1
        self.floor[q[kth]] = np.maximum(self.floor[q[kth]], score[kth])
        keep = rank < self.k
        self.parts = [(q[keep], ids[keep], score[keep])]
        self.size = int(keep.sum())
        return self.parts[0]


def scan(block: dict, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates in, by falling norm2 within each file of a task, each query's best among them out."""
    ids, q, qr, k = block["ids"], block["q"], block["qr"], block["k"]
    dim, head = q.shape[1], block["head"]
    q_norm = np.sqrt((q * q).sum(axis=1))
    q_rest = np.sqrt((qr[:, head:] ** 2).sum(axis=1))
    best = Best(block["floor"], k)
    step = max(64, min(1024, (1 << 22) // max(1, len(q))))
    slack = 1e-6 * (1 + q_norm)
    for batch in batches:
        if not batch.num_rows:
            continue
        x_all = matrix(batch.column("v"), dim)
        x_ids = batch.column("vec_id").to_numpy()
        for i in range(0, len(x_all), step):
            x, own = x_all[i:i + step], x_ids[i:i + step]
            top = math.sqrt(float((x * x).sum(axis=1).max()))
            act = np.flatnonzero(q_norm * top + slack >= best.floor)
            if not len(act):
                continue                                     # the next file's may be longer again
            xr = x @ block["turn"]
            rest = np.sqrt((xr[:, head:] ** 2).sum(axis=1))
            bound = qr[act, :head] @ xr[:, :head].T + q_rest[act, None] * rest
            alive = (bound + slack[act, None] * (1 + top) >= best.floor[act, None]) & (ids[act, None] != own)
            a, c = np.nonzero(alive)
            if not len(a):
                continue
            if len(a) * 8 > alive.size:
                score = (q[act] @ x.T)[a, c]
            else:
                score = np.concatenate([np.einsum("ij,ij->i", q[act[a[j:j + 65536]]], x[c[j:j + 65536]])
                                        for j in range(0, len(a), 65536)])
            good = score >= best.floor[act[a]]
            best.add(act[a[good]], own[c[good]], score[good])
    n, v, s = best.compact()
    for i in range(0, len(n), 50_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[n[i:i + 50_000]]), pa.array(v[i:i + 50_000]),
             pa.array(s[i:i + 50_000].astype(np.int64))], ["query_id", "vec_id", "score"])


def rotation(sample: np.ndarray) -> np.ndarray:
    """Right singular vectors as columns, largest first."""
    return np.linalg.svd(sample, full_matrices=True)[2].T if len(sample) else np.eye(sample.shape[1])


def top_k(rows: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, block: int = BLOCK,
          sample: int = SAMPLE, head: int = HEAD) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of largest inner product of each query."""
    spark = rows.sparkSession
    kept = cut(integers(rows, scale).repartitionByRange(F.desc("norm2"), "vec_id")
               .sortWithinPartitions(F.desc("norm2"), "vec_id"), "vectors")
    sizes = kept.agg(F.max(F.size("v")).alias("dim"),
                     F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("n")).first()
    dim, n = sizes["dim"] or 1, sizes["n"] or 0

    def pull(df, columns=("vec_id", "v")):                  # bounded by sample or block
        got = df.select(*columns).toArrow()
        return np.array(got.column(0).to_pylist(), np.int64), matrix(got.column(1).combine_chunks(), dim)

    turn = rotation(pull(kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample))[1])
    long_ids, long = pull(kept.orderBy(F.desc("norm2"), "vec_id").limit(sample))
    blocks = max(1, -(-n // block))
    found = None
    for b in range(blocks):
        part = kept.where(F.col("vec_id") % every == 0)
        if blocks > 1:
            part = part.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        ids, q = pull(part.orderBy("vec_id"))
        floor = np.full(len(ids), -np.inf)
        for i in range(0, len(ids), 512):
            s = np.where(ids[i:i + 512, None] == long_ids, -np.inf, q[i:i + 512] @ long.T)
            if s.shape[1] >= k:
                floor[i:i + 512] = -np.partition(-s, k - 1, axis=1)[:, k - 1]
        held = spark.sparkContext.broadcast(
            {"ids": ids, "q": q, "qr": q @ turn, "turn": turn, "floor": floor, "k": k, "head": min(head, dim)})

        def run(batches, held=held):
            return scan(held.value, batches)

        one = kept.select("vec_id", "v").mapInArrow(run, "query_id long, vec_id long, score long")
        one = cut(one, "best") if blocks > 1 else one
        found = one if found is None else found.unionByName(one)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""
