"""Merkle manifest of a documents table, with a proof for every document from few fetched nodes.

A document's leaf is the SHA-256 of its fields. Leaves of a source ascend by doc_id and form a tree
of fan-out ``ARITY``; the subroots, ordered by source, form one more tree, whose top is the root.
Tables, all cut into the shared folder: leaves (in range partitions by source and doc_id, so a
partition holds runs of neighbouring leaves), and the interior nodes, built level by level.

Proofs follow the octopus multiproof. A leaf partition is at most ``LEAVES`` neighbouring leaves. From
the runs it holds it works out, level by level, which nodes its proofs need and neither hold nor can be
derived from its own: the minimal union of missing coordinates, at most 2 * (ARITY - 1) a level and run.
It fetches these once (one equi-join by coordinate), derives the interior nodes that its leaves
share, and expands the proof of each leaf locally. Neither a hot source nor a large table changes what
one partition holds. Only hashes are shuffled, never texts.

Defined cases: null fields count as ``-``; rows without a doc_id come first in their source and are not
tampered with; rows without a source form a source of their own, before the others; rows that share a
doc_id stand in the order of their leaves; equal rows are leaves of their own; a lone leaf is its
source's subroot, a lone subroot the root; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadbay.operators.ordinals import ordinals
from loadbay.session import cut

ARITY = 16
LEAVES = 16_384            # leaves of a partition whose proofs are expanded together
EVERY = 5                  # tampered: the checksum of doc_id is divisible by this
TOP = -1                   # tree number of the tree over sources
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def leaf_hash(text: Column) -> Column:
    """The leaf of a row whose text is ``text``."""
    def framed(x):
        x = x.cast("string")
        return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
    return F.sha2(F.concat(*[framed(F.col(c)) for c in FIELDS[:-1]], framed(text)), 256)


def leaves(docs: DataFrame, every: int = EVERY, block: int = LEAVES) -> DataFrame:
    """source, doc_id, leaf, tampered (null where the row is not), part, row: ``part`` numbers the
    leaf partitions in tree order, ``row`` the leaves inside one."""
    wanted = F.crc32(F.col("doc_id").cast("string")) % every == 0
    hashed = docs.select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_hash(F.col("text")).alias("leaf"),
        F.when(wanted, leaf_hash(F.translate("text", UPPER, LOWER))).alias("tampered"))
    ordered = (cut(hashed, "hashed").repartitionByRange("source", "doc_id", "leaf")
               .sortWithinPartitions("source", "doc_id", "leaf")
               .withColumn("spot", F.monotonically_increasing_id()))
    placed = cut(ordered, "leaves")
    row = F.col("spot").bitwiseAND(F.lit((1 << 33) - 1))
    # a range partition of any size is dealt into leaf partitions of bounded size
    return (placed.withColumn("part", F.shiftleft(F.shiftright("spot", 33), 22) + F.floor(row / block).cast("long"))
            .withColumn("row", row % block).drop("spot"))


def runs(placed: DataFrame) -> DataFrame:
    """part, source, tree, first_row, n, start, total: the stretch of a source's leaves in a part.

    ``tree`` numbers the sources, ``start`` the first leaf of the run inside its source. As many
    rows as parts and sources together.
    """
    counts = cut(placed.groupBy("part", "source").agg(
        F.count("*").alias("n"), F.min("row").alias("first_row")), "runs")
    numbered = ordinals(counts.groupBy("source").agg(F.sum("n").alias("total")), "source", "tree")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    started = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    pairs = numbered.select(F.col("source").alias("_source"), "total", "tree")
    return cut(started.join(pairs, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "runs")


def _parents(nodes: DataFrame, arity: int) -> DataFrame:
    """The next level of every tree that has more than one node at this one."""
    kids = F.transform(F.array_sort(F.collect_list(F.struct("idx", "hash"))), lambda x: x["hash"])
    return (nodes.where(F.col("n") > 1)
            .groupBy("tree", F.floor(F.col("idx") / arity).cast("long").alias("up"))
            .agg(F.sha2(F.array_join(kids, ""), 256).alias("hash"), F.min("n").alias("n"),
                 F.min("level").alias("level"))
            .select("tree", (F.col("level") + 1).alias("level"), F.col("up").alias("idx"), "hash",
                    F.ceil(F.col("n") / arity).cast("long").alias("n")))


def build(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """All nodes of the trees whose lowest level is given as (tree, level, idx, hash, n)."""
    out = [level]
    while level.where(F.col("n") > 1).limit(1).count():
        level = cut(_parents(level, arity), "nodes")
        out.append(level)
    return reduce(DataFrame.unionByName, out)


def missing(low: int, high: int, n: int, arity: int = ARITY) -> Iterator[tuple[int, int]]:
    """(level, index) of the nodes that the leaves low..high of n need but cannot derive."""
    level = 0
    while n > 1:
        left, right = low // arity * arity, min((high // arity + 1) * arity, n) - 1
        for idx in (*range(left, low), *range(high + 1, right + 1)):
            yield level, idx
        low, high, n, level = low // arity, high // arity, -(-n // arity), level + 1


def _requests(arity: int):
    """part, tree, low, high, total in, coordinates out."""
    def run(batches):
        for batch in batches:
            out = []
            for part, tree, low, high, n in zip(*[batch.column(c).to_pylist() for c in (
                    "part", "tree", "low", "high", "total")]):
                out += [(part, tree, level, idx) for level, idx in missing(low, high, n, arity)]
            for i in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in zip(*out[i:i + 50_000])], ["part", "tree", "level", "idx"])
    return run


def sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


class Strand:
    """One tree as far as a run of its nodes sees it: the nodes of the run, and those fetched."""

    def __init__(self, low: int, nodes: list[bytes], n: int, fetched: dict[tuple[int, int], bytes], arity: int):
        self.arity, self.low = arity, low
        self.groups: list[tuple[int, list[bytes]]] = []          # per level: first group, its members
        high, level = low + len(nodes) - 1, 0
        while n > 1:
            left, right = low // arity * arity, min((high // arity + 1) * arity, n) - 1
            whole = [*(fetched[level, i] for i in range(left, low)), *nodes,
                     *(fetched[level, i] for i in range(high + 1, right + 1))]
            groups = [b"".join(whole[i:i + arity]) for i in range(0, len(whole), arity)]
            self.groups.append((low // arity, groups))
            nodes = [sha(g) for g in groups]                     # interiors shared by the run's leaves
            low, high, n, level = low // arity, high // arity, -(-n // arity), level + 1
        self.top = nodes[0]
        self._rest: list[dict[int, bytes]] = [{} for _ in range(len(self.groups) + 1)]

    def siblings(self, level: int, idx: int) -> bytes:
        """Siblings of a node, and of its ancestors, level by level."""
        if level == len(self.groups):
            return b""
        known = self._rest[level].get(idx) if level else None
        if known is None:
            up, at = divmod(idx, self.arity)
            first, groups = self.groups[level]
            group = groups[up - first]
            known = group[:64 * at] + group[64 * at + 64:] + self.siblings(level + 1, up)
            if level:
                self._rest[level][idx] = known
        return known

    def fold(self, idx: int, node: bytes) -> bytes:
        """The top when a lowest node is ``node`` and its siblings are as they are."""
        for first, groups in self.groups:
            idx, at = divmod(idx, self.arity)
            group = groups[idx - first]
            node = sha(group[:64 * at] + node + group[64 * at + 64:])
        return node


def _expand(arity: int):
    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        own = own.sort_by("row")
        fetched: dict[int, dict] = {}
        for tree, level, idx, node in zip(*[got.column(c).to_pylist() for c in ("tree", "level", "idx", "hash")]):
            fetched.setdefault(tree, {})[level, idx] = node.encode()
        tree = own.column("tree").to_numpy()
        leaf = [x.encode() for x in own.column("leaf").to_pylist()]
        bad = [x and x.encode() for x in own.column("tampered").to_pylist()]
        edges = np.r_[0, np.flatnonzero(tree[1:] != tree[:-1]) + 1, len(tree)]
        total, idx_of = own.column("total").to_numpy(), own.column("idx").to_numpy()
        strands = [Strand(int(idx_of[a]), leaf[a:b], int(total[a]), fetched.get(int(tree[a]), {}), arity)
                   for a, b in zip(edges[:-1], edges[1:])]
        trees = int(own.column("trees")[0].as_py())
        roof = Strand(int(tree[0]), [s.top for s in strands], trees, fetched.get(TOP, {}), arity)
        out = []
        for s, a, b in zip(strands, edges[:-1], edges[1:]):
            number = int(tree[a])
            over = roof.siblings(0, number)
            for i in range(a, b):
                idx = s.low + int(i - a)
                folded = roof.fold(number, s.fold(idx, bad[i] or leaf[i]))
                out.append((s.top.decode(), sha(s.siblings(0, idx) + over).decode(), folded.decode()))
        subroot, proof, folded = (pa.array(x, pa.string()) for x in zip(*out))
        root = roof.top.decode()
        return pa.Table.from_arrays(
            [own.column("doc_id"), own.column("leaf"), subroot, pa.array([root] * len(out)), proof, folded,
             pa.array([x[2] == root for x in out])],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def manifest(docs: DataFrame, every: int = EVERY, arity: int = ARITY, block: int = LEAVES) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    placed = leaves(docs, every, block)
    stretches = runs(placed)
    pairs = stretches.select(F.col("part").alias("_part"), F.col("source").alias("_source"),
                             "tree", "total", "start", "first_row")
    at = placed.join(pairs, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
    at = cut(at.select("part", "row", "doc_id", "leaf", "tampered", "tree", "total",
                       (F.col("start") + F.col("row") - F.col("first_row")).alias("idx")), "placed")
    trees = build(at.select("tree", F.lit(0).cast("long").alias("level"), "idx", F.col("leaf").alias("hash"),
                            F.col("total").alias("n")), arity)
    count = stretches.agg(F.countDistinct("tree")).scalar()
    tops = trees.where("n = 1").select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).cast("long").alias("level"),
                                       F.col("tree").alias("idx"), "hash")
    roof = build(cut(tops.withColumn("n", count), "subroots"), arity)
    nodes = trees.unionByName(roof).select("tree", "level", "idx", "hash")

    own = stretches.select("part", "tree", F.col("start").alias("low"),
                           (F.col("start") + F.col("n") - 1).alias("high"), "total")
    top = (stretches.groupBy("part").agg(F.min("tree").alias("low"), F.max("tree").alias("high"))
           .select("part", F.lit(TOP).cast("long").alias("tree"), "low", "high", count.alias("total")))
    asked = cut(own.unionByName(top).mapInArrow(
        _requests(arity), "part long, tree long, level long, idx long"), "asked")
    got = asked.join(nodes, ["tree", "level", "idx"]).select("part", "tree", "level", "idx", "hash")
    return (at.withColumn("trees", count).groupBy("part").cogroup(got.groupBy("part"))
            .applyInArrow(_expand(arity), PROOFS))


def _sql(levels: int = 7, roof: int = 4, arity: int = ARITY) -> str:
    """The same by group strings, level by level, up to ``arity ** levels`` leaves a source."""
    def framed(x):
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"

    def climb(name, base, depth):
        """CTEs <name>g<k>: the groups of level k; <name><k+1>: the nodes above."""
        out, below = [], base
        for k in range(depth):
            out.append(f"{name}g{k} AS (SELECT tree, idx // {arity} AS up, string_agg(h, '' ORDER BY idx) AS g,"
                       f" min(n) AS n FROM {below} GROUP BY tree, idx // {arity})")
            out.append(f"{name}{k + 1} AS (SELECT tree, up AS idx, CASE WHEN n > 1 THEN sha256(g) ELSE g END AS h,"
                       f" (n + {arity - 1}) // {arity} AS n FROM {name}g{k})")
            below = f"{name}{k + 1}"
        return out, below

    def walk(name, base, depth, tree, idx):
        """CTEs that carry ``sib`` and ``f`` of every document up through the groups."""
        out, below = [], base
        for k in range(depth):
            at = f"(({idx} // {arity ** k}) % {arity})"
            cutout = f"substr(g.g, 1, CAST(64 * {at} AS INTEGER)), {{}} substr(g.g, CAST(64 * {at} + 65 AS INTEGER))"
            out.append(
                f"{name}w{k} AS (SELECT d.* EXCLUDE (sib, f),"
                f" CASE WHEN g.n > 1 THEN concat(d.sib, {cutout.format('')}) ELSE d.sib END AS sib,"
                f" CASE WHEN g.n > 1 THEN sha256(concat({cutout.format('d.f,')})) ELSE d.f END AS f"
                f" FROM {below} d JOIN {name}g{k} g ON g.tree = {tree} AND g.up = {idx} // {arity ** (k + 1)})")
            below = f"{name}w{k}"
        return out, below

    head = ", ".join(framed(c) for c in FIELDS[:-1])
    crc = ["c0 AS (SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS c FROM range(256))"]
    crc += [f"c{k + 1} AS (SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END AS c FROM c{k})"
            for k in range(8)]
    low, top = climb("a", "a0", levels)
    high, root = climb("b", "b0", roof)
    up, mid = walk("a", "d0", levels, "d.tree", "d.idx")
    over, end = walk("b", mid, roof, "0", "d.tree")
    return "WITH RECURSIVE " + ",\n".join([
        *crc,
        "ids AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)",
        """crc AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 1 AS i, CAST(4294967295 AS BIGINT) AS c FROM ids
  UNION ALL SELECT r.doc_id, r.s, r.i + 1, xor(t.c, r.c // 256)
  FROM crc r JOIN c8 t ON t.i = xor(r.c % 256, CAST(ascii(substr(r.s, r.i, 1)) AS BIGINT)) WHERE r.i <= length(r.s))""",
        f"hit AS (SELECT doc_id FROM crc WHERE i = length(s) + 1 AND xor(c, 4294967295) % {EVERY} = 0)",
        f"""h0 AS (SELECT d.doc_id, d.source, sha256(concat({head}, {framed('d.text')})) AS leaf,
  CASE WHEN hit.doc_id IS NULL THEN NULL ELSE
    sha256(concat({head}, {framed(f"translate(d.text, '{UPPER}', '{LOWER}')")})) END AS tampered
  FROM documents d LEFT JOIN hit ON hit.doc_id = d.doc_id)""".replace("CAST(doc_id", "CAST(d.doc_id").replace(
            "CASE WHEN doc_id", "CASE WHEN d.doc_id"),
        "trees AS (SELECT source, count(*) AS total, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree"
        " FROM documents GROUP BY source)",
        """d0 AS (SELECT h.doc_id, h.leaf, t.tree, t.total, '' AS sib, coalesce(h.tampered, h.leaf) AS f,
  row_number() OVER (PARTITION BY t.tree ORDER BY h.doc_id NULLS FIRST, h.leaf) - 1 AS idx
  FROM h0 h JOIN trees t ON t.source IS NOT DISTINCT FROM h.source)""",
        "a0 AS (SELECT tree, idx, leaf AS h, total AS n FROM d0)", *low,
        f"b0 AS (SELECT 0 AS tree, tree AS idx, h, (SELECT count(*) FROM trees) AS n FROM {top})", *high,
        *up, *over]) + f"""
SELECT e.doc_id, e.leaf, s.h AS subroot, r.h AS root, sha256(e.sib) AS proof_sha256, e.f AS folded_root,
  e.f = r.h AS verified
FROM {end} e JOIN {top} s ON s.tree = e.tree, {root} r"""


SQL = _sql()
