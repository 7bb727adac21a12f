"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). Raking finds one factor per source, per
language and per topic such that the weighted tokens meet all three target marginals. Languages
and topics are few, so their factors and the language x topic table live on the driver; sources
may be many, so their factors stay in a table with one row per source, and a round is one pass
over that table: source factors from the current ones, then the language x topic sums they give.
A document is kept with probability min(1, rate * factor of its cell), decided by a hash of its
doc_id; where that is capped at one, the remainder is its weight, so weighted tokens meet the
targets either way.

Targets default to the observed shares raised to a power below one (flattened) and renormalised.

Defined cases: a null source or language is a category of its own, ``(none)``; null and empty
texts have no token and take the factor of their cell, or 1 where the cell has no token at all;
rows without a doc_id are decided by a hash of the text; repeated rows share a decision; an
empty table gives an empty one. Columns of the input named mix_topic, mix_prob or mix_weight are
replaced; all others stay, whatever their names.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadbay.session import cut

ROUNDS = 40
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
RATE = 0.5
NONE = "(none)"
WORKING = {"_source", "_lang", "_topic", "_tokens", "_u", "_mix_source", "_mix_lang", "_mix_topic", "_mix_factor"}
ADDED = {"mix_topic", "mix_prob", "mix_weight"}
# What a text is about, by what stands in it; the first that holds.
TOPICS = [("legal", "(?i)licen[sc]e|copyright"), ("contact", "@|https?://"), ("tables", r"\|"),
          ("figures", "[0-9]{3}"), ("prose", "")]


def topic_of(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS[:-1]):
        out = F.when(F.regexp_like(text, F.lit(pattern)), F.lit(name)).otherwise(out)
    return F.when(text.isNull(), F.lit(NONE)).otherwise(out)


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 32))


def described(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """docs with _source, _lang, _topic, _tokens and _u, the number its decision hangs on."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    return docs.withColumns({
        "_source": F.coalesce("source", F.lit(NONE)), "_lang": F.coalesce("lang", F.lit(NONE)),
        "_topic": topic if topic is not None else topic_of(F.col("text")),
        "_tokens": F.coalesce(F.regexp_count("text", F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long"),
        "_u": _number(F.substring(F.md5(key), 1, 8))})


def tempered(share: np.ndarray, power: float) -> np.ndarray:
    p = np.where(share > 0, share, 1.0) ** power * (share > 0)
    return p / max(p.sum(), 1e-300)


def rake(cells: DataFrame, powers: dict[str, float] = POWERS, rounds: int = ROUNDS) -> DataFrame:
    """cells (_source, _lang, _topic, w) with the column factor."""
    held = cut(cells.where("w > 0").groupBy("_source").agg(
        F.sum("w").alias("mass"), F.collect_list(F.struct("_lang", "_topic", "w")).alias("cells")), "cells")
    # at most languages x topics rows
    table = held.select(F.explode("cells").alias("c")).groupBy("c._lang", "c._topic").agg(
        F.sum("c.w").alias("w")).collect()
    if not table:
        return cells.withColumn("factor", F.lit(1.0))
    langs, topics = sorted({r["_lang"] for r in table}), sorted({r["_topic"] for r in table})
    m = np.zeros((len(langs), len(topics)))
    for r in table:
        m[langs.index(r["_lang"]), topics.index(r["_topic"])] = r["w"]
    total = m.sum()
    goal_l, goal_t = tempered(m.sum(axis=1) / total, powers["lang"]), tempered(m.sum(axis=0) / total, powers["topic"])
    flat = held.agg(F.sum(F.pow(F.col("mass") / total, F.lit(powers["source"]))).alias("z")).first()["z"]
    goal_s = F.pow(F.col("mass") / total, F.lit(powers["source"])) / F.lit(float(flat))
    b, c = np.ones(len(langs)), np.ones(len(topics))

    def source_factor() -> Column:
        fb = F.create_map(*[F.lit(v) for n, x in zip(langs, b) for v in (n, float(x))])
        fc = F.create_map(*[F.lit(v) for n, x in zip(topics, c) for v in (n, float(x))])
        spread = F.aggregate("cells", F.lit(0.0), lambda s, x: s + x["w"] * fb[x["_lang"]] * fc[x["_topic"]])
        return goal_s * F.lit(float(total)) / spread

    for _ in range(rounds):
        now = held.withColumn("a", source_factor()).select("a", F.explode("cells").alias("c"))
        sums = now.groupBy("c._lang", "c._topic").agg(F.sum(F.col("a") * F.col("c.w")).alias("w")).collect()
        m = np.zeros((len(langs), len(topics)))
        for r in sums:
            m[langs.index(r["_lang"]), topics.index(r["_topic"])] = r["w"]
        old_b, old_c = b.copy(), c.copy()
        for _ in range(500):
            b = goal_l * total / (m @ c)
            last, c = c, goal_t * total / (b @ m)
            if np.abs(c / last - 1).max() < 1e-14:
                break
        scale = c[0]
        b, c = b * scale, c / scale
        if max(np.abs(b / old_b - 1).max(), np.abs(c / old_c - 1).max()) < 1e-12:
            break
    fb = F.create_map(*[F.lit(v) for n, x in zip(langs, b) for v in (n, float(x))])
    fc = F.create_map(*[F.lit(v) for n, x in zip(topics, c) for v in (n, float(x))])
    return (held.withColumn("a", source_factor()).select("_source", "a", F.explode("cells").alias("c"))
            .select("_source", "c._lang", "c._topic", "c.w",
                    (F.col("a") * fb[F.col("c._lang")] * fc[F.col("c._topic")]).alias("factor")))


def mixed(docs: DataFrame, powers: dict[str, float] = POWERS, rate: float = RATE,
          rounds: int = ROUNDS) -> DataFrame:
    """The documents kept, with all their columns and mix_topic, mix_prob and mix_weight."""
    names = [c for c in docs.columns if c.lower() not in ADDED]
    own = {c: f"_{uuid.uuid4().hex}" for c in names if c.lower() in WORKING}
    rows = described(docs.withColumnsRenamed(own))
    cells = cut(rows.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("w")), "cells")
    factors = cut(rake(cells, powers, rounds).select(
        *[F.col(c).alias(f"_mix{c}") for c in ("_source", "_lang", "_topic")],
        F.col("factor").alias("_mix_factor")), "factors")
    joined = rows.join(factors, (F.col("_source") == F.col("_mix_source")) & (F.col("_lang") == F.col("_mix_lang"))
                       & (F.col("_topic") == F.col("_mix_topic")), "left")
    wanted = F.coalesce("_mix_factor", F.lit(1.0)) * F.lit(rate)
    return (joined.where(F.col("_u") < wanted)
            .select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in names], F.col("_topic").alias("mix_topic"),
                    F.round(F.least(wanted, F.lit(1.0)), 6).alias("mix_prob"),
                    F.round(F.greatest(wanted, F.lit(1.0)), 6).alias("mix_weight")))


def _sql(rounds: int = 200) -> str:
    """Plain raking, one marginal after the other, until it stands still for practical purposes."""
    topic = "CASE WHEN text IS NULL THEN '(none)'" + "".join(
        f" WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS[:-1]) + " ELSE 'prose' END"
    goals = ", ".join(
        f"goal_{k} AS (SELECT {k}, pow(sum(w), {p}) / sum(pow(sum(w), {p})) OVER () AS goal FROM cells GROUP BY {k})"
        for k, p in POWERS.items())
    return f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, {topic} AS topic,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS BIGINT) AS n_tokens,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 8) AS BIGINT) / 4294967296.0 AS u
  FROM documents),
cells AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS w FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0),
{goals},
fit(n, source, lang, topic, w, f) AS (
  SELECT 0, source, lang, topic, w, CAST(1 AS DOUBLE) FROM cells
  UNION ALL
  SELECT n + 1, source, lang, topic, w, f3 FROM (
    SELECT *, f2 * gt * total / sum(w * f2) OVER (PARTITION BY topic) AS f3 FROM (
      SELECT *, f1 * gl * total / sum(w * f1) OVER (PARTITION BY lang) AS f2 FROM (
        SELECT *, f * gs * total / sum(w * f) OVER (PARTITION BY source) AS f1 FROM (
          SELECT fit.*, sum(w) OVER () AS total, s.goal AS gs, l.goal AS gl, t.goal AS gt
          FROM fit JOIN goal_source s ON s.source = fit.source JOIN goal_lang l ON l.lang = fit.lang
          JOIN goal_topic t ON t.topic = fit.topic WHERE n < {rounds}))))),
factors AS (SELECT source, lang, topic, f FROM fit WHERE n = {rounds})
SELECT doc_id, r.source, r.lang, r.topic, n_tokens,
       round(least(coalesce(f, 1) * {RATE}, 1), 6) AS prob, round(greatest(coalesce(f, 1) * {RATE}, 1), 6) AS weight
FROM rows r LEFT JOIN factors USING (source, lang, topic)
WHERE u < coalesce(f, 1) * {RATE}
"""


SQL = _sql()
