"""Exact quantiles of columns with unbounded numbers of distinct values.

Spark's ``percentile`` keeps a value -> count map of a whole group in one task. That is fine for frames
bounded by the calendar (operations per day), not for response times in microseconds. Here a
mergeable sketch, built map-side in one narrow pass, brackets every wanted rank between two values; a
second pass counts the rows below and between the brackets as a whole and those inside by value, and a
running total over these few cells names the values at the ranks. A bracket holds about ``8 / accuracy``
of a group's rows, so no task sorts a group, and no wild value widens it.

The sketch's error is bounded, hence brackets hold their ranks; should one ever not, the query stops
instead of returning another value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadbay.functions import columns as C
from loadbay.operators.features import attach

ACCURACY = 10_000          # of a group's sketch: ranks are off by at most 1 / ACCURACY of its rows
FEW = 200_000              # the same where groups are few


def sketch(rows: DataFrame, probs: Sequence[float], by: Sequence[str], accuracy: int) -> DataFrame:
    """(by..., rows, lo, hi, brackets): per probability, ascending, a struct (low, high) of values
    between which both ranks next to its position lie.

    Groups of fewer than ``accuracy`` rows are bracketed by their whole range.
    """
    reach = 4.0 / accuracy
    marks = [(max(0.0, p - reach), min(1.0, p + reach)) for p in sorted(probs)]
    flat = [x for pair in marks for x in pair]
    out = rows.groupBy(*by).agg(
        F.count("*").alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.percentile_approx("v", F.array(*[F.lit(x) for x in flat]), F.lit(accuracy)).alias("marks"))
    small = F.col("rows") < accuracy

    def end(i: int, edge: str, limit: float) -> Column:
        if flat[i] == limit:
            return F.col(edge)
        return F.when(small, F.col(edge)).otherwise(F.col("marks")[i])
    pairs = [F.struct(end(2 * i, "lo", 0.0).alias("low"), end(2 * i + 1, "hi", 1.0).alias("high"))
             for i in range(len(marks))]
    return out.select(*by, "rows", "lo", "hi", F.array(*pairs).alias("brackets"))


def cells(rows: DataFrame, limits: DataFrame, n_brackets: int, by: Sequence[str]) -> DataFrame:
    """(by..., rows, lo, hi, passed, v, n): rows by value inside a bracket, and in one cell of NULL
    value between two; ``passed`` is the number of brackets that lie wholly below."""
    if by:
        met = attach(rows, limits, list(by))
    else:
        whole = limits.select(F.struct("rows", "lo", "hi", "brackets")).scalar()
        met = rows.withColumn("s", whole).select("v", "s.rows", "s.lo", "s.hi", "s.brackets")
    each = [F.col("brackets")[i] for i in range(n_brackets)]
    inside = F.lit(False)
    for b in each:
        inside = inside | F.col("v").between(b["low"], b["high"])
    passed = sum(((b["high"] < F.col("v")).cast("int") for b in each), F.lit(0))
    return (met.select(*by, "rows", "lo", "hi", passed.alias("passed"), F.when(inside, F.col("v")).alias("v"))
               .groupBy(*by, "passed", "v")
               .agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("rows", "lo", "hi")]))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
              by: Sequence[str] = (), accuracy: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles of the non-NULL values.

    One row per group: the keys, ``rows``, ``lo``, ``hi`` and per probability the
    quantile and ``<name>_kept``, the largest value not above it. Without keys there
    is exactly one row, of NULLs if empty.
    """
    by = list(by)
    rows = df.where(C.all_present(value, *by)).select(*by, F.col(value).cast("double").alias("v"))
    limits = sketch(rows, probs, by, accuracy or (ACCURACY if by else FEW))
    counted = cells(rows, limits, len(probs), by)
    order = (Window.partitionBy(*(by or [F.lit(0)])).orderBy("passed", F.asc_nulls_first("v"))
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("upto", F.sum("n").over(order))

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("rows") - 1)

    missed = F.raise_error(F.lit("a wanted rank lies outside its bracket")).cast("double")

    def at(rank: Column) -> Column:
        hit = (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n"))
        return F.max(F.when(hit, F.coalesce("v", missed)))

    picked = ranked.groupBy(*by).agg(
        F.max("rows").alias("rows"), F.max("lo").alias("lo"), F.max("hi").alias("hi"),
        *[at(f(position(p))).alias(f"{side}_{i}")
          for i, p in enumerate(probs) for side, f in (("low", F.floor), ("high", F.ceil))])
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        between = low + (high - low) * (position(p) - F.floor(position(p)))
        out += [between.alias(name), F.when(high <= between, high).otherwise(low).alias(f"{name}_kept")]
    return picked.select(*by, "rows", "lo", "hi", *out)
