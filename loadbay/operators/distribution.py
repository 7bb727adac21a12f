"""Histograms with a tail cap, and box statistics.

Rows meet their group's limits (see ``quantiles``) and are counted map-side, never gathered by group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.operators import quantiles as Q
from loadbay.operators.features import attach


def _with(df: DataFrame, value: str, limits: DataFrame, by: list[str], names: Sequence[str]) -> DataFrame:
    """(by..., v, names...): every non-NULL value with the limits of its group."""
    rows = df.where(C.all_present(value, *by)).select(*by, F.col(value).cast("double").alias("v"))
    if by:
        return attach(rows, limits.select(*by, *names), by)
    whole = limits.select(F.struct(*names)).scalar()
    return rows.withColumn("s", whole).select("v", *[f"s.{c}" for c in names])


def tail_cap(df: DataFrame, value: str, q: float = S.TAIL_QUANTILE):
    """The global cap as a scalar column: the quantile, or the default if empty."""
    cap = Q.quantiles(df, value, [q], ["cap"]).select("cap").scalar()
    return F.coalesce(cap, F.lit(S.EMPTY_CAP))


def bin_index(x, lo, hi, bins: int):
    """Equal-width bin of x in [lo, hi], last bin closed, edges as lo + i * width."""
    width = (hi - lo) / F.lit(float(bins))
    guess = F.least(F.floor((x - lo) / (hi - lo) * F.lit(float(bins))), F.lit(bins - 1))
    return (F.when(x < lo + guess * width, guess - 1)
             .when((guess < bins - 1) & (x >= lo + (guess + 1) * width), guess + 1)
             .otherwise(guess)).cast("int")


def histogram(df: DataFrame, value: str, by: Sequence[str] = (), bins: int = S.HISTOGRAM_BINS,
              cap: str = "global", q: float = S.TAIL_QUANTILE) -> DataFrame:
    """Counts of values up to the tail cap in equal bins over each group's own range.

    ``cap`` is ``"global"`` (one quantile over all rows) or ``"group"`` (each
    group's own). Empty bins are reported as 0. A group with a single value gets
    the range half a unit around it.
    """
    by = list(by)
    if by and cap == "global":
        kept = df.where(F.col(value).cast("double") <= tail_cap(df, value, q))
        limits = (kept.where(C.all_present(value, *by)).groupBy(*by)
                      .agg(F.min(F.col(value).cast("double")).alias("lo"), F.max(F.col(value).cast("double")).alias("hi")))
        placed = _with(kept, value, limits, by, ["lo", "hi"])
    else:
        limits = Q.quantiles(df, value, [q], ["cap"], by).withColumn("hi", F.col("cap_kept"))
        placed = _with(df, value, limits, by, ["lo", "cap", "hi"]).where(F.col("v") <= F.col("cap"))
    flat = F.col("lo") == F.col("hi")
    placed = placed.select(*by, "v",
                           F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                           F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    filled = (placed.withColumn("bin", bin_index(F.col("v"), F.col("lo"), F.col("hi"), bins))
                    .groupBy(*by, "lo", "hi", "bin").agg(F.count("*").alias("n")))
    # at most ``bins`` entries per group: spread them out again with the empty ones
    found = filled.groupBy(*by, "lo", "hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    spread = found.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return spread.select(*by, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                         F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).alias("count"))


def box_stats(df: DataFrame, value: str, by: Sequence[str] = (),
              factor: float = S.IQR_FACTOR) -> DataFrame:
    """Quartiles, whiskers (furthest points inside the fences) and outlier counts."""
    by = list(by)
    names = ["q1", "median", "q3"]
    quartiles = Q.quantiles(df, value, [0.25, 0.5, 0.75], names, by)
    spread = _with(df, value, quartiles, by, ["rows", *names])
    reach = (F.col("q3") - F.col("q1")) * F.lit(factor)
    low, high = F.col("q1") - reach, F.col("q3") + reach
    outlier = (F.col("v") < low) | (F.col("v") > high)
    return (spread.groupBy(*by)
                  .agg(F.max("rows").alias("rows"), *[F.max(x).alias(x) for x in names],
                       F.min(F.when(F.col("v") >= low, F.col("v"))).alias("whisker_low"),
                       F.max(F.when(F.col("v") <= high, F.col("v"))).alias("whisker_high"),
                       F.count_if(outlier).alias("outliers")))


def outlier_points(df: DataFrame, value: str, by: Sequence[str],
                   factor: float = S.IQR_FACTOR) -> DataFrame:
    """The distinct values outside the fences and how often each occurs."""
    by = list(by)
    fences = Q.quantiles(df, value, [0.25, 0.75], ["q1", "q3"], by)
    reach = (F.col("q3") - F.col("q1")) * F.lit(factor)
    return (_with(df, value, fences, by, ["q1", "q3"])
            .where((F.col("v") < F.col("q1") - reach) | (F.col("v") > F.col("q3") + reach))
            .groupBy(*by, F.col("v").alias("value")).agg(F.count("*").alias("count")))
