"""Outlier masks as column expressions over a statistics struct.

The struct carries ``mean``, ``sd``, ``q1`` and ``q3``; it comes either from a
scalar subquery (one population) or from a per-group join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadbay import schemas as S


def zscore_mask(x: Column, stats: Column, threshold: float = S.Z_DAILY) -> Column:
    """|x - mean| > threshold * sd; never true when sd is zero or undefined."""
    sd = F.nullif(stats["sd"], F.lit(0.0))
    return F.coalesce(F.abs(x - stats["mean"]) / sd > F.lit(threshold), F.lit(False))


def iqr_mask(x: Column, stats: Column, factor: float = S.IQR_FACTOR) -> Column:
    """Strictly outside the quartile fences."""
    reach = (stats["q3"] - stats["q1"]) * F.lit(factor)
    outside = (x < stats["q1"] - reach) | (x > stats["q3"] + reach)
    return F.coalesce(outside, F.lit(False))


def anomaly_mask(
    x: Column, stats: Column, method: str = "Combined",
    z: float = S.Z_DAILY, factor: float = S.IQR_FACTOR,
) -> Column:
    """``"Z-Score"``, ``"IQR"``, and either of the two for any other method."""
    if method == "Z-Score":
        return zscore_mask(x, stats, z)
    if method == "IQR":
        return iqr_mask(x, stats, factor)
    return zscore_mask(x, stats, z) | iqr_mask(x, stats, factor)
