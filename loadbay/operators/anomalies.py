"""Anomalous days and outlying durations or response times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.functions import masks as M
from loadbay.operators import quantiles as Q
from loadbay.operators.datasets import counts
from loadbay.operators.summaries import keyed


def day_stats(daily: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """mean, sd, q1, q3 of a per-day frame (bounded by the calendar per group)."""
    return daily.groupBy(*by).agg(
        F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
                 F.percentile(value, F.lit(0.25)).alias("q1"),
                 F.percentile(value, F.lit(0.75)).alias("q3")).alias("stats"))


def with_day_stats(daily: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    if by:
        return daily.join(day_stats(daily, value, by), list(by))
    return daily.withColumn("stats", day_stats(daily, value).scalar())


def detail_stats(df: DataFrame, value: str):
    """The same struct over detail rows, as a scalar column."""
    spread = Q.quantiles(df, value, [0.25, 0.75], ["q1", "q3"])
    q = spread.select(F.struct("q1", "q3")).scalar()
    moments = (df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
                 .withColumn("q", q))
    return moments.select(F.struct("mean", "sd", "q.q1", "q.q3")).scalar()


# --- days ---------------------------------------------------------------------

def anomalous_days(products: DataFrame) -> DataFrame:
    """Dates with unusual operation counts, by either rule, with both flags."""
    daily = with_day_stats(counts(products, "date", name="ops"), "ops")
    x, stats = F.col("ops"), F.col("stats")
    flagged = daily.select("date", "ops", M.zscore_mask(x, stats).alias("anomaly_zscore"),
                           M.iqr_mask(x, stats).alias("anomaly_iqr"))
    return flagged.where(F.col("anomaly_zscore") | F.col("anomaly_iqr"))


def daily_operations(products: DataFrame) -> DataFrame:
    return keyed(products, "date").agg(
        F.count("process").alias("ops"), C.total("quantity_pcs").alias("qty"),
        C.mean_seconds("duration_sec_final").alias("avg_dur"))


def anomalous_operation_days(products: DataFrame, method: str = "Combined",
                             z: float = S.Z_DAILY, factor: float = S.IQR_FACTOR) -> DataFrame:
    daily = with_day_stats(daily_operations(products), "ops")
    hit = M.anomaly_mask(F.col("ops"), F.col("stats"), method, z, factor)
    return daily.where(hit).select("date", "ops", "qty",
                                   C.round_half_even("avg_dur", 2).alias("avg_dur"))


def anomalous_employee_days(workers: DataFrame) -> DataFrame:
    """Per employee, against that employee's own daily statistics; both flags."""
    daily = with_day_stats(counts(workers, "employee_name", "date", name="actions"),
                           "actions", ["employee_name"])
    x, stats = F.col("actions"), F.col("stats")
    flagged = daily.select("employee_name", "date", "actions",
                           M.zscore_mask(x, stats).alias("anomaly_z"),
                           M.iqr_mask(x, stats).alias("anomaly_iqr"))
    return flagged.where(F.col("anomaly_z") | F.col("anomaly_iqr"))


def anomalous_employee_days_by(workers: DataFrame, method: str = "Combined",
                               z: float = S.Z_DAILY, factor: float = S.IQR_FACTOR) -> DataFrame:
    daily = with_day_stats(counts(workers, "employee_name", "date", name="actions"),
                           "actions", ["employee_name"])
    hit = M.anomaly_mask(F.col("actions"), F.col("stats"), method, z, factor)
    return daily.where(hit).select("employee_name", "date", "actions")


def bands(daily: DataFrame, value: str, by: Sequence[str] = (), z: float = S.Z_DAILY) -> DataFrame:
    """Reference lines: mean, mean + z sd, and mean - z sd but not below zero."""
    mean, sd = F.col("stats.mean"), F.col("stats.sd")
    upper, lower = mean + F.lit(z) * sd, mean - F.lit(z) * sd
    return day_stats(daily, value, by).select(
        *by, mean.alias("mean"), sd.alias("sd"), upper.alias("upper"),
        C.not_negative(lower).alias("lower"))


def operation_bands(products: DataFrame, z: float = S.Z_DAILY) -> DataFrame:
    return bands(counts(products, "date", name="ops"), "ops", z=z)


def employee_bands(workers: DataFrame, z: float = S.Z_DAILY) -> DataFrame:
    daily = counts(workers, "employee_name", "date", name="actions")
    return bands(daily, "actions", ["employee_name"], z)


# --- detail rows --------------------------------------------------------------

def outlier_rates(df: DataFrame, value: str, z: float = S.Z_DETAIL,
                  factor: float = S.IQR_FACTOR) -> DataFrame:
    """How many rows each rule flags, and the percentage of non-missing rows."""
    present = df.where(F.col(value).isNotNull()).select(value)
    flagged = present.withColumn("stats", detail_stats(df, value))
    x, stats = F.col(value), F.col("stats")
    out = flagged.agg(F.count("*").alias("total"),
                      F.count_if(M.zscore_mask(x, stats, z)).alias("outliers_z"),
                      F.count_if(M.iqr_mask(x, stats, factor)).alias("outliers_iqr"))
    pct = lambda c: C.round_half_even(C.ratio(c, "total") * 100, 2)
    return out.select("total", "outliers_z", pct("outliers_z").alias("pct_z"),
                      "outliers_iqr", pct("outliers_iqr").alias("pct_iqr"))


def outlier_summary(df: DataFrame, value: str, method: str = "Combined",
                    z: float = S.Z_DAILY, factor: float = S.IQR_FACTOR) -> DataFrame:
    """Total, flagged rows and percentage for a chosen rule; safe on no rows."""
    present = df.where(F.col(value).isNotNull()).select(value)
    flagged = present.withColumn("stats", detail_stats(df, value))
    hit = M.anomaly_mask(F.col(value), F.col("stats"), method, z, factor)
    out = flagged.agg(F.count("*").alias("total"), F.count_if(hit).alias("outliers"))
    pct = F.col("outliers") / F.greatest("total", F.lit(1)) * 100
    return out.withColumn("outlier_pct", C.round_half_even(pct, 2))


def top_outliers(df: DataFrame, value: str, columns: Sequence[str], top: int = 10,
                 method: str = "Combined", z: float = S.Z_DETAIL,
                 factor: float = S.IQR_FACTOR) -> DataFrame:
    """The largest flagged rows; ties ordered by the remaining columns."""
    flagged = df.where(F.col(value).isNotNull()).withColumn("stats", detail_stats(df, value))
    hit = M.anomaly_mask(F.col(value), F.col("stats"), method, z, factor)
    ties = [F.asc_nulls_last(c) for c in columns if c != value]
    return flagged.where(hit).select(*columns).orderBy(F.desc(value), *ties).limit(top)


DURATION_TOP = ("start_time", "worker", "process", "product_label", "duration_sec_final")
DURATION_TOP_WIDE = (*DURATION_TOP, "quantity_pcs")
RESPONSE_TOP = ("input_date", "employee_name", "dialog_type", "response_time_sec")
RESPONSE_TOP_WIDE = ("input_date", "employee_name", "dialog_type",
                     "screen_heading", "response_time_sec")
