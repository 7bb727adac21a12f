"""Descriptive statistics, value counts, grouped summaries, KPIs and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.operators import quantiles as Q


def keyed(df: DataFrame, *keys: str):
    """groupBy that leaves out rows with a NULL key."""
    return df.where(C.all_present(*keys)).groupBy(*keys)


# --- describe -----------------------------------------------------------------

def describe(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """count, mean, sample sd, min, quartiles and max, one row per column.

    Columns that are absent are skipped. All of them are summarised together:
    unpivoted, then grouped by feature name.
    """
    present = [c for c in columns if c in df.columns]
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in present], "feature", "value")
    moments = (long.where(F.col("value").isNotNull()).groupBy("feature")
                   .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")))
    spread = Q.quantiles(long, "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], ["feature"], Q.FEW)
    r = C.round_half_even
    return (spread.join(moments, "feature")
                  .select("feature", F.col("rows").alias("count"),
                          r("mean", digits).alias("mean"), r("std", digits).alias("std"),
                          r("lo", digits).alias("min"), r("q25", digits).alias("q25"),
                          r("q50", digits).alias("q50"), r("q75", digits).alias("q75"),
                          r("hi", digits).alias("max")))


def value_counts(df: DataFrame, column: str, name: str = "count",
                 top: int | None = None) -> DataFrame:
    """Non-NULL value counts, most frequent first, ties by value."""
    out = keyed(df, column).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc(column))
    return out if top is None else out.limit(top)


def table_shapes(products: DataFrame, workers: DataFrame) -> DataFrame:
    def shape(df, name):
        return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"),
                      F.lit(len(df.columns)).alias("column_count"))
    return shape(products, "products").unionAll(shape(workers, "workers"))


# --- grouped summaries --------------------------------------------------------

def _operation_totals(digits: int | None = 2) -> list[Column]:
    mean = C.mean_seconds("duration_sec_final")
    return [F.count("process").alias("total_ops"),
            C.total("quantity_pcs").alias("total_qty"),
            (mean if digits is None else C.round_half_even(mean, digits)).alias("avg_duration")]


def product_period(df: DataFrame, period: str) -> DataFrame:
    """Operations, quantity, mean duration and distinct workers per date or week."""
    return keyed(df, period).agg(*_operation_totals(),
                                 F.count_distinct("worker").alias("unique_workers"))


def worker_productivity(df: DataFrame, digits: int | None = 2) -> DataFrame:
    """Per worker; ``digits=None`` keeps the mean duration unrounded."""
    out = keyed(df, "worker").agg(*_operation_totals(digits),
                                  F.count_distinct("date").alias("active_days"))
    return out.withColumn(
        "ops_per_day", C.round_half_even(C.ratio("total_ops", "active_days"), 1))


def product_comparison(df: DataFrame) -> DataFrame:
    return keyed(df, "product_label").agg(
        *_operation_totals(),
        F.count_distinct("worker").alias("unique_workers"),
        F.count_distinct("process").alias("unique_processes"))


def employee_period(df: DataFrame, period: str) -> DataFrame:
    """Actions and mean response per employee and date or week."""
    return keyed(df, "employee_name", period).agg(
        F.count("dialog_type").alias("total_actions"),
        C.round_half_even(C.mean_seconds("response_time_sec"), 2).alias("avg_response_sec"))


def kpi_overview(products: DataFrame, workers: DataFrame) -> DataFrame:
    """The six headline numbers in one row."""
    w = workers.agg(F.struct(F.count("*").alias("employee_actions"),
                             F.count_distinct("employee_name").alias("active_employees")))
    return (products.agg(F.count("*").alias("operations"),
                         C.mean_seconds("duration_sec_final").alias("avg_duration"),
                         C.total("quantity_pcs").alias("total_quantity"),
                         F.count_distinct("worker").alias("active_workers"))
                    .withColumn("w", w.scalar())
                    .select("operations", "w.employee_actions", "avg_duration",
                            "total_quantity", "active_workers", "w.active_employees"))


def product_kpis(df: DataFrame) -> DataFrame:
    return keyed(df, "product_label").agg(
        F.count("*").alias("operations"), C.total("quantity_pcs").alias("quantity"),
        C.mean_seconds("duration_sec_final").alias("avg_duration"),
        F.count_distinct("worker").alias("workers"))


def _one_worker(df: DataFrame, worker: str | None) -> DataFrame:
    return df if worker is None else df.where(F.col("worker") == worker)


def worker_detail_kpis(df: DataFrame, worker: str | None = None) -> DataFrame:
    """Drill-down numbers for one worker, or for every worker at once."""
    return keyed(_one_worker(df, worker), "worker").agg(
        F.count("*").alias("total_ops"), C.total("quantity_pcs").alias("total_qty"),
        C.mean_seconds("duration_sec_final").alias("avg_duration"),
        F.count_distinct("date").alias("active_days"))


def worker_detail_daily(df: DataFrame, worker: str | None = None) -> DataFrame:
    return keyed(_one_worker(df, worker), "worker", "date").agg(F.count("*").alias("ops"))


def worker_detail_mix(df: DataFrame, worker: str | None = None) -> DataFrame:
    return keyed(_one_worker(df, worker), "worker", "process").agg(F.count("*").alias("count"))


def employee_scorecard(df: DataFrame) -> DataFrame:
    """Per employee name; sessions are counted as distinct ids under that name."""
    out = keyed(df, "employee_name").agg(
        F.count("dialog_type").alias("total_actions"),
        C.mean_seconds("response_time_sec").alias("avg_response_sec"),
        F.count_distinct("date").alias("active_days"),
        F.count_distinct("session_id").alias("total_sessions"))
    return out.withColumn(
        "actions_per_day", C.round_half_even(C.ratio("total_actions", "active_days"), 1))


# --- trends and rankings ------------------------------------------------------

TREND_PERIODS = {"daily": "date", "weekly": "week_number"}
TREND_METRICS = {
    "count": lambda: F.count("process"),
    "qty": lambda: C.total("quantity_pcs"),
    "duration": lambda: C.mean_seconds("duration_sec_final"),
}


def trend(df: DataFrame, grain: str = "daily", metric: str = "count",
          split: bool = True) -> DataFrame:
    """One metric per day or week, optionally split by product."""
    keys = [TREND_PERIODS[grain]] + (["product_label"] if split else [])
    return keyed(df, *keys).agg(TREND_METRICS[metric]().alias("value"))


def rank_workers(df: DataFrame, metric: str = "total_ops", top: int = 20) -> DataFrame:
    """Top workers by a productivity metric; ties by operations, then by name."""
    if metric not in S.RANK_METRICS:
        raise ValueError(f"metric must be one of {S.RANK_METRICS}")
    stats = worker_productivity(df, digits=None).where(F.col(metric).isNotNull())
    order = [F.desc(metric)] + ([] if metric == "total_ops" else [F.desc("total_ops")])
    return stats.orderBy(*order, F.asc("worker")).limit(top)


def top_workers_with_quantity(df: DataFrame, top: int = 15) -> DataFrame:
    return (keyed(df, "worker")
            .agg(F.count("process").alias("total_ops"), C.total("quantity_pcs").alias("total_qty"))
            .orderBy(F.desc("total_ops"), F.asc("worker")).limit(top))
