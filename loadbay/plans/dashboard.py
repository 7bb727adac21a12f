"""The tables of the interactive pages, over a filtered pair of prepared tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from loadbay import schemas as S
from loadbay.operators import anomalies as A
from loadbay.operators import correlation, datasets, distribution, filters, summaries
from loadbay.plans.explore import weekday_box


@dataclass(frozen=True)
class AnomalySettings:
    """Method and thresholds; z from 1.5 to 4, factor from 1 to 3 on the page."""

    method: str = "Combined"
    z: float = S.Z_DAILY
    factor: float = S.IQR_FACTOR


def overview(p: DataFrame, w: DataFrame) -> dict[str, DataFrame]:
    return {
        "kpis": summaries.kpi_overview(p, w),
        "ops_trend": datasets.counts(p, "date", name="ops"),
        "actions_trend": datasets.counts(w, "date", name="actions"),
        "product_split": datasets.product_split(p),
        "top_workers": summaries.value_counts(p, "worker", "ops", top=10),
        "top_processes": summaries.value_counts(p, "process", top=10),
        "hour_heatmap": datasets.hour_heatmap(p),
    }


def operations(p: DataFrame, grain: str = "daily", metric: str = "count",
               split: bool = True) -> dict[str, DataFrame]:
    by = ["product_label"] if split else []
    return {
        "trend": summaries.trend(p, grain, metric, split),
        "process_volume": datasets.counts(p, "process", *by),
        "duration_histogram": distribution.histogram(p, "duration_sec_final", by),
        "duration_box": distribution.box_stats(p, "duration_sec_final", by),
        "weekday_box": weekday_box(p),
        "hourly": datasets.counts(p, "hour", *by),
    }


def products(p: DataFrame) -> dict[str, DataFrame]:
    return {
        "kpis": summaries.product_kpis(p),
        "daily_ops": datasets.counts(p, "date", "product_label", name="ops"),
        "daily_qty": datasets.daily_quantity(p),
        "duration_box": distribution.box_stats(p, "duration_sec_final", ["product_label"]),
        "correlation": correlation.correlation(p, S.PRODUCT_CORRELATION_SHORT, digits=2),
    }


def workforce(p: DataFrame, w: DataFrame, rank_by: str = "total_ops", top: int = 20,
              worker: str | None = None) -> dict[str, DataFrame]:
    by = ["employee_name"]
    return {
        "ranking": summaries.rank_workers(p, rank_by, top),
        "worker_statistics": summaries.worker_productivity(p),
        "worker_kpis": summaries.worker_detail_kpis(p, worker),
        "worker_daily": summaries.worker_detail_daily(p, worker),
        "worker_mix": summaries.worker_detail_mix(p, worker),
        "scorecard": summaries.employee_scorecard(w),
        "daily_actions": datasets.counts(w, "date", "employee_name", name="actions"),
        "hourly_actions": datasets.counts(w, "hour", "employee_name", name="actions"),
        "dialogs": datasets.counts(w, "dialog_type", "employee_name"),
        "response_histogram": distribution.histogram(w, "response_time_sec", by, cap="global"),
        "response_box": distribution.box_stats(w, "response_time_sec", by),
        "weekly_actions": datasets.counts(w, "week_number", "employee_name", name="actions"),
        "correlation": correlation.correlation(w, S.WORKER_CORRELATION_SHORT, digits=2),
    }


def anomalies(p: DataFrame, w: DataFrame,
              settings: AnomalySettings = AnomalySettings()) -> dict[str, DataFrame]:
    how = {"method": settings.method, "z": settings.z, "factor": settings.factor}
    return {
        "operation_days": A.anomalous_operation_days(p, **how),
        "operation_bands": A.bands(A.daily_operations(p), "ops", z=settings.z),
        "duration_summary": A.outlier_summary(p, "duration_sec_final", **how),
        "duration_top": A.top_outliers(p, "duration_sec_final", A.DURATION_TOP_WIDE, 20, **how),
        "duration_box": distribution.box_stats(p, "duration_sec_final", ["product_label"]),
        "employee_days": A.anomalous_employee_days_by(w, **how),
        "employee_bands": A.employee_bands(w, settings.z),
        "response_summary": A.outlier_summary(w, "response_time_sec", **how),
        "response_top": A.top_outliers(w, "response_time_sec", A.RESPONSE_TOP_WIDE, 20, **how),
    }


def data_explorer(p: DataFrame, w: DataFrame, product_columns: Sequence[str] = S.PRODUCT_EXPLORE,
                  worker_columns: Sequence[str] = S.WORKER_EXPLORE) -> dict[str, DataFrame]:
    return {"products": filters.explore(p, product_columns),
            "workers": filters.explore(w, worker_columns)}
