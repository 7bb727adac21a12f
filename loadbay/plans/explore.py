"""Exploration job: every summary, chart dataset and anomaly table of both logs.

Each entry is a lazy DataFrame over prepared tables; nothing runs until the caller
writes or shows it. ``write_report`` writes them all as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from loadbay import schemas as S
from loadbay.operators import anomalies as A
from loadbay.operators import correlation, datasets, distribution, summaries


def product_report(p: DataFrame) -> dict[str, DataFrame]:
    return {
        "describe": summaries.describe(p, S.PRODUCT_DESCRIBE),
        "label_counts": summaries.value_counts(p, "product_label"),
        "top_workers_by_rows": summaries.value_counts(p, "worker", top=10),
        "process_counts": summaries.value_counts(p, "process"),
        "daily": summaries.product_period(p, "date").orderBy("date"),
        "weekly": summaries.product_period(p, "week_number").orderBy("week_number"),
        "worker_productivity": summaries.worker_productivity(p).orderBy(
            summaries.F.desc("total_ops"), "worker"),
        "product_comparison": summaries.product_comparison(p),
        "daily_ops_by_product": datasets.counts(p, "date", "product_label", name="ops_count"),
        "daily_qty_by_product": datasets.daily_quantity(p),
        "process_by_product": datasets.counts(p, "process", "product_label"),
        "hourly_by_product": datasets.counts(p, "product_label", "hour"),
        "duration_histogram": distribution.histogram(p, "duration_sec_final"),
        "top15_workers": summaries.top_workers_with_quantity(p),
        "correlation": correlation.correlation(p, S.PRODUCT_CORRELATION),
        "weekday_box": weekday_box(p),
        "anomalous_days": A.anomalous_days(p),
        "anomaly_bands": A.operation_bands(p),
        "duration_outlier_rates": A.outlier_rates(p, "duration_sec_final"),
        "top_duration_outliers": A.top_outliers(p, "duration_sec_final", A.DURATION_TOP),
        "duration_box": distribution.box_stats(p, "duration_sec_final"),
    }


def worker_report(w: DataFrame) -> dict[str, DataFrame]:
    return {
        "describe": summaries.describe(w, S.WORKER_DESCRIBE),
        "employee_counts": summaries.value_counts(w, "employee_name"),
        "dialog_counts": summaries.value_counts(w, "dialog_type"),
        "top_devices": summaries.value_counts(w, "device", top=10),
        "daily": summaries.employee_period(w, "date"),
        "weekly": summaries.employee_period(w, "week_number"),
        "daily_actions": datasets.counts(w, "date", "employee_name", name="actions"),
        "response_histogram": distribution.histogram(
            w, "response_time_sec", ["employee_name"], cap="group"),
        "hourly_actions": datasets.counts(w, "employee_name", "hour", name="actions"),
        "dialog_by_employee": datasets.counts(w, "dialog_type", "employee_name"),
        "correlation": correlation.correlation(w, S.WORKER_CORRELATION),
        "weekly_actions": datasets.counts(w, "employee_name", "week_number", name="actions"),
        "anomalous_days": A.anomalous_employee_days(w),
        "anomaly_bands": A.employee_bands(w),
        "response_outlier_rates": A.outlier_rates(w, "response_time_sec"),
        "top_response_outliers": A.top_outliers(w, "response_time_sec", A.RESPONSE_TOP),
        "response_histogram_capped": distribution.histogram(
            w, "response_time_sec", ["employee_name"], cap="global"),
    }


def weekday_box(p: DataFrame) -> DataFrame:
    """Box statistics of operations per day, by weekday."""
    daily = datasets.counts(p, "date", "weekday_name", "day_of_week", name="ops")
    return distribution.box_stats(daily, "ops", ["weekday_name"])


def write_report(report: dict[str, DataFrame], out_dir: str) -> None:
    for name, df in report.items():
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
