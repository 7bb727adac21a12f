"""Query name -> callable(spark, sf_dir).

Analyses read prepared tables that are staged once per application in the shared
folder (``session.stage``); the queries that stand for a preparation step run that
step itself. Float results that depend on summation order are rounded to six digits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay import fixtures
from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.operators import anomalies as A
from loadbay.operators import anonymize as N
from loadbay.operators import clean, correlation, datasets, distribution, features
from loadbay.operators import filters as FL
from loadbay.operators import sessions, summaries
from loadbay.operators.ordinals import ordinals
from loadbay.plans import anonymise, explore, prepare
from loadbay.session import app_dir, materialized, stage, unstage
from loadbay.sources import prepared, raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the filter queries, shared with the SQL side.
FILTER_FROM, FILTER_TO = dt.date(1996, 3, 1), dt.date(1999, 10, 31)
FILTER_PRODUCTS = ("Brand#2", "Brand#4", "Brand#11", "Brand#17", "Brand#25")
FILTER_PROCESSES = ("100 - Goods Receipt", "341 - Shipping - Express", "SYSTEM")
SEARCH_TEXT = "pplier#0000000"
METHODS = {"z": ("Z-Score", 2.0, 1.5), "iqr": ("IQR", 2.5, 1.2), "combined": ("Combined", 2.2, 1.4)}
HEADER_LABELS = {"moves_a.csv": "A-100", "moves_b.csv": "B-200"}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: C.round_half_even(c, 6) for c in columns})


# --- inputs -------------------------------------------------------------------

def _staged(spark, sf_dir):
    def inner(key, build):
        return stage(spark, f"{sf_dir}/{key}", build)
    return inner


def raw_p(spark, sf):
    return fixtures.raw_products(spark, sf)


def raw_w(spark, sf):
    return fixtures.raw_workers(spark, sf)


def clean_p(spark, sf):
    return stage(spark, f"{sf}/clean_products", lambda: clean.clean_products(raw_p(spark, sf)))


def clean_w(spark, sf):
    return stage(spark, f"{sf}/clean_workers", lambda: clean.clean_workers(raw_w(spark, sf)))


def P(spark, sf):
    """Prepared product log."""
    return stage(spark, f"{sf}/products", lambda: prepare.prepare_products(
        raw_p(spark, sf), staged=_staged(spark, sf)), by="date", rows=lambda: clean_p(spark, sf).count())


def W(spark, sf):
    """Prepared input log."""
    return stage(spark, f"{sf}/workers", lambda: prepare.prepare_workers(
        raw_w(spark, sf), staged=_staged(spark, sf)))


def maps(spark, sf) -> anonymise.Maps:
    """The pseudonym maps, staged like the prepared tables."""
    names = stage(spark, f"{sf}/name_map", lambda: N.name_map(P(spark, sf), W(spark, sf)))
    ids = stage(spark, f"{sf}/id_map", lambda: N.employee_id_map(W(spark, sf)))
    equipment = stage(spark, f"{sf}/equipment_map", lambda: N.equipment_map(W(spark, sf), ids))
    return anonymise.Maps(names, ids, equipment)


def _folder(spark, sf, name):
    slug = "".join(ch if ch.isalnum() else "_" for ch in sf)
    return f"{app_dir(spark)}/{slug}/{name}"


# --- sources, sinks, layout ---------------------------------------------------

def _raw_exports(spark, sf):
    """The raw product log as two CSV exports with source-language headers; the
    second export lacks one column."""
    back = {v: k for k, v in S.PRODUCT_HEADERS.items()}
    rows = raw_p(spark, sf)
    paths = []
    for name, label in HEADER_LABELS.items():
        part = rows.where(F.col("source_file") == name).drop("product_label", "source_file")
        if name == "moves_b.csv":
            part = part.drop("target_mlp")
        part = part.withColumnsRenamed(back).withColumn(f"SUKL {label}", F.lit(None).cast("string"))
        path = _folder(spark, sf, name)
        part.write.mode("overwrite").csv(path, header=True, escape='"')
        paths.append(path)
    return paths


def _raw_worker_exports(spark, sf):
    back = {v: k for k, v in S.WORKER_HEADERS.items()}
    rows = raw_w(spark, sf)
    paths = []
    for name in ("inputs_1.csv", "inputs_2.csv"):
        path = _folder(spark, sf, name)
        (rows.where(F.col("source_file") == name).drop("source_file").withColumnsRenamed(back)
             .write.mode("overwrite").csv(path, header=True, escape='"', emptyValue=""))
        paths.append(path)
    return paths


@query("ingest_products")
def _(spark, sf):
    return raw.load_product_files(spark, _raw_exports(spark, sf))


@query("ingest_workers")
def _(spark, sf):
    return raw.load_worker_files(spark, _raw_worker_exports(spark, sf))


@query("product_label_from_header")
def _(spark, sf):
    df = raw.load_product_files(spark, _raw_exports(spark, sf))
    return df.groupBy("source_file", "product_label").agg(F.count("*").alias("row_count"))


@query("source_file_counts")
def _(spark, sf):
    return raw.source_file_counts(raw.load_worker_files(spark, _raw_worker_exports(spark, sf)))


@query("load_prepared_products")
def _(spark, sf):
    path = _folder(spark, sf, "prepared_products_csv")
    prepared.write_prepared(P(spark, sf), path, "csv")
    return rounded(prepared.load_products(spark, path, "csv"), "purchase_order",
                   "worker_daily_duration_sec")


@query("load_prepared_workers")
def _(spark, sf):
    path = _folder(spark, sf, "prepared_workers_csv")
    prepared.write_prepared(W(spark, sf), path, "csv")
    back = prepared.load_workers(spark, path, "csv")
    return rounded(back, *RESPONSE_FLOATS).withColumn(
        "screen_heading", F.nullif("screen_heading", F.lit("")))


@query("write_prepared")
def _(spark, sf):
    path = _folder(spark, sf, "prepared_by_date")
    prepared.write_prepared(P(spark, sf), path)
    return rounded(prepared.load_products(spark, path), "worker_daily_duration_sec")


@query("write_anonymized")
def _(spark, sf):
    """Anonymises a copy of the prepared input log in place and reads it back."""
    path = _folder(spark, sf, "anonymized_workers")
    prepared.write_prepared(W(spark, sf), path)
    m = maps(spark, sf)
    out = N.anonymize_workers(prepared.load_workers(spark, path), m.names, m.ids, m.equipment)
    prepared.replace_table(out, path, _folder(spark, sf, "anonymized_workers_staging"))
    return rounded(prepared.load_workers(spark, path), *RESPONSE_FLOATS)


def _job(spark, sf):
    """The anonymisation job over a published copy of both prepared tables."""
    def build():
        root = _folder(spark, sf, "anonymise_job")
        # CSV is not laid out by date: the test tables have a few rows a day
        prepared.publish(spark, root, {"products": P(spark, sf), "workers": W(spark, sf)}, "csv")
        # the job reads the copy; what the copy was made from would only fill the disk beside it
        unstage(spark, *(f"{sf}/{name}" for name in ("clean_products", "clean_workers", "products", "workers")))
        anonymise.run(spark, root, "csv")
        return spark.range(0)
    stage(spark, f"{sf}/anonymise_job", build)
    return _folder(spark, sf, "anonymise_job")


@query("anonymise_job_products")
def _(spark, sf):
    return rounded(prepared.load_products(spark, f"{_job(spark, sf)}/products", "csv"), "purchase_order",
                   "worker_daily_duration_sec")


@query("anonymise_job_workers")
def _(spark, sf):
    return rounded(prepared.load_workers(spark, f"{_job(spark, sf)}/workers", "csv"), *RESPONSE_FLOATS)


# --- cleaning and quality -----------------------------------------------------

@query("standardize_columns")
def _(spark, sf):
    back = {v: k for k, v in S.PRODUCT_HEADERS.items()}
    return clean.standardize_products(raw_p(spark, sf).withColumnsRenamed(back))


@query("parse_datetimes")
def _(spark, sf):
    return (clean.parse_timestamps(raw_p(spark, sf), S.PRODUCT_TIMESTAMPS)
            .select("sales_order", "order_line", *S.PRODUCT_TIMESTAMPS))


@query("expiration_sentinels")
def _(spark, sf):
    return clean.count_sentinel_expiration(
        clean.parse_timestamps(raw_p(spark, sf), ["expiration"]))


@query("coerce_ints")
def _(spark, sf):
    return (clean.coerce_ints(raw_p(spark, sf))
            .select("sales_order", "product_number", "duration_sec", "quantity_pcs"))


@query("coerce_nullable")
def _(spark, sf):
    return (clean.coerce_nullable(raw_p(spark, sf))
            .select("sales_order", "purchase_order", "order_line"))


@query("missing_products")
def _(spark, sf):
    return clean.missing_report(clean.type_products(raw_p(spark, sf)))


@query("missing_workers")
def _(spark, sf):
    return clean.missing_report(clean.type_workers(raw_w(spark, sf)))


@query("duplicates_products")
def _(spark, sf):
    return clean.duplicate_report(clean.type_products(raw_p(spark, sf)))


@query("duplicates_workers")
def _(spark, sf):
    return clean.duplicate_report(clean.type_workers(raw_w(spark, sf)))


@query("dedup_products")
def _(spark, sf):
    return clean.drop_duplicate_rows(raw_p(spark, sf))


@query("dedup_workers")
def _(spark, sf):
    return clean.drop_duplicate_rows(raw_w(spark, sf))


@query("clean_products")
def _(spark, sf):
    return clean.clean_products(raw_p(spark, sf))


@query("clean_workers")
def _(spark, sf):
    return clean.clean_workers(raw_w(spark, sf))


# --- scalar features ----------------------------------------------------------

@query("calendar_products")
def _(spark, sf):
    return (features.with_calendar(clean_p(spark, sf), "start_time")
            .select("sales_order", "start_time", *S.CALENDAR_COLUMNS))


@query("calendar_workers")
def _(spark, sf):
    return (features.with_calendar(clean_w(spark, sf), "input_date")
            .select("employee_id", "input_date", *S.CALENDAR_COLUMNS))


@query("durations")
def _(spark, sf):
    return (features.with_durations(clean_p(spark, sf))
            .select("sales_order", "start_time", "end_time", "duration_sec",
                    "computed_duration_sec", "duration_sec_final", "duration_min"))


@query("response_times")
def _(spark, sf):
    return (features.with_response_times(clean_w(spark, sf))
            .select("employee_id", "prompt_date", "input_date",
                    "response_time_sec", "response_time_min"))


@query("process_category")
def _(spark, sf):
    return (features.with_process_category(clean_p(spark, sf))
            .groupBy("process", "process_category").agg(F.count("*").alias("row_count")))


# --- group features -----------------------------------------------------------

DAY_FLOATS = ("employee_daily_avg_response_sec", "employee_daily_total_response_sec")
WEEK_FLOATS = ("employee_weekly_avg_response_sec",)
RESPONSE_FLOATS = (*DAY_FLOATS, *WEEK_FLOATS)


@query("feat_product_day")
def _(spark, sf):
    df = features.with_calendar(clean_p(spark, sf), "start_time")
    return features.with_product_features(df).select(
        "sales_order", "product_label", "date", "daily_product_ops_count")


@query("feat_worker_day")
def _(spark, sf):
    df = features.product_scalars(clean_p(spark, sf))
    return features.with_worker_day_features(df).select(
        "sales_order", "worker", "date", "worker_daily_ops", "worker_daily_qty",
        "worker_daily_duration_sec")


@query("feat_product_week")
def _(spark, sf):
    df = features.with_calendar(clean_p(spark, sf), "start_time")
    return features.with_product_features(df).select(
        "sales_order", "product_label", "week_number", "weekly_product_ops", "weekly_product_qty")


def _activity(spark, sf):
    return features.with_activity_features(features.worker_scalars(clean_w(spark, sf)))


@query("feat_employee_day")
def _(spark, sf):
    return rounded(_activity(spark, sf).select(
        "employee_id", "input_date", "date", "employee_daily_actions", *DAY_FLOATS), *DAY_FLOATS)


@query("feat_employee_week")
def _(spark, sf):
    return rounded(_activity(spark, sf).select(
        "employee_id", "input_date", "week_number", "employee_weekly_actions", *WEEK_FLOATS),
        *WEEK_FLOATS)


@query("feat_employee_hour")
def _(spark, sf):
    return _activity(spark, sf).select("employee_id", "input_date", "hour",
                                       "employee_hourly_action_count")


@query("feat_employee_dialog")
def _(spark, sf):
    return features.with_employee_dialog_count(clean_w(spark, sf)).select(
        "employee_id", "input_date", "dialog_type", "employee_dialog_type_count")


@query("feat_employee_device")
def _(spark, sf):
    return features.with_employee_device_count(clean_w(spark, sf)).select(
        "employee_id", "input_date", "device", "employee_device_usage_count")


@query("session_gaps")
def _(spark, sf):
    """Every dated row with the input before it."""
    return sessions.row_gaps(features.worker_scalars(clean_w(spark, sf))).select(
        "employee_id", "input_date", "previous_input", "gap_sec", "new_session")


@query("sessionize")
def _(spark, sf):
    df = features.worker_scalars(clean_w(spark, sf))
    return sessions.sessionize(df).select("employee_id", "input_date", "prompt_date", "session_id")


@query("prepare_products")
def _(spark, sf):
    return prepare.prepare_products(raw_p(spark, sf), staged=materialized)


@query("prepare_workers")
def _(spark, sf):
    return rounded(prepare.prepare_workers(raw_w(spark, sf), staged=materialized), *RESPONSE_FLOATS)


# --- filters ------------------------------------------------------------------

def the_filters() -> FL.Filters:
    return FL.Filters(date_range=(FILTER_FROM, FILTER_TO), products=FILTER_PRODUCTS,
                      processes=FILTER_PROCESSES)


@query("filter_products")
def _(spark, sf):
    return FL.explore(FL.filter_products(P(spark, sf), the_filters()), S.PRODUCT_EXPLORE)


@query("filter_workers")
def _(spark, sf):
    """No date range: the product log's own bounds apply to the input log too."""
    f = FL.Filters(employees=W(spark, sf).select("employee_name").distinct())
    return FL.explore(FL.filter_workers(P(spark, sf), W(spark, sf), f), S.WORKER_EXPLORE)


@query("filter_options")
def _(spark, sf):
    return FL.filter_options(P(spark, sf), W(spark, sf))


@query("worker_search")
def _(spark, sf):
    return FL.search_workers(P(spark, sf), SEARCH_TEXT)


@query("date_bounds")
def _(spark, sf):
    return FL.date_bounds(P(spark, sf), W(spark, sf))


@query("filter_summary")
def _(spark, sf):
    return FL.filter_summary(P(spark, sf), W(spark, sf), the_filters())


@query("explore_products")
def _(spark, sf):
    return FL.explore(P(spark, sf), S.PRODUCT_EXPLORE)


@query("explore_workers")
def _(spark, sf):
    return FL.explore(W(spark, sf), S.WORKER_EXPLORE)


@query("export_products")
def _(spark, sf):
    path = _folder(spark, sf, "export_products")
    prepared.export_csv(FL.filter_products(P(spark, sf), the_filters()), path)
    return rounded(prepared.load_products(spark, path, "csv"), "worker_daily_duration_sec")


@query("export_workers")
def _(spark, sf):
    path = _folder(spark, sf, "export_workers")
    f = FL.Filters(date_range=(dt.date(1999, 1, 5), dt.date(1999, 1, 20)))
    prepared.export_csv(FL.filter_workers(P(spark, sf), W(spark, sf), f), path)
    return (prepared.load_workers(spark, path, "csv")
            .select("employee_id", "input_date", "dialog_type", "response_time_sec", "session_id"))


# --- summaries ----------------------------------------------------------------

@query("describe_products")
def _(spark, sf):
    return summaries.describe(P(spark, sf), S.PRODUCT_DESCRIBE)


@query("describe_workers")
def _(spark, sf):
    return summaries.describe(W(spark, sf), S.WORKER_DESCRIBE)


def _value_counts(name, table, column, top=None, count="count"):
    QUERIES[name] = lambda spark, sf: summaries.value_counts(
        table(spark, sf), column, count, top)


_value_counts("label_counts", P, "product_label")
_value_counts("process_counts", P, "process")
_value_counts("top_workers_by_rows", P, "worker", 10)
_value_counts("top_devices", W, "device", 10)
_value_counts("employee_counts", W, "employee_name")
_value_counts("dialog_counts", W, "dialog_type")
_value_counts("top10_workers", P, "worker", 10, "ops")
_value_counts("top10_processes", P, "process", 10)


@query("table_shapes")
def _(spark, sf):
    return summaries.table_shapes(P(spark, sf), W(spark, sf))


@query("daily_products")
def _(spark, sf):
    return summaries.product_period(P(spark, sf), "date")


@query("weekly_products")
def _(spark, sf):
    return summaries.product_period(P(spark, sf), "week_number")


@query("worker_productivity")
def _(spark, sf):
    return summaries.worker_productivity(P(spark, sf))


@query("product_comparison")
def _(spark, sf):
    return summaries.product_comparison(P(spark, sf))


@query("daily_employees")
def _(spark, sf):
    return summaries.employee_period(W(spark, sf), "date")


@query("weekly_employees")
def _(spark, sf):
    return summaries.employee_period(W(spark, sf), "week_number")


@query("kpi_overview")
def _(spark, sf):
    return rounded(summaries.kpi_overview(P(spark, sf), W(spark, sf)), "avg_duration")


@query("product_kpis")
def _(spark, sf):
    return rounded(summaries.product_kpis(P(spark, sf)), "avg_duration")


@query("worker_detail_kpis")
def _(spark, sf):
    return rounded(summaries.worker_detail_kpis(P(spark, sf)), "avg_duration")


@query("worker_detail_daily")
def _(spark, sf):
    return summaries.worker_detail_daily(P(spark, sf))


@query("worker_detail_mix")
def _(spark, sf):
    return summaries.worker_detail_mix(P(spark, sf))


@query("employee_scorecard")
def _(spark, sf):
    return rounded(summaries.employee_scorecard(W(spark, sf)), "avg_response_sec")


def _trend(grain, metric, split):
    def run(spark, sf):
        out = summaries.trend(P(spark, sf), grain, metric, split)
        return rounded(out, "value") if metric == "duration" else out
    QUERIES[f"trend_{grain}_{metric}_{'split' if split else 'total'}"] = run


for _grain in summaries.TREND_PERIODS:
    for _metric in summaries.TREND_METRICS:
        for _split in (True, False):
            _trend(_grain, _metric, _split)


def _rank(metric):
    QUERIES[f"rank_workers_{metric}"] = lambda spark, sf: rounded(
        summaries.rank_workers(P(spark, sf), metric), "avg_duration")


for _metric in S.RANK_METRICS:
    _rank(_metric)


@query("top15_workers")
def _(spark, sf):
    return summaries.top_workers_with_quantity(P(spark, sf))


# --- chart datasets -----------------------------------------------------------

def _counts(name, table, *keys, count="count"):
    QUERIES[name] = lambda spark, sf: datasets.counts(table(spark, sf), *keys, name=count)


_counts("daily_ops_by_product", P, "date", "product_label", count="ops_count")
_counts("process_by_product_long", P, "process", "product_label")
_counts("hourly_by_product", P, "product_label", "hour")
_counts("hourly_total", P, "hour")
_counts("weekday_daily_ops", P, "date", "weekday_name", "day_of_week", count="ops")
_counts("ops_trend", P, "date", count="ops")
_counts("actions_trend", W, "date", count="actions")
_counts("hour_heatmap_long", P, "day_of_week", "hour")
_counts("daily_actions_by_employee", W, "date", "employee_name", count="actions")
_counts("hourly_actions_by_employee", W, "employee_name", "hour", count="actions")
_counts("dialog_by_employee_long", W, "dialog_type", "employee_name")
_counts("weekly_actions_by_employee", W, "employee_name", "week_number", count="actions")


@query("daily_qty_by_product")
def _(spark, sf):
    return datasets.daily_quantity(P(spark, sf))


def _cells_as_text(df):
    """For the comparison with SQL: (value, n) as ``value=n`` joined by ``;``."""
    return df.withColumn("cells", F.array_join(F.transform(
        "cells", lambda c: F.concat(c["value"], F.lit("="), c["n"].cast("string"))), ";"))


@query("process_by_product")
def _(spark, sf):
    """Products as rows, every process that occurs as a cell."""
    return _cells_as_text(datasets.matrix_rows(P(spark, sf), "product_label", "process"))


@query("dialog_by_employee")
def _(spark, sf):
    """Employees as rows, every dialog type that occurs as a cell."""
    return _cells_as_text(datasets.matrix_rows(W(spark, sf), "employee_name", "dialog_type"))


@query("product_split")
def _(spark, sf):
    return rounded(datasets.product_split(P(spark, sf)), "share_pct")


@query("hour_heatmap")
def _(spark, sf):
    return datasets.hour_heatmap(P(spark, sf))


# --- distributions and correlation --------------------------------------------

def _histogram(name, table, value, by=(), cap="global"):
    QUERIES[name] = lambda spark, sf: rounded(
        distribution.histogram(table(spark, sf), value, by, cap=cap), "bin_start")


_histogram("duration_histogram", P, "duration_sec_final")
_histogram("duration_histogram_by_product", P, "duration_sec_final", ["product_label"])
_histogram("response_histogram_by_employee", W, "response_time_sec", ["employee_name"], "group")
_histogram("response_histogram_global_cap", W, "response_time_sec", ["employee_name"])

BOX_FLOATS = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query("box_weekday_ops")
def _(spark, sf):
    return rounded(explore.weekday_box(P(spark, sf)), *BOX_FLOATS)


def _box(name, table, value, by=()):
    QUERIES[name] = lambda spark, sf: rounded(
        distribution.box_stats(table(spark, sf), value, by), *BOX_FLOATS)


_box("box_duration", P, "duration_sec_final")
_box("box_duration_by_product", P, "duration_sec_final", ["product_label"])
_box("box_response_by_employee", W, "response_time_sec", ["employee_name"])


@query("box_outlier_points")
def _(spark, sf):
    return distribution.outlier_points(P(spark, sf), "duration_sec_final", ["product_label"])


def _corr(name, table, columns, digits=None):
    QUERIES[name] = lambda spark, sf: rounded(
        correlation.correlation(table(spark, sf), columns, digits), "r")


_corr("corr_products", P, S.PRODUCT_CORRELATION)
# from the averages as they are reported, six digits: a coefficient next to a rounding step must not
# depend on digits behind them
_corr("corr_workers", lambda spark, sf: rounded(W(spark, sf), *RESPONSE_FLOATS), S.WORKER_CORRELATION)
_corr("corr_products_dash", P, S.PRODUCT_CORRELATION_SHORT, 2)
_corr("corr_workers_dash", W, S.WORKER_CORRELATION_SHORT, 2)


# --- anomalies ----------------------------------------------------------------

@query("anomalous_days")
def _(spark, sf):
    return A.anomalous_days(P(spark, sf))


@query("anomalous_days_by_employee")
def _(spark, sf):
    return A.anomalous_employee_days(W(spark, sf))


def _methods(key):
    method, z, factor = METHODS[key]
    how = {"method": method, "z": z, "factor": factor}
    QUERIES[f"anomalous_days_{key}"] = lambda spark, sf: A.anomalous_operation_days(
        P(spark, sf), **how)
    QUERIES[f"anomalous_days_by_employee_{key}"] = lambda spark, sf: A.anomalous_employee_days_by(
        W(spark, sf), **how)
    QUERIES[f"duration_outliers_{key}"] = lambda spark, sf: A.outlier_summary(
        P(spark, sf), "duration_sec_final", **how)
    QUERIES[f"response_outliers_{key}"] = lambda spark, sf: A.outlier_summary(
        W(spark, sf), "response_time_sec", **how)


for _key in METHODS:
    _methods(_key)


@query("anomaly_bands")
def _(spark, sf):
    return rounded(A.operation_bands(P(spark, sf)), "mean", "sd", "upper", "lower")


@query("anomaly_bands_by_employee")
def _(spark, sf):
    return rounded(A.employee_bands(W(spark, sf)), "mean", "sd", "upper", "lower")


@query("anomaly_bands_operations")
def _(spark, sf):
    """Bands over operations with a process, at the chosen z."""
    return rounded(A.bands(A.daily_operations(P(spark, sf)), "ops", z=METHODS["z"][1]),
                   "mean", "sd", "upper", "lower")


@query("duration_outlier_rates")
def _(spark, sf):
    return A.outlier_rates(P(spark, sf), "duration_sec_final")


@query("response_outlier_rates")
def _(spark, sf):
    return A.outlier_rates(W(spark, sf), "response_time_sec")


@query("top_duration_outliers")
def _(spark, sf):
    return A.top_outliers(P(spark, sf), "duration_sec_final", A.DURATION_TOP)


@query("top_response_outliers")
def _(spark, sf):
    return A.top_outliers(W(spark, sf), "response_time_sec", A.RESPONSE_TOP)


@query("top20_duration_outliers")
def _(spark, sf):
    return A.top_outliers(P(spark, sf), "duration_sec_final", A.DURATION_TOP_WIDE, 20, z=S.Z_DAILY)


@query("top20_response_outliers")
def _(spark, sf):
    return A.top_outliers(W(spark, sf), "response_time_sec", A.RESPONSE_TOP_WIDE, 20, z=S.Z_DAILY)


# --- anonymisation ------------------------------------------------------------

@query("system_names")
def _(spark, sf):
    return N.all_names(P(spark, sf), W(spark, sf))


@query("name_map")
def _(spark, sf):
    return N.name_map(P(spark, sf), W(spark, sf))


@query("employee_id_map")
def _(spark, sf):
    return N.employee_id_map(W(spark, sf))


@query("equipment_map")
def _(spark, sf):
    return N.equipment_map(W(spark, sf), N.employee_id_map(W(spark, sf)))


@query("anonymize_products")
def _(spark, sf):
    return (N.anonymize_products(P(spark, sf), maps(spark, sf).names)
            .select("sales_order", "start_time", "worker"))


@query("anonymize_workers")
def _(spark, sf):
    m = maps(spark, sf)
    return (N.anonymize_workers(W(spark, sf), m.names, m.ids, m.equipment)
            .select("input_date", "prompt_date", "employee_name", "employee_id", "equipment",
                    "screen_heading", "json_text"))


@query("unmapped_counts")
def _(spark, sf):
    return N.unmapped_counts(P(spark, sf), W(spark, sf), maps(spark, sf).names)


@query("scrub_text")
def _(spark, sf):
    df = W(spark, sf).select("input_date", "prompt_date", "screen_heading", "json_text")
    return N.scrub_text(df, maps(spark, sf).names)


def nested_people(spark, sf):
    """The names and their beginnings, two letters short; two of three take the next name as pseudonym."""
    names = maps(spark, sf).names.where("NOT is_system").select("real")
    numbered = ordinals(names.unionAll(names.selectExpr("substring(real, 1, length(real) - 2)")).distinct(), "real")
    after = numbered.select(F.col("real").alias("next"), (F.col("position") - 1).alias("position"))
    fake = F.when(F.col("position") % 3 != 2, F.col("next"))
    return numbered.join(after, "position", "left").select(
        "real", F.coalesce(fake, F.concat(F.lit("Alias "), F.col("position"))).alias("fake"), "position",
        F.lit(False).alias("is_system"))


@query("scrub_nested_names")
def _(spark, sf):
    people = stage(spark, f"{sf}/nested_people", lambda: nested_people(spark, sf))
    return N.scrub_text(W(spark, sf).select("input_date", "prompt_date", "screen_heading", "json_text"), people)


@query("anonymize_report")
def _(spark, sf):
    m = maps(spark, sf)
    return N.report(m.names, m.ids, m.equipment)


@query("anonymize_sample")
def _(spark, sf):
    return N.sample_names(maps(spark, sf).names)
