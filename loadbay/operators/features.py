"""Row-level and group features of cleaned logs.

Group features use a window over detail rows only for employees whose rows one task can hold; all others
never do (only over small grids). Each is an aggregate on a
narrow projection (partial aggregation absorbs hot keys) that is joined back with
a left equi-join, so rows with a NULL key keep a NULL feature. AQE broadcasts the
aggregate when its measured size allows it and otherwise sort-merge joins,
splitting skewed partitions of the detail side.

Features whose keys are functions of one another share a join: a week is a
function of the date, so weekly totals are rolled up from the daily grid and
carried by it. The product log needs two wide joins for its six group features. All keys of the input
log hold the employee: its rows move once, to their employee, and only those of employees with very
many rows go through three wide joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.operators import sessions
from loadbay.session import cut


def attach(df: DataFrame, features: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of per-key features onto detail rows; NULL keys never match.

    A hash of the keys is one more join key: the aggregate is not partitioned by it, so Spark puts
    an exchange between aggregate and join, which is what lets AQE split a hot key's detail rows.
    The extra exchange moves one row per key. The hash is cut to six bits: more would not compress.
    """
    mark = F.pmod(F.xxhash64(*keys), F.lit(64)).cast("byte")
    features = features.where(C.all_present(*keys)).withColumn("__key", mark)
    return df.withColumn("__key", mark).join(features, [*keys, "__key"], "left").drop("__key")


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(C.calendar(ts))


def with_durations(df: DataFrame) -> DataFrame:
    """Recorded duration when positive, else end minus start (never negative)."""
    computed = C.not_negative(C.seconds_between("start_time", "end_time"))
    df = df.withColumn("computed_duration_sec", computed)
    df = df.withColumn(
        "duration_sec_final",
        F.when(F.col("duration_sec") > 0, F.col("duration_sec").cast("double"))
         .otherwise(F.col("computed_duration_sec")))
    return df.withColumn("duration_min", C.round_half_even(F.col("duration_sec_final") / 60.0, 2))


def with_response_times(df: DataFrame) -> DataFrame:
    response = C.not_negative(C.seconds_between("prompt_date", "input_date"))
    df = df.withColumn("response_time_sec", response)
    return df.withColumn("response_time_min",
                         C.round_half_even(F.col("response_time_sec") / 60.0, 4))


def with_process_category(df: DataFrame) -> DataFrame:
    return df.withColumn("process_category", C.process_category("process"))


def product_scalars(df: DataFrame) -> DataFrame:
    return (df.transform(with_calendar, "start_time")
              .transform(with_durations)
              .transform(with_process_category))


def worker_scalars(df: DataFrame) -> DataFrame:
    return df.transform(with_calendar, "input_date").transform(with_response_times)


# --- product log ---------------------------------------------------------------

def product_day_grid(df: DataFrame) -> DataFrame:
    """(product_label, date) -> rows, non-NULL processes, quantity."""
    return (df.where(C.all_present("product_label", "date"))
              .groupBy("product_label", "date", "week_number")
              .agg(F.count("*").alias("daily_product_ops_count"),
                   F.count("process").alias("process_rows"),
                   C.total("quantity_pcs").alias("qty")))


def product_day_features(df: DataFrame) -> DataFrame:
    """The grid with (product_label, week_number) totals beside each day. Week numbers
    of all years are pooled; the window covers grid rows only, seven per year."""
    week = Window.partitionBy("product_label", "week_number")
    return product_day_grid(df).select(
        "product_label", "date", "daily_product_ops_count",
        F.sum("process_rows").over(week).alias("weekly_product_ops"),
        F.sum("qty").over(week).alias("weekly_product_qty"))


def with_product_features(df: DataFrame) -> DataFrame:
    return attach(df, product_day_features(df), ["product_label", "date"])


def worker_day_features(df: DataFrame) -> DataFrame:
    return (df.where(C.all_present("worker", "date"))
              .groupBy("worker", "date")
              .agg(F.count("process").alias("worker_daily_ops"),
                   C.total("quantity_pcs").alias("worker_daily_qty"),
                   C.sum_seconds("duration_sec_final").alias("worker_daily_duration_sec")))


def with_worker_day_features(df: DataFrame) -> DataFrame:
    return attach(df, worker_day_features(df), ["worker", "date"])


def product_features(df: DataFrame) -> DataFrame:
    """All 17 derived columns of the product log, in table order.

    The rows move once, to the worker totals, and without the columns that can be derived behind that
    join. The product grid is a table before it is joined, so that its size is known when the join is
    planned: where it is small, the rows stay where they are, else they move a second time.
    """
    base = product_scalars(df)
    per_product, per_worker = cut(product_day_features(base), "product_days"), worker_day_features(base)
    return (df.withColumn("date", C.calendar("start_time")["date"])
              .transform(attach, per_worker, ["worker", "date"])
              .transform(product_scalars)
              .transform(attach, per_product, ["product_label", "date"])
              .select(*S.PREPARED_PRODUCTS.names))


# --- input log -----------------------------------------------------------------

# an employee with more rows is not gathered in one task
HOT_ROWS = 100_000


def employee_value_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return (df.where(C.all_present("employee_id", column))
              .groupBy("employee_id", column).agg(F.count("*").alias(name)))


def dialog_counts(df: DataFrame) -> DataFrame:
    return employee_value_count(df, "dialog_type", "employee_dialog_type_count")


def device_counts(df: DataFrame) -> DataFrame:
    return employee_value_count(df, "device", "employee_device_usage_count")


def with_employee_dialog_count(df: DataFrame) -> DataFrame:
    return attach(df, dialog_counts(df), ["employee_id", "dialog_type"])


def with_employee_device_count(df: DataFrame) -> DataFrame:
    return attach(df, device_counts(df), ["employee_id", "device"])


def activity_features(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC, whole: DataFrame | None = None) -> DataFrame:
    """Daily, weekly and hourly employee totals and session numbers per grid row.

    The grid is partitioned by employee once, for the session numbers; the other
    windows use the same partitioning. An employee has at most 86400 / gap grid rows
    per day however many inputs they made.
    """
    grid = sessions.number_grid(sessions.activity_grid(df, gap_sec, whole), gap_sec)

    def over(*keys):
        return Window.partitionBy("employee_id", *keys)

    def mean_over(window):
        total = F.sum("response_micros").over(window)
        return C.ratio(total, F.sum("responses").over(window)) / F.lit(1e6)

    dated = F.col("dated")
    day, week, hour = over("date"), over("week_number"), over("hour")
    return grid.select(
        *sessions.GRID_KEY,
        F.when(dated, F.sum("dialogs").over(day)).alias("employee_daily_actions"),
        F.when(dated, mean_over(day)).alias("employee_daily_avg_response_sec"),
        F.when(dated, F.coalesce(C.from_micros(F.sum("response_micros").over(day)), F.lit(0.0)))
         .alias("employee_daily_total_response_sec"),
        F.when(dated, F.sum("dialogs").over(week)).alias("employee_weekly_actions"),
        F.when(dated, mean_over(week)).alias("employee_weekly_avg_response_sec"),
        F.when(dated, F.sum("rows").over(hour)).alias("employee_hourly_action_count"),
        "session_base")


def with_activity_features(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC, whole: DataFrame | None = None) -> DataFrame:
    """Attach ``activity_features``; ``session_id`` is the grid row's session, or for
    rows without an input time the base number plus the row's place in its group."""
    features = activity_features(df, gap_sec, whole)
    placed = sessions.placed(df, gap_sec, whole)
    return (attach(placed, features, list(sessions.GRID_KEY))
            .withColumn("session_id", F.col("session_base") + F.col("place"))
            .drop("session_base", *sessions.PLACEMENT))


def gathered_features(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC, whole: DataFrame | None = None) -> DataFrame:
    """The group features of raw rows, by windows over all rows of an employee. The rows move once, without
    the columns that can be derived behind that."""
    base = sessions.with_sessions(worker_scalars(df.repartition("employee_id")), gap_sec, whole)

    def over(*keys):
        return Window.partitionBy("employee_id", *keys)

    def micros_over(window):
        return F.sum(C.micros("response_time_sec")).over(window)

    def mean_over(window):
        return C.ratio(micros_over(window), F.count("response_time_sec").over(window)) / F.lit(1e6)

    dated = F.col("input_date").isNotNull()
    day, week, hour = over("date"), over("week_number"), over("hour")
    return base.select(
        *df.columns,
        F.when(dated, F.count("dialog_type").over(day)).alias("employee_daily_actions"),
        F.when(dated, mean_over(day)).alias("employee_daily_avg_response_sec"),
        F.when(dated, F.coalesce(C.from_micros(micros_over(day)), F.lit(0.0))).alias("employee_daily_total_response_sec"),
        F.when(dated, F.count("dialog_type").over(week)).alias("employee_weekly_actions"),
        F.when(dated, mean_over(week)).alias("employee_weekly_avg_response_sec"),
        F.when(dated, F.count("*").over(hour)).alias("employee_hourly_action_count"),
        F.when(F.col("dialog_type").isNotNull(), F.count("*").over(over("dialog_type"))).alias("employee_dialog_type_count"),
        F.when(F.col("device").isNotNull(), F.count("*").over(over("device"))).alias("employee_device_usage_count"),
        "session_id").transform(worker_scalars)


def joined_features(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC, whole: DataFrame | None = None) -> DataFrame:
    """The same by three joins, whatever share of the log an employee has."""
    base = worker_scalars(df)
    per_dialog, per_device = dialog_counts(base), device_counts(base)
    return (base.transform(with_activity_features, gap_sec, whole)
                .transform(attach, per_dialog, ["employee_id", "dialog_type"])
                .transform(attach, per_device, ["employee_id", "device"]))


def worker_features(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All 18 derived columns of the input log, in table order.

    Rows of employees with up to ``hot_rows`` rows are gathered by employee and move once; those of the few
    others (there are at most rows / ``hot_rows``) are joined. Rows without an employee have no group features.
    """
    columns, whole = df.columns, worker_scalars(df)
    hot = cut(df.where(F.col("employee_id").isNotNull()).groupBy("employee_id").agg(F.count("*").alias("n"))
              .where(F.col("n") > hot_rows).select("employee_id"), "hot_employees")
    known = df.where(F.col("employee_id").isNotNull())
    nobody = worker_scalars(df.where(F.col("employee_id").isNull()))
    if hot.isEmpty():
        out = gathered_features(known, gap_sec, whole)
    else:
        few = known.join(hot, "employee_id", "left_anti").select(*columns)
        many = known.join(hot, "employee_id", "left_semi").select(*columns)
        out = gathered_features(few, gap_sec, whole).unionByName(joined_features(many, gap_sec, whole))
    return out.unionByName(nobody, allowMissingColumns=True).select(*S.PREPARED_WORKERS.names)
