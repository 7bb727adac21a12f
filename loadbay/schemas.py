"""Column names, header maps and constants of the two event logs.

Everything in this module is a fixed value: raw files and downstream readers
rely on these exact names and thresholds.
"""

from pyspark.sql import types as T

# --- fixed values: headers of raw product-movement files -> column names -------
PRODUCT_HEADERS = {
    "Sklad": "warehouse",
    "Zdrojová pozícia": "source_position",
    "Cieľová pozícia": "target_position",
    "Proces": "process",
    "Začiatok": "start_time",
    "Koniec": "end_time",
    "Čas[sek]": "duration_sec",
    "Pracovník": "worker",
    "Zdrojová LP": "source_lp",
    "Cieľová  LP": "target_lp",  # two spaces in the raw header
    "Číslo produktu": "product_number",
    "Šarža": "batch",
    "Exspirácia": "expiration",
    "Množstvo [ks]": "quantity_pcs",
    "Nákupná objednávka": "purchase_order",
    "Predajná objednávka": "sales_order",
    "Riadok obj.": "order_line",
    "Zdrojová MLP": "source_mlp",
    "Cieľová MLP": "target_mlp",
}

# --- fixed values: headers of raw handheld input logs -> column names ----------
WORKER_HEADERS = {
    "Sklad": "warehouse",
    "Employee ID": "employee_id",
    "Employee Name": "employee_name",
    "Device": "device",
    "Equipment": "equipment",
    "Solution Environment": "solution_environment",
    "Prompt Date": "prompt_date",
    "Input Date": "input_date",
    "Dialog Type": "dialog_type",
    "Screen Heading": "screen_heading",
    "Screen Text": "screen_text",
    "System Message": "system_message",
    "Dialog Prompt": "dialog_prompt",
    "Dialog Field": "dialog_field",
    "Screen Options": "screen_options",
    "User Input": "user_input",
    "JSON Text": "json_text",
}

# --- fixed values: the product label is the rest of a header with this prefix --
LABEL_HEADER_PREFIX = "SUKL"

# --- fixed values: thresholds -------------------------------------------------
EXPIRATION_FLOOR = "2000-01-01"
SESSION_GAP_SEC = 1800
Z_DAILY = 2.5
Z_DETAIL = 3.0
IQR_FACTOR = 1.5
TAIL_QUANTILE = 0.99
HISTOGRAM_BINS = 60
EMPTY_CAP = 100.0

# --- fixed values: identifiers that are machines, not people ------------------
SYSTEM_NAMES = ("AFRAME", "DIHN", "MKOC", "SYSTEM", "VVAH")
SYSTEM_PATTERN = r"^USER\d+$"
EMPLOYEE_ID_POOL = ("EMP_A", "EMP_B", "EMP_C", "EMP_D", "EMP_E", "EMP_F")

# --- fixed values: column sets ------------------------------------------------
CALENDAR_COLUMNS = (
    "date", "hour", "day_of_week", "weekday_name", "week_number", "month", "is_weekend",
)
PRODUCT_EXPLORE = (
    "date", "worker", "process", "product_label",
    "quantity_pcs", "duration_sec_final", "hour", "weekday_name",
)
WORKER_EXPLORE = (
    "date", "employee_name", "employee_id", "dialog_type",
    "screen_heading", "response_time_sec", "hour", "weekday_name",
)
PRODUCT_DESCRIBE = (
    "duration_sec_final", "quantity_pcs", "daily_product_ops_count",
    "worker_daily_ops", "worker_daily_qty",
)
WORKER_DESCRIBE = (
    "response_time_sec", "employee_daily_actions",
    "employee_daily_avg_response_sec", "employee_weekly_actions",
)
PRODUCT_CORRELATION = (
    "duration_sec_final", "quantity_pcs", "hour", "day_of_week", "week_number",
    "daily_product_ops_count", "worker_daily_ops", "worker_daily_qty",
    "worker_daily_duration_sec", "weekly_product_ops", "weekly_product_qty",
)
PRODUCT_CORRELATION_SHORT = PRODUCT_CORRELATION[:8]
WORKER_CORRELATION = (
    "response_time_sec", "hour", "day_of_week", "week_number",
    "employee_daily_actions", "employee_daily_avg_response_sec",
    "employee_daily_total_response_sec", "employee_weekly_actions",
    "employee_weekly_avg_response_sec", "employee_hourly_action_count",
    "employee_dialog_type_count", "session_id",
)
WORKER_CORRELATION_SHORT = (
    "response_time_sec", "hour", "day_of_week", "week_number",
    "employee_daily_actions", "employee_daily_avg_response_sec",
    "employee_weekly_actions", "employee_hourly_action_count", "session_id",
)
RANK_METRICS = ("total_ops", "total_qty", "ops_per_day", "avg_duration", "active_days")

PRODUCT_TIMESTAMPS = ("start_time", "end_time", "expiration")
WORKER_TIMESTAMPS = ("prompt_date", "input_date")

# --- derived layouts ----------------------------------------------------------
PRODUCT_RAW = (*PRODUCT_HEADERS.values(), "product_label", "source_file")
WORKER_RAW = (*WORKER_HEADERS.values(), "source_file")


def _struct(fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_CALENDAR_TYPES = (
    ("date", T.DateType()), ("hour", T.IntegerType()), ("day_of_week", T.IntegerType()),
    ("weekday_name", T.StringType()), ("week_number", T.IntegerType()),
    ("month", T.IntegerType()), ("is_weekend", T.IntegerType()),
)
_PRODUCT_TYPED = {
    "start_time": T.TimestampNTZType(), "end_time": T.TimestampNTZType(),
    "expiration": T.TimestampNTZType(), "duration_sec": T.LongType(),
    "quantity_pcs": T.LongType(), "purchase_order": T.DoubleType(),
    "order_line": T.DoubleType(),
}
_WORKER_TYPED = {"prompt_date": T.TimestampNTZType(), "input_date": T.TimestampNTZType()}

CLEAN_PRODUCTS = _struct(
    (c, _PRODUCT_TYPED.get(c, T.StringType())) for c in PRODUCT_RAW)
CLEAN_WORKERS = _struct(
    (c, _WORKER_TYPED.get(c, T.StringType())) for c in WORKER_RAW)

PREPARED_PRODUCTS = _struct([
    *((f.name, f.dataType) for f in CLEAN_PRODUCTS),
    *_CALENDAR_TYPES,
    ("computed_duration_sec", T.DoubleType()), ("duration_sec_final", T.DoubleType()),
    ("duration_min", T.DoubleType()), ("daily_product_ops_count", T.LongType()),
    ("worker_daily_ops", T.LongType()), ("worker_daily_qty", T.LongType()),
    ("worker_daily_duration_sec", T.DoubleType()), ("weekly_product_ops", T.LongType()),
    ("weekly_product_qty", T.LongType()), ("process_category", T.StringType()),
])
PREPARED_WORKERS = _struct([
    *((f.name, f.dataType) for f in CLEAN_WORKERS),
    *_CALENDAR_TYPES,
    ("response_time_sec", T.DoubleType()), ("response_time_min", T.DoubleType()),
    ("employee_daily_actions", T.LongType()),
    ("employee_daily_avg_response_sec", T.DoubleType()),
    ("employee_daily_total_response_sec", T.DoubleType()),
    ("employee_weekly_actions", T.LongType()),
    ("employee_weekly_avg_response_sec", T.DoubleType()),
    ("employee_hourly_action_count", T.LongType()),
    ("employee_dialog_type_count", T.LongType()), ("session_id", T.LongType()),
    ("employee_device_usage_count", T.LongType()),
])
