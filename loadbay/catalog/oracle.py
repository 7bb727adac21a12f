"""Query name -> SQL over the test tables, run by another engine as a check.

The statements are written from the rules, not from the Spark plans: group features
are guarded windows, sessions a running sum over rows, quantiles ``quantile_cont``.
"""

from __future__ import annotations

import re

from loadbay import schemas as S
from loadbay.catalog import queries as Q
from loadbay.operators import anonymize as N
from loadbay.operators.datasets import WEEKDAY_LABELS

ORACLE: dict[str, str] = {}


def r(x: str, digits: int = 6) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def num(x: str) -> str:
    d = f"try_cast({x} AS DOUBLE)"
    return f"CASE WHEN isnan({d}) THEN NULL ELSE {d} END"


def to_int(x: str) -> str:
    return f"coalesce(CAST(trunc({num(x)}) AS BIGINT), 0)"


def mean(x: str) -> str:
    """Mean of seconds, summed in whole microseconds (exact in any order)."""
    return f"(sum(round({x} * 1e6)) / count({x}) / 1e6)"


def calendar(ts: str) -> str:
    return f"""CAST({ts} AS DATE) AS date, CAST(hour({ts}) AS INTEGER) AS hour,
      CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week, dayname({ts}) AS weekday_name,
      CAST(week({ts}) AS INTEGER) AS week_number, CAST(month({ts}) AS INTEGER) AS month,
      CAST(coalesce(isodow({ts}) >= 6, false) AS INTEGER) AS is_weekend"""


def when_keys(expr: str, *keys: str) -> str:
    cond = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"CASE WHEN {cond} THEN {expr} END"


def over(*keys: str) -> str:
    return f"OVER (PARTITION BY {', '.join(keys)})"


def mean_over(x: str, *keys: str) -> str:
    return f"(sum(round({x} * 1e6)) {over(*keys)} / count({x}) {over(*keys)} / 1e6)"


P_PASS = ", ".join(c for c in S.PRODUCT_RAW if c not in (
    "start_time", "end_time", "expiration", "duration_sec", "quantity_pcs",
    "purchase_order", "order_line"))
W_PASS = ", ".join(c for c in S.WORKER_RAW if c not in ("prompt_date", "input_date"))

CTES = {
    "p_joined": """
    SELECT *, (l_partkey * 31 + l_linenumber * 7) % 600
             + CASE WHEN l_partkey % 401 = 0 THEN 7200 ELSE 0 END AS true_dur,
           l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 86400) AS begun
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "p_once": """
    SELECT 'W' || (l_suppkey % 5) AS warehouse, 'P-' || (l_partkey % 1000) AS source_position,
      CASE WHEN l_returnflag <> 'N' THEN 'T-' || (l_suppkey % 50) END AS target_position,
      CASE l_returnflag || l_linestatus
        WHEN 'AF' THEN '100 - Goods Receipt' WHEN 'AO' THEN '110 - Putaway'
        WHEN 'NF' THEN '341 - Shipping Detail' WHEN 'NO' THEN '210 - Replenishment'
        WHEN 'RF' THEN '341 - Shipping - Express'
        ELSE CASE WHEN l_partkey % 50 <> 0 THEN 'SYSTEM' END END AS process,
      CASE WHEN l_orderkey % 499 = 0 THEN 'bad' ELSE CAST(begun AS VARCHAR) END AS start_time,
      CAST(begun + to_seconds(true_dur - CASE WHEN l_partkey % 97 = 0 THEN 3600 ELSE 0 END)
           AS VARCHAR) AS end_time,
      CASE WHEN l_partkey % 10 = 0 THEN '0' WHEN l_partkey % 10 = 1 THEN NULL
           ELSE CAST(true_dur AS VARCHAR) END AS duration_sec,
      CASE WHEN l_suppkey = 7 THEN 'SYSTEM' WHEN l_suppkey % 20 = 0 THEN 'USER' || l_suppkey
           WHEN l_suppkey % 33 = 1 THEN NULL ELSE s_name END AS worker,
      'LP' || l_orderkey AS source_lp,
      CASE WHEN l_linenumber % 3 <> 0 THEN 'LT' || l_orderkey END AS target_lp,
      CAST(l_partkey AS VARCHAR) AS product_number, 'B' || (l_partkey % 37) AS batch,
      CASE WHEN l_partkey % 11 = 0 THEN '1900-01-01 00:00:00'
           ELSE CAST(l_shipdate + to_days(CAST(l_partkey % 700 AS INTEGER)) AS VARCHAR) END AS expiration,
      CASE l_partkey % 211 WHEN 0 THEN 'n/a' WHEN 1 THEN '12.7' WHEN 2 THEN 'NaN'
           ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity_pcs,
      CASE WHEN l_orderkey % 13 = 0 THEN 'PO-x' WHEN l_orderkey % 17 = 0 THEN 'NaN'
           WHEN l_linestatus = 'F' THEN CAST(l_orderkey AS VARCHAR) END AS purchase_order,
      CAST(l_orderkey AS VARCHAR) AS sales_order, CAST(l_linenumber AS VARCHAR) AS order_line,
      CAST(NULL AS VARCHAR) AS source_mlp,
      CASE WHEN p_type < 'M' AND l_linenumber = 1 THEN 'M' || l_suppkey END AS target_mlp,
      p_brand AS product_label,
      CASE WHEN p_type < 'M' THEN 'moves_a.csv' ELSE 'moves_b.csv' END AS source_file
    FROM p_joined""",
    "p_raw": """
    SELECT * FROM p_once UNION ALL SELECT * FROM p_once WHERE CAST(sales_order AS BIGINT) % 97 = 0""",
    "p_typed": f"""
    SELECT {P_PASS}, try_cast(start_time AS TIMESTAMP) AS start_time,
      try_cast(end_time AS TIMESTAMP) AS end_time,
      CASE WHEN try_cast(expiration AS TIMESTAMP) >= TIMESTAMP '2000-01-01'
           THEN try_cast(expiration AS TIMESTAMP) END AS expiration,
      {to_int('duration_sec')} AS duration_sec, {to_int('quantity_pcs')} AS quantity_pcs,
      {num('purchase_order')} AS purchase_order, {num('order_line')} AS order_line
    FROM p_raw""",
    "p_clean": "SELECT DISTINCT * FROM p_typed",
    "p_scalar": f"""
    SELECT *, {r('duration_sec_final / 60', 2)} AS duration_min FROM (
      SELECT *, CASE WHEN duration_sec > 0 THEN CAST(duration_sec AS DOUBLE)
                     ELSE computed_duration_sec END AS duration_sec_final FROM (
        SELECT *, {calendar('start_time')},
          CASE WHEN end_time < start_time THEN 0.0::DOUBLE
               ELSE epoch_us(end_time - start_time) / 1e6 END AS computed_duration_sec,
          regexp_replace(split_part(process, ' - ', 1), '^\\s+|\\s+$', '', 'g') AS process_category
        FROM p_clean))""",
    "p": f"""
    SELECT *,
      {when_keys('count(*) ' + over('product_label', 'date'), 'product_label', 'date')}
        AS daily_product_ops_count,
      {when_keys('count(process) ' + over('worker', 'date'), 'worker', 'date')} AS worker_daily_ops,
      CAST({when_keys('sum(quantity_pcs) ' + over('worker', 'date'), 'worker', 'date')} AS BIGINT)
        AS worker_daily_qty,
      {when_keys('coalesce(sum(duration_sec_final) ' + over('worker', 'date') + ', 0)', 'worker', 'date')}
        AS worker_daily_duration_sec,
      {when_keys('count(process) ' + over('product_label', 'week_number'), 'product_label', 'week_number')}
        AS weekly_product_ops,
      CAST({when_keys('sum(quantity_pcs) ' + over('product_label', 'week_number'), 'product_label', 'week_number')}
        AS BIGINT) AS weekly_product_qty
    FROM p_scalar""",
    "w_once": """
    SELECT event_id, 'W' || (user_id % 3) AS warehouse,
      'E' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS employee_id,
      'Employee#' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS employee_name,
      'DEV' || (event_id % 7) AS device,
      CASE WHEN event_id % 3 = 0 THEN 'FAE' || lpad(CAST(user_id AS VARCHAR), 6, '0')
           ELSE 'HW' || (event_id % 11) END AS equipment,
      'PRD' AS solution_environment,
      CAST(ts - to_microseconds(CASE WHEN event_id % 100 = 0 THEN -5000000
             ELSE CAST(round(value * 100) AS BIGINT) * 10000 END) AS VARCHAR) AS prompt_date,
      CASE WHEN event_id % 500 <> 499 THEN CAST(ts AS VARCHAR) END AS input_date,
      CASE WHEN event_id % 250 <> 1 THEN event_type END AS dialog_type,
      CASE event_id % 4 WHEN 0 THEN 'Welcome Employee#' || lpad(CAST(user_id AS VARCHAR), 6, '0')
           WHEN 1 THEN '' ELSE CASE WHEN event_id % 20 = 2
             THEN 'Employee#' || lpad(CAST(user_id AS VARCHAR), 6, '0') || ' to Employee#'
                  || lpad(CAST(user_id * 7 % 50 AS VARCHAR), 6, '0') ELSE event_type END END AS screen_heading,
      'Scan ' || event_type AS screen_text,
      CASE WHEN event_type = 'error' THEN 'E' || (event_id % 10) END AS system_message,
      event_type || '?' AS dialog_prompt, 'F' || (event_id % 5) AS dialog_field,
      CAST(NULL AS VARCHAR) AS screen_options, 'V' || (event_id % 100) AS user_input,
      CASE WHEN event_id % 5 = 0
           THEN '{"user": "Employee#' || lpad(CAST(user_id AS VARCHAR), 6, '0') || '"}'
           ELSE props END AS json_text,
      CASE WHEN user_id % 2 = 0 THEN 'inputs_1.csv' ELSE 'inputs_2.csv' END AS source_file
    FROM (SELECT * REPLACE (ts - to_days(9131) AS ts) FROM events)""",
    "w_raw": """
    SELECT * EXCLUDE (event_id) FROM w_once
    UNION ALL SELECT * EXCLUDE (event_id) FROM w_once WHERE event_id % 83 = 0""",
    "w_typed": f"""
    SELECT {W_PASS}, try_cast(prompt_date AS TIMESTAMP) AS prompt_date,
      try_cast(input_date AS TIMESTAMP) AS input_date FROM w_raw""",
    "w_clean": "SELECT DISTINCT * FROM w_typed",
    "w_scalar": f"""
    SELECT *, {r('response_time_sec / 60', 4)} AS response_time_min FROM (
      SELECT *, {calendar('input_date')},
        CASE WHEN input_date < prompt_date THEN 0.0::DOUBLE
             ELSE epoch_us(input_date - prompt_date) / 1e6 END AS response_time_sec
      FROM w_clean)""",
    "w_lagged": """
    SELECT *, lag(input_date) OVER (PARTITION BY employee_id
                                    ORDER BY input_date NULLS LAST, prompt_date) AS previous
    FROM w_scalar""",
    "w": f"""
    SELECT * EXCLUDE (previous),
      {when_keys('count(dialog_type) ' + over('employee_id', 'date'), 'employee_id', 'date')}
        AS employee_daily_actions,
      {r(when_keys(mean_over('response_time_sec', 'employee_id', 'date'), 'employee_id', 'date'))}
        AS employee_daily_avg_response_sec,
      {r(when_keys('coalesce(sum(round(response_time_sec * 1e6)) ' + over('employee_id', 'date') + ', 0) / 1e6', 'employee_id', 'date'))}
        AS employee_daily_total_response_sec,
      {when_keys('count(dialog_type) ' + over('employee_id', 'week_number'), 'employee_id', 'week_number')}
        AS employee_weekly_actions,
      {r(when_keys(mean_over('response_time_sec', 'employee_id', 'week_number'), 'employee_id', 'week_number'))}
        AS employee_weekly_avg_response_sec,
      {when_keys('count(*) ' + over('employee_id', 'hour'), 'employee_id', 'hour')}
        AS employee_hourly_action_count,
      {when_keys('count(*) ' + over('employee_id', 'dialog_type'), 'employee_id', 'dialog_type')}
        AS employee_dialog_type_count,
      CAST({when_keys('''sum(CASE WHEN previous IS NULL OR input_date IS NULL
                 OR epoch_us(input_date - previous) > 1800000000 THEN 1 ELSE 0 END)
           OVER (PARTITION BY employee_id ORDER BY input_date NULLS LAST, prompt_date
                 ROWS UNBOUNDED PRECEDING)''', 'employee_id')} AS BIGINT) AS session_id,
      {when_keys('count(*) ' + over('employee_id', 'device'), 'employee_id', 'device')}
        AS employee_device_usage_count
    FROM w_lagged""",
    "n_all": """
    SELECT DISTINCT name, name IN ('AFRAME','DIHN','MKOC','SYSTEM','VVAH')
                          OR regexp_matches(name, '^USER[0-9]+$') AS is_system
    FROM (SELECT worker AS name FROM p_clean UNION ALL SELECT employee_name FROM w_clean)
    WHERE name IS NOT NULL""",
    "pool": f"""
    SELECT fake, row_number() OVER (ORDER BY md5(fake)) - 1 AS slot FROM (
      SELECT a || b || ' ' || c || d AS fake
      FROM unnest({list(N.STEMS)}) t1(a), unnest({list(N.GIVEN_ENDINGS)}) t2(b),
           unnest({list(N.STEMS)}) t3(c), unnest({list(N.FAMILY_ENDINGS)}) t4(d))""",
    "n_ranked": """
    SELECT name, row_number() OVER (ORDER BY name) - 1 AS position FROM n_all WHERE NOT is_system""",
    "n_map": """
    SELECT name AS real, fake, position, false AS is_system
    FROM n_ranked JOIN pool ON slot = position % 10816
    UNION ALL SELECT name, name, CAST(NULL AS BIGINT), true FROM n_all WHERE is_system""",
    "id_map": """
    SELECT real, ['EMP_A','EMP_B','EMP_C','EMP_D','EMP_E','EMP_F'][CAST(position % 6 AS INTEGER) + 1] AS fake,
           position
    FROM (SELECT employee_id AS real, row_number() OVER (ORDER BY employee_id) - 1 AS position
          FROM (SELECT DISTINCT employee_id FROM w_clean WHERE employee_id IS NOT NULL))""",
    "codes": "SELECT DISTINCT equipment AS code FROM w_clean WHERE equipment IS NOT NULL",
    "eq_map": """
    SELECT code AS real, coalesce(min_by(replace(code, id_map.real, id_map.fake), position), code) AS fake
    FROM codes LEFT JOIN id_map ON contains(code, id_map.real) GROUP BY code""",
    "texts": """
    SELECT DISTINCT t FROM (SELECT screen_heading AS t FROM w_clean
                            UNION ALL SELECT json_text FROM w_clean)""",
    "scrub_list": "SELECT list({'r': real, 'f': fake} ORDER BY position) AS names FROM n_map WHERE NOT is_system",
    # every name of the list replaced in its order
    "scrubbed": """
    SELECT t, nullif(list_reduce([t] || [x.r || chr(1) || x.f FOR x IN names],
                                 lambda acc, x: replace(acc, split_part(x, chr(1), 1), split_part(x, chr(1), 2))), '') AS clean
    FROM texts, scrub_list""",
    # names inside names, and pseudonyms that are later names
    "nest": """
    SELECT real, row_number() OVER (ORDER BY real) - 1 AS position FROM (
      SELECT real FROM n_map WHERE NOT is_system
      UNION SELECT substr(real, 1, length(real) - 2) FROM n_map WHERE NOT is_system)""",
    "nest_list": """
    SELECT list(a.real || chr(1) || CASE WHEN a.position % 3 <> 2 AND b.real IS NOT NULL THEN b.real
                                         ELSE 'Alias ' || a.position END ORDER BY a.position) AS pairs
    FROM nest a LEFT JOIN nest b ON b.position = a.position + 1""",
    "nest_scrubbed": """
    SELECT t, nullif(list_reduce([t] || pairs,
                                 lambda acc, x: replace(acc, split_part(x, chr(1), 1), split_part(x, chr(1), 2))), '') AS clean
    FROM texts, nest_list""",
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def _needs(sql: str, seen: list[str]) -> None:
    for name in _NAMES.findall(sql):
        if name not in seen:
            _needs(CTES[name], seen)
            if name not in seen:
                seen.append(name)


def oracle(name: str, body: str) -> None:
    """Register a statement, prefixed by the common table expressions it uses."""
    used: list[str] = []
    _needs(body, used)
    ctes = [f"{n} AS ({CTES[n]})" for n in CTES if n in used]
    ORACLE[name] = f"WITH {', '.join(ctes)}\n{body}" if ctes else body


def drop_null(*keys: str) -> str:
    return " AND ".join(f"{k} IS NOT NULL" for k in keys)


P_COLS = ", ".join(S.PREPARED_PRODUCTS.names)
W_COLS = ", ".join(S.PREPARED_WORKERS.names)

# --- sources and sinks --------------------------------------------------------
_LABEL = "CASE source_file WHEN 'moves_a.csv' THEN 'A-100' ELSE 'B-200' END"
oracle("ingest_products", f"SELECT * REPLACE ({_LABEL} AS product_label) FROM p_raw")
oracle("ingest_workers", "SELECT * REPLACE (nullif(screen_heading, '') AS screen_heading) FROM w_raw")
oracle("product_label_from_header",
       f"SELECT source_file, {_LABEL} AS product_label, count(*) AS row_count FROM p_raw GROUP BY 1, 2")
oracle("source_file_counts", "SELECT source_file, count(*) AS row_count FROM w_raw GROUP BY 1")
oracle("load_prepared_products", f"SELECT {P_COLS} FROM p")
oracle("load_prepared_workers",
       f"SELECT * REPLACE (nullif(screen_heading, '') AS screen_heading) FROM (SELECT {W_COLS} FROM w)")
oracle("write_prepared", f"SELECT {P_COLS} FROM p")
_MASKED = {"employee_name": "n_map.fake", "employee_id": "id_map.fake", "equipment": "eq_map.fake",
           "screen_heading": "h.clean", "json_text": "j.clean"}
_JOB = f"""
    SELECT {", ".join(f"{_MASKED.get(c, 'w.' + c)} AS {c}" for c in S.PREPARED_WORKERS.names)}
    FROM w LEFT JOIN n_map ON w.employee_name = n_map.real
      LEFT JOIN id_map ON w.employee_id = id_map.real LEFT JOIN eq_map ON w.equipment = eq_map.real
      LEFT JOIN scrubbed h ON w.screen_heading = h.t LEFT JOIN scrubbed j ON w.json_text = j.t"""
oracle("write_anonymized", _JOB)
oracle("anonymise_job_workers", _JOB)
oracle("anonymise_job_products", f"""
    SELECT {", ".join("n_map.fake AS worker" if c == "worker" else f"p.{c}" for c in S.PREPARED_PRODUCTS.names)}
    FROM p LEFT JOIN n_map ON p.worker = n_map.real""")

# --- cleaning -----------------------------------------------------------------
oracle("standardize_columns", "SELECT * FROM p_raw")
oracle("parse_datetimes", """
    SELECT sales_order, order_line, try_cast(start_time AS TIMESTAMP) AS start_time,
      try_cast(end_time AS TIMESTAMP) AS end_time, try_cast(expiration AS TIMESTAMP) AS expiration
    FROM p_raw""")
oracle("expiration_sentinels", """
    SELECT count(*) AS total_rows,
      count(*) FILTER (WHERE try_cast(expiration AS TIMESTAMP) < TIMESTAMP '2000-01-01') AS sentinel_rows
    FROM p_raw""")
oracle("coerce_ints", f"""
    SELECT sales_order, product_number, {to_int('duration_sec')} AS duration_sec,
      {to_int('quantity_pcs')} AS quantity_pcs FROM p_raw""")
oracle("coerce_nullable", f"""
    SELECT sales_order, {num('purchase_order')} AS purchase_order, {num('order_line')} AS order_line
    FROM p_raw""")


def _missing(table: str, columns) -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS n FROM {table}"
             for c in columns]
    return (f"SELECT column_name, missing, {r('missing / n * 100', 1)} AS pct FROM ("
            + " UNION ALL ".join(parts) + ") WHERE missing > 0")


oracle("missing_products", _missing("p_typed", S.PRODUCT_RAW))
oracle("missing_workers", _missing("w_typed", S.WORKER_RAW))
for _t, _name in (("p", "products"), ("w", "workers")):
    oracle(f"duplicates_{_name}", f"""
        SELECT (SELECT count(*) FROM {_t}_typed) AS total_rows,
               (SELECT count(*) FROM {_t}_typed) - (SELECT count(*) FROM {_t}_clean) AS duplicate_rows""")
    oracle(f"dedup_{_name}", f"SELECT DISTINCT * FROM {_t}_raw")
    oracle(f"clean_{_name}", f"SELECT * FROM {_t}_clean")

# --- features -----------------------------------------------------------------
_CAL = ", ".join(S.CALENDAR_COLUMNS)
oracle("calendar_products", f"SELECT sales_order, start_time, {_CAL} FROM p_scalar")
oracle("calendar_workers", f"SELECT employee_id, input_date, {_CAL} FROM w_scalar")
oracle("durations", """SELECT sales_order, start_time, end_time, duration_sec, computed_duration_sec,
    duration_sec_final, duration_min FROM p_scalar""")
oracle("response_times", """SELECT employee_id, prompt_date, input_date, response_time_sec,
    response_time_min FROM w_scalar""")
oracle("process_category",
       "SELECT process, process_category, count(*) AS row_count FROM p_scalar GROUP BY 1, 2")
oracle("feat_product_day", "SELECT sales_order, product_label, date, daily_product_ops_count FROM p")
oracle("feat_worker_day", """SELECT sales_order, worker, date, worker_daily_ops, worker_daily_qty,
    worker_daily_duration_sec FROM p""")
oracle("feat_product_week", """SELECT sales_order, product_label, week_number, weekly_product_ops,
    weekly_product_qty FROM p""")
oracle("feat_employee_day", """SELECT employee_id, input_date, date, employee_daily_actions,
    employee_daily_avg_response_sec, employee_daily_total_response_sec FROM w""")
oracle("feat_employee_week", """SELECT employee_id, input_date, week_number, employee_weekly_actions,
    employee_weekly_avg_response_sec FROM w""")
oracle("feat_employee_hour",
       "SELECT employee_id, input_date, hour, employee_hourly_action_count FROM w")
oracle("feat_employee_dialog",
       "SELECT employee_id, input_date, dialog_type, employee_dialog_type_count FROM w")
oracle("feat_employee_device",
       "SELECT employee_id, input_date, device, employee_device_usage_count FROM w")
oracle("session_gaps", """
    SELECT employee_id, input_date, previous_input,
      epoch_us(input_date - previous_input) / 1e6 AS gap_sec,
      CASE WHEN epoch_us(input_date - previous_input) <= 1800000000 THEN 0 ELSE 1 END AS new_session
    FROM (SELECT employee_id, input_date,
            lag(input_date) OVER (PARTITION BY employee_id ORDER BY input_date) AS previous_input
          FROM w_clean WHERE input_date IS NOT NULL AND employee_id IS NOT NULL)""")
oracle("sessionize", "SELECT employee_id, input_date, prompt_date, session_id FROM w")
oracle("prepare_products", f"SELECT {P_COLS} FROM p")
oracle("prepare_workers", f"SELECT {W_COLS} FROM w")

# --- filters ------------------------------------------------------------------
_IN = lambda values: "(" + ", ".join(f"'{v}'" for v in values) + ")"
_P_SEL = f"""date BETWEEN DATE '{Q.FILTER_FROM}' AND DATE '{Q.FILTER_TO}'
    AND product_label IN {_IN(Q.FILTER_PRODUCTS)} AND process IN {_IN(Q.FILTER_PROCESSES)}
    AND worker IS NOT NULL"""
oracle("filter_products", f"SELECT {', '.join(S.PRODUCT_EXPLORE)} FROM p_scalar WHERE {_P_SEL}")
oracle("filter_workers", f"""
    SELECT {', '.join(S.WORKER_EXPLORE)} FROM w_scalar
    WHERE date BETWEEN (SELECT min(date) FROM p_scalar) AND (SELECT max(date) FROM p_scalar)
      AND employee_name IS NOT NULL""")
oracle("filter_options", """
    SELECT DISTINCT * FROM (
      SELECT 'product_label' AS option, product_label AS value FROM p_clean
      UNION ALL SELECT 'process', process FROM p_clean UNION ALL SELECT 'worker', worker FROM p_clean
      UNION ALL SELECT 'employee_name', employee_name FROM w_clean) WHERE value IS NOT NULL""")
oracle("worker_search", f"""
    SELECT DISTINCT worker FROM p_clean WHERE contains(lower(worker), lower('{Q.SEARCH_TEXT}'))""")
oracle("date_bounds", """
    SELECT min(date) AS min_date, max(date) AS max_date
    FROM (SELECT date FROM p_scalar UNION ALL SELECT date FROM w_scalar)""")
oracle("filter_summary", f"""
    SELECT (SELECT count(*) FROM p_scalar WHERE {_P_SEL}) AS products_selected,
      (SELECT count(*) FROM p_scalar) AS products_total,
      (SELECT count(*) FROM w_scalar WHERE date BETWEEN DATE '{Q.FILTER_FROM}' AND DATE '{Q.FILTER_TO}'
         AND employee_name IS NOT NULL) AS workers_selected,
      (SELECT count(*) FROM w_scalar) AS workers_total""")
oracle("explore_products", f"SELECT {', '.join(S.PRODUCT_EXPLORE)} FROM p_scalar")
oracle("explore_workers", f"SELECT {', '.join(S.WORKER_EXPLORE)} FROM w_scalar")
oracle("export_products", f"SELECT {P_COLS} FROM p WHERE {_P_SEL}")
oracle("export_workers", """
    SELECT employee_id, input_date, dialog_type, response_time_sec, session_id FROM w
    WHERE date BETWEEN DATE '1999-01-05' AND DATE '1999-01-20' AND employee_name IS NOT NULL""")


# --- summaries ----------------------------------------------------------------

def _describe(table: str, columns) -> str:
    one = """SELECT '{c}' AS feature, count({c}) AS count, {mean} AS mean, {std} AS std, {lo} AS min,
        {a} AS q25, {b} AS q50, {d} AS q75, {hi} AS max FROM {t}"""
    return " UNION ALL ".join(one.format(
        c=c, t=table, mean=r(f"avg({c})", 2), std=r(f"stddev_samp({c})", 2), lo=r(f"min({c})", 2),
        a=r(f"quantile_cont({c}, 0.25)", 2), b=r(f"quantile_cont({c}, 0.5)", 2),
        d=r(f"quantile_cont({c}, 0.75)", 2), hi=r(f"max({c})", 2)) for c in columns)


oracle("describe_products", _describe("p", S.PRODUCT_DESCRIBE))
oracle("describe_workers", _describe("w", S.WORKER_DESCRIBE))


def _value_counts(name, table, column, top=None, count="count"):
    tail = f" LIMIT {top}" if top else ""
    oracle(name, f"""SELECT {column}, count(*) AS {count} FROM {table} WHERE {column} IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1{tail}""")


_value_counts("label_counts", "p_clean", "product_label")
_value_counts("process_counts", "p_clean", "process")
_value_counts("top_workers_by_rows", "p_clean", "worker", 10)
_value_counts("top_devices", "w_clean", "device", 10)
_value_counts("employee_counts", "w_clean", "employee_name")
_value_counts("dialog_counts", "w_clean", "dialog_type")
_value_counts("top10_workers", "p_clean", "worker", 10, "ops")
_value_counts("top10_processes", "p_clean", "process", 10)

oracle("table_shapes", """
    SELECT 'products' AS table_name, count(*) AS row_count, 38 AS column_count FROM p_clean
    UNION ALL SELECT 'workers', count(*), 36 FROM w_clean""")

_QTY = "CAST(coalesce(sum(quantity_pcs), 0) AS BIGINT)"
_TOTALS = f"count(process) AS total_ops, {_QTY} AS total_qty"
_AVG2 = r(mean("duration_sec_final"), 2) + " AS avg_duration"
_AVG6 = r(mean("duration_sec_final")) + " AS avg_duration"
for _name, _key in (("daily_products", "date"), ("weekly_products", "week_number")):
    oracle(_name, f"""SELECT {_key}, {_TOTALS}, {_AVG2}, count(DISTINCT worker) AS unique_workers
        FROM p_scalar WHERE {_key} IS NOT NULL GROUP BY 1""")


def _productivity(average: str) -> str:
    return f"""SELECT *, {r('total_ops / nullif(active_days, 0)', 1)} AS ops_per_day FROM (
      SELECT worker, {_TOTALS}, {average}, count(DISTINCT date) AS active_days
      FROM p_scalar WHERE worker IS NOT NULL GROUP BY 1)"""


oracle("worker_productivity", _productivity(_AVG2))
oracle("product_comparison", f"""
    SELECT product_label, {_TOTALS}, {_AVG2}, count(DISTINCT worker) AS unique_workers,
      count(DISTINCT process) AS unique_processes
    FROM p_scalar WHERE product_label IS NOT NULL GROUP BY 1""")
for _name, _key in (("daily_employees", "date"), ("weekly_employees", "week_number")):
    oracle(_name, f"""
        SELECT employee_name, {_key}, count(dialog_type) AS total_actions,
          {r(mean('response_time_sec'), 2)} AS avg_response_sec
        FROM w_scalar WHERE {drop_null('employee_name', _key)} GROUP BY 1, 2""")
oracle("kpi_overview", f"""
    SELECT count(*) AS operations, (SELECT count(*) FROM w_scalar) AS employee_actions, {_AVG6},
      {_QTY} AS total_quantity, count(DISTINCT worker) AS active_workers,
      (SELECT count(DISTINCT employee_name) FROM w_scalar) AS active_employees FROM p_scalar""")
oracle("product_kpis", f"""
    SELECT product_label, count(*) AS operations, {_QTY} AS quantity, {_AVG6},
      count(DISTINCT worker) AS workers FROM p_scalar WHERE product_label IS NOT NULL GROUP BY 1""")
oracle("worker_detail_kpis", f"""
    SELECT worker, count(*) AS total_ops, {_QTY} AS total_qty, {_AVG6},
      count(DISTINCT date) AS active_days FROM p_scalar WHERE worker IS NOT NULL GROUP BY 1""")
oracle("worker_detail_daily", """
    SELECT worker, date, count(*) AS ops FROM p_scalar
    WHERE worker IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2""")
oracle("worker_detail_mix", """
    SELECT worker, process, count(*) AS count FROM p_scalar
    WHERE worker IS NOT NULL AND process IS NOT NULL GROUP BY 1, 2""")
oracle("employee_scorecard", f"""
    SELECT *, {r('total_actions / nullif(active_days, 0)', 1)} AS actions_per_day FROM (
      SELECT employee_name, count(dialog_type) AS total_actions,
        {r(mean('response_time_sec'))} AS avg_response_sec, count(DISTINCT date) AS active_days,
        count(DISTINCT session_id) AS total_sessions
      FROM w WHERE employee_name IS NOT NULL GROUP BY 1)""")

for _grain, _key in (("daily", "date"), ("weekly", "week_number")):
    for _metric, _expr in (("count", "count(process)"), ("qty", _QTY),
                           ("duration", r(mean("duration_sec_final")))):
        for _split, _keys in (("split", (_key, "product_label")), ("total", (_key,))):
            oracle(f"trend_{_grain}_{_metric}_{_split}", f"""
                SELECT {', '.join(_keys)}, {_expr} AS value FROM p_scalar
                WHERE {drop_null(*_keys)} GROUP BY {', '.join(_keys)}""")
for _metric in S.RANK_METRICS:
    oracle(f"rank_workers_{_metric}", f"""
        SELECT * REPLACE ({r('avg_duration')} AS avg_duration) FROM (
          {_productivity(mean('duration_sec_final') + ' AS avg_duration')})
        ORDER BY {_metric} DESC NULLS LAST, total_ops DESC, worker LIMIT 20""")
oracle("top15_workers", f"""
    SELECT worker, {_TOTALS} FROM p_scalar WHERE worker IS NOT NULL
    GROUP BY 1 ORDER BY total_ops DESC, worker LIMIT 15""")


# --- chart datasets -----------------------------------------------------------

def _counts(name, table, *keys, count="count"):
    oracle(name, f"""SELECT {', '.join(keys)}, count(*) AS {count} FROM {table}
        WHERE {drop_null(*keys)} GROUP BY {', '.join(keys)}""")


_counts("daily_ops_by_product", "p_scalar", "date", "product_label", count="ops_count")
_counts("process_by_product_long", "p_scalar", "process", "product_label")
_counts("hourly_by_product", "p_scalar", "product_label", "hour")
_counts("hourly_total", "p_scalar", "hour")
_counts("weekday_daily_ops", "p_scalar", "date", "weekday_name", "day_of_week", count="ops")
_counts("ops_trend", "p_scalar", "date", count="ops")
_counts("actions_trend", "w_scalar", "date", count="actions")
_counts("hour_heatmap_long", "p_scalar", "day_of_week", "hour")
_counts("daily_actions_by_employee", "w_scalar", "date", "employee_name", count="actions")
_counts("hourly_actions_by_employee", "w_scalar", "employee_name", "hour", count="actions")
_counts("dialog_by_employee_long", "w_scalar", "dialog_type", "employee_name")
_counts("weekly_actions_by_employee", "w_scalar", "employee_name", "week_number", count="actions")
oracle("daily_qty_by_product", f"""
    SELECT date, product_label, {_QTY} AS total_qty FROM p_scalar
    WHERE {drop_null('date', 'product_label')} GROUP BY 1, 2""")


def _matrix(table, row, column):
    return f"""
    SELECT a.{row}, string_agg(b.{column} || '=' || coalesce(n, 0), ';' ORDER BY b.{column}) AS cells
    FROM (SELECT DISTINCT {row} FROM {table} WHERE {drop_null(row, column)}) a
      CROSS JOIN (SELECT DISTINCT {column} FROM {table} WHERE {drop_null(row, column)}) b
      LEFT JOIN (SELECT {row}, {column}, count(*) AS n FROM {table} GROUP BY 1, 2) c
        ON a.{row} = c.{row} AND b.{column} = c.{column}
    GROUP BY 1"""


oracle("process_by_product", _matrix("p_scalar", "product_label", "process"))
oracle("dialog_by_employee", _matrix("w_scalar", "employee_name", "dialog_type"))
oracle("product_split", f"""
    SELECT product_label, count(*) AS count,
      {r('count(*) / (SELECT count(product_label) FROM p_scalar) * 100')} AS share_pct
    FROM p_scalar WHERE product_label IS NOT NULL GROUP BY 1""")
oracle("hour_heatmap", f"""
    SELECT {list(WEEKDAY_LABELS)}[day_of_week + 1] AS weekday,
      {', '.join(f'count(*) FILTER (WHERE hour = {h}) AS h{h}' for h in range(24))}
    FROM p_scalar WHERE day_of_week IS NOT NULL AND hour IS NOT NULL GROUP BY day_of_week""")


# --- distributions ------------------------------------------------------------

def _histogram(table: str, value: str, by: str | None = None, cap: str = "global") -> str:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON true"
    present = f"{value} IS NOT NULL" + (f" AND {by} IS NOT NULL" if by else "")
    if cap == "group":
        limit = f"""(SELECT {by}, quantile_cont({value}, 0.99) AS cap FROM {table}
                    WHERE {present} GROUP BY {by}) USING ({by})"""
    else:
        limit = f"""(SELECT coalesce(quantile_cont({value}, 0.99), 100) AS cap FROM {table}
                    WHERE {value} IS NOT NULL) ON true"""
    return f"""
    SELECT {key}bin, {r('lo + bin * ((hi - lo) / 60)')} AS bin_start, coalesce(n, 0) AS count
    FROM (SELECT *, CAST(unnest(range(60)) AS INTEGER) AS bin FROM (
            SELECT {key}CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                   CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
            FROM kept {group}))
    LEFT JOIN (
      SELECT {key}CAST(CASE WHEN v < lo + g * width THEN g - 1
                 WHEN g < 59 AND v >= lo + (g + 1) * width THEN g + 1 ELSE g END AS INTEGER) AS bin,
             count(*) AS n
      FROM (SELECT kept.*, lo, (hi - lo) / 60 AS width,
                   least(floor((v - lo) / (hi - lo) * 60), 59) AS g
            FROM kept JOIN (
              SELECT {key}CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                     CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
              FROM kept {group}) {join})
      GROUP BY ALL) USING ({key}bin)""", f"""
    SELECT {key}{value} AS v FROM {table} JOIN {limit} WHERE {present} AND {value} <= cap"""


def _hist_oracle(name, *args, **kwargs):
    body, kept = _histogram(*args, **kwargs)
    oracle(name, f"SELECT * FROM (WITH kept AS ({kept}) {body})")


_hist_oracle("duration_histogram", "p_scalar", "duration_sec_final")
_hist_oracle("duration_histogram_by_product", "p_scalar", "duration_sec_final", "product_label")
_hist_oracle("response_histogram_by_employee", "w_scalar", "response_time_sec", "employee_name", "group")
_hist_oracle("response_histogram_global_cap", "w_scalar", "response_time_sec", "employee_name")


def _box(source: str, by: str | None = None) -> str:
    """Box statistics of column v of a sub-select."""
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    join = f"JOIN q USING ({by})" if by else "JOIN q ON true"
    low, high = "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"
    return f"""
    SELECT * FROM (WITH s AS ({source}),
      q AS (SELECT {key}quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                   quantile_cont(v, 0.75) AS q3, count(v) AS n FROM s {group})
    SELECT {key}max(n) AS rows, {r('max(q1)')} AS q1, {r('max(median)')} AS median, {r('max(q3)')} AS q3,
      {r(f'min(v) FILTER (WHERE v >= {low})')} AS whisker_low,
      {r(f'max(v) FILTER (WHERE v <= {high})')} AS whisker_high,
      count(*) FILTER (WHERE v < {low} OR v > {high}) AS outliers
    FROM s {join} {group})"""


oracle("box_weekday_ops", _box("""SELECT weekday_name, CAST(count(*) AS DOUBLE) AS v FROM p_scalar
    WHERE date IS NOT NULL GROUP BY date, weekday_name""", "weekday_name"))
oracle("box_duration", _box(
    "SELECT duration_sec_final AS v FROM p_scalar WHERE duration_sec_final IS NOT NULL"))
oracle("box_duration_by_product", _box("""SELECT product_label, duration_sec_final AS v FROM p_scalar
    WHERE duration_sec_final IS NOT NULL AND product_label IS NOT NULL""", "product_label"))
oracle("box_response_by_employee", _box("""SELECT employee_name, response_time_sec AS v FROM w_scalar
    WHERE response_time_sec IS NOT NULL AND employee_name IS NOT NULL""", "employee_name"))
oracle("box_outlier_points", """
    SELECT product_label, duration_sec_final AS value, count(*) AS count
    FROM p_scalar JOIN (SELECT product_label, quantile_cont(duration_sec_final, 0.25) AS q1,
                               quantile_cont(duration_sec_final, 0.75) AS q3
                        FROM p_scalar GROUP BY 1) USING (product_label)
    WHERE duration_sec_final < q1 - 1.5 * (q3 - q1) OR duration_sec_final > q3 + 1.5 * (q3 - q1)
    GROUP BY 1, 2""")


def _corr(table: str, columns, digits: int = 6) -> str:
    pairs = [(a, b) for a in columns for b in columns]
    cells = ", ".join(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS "{a}|{b}"' for a, b in pairs)
    names = ", ".join(f'"{a}|{b}"' for a, b in pairs)
    value = r("CASE WHEN isnan(x) THEN NULL ELSE x END", digits)
    return f"""
    SELECT split_part(pair, '|', 1) AS feature_a, split_part(pair, '|', 2) AS feature_b, {value} AS r
    FROM (SELECT {cells} FROM {table}) UNPIVOT INCLUDE NULLS (x FOR pair IN ({names}))"""


oracle("corr_products", _corr("p", S.PRODUCT_CORRELATION))
oracle("corr_workers", _corr("w", S.WORKER_CORRELATION))
oracle("corr_products_dash", _corr("p", S.PRODUCT_CORRELATION_SHORT, 2))
oracle("corr_workers_dash", _corr("w", S.WORKER_CORRELATION_SHORT, 2))

# --- anomalies ----------------------------------------------------------------


def _z(x, t):
    return f"coalesce(abs({x} - mean) / nullif(sd, 0) > {t}, false)"


def _iqr(x, f):
    return f"coalesce({x} < q1 - {f} * (q3 - q1) OR {x} > q3 + {f} * (q3 - q1), false)"


def _mask(x, key):
    method, z, f = Q.METHODS[key]
    return {"Z-Score": _z(x, z), "IQR": _iqr(x, f)}.get(method, f"({_z(x, z)} OR {_iqr(x, f)})")


def _stats(x):
    return (f"avg({x}) AS mean, stddev_samp({x}) AS sd, quantile_cont({x}, 0.25) AS q1, "
            f"quantile_cont({x}, 0.75) AS q3")


_DAILY = f"""SELECT date, count(*) AS row_ops, count(process) AS ops,
    CAST(sum(quantity_pcs) AS BIGINT) AS qty, {mean('duration_sec_final')} AS avg_dur
    FROM p_scalar WHERE date IS NOT NULL GROUP BY 1"""
_EMP = """SELECT employee_name, date, count(*) AS actions FROM w_scalar
    WHERE employee_name IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2"""
_EMP_STATS = f"SELECT employee_name, {_stats('actions')} FROM ({_EMP}) GROUP BY 1"

oracle("anomalous_days", f"""
    SELECT date, ops, {_z('ops', 2.5)} AS anomaly_zscore, {_iqr('ops', 1.5)} AS anomaly_iqr
    FROM (SELECT date, row_ops AS ops FROM ({_DAILY}))
    JOIN (SELECT {_stats('row_ops')} FROM ({_DAILY})) ON true
    WHERE {_z('ops', 2.5)} OR {_iqr('ops', 1.5)}""")
oracle("anomalous_days_by_employee", f"""
    SELECT employee_name, date, actions, {_z('actions', 2.5)} AS anomaly_z,
      {_iqr('actions', 1.5)} AS anomaly_iqr
    FROM ({_EMP}) JOIN ({_EMP_STATS}) USING (employee_name)
    WHERE {_z('actions', 2.5)} OR {_iqr('actions', 1.5)}""")
for _key in Q.METHODS:
    oracle(f"anomalous_days_{_key}", f"""
        SELECT date, ops, qty, {r('avg_dur', 2)} AS avg_dur
        FROM ({_DAILY}) JOIN (SELECT {_stats('ops')} FROM ({_DAILY})) ON true
        WHERE {_mask('ops', _key)}""")
    oracle(f"anomalous_days_by_employee_{_key}", f"""
        SELECT employee_name, date, actions FROM ({_EMP}) JOIN ({_EMP_STATS}) USING (employee_name)
        WHERE {_mask('actions', _key)}""")
    for _name, _table, _x in (("duration", "p_scalar", "duration_sec_final"),
                              ("response", "w_scalar", "response_time_sec")):
        oracle(f"{_name}_outliers_{_key}", f"""
            SELECT count(*) AS total, count(*) FILTER (WHERE {_mask(_x, _key)}) AS outliers,
              {r(f'count(*) FILTER (WHERE {_mask(_x, _key)}) / greatest(count(*), 1) * 100', 2)} AS outlier_pct
            FROM {_table} JOIN (SELECT {_stats(_x)} FROM {_table}) ON true WHERE {_x} IS NOT NULL""")
_BANDS = (f"{r('mean')} AS mean, {r('sd')} AS sd, {r('mean + 2.5 * sd')} AS upper, "
          f"{r('CASE WHEN mean - 2.5 * sd < 0 THEN 0 ELSE mean - 2.5 * sd END')} AS lower")
oracle("anomaly_bands", f"SELECT {_BANDS} FROM (SELECT {_stats('row_ops')} FROM ({_DAILY}))")
oracle("anomaly_bands_operations", f"""
    SELECT {_BANDS.replace('2.5', str(Q.METHODS['z'][1]))} FROM (SELECT {_stats('ops')} FROM ({_DAILY}))""")
oracle("anomaly_bands_by_employee", f"SELECT employee_name, {_BANDS} FROM ({_EMP_STATS})")

for _name, _table, _x, _short, _wide in (
        ("duration", "p_scalar", "duration_sec_final",
         "start_time, worker, process, product_label, duration_sec_final",
         "start_time, worker, process, product_label, duration_sec_final, quantity_pcs"),
        ("response", "w_scalar", "response_time_sec",
         "input_date, employee_name, dialog_type, response_time_sec",
         "input_date, employee_name, dialog_type, screen_heading, response_time_sec")):
    oracle(f"{_name}_outlier_rates", f"""
        SELECT total, outliers_z, {r('outliers_z / total * 100', 2)} AS pct_z,
               outliers_iqr, {r('outliers_iqr / total * 100', 2)} AS pct_iqr FROM (
          SELECT count(*) AS total, count(*) FILTER (WHERE {_z(_x, 3.0)}) AS outliers_z,
                 count(*) FILTER (WHERE {_iqr(_x, 1.5)}) AS outliers_iqr
          FROM {_table} JOIN (SELECT {_stats(_x)} FROM {_table}) ON true WHERE {_x} IS NOT NULL)""")
    for _key, _cols, _t, _n in ((f"top_{_name}_outliers", _short, 3.0, 10),
                                (f"top20_{_name}_outliers", _wide, 2.5, 20)):
        _ties = ", ".join(f"{c} NULLS LAST" for c in _cols.split(", ") if c != _x)
        oracle(_key, f"""
            SELECT {_cols} FROM {_table} JOIN (SELECT {_stats(_x)} FROM {_table}) ON true
            WHERE {_x} IS NOT NULL AND ({_z(_x, _t)} OR {_iqr(_x, 1.5)})
            ORDER BY {_x} DESC, {_ties} LIMIT {_n}""")

# --- anonymisation ------------------------------------------------------------
oracle("system_names", "SELECT name, is_system FROM n_all")
oracle("name_map", "SELECT real, fake, position, is_system FROM n_map")
oracle("employee_id_map", "SELECT real, fake, position FROM id_map")
oracle("equipment_map", "SELECT real, fake FROM eq_map")
oracle("anonymize_products", """
    SELECT sales_order, start_time, fake AS worker FROM p_clean LEFT JOIN n_map ON worker = real""")
oracle("scrub_text", """
    SELECT input_date, prompt_date, h.clean AS screen_heading, j.clean AS json_text
    FROM w_clean LEFT JOIN scrubbed h ON screen_heading = h.t LEFT JOIN scrubbed j ON json_text = j.t""")
oracle("scrub_nested_names", """
    SELECT input_date, prompt_date, h.clean AS screen_heading, j.clean AS json_text
    FROM w_clean LEFT JOIN nest_scrubbed h ON screen_heading = h.t LEFT JOIN nest_scrubbed j ON json_text = j.t""")
oracle("anonymize_workers", """
    SELECT input_date, prompt_date, n_map.fake AS employee_name, id_map.fake AS employee_id,
      eq_map.fake AS equipment, h.clean AS screen_heading, j.clean AS json_text
    FROM w_clean LEFT JOIN n_map ON employee_name = n_map.real
      LEFT JOIN id_map ON employee_id = id_map.real LEFT JOIN eq_map ON equipment = eq_map.real
      LEFT JOIN scrubbed h ON screen_heading = h.t LEFT JOIN scrubbed j ON json_text = j.t""")
oracle("unmapped_counts", """
    SELECT 'products' AS table_name, count(*) - count(worker) AS unmapped FROM p_clean
    UNION ALL SELECT 'workers', count(*) - count(employee_name) FROM w_clean""")
oracle("anonymize_report", """
    SELECT count(*) FILTER (WHERE NOT is_system) AS personal_names,
      count(*) FILTER (WHERE is_system) AS system_names,
      (SELECT count(*) FROM id_map) AS employee_ids,
      (SELECT count(*) FROM eq_map WHERE real <> fake) AS equipment_changed FROM n_map""")
oracle("anonymize_sample", """
    SELECT real, fake FROM n_map WHERE NOT is_system ORDER BY real LIMIT 15""")
