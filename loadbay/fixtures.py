"""Adapters that shape the star-schema test tables into raw, dirty operation logs.

Every column is text, as it would arrive from a file export, and the dirt is
deterministic: duplicates, missing keys, unparseable numbers and dates, placeholder
expiry dates, ends before starts. Integer arithmetic only, so that a SQL engine can
build the same rows for comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined with part and supplier, as a product-movement log."""
    joined = (_table(spark, sf_dir, "lineitem")
              .join(_table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
              .join(_table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey")))
    timed = joined.selectExpr(
        "*",
        "(l_partkey * 31 + l_linenumber * 7) % 600"
        " + IF(l_partkey % 401 = 0, 7200, 0) AS true_dur",
        "timestampadd(SECOND, CAST((l_orderkey * 7919 + l_linenumber * 104729) % 86400 AS INT),"
        " l_shipdate) AS begun",
        "p_type < 'M' AS first_file",
        "explode(sequence(1, IF(l_orderkey % 97 = 0, 2, 1))) AS copy")
    return timed.selectExpr(
        "concat('W', l_suppkey % 5) AS warehouse",
        "concat('P-', l_partkey % 1000) AS source_position",
        "IF(l_returnflag = 'N', NULL, concat('T-', l_suppkey % 50)) AS target_position",
        """CASE concat(l_returnflag, l_linestatus)
             WHEN 'AF' THEN '100 - Goods Receipt' WHEN 'AO' THEN '110 - Putaway'
             WHEN 'NF' THEN '341 - Shipping Detail' WHEN 'NO' THEN '210 - Replenishment'
             WHEN 'RF' THEN '341 - Shipping - Express'
             ELSE IF(l_partkey % 50 = 0, NULL, 'SYSTEM') END AS process""",
        "IF(l_orderkey % 499 = 0, 'bad', CAST(begun AS STRING)) AS start_time",
        "CAST(timestampadd(SECOND, CAST(true_dur - IF(l_partkey % 97 = 0, 3600, 0) AS INT), begun)"
        " AS STRING) AS end_time",
        "CASE WHEN l_partkey % 10 = 0 THEN '0' WHEN l_partkey % 10 = 1 THEN NULL"
        " ELSE CAST(true_dur AS STRING) END AS duration_sec",
        "CASE WHEN l_suppkey = 7 THEN 'SYSTEM' WHEN l_suppkey % 20 = 0 THEN concat('USER', l_suppkey)"
        " WHEN l_suppkey % 33 = 1 THEN NULL ELSE s_name END AS worker",
        "concat('LP', l_orderkey) AS source_lp",
        "IF(l_linenumber % 3 = 0, NULL, concat('LT', l_orderkey)) AS target_lp",
        "CAST(l_partkey AS STRING) AS product_number",
        "concat('B', l_partkey % 37) AS batch",
        "IF(l_partkey % 11 = 0, '1900-01-01 00:00:00',"
        " CAST(timestampadd(DAY, CAST(l_partkey % 700 AS INT), l_shipdate) AS STRING)) AS expiration",
        "CASE WHEN l_partkey % 211 = 0 THEN 'n/a' WHEN l_partkey % 211 = 1 THEN '12.7'"
        " WHEN l_partkey % 211 = 2 THEN 'NaN'"
        " ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity_pcs",
        "CASE WHEN l_orderkey % 13 = 0 THEN 'PO-x' WHEN l_orderkey % 17 = 0 THEN 'NaN'"
        " WHEN l_linestatus = 'F' THEN CAST(l_orderkey AS STRING) END AS purchase_order",
        "CAST(l_orderkey AS STRING) AS sales_order",
        "CAST(l_linenumber AS STRING) AS order_line",
        "CAST(NULL AS STRING) AS source_mlp",
        "IF(first_file AND l_linenumber = 1, concat('M', l_suppkey), NULL) AS target_mlp",
        "p_brand AS product_label",
        "IF(first_file, 'moves_a.csv', 'moves_b.csv') AS source_file")


def raw_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a handheld input log."""
    # 25 years back, so that both logs cover common days
    events = _table(spark, sf_dir, "events").withColumn(
        "ts", F.expr("timestampadd(DAY, -9131, ts)")).selectExpr(
        "*", "explode(sequence(1, IF(event_id % 83 = 0, 2, 1))) AS copy")
    return events.selectExpr(
        "concat('W', user_id % 3) AS warehouse",
        "concat('E', lpad(CAST(user_id AS STRING), 6, '0')) AS employee_id",
        "concat('Employee#', lpad(CAST(user_id AS STRING), 6, '0')) AS employee_name",
        "concat('DEV', event_id % 7) AS device",
        "IF(event_id % 3 = 0, concat('FAE', lpad(CAST(user_id AS STRING), 6, '0')),"
        " concat('HW', event_id % 11)) AS equipment",
        "'PRD' AS solution_environment",
        "CAST(timestampadd(MICROSECOND, -CAST(IF(event_id % 100 = 0, -5000000,"
        " round(value * 100) * 10000) AS BIGINT), ts) AS STRING) AS prompt_date",
        "IF(event_id % 500 = 499, NULL, CAST(ts AS STRING)) AS input_date",
        "IF(event_id % 250 = 1, NULL, event_type) AS dialog_type",
        "CASE event_id % 4 WHEN 0 THEN concat('Welcome Employee#', lpad(CAST(user_id AS STRING), 6, '0'))"
        " WHEN 1 THEN '' ELSE IF(event_id % 20 = 2, concat('Employee#', lpad(CAST(user_id AS STRING), 6, '0'),"
        " ' to Employee#', lpad(CAST(user_id * 7 % 50 AS STRING), 6, '0')), event_type) END AS screen_heading",
        "concat('Scan ', event_type) AS screen_text",
        "IF(event_type = 'error', concat('E', event_id % 10), NULL) AS system_message",
        "concat(event_type, '?') AS dialog_prompt",
        "concat('F', event_id % 5) AS dialog_field",
        "CAST(NULL AS STRING) AS screen_options",
        "concat('V', event_id % 100) AS user_input",
        "IF(event_id % 5 = 0, concat('{\"user\": \"Employee#', lpad(CAST(user_id AS STRING), 6, '0'), '\"}'),"
        " props) AS json_text",
        "IF(user_id % 2 = 0, 'inputs_1.csv', 'inputs_2.csv') AS source_file")
