"""Scalar rules: coercion, rounding, calendar parts, durations, categories."""

import datetime as dt

from pyspark.sql import functions as F

from loadbay.functions import columns as C
from loadbay.operators import clean, features


def values(df, expr):
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def strings(spark, *items):
    return spark.createDataFrame([(x,) for x in items], "s string").coalesce(1)


def test_text_to_int_truncates_and_defaults_to_zero(spark):
    df = strings(spark, "12.7", "-12.7", "x", None, "NaN", "1e3", "Infinity", "")
    assert values(df, C.parse_int("s"))[:6] == [12, -12, 0, 0, 0, 1000]
    assert values(df, C.parse_int("s"))[7] == 0


def test_text_to_double_has_no_nan(spark):
    df = strings(spark, "1.5", "x", None, "NaN", "-2")
    assert values(df, C.parse_double("s")) == [1.5, None, None, None, -2.0]


def test_timestamps_parse_or_become_null(spark):
    df = strings(spark, "2024-01-02 03:04:05.678901", "bad", None, "2024-02-30 00:00:00")
    assert values(df, C.parse_timestamp("s")) == [
        dt.datetime(2024, 1, 2, 3, 4, 5, 678901), None, None, None]
    us = strings(spark, "1/31/2024 13:05:06", "31/1/2024 13:05:06")
    assert values(us, C.parse_timestamp("s", "M/d/yyyy HH:mm:ss")) == [
        dt.datetime(2024, 1, 31, 13, 5, 6), None]


def test_rounding_is_half_even_after_scaling(spark):
    df = spark.createDataFrame([(0.125,), (0.285,), (2.5,), (None,)], "x double").coalesce(1)
    assert values(df, C.round_half_even("x", 2)) == [0.12, 0.28, 2.5, None]
    assert values(df, C.round_half_even("x", 0))[2] == 2.0


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(5.0,), (-3.0,), (None,)], "x double").coalesce(1)
    assert values(df, C.not_negative("x")) == [5.0, 0.0, None]


def test_calendar_at_a_year_boundary(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 12, 29, 23, 59),), (dt.datetime(2024, 12, 30),), (None,)],
        "t timestamp_ntz").coalesce(1)
    got = [tuple(r)[1:] for r in features.with_calendar(df, "t").collect()]
    assert got == [
        (dt.date(2024, 12, 29), 23, 6, "Sunday", 52, 12, 1),
        (dt.date(2024, 12, 30), 0, 0, "Monday", 1, 12, 0),
        (None, None, None, None, None, None, 0)]


def test_process_category(spark):
    df = strings(spark, "341 - Shipping - X", "SYSTEM", "\t100\n - a", "7 -b", None, " - x")
    assert values(df, C.process_category("s")) == ["341", "SYSTEM", "100", "7 -b", None, ""]


def test_system_names(spark):
    df = strings(spark, "SYSTEM", "USER12", "USER", "XUSER1", "Ann", None, "USER1x", "VVAH")
    assert values(df, C.is_system_name("s")) == [True, True, False, False, False, None, False, True]


def test_final_duration_prefers_positive_recorded(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1, 30)
    df = spark.createDataFrame(
        [(7, t0, t1), (0, t0, t1), (0, t1, t0), (0, None, t1), (-5, t0, t1)],
        "duration_sec bigint, start_time timestamp_ntz, end_time timestamp_ntz").coalesce(1)
    got = [(r.computed_duration_sec, r.duration_sec_final, r.duration_min)
           for r in features.with_durations(df).collect()]
    assert got == [(90.0, 7.0, 0.12), (90.0, 90.0, 1.5), (0.0, 0.0, 0.0),
                   (None, None, None), (90.0, 90.0, 1.5)]


def test_means_do_not_depend_on_partitioning(spark):
    rows = [(0.1 * i % 7.3,) for i in range(5000)]
    one = spark.createDataFrame(rows, "x double")
    a = one.coalesce(1).agg(C.mean_seconds("x"), C.sum_seconds("x")).first()
    b = one.repartition(7).agg(C.mean_seconds("x"), C.sum_seconds("x")).first()
    assert tuple(a) == tuple(b)
    empty = one.where("x < 0").agg(C.mean_seconds("x"), C.sum_seconds("x")).first()
    assert tuple(empty) == (None, 0.0)


def test_missing_and_duplicate_reports(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), (None, None)],
                               "k string, v string")
    assert {tuple(r) for r in clean.missing_report(df).collect()} == {("k", 1, 25.0), ("v", 3, 75.0)}
    assert tuple(clean.duplicate_report(df).first()) == (4, 1)
    once = clean.drop_duplicate_rows(df)
    assert once.count() == 3 and clean.drop_duplicate_rows(once).count() == 3
    assert clean.missing_report(df.where("k = 'none'")).count() == 0
    assert tuple(clean.duplicate_report(df.where("k = 'none'")).first()) == (0, 0)


def test_sentinel_expiration(spark):
    df = spark.createDataFrame([("1900-01-01",), ("1999-12-31 23:59:59",), ("2000-01-01",), ("x",)],
                               "expiration string").coalesce(1)
    typed = clean.parse_timestamps(df, ["expiration"])
    assert tuple(clean.count_sentinel_expiration(typed).first()) == (4, 2)
    kept = values(clean.drop_sentinel_expiration(typed), F.col("expiration"))
    assert kept == [None, None, dt.datetime(2000, 1, 1), None]


def test_copies_are_dropped_where_the_rows_lie(spark, tmp_path):
    """Equal values of different bits and NULLs in different places; rows without a copy are not shuffled."""
    data = [("a", None, 0.0), ("a", None, -0.0), (None, "a", 0.0), (None, "a", 0.0), (None, None, float("nan")),
            (None, None, float("nan")), ("b", "b", None)] + [(f"x{i}", "y", 1.0) for i in range(5000)] + [("hot", "", 2.0)] * 3000
    df = spark.createDataFrame(data, "k string, v string, n double").repartition(7)
    df.write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    out = clean.drop_duplicate_rows(df)
    got = out.collect()
    assert len(got) == 5005 and out.columns == df.columns and out.exceptAll(df.distinct()).count() == 0
    assert df.exceptAll(out).select("k").distinct().count() == 3          # copies of a, (None, a or NaN), hot
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1                    # that of the rows that have copies


def test_rows_without_a_copy_stay_however_many_hashes_repeat(spark, settings, monkeypatch):
    """The table of repeated hashes is broadcast as it is bounded, whatever Spark's limit; all bits set, still right."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    df = spark.range(0, 3000, 1, 5).selectExpr("CAST(id % 2900 AS STRING) k", "IF(id % 7 = 0, NULL, id % 2900) v")
    for words in (clean.MARK_WORDS, 1):
        monkeypatch.setattr(clean, "MARK_WORDS", words)
        out = clean.drop_duplicate_rows(df)
        assert out.exceptAll(df.distinct()).count() == 0 and df.distinct().exceptAll(out).count() == 0
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
