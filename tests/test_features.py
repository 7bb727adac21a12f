"""Group features and sessions, against rules worked out row by row."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.operators import features, sessions

T0 = dt.datetime(2024, 1, 1)


def layout(x):
    return [(f.name, f.dataType) for f in getattr(x, "schema", x)]


def worker_rows(spark, rows):
    """rows of (employee, input, prompt, dialog, device) as a cleaned input log."""
    data = [{"employee_id": e, "input_date": i, "prompt_date": p, "dialog_type": d, "device": v}
            for e, i, p, d, v in rows]
    schema = S.CLEAN_WORKERS
    full = [tuple(r.get(f.name) for f in schema) for r in data]
    return spark.createDataFrame(full, schema)


def product_rows(spark, rows):
    """rows of (label, worker, process, qty, start, seconds) as a cleaned product log."""
    data = [{"product_label": a, "worker": w, "process": p, "quantity_pcs": q, "start_time": t,
             "duration_sec": s} for a, w, p, q, t, s in rows]
    schema = S.CLEAN_PRODUCTS
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in data], schema)


def test_null_keys_get_null_features(spark):
    df = product_rows(spark, [("a", "w", "p", 1, T0, 5), (None, "w", None, 2, T0, 5),
                              ("a", None, "p", 4, T0, 5), ("a", "w", "p", 8, None, 5)])
    got = {r.quantity_pcs: r for r in features.product_features(df).collect()}
    assert [got[q].daily_product_ops_count for q in (1, 2, 4, 8)] == [2, None, 2, None]
    assert [got[q].worker_daily_ops for q in (1, 2, 4, 8)] == [1, 1, None, None]
    assert [got[q].worker_daily_qty for q in (1, 2, 4, 8)] == [3, 3, None, None]
    assert [got[q].worker_daily_duration_sec for q in (1, 2, 4, 8)] == [10.0, 10.0, None, None]
    assert [got[q].weekly_product_qty for q in (1, 2, 4, 8)] == [5, None, 5, None]


def test_counts_of_rows_and_of_values_differ(spark):
    df = product_rows(spark, [("a", "w", None, 1, T0, 0), ("a", "w", None, 2, T0, 0)])
    row = features.product_features(df).first()
    assert (row.daily_product_ops_count, row.worker_daily_ops, row.weekly_product_ops) == (2, 0, 0)


def test_weeks_of_all_years_are_pooled(spark):
    df = product_rows(spark, [("a", "w", "p", 1, dt.datetime(2023, 1, 4), 1),
                              ("a", "w", "p", 2, dt.datetime(2024, 1, 3), 1)])
    assert {r.weekly_product_qty for r in features.product_features(df).collect()} == {3}


def test_session_boundaries(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    df = worker_rows(spark, [("e", at(0), at(0), "d", "x"), ("e", at(1800), at(0), "d", "x"),
                             ("e", at(3601), at(0), "d", "x"), ("e", None, at(1), "d", "x"),
                             ("e", None, None, "d", "x"), (None, at(0), at(0), "d", "x")])
    out = features.worker_features(df)
    got = sorted(((r.input_date or dt.datetime.max, r.session_id) for r in out.where(
        "employee_id is not null").collect()))
    assert [s for _, s in got] == [1, 1, 2, 3, 4]
    assert out.where("employee_id is null").first().session_id is None
    assert layout(out) == layout(S.PREPARED_WORKERS)


def brute_sessions(rows, gap):
    """Multiset of (employee, input, session) by walking each employee's rows in order."""
    per = defaultdict(list)
    for e, i, *_ in rows:
        if e is not None:
            per[e].append(i)
    out = []
    for e, times in per.items():
        session, last = 0, None
        for t in sorted(times, key=lambda t: (t is None, t or T0)):
            if last is None or t is None or (t - last).total_seconds() > gap:
                session += 1
            out.append((e, t, session))
            last = t
    return sorted(out, key=repr)


@pytest.mark.parametrize("gap", [1800, 600, 7000, 1])
def test_sessions_equal_a_row_by_row_walk(spark, gap):
    rng = random.Random(gap)
    rows = []
    for n in range(3000):
        e = "hot" if n % 3 == 0 else f"e{rng.randrange(8)}"
        t = T0 + dt.timedelta(seconds=rng.choice([0.5, 1, gap / 3, gap]) * rng.randrange(400))
        rows.append((None if n % 101 == 0 else e, None if n % 17 == 0 else t,
                     None if n % 34 == 0 else t, "d", "x"))
    base = features.worker_scalars(worker_rows(spark, rows))
    for out in (sessions.sessionize(base, gap), features.with_activity_features(base, gap)):
        got = sorted(((r.employee_id, r.input_date, r.session_id)
                      for r in out.where("employee_id is not null").collect()), key=repr)
        assert got == brute_sessions(rows, gap)
        assert out.count() == len(rows)


def test_row_gaps_of_a_busy_moment_are_spread(spark, settings):
    """80 % of the rows in one half-hour of one employee, many at the very same time."""
    rng = random.Random(1)
    rows = [("hot", T0 + dt.timedelta(seconds=rng.randrange(0, 60)), T0, "d", f"x{n}") for n in range(8000)]
    rows += [(f"e{n % 40}", T0 + dt.timedelta(hours=n), T0, "d", "x") for n in range(1999)] + [(None, T0, T0, "d", "x")]
    base = features.worker_scalars(worker_rows(spark, rows))
    settings(adaptive__enabled="false", shuffle__partitions="16")
    ranged = sessions.in_ranges(base.where("employee_id is not null"), "employee_id", "input_date")
    sizes = [r["count"] for r in ranged.groupBy("part").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * 9999 / 16
    got = sorted((r.employee_id, r.input_date, r.previous_input) for r in sessions.row_gaps(base).collect()
                 if r.previous_input is not None)
    want, last = [], {}
    for e, t in sorted((r[0], r[1]) for r in rows if r[0]):
        if e in last:
            want.append((e, t, last[e]))
        last[e] = t
    assert got == sorted(want)


def test_many_undated_rows_of_one_employee_are_numbered_apart(spark):
    rows = [("e", None, T0, "d", f"x{n}") for n in range(500)] + [("e", T0, T0, "d", "x")]
    out = sessions.sessionize(features.worker_scalars(worker_rows(spark, rows)))
    assert sorted(r.session_id for r in out.collect()) == list(range(1, 502))


def test_employee_features_by_hand(spark):
    h = lambda d, hr, s=0: dt.datetime(2024, 1, d, hr, 0, s)
    df = worker_rows(spark, [
        ("e", h(1, 9, 4), h(1, 9), "scan", "a"), ("e", h(1, 9, 10), h(1, 9), None, "a"),
        ("e", h(8, 9, 1), h(8, 9), "scan", None), ("e", None, h(8, 9), "scan", "b")])
    rows = {r.input_date: r for r in features.worker_features(df).collect()}
    first = rows[h(1, 9, 4)]
    assert (first.employee_daily_actions, first.employee_daily_avg_response_sec,
            first.employee_daily_total_response_sec) == (1, 7.0, 14.0)
    assert (first.employee_weekly_actions, first.employee_hourly_action_count) == (1, 3)
    assert (first.employee_dialog_type_count, first.employee_device_usage_count) == (3, 2)
    lost = rows[None]
    assert lost.employee_daily_actions is None and lost.employee_hourly_action_count is None
    assert lost.is_weekend == 0 and lost.session_id == 3 and lost.employee_device_usage_count == 1
    assert rows[h(1, 9, 10)].employee_dialog_type_count is None


def test_prepared_layouts_and_empty_input(spark):
    p = features.product_features(product_rows(spark, []))
    w = features.worker_features(worker_rows(spark, []))
    assert layout(p) == layout(S.PREPARED_PRODUCTS) and len(p.columns) == 38 and p.count() == 0
    assert layout(w) == layout(S.PREPARED_WORKERS) and len(w.columns) == 36 and w.count() == 0


def test_skewed_joins_keep_every_row(spark, settings):
    """A third of the rows share one key; joins may not broadcast, and AQE splits."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
             adaptive__advisoryPartitionSizeInBytes="32KB",
             adaptive__coalescePartitions__parallelismFirst="false", shuffle__partitions="64")
    n = 60_000
    rows = spark.range(0, n, 1, 8).selectExpr(
        "CAST(id AS STRING) sales_order", "sha2(CAST(id AS STRING), 256) batch",
        "IF(id % 3 = 0, 'hot', IF(id % 3 = 1, NULL, concat('w', id % 50))) worker",
        "IF(id % 3 = 1, 'hot', concat('p', id % 40)) product_label",
        "timestampadd(DAY, IF(id % 3 = 0, 0, CAST(id % 30 AS INT)), TIMESTAMP_NTZ'2024-01-01') start_time",
        "CAST(id % 5 AS BIGINT) quantity_pcs", "'p' process")
    have = set(rows.columns)
    df = rows.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in S.CLEAN_PRODUCTS])
    out = features.product_features(df).select("batch", "worker", "worker_daily_ops", "weekly_product_qty")
    got = out.toPandas()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    assert len(got) == n and got["batch"].nunique() == n
    assert set(got.loc[got["worker"] == "hot", "worker_daily_ops"]) == {n // 3}
    assert got.loc[got["worker"].isna(), "worker_daily_ops"].isna().all()


@pytest.mark.parametrize("join", ["dialog", "worker_day"])
def test_each_group_join_splits_its_hot_key(spark, settings, join):
    """One key holds 80 % of the rows; the plan has this join alone."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
             adaptive__advisoryPartitionSizeInBytes="32KB",
             adaptive__coalescePartitions__parallelismFirst="false", shuffle__partitions="64")
    n = 60_000
    rows = spark.range(0, n, 1, 8)
    hot = "id % 5 > 0"
    if join == "dialog":
        df = rows.selectExpr("sha2(CAST(id AS STRING), 256) v", f"IF({hot}, 'e', concat('e', id % 300)) employee_id",
                             f"IF({hot}, 'd', concat('d', id % 7)) dialog_type")
        out = features.with_employee_dialog_count(df)
        got = out.where("employee_id = 'e' AND dialog_type = 'd'").select("employee_dialog_type_count")
    else:
        df = rows.selectExpr("sha2(CAST(id AS STRING), 256) v", f"IF({hot}, 'w', concat('w', id % 300)) worker",
                             f"date_add(DATE'2024-01-01', IF({hot}, 0, CAST(id % 40 AS INT))) date", "'p' process",
                             "1L quantity_pcs", "1.5D duration_sec_final")
        out = features.with_worker_day_features(df)
        got = out.where("worker = 'w'").select("worker_daily_ops")
    assert out.toPandas().shape[0] == n
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Join(skew=true)") == 1
    assert {r[0] for r in got.distinct().collect()} == {n * 4 // 5}


def test_sums_of_seconds_do_not_depend_on_order(spark):
    big = "CAST(id * 1000003 + 0.000001 * (id % 7) AS DOUBLE)"
    one = spark.range(0, 200_000, 1, 1).selectExpr(f"{big} x")
    many = spark.range(0, 200_000, 1, 37).selectExpr(f"{big} x").repartition(23)
    a, b = (df.agg(C.sum_seconds("x"), C.mean_seconds("x")).first() for df in (one, many))
    assert a == b and a[0] > 9e9


def test_product_rows_move_once_where_the_grid_is_small(spark):
    """To the worker totals, without the derived columns; the product grid comes to the rows."""
    df = product_rows(spark, [("a", f"w{i}", "p", i, T0 + dt.timedelta(days=i % 9), 5) for i in range(500)])
    out = features.product_features(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan if "Join LeftOuter" in x]) == 2
    assert physical.count("BroadcastHashJoin") >= 1 and "weekday_name" not in physical[physical.index("Join"):].split(
        "Exchange", 1)[-1]
    got = {r.quantity_pcs: (r.daily_product_ops_count, r.worker_daily_qty, r.weekday_name) for r in out.collect()}
    assert len(got) == 500 and got[9] == (56, 9, "Monday") and got[8] == (55, 8, "Tuesday")


def busy_worker_rows(spark):
    rng = random.Random(7)
    rows = []
    for n in range(1500):
        e = None if n % 50 == 0 else "hot" if n % 3 == 0 else f"e{rng.randrange(8)}"
        t = T0 + dt.timedelta(seconds=rng.choice([0.5, 600, 1800]) * rng.randrange(400))
        p = None if n % 34 == 0 else t - dt.timedelta(seconds=rng.randrange(-5, 9000))
        rows.append((e, None if n % 5 == 0 else t, p, None if n % 11 == 0 else f"d{n % 3}", None if n % 13 == 0 else f"v{n % 4}"))
    return worker_rows(spark, rows + rows[:40])


def test_gathered_employees_get_what_joined_ones_get(spark, monkeypatch):
    df = busy_worker_rows(spark)
    monkeypatch.setattr(sessions, "UNDATED_PER_SHARD", 60)           # several shards
    monkeypatch.setattr(sessions.with_grid_key, "__defaults__", (S.SESSION_GAP_SEC, 60, None))
    joined = sorted(map(repr, features.joined_features(df).select(*S.PREPARED_WORKERS.names).collect()))
    for hot_rows in (0, 300, 10 ** 6):                               # all, one or none joined
        out = features.worker_features(df, hot_rows=hot_rows)
        assert layout(out) == layout(S.PREPARED_WORKERS)
        assert sorted(map(repr, out.collect())) == joined


def test_input_rows_move_once(spark, settings):
    settings(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    plan = features.worker_features(busy_worker_rows(spark))._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if " Exchange " in x and "SinglePartition" not in x]
    assert len(exchanges) == 1 and "employee_id" in exchanges[0]
