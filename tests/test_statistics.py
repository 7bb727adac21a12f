"""Quantiles, histograms, boxes, correlation and masks against NumPy and pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.operators import anomalies, correlation, datasets, distribution, summaries
from loadbay.operators import quantiles as Q


def frame(spark, pdf, schema):
    clean = pdf.astype(object).where(pdf.notna(), None)
    return spark.createDataFrame([tuple(r) for r in clean.itertuples(index=False)], schema).repartition(3)


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(5)
    parts = {"flat": np.full(40, 3.25), "one": np.array([7.5]), "pair": np.array([1.0, 2.0]),
             "small": np.array([1.0, 2.0, 3.0, 10.0]),
             "tail": np.concatenate([rng.exponential(30, 3000), [1e7]]),
             "ties": rng.integers(0, 6, 2000).astype(float),
             "hot": np.concatenate([np.full(3000, 12.5), rng.normal(0, 1, 1500)])}
    pdf = pd.concat([pd.DataFrame({"g": k, "x": v}) for k, v in parts.items()])
    return pd.concat([pdf, pd.DataFrame({"g": ["tail", None, "void"], "x": [np.nan, 5.0, np.nan]})])


@pytest.mark.parametrize("accuracy", [20, 300, Q.ACCURACY])
def test_quantiles_per_group_and_overall(spark, groups, accuracy):
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    df = frame(spark, groups, "g string, x double")
    got = Q.quantiles(df, "x", probs, names, ["g"], accuracy).toPandas().set_index("g")
    want = groups.dropna().groupby("g")["x"].quantile(probs).unstack()
    assert set(got.index) == set(want.index)
    np.testing.assert_allclose(got.loc[want.index, names].to_numpy(), want.to_numpy(), rtol=1e-12)
    whole = Q.quantiles(df, "x", probs, names, accuracy=accuracy).first()
    np.testing.assert_allclose([whole[n] for n in names], groups["x"].quantile(probs), rtol=1e-12)
    empty = Q.quantiles(df.where("g = 'void'"), "x", probs, names).first()
    assert all(v is None for v in empty)


def test_known_quartiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    row = Q.quantiles(df, "x", [0.25, 0.75, 0.99], ["a", "b", "c"]).first()
    assert (row.a, row.b) == (1.75, 4.75) and row.c == pytest.approx(9.79)


@pytest.mark.parametrize("cap", ["group", "global"])
def test_histograms_equal_numpy(spark, groups, cap):
    df = frame(spark, groups, "g string, x double")
    got = distribution.histogram(df, "x", ["g"], cap=cap).toPandas()
    present = groups.dropna()
    everywhere = groups["x"].quantile(0.99)
    for g, part in present.groupby("g"):
        x = part["x"]
        x = x[x <= (x.quantile(0.99) if cap == "group" else everywhere)]
        mine = got[got["g"] == g].sort_values("bin")
        if len(x) == 0:
            assert mine.empty
            continue
        counts, edges = np.histogram(x, bins=60)
        assert mine["count"].tolist() == counts.tolist(), g
        np.testing.assert_allclose(mine["bin_start"], edges[:-1], rtol=1e-12, atol=1e-12)


def test_global_histogram_counts_every_capped_row(spark, groups):
    df = frame(spark, groups, "g string, x double")
    got = distribution.histogram(df, "x").toPandas().sort_values("bin")
    x = groups["x"].dropna()
    assert got["count"].tolist() == np.histogram(x[x <= x.quantile(0.99)], bins=60)[0].tolist()
    assert distribution.histogram(df.where("g = 'void'"), "x").count() == 0


def test_boxes(spark, groups):
    df = frame(spark, groups, "g string, x double")
    got = distribution.box_stats(df, "x", ["g"]).toPandas().set_index("g")
    for g, part in groups.dropna().groupby("g"):
        x = part["x"].to_numpy()
        q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        row = got.loc[g]
        np.testing.assert_allclose(
            [row.q1, row["median"], row.q3, row.whisker_low, row.whisker_high],
            [q1, med, q3, inside.min(), inside.max()], rtol=1e-12)
        assert row.outliers == len(x) - len(inside) and row["rows"] == len(x)
    points = distribution.outlier_points(df, "x", ["g"]).groupBy("g").agg(F.sum("count").alias("n"))
    assert {r.g: r.n for r in points.collect()} == {
        g: n for g, n in got["outliers"].items() if n > 0}


def test_describe_matches_pandas(spark, groups):
    pdf = groups[["x"]].assign(y=np.arange(len(groups)))
    got = summaries.describe(frame(spark, pdf, "x double, y bigint"), ["x", "y", "absent"])
    got = got.toPandas().set_index("feature")
    want = pdf.describe().round(2).T
    want.columns = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    np.testing.assert_allclose(got.loc[want.index, want.columns].to_numpy(dtype=float),
                               want.to_numpy(), rtol=1e-9)


def test_correlation_matches_pandas_pairwise(spark):
    rng = np.random.default_rng(3)
    n = 4000
    a = rng.normal(1e6, 2, n)
    pdf = pd.DataFrame({"a": a, "b": a * 0.5 + rng.normal(0, 1, n), "c": rng.integers(0, 24, n) * 1.0,
                        "d": 0.1, "e": -a, "f": np.nan})
    pdf.loc[::3, "b"] = np.nan
    pdf.loc[1::5, "c"] = np.nan
    pdf.loc[5:, "f"] = np.nan
    pdf.loc[0, "f"] = 1.0
    pdf["g"] = np.where(pdf["b"].isna(), 1.0, 4.0)  # constant wherever b is present
    cols = list(pdf.columns)
    got = correlation.correlation(frame(spark, pdf, ", ".join(f"{c} double" for c in cols)), cols + ["zz"])
    got = got.toPandas().pivot(index="feature_a", columns="feature_b", values="r")
    want = pdf.corr()
    got = got.loc[cols, cols].astype(float)
    assert got["d"].isna().all() and got["f"].isna().all()
    assert np.isnan(got.loc["b", "g"]) and np.isnan(got.loc["g", "b"])
    mask = want.notna() & got.notna()
    np.testing.assert_allclose(got.where(mask), want.where(mask), atol=1e-7)
    assert mask.loc[["a", "b", "c", "e"], ["a", "b", "c", "e"]].all().all()
    assert (got - got.T).abs().max().max() < 1e-12 and got.max().max() <= 1 + 1e-12


def days(spark, counts, label="date"):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i, n in enumerate(counts) for _ in range(n)]
    return spark.createDataFrame(rows, f"{label} date")


def test_anomalous_days(spark):
    got = anomalies.anomalous_days(days(spark, [10, 11, 9, 10, 12, 10, 9, 11, 10, 60])).collect()
    assert [(r.date.day, r.ops, r.anomaly_zscore, r.anomaly_iqr) for r in got] == [(10, 60, True, True)]
    assert anomalies.anomalous_days(days(spark, [7] * 9)).count() == 0
    assert anomalies.anomalous_days(days(spark, [7])).count() == 0
    assert anomalies.anomalous_days(days(spark, [])).count() == 0


def test_unknown_method_means_either_rule(spark):
    df = spark.createDataFrame([(float(x),) for x in [1] * 50 + [2] * 50 + [4]], "x double")
    n = lambda m: anomalies.outlier_summary(df, "x", m, z=4.0, factor=1.2).first().outliers
    assert (n("IQR"), n("Z-Score"), n("Combined"), n("anything")) == (1, 1, 1, 1)
    empty = anomalies.outlier_summary(df.where("x < 0"), "x").first()
    assert tuple(empty) == (0, 0, 0.0)
    assert tuple(anomalies.outlier_rates(df.where("x < 0"), "x").first()) == (0, 0, None, 0, None)


def test_bands_do_not_go_below_zero(spark):
    row = anomalies.bands(datasets.counts(days(spark, [1, 1, 1, 30]), "date", name="ops"), "ops").first()
    assert row.lower == 0.0 and row.upper == pytest.approx(8.25 + 2.5 * 14.5)
    lone = anomalies.bands(datasets.counts(days(spark, [4]), "date", name="ops"), "ops").first()
    assert lone["mean"] == 4.0 and lone.sd is None and lone.upper is None


def test_rankings_break_ties_by_operations_then_name(spark):
    rows = [("b", "p", 1, 5.0, 1), ("a", "p", 1, 5.0, 1), ("c", "p", 2, 5.0, 1), ("c", "p", 1, 5.0, 2)]
    df = spark.createDataFrame(
        [(w, p, q, d, dt.date(2024, 1, n)) for w, p, q, d, n in rows],
        "worker string, process string, quantity_pcs bigint, duration_sec_final double, date date")
    order = lambda m: [r.worker for r in summaries.rank_workers(df, m, 2).collect()]
    assert order("total_ops") == ["c", "a"] and order("ops_per_day") == ["c", "a"]
    with pytest.raises(ValueError):
        summaries.rank_workers(df, "age")
    assert summaries.worker_productivity(df).where("worker = 'c'").first().ops_per_day == 1.0


def test_matrix_and_heatmap_are_zero_filled(spark):
    df = spark.createDataFrame([(0, 3), (0, 3), (6, 23), (None, 1)], "day_of_week int, hour int")
    heat = {r.weekday: r for r in datasets.hour_heatmap(df).collect()}
    assert set(heat) == {"Mon", "Sun"} and heat["Mon"].h3 == 2 and heat["Sun"].h0 == 0
    wide = datasets.matrix(df, "day_of_week", "hour")
    assert wide.columns == ["day_of_week", "3", "23"]
    assert len(S.PRODUCT_CORRELATION_SHORT) == 8


def test_matrix_rows_keep_any_value(spark):
    df = spark.createDataFrame([("a", "x=1;y"), ("a", "x=1;y"), ("a", ""), ("b", "z"), (None, "z"), ("b", None)], "r string, c string")
    got = {r.r: [tuple(c) for c in r.cells] for r in datasets.matrix_rows(df, "r", "c").collect()}
    assert got == {"a": [("", 1), ("x=1;y", 2), ("z", 0)], "b": [("", 0), ("x=1;y", 0), ("z", 1)]}


def test_a_wild_value_widens_no_bracket(spark):
    df = spark.range(100_000).selectExpr("IF(id = 5, 2.5e11, id / 1e6) x").repartition(7)
    rows = df.select(F.col("x").alias("v"))
    limits = Q.sketch(rows, [0.5, 0.75], [], 2000)
    inside = Q.cells(rows, limits, 2, []).where("v IS NOT NULL").count()
    assert 2 <= inside <= 2 * 100_000 * 12 / 2000
    row = Q.quantiles(df, "x", [0.5, 0.75], ["a", "b"], accuracy=2000).first()
    values = sorted([i / 1e6 for i in range(100_000) if i != 5] + [2.5e11])
    assert row.hi == 2.5e11 and row.lo == 0.0
    assert row.a == pytest.approx((values[49_999] + values[50_000]) / 2, rel=1e-12)


@pytest.mark.parametrize("seed", range(4))
def test_ranks_lie_in_their_brackets_at_every_size(spark, seed):
    """Sketches of unlike partitions, ties, and group sizes around the accuracy."""
    rng = np.random.default_rng(seed)
    sizes = {"a": 1, "b": 199, "c": 200, "d": 201, "e": 5000, "f": 20_000}
    pdf = pd.concat([pd.DataFrame({"g": g, "x": np.round(rng.exponential(5, n), int(rng.integers(0, 6)))})
                     for g, n in sizes.items()])
    df = spark.createDataFrame(pdf).repartition(5, "x")
    probs = [0.0, 0.01, 0.25, 0.26, 0.5, 0.99, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    got = Q.quantiles(df, "x", probs, names, ["g"], 200).toPandas().set_index("g")
    want = pdf.groupby("g")["x"].quantile(probs).unstack()
    np.testing.assert_allclose(got.loc[want.index, names].to_numpy(), want.to_numpy(), rtol=1e-12)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_take_three_exchanges(spark, groups, by):
    df = frame(spark, groups, "g string, x double")
    out = Q.quantiles(df, "x", [0.25, 0.5], ["a", "b"], by)
    before = df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    subqueries = 1 if not by else 0               # the sketch's own exchange stands in its subquery
    shuffles = sum("Exchange" in x and "Broadcast" not in x and "Reused" not in x for x in plan.splitlines())
    assert before <= 1 and shuffles - 1 + subqueries <= 3 + subqueries, plan


def test_a_hot_group_is_split_where_rows_meet_limits(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 'hot', cast(id AS string)) g", "cast(id AS double) x")
    plan = distribution.box_stats(df, "x", ["g"])._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert joins and all("__key" in x for x in joins)
