import datetime as dt

import pytest

from loadbay.operators import filters as FL

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    p = spark.createDataFrame(
        [(D(2024, 1, 1), "a", "w1", "p1"), (D(2024, 1, 2), "a", "W2", "p2"),
         (D(2024, 1, 3), "b", None, "p1"), (None, "b", "w1", "p1"), (D(2024, 1, 5), "b", "w1", None)],
        "date date, product_label string, worker string, process string")
    w = spark.createDataFrame(
        [(D(2023, 12, 31), "e1"), (D(2024, 1, 1), "e1"), (D(2024, 1, 5), "e2"),
         (D(2024, 1, 6), "e2"), (None, "e1"), (D(2024, 1, 2), None)], "date date, employee_name string")
    return p, w


def n(tables, f):
    p, w = FL.apply_filters(*tables, f)
    return p.count(), w.count()


def test_range_is_inclusive_and_missing_never_passes(tables):
    assert n(tables, FL.Filters((D(2024, 1, 1), D(2024, 1, 5)))) == (2, 2)
    assert n(tables, FL.Filters((D(2024, 1, 2), D(2024, 1, 2)))) == (1, 0)


def test_without_range_both_tables_use_the_product_bounds(tables):
    assert n(tables, FL.Filters()) == (2, 2)


def test_lists(spark, tables):
    assert n(tables, FL.Filters(products=["b"])) == (0, 2)
    assert n(tables, FL.Filters(workers=["w1"], employees=["e1"])) == (1, 1)
    assert n(tables, FL.Filters(products=[], employees=[])) == (0, 0)
    many = spark.createDataFrame([("e2",), ("e2",), ("zz",)], "name string")
    assert n(tables, FL.Filters(employees=many)) == (2, 1)


def test_range_filter_reaches_the_scan(spark, tables, tmp_path):
    path = str(tmp_path / "p")
    tables[0].write.parquet(path)
    f = FL.Filters((D(2024, 1, 1), D(2024, 1, 2)), products=["a"])
    plan = FL.filter_products(spark.read.parquet(path), f)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(date,2024-01-01)" in plan and "product_label" in plan.split("PushedFilters")[1]


def test_options_search_bounds_summary(tables):
    p, w = tables
    got = [tuple(r) for r in FL.filter_options(p, w).collect()]
    assert got == [("employee_name", "e1"), ("employee_name", "e2"), ("process", "p1"), ("process", "p2"),
                   ("product_label", "a"), ("product_label", "b"), ("worker", "W2"), ("worker", "w1")]
    assert [r.worker for r in FL.search_workers(p, "W").collect()] == ["W2", "w1"]
    assert tuple(FL.date_bounds(p, w).first()) == (D(2023, 12, 31), D(2024, 1, 6))
    row = FL.filter_summary(p, w, FL.Filters(products=["a"])).first()
    assert row.asDict() == {"products_selected": 2, "products_total": 5,
                            "workers_selected": 2, "workers_total": 6}


def test_explore_skips_absent_columns(tables):
    assert FL.explore(tables[0], FL.PRODUCT_DEFAULT).columns == [
        "date", "worker", "process", "product_label"]
    assert FL.explore(tables[0]).columns == tables[0].columns
