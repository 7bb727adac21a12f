"""Interactive selection expressed as predicates that reach the Parquet scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadbay import schemas as S


@dataclass(frozen=True)
class Filters:
    """A selection. ``None`` selects every value, an empty list none; rows without a
    value never pass.

    Lists are short choices made by a person and become ``IN`` predicates; a large
    choice is given as a one-column DataFrame and becomes a left semi join.
    """

    date_range: tuple[dt.date, dt.date] | None = None
    products: Sequence[str] | DataFrame | None = None
    workers: Sequence[str] | DataFrame | None = None
    processes: Sequence[str] | DataFrame | None = None
    employees: Sequence[str] | DataFrame | None = None

    def bounds(self, products: DataFrame) -> tuple[Column, Column]:
        """The date range, or else the product table's own, for both tables."""
        if self.date_range is not None and len(self.date_range) == 2:
            return F.lit(self.date_range[0]), F.lit(self.date_range[1])
        span = products.agg(F.struct(F.min("date").alias("d0"), F.max("date").alias("d1"))).scalar()
        return span["d0"], span["d1"]


def _pick(df: DataFrame, column: str, choice) -> DataFrame:
    if choice is None:
        return df.where(F.col(column).isNotNull())
    if isinstance(choice, DataFrame):
        return df.join(choice.select(F.col(choice.columns[0]).alias(column)), column, "left_semi")
    return df.where(F.col(column).isin(list(choice)))


def filter_products(products: DataFrame, f: Filters) -> DataFrame:
    d0, d1 = f.bounds(products)
    out = products.where(F.col("date").between(d0, d1))
    out = _pick(out, "product_label", f.products)
    out = _pick(out, "worker", f.workers)
    return _pick(out, "process", f.processes)


def filter_workers(products: DataFrame, workers: DataFrame, f: Filters) -> DataFrame:
    d0, d1 = f.bounds(products)
    return _pick(workers.where(F.col("date").between(d0, d1)), "employee_name", f.employees)


def apply_filters(products: DataFrame, workers: DataFrame, f: Filters):
    return filter_products(products, f), filter_workers(products, workers, f)


def filter_options(products: DataFrame, workers: DataFrame) -> DataFrame:
    """(option, value): the distinct choices of every list, without NULL."""
    kinds = ["product_label", "process", "worker"]
    p = products.select(*kinds).unpivot([], kinds, "option", "value")
    w = workers.select(F.lit("employee_name").alias("option"), F.col("employee_name").alias("value"))
    return (p.unionAll(w).where(F.col("value").isNotNull())
             .distinct().orderBy("option", "value"))


def search_workers(products: DataFrame, text: str) -> DataFrame:
    """Distinct worker names containing the text, ignoring case."""
    hit = F.contains(F.lower("worker"), F.lower(F.lit(text)))
    return products.where(hit).select("worker").distinct().orderBy("worker")


def date_bounds(products: DataFrame, workers: DataFrame) -> DataFrame:
    dates = products.select("date").unionAll(workers.select("date"))
    return dates.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def filter_summary(products: DataFrame, workers: DataFrame, f: Filters) -> DataFrame:
    """Selected and total row counts of both tables in one row."""
    p, w = apply_filters(products, workers, f)

    def n(df):
        return df.agg(F.count("*")).scalar()

    return products.agg(F.count("*").alias("products_total")).select(
        n(p).alias("products_selected"), "products_total",
        n(w).alias("workers_selected"), n(workers).alias("workers_total"))


def explore(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Chosen columns that exist; an empty choice shows everything."""
    chosen = [c for c in columns if c in df.columns]
    return df.select(*chosen) if chosen else df


PRODUCT_DEFAULT = S.PRODUCT_EXPLORE
WORKER_DEFAULT = S.WORKER_EXPLORE
