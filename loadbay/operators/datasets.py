"""The tables behind the charts: counts and sums over small key combinations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadbay.functions import columns as C
from loadbay.operators.summaries import keyed

# --- fixed values: weekday labels, Monday first -------------------------------
WEEKDAY_LABELS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def counts(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key combination (NULL keys left out)."""
    return keyed(df, *keys).agg(F.count("*").alias(name))


def daily_quantity(df: DataFrame) -> DataFrame:
    return keyed(df, "date", "product_label").agg(C.total("quantity_pcs").alias("total_qty"))


def product_split(df: DataFrame) -> DataFrame:
    """Operations per product and their share in percent."""
    per = counts(df, "product_label")
    whole = df.agg(F.count("product_label")).scalar()
    return per.withColumn("share_pct", C.ratio("count", whole) * 100)


def matrix(df: DataFrame, row: str, column: str,
           values: Sequence | None = None) -> DataFrame:
    """Zero-filled count matrix, one output column per value of ``column``.

    The counts are aggregated before they are pivoted. ``values`` fixes the output
    columns; without it Spark looks them up and refuses more than
    ``spark.sql.pivotMaxValues`` of them, so put the bounded side into columns.
    """
    per = counts(df, row, column, name="n")
    grouped = per.groupBy(row).pivot(column, list(values) if values is not None else None)
    return grouped.agg(F.sum("n")).na.fill(0)


def matrix_rows(df: DataFrame, row: str, column: str) -> DataFrame:
    """The whole zero-filled matrix, one row per value of ``row``: ``cells`` is an array of (value, n)
    with every value of ``column`` that occurs anywhere, in order. The values come from the data (a
    list of distinct values, as long as a chart's axis), so none is left out."""
    per = counts(df, row, column, name="n")
    axis = per.agg(F.sort_array(F.collect_set(F.col(column).cast("string")))).scalar()
    grouped = per.groupBy(row).agg(F.map_from_entries(F.collect_list(
        F.struct(F.col(column).cast("string").alias("k"), "n"))).alias("m"))
    cells = F.transform("axis", lambda v: F.struct(
        v.alias("value"), F.coalesce(F.try_element_at("m", v), F.lit(0)).alias("n")))
    return grouped.withColumn("axis", axis).select(row, cells.alias("cells"))


def weekday_label(day_of_week: str | Column) -> Column:
    labels = F.array(*[F.lit(x) for x in WEEKDAY_LABELS])
    return F.element_at(labels, C.col(day_of_week) + 1)


def hour_heatmap(df: DataFrame, hours: Sequence[int] | None = tuple(range(24))) -> DataFrame:
    """Weekday x hour counts; rows only for weekdays that occur."""
    wide = matrix(df, "day_of_week", "hour", hours)
    return wide.select(weekday_label("day_of_week").alias("weekday"),
                       *[F.col(f"`{c}`").alias(f"h{c}") for c in wide.columns
                         if c != "day_of_week"])
