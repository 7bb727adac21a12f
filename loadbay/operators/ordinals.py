"""Numbering distinct values in sort order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadbay.session import cut


def ordinals(df: DataFrame, column: str, name: str = "position") -> DataFrame:
    """0, 1, 2, ... in the sort order of ``column``.

    A range-partitioned sort numbers rows inside its partitions; the result is
    materialised in the shared folder, so partition membership cannot change on a
    retry, and the offset of each partition is the running total of the sizes.
    """
    spot = df.orderBy(column).withColumn("spot", F.monotonically_increasing_id())
    placed = cut(spot).withColumn("part", F.shiftright("spot", 33))
    # runs over one row per partition of the sort
    before = (Window.partitionBy(F.lit(0)).orderBy("part")
                    .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (placed.groupBy("part").agg(F.count("*").alias("size"))
                     .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")))
    inside = F.col("spot").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(offsets, "part")
                  .withColumn(name, F.col("offset") + inside)
                  .drop("spot", "part", "offset"))
