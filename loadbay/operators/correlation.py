"""Pearson correlation matrices in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.functions import columns as C


def correlation(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """(feature_a, feature_b, r) for every ordered pair.

    Rows missing either value are left out of that pair only. A column that is
    constant over a pair's rows has no correlation (NULL).

    Rows are grouped by which columns are missing. Within such a group every pair
    has the same rows, so plain sums of values and products serve all pairs at once,
    and groups are added up per pair at the end. Values are centred on the column
    mean first, so that products keep their precision.
    """
    present = [c for c in columns if c in df.columns]
    m = len(present)
    index = range(m)
    values = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(present)])
    means = values.selectExpr(
        "struct(" + ", ".join(f"avg(x{i}) AS x{i}" for i in index) + ")").scalar()
    missing = " + ".join(f"IF(x{i} IS NULL, {1 << i}L, 0L)" for i in index)
    centred = values.withColumn("m", means).selectExpr(
        f"{missing} AS missing", *[f"coalesce(x{i} - m.x{i}, 0D) AS d{i}" for i in index])

    def listed(expr, over):
        return "array(" + ", ".join(expr.format(*x) for x in over) + ")"

    one = [(i,) for i in index]
    upper = [(i, j) for i in index for j in index if i <= j]
    sums = centred.groupBy("missing").agg(
        F.count("*").alias("n"),
        F.expr(listed("sum(d{0})", one)).alias("s"),
        F.expr(listed("min(d{0})", one)).alias("lo"),
        F.expr(listed("max(d{0})", one)).alias("hi"),
        F.expr(listed("sum(d{0} * d{1})", upper)).alias("p"))

    # one row per missing-pattern and ordered pair; p holds the upper triangle row by row
    def at(i, j):
        return f"p[{i} * {m} - {i} * ({i} - 1) DIV 2 + {j} - {i}]"

    pairs = sums.selectExpr("*", f"explode(sequence(0, {m * m - 1})) AS k").selectExpr(
        "*", f"k DIV {m} AS a", f"k % {m} AS b").selectExpr(
        "a", "b", "n", "s[a] AS sa", "s[b] AS sb", f"{at('a', 'a')} AS aa", f"{at('b', 'b')} AS bb",
        f"{at('least(a, b)', 'greatest(a, b)')} AS ab",
        "lo[a] AS la", "hi[a] AS ha", "lo[b] AS lb", "hi[b] AS hb",
        "(missing & (shiftleft(1L, CAST(a AS INT)) | shiftleft(1L, CAST(b AS INT)))) = 0 AS complete")
    totals = pairs.where("complete").groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "aa", "bb", "ab")],
        *[F.min(c).alias(c) for c in ("la", "lb")], *[F.max(c).alias(c) for c in ("ha", "hb")])
    r = F.expr("""CASE WHEN ha > la AND hb > lb THEN
        try_divide(ab - sa * sb / n, sqrt(aa - sa * sa / n) * sqrt(bb - sb * sb / n)) END""")
    cells = df.sparkSession.createDataFrame(
        [(i, j, present[i], present[j]) for i in index for j in index],
        "a bigint, b bigint, feature_a string, feature_b string")
    out = cells.join(totals.select("a", "b", r.alias("r")), ["a", "b"], "left")
    out = out.select("feature_a", "feature_b", "r")
    return out if digits is None else out.withColumn("r", C.round_half_even("r", digits))
