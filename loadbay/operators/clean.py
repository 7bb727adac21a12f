"""Typing, data-quality reports and de-duplication of raw logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.session import cut


def standardize_products(df: DataFrame) -> DataFrame:
    """Source-language headers to column names; unknown columns pass through."""
    return df.withColumnsRenamed(S.PRODUCT_HEADERS)


def standardize_workers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(S.WORKER_HEADERS)


def parse_timestamps(df: DataFrame, columns, fmt: str | dict[str, str] | None = None) -> DataFrame:
    """``fmt``: one pattern for all columns, or a pattern by column; without one, ISO text."""
    by = fmt if isinstance(fmt, dict) else dict.fromkeys(columns, fmt)
    return df.withColumns({c: C.parse_timestamp(c, by.get(c)) for c in columns})


def drop_sentinel_expiration(df: DataFrame) -> DataFrame:
    """Expiry dates before the floor are placeholders: make them NULL."""
    keep = F.col("expiration") >= F.lit(S.EXPIRATION_FLOOR).cast("timestamp_ntz")
    return df.withColumn("expiration", F.when(keep, F.col("expiration")))


def count_sentinel_expiration(df: DataFrame) -> DataFrame:
    """How many (typed) expiry dates are placeholders."""
    early = F.col("expiration") < F.lit(S.EXPIRATION_FLOOR).cast("timestamp_ntz")
    return df.agg(F.count("*").alias("total_rows"),
                  F.count_if(early).alias("sentinel_rows"))


def coerce_ints(df: DataFrame) -> DataFrame:
    return df.withColumns({c: C.parse_int(c) for c in ("duration_sec", "quantity_pcs")})


def coerce_nullable(df: DataFrame) -> DataFrame:
    return df.withColumns({c: C.parse_double(c) for c in ("purchase_order", "order_line")})


def type_products(df: DataFrame, fmt: str | dict[str, str] | None = None) -> DataFrame:
    """All coercions of the product log, before de-duplication."""
    return (df.transform(parse_timestamps, S.PRODUCT_TIMESTAMPS, fmt)
              .transform(drop_sentinel_expiration)
              .transform(coerce_ints)
              .transform(coerce_nullable))


def type_workers(df: DataFrame, fmt: str | dict[str, str] | None = None) -> DataFrame:
    return parse_timestamps(df, S.WORKER_TIMESTAMPS, fmt)


def missing_report(df: DataFrame) -> DataFrame:
    """NULL count and percentage per column, for columns that have any; one pass."""
    names = df.columns
    counts = df.agg(F.count("*").alias("__rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    long = counts.unpivot(["__rows"], names, "column_name", "missing")
    return (long.where(F.col("missing") > 0)
                .select("column_name", "missing",
                        C.round_half_even(C.ratio("missing", "__rows") * 100, 1).alias("pct")))


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each full-row group.

    Copies collapse in the map-side aggregate, so a heavily repeated row does not
    weigh on one task.
    """
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("copies"))
    return groups.agg(C.total("copies").alias("total_rows"),
                      C.total(F.col("copies") - 1).alias("duplicate_rows"))


MARK_WORDS = 1 << 18        # of 64 hashes each, in the table of repeated hashes: it has no more rows


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication that moves only the rows that may have a copy.

    A hash of each row is counted first, so the aggregate holds one number a row instead of whole rows, which
    it would have to spill. The repeated hashes are kept as bits of a table that is bounded whatever the input, so
    it can be broadcast and the rows need not move to it. A row whose bit is not set has no copy and stays where it is;
    the others, among them different rows of one bit, are compared in all their columns. Should most rows have
    copies, all move once.
    """
    marked = df.withColumn("__mark", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    word = F.expr(f"shiftright(__mark, 6) & {MARK_WORDS - 1}L").alias("__word")
    bit = "CAST(__mark & 63 AS INT)"
    repeated = cut(marked.groupBy("__mark").agg(F.count("*").alias("copies")).where("copies > 1")
                         .groupBy(word).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("__bits")), "repeated")
    told = (marked.withColumn("__word", word).join(F.broadcast(repeated), "__word", "left")
                  .withColumn("__several", F.expr(f"coalesce(shiftright(__bits, {bit}) & 1L, 0L) = 1L")))
    single = told.where(~F.col("__several")).select(*[F.col(f"`{c}`") for c in df.columns])
    several = told.where("__several").select(*[F.col(f"`{c}`") for c in df.columns])
    return single.unionAll(several.dropDuplicates())


def clean_products(df: DataFrame, fmt: str | dict[str, str] | None = None) -> DataFrame:
    return df.transform(type_products, fmt).transform(drop_duplicate_rows)


def clean_workers(df: DataFrame, fmt: str | dict[str, str] | None = None) -> DataFrame:
    return df.transform(type_workers, fmt).transform(drop_duplicate_rows)
