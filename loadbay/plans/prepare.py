"""Preparation job: raw logs -> cleaned -> featured -> prepared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadbay import schemas as S
from loadbay.operators import clean, features
from loadbay.session import materialized
from loadbay.sources import prepared, raw

Stage = Callable[[str, Callable[[], DataFrame]], DataFrame]


def _inline(_key: str, build: Callable[[], DataFrame]) -> DataFrame:
    return build()


def prepare_products(raw_log: DataFrame, fmt: str | dict[str, str] | None = None,
                     staged: Stage = _inline) -> DataFrame:
    """38 columns. ``staged`` may write the cleaned table out between the steps, so
    that every aggregate scans narrow Parquet columns instead of the full shuffle."""
    cleaned = staged("clean_products", lambda: clean.clean_products(raw_log, fmt))
    return features.product_features(cleaned)


def prepare_workers(raw_log: DataFrame, fmt: str | dict[str, str] | None = None,
                    gap_sec: int = S.SESSION_GAP_SEC, staged: Stage = _inline) -> DataFrame:
    """36 columns."""
    cleaned = staged("clean_workers", lambda: clean.clean_workers(raw_log, fmt))
    return features.worker_features(cleaned, gap_sec)


def run(spark: SparkSession, product_paths, worker_paths, out_dir: str,
        raw_format: str = "csv", timestamp_format: str | dict[str, str] | None = None,
        out_format: str = "parquet") -> None:
    """Read raw files, publish ``<out_dir>/products`` and ``<out_dir>/workers`` together."""
    products = raw.load_product_files(spark, product_paths, raw_format)
    workers = raw.load_worker_files(spark, worker_paths, raw_format)
    prepared.publish(spark, out_dir, {
        "products": lambda: prepare_products(products, timestamp_format, materialized),
        "workers": lambda: prepare_workers(workers, timestamp_format, staged=materialized)}, out_format)
