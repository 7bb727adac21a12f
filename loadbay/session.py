"""Session settings, the shared checkpoint folder and staged tables."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators are designed for. AQE splits skewed join partitions and
# decides on broadcasts from measured sizes; nothing in the package forces one.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # at run time, from measured sizes: broadcast up to this much ...
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # ... and hash instead of sorting the wide side where each build partition fits
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "loadbay", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, as in tests, a
    folder inside the warehouse, which driver and executors share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/loadbay_work"


def app_dir(spark: SparkSession) -> str:
    """This application's folder inside the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/loadbay/{spark.sparkContext.applicationId}"


COMPRESSION = "zstd"                # of intermediate tables

# a table's shuffle files go with its write, not when the driver happens to collect its garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: list[str] = []


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside are deleted as soon as it is written."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def fresh_path(spark: SparkSession, key: str) -> str:
    """A path nobody has written yet, in this application's folder."""
    _made.append(f"{app_dir(spark)}/{key}_{uuid.uuid4().hex}")
    return _made[-1]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the intermediate tables made inside it; results must be written by then."""
    before = len(_made)
    try:
        yield
    finally:
        while len(_made) > before:
            release(spark, _made.pop())


def release(spark: SparkSession, path: str | None = None) -> None:
    """Delete one intermediate table, or all that this application has written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path or app_dir(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path is None:
        app = spark.sparkContext.applicationId
        for slot in [s for s in _staged if s[0] == app]:
            del _staged[slot]


def cut(df: DataFrame, key: str = "cut") -> DataFrame:
    """Write to a fresh Parquet table in the shared folder and read it back: the lineage
    ends there, columns stay prunable, and a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = fresh_path(spark, key)
    with shuffles_deleted(spark):
        df.write.parquet(path, compression=COMPRESSION)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete the table that ``cut`` returned, once nothing reads it any more."""
    release(df.sparkSession, df._cut_path)


def materialized(key: str, build: Callable[[], DataFrame]) -> DataFrame:
    return cut(build(), key)


_staged: dict[tuple, str] = {}


def unstage(spark: SparkSession, *keys: str) -> None:
    """Delete staged tables that nothing reads any more; ``stage`` builds them again where they are wanted."""
    for key in keys:
        path = _staged.pop((spark.sparkContext.applicationId, key), None)
        if path:
            release(spark, path)


# rows of a staged table that move through one shuffle: a larger one is written in slices
SLICE_ROWS = 20_000_000


def stage(spark: SparkSession, key: str, build: Callable[[], DataFrame], by: str | None = None,
          rows: Callable[[], int] | None = None) -> DataFrame:
    """Write a table once per application into the shared folder and read it back.

    This is the stage boundary between preparing and analysing: later queries scan
    Parquet with pruned columns and pushed filters instead of repeating the
    de-duplication and the joins, and a lost executor costs only its own tasks.

    With ``by``, a key of the joins that move the table's rows, a table of more than ``SLICE_ROWS`` rows is written in
    slices of that key, so that the disk holds the shuffle files of one slice at a time. Of one key only, since Spark
    then takes the slice to the other side of the join as well.
    """
    app = spark.sparkContext.applicationId
    slot = (app, key)
    if slot not in _staged:
        name = f"{re.sub(r'[^A-Za-z0-9]+', '_', key)[-60:]}_{zlib.crc32(key.encode()):08x}"
        path = f"{app_dir(spark)}/{name}"
        table = build()
        with shuffles_deleted(spark):
            parts = -(-rows() // SLICE_ROWS) if by and rows else 1
            for i in range(max(parts, 1)):
                piece = table.where(F.pmod(F.xxhash64(by), F.lit(parts)) == i) if parts > 1 else table
                piece.write.mode("append" if i else "overwrite").parquet(path, compression=COMPRESSION)
        _staged[slot] = path
    return spark.read.parquet(_staged[slot])
