"""Sends this package's source to the executors, for sessions started without it on their path."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from loadbay.session import app_dir

PACKAGE = Path(__file__).resolve().parents[1]
_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Once per application: a zip of the package in the shared folder, added as a Python file."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return spark
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    path = f"{app_dir(spark)}/code/{PACKAGE.name}.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(body.getvalue()))
    out.close()
    sc.addPyFile(path)
    _sent.add(sc.applicationId)
    return spark
