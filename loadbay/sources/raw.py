"""Raw log files to one text-typed table per log.

A path may be a file, a folder of files or a glob. Every export is read by its own header, gets
its label from it and its name in ``source_file``; a folder that Spark has written (``_SUCCESS``), or
that is named like a file (``moves.csv/``), is one export. Exports that share a header are read together, so the plan
grows with the number of layouts, not of files. Headers are read by tasks, one job for all files of a
path, and the driver sees one row for every layout and export. Quoted fields, in headers too, may hold line breaks.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.operators import clean

HEADER_LINES = 200          # a header record spans at most so many further lines


def read_text_table(spark: SparkSession, path: str | list[str], fmt: str = "csv", **options) -> DataFrame:
    """One raw export, all columns text: csv (default), json, orc or parquet."""
    if fmt == "csv":
        return spark.read.csv(path, header=True, inferSchema=False,
                              **{"multiLine": True, "escape": '"', **options})
    if fmt == "json":
        return spark.read.json(path, primitivesAsString=True, **options)
    df = spark.read.format(fmt).options(**options).load(path)
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in df.columns})


def label_from_header(df: DataFrame) -> DataFrame:
    """Product label from the name of the first label column; those columns go."""
    marked = [c for c in df.columns if c.startswith(S.LABEL_HEADER_PREFIX)]
    if not marked:
        return df
    label = marked[0].replace(S.LABEL_HEADER_PREFIX, "").strip()
    return df.drop(*marked).withColumn("product_label", F.lit(label))


def _children(fs, status) -> list:
    return sorted((s for s in fs.listStatus(status.getPath())
                   if not s.getPath().getName().startswith(("_", "."))), key=lambda s: s.getPath().getName())


def _listed(spark: SparkSession, path: str, fmt: str) -> list[tuple[str, bool]]:
    """(path, is a folder) of every export that ``path`` names; nothing is opened."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for s in fs.globStatus(hadoop) or []:
        whole = not s.isDirectory() or s.getPath().getName().lower().endswith(f".{fmt}") or any(
            c.getPath().getName() == "_SUCCESS" for c in fs.listStatus(s.getPath()))
        found += [s] if whole else _children(fs, s)
    if not found:
        raise FileNotFoundError(path)
    return [(s.getPath().toString(), s.isDirectory()) for s in found]


def _lines(spark: SparkSession, names: list[str], folder: bool) -> DataFrame:
    """export, file, n (ascending inside a file's first block), value: the lines of each file's first block."""
    meta = F.col("_metadata")
    file = F.regexp_replace(F.url_decode(F.replace(meta["file_path"], F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    export = F.regexp_replace(file, "/[^/]*$", "") if folder else file
    return (spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(names)
            .where(meta["file_block_start"] == 0)
            .select(export.alias("export"), file.alias("file"), F.monotonically_increasing_id().alias("n"), "value"))


def _quotes(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))


def _headers(lines: DataFrame) -> dict[str, str]:
    """The header record of every CSV export that has one: its first line, and those after it as long
    as a quote is open."""
    first = lines.groupBy("export").agg(F.min(F.struct("file", "n", "value")).alias("first"))
    got = {r["export"]: r for r in first.select(
        "export", "first.*", (_quotes(F.col("first.value")) % 2).alias("open")).collect()}
    headers = {e: r["value"] for e, r in got.items()}
    broken = [(e, r["file"], r["n"]) for e, r in got.items() if r["open"]]
    if broken:                           # only these files are read once more, HEADER_LINES lines of each
        begun = lines.sparkSession.createDataFrame(broken, "export string, file string, n0 long")
        near = (lines.join(begun, ["export", "file"])
                .where(F.col("n").between(F.col("n0"), F.col("n0") + HEADER_LINES))
                .groupBy("export").agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("lines")))
        start = F.struct(F.lit("").alias("text"), F.lit(True).alias("open"))

        def grow(state, line):
            text = F.when(state["text"] == "", line["value"]).otherwise(
                F.concat(state["text"], F.lit("\n"), line["value"]))
            return F.when(state["open"], F.struct(text.alias("text"), (_quotes(text) % 2 == 1).alias("open"))
                          ).otherwise(state)
        whole = near.select("export", F.aggregate("lines", start, grow, lambda s: s["text"]).alias("text"))
        headers.update({r["export"]: r["text"] for r in whole.collect()})
    return headers


def _layouts(spark: SparkSession, found: list[tuple[str, bool]], fmt: str) -> dict[str, object]:
    """What distinguishes each export's columns, by a fixed number of jobs."""
    out: dict[str, object] = {}
    if fmt in ("csv", "json"):
        for folder in {f for _, f in found}:
            lines = _lines(spark, [p for p, f in found if f == folder], folder)
            if fmt == "csv":
                out.update(_headers(lines))
            else:
                keys = lines.select("export", F.explode(F.json_object_keys("value")).alias("key")).distinct()
                out.update({r["export"]: tuple(r["keys"]) for r in keys.groupBy("export").agg(
                    F.array_sort(F.collect_list("key")).alias("keys")).collect()})
        return out
    merged = None
    try:
        merged = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).format(fmt).load(
            [p for p, _ in found]).columns
    except AnalysisException:            # columns of one name and several types
        pass
    if merged is not None and not any(c.startswith(S.LABEL_HEADER_PREFIX) for c in merged):
        return {p: "merged" for p, _ in found}
    # which file has which label column stands in its footer alone
    return {p: tuple(spark.read.format(fmt).load(p).columns) for p, _ in found}


def exports(spark: SparkSession, path: str, fmt: str) -> list[tuple[str, bool, object]]:
    """(path, is a folder, layout) of every export that ``path`` names and that is not empty."""
    found = _listed(spark, path, fmt)
    layouts = _layouts(spark, found, fmt)
    return [(p, f, layouts[p]) for p, f in found if layouts.get(p)]


def read_exports(spark: SparkSession, paths: Iterable[str], fmt: str, **options) -> list[DataFrame]:
    """One frame per layout, with ``source_file`` and, where the header has it, the label."""
    groups: dict[tuple, list[str]] = {}
    for path in paths:
        for name, folder, layout in exports(spark, path, fmt):
            groups.setdefault((folder, layout), []).append(name)
    frames = []
    for (folder, layout), names in groups.items():
        tag = (F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2) if folder
               else F.col("_metadata.file_name"))
        if layout == "merged":
            options = {"mergeSchema": True, **options}
        df = read_text_table(spark, names, fmt, **options)
        frames.append(label_from_header(df.withColumn("source_file", F.url_decode(F.replace(tag, F.lit("+"), F.lit("%2B"))))))
    return frames


def _stack(frames: Iterable[DataFrame], layout: Iterable[str]) -> DataFrame:
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    missing = {c: F.lit(None).cast("string") for c in layout if c not in stacked.columns}
    stacked = stacked.withColumns(missing) if missing else stacked
    extra = [f"`{c}`" for c in stacked.columns if c not in set(layout)]
    return stacked.select(*layout, *extra)


def load_product_files(spark: SparkSession, paths: Iterable[str], fmt: str = "csv",
                       **options) -> DataFrame:
    frames = [clean.standardize_products(df) for df in read_exports(spark, paths, fmt, **options)]
    return _stack(frames, S.PRODUCT_RAW)


def load_worker_files(spark: SparkSession, paths: Iterable[str], fmt: str = "csv",
                      **options) -> DataFrame:
    frames = [clean.standardize_workers(df) for df in read_exports(spark, paths, fmt, **options)]
    return _stack(frames, S.WORKER_RAW)


def source_file_counts(df: DataFrame) -> DataFrame:
    """Rows per source file."""
    return df.groupBy("source_file").agg(F.count("*").alias("row_count"))
