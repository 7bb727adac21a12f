"""Command line for the batch jobs.

    python -m loadbay prepare   --products A.csv B.csv --workers L1.csv L2.csv --out DIR
    python -m loadbay explore   --prepared DIR --out REPORT_DIR
    python -m loadbay anonymise --prepared DIR

Under spark-submit the master and spark.checkpoint.dir come from the cluster.
"""

from __future__ import annotations

import argparse

from loadbay.plans import anonymise, explore, prepare
from loadbay.session import build_session, scratch
from loadbay.sources import prepared


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loadbay", description="Warehouse operations-log analytics.")
    p.add_argument("--master", help="only outside spark-submit, e.g. local[8]")
    jobs = p.add_subparsers(dest="job", required=True)
    a = jobs.add_parser("prepare", help="raw logs to prepared tables")
    a.add_argument("--products", nargs="+", required=True)
    a.add_argument("--workers", nargs="+", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--raw-format", default="csv", choices=("csv", "json", "orc", "parquet"))
    a.add_argument("--timestamp-format", nargs="+", default=[], metavar="PATTERN|COLUMN=PATTERN",
                   help="Spark pattern for all columns, or one by column; default is ISO-like text")
    a.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    b = jobs.add_parser("explore", help="all summaries, chart datasets and anomaly tables")
    b.add_argument("--prepared", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    c = jobs.add_parser("anonymise", help="replace people in both prepared tables")
    c.add_argument("--prepared", required=True)
    c.add_argument("--staging", help="not used any more: new versions are built beside the old ones")
    c.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    return p


def timestamp_formats(given: list[str]) -> str | dict[str, str] | None:
    """One pattern, or patterns by column."""
    if len(given) == 1 and "=" not in given[0]:
        return given[0]
    return dict(g.split("=", 1) for g in given) or None


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"loadbay {args.job}", args.master)
    with scratch(spark):                 # intermediate tables, name maps among them, go with the job
        if args.job == "prepare":
            prepare.run(spark, args.products, args.workers, args.out, args.raw_format,
                        timestamp_formats(args.timestamp_format), args.format)
        elif args.job == "explore":
            p = prepared.cached(spark, f"{args.prepared}/products", "products", args.format)
            w = prepared.cached(spark, f"{args.prepared}/workers", "workers", args.format)
            explore.write_report(explore.product_report(p), f"{args.out}/products")
            explore.write_report(explore.worker_report(w), f"{args.out}/workers")
        else:
            anonymise.run(spark, args.prepared, args.format)


if __name__ == "__main__":
    main()
