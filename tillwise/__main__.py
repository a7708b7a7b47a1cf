"""Run questions as a batch job and write each result.

    spark-submit --py-files tillwise.zip tillwise/__main__.py --tables /data/sales \\
        --out /data/answers revenue_by_period customer_ltv
    python -m tillwise --tables /root/testdata/sf0.01 --out /tmp/answers --all

``--tables`` is a folder of ``<table>.parquet`` or, with ``--catalog``, a database name.  The
session comes from the submitting environment (``getOrCreate``); its ``spark.checkpoint.dir``
must name shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from tillwise.catalog import QUERIES
from tillwise.session import ensure_checkpoint_dir
from tillwise.sources.sinks import write_result
from tillwise.sources.tables import Tables, load_tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillwise")
    parser.add_argument("questions", nargs="*", help=f"any of: {', '.join(QUERIES)}")
    parser.add_argument("--all", action="store_true", help="run every question")
    parser.add_argument("--tables", required=True, help="table folder, or database with --catalog")
    parser.add_argument("--catalog", action="store_true")
    parser.add_argument("--out", required=True, help="output folder; one sub-folder per question")
    parser.add_argument("--format", default="parquet")
    args = parser.parse_args(argv)
    names = list(QUERIES) if args.all else args.questions
    unknown = [n for n in names if n not in QUERIES]
    if unknown or not names:
        parser.error(f"unknown or no questions: {unknown}")

    spark = SparkSession.builder.appName("tillwise").getOrCreate()
    ensure_checkpoint_dir(spark)
    tables = (Tables.from_catalog(spark, args.tables) if args.catalog
              else load_tables(spark, args.tables))
    for name in names:
        write_result(QUERIES[name](tables), os.path.join(args.out, name), fmt=args.format)
        print(f"{name}: written to {os.path.join(args.out, name)}", flush=True)


if __name__ == "__main__":
    main()
