"""Staging job: write the ten banking tables once, for queries to read with ``Bank.from_staged``.

    python -m tallyspark.stage <source_dir> <staged_dir>
    spark-submit tallyspark/stage.py <source_dir> <staged_dir>

On a cluster this runs as its own job (the session comes from spark-submit); queries then
start from plain Parquet columns instead of re-deriving the mapping.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):  # run as a script (spark-submit tallyspark/stage.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyspark.session import REQUIRED  # noqa: E402
from tallyspark.sources.banking import Bank  # noqa: E402


def main(argv: list[str]) -> None:
    if len(argv) != 2:
        raise SystemExit("usage: python -m tallyspark.stage <source_dir> <staged_dir>")
    spark = SparkSession.builder.appName("tallyspark-stage").getOrCreate()
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    Bank(spark, argv[0]).write_staged(argv[1])


if __name__ == "__main__":
    main(sys.argv[1:])
