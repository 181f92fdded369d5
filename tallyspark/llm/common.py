"""Shared helpers: the shared folder for intermediate tables, staging, exact positions.

Intermediate tables go to the folder that the session names in ``spark.checkpoint.dir``, which
every executor and the driver can reach, so a lost executor costs a re-read and no recompute.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir

#: A word: a maximal run of characters other than space, \t, \n, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"
#: A-Z and a-z, for lower-casing of ASCII letters only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``staged`` wrote and nothing reads any more. Only folders inside the shared
    folder go; Spark Connect sessions, which have no file system at hand, keep them."""
    for df in tables:
        spark = df.sparkSession
        root = ensure_checkpoint_dir(spark).rstrip("/")
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        if not hasattr(spark, "_jvm"):
            return
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if folder.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/") + "/"):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct ``_doc``, whatever their names."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("_doc")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def running_total(
    df: DataFrame, key: str, weight: str, order: list[str], out: str, rows_per_part: int = 4_000
) -> DataFrame:
    """Sum of ``weight`` over the rows of ``key`` that come before, without a task per key.

    ``df`` has ``key`` (never null) and a column ``_h`` that spreads the rows of a key evenly
    (a hash of the row). Rows of a key are split into ceil(rows / rows_per_part) parts by
    ``_h``; a key's order is (part, *order), a fixed pseudo-random order. One window runs inside
    the parts, which stay near ``rows_per_part`` rows whatever the key's share, and one over
    the parts' totals. ``df`` must give the same rows each time it is evaluated, and the caller
    bounds the number of keys: their part counts are broadcast, so that rows go straight to their
    part and never meet by key.
    """
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    parts = counts.select("_k", F.ceil(F.col("_n") / F.lit(rows_per_part)).cast("long").alias("_parts"))
    rows = (
        df.join(F.broadcast(parts), F.col(key) == F.col("_k"))
        .withColumn("_part", F.expr("pmod(_h, _parts)"))
        .drop("_k", "_parts")
    )
    totals = rows.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(F.sum(weight).alias("_t"))
    before = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_k", "_p", F.coalesce(F.sum("_t").over(before), F.lit(0).cast("long")).alias("_s"))
    inside = Window.partitionBy(key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = rows.withColumn(out, F.coalesce(F.sum(weight).over(inside), F.lit(0).cast("long")))
    return (
        here.join(starts, (F.col(key) == F.col("_k")) & (F.col("_part") == F.col("_p")))
        .withColumn(out, F.col(out) + F.col("_s"))
        .drop("_k", "_p", "_s", "_part")
    )
