"""Sharding (operator 5) along a Hilbert curve, under the law ``rows``.

Each of a row's metadata dimensions (language, source, size, doc_id) is quantised into
2**``bits`` cells by whole values at the exact quantiles of all rows, so cells hold similar shares and keep the dimension's order. The cell's index on the Hilbert curve orders the rows, and
the order is cut into runs whose row counts differ by at most one. Neighbours on the curve are
neighbours in every dimension, so a shard (and each file of it) spans short ranges of all of
them and min/max statistics prune reads on any.

Inside a cell rows follow a hash of doc_id, so a cell with a third of all rows is placed by many
tasks. Defined results: null values take the lowest cell; ids of any type keep their order, strings by
their bytes; other columns are ignored; texts are measured whole; a null text has size 1 and the checksum of
no bytes; equal rows are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import packed, running_total, staged

BITS = 3
#: Rows for which a dimension gets a further range of its values, and ranges at least.
PER_RANGE, MIN_RANGES = 100_000, 8
DIMS = ["_lang", "_source", "size", "doc_id"]


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each column of ``axes`` (dimensions x rows).

    Skilling's method (2004), on whole columns: undo the excess rotations from the highest bit
    down, Gray-encode, then interleave the bits.
    """
    x = axes.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for d in range(dims):
            set_ = (x[d] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t ^= np.where((x[dims - 1] >> b) & 1, (1 << b) - 1, 0)
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> b) & 1)
    return out


def quantiles(rows: DataFrame, dim: str, parts: int, ranges: int) -> list:
    """The different values, increasing and without null, at the positions ``i * n // parts`` (i from 1) of all
    ``n`` rows in the order of ``dim``, null first.

    A value is one row with its count, however often it occurs. ``ranges`` ranges of values are added up
    on their own; only those that hold a position are read again, to find it.
    """
    value = F.col("v").asc_nulls_first()
    counts = rows.groupBy(F.col(dim).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranged = staged(counts.repartitionByRange(ranges, value).withColumn("r", F.spark_partition_id()), "shard-values")
    totals = [(r["r"], r["n"]) for r in ranged.groupBy("r").agg(F.sum("n").alias("n")).collect()]  # a row per range
    totals.sort()
    starts = list(accumulate((n for _, n in totals), initial=0))
    found, held = F.lit(False), set()
    for at in {i * starts[-1] // parts for i in range(1, parts)} if totals else ():
        k = bisect_right(starts, at) - 1
        r, at = totals[k][0], at - starts[k]
        held.add(r)
        found = found | ((F.col("r") == r) & (F.col("b") <= at) & (F.col("b") + F.col("n") > at))
    if not held:
        return []
    before = F.sum("n").over(Window.partitionBy("r").orderBy(value)) - F.col("n")
    placed = ranged.where(F.col("r").isin(list(held))).withColumn("b", before)
    return [r["v"] for r in placed.where(found & F.col("v").isNotNull()).orderBy("r", "b").collect()]  # under ``parts`` rows


def cuts(rows: DataFrame, dims: list[str], bits: int = BITS, per_range: int = PER_RANGE) -> dict[str, list]:
    """For each dimension at most 2**bits - 1 increasing values, the quantiles of all rows: where its
    cells after the first begin."""
    ranges = MIN_RANGES + rows.count() // per_range
    return {d: quantiles(rows, d, 1 << bits, ranges) for d in dims}


def cells(values: list, cut: list) -> np.ndarray:
    """The cell of each value; null is lowest."""
    return np.array([0 if v is None else bisect_right(cut, v) for v in values], dtype=np.int64)


def curve_cells(rows: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """Adds ``_cell``, the Hilbert index of the quantised columns ``dims``."""
    bounds = cuts(rows, dims, bits)
    names = rows.columns

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            axes = [cells(b[d].to_pylist(), bounds[d]) for d in dims]
            cell = hilbert_index(np.stack(axes), bits) if len(b) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64())], names=[*names, "_cell"])

    return rows.mapInArrow(index, T.StructType([*rows.schema.fields, T.StructField("_cell", T.LongType())]))


def measured(docs: DataFrame) -> DataFrame:
    """What sharding reads of a document: a narrow row."""
    raw = F.col("text").cast("string").cast("binary")
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(raw), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(raw, F.lit(b""))).cast("long").alias("text_crc32"),
        F.col("lang").cast("string").alias("_lang"),
        F.col("source").cast("string").alias("_source"),
    ).withColumn("_h", F.xxhash64("doc_id", "size", "text_crc32"))


def hilbert_shards(docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, cell of every row."""
    rows = staged(measured(docs), "shard-rows")
    celled = staged(curve_cells(rows, DIMS, bits), "shard-cells")
    one = F.lit(1).cast("long")
    placed = running_total(celled.withColumn("_one", one), "_cell", "_one", ["_h", "doc_id", "size", "text_crc32"], "_in_cell")
    # At most 2**(bits * dimensions) cells.
    per_cell = celled.groupBy(F.col("_cell").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_cell.select(
        "_c", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_start"), F.sum("_n").over(Window.partitionBy()).alias("_all")
    )
    ranked = placed.join(F.broadcast(starts), F.col("_cell") == F.col("_c")).withColumn("_rank", F.col("_start") + F.col("_in_cell"))
    shard = F.expr(f"cast((_rank * {int(shards)}) div _all as int)")
    first = F.expr(f"(shard * _all + {int(shards) - 1}) div {int(shards)}")
    return ranked.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_rank") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("_cell").alias("cell"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, bits: int = BITS) -> None:
    """Write ``docs`` as files that follow the curve (a folder ``_shard=N`` per shard)."""
    plan = hilbert_shards(docs, shards, bits).select(F.col("doc_id").alias("_id"), "size", F.col("text_crc32").alias("_crc"), "shard", "slot")
    plan = plan.groupBy("_id", "_crc").agg(F.min(F.struct("shard", "slot")).alias("_to"))  # repeated rows share a place
    crc = F.crc32(F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))).cast("long")
    rows = docs.select(packed(docs), "doc_id", crc.alias("_own")).join(
        plan, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_crc"))
    )
    placed = rows.repartitionByRange("_to").sortWithinPartitions("_to").select("_doc.*", F.col("_to.shard").alias("_shard"))
    placed.write.partitionBy("_shard").parquet(path)
