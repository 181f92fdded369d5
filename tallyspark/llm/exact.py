"""Exact dedup (operator 9) with DataFrame functions only.

Texts are grouped by their 128-bit MD5 together with their bytes: the hash places the groups, and
equality of the grouping key compares the bytes, so texts whose hashes collide stay apart. Of
each group the smallest (or largest) doc_id stays. Members find their group again by MD5 and
SHA-256, so texts cross the network once, after copies have met on their own machine.

Defined results: null text counts as empty; null doc_ids never stay while another row does
(all null: keep_id is null and every such row is kept); rows with an equal doc_id and text are
one document written twice, and both carry the group's kept flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import ascii_lower, packed, text_or_empty


def exact_groups(docs: DataFrame, keep: str = "min") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row; texts are equal after
    lower-casing A-Z."""
    text = ascii_lower(text_or_empty())
    copies = docs.select("doc_id", text.alias("t"))
    stay = F.min("doc_id") if keep == "min" else F.max("doc_id")
    groups = (
        copies.groupBy(F.md5(F.col("t").cast("binary")).alias("h"), "t")
        .agg(F.count(F.lit(1)).alias("group_size"), stay.alias("keep_id"))
        .select(
            F.unhex("h").alias("_h"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("_s"), "group_size", "keep_id"
        )
    )
    members = copies.select(
        "doc_id",
        F.unhex(F.md5(F.col("t").cast("binary"))).alias("h"),
        F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("s"),
    )
    return members.join(groups, (F.col("h") == F.col("_h")) & (F.col("s") == F.col("_s"))).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("s")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, keep: str = "min") -> DataFrame:
    """``docs`` without the rows that another copy of the same text outranks."""
    gone = exact_groups(docs, keep).where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    rows = docs.select(packed(docs), "doc_id", F.sha2(ascii_lower(text_or_empty()).cast("binary"), 256).alias("_own"))
    return rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha")), "left_anti").select("_doc.*")


SQL = """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n
    FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY n) AS keep_id,
       count(*) OVER (PARTITION BY n) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY n) AS kept,
       sha256(n) AS text_sha256
FROM t
"""
