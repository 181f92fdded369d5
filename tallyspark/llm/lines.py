"""Line dedup (operator 7) with DataFrame functions only.

A document's lines are its \\n-separated parts; blank lines (no word) take no part. Every three
consecutive other lines make a window, and windows overlap. Windows are compared across all
documents by a 128-bit hash of their lines; a window's first occurrence is the one with
the smallest (doc_id, text hash, position), and every later one is removed: the lines that any
later occurrence covers go, and what remains is joined again. Only hashes and positions are
shuffled to find the windows; texts travel once, to meet the lines to be cut.

Defined results: an empty table gives no rows; a text of any length is read whole, in time linear in its lines; other
columns are kept in ``_doc``, whatever their names; null text has no lines and stays null; null doc_ids come last; documents of
fewer than three such lines never change; rows with an equal doc_id and text are one document
written twice (they share one fate). A document all of whose lines go keeps its row, with an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import WORD, packed, staged

WINDOW = 3


def _lines() -> Column:
    return F.split(F.col("_text"), "\n", -1)


def _identity() -> list[Column]:
    return [F.col("doc_id").alias("_id"), F.xxhash64(F.col("_text")).alias("_th")]


def window_rows(docs: DataFrame) -> DataFrame:
    """One row per window: _id, _th (the document), h1, h2 (its hash), at (positions of its lines)."""
    numbered = F.transform(_lines(), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    solid = F.filter(numbered, lambda s: s["x"].rlike(WORD))
    hashed = F.transform(
        solid, lambda s: F.struct(s["i"].alias("i"), F.xxhash64(s["x"]).alias("a"), F.xxhash64(F.lit("line"), s["x"]).alias("b"))
    )
    per_doc = docs.select("doc_id", F.col("text").cast("string").alias("_text")).select(*_identity(), hashed.alias("_l"))
    long_enough = per_doc.where(F.size("_l") >= WINDOW)
    windows = F.expr(
        "transform(sequence(0, size(_l) - 3), p -> named_struct("
        "'h1', xxhash64(_l[p].a, _l[p + 1].a, _l[p + 2].a), 'h2', xxhash64(_l[p].b, _l[p + 1].b, _l[p + 2].b), "
        "'at', array(_l[p].i, _l[p + 1].i, _l[p + 2].i)))"
    )
    return long_enough.select("_id", "_th", F.explode(windows).alias("w")).select("_id", "_th", "w.h1", "w.h2", "w.at")


def covered_lines(docs: DataFrame) -> DataFrame:
    """_id, _th and the positions of the lines that later occurrences of a window cover."""
    w = window_rows(docs)
    place = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_th").alias("th"), F.col("at")[0].alias("p"))
    first = (
        w.groupBy(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
        .where("_n > 1")
    )
    # Written, so that both sides of the join are exchanged for it and a hot window can be split.
    first = staged(first, "line-windows")
    later = w.join(first, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).where(place > F.col("_first"))
    return later.select("_id", "_th", F.explode("at").alias("i")).groupBy("_id", "_th").agg(F.sort_array(F.collect_set("i")).alias("_cut"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with repeated windows cut from ``text`` (struct ``_doc``), n_lines and n_removed."""
    cut = covered_lines(docs).select(F.col("_id").alias("_cid"), F.col("_th").alias("_cth"), "_cut")
    rows = docs.select(packed(docs), "doc_id", F.col("text").cast("string").alias("_text"))
    joined = rows.join(
        cut, F.col("doc_id").eqNullSafe(F.col("_cid")) & F.xxhash64(F.col("_text")).eqNullSafe(F.col("_cth")), "left"
    )
    # A mask of the lines up to the last one cut, from the gaps between cut positions: linear in the lines.
    gaps = "transform(_cut, (c, k) -> concat(array_repeat(false, c - if(k = 0, -1, _cut[k - 1]) - 1), array(true)))"
    left = F.expr(f"array_join(zip_with(split(_text, '\\n', -1), flatten({gaps}), (x, m) -> if(coalesce(m, false), NULL, x)), '\\n')")
    fields = [
        F.when(F.col("_cut").isNull(), F.col("_text")).otherwise(left).alias("text") if c == "text" else F.col("_doc").getField(c).alias(c)
        for c in docs.columns
    ]
    return joined.select(
        F.struct(*fields).alias("_doc"),
        F.when(F.col("_text").isNull(), 0).otherwise(F.size(_lines())).cast("long").alias("n_lines"),
        F.coalesce(F.size("_cut"), F.lit(0)).cast("long").alias("n_removed"),
    )


SQL = r"""
WITH l AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL
), s AS (
    SELECT *, lead(x, 1) OVER d AS y, lead(x, 2) OVER d AS z, lead(i, 1) OVER d AS j, lead(i, 2) OVER d AS k
    FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
    WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), w AS (
    SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, i) AS occurrence FROM s WHERE z IS NOT NULL
), cut AS (
    SELECT DISTINCT doc_id, unnest([i, j, k]) AS i FROM w WHERE occurrence > 1
), left_over AS (
    SELECT l.doc_id, count(*) AS n_lines, count(cut.i) AS n_removed,
           coalesce(string_agg(l.x, chr(10) ORDER BY l.i) FILTER (WHERE cut.i IS NULL), '') AS kept
    FROM l LEFT JOIN cut ON l.doc_id = cut.doc_id AND l.i = cut.i
    GROUP BY l.doc_id
)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN left_over USING (doc_id)
"""
