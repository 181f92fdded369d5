"""Connected components of an edge table by alternating large and small stars.

Every node learns the smallest node of its component. A large star links a node's larger
neighbours to the smallest node it knows, a small star links the node and its smaller neighbours to
the smallest; rounds alternate until the edges stay as they are, after a number of rounds that
grows with the logarithm of the nodes (Kiveris and others, 2014). Each round is written to the
shared folder, so lineage stays short and a lost executor costs a re-read, and the round before is deleted. What a node
knows is written too: a join of two exchanged tables can be split at a hot node, the centre of a star.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import discard, staged


def _stars(edges: DataFrame, large: bool, name: str) -> tuple[DataFrame, DataFrame]:
    """The edges of a star round, and the table of what nodes know, which they are read from."""
    u, v = F.col("u"), F.col("v")
    if large:
        near = edges.select("u", "v").union(edges.select(v.alias("u"), u.alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = staged(near.groupBy(u.alias("c")).agg(F.least(F.min("v"), F.first("u")).alias("m")), f"{name}-least")
    seen = near.join(least, u == F.col("c"))
    if large:
        out = seen.where(v > u).select(v.alias("u"), F.col("m").alias("v"))
    else:
        out = seen.select(v.alias("u"), F.col("m").alias("v")).union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct(), least


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """(u, v) with v the smallest node of u's component, for every u that has an edge and is not
    the smallest itself. ``edges`` has columns u and v of one orderable type, without nulls."""
    now = staged(edges.where(F.col("u") != F.col("v")).distinct(), name)
    mark = _mark(now)
    while mark[0]:
        large, known = _stars(now, True, name)
        large = staged(large, f"{name}-large")
        small, known_too = _stars(large, False, name)
        new = staged(small, name)
        discard(now, large, known, known_too)
        now = new
        after = _mark(now)
        if after == mark:
            break
        mark = after
    return now
