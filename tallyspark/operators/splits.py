"""Keys split into ordered leaves, so that no task holds a whole key, in two passes over the rows.

Windows run inside leaves. A key with at most ``limit`` rows is one leaf, which is the plain window and
needs nothing else. A crowded key is cut by the first of its ordered ``levels`` (e.g. the hour), a crowded
(key, hour) by the second (e.g. the second and id), and so on; each level is a pure function of the
row that agrees with the window's order. What earlier leaves contribute (a prefix sum, their last rows)
comes from a table with a row per leaf of a crowded key, and there is none for other keys.

* The first pass counts all levels at once (grouping sets, combined inside map tasks) and finds what is crowded.
* The second deals the rows to their leaves in one exchange. The windows and the leaf table both read
  that exchange: ``hot_rows`` filters above it, so that its two uses stay the same plan and Spark reuses it.

Crowded keys go to the rows by broadcast, of at most ``CROWDED`` keys a level whatever the data's
size (a key beyond that stays a larger leaf; results are the same). All joins are null-safe: a null
key, date or value is a value like any other, as in PARTITION BY.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = "_sp_leaf"
LEAF_ROWS = 1_000_000
CROWDED = 100_000


def attach(rows: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the other columns of ``small``, joined on ``keys`` null-safe."""
    right = small.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for i, k in enumerate(keys):
        one = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = one if i == 0 else cond & one
    return rows.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def split(df: DataFrame, by: list[str], levels: list[Column], limit: int = LEAF_ROWS) -> DataFrame:
    """``df`` dealt by LEAF, the struct of the key, of whether it is crowded, and of the levels that cut
    it (null below). Without ``by`` the whole table is one key, which is always cut.

    A struct is never null itself and equals another when their fields do, nulls included, so LEAF is
    a plain join key: rows that a window has dealt by LEAF meet their leaf's totals without another
    shuffle.
    """
    names = [f"_sp_{i}" for i in range(len(levels))]
    x = df.withColumns(dict(zip(names, levels, strict=True)))
    keys = [[*by, *names[:i]] for i in range(len(names))]
    checked = keys if by else keys[1:]
    counts = x.groupingSets([[F.col(c) for c in k] for k in checked], *[F.col(c) for c in checked[-1]])
    counts = counts.agg(F.count(F.lit(1)).alias("_sp_n"), F.grouping_id().alias("_sp_set"))
    cut = [] if by else [F.lit(True)]
    for i, key in enumerate(checked):
        # The set and the count in one condition: Spark then keeps it above the shared aggregate.
        here = F.when(F.col("_sp_n") > limit, F.col("_sp_set")) == 2 ** (len(checked) - 1 - i) - 1
        crowded = counts.where(here).orderBy(F.desc("_sp_n"), *key).limit(CROWDED)
        flag = f"_sp_cut{len(cut)}"
        x = attach(x, F.broadcast(crowded.select(*key, F.lit(True).alias(flag))), key, "left")
        cut.append(F.coalesce(F.col(flag), F.lit(False)))
    parts = [F.when(c, F.col(n)).alias(n) for c, n in zip(cut, names, strict=True)]
    leaf = F.struct(*by, cut[0].alias("hot"), *parts)
    dropped = [*names, *[f"_sp_cut{i}" for i in range(len(cut))]]
    return x.withColumn(LEAF, leaf).drop(*dropped).repartition(LEAF)


def hot_rows(x: DataFrame) -> DataFrame:
    """The rows of ``x`` (from ``split``) whose key has more than one leaf, filtered after the exchange."""
    return x.where(F.when(F.spark_partition_id() >= 0, F.col(LEAF)["hot"]))


def earlier_sums(x: DataFrame, by: list[str], order: list[Column], last: list[Column], sums: dict[str, Column], wholes: dict[str, str] | None = None) -> DataFrame:
    """A row per leaf of the crowded keys: for each of ``sums`` the sum over the key's earlier leaves
    (null where there is nothing to sum), and for each of ``wholes`` (name: sum) that over all its leaves.

    ``last`` are the largest order values of a leaf, which place it: ``order`` sorts by them, under
    the names _sp_o0, _sp_o1, ...
    """
    place = [c.alias(f"_sp_o{i}") for i, c in enumerate(last)]
    totals = hot_rows(x).groupBy(LEAF, *by).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()], *place)
    key = Window.partitionBy(*by)
    earlier = key.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = [F.sum(f"_t_{n}").over(earlier).alias(n) for n in sums]
    out += [F.sum(f"_t_{of}").over(key).alias(n) for n, of in (wholes or {}).items()]
    return totals.select(LEAF, *out)


def to_leaves(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """``rows`` with the other columns of ``leaves`` (one row per LEAF), null for the leaves that have none."""
    return rows.join(leaves.withColumnRenamed(LEAF, "_sp_of"), F.col(LEAF) == F.col("_sp_of"), "left").drop("_sp_of")


def add(a: Column, b: Column) -> Column:
    """Sum of two sums: null only if both are."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
