"""Ranks, positions, tiles and percent ranks without a single-task window and without stored copies.

``OVER (ORDER BY value)`` sorts every row in one task. Here values are cut by a radix
(``value_radix``), a pure, order-preserving function with three digits: the first is a hundredth of the value's
logarithm (values of a bucket differ by at most one percent; at most about 7,500 buckets), and two more cut
a bucket into 4,096 cells each. Keys use as many digits as their crowding needs
(``operators.splits``): a group with few distinct values is one window, a crowded group is cut by the first digit, a crowded
bucket by the second, a crowded cell by the third. Counts per leaf give what lies before it.

Ties are counted per distinct value first (map-side combined), so a value shared by a third of
the rows is one row of the ranked table, and ranks join back on the value null-safe, where
adaptive execution may split a hot value. NULL takes its SQL place: first ascending, last descending.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.splits import LEAF, LEAF_ROWS, attach, earlier_sums, split, to_leaves

IDS_PER_LEAF = 1_000_000
DIGIT = 12  # bits of the second and of the third digit
LAST = 2**62  # after every radix


def value_radix(value: Column) -> Column:
    """An ordered whole number of a number, three digits of 1 % and twice 1 / 4,096; null for null."""
    x = value.cast("double")
    return F.floor(F.signum(x) * F.ln(F.abs(x) + 1) * (100 * 4 ** DIGIT))


def value_bucket(value: Column) -> Column:
    """The first digit of ``value_radix``."""
    return F.shiftright(value_radix(value), 2 * DIGIT).cast("int")


def digits(value: Column, descending: bool = False) -> list[Column]:
    """The radix cut at its three digits, ascending in the wanted order (each includes those before it)."""
    r = value_radix(value)
    r = F.coalesce(-r, F.lit(LAST)) if descending else r
    return [F.shiftright(r, 2 * DIGIT), F.shiftright(r, DIGIT), r]


def _ordered(c: str, descending: bool) -> Column:
    return F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()


def counts_before(
    counts: DataFrame, by: list[str], value: str, n: str, descending: bool, out: str, total: str, limit: int = LEAF_ROWS,
    number: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """From one row per (by, value) with its count ``n``: adds the number of the group's rows that
    come before the value, and the group's number of rows. A value that is no number (an exact key) needs
    ``number``, a never decreasing function of it."""
    place = (number or (lambda c: c))(F.col(value))
    x = split(counts, by, digits(place, descending), limit)
    earlier = earlier_sums(x, by, [_ordered("_sp_o0", descending)], [F.max(place)], {"_rk_o": F.col(n)}, {"_rk_w": "_rk_o"})
    leaf = Window.partitionBy(LEAF)
    inner = leaf.orderBy(_ordered(value, descending)).rowsBetween(Window.unboundedPreceding, -1)
    local = x.select("*", F.sum(n).over(inner).alias("_rk_i"), F.sum(n).over(leaf).alias("_rk_t"))
    zero = F.lit(0).cast("long")
    found = {out: F.coalesce("_rk_o", zero) + F.coalesce("_rk_i", zero), total: F.coalesce("_rk_w", "_rk_t")}
    return to_leaves(local, earlier).withColumns(found).drop(LEAF, "_rk_o", "_rk_w", "_rk_i", "_rk_t")


def dense_rank(
    df: DataFrame, value: str, out: str, descending: bool = True, by: list[str] | None = None, limit: int = LEAF_ROWS,
    number: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """DENSE_RANK() OVER ([PARTITION BY by] ORDER BY value [DESC])."""
    by = by or []
    pairs = df.select(*by, value).distinct().withColumn("_rk_one", F.lit(1).cast("long"))
    ranked = counts_before(pairs, by, value, "_rk_one", descending, "_rk_b", "_rk_n", limit, number)
    return attach(df, ranked.select(*by, value, (F.col("_rk_b") + 1).cast("long").alias(out)), [*by, value])


def positions(
    df: DataFrame, value: str, row_id: str, number: str, total: str, by: list[str] | None = None, descending: bool = True,
    limit: int = LEAF_ROWS, ids_per_leaf: int = IDS_PER_LEAF,
) -> DataFrame:
    """ROW_NUMBER() OVER ([PARTITION BY by] ORDER BY value [DESC], row_id) of every row, and the
    group's number of rows.

    Cells of the first two digits that are still crowded hold ties; they are cut by value and
    ranges of ids.
    """
    by = by or []
    first, second, _ = digits(F.col(value), descending)
    v = -F.col(value) if descending else F.col(value)
    fine = F.struct(v.isNull().alias("z"), v.alias("v"), F.floor(F.col(row_id) / F.lit(ids_per_leaf)).alias("r"))
    x = split(df, by, [first, second, fine], limit)
    place = [_ordered("_sp_o0", descending), F.asc("_sp_o1")]
    earlier = earlier_sums(x, by, place, [F.max(value), F.max(row_id)], {"_rk_o": F.lit(1).cast("long")}, {"_rk_w": "_rk_o"})
    leaf = Window.partitionBy(LEAF)
    inner = leaf.orderBy(_ordered(value, descending), F.col(row_id).asc())
    local = x.select("*", F.row_number().over(inner).cast("long").alias("_rk_i"), F.count(F.lit(1)).over(leaf).alias("_rk_t"))
    found = {number: F.coalesce("_rk_o", F.lit(0)) + F.col("_rk_i"), total: F.coalesce("_rk_w", "_rk_t")}
    return to_leaves(local, earlier).withColumns(found).drop(LEAF, "_rk_o", "_rk_w", "_rk_i", "_rk_t")


def tile_of(number: Column, total: Column, tiles: int) -> Column:
    """NTILE's law: with total = q * tiles + r, the first r tiles have q + 1 rows and the others q."""
    q, r = F.call_function("div", total, F.lit(tiles)), total % tiles
    large = r * (q + 1)
    in_large = F.call_function("div", number - 1, q + 1) + 1
    in_small = r + F.call_function("div", number - 1 - large, F.nullif(q, F.lit(0).cast("long"))) + 1
    return F.when(number <= large, in_large).otherwise(in_small).cast("int")


def ntile(
    df: DataFrame, value: str, row_id: str, tiles: int, out: str, by: list[str] | None = None, descending: bool = True,
    limit: int = LEAF_ROWS, ids_per_leaf: int = IDS_PER_LEAF,
) -> DataFrame:
    """NTILE(tiles) OVER ([PARTITION BY by] ORDER BY value [DESC], row_id) of every row."""
    x = positions(df, value, row_id, "_nt_i", "_nt_n", by, descending, limit, ids_per_leaf)
    return x.withColumn(out, tile_of(F.col("_nt_i"), F.col("_nt_n"), tiles)).drop("_nt_i", "_nt_n")


def top_bucket(df: DataFrame, value: str, row_id: str, tiles: int, limit: int = LEAF_ROWS, ids_per_leaf: int = IDS_PER_LEAF) -> DataFrame:
    """Rows with NTILE(tiles) OVER (ORDER BY value DESC, row_id) = 1."""
    return ntile(df, value, row_id, tiles, "_nt", limit=limit, ids_per_leaf=ids_per_leaf).where("_nt = 1").drop("_nt")


def _percent(rank_less_one: str, total: str) -> Column:
    share = F.col(rank_less_one).cast("double") / (F.col(total) - 1).cast("double")
    return F.when(F.col(total) <= 1, F.lit(0.0)).otherwise(share)


def percent_rank_at_least(df: DataFrame, value: Column, threshold: float, out: str, limit: int = LEAF_ROWS) -> DataFrame:
    """Rows with PERCENT_RANK() OVER (ORDER BY value) >= threshold, and that rank.

    Ranks come from counts per distinct value; only the values that pass meet the rows again.
    """
    keyed = df.withColumn("_rk_v", value)
    counts = keyed.groupBy("_rk_v").agg(F.count(F.lit(1)).alias("_rk_c"))
    ranked = counts_before(counts, [], "_rk_v", "_rk_c", False, "_rk_b", "_rk_n", limit)
    passing = ranked.select("_rk_v", _percent("_rk_b", "_rk_n").alias(out)).where(F.col(out) >= threshold)
    return attach(keyed, passing, ["_rk_v"]).drop("_rk_v")


def percent_rank_of_counts(df: DataFrame, by: list[str], count_col: str, out: str, limit: int = LEAF_ROWS) -> DataFrame:
    """PERCENT_RANK() OVER (PARTITION BY by ORDER BY count_col) from counts per (group, value)."""
    counts = df.groupBy(*by, count_col).agg(F.count(F.lit(1)).alias("_rk_c"))
    ranked = counts_before(counts, by, count_col, "_rk_c", False, "_rk_b", "_rk_n", limit)
    return attach(df, ranked.select(*by, count_col, _percent("_rk_b", "_rk_n").alias(out)), [*by, count_col])


def median_rows(df: DataFrame, by: list[str], value: str, limit: int = LEAF_ROWS) -> DataFrame:
    """The values at positions (n + 1) div 2 and (n + 2) div 2 of each group in ascending order (NULL
    first), one row per position (one row in all if both are the same)."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_rk_c"))
    ranked = counts_before(counts, by, value, "_rk_c", False, "_rk_b", "_rk_n", limit)
    middles = F.array_distinct(F.array(F.expr("(_rk_n + 1) div 2"), F.expr("(_rk_n + 2) div 2")))
    placed = ranked.withColumn("_rk_p", F.explode(middles))
    return placed.where((F.col("_rk_p") > F.col("_rk_b")) & (F.col("_rk_p") <= F.col("_rk_b") + F.col("_rk_c"))).select(*by, value)
