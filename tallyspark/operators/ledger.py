"""Ordered ledger windows that never hold a crowded account in one task.

A plain ``Window.partitionBy('account_id')`` gives every account to one task, which is right until an
account is crowded. Here a crowded account is split (``operators.splits``) by the hour of its ledger order, and
a crowded hour again by second. Rows at a whole second (dates without a time, second resolution) are cut
further into ranges of ``IDS_PER_LEAF`` ids; the order inside an instant is the id, so all levels follow
the order (date, id), and a million rows pinned to one midnight fill one leaf, not more.

Windows run inside leaves; a leaf of a crowded account takes from earlier ones a prefix sum, their
number of rows, or their last few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.splits import LEAF, LEAF_ROWS, add, earlier_sums, hot_rows, split, to_leaves

IDS_PER_LEAF = 1_000_000


def by_time(
    df: DataFrame, key: str, ts: str = "transaction_date", row_id: str = "transaction_id", limit: int = LEAF_ROWS,
    ids_per_leaf: int = IDS_PER_LEAF,
) -> DataFrame:
    """The ledger split for windows ordered by (ts, row_id); a null ts comes first."""
    second = F.date_trunc("second", F.col(ts))
    later = F.coalesce(F.col(ts) > second, F.lit(False))
    ids = F.when(~later, F.floor(F.col(row_id) / F.lit(ids_per_leaf)))
    fine = F.struct(second.alias("s"), later.alias("l"), ids.alias("r"))
    return split(df, [key], [F.date_trunc("hour", F.col(ts)), fine], limit)


def _order(ts: str, row_id: str) -> list[Column]:
    return [F.col(ts).asc(), F.col(row_id).asc()]


def _carried(x: DataFrame, key: str, ts: str, row_id: str, sums: dict[str, Column], wholes: dict[str, str] | None = None) -> DataFrame:
    return earlier_sums(x, [key], [F.asc("_sp_o0"), F.asc("_sp_o1")], [F.max(ts), F.max(row_id)], sums, wholes)


def running_sums(x: DataFrame, key: str, values: dict[str, Column], ts: str = "transaction_date", row_id: str = "transaction_id") -> DataFrame:
    """Add ``SUM(value) OVER (PARTITION BY key ORDER BY ts, row_id ROWS UNBOUNDED PRECEDING)`` for each
    named value. ``x`` comes from ``by_time``."""
    inside = Window.partitionBy(LEAF).orderBy(*_order(ts, row_id)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = x.select("*", *[F.sum(c).over(inside).alias(f"_lg_{n}") for n, c in values.items()])
    out = to_leaves(local, _carried(x, key, ts, row_id, {f"_c_{n}": c for n, c in values.items()}))
    sums = {n: add(F.col(f"_c_{n}"), F.col(f"_lg_{n}")).cast(local.schema[f"_lg_{n}"].dataType) for n in values}
    return out.withColumns(sums).drop(LEAF, *[f"_{p}_{n}" for n in values for p in ("c", "lg")])


def row_numbers(
    x: DataFrame, key: str, number: str, total: str | None = None, ts: str = "transaction_date", row_id: str = "transaction_id"
) -> DataFrame:
    """Add ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts, row_id)`` of every row and, if named,
    ``COUNT(*) OVER (PARTITION BY key)``."""
    inside = Window.partitionBy(LEAF).orderBy(*_order(ts, row_id))
    local = [F.row_number().over(inside).cast("long").alias("_lg_i")]
    if total:
        local.append(F.count(F.lit(1)).over(Window.partitionBy(LEAF)).alias("_lg_n"))
    carry = _carried(x, key, ts, row_id, {"_c_i": F.lit(1).cast("long")}, {"_c_n": "_c_i"} if total else None)
    out = to_leaves(x.select("*", *local), carry).withColumn(number, F.coalesce("_c_i", F.lit(0)) + F.col("_lg_i"))
    if total:
        out = out.withColumn(total, F.coalesce("_c_n", "_lg_n"))
    return out.drop(LEAF, "_lg_i", "_lg_n", "_c_i", "_c_n")


def _last(c: Column, rows: int) -> Column:
    """The last ``rows`` entries of an array."""
    return F.when(F.size(c) > rows, F.slice(c, -rows, rows)).otherwise(c)


def last_rows_before(x: DataFrame, key: str, rows: int, out: str, ts: str = "transaction_date", row_id: str = "transaction_id") -> DataFrame:
    """A row per leaf of the crowded keys: ``out``, the last ``rows`` rows (structs, in order) before it.

    Leaves hand on whole rows, at most ``rows`` of them, so this reads the same exchange as the window
    over all rows; an array here holds at most rows * rows structs.
    """
    order = [F.col(ts).desc(), F.col(row_id).desc()]
    tail = hot_rows(x).withColumn("_lg_d", F.row_number().over(Window.partitionBy(LEAF).orderBy(*order))).where(F.col("_lg_d") <= rows)
    whole = F.struct((-F.col("_lg_d")).alias("_lg_d"), *[c for c in x.columns if c != LEAF])
    tails = tail.groupBy(LEAF, key).agg(F.sort_array(F.collect_list(whole)).alias("_lg_tail"), F.max(ts).alias("_sp_o0"), F.max(row_id).alias("_sp_o1"))
    before = Window.partitionBy(key).orderBy("_sp_o0", "_sp_o1").rowsBetween(-rows, -1)
    return tails.select(LEAF, _last(F.flatten(F.collect_list("_lg_tail").over(before)), rows).alias(out))


def previous_values(
    x: DataFrame, key: str, values: dict[str, tuple[str, int]], ts: str = "transaction_date", row_id: str = "transaction_id"
) -> DataFrame:
    """Add ``LAG(column, offset) OVER (PARTITION BY key ORDER BY ts, row_id)`` for each name: (column,
    offset). A row near the start of a leaf takes it from the last rows before the leaf."""
    inside = Window.partitionBy(LEAF).orderBy(*_order(ts, row_id))
    lags = [F.lag(c, k).over(inside).alias(f"_lag_{n}") for n, (c, k) in values.items()]
    local = x.select("*", F.row_number().over(inside).alias("_lg_i"), *lags)
    joined = to_leaves(local, last_rows_before(x, key, max(k for _, k in values.values()), "_lg_context", ts, row_id))
    found = {}
    for n, (c, k) in values.items():
        at = F.size("_lg_context") + F.col("_lg_i") - k  # 1-based place of the wanted row in the context
        earlier = F.when(at >= 1, F.element_at("_lg_context", F.greatest(at, F.lit(1)))[c])
        found[n] = F.when(F.col("_lg_i") > k, F.col(f"_lag_{n}")).otherwise(earlier)
    return joined.withColumns(found).drop(LEAF, "_lg_i", "_lg_context", *[f"_lag_{n}" for n in values])


def preceding_rows_sum_count(
    x: DataFrame, key: str, value: str, rows: int, sum_out: str, cnt_out: str, ts: str = "transaction_date", row_id: str = "transaction_id"
) -> DataFrame:
    """SUM and COUNT of the column ``value`` over ``ROWS BETWEEN rows PRECEDING AND 1 PRECEDING``.

    Rows near the start of a leaf take what is missing from the last ``rows`` rows before the leaf.
    """
    inside = Window.partitionBy(LEAF).orderBy(*_order(ts, row_id))
    frame = inside.rowsBetween(-rows, -1)
    local = x.select(
        "*", F.row_number().over(inside).alias("_lg_i"), F.sum(value).over(frame).alias("_lg_s"), F.count(value).over(frame).alias("_lg_c")
    )
    joined = to_leaves(local, last_rows_before(x, key, rows, "_lg_context", ts, row_id))
    size = F.size("_lg_context")
    take = F.least(F.lit(rows) - (F.col("_lg_i") - 1), size)
    part = F.filter(F.transform(F.slice("_lg_context", size - take + 1, take), lambda r: r[value]), lambda v: v.isNotNull())
    total = local.schema["_lg_s"].dataType
    more = F.aggregate(part, F.lit(0).cast(total), lambda acc, v: (acc + v).cast(total))
    reach = F.col("_lg_context").isNotNull() & (take > 0)
    more, n = F.when(reach & (F.size(part) > 0), more), F.when(reach, F.size(part)).otherwise(0)
    found = {sum_out: add(F.col("_lg_s"), more).cast(total), cnt_out: F.col("_lg_c") + n}
    return joined.withColumns(found).drop(LEAF, "_lg_i", "_lg_s", "_lg_c", "_lg_context")
