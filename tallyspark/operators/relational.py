"""Relational building blocks shared by the plans.

* ``customer_names`` / ``branch_names``: dimension lookups joined after aggregation, so a
  name string is never shuffled with ledger rows.
* ``owners``: the joint-ownership fan-out (account-keyed rows to customer-keyed rows).
  Plans aggregate the ledger per account before calling it, so the fan-out multiplies one
  row per account instead of every transaction, and a hot account becomes one row.
* ``absent`` / ``present``: anti / semi joins whose right side is first reduced to its
  distinct keys (a map-side combined aggregate), which keeps a hot key from skewing the
  join and shrinks the shuffle to one row per key and partition.
* ``full_outer``: the full outer join with one column for each key, whichever side a row has.
* ``population``: a global aggregate as a scalar subquery (``DataFrame.scalar()``): it runs
  once and its value is inlined into the filter, with no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.core import customer_name
from tallyspark.sources.banking import Bank


def customer_names(b: Bank) -> DataFrame:
    return b.customers.select("customer_id", customer_name().alias("customer_name"))


def branch_names(b: Bank) -> DataFrame:
    return b.branches.select("branch_id", F.col("name").alias("branch_name"))


def owners(b: Bank, df: DataFrame, account_col: str = "account_id") -> DataFrame:
    """Fan account-keyed rows out to every owner: adds ``customer_id``."""
    ca = b.customer_accounts.select("customer_id", F.col("account_id").alias(account_col))
    return df.join(ca, account_col)


def absent(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    on = [on] if isinstance(on, str) else on
    return left.join(right.select(*on).distinct(), on, "left_anti")


def present(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    on = [on] if isinstance(on, str) else on
    return left.join(right.select(*on).distinct(), on, "left_semi")


def full_outer(left: DataFrame, right: DataFrame, keys: list[str], in_left: str, in_right: str) -> DataFrame:
    """Rows of both sides by equal ``keys``, unmatched ones of either side kept once.

    Each key is one column, from the side that has the row; ``in_left`` and ``in_right`` tell the sides. A
    null key equals nothing, so its rows stay one-sided, each with its own key values.
    """
    a = left.withColumn(in_left, F.lit(True))
    b = right.withColumnsRenamed({k: f"_r_{k}" for k in keys}).withColumn(in_right, F.lit(True))
    cond = F.lit(True)
    for i, k in enumerate(keys):
        one = F.col(k) == F.col(f"_r_{k}")
        cond = one if i == 0 else cond & one
    both = a.join(b, cond, "full_outer")
    sides = {k: F.when(F.col(in_left), F.col(k)).otherwise(F.col(f"_r_{k}")) for k in keys}
    flags = {c: F.coalesce(c, F.lit(False)) for c in (in_left, in_right)}
    return both.withColumns(sides).withColumns(flags).drop(*[f"_r_{k}" for k in keys])


def population(df: DataFrame, aggregate: Column) -> Column:
    """A global aggregate of ``df`` as a scalar-subquery column (one value, computed once)."""
    return df.agg(aggregate).scalar()
