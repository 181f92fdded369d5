"""Section 3: comparisons with a population or a peer group (operators 56-65).

Scalar subqueries stay scalar subqueries (``DataFrame.scalar()``: computed once, inlined
into the filter, no join); correlated subqueries on equality become a grouped aggregate joined back
on the correlation key, which is map-side combined and never sorts a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.core import avg_of, collated, mean_exact, money, ratio
from tallyspark.operators.relational import branch_names, customer_names, owners, population
from tallyspark.sources.banking import Bank

LARGE_MULTIPLE = 2


def _customer_totals(b: Bank, value, name: str) -> DataFrame:
    per_acc = b.transactions.groupBy("account_id").agg(F.sum(value).alias("_v"))
    return owners(b, per_acc).groupBy("customer_id").agg(F.sum("_v").alias(name))


def q56_customers_above_avg_total(b: Bank) -> DataFrame:
    tot = _customer_totals(b, F.col("amount"), "total")
    avg_total = population(tot, mean_exact("total"))
    return (
        tot.where(F.col("total").cast("double") > avg_total)
        .join(customer_names(b), "customer_id")
        .select("customer_id", "customer_name", money("total").alias("total_amt"))
        .orderBy(F.desc("total_amt"), "customer_id")
    )


def q57_accounts_with_large_max(b: Bank, multiple: int = LARGE_MULTIPLE) -> DataFrame:
    x = F.abs("amount")
    g = b.transactions.groupBy("account_id").agg(F.max(x).alias("m"), F.sum(x).alias("s"), F.count(x).alias("n"))
    return g.where(F.col("m").cast("double") > multiple * ratio("s", "n")).select("account_id")


def q58_top_deposit_branch(b: Bank) -> DataFrame:
    dep = (
        b.ledger.where(F.col("type_lc") == "deposit")
        .groupBy("account_id")
        .agg(F.sum("amount").alias("s"))
    )
    per_branch = (
        dep.join(b.accounts.select("account_id", "branch_id"), "account_id")
        .groupBy("branch_id")
        .agg(F.sum("s").alias("total"))
    )
    # Exact decimal equality with the maximum: ties for first place are all returned.
    x = per_branch.where(F.col("total") == population(per_branch, F.max("total")))
    return x.join(branch_names(b), "branch_id").select(
        "branch_id", "branch_name", money("total").alias("total_deposits")
    )


def q59_latest_tx_is_largest(b: Bank) -> DataFrame:
    """One row per transaction that sits at the customer's latest timestamp and has the
    customer's largest absolute amount (duplicates kept, as in the reference).

    One ledger pass: an account's latest timestamp, with the largest amount there and how often it
    occurs, and the account's largest amount. Only an account whose latest timestamp is the
    customer's, and whose largest amount there is the customer's, has such rows.
    """
    t = b.transactions.select("account_id", "transaction_date", F.abs("amount").alias("amt"))
    # Per (account, timestamp, amount) and then per account: no row is read twice.
    counted = t.groupBy("account_id", "transaction_date", "amt").agg(F.count(F.lit(1)).alias("n"))
    acc = counted.groupBy("account_id").agg(
        F.max(F.when(F.col("transaction_date").isNotNull() & F.col("amt").isNotNull(), F.struct("transaction_date", "amt", "n"))).alias("top"),
        F.max("transaction_date").alias("last"), F.max("amt").alias("big"),
    )
    # The same for a customer's accounts: rows at equal (timestamp, amount) are counted together.
    tops = owners(b, acc).groupBy("customer_id", "top.transaction_date", "top.amt").agg(
        F.sum("top.n").alias("n"), F.max("last").alias("last"), F.max("big").alias("big")
    )
    top = F.max(F.when(F.col("transaction_date").isNotNull(), F.struct("transaction_date", "amt", "n")))
    cust = tops.groupBy("customer_id").agg(top.alias("top"), F.max("last").alias("latest_dt"), F.max("big").alias("largest"))
    hit = cust.where((F.col("top.transaction_date") == F.col("latest_dt")) & (F.col("top.amt") == F.col("largest")))
    x = hit.select("customer_id", F.explode(F.sequence(F.lit(1).cast("long"), "top.n")).alias("_copy"))
    return x.select("customer_id").join(customer_names(b), "customer_id")


def q60_accounts_above_avg_fee_count(b: Bank) -> DataFrame:
    cnt = b.fees.groupBy("account_id").agg(F.count(F.lit(1)).alias("fee_count"))
    avg_fee = population(cnt, mean_exact("fee_count"))
    return (
        cnt.where(F.col("fee_count") > avg_fee)
        .select("account_id", "fee_count")
        .orderBy(F.desc("fee_count"), "account_id")
    )


def q61_customers_top5pct_tx_count(b: Bank, tiles: int = 20) -> DataFrame:
    from tallyspark.plans.windows import top_customers

    per_acc = b.transactions.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    cnt = owners(b, per_acc).groupBy("customer_id").agg(F.sum("n").cast("long").alias("txn_count"))
    return top_customers(b, cnt, "txn_count", tiles)


def q62_loans_above_type_avg_rate(b: Bank, case_insensitive: bool = True) -> DataFrame:
    loans = b.loans.where(F.col("loan_type").isNotNull())
    by_type = loans.groupBy("loan_type").agg(F.sum("interest_rate").alias("s"), F.count("interest_rate").alias("n"))
    if case_insensitive:  # variants of a type share its mean; few rows, joined by the collated text
        variants = by_type.select("loan_type", collated("loan_type").alias("_type"))
        means = by_type.groupBy(collated("loan_type").alias("_of")).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        by_type = variants.join(means, F.col("_type") == F.col("_of")).drop("_type", "_of")
    x = loans.join(by_type, "loan_type").where(F.col("interest_rate").cast("double") > ratio("s", "n"))
    return x.select("loan_id", "loan_type", money("interest_rate").alias("interest_rate"))


def q63_customers_below_branch_avg_balance(b: Bank) -> DataFrame:
    acc = b.accounts.select("account_id", "branch_id", "current_balance")
    cb = owners(b, acc).groupBy("customer_id", "branch_id").agg(F.sum("current_balance").alias("bal"))
    br = cb.groupBy("branch_id").agg(F.sum("bal").alias("s"), F.count("bal").alias("n"))
    x = cb.join(br, "branch_id").where(F.col("bal").cast("double") < ratio("s", "n"))
    return x.join(customer_names(b), "customer_id").select(
        "customer_id", "customer_name", "branch_id", money("bal").alias("cust_balance"),
        avg_of("s", "n").alias("avg_customer_balance"),
    )


def q64_accounts_last_tx_large_withdrawal(b: Bank) -> DataFrame:
    """The latest row and the average of each account from one map-side combined aggregate."""
    amt = F.abs("amount")
    latest = F.max_by(F.struct("type_lc", amt.alias("amt")), F.struct("transaction_date", "transaction_id"))
    g = b.ledger.groupBy("account_id").agg(latest.alias("last"), F.sum(amt).alias("s"), F.count("amount").alias("n"))
    x = g.where((F.col("last.type_lc") == "withdrawal") & (F.col("last.amt").cast("double") > ratio("s", "n")))
    return x.where(F.col("account_id").isNotNull()).select("account_id")


def q65_owners_of_most_active_account(b: Bank) -> DataFrame:
    act = b.transactions.groupBy("account_id").agg(F.count(F.lit(1)).alias("txn_count"))
    # LIMIT 1 with an account_id tie-break: a distributed top-1 (TakeOrderedAndProject) used
    # as a scalar subquery, so its one value filters the owners without a join.
    top = act.orderBy(F.desc("txn_count"), F.asc("account_id")).limit(1).select("account_id").scalar()
    x = b.customer_accounts.select("customer_id", "account_id").where(F.col("account_id") == top)
    return x.join(customer_names(b), "customer_id").select("customer_id", "customer_name", "account_id")
