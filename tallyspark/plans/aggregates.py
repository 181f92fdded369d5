"""Section 1: grouped metrics, HAVING filters, absence checks (operators 10-25).

Ledger aggregates are computed per account first (partial + final hash aggregate on the
scan) and only then joined to accounts, owners or branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.core import avg_of, collated, fround, lc, mean_exact, money, ratio
from tallyspark.operators import ranking
from tallyspark.operators.relational import absent, branch_names, customer_names, owners, population
from tallyspark.sources.banking import Bank

FEE_THRESHOLD = 500
TOP_BRANCHES = 5
INACTIVE_MONTHS = 24


def q10_accounts_without_transactions(b: Bank) -> DataFrame:
    return absent(b.accounts.select("account_id"), b.transactions, "account_id")


def by_text(df: DataFrame, text: str, sums: dict[str, Column], case_insensitive: bool = True) -> DataFrame:
    """Rows grouped by a text, each group shown as its smallest variant. Under the reference's default
    collation texts that differ in case or accents are one group; they are summed as written first, so
    the collation sees one row per variant."""
    g = df.groupBy(text).agg(*[c.alias(n) for n, c in sums.items()])
    if not case_insensitive:
        return g
    return g.groupBy(collated(text).alias("_text")).agg(F.min(text).alias(text), *[F.sum(n).alias(n) for n in sums]).drop("_text")


def q11_avg_size_by_transaction_type(b: Bank, case_insensitive: bool = True) -> DataFrame:
    g = by_text(b.transactions, "transaction_type", {"s": F.sum(F.abs("amount")), "n": F.count("amount")}, case_insensitive)
    return g.select("transaction_type", avg_of("s", "n").alias("avg_transaction_size")).orderBy(F.desc("avg_transaction_size"), "transaction_type")


def q12_customers_in_multiple_branches(b: Bank) -> DataFrame:
    acc = b.accounts.select("account_id", "branch_id")
    per_cust = (
        owners(b, acc)
        .groupBy("customer_id")
        .agg(F.countDistinct("branch_id").alias("branch_count"))
        .where(F.col("branch_count") > 1)
    )
    return per_cust.join(customer_names(b), "customer_id").select(
        "customer_id", "customer_name", "branch_count"
    ).orderBy(F.desc("branch_count"), "customer_id")


def q13_branch_avg_account_age(b: Bank) -> DataFrame:
    age = F.datediff(b.as_of_col, F.col("opened_date"))
    g = b.accounts.groupBy("branch_id").agg(F.sum(age).alias("s"), F.count(age).alias("n"))
    return g.join(branch_names(b), "branch_id").select(
        "branch_id", "branch_name", avg_of("s", "n").alias("avg_account_age_days")
    ).orderBy(F.desc("avg_account_age_days"), "branch_id")


def q14_loan_type_averages(b: Bank, case_insensitive: bool = True) -> DataFrame:
    sums = {"si": F.sum("interest_rate"), "ni": F.count("interest_rate"), "sp": F.sum("principal_amount"), "np": F.count("principal_amount")}
    g = by_text(b.loans, "loan_type", sums, case_insensitive)
    return g.select(
        "loan_type", avg_of("si", "ni").alias("avg_interest_rate"), avg_of("sp", "np").alias("avg_principal_amount")
    ).orderBy(F.desc("avg_principal_amount"), "loan_type")


def q15_customers_fees_over_threshold(b: Bank, threshold: int = FEE_THRESHOLD) -> DataFrame:
    per_acc = b.fees.groupBy("account_id").agg(F.sum("amount").alias("fees"))
    per_cust = owners(b, per_acc).groupBy("customer_id").agg(F.sum("fees").alias("total"))
    return (
        per_cust.where(F.col("total") > threshold)
        .join(customer_names(b), "customer_id")
        .select("customer_id", "customer_name", money("total").alias("total_fees_paid"))
        .orderBy(F.desc("total_fees_paid"), "customer_id")
    )


def q16_top_branches_by_volume(b: Bank, top: int = TOP_BRANCHES) -> DataFrame:
    per_acc = b.transactions.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    per_branch = (
        per_acc.join(b.accounts.select("account_id", "branch_id"), "account_id")
        .groupBy("branch_id")
        .agg(F.sum("n").alias("transaction_count"))
    )
    # A top-k report: the limit is the feature. orderBy + limit plans TakeOrderedAndProject.
    return (
        per_branch.join(branch_names(b), "branch_id")
        .select("branch_id", "branch_name", F.col("transaction_count").cast("long").alias("transaction_count"))
        .orderBy(F.desc("transaction_count"), F.asc("branch_id"))
        .limit(top)
    )


def q17_frozen_account_percentage(b: Bank) -> DataFrame:
    frozen = F.sum(F.when(lc("status") == "frozen", 1).otherwise(0))
    return b.accounts.agg(fround(ratio(frozen * 100, F.count(F.lit(1))), 2).alias("frozen_percentage"))


def q18_negative_ledger_accounts(b: Bank) -> DataFrame:
    g = b.transactions.groupBy("account_id").agg(F.sum("amount").alias("bal"))
    return g.where(F.col("bal") < 0).select("account_id", money("bal").alias("net_ledger_balance")).orderBy(
        "net_ledger_balance", "account_id"
    )


def q19_customers_inactive_two_years(b: Bank, months: int = INACTIVE_MONTHS) -> DataFrame:
    per_acc = b.transactions.groupBy("account_id").agg(F.max("transaction_date").alias("last"))
    per_cust = owners(b, per_acc).groupBy("customer_id").agg(F.max("last").alias("latest_transaction_date"))
    cutoff = F.add_months(b.as_of_col, -months).cast("timestamp_ntz")
    return (
        per_cust.where(F.col("latest_transaction_date") < cutoff)
        .join(customer_names(b), "customer_id")
        .select("customer_id", "customer_name", "latest_transaction_date")
    )


def q20_median_amount_per_account(b: Bank) -> DataFrame:
    """Average of the middle row(s) of each account's amounts in ascending order.

    As in the reference, NULL amounts sort first and count in n; the rows at positions
    floor((n+1)/2) and floor((n+2)/2) are averaged (NULLs skipped by the average). The ledger is
    reduced to a count per (account, amount) first (``ranking.median_rows``).
    """
    middle = ranking.median_rows(b.transactions.select("account_id", "amount"), ["account_id"], "amount")
    g = middle.groupBy("account_id").agg(F.sum("amount").alias("s"), F.count("amount").alias("n"))
    return g.select("account_id", avg_of("s", "n").alias("median_transaction_amount"))


def q21_employees_without_transactions(b: Bank) -> DataFrame:
    creators = b.transactions.select(F.col("created_by_employee_id").alias("employee_id")).where(
        F.col("employee_id").isNotNull()
    )
    return absent(b.employees.select("employee_id", "branch_id"), creators, "employee_id")


def q22_branches_withdrawal_avg_exceeds_deposit(b: Bank) -> DataFrame:
    t = b.ledger
    is_w, is_d = F.col("type_lc") == "withdrawal", F.col("type_lc") == "deposit"
    per_acc = t.groupBy("account_id").agg(
        F.sum(F.when(is_w, F.abs("amount"))).alias("sw"), F.count(F.when(is_w, F.col("amount"))).alias("nw"),
        F.sum(F.when(is_d, F.col("amount"))).alias("sd"), F.count(F.when(is_d, F.col("amount"))).alias("nd"),
    )
    per_branch = (
        per_acc.join(b.accounts.select("account_id", "branch_id"), "account_id")
        .groupBy("branch_id")
        .agg(F.sum("sw").alias("sw"), F.sum("nw").alias("nw"), F.sum("sd").alias("sd"), F.sum("nd").alias("nd"))
        .where(ratio("sw", "nw") > ratio("sd", "nd"))
    )
    return per_branch.join(branch_names(b), "branch_id").select(
        "branch_id", "branch_name", avg_of("sw", "nw").alias("avg_withdrawal"), avg_of("sd", "nd").alias("avg_deposit")
    )


def q23_joint_vs_single_owner_counts(b: Bank) -> DataFrame:
    per_acc = b.customer_accounts.groupBy("account_id").agg(F.countDistinct("customer_id").alias("owner_count"))
    return per_acc.agg(
        F.sum(F.when(F.col("owner_count") == 1, 1).otherwise(0)).cast("long").alias("single_owner_accounts"),
        F.sum(F.when(F.col("owner_count") > 1, 1).otherwise(0)).cast("long").alias("joint_accounts"),
    )


def q24_customers_above_overall_avg(b: Bank) -> DataFrame:
    t = b.transactions
    per_acc = t.groupBy("account_id").agg(F.sum(F.abs("amount")).alias("s"), F.count("amount").alias("n"))
    per_cust = owners(b, per_acc).groupBy("customer_id").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    overall = population(t, mean_exact(F.abs("amount")))
    return (
        per_cust.where(ratio("s", "n") > overall)
        .join(customer_names(b), "customer_id")
        .select("customer_id", "customer_name", avg_of("s", "n").alias("avg_txn"))
        .orderBy(F.desc("avg_txn"), "customer_id")
    )


def q25_transaction_types_by_impact(b: Bank, case_insensitive: bool = True) -> DataFrame:
    g = by_text(b.transactions, "transaction_type", {"s": F.sum("amount")}, case_insensitive)
    return g.select("transaction_type", money("s").alias("total_impact")).orderBy(F.desc("total_impact"), "transaction_type")
