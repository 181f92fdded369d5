"""Section 4: window operators (66-90).

* Rankings, NTILE buckets and percent ranks go through ``operators.ranking`` (an ordered radix of the
  value and counts before its cells), never through a window over all rows.
* Month rollups aggregate first; the lag/rolling windows then run over one row per
  (key, month), so a window partition is bounded by the months covered, not by activity.
* Per-account ledger windows (running sums, lag, 10-row rolling frame) cut crowded accounts by the hour,
  crowded hours again, and carry from earlier parts (``operators.ledger``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.core import avg_of, cent_moments, fround, money, month_label, ratio, variance_number, with_exact_variance
from tallyspark.operators import ledger, ranking
from tallyspark.operators.relational import branch_names, customer_names, owners
from tallyspark.plans.joins import _top_tx_per_customer, branch_default_rates, largest_first
from tallyspark.sources.banking import Bank

OUTLIER_PR = 0.95
SPIKE_FACTOR = 3
SPIKE_ROWS = 10
INCREASES = 3
DORMANT_MONTHS = 12
TAIL_TENTHS = 9  # last 10 % of the timeline: row >= ceil(0.9 * n)
DECLINE_CHAIN = 3
ROLLING_MONTHS = 3


def ledger_columns() -> list[Column]:
    return [
        F.col("transaction_id"), F.col("account_id"), F.col("transaction_type"), money("amount").alias("amount"),
        F.col("transaction_date"), F.col("created_by_employee_id"),
    ]


def top_customers(b: Bank, per_cust: DataFrame, value: str, tiles: int) -> DataFrame:
    """Customers in NTILE(tiles) bucket 1 by ``value`` desc, customer_id as tie-break."""
    top = ranking.top_bucket(per_cust, value, "customer_id", tiles)
    named = top.join(customer_names(b), "customer_id").select("customer_id", "customer_name", value)
    return named.orderBy(F.desc(value), "customer_id")


def customer_month_counts(b: Bank) -> DataFrame:
    per_acc = b.ledger.groupBy("account_id", F.col("tx_month").alias("ym")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return owners(b, per_acc).groupBy("customer_id", "ym").agg(F.sum("n").cast("long").alias("txn_count"))


def split_ledger(t: DataFrame, leaf_rows: int) -> DataFrame:
    """The ledger in leaves; accounts of more than ``leaf_rows`` rows are cut."""
    return ledger.by_time(t, "account_id", limit=leaf_rows, ids_per_leaf=leaf_rows)


def q66_rank_customers_by_value(b: Bank) -> DataFrame:
    per_acc = b.transactions.groupBy("account_id").agg(F.sum("amount").alias("s"))
    tot = owners(b, per_acc).groupBy("customer_id").agg(F.sum("s").alias("total_value"))
    ranked = ranking.dense_rank(tot, "total_value", "rank_no", descending=True)
    return ranked.join(customer_names(b), "customer_id").select(
        "customer_id", "customer_name", money("total_value").alias("total_value"), "rank_no"
    )


def q67_running_balance(b: Bank, leaf_rows: int = ledger.LEAF_ROWS) -> DataFrame:
    t = split_ledger(b.transactions.select("account_id", "transaction_date", "transaction_id", "amount"), leaf_rows)
    x = ledger.running_sums(t, "account_id", {"running_balance": F.col("amount")})
    return x.select(
        "account_id", "transaction_date", "transaction_id", money("amount").alias("amount"),
        money("running_balance").alias("running_balance"),
    ).orderBy("account_id", "transaction_date", "transaction_id")


def q68_rank_tx_within_account(b: Bank) -> DataFrame:
    t = b.transactions.withColumn("_amt", F.abs("amount"))
    ranked = ranking.dense_rank(t, "_amt", "txn_rank", descending=True, by=["account_id"])
    return ranked.select(*ledger_columns(), "txn_rank")


def q69_top_tx_per_customer(b: Bank) -> DataFrame:
    top = _top_tx_per_customer(b, largest_first())
    return top.join(customer_names(b), "customer_id").select(
        "customer_id", "customer_name", "transaction_id", "transaction_date", money("amount").alias("amount")
    )


def q70_account_mom_growth(b: Bank) -> DataFrame:
    m = b.ledger.groupBy("account_id", F.col("tx_month").alias("ym")).agg(
        F.sum(F.abs("amount")).alias("total")
    )
    x = m.withColumn("prev", F.lag("total").over(Window.partitionBy("account_id").orderBy("ym")))
    growth = fround(ratio((F.col("total") - F.col("prev")) * 100, "prev"), 2)
    return x.select(
        "account_id", month_label("ym").alias("ym"), money("total").alias("total_amt"), money("prev").alias("prev_amt"),
        growth.alias("mom_growth_pct"),
    ).orderBy("account_id", "ym")


def q71_customers_three_month_decline(b: Bank, chain: int = DECLINE_CHAIN) -> DataFrame:
    """Customers with ``chain`` consecutive strict declines of monthly activity (the month
    and its ``chain`` predecessors among present months, each lower than the one before)."""
    m = customer_month_counts(b)
    w = Window.partitionBy("customer_id").orderBy("ym")
    lags = [F.col("txn_count")] + [F.col(f"p{i}") for i in range(1, chain + 1)]
    x = m.select("customer_id", "txn_count", *[F.lag("txn_count", i).over(w).alias(f"p{i}") for i in range(1, chain + 1)])
    cond = F.col(f"p{chain}").isNotNull()
    for newer, older in zip(lags, lags[1:]):
        cond = cond & (older > newer)
    return x.where(cond).select("customer_id").distinct()


def q72_rank_branches_by_default_rate(b: Bank) -> DataFrame:
    br = branch_default_rates(b).withColumn("rate", ratio("s", "n"))
    ranked = ranking.dense_rank(br, "rate", "rank_no", descending=True)
    return ranked.join(branch_names(b), "branch_id").select(
        "branch_id", "branch_name", avg_of("s", "n").alias("default_rate"), "rank_no"
    )


def q73_cumulative_deposit_withdrawal(b: Bank, leaf_rows: int = ledger.LEAF_ROWS) -> DataFrame:
    t = b.ledger.select("account_id", "transaction_date", "transaction_id", "type_lc", "amount")
    dep = F.when(F.col("type_lc") == "deposit", F.col("amount")).otherwise(F.lit(0))
    wd = F.when(F.col("type_lc") == "withdrawal", F.abs("amount")).otherwise(F.lit(0))
    moved = t.select("account_id", "transaction_date", "transaction_id", dep.alias("_d"), wd.alias("_w"))
    x = ledger.running_sums(split_ledger(moved, leaf_rows), "account_id", {"cum_deposit": F.col("_d"), "cum_withdrawal": F.col("_w")})
    return x.select(
        "account_id", "transaction_date", "transaction_id",
        money("cum_deposit").alias("cum_deposit"), money("cum_withdrawal").alias("cum_withdrawal"),
    ).orderBy("account_id", "transaction_date", "transaction_id")


def q74_month_balance_drop(b: Bank) -> DataFrame:
    m = b.ledger.groupBy("account_id", F.col("tx_month").alias("ym")).agg(
        F.sum("amount").alias("net")
    )
    w = Window.partitionBy("account_id").orderBy("ym")
    rb = m.withColumn("bal", F.sum("net").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    x = rb.withColumn("prev", F.lag("bal").over(w)).where(F.col("prev").isNotNull() & (F.col("bal") < F.col("prev")))
    return x.select(
        "account_id", month_label("ym").alias("ym"), money("bal").alias("month_end_balance"),
        money("prev").alias("prev_balance"),
    )


def q75_rank_customers_in_branch_by_balance(b: Bank) -> DataFrame:
    acc = b.accounts.select("account_id", "branch_id", "current_balance")
    cb = owners(b, acc).groupBy("customer_id", "branch_id").agg(F.sum("current_balance").alias("total_balance"))
    ranked = ranking.dense_rank(cb, "total_balance", "branch_rank", descending=True, by=["branch_id"])
    return (
        ranked.join(customer_names(b), "customer_id")
        .select("branch_id", "customer_id", "customer_name", money("total_balance").alias("total_balance"), "branch_rank")
        .orderBy("branch_id", "branch_rank", "customer_id")
    )


def q76_outlier_transactions(b: Bank, threshold: float = OUTLIER_PR) -> DataFrame:
    pr = ranking.percent_rank_at_least(b.transactions, F.abs("amount"), threshold, "pr")
    return pr.select(*ledger_columns(), fround("pr", 6).alias("pr"))


def q77_rolling_3_month_avg_rows(b: Bank, months: int = ROLLING_MONTHS) -> DataFrame:
    m = b.ledger.groupBy("account_id", F.col("tx_month").alias("ym")).agg(
        F.sum(F.abs("amount")).alias("total")
    )
    w = Window.partitionBy("account_id").orderBy("ym").rowsBetween(-(months - 1), Window.currentRow)
    return m.select(
        "account_id", month_label("ym").alias("ym"), money("total").alias("month_total"),
        avg_of(F.sum("total").over(w), F.count("total").over(w)).alias("rolling_3m_avg"),
    ).orderBy("account_id", "ym")


def q78_customers_latest_tx_withdrawal(b: Bank) -> DataFrame:
    latest = _top_tx_per_customer(b, [F.desc("transaction_date"), F.desc("transaction_id")])
    x = latest.where(F.col("type_lc") == "withdrawal").select("customer_id")
    return x.join(customer_names(b), "customer_id")


def q79_rank_employees_in_branch(b: Bank) -> DataFrame:
    cnt = (
        b.transactions.where(F.col("created_by_employee_id").isNotNull())
        .groupBy(F.col("created_by_employee_id").alias("employee_id"))
        .agg(F.count("transaction_id").alias("n"))
    )
    emp = b.employees.join(cnt, "employee_id", "left").select(
        "branch_id", "employee_id", F.coalesce("n", F.lit(0)).cast("long").alias("txn_count")
    )
    ranked = ranking.dense_rank(emp, "txn_count", "branch_rank", by=["branch_id"])
    return ranked.orderBy("branch_id", "branch_rank", "employee_id")


def q80_gap_between_transactions(b: Bank, leaf_rows: int = ledger.LEAF_ROWS) -> DataFrame:
    t = split_ledger(b.transactions.select("account_id", "transaction_id", "transaction_date"), leaf_rows)
    x = ledger.previous_values(t, "account_id", {"prev_dt": ("transaction_date", 1)})
    # TIMESTAMPDIFF(DAY): whole elapsed 24-hour days (23 hours -> 0), not calendar days.
    return x.where(F.col("prev_dt").isNotNull()).select(
        "account_id", "transaction_id", "transaction_date", "prev_dt",
        F.timestamp_diff("DAY", "prev_dt", "transaction_date").alias("gap_days"),
    )


def q81_dormant_accounts(b: Bank, months: int = DORMANT_MONTHS) -> DataFrame:
    last = b.transactions.groupBy("account_id").agg(F.max("transaction_date").alias("last_transaction_date"))
    cutoff = F.add_months(b.as_of_col, -months).cast("timestamp_ntz")
    x = b.accounts.select("account_id").join(last, "account_id", "left")
    return x.where(F.col("last_transaction_date").isNull() | (F.col("last_transaction_date") < cutoff))


def q82_rank_loans_by_remaining_term(b: Bank) -> DataFrame:
    loans = b.loans.where(F.col("end_date").isNotNull()).select(
        "loan_id", "account_id", "end_date",
        F.datediff("end_date", b.as_of_col).cast("long").alias("remaining_days"),
    )
    return ranking.dense_rank(loans, "remaining_days", "rank_no", descending=True)


def q83_account_share_of_customer_balance(b: Bank) -> DataFrame:
    cb = b.customer_accounts.select("customer_id", "account_id").join(
        b.accounts.select("account_id", "current_balance"), "account_id"
    )
    tot = cb.groupBy("customer_id").agg(F.sum("current_balance").alias("total"))
    pct = fround(ratio(F.col("current_balance") * 100, "total"), 2)
    return (
        cb.join(tot, "customer_id")
        .select("customer_id", "account_id", money("current_balance").alias("current_balance"), pct.alias("pct_contribution"))
        .orderBy("customer_id", F.desc("pct_contribution"), "account_id")
    )


def q84_customers_top10pct_account_count(b: Bank, tiles: int = 10) -> DataFrame:
    cc = b.customer_accounts.groupBy("customer_id").agg(F.countDistinct("account_id").alias("acc_count"))
    return top_customers(b, cc, "acc_count", tiles)


def q85_transaction_spikes(
    b: Bank, factor: int = SPIKE_FACTOR, rows: int = SPIKE_ROWS, leaf_rows: int = ledger.LEAF_ROWS
) -> DataFrame:
    t = split_ledger(b.transactions.withColumn("_amt", F.abs("amount")), leaf_rows)
    x = ledger.preceding_rows_sum_count(t, "account_id", "_amt", rows, "_s", "_n").withColumn("_ravg", ratio("_s", "_n"))
    x = x.where(F.col("_ravg").isNotNull() & (F.col("_amt").cast("double") > factor * F.col("_ravg")))
    return x.select(*ledger_columns(), fround("_ravg", 4).alias("rolling_avg"))


def q86_rank_cards_by_usage(b: Bank) -> DataFrame:
    per_acc = b.transactions.groupBy("account_id").agg(F.count("transaction_id").alias("n"))
    usage = (
        owners(b, b.cards.select("card_id", "account_id"))
        .join(per_acc, "account_id", "left")
        .groupBy("customer_id", "card_id")
        .agg(F.sum(F.coalesce("n", F.lit(0))).cast("long").alias("txn_count"))
    )
    ranked = ranking.dense_rank(usage, "txn_count", "usage_rank", by=["customer_id"])
    return ranked.orderBy("customer_id", "usage_rank", "card_id")


def q87_branches_increasing_volume(b: Bank, needed: int = INCREASES) -> DataFrame:
    per_acc = b.ledger.groupBy("account_id", F.col("tx_month").alias("ym")).agg(
        F.count(F.lit(1)).alias("n")
    )
    m = (
        per_acc.join(b.accounts.select("account_id", "branch_id"), "account_id")
        .groupBy("branch_id", "ym")
        .agg(F.sum("n").alias("txn_count"))
    )
    x = m.withColumn("prev", F.lag("txn_count").over(Window.partitionBy("branch_id").orderBy("ym")))
    up = F.when(F.col("prev").isNotNull() & (F.col("txn_count") > F.col("prev")), 1).otherwise(0)
    return x.groupBy("branch_id").agg(F.sum(up).alias("ups")).where(F.col("ups") >= needed).select("branch_id")


def q88_largest_tx_in_last_tenth(b: Bank, tail_tenths: int = TAIL_TENTHS) -> DataFrame:
    """Only the latest row that holds the customer's largest amount can decide: it is in the tail
    if any is. It comes from per-account maxima, its position from one conditional count."""
    t = b.transactions
    per_acc = t.groupBy("account_id").agg(
        F.max(F.when(F.col("amount").isNotNull(), F.struct(F.abs("amount"), "transaction_date", "transaction_id"))).alias("big"),
        F.count(F.lit(1)).alias("n"),
    )
    per_cust = owners(b, per_acc).groupBy("customer_id").agg(F.max("big").alias("big"), F.sum("n").alias("total_txn"))
    goal = per_cust.where(F.col("big").isNotNull()).select(
        "customer_id", "total_txn", F.struct("big.transaction_date", "big.transaction_id").alias("big_at")
    )
    # The owners of an account with the rows they look for; ledger rows meet them on the account.
    looked_for = b.customer_accounts.select("customer_id", "account_id").join(goal, "customer_id")
    rows = t.select("account_id", F.struct("transaction_date", "transaction_id").alias("at")).join(looked_for, "account_id")
    position = rows.groupBy("customer_id", "total_txn").agg(F.count(F.when(F.col("at") <= F.col("big_at"), 1)).alias("rn_time"))
    # CEIL(0.9 * n) in exact integer arithmetic
    tail = position.where(F.col("rn_time") >= F.expr(f"({int(tail_tenths)} * total_txn + 9) div 10"))
    return tail.select("customer_id").join(customer_names(b), "customer_id")


def q89_rank_accounts_by_volatility(b: Bank) -> DataFrame:
    g = b.transactions.groupBy("account_id").agg(*cent_moments("amount"))
    # Ranked by the exact variance: equal deviations tie however many rows they come from.
    ranked = ranking.dense_rank(with_exact_variance(g, "_var"), "_var", "volatility_rank", number=variance_number)
    std = F.sqrt(variance_number(F.col("_var"))) / 100.0
    return ranked.select("account_id", fround(std, 4).alias("volatility"), "volatility_rank")


def q90_customers_percentile_drop(b: Bank) -> DataFrame:
    m = customer_month_counts(b)
    p = ranking.percent_rank_of_counts(m, ["ym"], "txn_count", "pr")
    x = p.withColumn("prev_pr", F.lag("pr").over(Window.partitionBy("customer_id").orderBy("ym")))
    return x.where(F.col("prev_pr").isNotNull() & (F.col("pr") < F.col("prev_pr"))).select("customer_id").distinct()
