"""Section 2: joins, self joins, semi/anti joins, interval joins (operators 26-55).

Rewrites used here (each checked against the literal shape by the oracle):
* LEFT JOIN + IS NULL  -> ``left_anti`` against distinct keys.
* join + DISTINCT used as EXISTS -> ``left_semi``.
* employees x accounts x transactions fan-outs repaired by COUNT(DISTINCT) -> per-key
  pre-counts and semi/anti joins.
* DISTINCT over rows already unique by the table keys (transaction_id, (customer_id,
  account_id), loan_id) is dropped: it would only add a shuffle of the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.core import (
    avg_of, collated, customer_name, lc, mean_exact, money, month_label, month_start, ratio,
)
from tallyspark.operators.intervals import DAY, without_point
from tallyspark.operators.relational import absent, branch_names, customer_names, owners, population, present
from tallyspark.sources.banking import Bank

REPAYMENT_TYPES = ["loan_payment", "repayment", "emi"]
NEARBY_DAYS = 3
MIN_SENDERS = 10


def q26_customer_account_and_tx_totals(b: Bank) -> DataFrame:
    per_acc = b.transactions.groupBy("account_id").agg(F.count("transaction_id").alias("n"))
    ca = b.customer_accounts.select("customer_id", "account_id").distinct()
    per_cust = (
        ca.join(per_acc, "account_id", "left")
        .groupBy("customer_id")
        .agg(F.count("account_id").alias("acc"), F.sum(F.coalesce("n", F.lit(0))).alias("txn"))
    )
    return (
        customer_names(b)
        .join(per_cust, "customer_id", "left")
        .select(
            "customer_id", "customer_name",
            F.coalesce("acc", F.lit(0)).cast("long").alias("total_accounts"),
            F.coalesce("txn", F.lit(0)).cast("long").alias("total_transactions"),
        )
        .orderBy(F.desc("total_transactions"), F.desc("total_accounts"), "customer_id")
    )


def q27_customer_pairs_sharing_account(b: Bank) -> DataFrame:
    # The output is every ordered owner pair of an account, so a self join on account_id is
    # the operator itself; rows are unique because (customer_id, account_id) is a key.
    ca = b.customer_accounts
    left = ca.select(F.col("customer_id").alias("customer_1"), "account_id")
    right = ca.select(F.col("customer_id").alias("customer_2"), "account_id")
    return left.join(right, "account_id").where(F.col("customer_1") < F.col("customer_2")).select(
        "customer_1", "customer_2", "account_id"
    )


def q28_multi_owner_account_owner_list(b: Bank) -> DataFrame:
    named = b.customer_accounts.select("customer_id", "account_id").join(customer_names(b), "customer_id")
    # GROUP_CONCAT(DISTINCT name ORDER BY customer_id): one entry per distinct name (case and accents
    # aside), that of the smallest id. No length cut (MySQL's 1024-byte default is a setting).
    per_name = named.groupBy("account_id", collated("customer_name").alias("_name")).agg(
        F.min("customer_id").alias("first_id"), F.min_by("customer_name", "customer_id").alias("customer_name"),
        F.countDistinct("customer_id").alias("ids"),
    )
    listed = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("first_id", "customer_name"))), lambda s: s["customer_name"]),
        ", ",
    )
    return (
        per_name.groupBy("account_id")
        .agg(listed.alias("owners"), F.sum("ids").cast("long").alias("owner_count"))
        .where(F.col("owner_count") > 1)
        .orderBy(F.desc("owner_count"), "account_id")
    )


def q29_same_customer_transfers(b: Bank) -> DataFrame:
    ca = b.customer_accounts.select("customer_id", "account_id")
    tr = b.transfers.select("transfer_id", "from_account_id", "to_account_id", "amount")
    x = tr.join(ca.withColumnRenamed("account_id", "from_account_id"), "from_account_id")
    x = x.join(ca.withColumnRenamed("account_id", "to_account_id"), ["to_account_id", "customer_id"])
    return x.select("transfer_id", "from_account_id", "to_account_id", money("amount").alias("amount"))


def q30_customers_with_loan_and_savings(b: Bank) -> DataFrame:
    savings = b.accounts.where(lc("account_type") == "savings").select("account_id")
    savers = present(b.customer_accounts.select("customer_id", "account_id"), savings, "account_id")
    return present(present(customer_names(b), b.loans, "customer_id"), savers, "customer_id")


def q31_cards_on_inactive_accounts(b: Bank) -> DataFrame:
    acc = b.accounts.where(lc("status") != "active").select("account_id", F.col("status").alias("account_status"))
    cards = b.cards.select("card_id", "account_id", F.col("status").alias("card_status"))
    x = owners(b, cards.join(acc, "account_id")).join(customer_names(b), "customer_id")
    # One row per (customer, card, account): (card_id, account_id) and (customer_id,
    # account_id) are keys, so the original DISTINCT is already satisfied.
    return x.select("customer_id", "customer_name", "account_id", "account_status", "card_id", "card_status")


def q32_branches_staffed_without_transactions(b: Bank) -> DataFrame:
    acc = b.accounts.select("account_id", "branch_id")
    with_activity = present(acc, b.transactions, "account_id")
    staffed = present(acc.select("branch_id").distinct(), b.employees, "branch_id")
    return branch_names(b).join(absent(staffed, with_activity, "branch_id"), "branch_id")


def q33_same_day_multiple_withdrawals(b: Bank) -> DataFrame:
    # Self join on (account, day) with t1.id < t2.id keeps (account, day) when it has two or
    # more withdrawals: a grouped count, linear instead of quadratic per day.
    # A NULL account or day never equals another one, so it makes no pair.
    w = b.ledger.where((F.col("type_lc") == "withdrawal") & F.col("account_id").isNotNull() & F.col("tx_day").isNotNull())
    g = w.groupBy("account_id", F.col("tx_day").alias("txn_day")).agg(F.count(F.lit(1)).alias("n"))
    return g.where(F.col("n") > 1).select("account_id", "txn_day")


def q34_customer_branch_city_mismatch(b: Bank) -> DataFrame:
    acc = b.accounts.select("account_id", "branch_id").join(
        b.branches.select("branch_id", F.col("city").alias("branch_city")), "branch_id"
    )
    cust = b.customers.select("customer_id", customer_name().alias("customer_name"), F.col("city").alias("customer_city"))
    x = owners(b, acc).join(cust, "customer_id").where(F.lower("customer_city") != F.lower("branch_city"))
    return x.select("customer_id", "customer_name", "customer_city", "branch_city", "account_id")


def q35_receive_only_accounts(b: Bank) -> DataFrame:
    tr = b.transfers
    received = tr.select(F.col("to_account_id").alias("account_id"))
    sent = tr.select(F.col("from_account_id").alias("account_id"))
    return absent(present(b.accounts.select("account_id"), received, "account_id"), sent, "account_id")


def _top_tx_per_customer(b: Bank, order) -> DataFrame:
    """Top row per customer over the owner-expanded ledger, by a total order.

    Top per account first (``row_number() == 1`` plans a WindowGroupLimit on both sides of
    the shuffle, so a hot account is cut to one row per map task), then top per customer
    over one row per owned account.
    """
    t = b.ledger.select("account_id", "transaction_id", "type_lc", "transaction_date", "amount", F.abs("amount").alias("amt"))
    per_acc = t.withColumn("rn", F.row_number().over(Window.partitionBy("account_id").orderBy(*order))).where("rn = 1")
    per_cust = owners(b, per_acc.drop("rn"))
    return per_cust.withColumn("rn", F.row_number().over(Window.partitionBy("customer_id").orderBy(*order))).where(
        "rn = 1"
    ).drop("rn")


def largest_first():
    return [F.desc("amt"), F.desc("transaction_date"), F.desc("transaction_id")]


def q36_customers_largest_tx_withdrawal(b: Bank) -> DataFrame:
    top = _top_tx_per_customer(b, largest_first()).where(F.col("type_lc") == "withdrawal")
    return top.select("customer_id").join(customer_names(b), "customer_id")


def q37_fees_without_same_month_tx(b: Bank) -> DataFrame:
    fees = b.fees.select("account_id", month_start("fee_date").alias("m"))
    tx = b.ledger.select("account_id", F.col("tx_month").alias("m"))
    gaps = absent(fees, tx, ["account_id", "m"]).distinct()
    return gaps.select("account_id", month_label("m").alias("fee_month"))


def q38_payments_before_loan_start(b: Bank) -> DataFrame:
    pay = b.ledger.where(F.col("type_lc").isin(REPAYMENT_TYPES)).select(
        "account_id", "transaction_id", "transaction_date", "amount"
    )
    loans = b.loans.select("loan_id", "account_id", F.col("start_date").cast("timestamp_ntz").alias("start"))
    # Payments at or after the account's latest start match no loan: they go before the product.
    latest = loans.groupBy("account_id").agg(F.max("start").alias("latest"))
    early = pay.join(latest, "account_id").where(F.col("transaction_date") < F.col("latest")).drop("latest")
    x = loans.join(early, "account_id").where(F.col("transaction_date") < F.col("start"))
    return x.select("loan_id", "account_id", "transaction_id", "transaction_date", money("amount").alias("amount"))


def q39_cards_linked_to_multiple_accounts(b: Bank) -> DataFrame:
    x = owners(b, b.cards.select("card_id", "account_id"))
    g = x.groupBy("customer_id", "card_id").agg(F.countDistinct("account_id").alias("linked_accounts"))
    return g.where(F.col("linked_accounts") > 1).join(customer_names(b), "customer_id").select(
        "customer_id", "customer_name", "card_id", "linked_accounts"
    )


def default_indicator():
    return F.when((F.col("default_flag") == 1) | (lc("status") == "default"), 1).otherwise(0)


def branch_default_rates(b: Bank) -> DataFrame:
    loans = b.loans.select("account_id", default_indicator().alias("d"))
    return (
        loans.join(b.accounts.select("account_id", "branch_id"), "account_id")
        .groupBy("branch_id")
        .agg(F.sum("d").alias("s"), F.count("d").alias("n"))
    )


def q40_branches_above_overall_default_rate(b: Bank) -> DataFrame:
    overall = population(b.loans.select(default_indicator().alias("d")), mean_exact("d"))
    x = branch_default_rates(b).where(ratio("s", "n") > overall)
    return (
        x.join(branch_names(b), "branch_id")
        .select("branch_id", "branch_name", avg_of("s", "n").alias("br_default_rate"))
        .orderBy(F.desc("br_default_rate"), "branch_id")
    )


def q41_accounts_mostly_employee_created(b: Bank) -> DataFrame:
    g = b.transactions.groupBy("account_id").agg(
        F.count("created_by_employee_id").alias("emp"), F.count(F.lit(1)).alias("all")
    )
    return g.where(F.col("emp") > F.col("all") - F.col("emp")).select("account_id")


def q42_joint_owner_after_opening(b: Bank) -> DataFrame:
    x = b.customer_accounts.join(b.accounts.select("account_id", "opened_date"), "account_id").where(
        F.col("ownership_start_date") > F.col("opened_date")
    )
    return x.join(customer_names(b), "customer_id").select(
        "customer_id", "customer_name", "account_id", "ownership_start_date", "opened_date"
    )


def q43_same_day_account_openings(b: Bank) -> DataFrame:
    x = b.customer_accounts.select("customer_id", "account_id").join(
        b.accounts.select("account_id", "opened_date"), "account_id"
    )
    # The opening date joins the equi key, so only same-day accounts of a customer pair up.
    left = x.select("customer_id", F.col("account_id").alias("account_1"), "opened_date")
    right = x.select("customer_id", F.col("account_id").alias("account_2"), "opened_date")
    return left.join(right, ["customer_id", "opened_date"]).where(F.col("account_1") < F.col("account_2")).select(
        "customer_id", "account_1", "account_2", "opened_date"
    )


def q44_cross_branch_employee_handling(b: Bank) -> DataFrame:
    t = b.transactions.where(F.col("created_by_employee_id").isNotNull()).select(
        F.col("created_by_employee_id").alias("employee_id"), "transaction_id", "account_id"
    )
    e = b.employees.select("employee_id", F.col("branch_id").alias("employee_branch"))
    a = b.accounts.select("account_id", F.col("branch_id").alias("account_branch"))
    x = t.join(e, "employee_id").join(a, "account_id").where(F.col("employee_branch") != F.col("account_branch"))
    return x.select("employee_id", "employee_branch", "account_branch", "transaction_id")


def q45_customers_above_branch_avg_accounts(b: Bank) -> DataFrame:
    cc = (
        owners(b, b.accounts.select("account_id", "branch_id"))
        .groupBy("customer_id", "branch_id")
        .agg(F.countDistinct("account_id").alias("acc_count"))
    )
    # Branch average as a grouped aggregate joined back (map-side combined) rather than a
    # window over each branch, so a large branch is never sorted in one task.
    br = cc.groupBy("branch_id").agg(F.sum("acc_count").alias("s"), F.count("acc_count").alias("n"))
    x = cc.join(br, "branch_id").where(F.col("acc_count") > ratio("s", "n"))
    return (
        x.join(customer_names(b), "customer_id")
        .select("customer_id", "customer_name", "branch_id", "acc_count", avg_of("s", "n").alias("avg_acc_per_customer"))
        .orderBy(F.desc("acc_count"), "customer_id", "branch_id")
    )


def q46_customers_without_interest(b: Bank) -> DataFrame:
    ca = b.customer_accounts.select("customer_id", "account_id")
    interest = b.ledger.where(F.col("type_lc") == "interest")
    with_interest = present(ca, interest, "account_id")
    return absent(ca.select("customer_id").distinct(), with_interest, "customer_id").join(
        customer_names(b), "customer_id"
    )


def q47_transfers_date_mismatch(b: Bank) -> DataFrame:
    tr = b.transfers
    return tr.where(F.to_date("transaction_date") != F.to_date("initiated_at")).select(
        "transfer_id", "from_account_id", "to_account_id", "transaction_date", "initiated_at"
    )


def q48_customers_multiple_card_types(b: Bank, case_insensitive: bool = True) -> DataFrame:
    kind = collated("card_type") if case_insensitive else F.col("card_type")
    cards = b.cards.select("account_id", kind.alias("card_type"))
    g = owners(b, cards).groupBy("customer_id").agg(F.countDistinct("card_type").alias("distinct_card_types"))
    return (
        g.where(F.col("distinct_card_types") > 1)
        .join(customer_names(b), "customer_id")
        .select("customer_id", "customer_name", "distinct_card_types")
        .orderBy(F.desc("distinct_card_types"), "customer_id")
    )


def q49_branches_with_mom_avg_decline(b: Bank) -> DataFrame:
    t = b.ledger.select("account_id", F.col("tx_month").alias("ym"), F.abs("amount").alias("x"))
    per_acc = t.groupBy("account_id", "ym").agg(F.sum("x").alias("s"), F.count("x").alias("n"))
    m = (
        per_acc.join(b.accounts.select("account_id", "branch_id"), "account_id")
        .groupBy("branch_id", "ym")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        .withColumn("avg_amt", ratio("s", "n"))
    )
    # One row per (branch, month): each window partition is bounded by the months covered.
    prev = F.lag("avg_amt").over(Window.partitionBy("branch_id").orderBy("ym"))
    x = m.withColumn("prev_avg", prev).where(F.col("prev_avg").isNotNull() & (F.col("avg_amt") < F.col("prev_avg")))
    return x.select("branch_id").distinct().join(branch_names(b), "branch_id")


def q50_fees_without_nearby_tx(b: Bank, days: int = NEARBY_DAYS) -> DataFrame:
    """Fees with no transaction of the account in [fee_date - days, fee_date + days].

    Both bounds are midnights, so the last day only matches a transaction at 00:00. The range join goes
    by buckets of ``days`` days (``operators.intervals``), three or four a fee.
    """
    tx = b.transactions.select("account_id", "transaction_date")
    fees = b.fees.select("fee_id", "account_id", "amount", "fee_date").withColumns({
        "_low": F.date_sub("fee_date", days).cast("timestamp_ntz"), "_high": F.date_add("fee_date", days).cast("timestamp_ntz"),
    })
    lone = without_point(tx, fees, ["fee_id"], ["account_id"], "transaction_date", "_low", "_high", max(1, days) * DAY)
    return lone.select("fee_id", "account_id", money("amount").alias("amount"), "fee_date")


def q51_first_tx_before_opening(b: Bank) -> DataFrame:
    first = b.transactions.groupBy("account_id").agg(F.min("transaction_date").alias("first_tx"))
    early = first.join(b.accounts.select("account_id", "opened_date"), "account_id").where(
        F.col("first_tx") < F.col("opened_date").cast("timestamp_ntz")
    )
    return owners(b, early.select("account_id")).join(customer_names(b), "customer_id").select(
        "customer_id", "customer_name", "account_id"
    )


def q52_accounts_many_senders(b: Bank, min_senders: int = MIN_SENDERS) -> DataFrame:
    g = b.transfers.groupBy(F.col("to_account_id").alias("account_id")).agg(
        F.countDistinct("from_account_id").alias("unique_senders")
    )
    return g.where(F.col("unique_senders") > min_senders).orderBy(F.desc("unique_senders"), "account_id")


def q53_loans_without_repayment(b: Bank) -> DataFrame:
    repay = b.ledger.where(F.col("type_lc").isin(REPAYMENT_TYPES))
    loans = absent(b.loans.select("loan_id", "customer_id", "account_id"), repay, "account_id")
    return loans.join(customer_names(b), "customer_id").select("customer_id", "customer_name", "loan_id", "account_id")


def q54_branch_employee_account_ratio(b: Bank) -> DataFrame:
    emp = b.employees.groupBy("branch_id").agg(F.countDistinct("employee_id").alias("e"))
    acc = b.accounts.groupBy("branch_id").agg(F.countDistinct("account_id").alias("a"))
    x = branch_names(b).join(emp, "branch_id", "left").join(acc, "branch_id", "left")
    ratio_col = avg_of(F.coalesce("e", F.lit(0)), F.coalesce("a", F.lit(0)))
    return x.select("branch_id", "branch_name", ratio_col.alias("emp_to_account_ratio")).orderBy(
        F.desc_nulls_last("emp_to_account_ratio"), "branch_id"
    )


def q55_joint_owners_no_activity(b: Bank) -> DataFrame:
    # The EXISTS in the reference's ON clause always holds for the row's own owner, so this
    # is: owners of joint accounts that have no transaction at all.
    ca = b.customer_accounts.select("customer_id", "account_id")
    joint = ca.groupBy("account_id").agg(F.countDistinct("customer_id").alias("n")).where("n > 1")
    x = absent(ca.join(joint.select("account_id"), "account_id", "left_semi"), b.transactions, "account_id")
    return x.join(customer_names(b), "customer_id").select("customer_id", "customer_name", "account_id")
