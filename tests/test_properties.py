
import pytest
from pyspark.sql import functions as F

from tallyspark.plans.registry import plan_functions
from tallyspark.sources.banking import Bank

P = plan_functions()


@pytest.fixture(scope="module")
def bank(spark, sf_dir):
    return Bank.shared(spark, sf_dir)


def _set(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_accounts_with_and_without_transactions_partition_all(bank):
    without = _set(P["q010_accounts_without_transactions"](bank), "account_id")
    with_tx = _set(bank.transactions.select("account_id").distinct(), "account_id")
    everyone = _set(bank.accounts, "account_id")
    assert without.isdisjoint(with_tx) and without | (with_tx & everyone) == everyone


def test_negative_balance_forms_are_equal(bank):
    a = _set(P["q018_negative_ledger_accounts"](bank), "account_id", "net_ledger_balance")
    b = _set(P["q091_negative_balance_cte"](bank), "account_id", "ledger_balance")
    assert a == b and a


def test_last_running_balance_is_the_ledger_sum(bank):
    run = P["q067_running_balance"](bank)
    last = run.groupBy("account_id").agg(F.max_by("running_balance", F.struct("transaction_date", "transaction_id")).alias("b"))
    total = bank.transactions.groupBy("account_id").agg(F.sum("amount").cast("double").alias("b"))
    assert _set(last, "account_id", "b") == _set(total, "account_id", "b")


def test_single_plus_joint_is_every_owned_account(bank):
    row = P["q023_joint_vs_single_owner_counts"](bank).collect()[0]
    assert row["single_owner_accounts"] + row["joint_accounts"] == bank.customer_accounts.select("account_id").distinct().count()


def test_balance_shares_sum_to_one_hundred(bank):
    shares = P["q083_account_share_of_customer_balance"](bank).where(F.col("pct_contribution").isNotNull())
    sums = shares.groupBy("customer_id").agg(F.sum("pct_contribution").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert sums and all(abs(r["s"] - 100.0) <= 0.005 * r["n"] + 1e-9 for r in sums)


def test_rapid_transfers_full_outer_form_equals_inner(bank):
    tr = bank.transfers.select("from_account_id", "to_account_id", "amount", F.to_date("transaction_date").alias("d"))
    out = tr.groupBy(F.col("from_account_id").alias("account_id"), "d").agg(
        F.count(F.lit(1)).alias("out_cnt"), F.sum("amount").alias("out_amt")
    )
    inn = tr.groupBy(F.col("to_account_id").alias("account_id"), "d").agg(
        F.count(F.lit(1)).alias("in_cnt"), F.sum("amount").alias("in_amt")
    )
    full = out.join(inn, ["account_id", "d"], "full_outer").select(
        "account_id", "d",
        F.coalesce("in_cnt", F.lit(0)).alias("in_cnt"), F.coalesce("out_cnt", F.lit(0)).alias("out_cnt"),
        F.coalesce("in_amt", F.lit(0)).alias("in_amt"), F.coalesce("out_amt", F.lit(0)).alias("out_amt"),
    )
    keep = (
        (F.col("in_cnt") >= 5) & (F.col("out_cnt") >= 5)
        & (F.abs(F.col("in_amt") - F.col("out_amt")) * 10 <= F.greatest("in_amt", "out_amt"))
    )
    assert _set(full.where(keep), "account_id", "d") == _set(P["q100_rapid_in_out_transfers"](bank), "account_id", "d")
