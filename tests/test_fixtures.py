"""Handmade unit fixtures (FIXTURES.md section 5): 3-10 rows per semantic rule.

Each case runs the Spark plan over the fixture tables and the oracle statement (without
the staging mapping) over the same rows in DuckDB, compares both, and checks the value
the rule is about.
"""

from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from oracle_harness import compare
from pyspark.sql import types as T

from tallyspark.oracle import SQL
from tallyspark.plans.registry import plan_functions
from tallyspark.sources.banking import Bank, FixtureBank
from tallyspark.sources.schema import SCHEMAS

PLANS = plan_functions()
D = Decimal


def _duck_type(t: T.DataType) -> str:
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return {
        T.LongType(): "BIGINT", T.IntegerType(): "INTEGER", T.StringType(): "VARCHAR",
        T.DateType(): "DATE", T.TimestampNTZType(): "TIMESTAMP",
    }[t]


class Fixture:
    def __init__(self, spark, **tables):
        self.spark = spark
        self.con = duckdb.connect()
        frames = {}
        for name in Bank.TABLES:
            schema = SCHEMAS[name]
            rows = tables.get(name, [])
            cols = ", ".join(f"{f.name} {_duck_type(f.dataType)}" for f in schema.fields)
            self.con.execute(f"CREATE TABLE {name} ({cols})")
            if rows:
                marks = ", ".join("?" for _ in schema.fields)
                self.con.executemany(f"INSERT INTO {name} VALUES ({marks})", [list(r) for r in rows])
            frames[name] = spark.createDataFrame(rows, schema)
        self.bank = FixtureBank(spark, frames)

    def run(self, key, check_oracle=True):
        df = PLANS[key](self.bank)
        if check_oracle:
            ok, msg = compare(df, self.con, SQL[key])
            assert ok, f"{key}: {msg}"
        return [r.asDict() for r in df.collect()]


def tx(i, acc, typ, amt, ts, emp=None):
    return (i, acc, typ, None if amt is None else D(amt), ts, emp)


def acct(i, branch=1, typ="savings", status="active", bal="100.00", opened=date(2020, 1, 1)):
    return (i, branch, typ, status, D(bal), opened)


CUSTOMERS = [(1, "Ann", "Lee", "pune"), (2, None, "Roy", None), (3, "Ann", "Lee", "delhi")]
BRANCHES = [(1, "Main", "PUNE"), (2, "East", "DELHI"), (3, "Empty", "GOA")]


def test_null_amount_ranks_first_in_median_and_percent_rank(spark):
    t = [
        tx(1, 10, "deposit", None, datetime(2021, 1, 1)),
        tx(2, 10, "deposit", "5.00", datetime(2021, 1, 2)),
        tx(3, 10, "deposit", "7.00", datetime(2021, 1, 3)),
        tx(4, 10, "deposit", "9.00", datetime(2021, 1, 4)),
    ]
    f = Fixture(spark, transactions=t, accounts=[acct(10)])
    # n = 4 with the NULL first: rows 2 and 3 are NULL-excluded 5.00 and 7.00 -> (5 + 7) / 2
    assert f.run("q020_median_amount_per_account")[0]["median_transaction_amount"] == 6.0
    pr = {r["transaction_id"]: r["pr"] for r in f.run("q076_outlier_transactions")}
    assert pr == {4: 1.0}  # NULL has rank 1 (pr 0), 9.00 is the top


def test_equal_timestamps_keep_duplicates_and_tie_break(spark):
    ts = datetime(2022, 5, 1, 10)
    t = [
        tx(1, 10, "deposit", "50.00", datetime(2022, 4, 1)),
        tx(2, 10, "withdrawal", "-80.00", ts),
        tx(3, 10, "deposit", "80.00", ts),
    ]
    f = Fixture(
        spark, customers=CUSTOMERS[:1], accounts=[acct(10)], customer_accounts=[(1, 10, date(2020, 1, 1))],
        transactions=t,
    )
    assert len(f.run("q059_latest_tx_is_largest")) == 2  # both rows at the latest timestamp
    top = f.run("q069_top_tx_per_customer")
    assert [r["transaction_id"] for r in top] == [3]  # tie on |amount| and date: highest id
    assert f.run("q036_customers_largest_tx_withdrawal") == []
    assert len(f.run("q088_largest_tx_in_last_tenth")) == 1


def test_month_gap_rows_vs_calendar_window(spark):
    t = [
        tx(1, 10, "deposit", "30.00", datetime(2023, 1, 5)),
        tx(2, 10, "deposit", "60.00", datetime(2023, 3, 5)),
        tx(3, 10, "deposit", "90.00", datetime(2023, 4, 5)),
    ]
    f = Fixture(spark, transactions=t, accounts=[acct(10)])
    rows = {r["ym"]: r["rolling_3m_avg"] for r in f.run("q077_rolling_3_month_avg_rows")}
    cal = {r["ym"]: r["rolling_3m_avg"] for r in f.run("q099_rolling_3_month_avg_calendar")}
    assert rows["2023-04"] == 60.0  # last three present months: Jan, Mar, Apr
    assert cal["2023-04"] == 75.0  # calendar Feb..Apr: Mar, Apr
    growth = {r["ym"]: r["mom_growth_pct"] for r in f.run("q070_account_mom_growth")}
    assert growth == {"2023-01": None, "2023-03": 100.0, "2023-04": 50.0}  # gaps skipped


def test_whole_day_gap_and_zero_previous_month(spark):
    t = [
        tx(1, 10, "deposit", "0.00", datetime(2023, 1, 1, 1)),
        tx(2, 10, "deposit", "10.00", datetime(2023, 2, 1, 0)),
        tx(3, 10, "deposit", "10.00", datetime(2023, 2, 1, 23)),
    ]
    f = Fixture(spark, transactions=t, accounts=[acct(10)])
    gaps = {r["transaction_id"]: r["gap_days"] for r in f.run("q080_gap_between_transactions")}
    assert gaps == {2: 30, 3: 0}  # 30 days 23 hours -> 30; 23 hours -> 0
    growth = {r["ym"]: r["mom_growth_pct"] for r in f.run("q070_account_mom_growth")}
    assert growth["2023-02"] is None  # previous month total is 0 -> NULL, no error


def test_fee_window_upper_bound_is_midnight(spark):
    fees = [(1, 10, D("50.00"), date(2023, 6, 10)), (2, 11, D("50.00"), date(2023, 6, 10))]
    t = [
        tx(1, 10, "deposit", "1.00", datetime(2023, 6, 13, 0, 0)),  # day +3 at midnight: nearby
        tx(2, 11, "deposit", "1.00", datetime(2023, 6, 13, 12, 0)),  # day +3 at noon: outside
    ]
    f = Fixture(spark, fees=fees, transactions=t, accounts=[acct(10), acct(11)])
    assert [r["fee_id"] for r in f.run("q050_fees_without_nearby_tx")] == [2]


def test_joint_account_fan_out_and_inactive_joint(spark):
    ca = [(1, 10, date(2020, 1, 1)), (2, 10, date(2020, 2, 1)), (1, 11, date(2020, 1, 1)), (3, 11, date(2020, 1, 1))]
    fees = [(1, 10, D("400.00"), date(2023, 1, 1)), (2, 10, D("200.00"), date(2023, 2, 1))]
    t = [tx(1, 10, "deposit", "10.00", datetime(2023, 1, 1))]
    f = Fixture(
        spark, customers=CUSTOMERS, customer_accounts=ca, fees=fees, transactions=t,
        accounts=[acct(10), acct(11)],
    )
    paid = {r["customer_id"]: r["total_fees_paid"] for r in f.run("q015_customers_fees_over_threshold")}
    assert paid == {1: 600.0, 2: 600.0}  # a joint account's fees count in full for each owner
    idle = {(r["customer_id"], r["account_id"]) for r in f.run("q055_joint_owners_no_activity")}
    assert idle == {(1, 11), (3, 11)}
    owners = {r["account_id"]: r["owners"] for r in f.run("q028_multi_owner_account_owner_list")}
    assert owners == {10: "Ann Lee, Roy", 11: "Ann Lee"}  # NULL first name skipped; names distinct


def test_empty_tables_and_branch_without_accounts(spark):
    f = Fixture(spark, branches=BRANCHES, employees=[(1, 3)])
    assert f.run("q017_frozen_account_percentage") == [{"frozen_percentage": None}]
    ratios = {r["branch_id"]: r["emp_to_account_ratio"] for r in f.run("q054_branch_employee_account_ratio")}
    assert ratios == {1: None, 2: None, 3: None}
    assert f.run("q013_branch_avg_account_age") == []


def test_zero_customer_total_and_null_city(spark):
    accounts = [acct(10, bal="50.00", branch=1), acct(11, bal="-50.00", branch=2)]
    ca = [(1, 10, date(2020, 1, 1)), (1, 11, date(2020, 1, 1)), (2, 10, date(2020, 1, 1))]
    f = Fixture(spark, customers=CUSTOMERS, branches=BRANCHES, accounts=accounts, customer_accounts=ca)
    pct = {(r["customer_id"], r["account_id"]): r["pct_contribution"] for r in f.run("q083_account_share_of_customer_balance")}
    assert pct[(1, 10)] is None and pct[(2, 10)] == 100.0
    mism = {(r["customer_id"], r["account_id"]) for r in f.run("q034_customer_branch_city_mismatch")}
    assert mism == {(1, 11)}  # customer 2 has a NULL city: dropped


def test_loan_start_at_transaction_timestamp(spark):
    loans = [(1, 1, 10, "home", D("7.50"), D("1000.00"), date(2023, 3, 1), None, 0, "active")]
    t = [
        tx(1, 10, "EMI", "-10.00", datetime(2023, 3, 1, 0, 0)),  # exactly at start: not before
        tx(2, 10, "repayment", "-20.00", datetime(2023, 2, 28, 23, 0)),
    ]
    f = Fixture(
        spark, customers=CUSTOMERS[:1], loans=loans, transactions=t, accounts=[acct(10)],
        customer_accounts=[(1, 10, date(2020, 1, 1))],
    )
    assert [r["transaction_id"] for r in f.run("q038_payments_before_loan_start")] == [2]
    ba = f.run("q097_before_after_first_loan")[0]
    assert (ba["avg_before_loan"], ba["avg_after_loan"]) == (20.0, 10.0)


def test_tied_bucket_edge_uses_customer_id(spark):
    custs = [(i, "F", f"L{i}", "x") for i in range(1, 12)]
    accounts = [acct(100 + i) for i in range(1, 12)]
    ca = [(i, 100 + i, date(2020, 1, 1)) for i in range(1, 12)]
    t = [tx(i, 100 + (i % 11) + 1, "deposit", "1.00", datetime(2023, 1, 1, i % 24)) for i in range(1, 23)]
    f = Fixture(spark, customers=custs, accounts=accounts, customer_accounts=ca, transactions=t)
    # 11 customers with 2 transactions each: NTILE(20) bucket 1 holds one row, the lowest id
    assert [r["customer_id"] for r in f.run("q061_customers_top5pct_tx_count")] == [1]
    assert [r["customer_id"] for r in f.run("q084_customers_top10pct_account_count")] == [1, 2]


def test_one_sided_transfer_days(spark):
    day = datetime(2024, 1, 3, 9)
    tr = [(i, 1, 2, D("100.00"), day, day) for i in range(5)]  # account 1 only sends
    tr += [(10 + i, 3, 1, D("100.00"), day, day) for i in range(4)]  # 4 in: below 5
    tr += [(20 + i, 2, 4, D("100.00"), day, day) for i in range(5)]  # account 2 receives 5, sends 5
    f = Fixture(spark, transfers=tr)
    rows = f.run("q100_rapid_in_out_transfers")
    assert [(r["account_id"], r["in_cnt"], r["out_cnt"]) for r in rows] == [(2, 5, 5)]


@pytest.mark.parametrize("key", ["q018_negative_ledger_accounts", "q091_negative_balance_cte"])
def test_negative_balance_forms_agree(spark, key):
    t = [tx(1, 10, "withdrawal", "-5.00", datetime(2023, 1, 1)), tx(2, 11, "deposit", "5.00", datetime(2023, 1, 1))]
    f = Fixture(spark, transactions=t, accounts=[acct(10), acct(11)])
    assert [r["account_id"] for r in f.run(key)] == [10]


def test_month_calendar(spark):
    from tallyspark.plans.pipelines import month_calendar

    months = [r["ym"] for r in month_calendar(spark).collect()]
    assert len(months) == 25 and months[0] == "2022-02" and months[-1] == "2024-02"


HOT_KEYS = [
    "q020_median_amount_per_account", "q036_customers_largest_tx_withdrawal", "q059_latest_tx_is_largest",
    "q064_accounts_last_tx_large_withdrawal", "q066_rank_customers_by_value", "q067_running_balance",
    "q068_rank_tx_within_account", "q069_top_tx_per_customer", "q073_cumulative_deposit_withdrawal",
    "q076_outlier_transactions", "q078_customers_latest_tx_withdrawal", "q080_gap_between_transactions",
    "q085_transaction_spikes", "q088_largest_tx_in_last_tenth", "q089_rank_accounts_by_volatility",
]


@pytest.fixture(scope="module")
def hot(spark):
    import random
    from datetime import timedelta

    rnd = random.Random(5)
    start = datetime(2023, 3, 1)
    t = []
    for i in range(360):
        acc = 10 if i % 3 == 0 else 11 + rnd.randint(0, 5)  # account 10 holds a third of the rows
        ts = start + timedelta(minutes=17 * rnd.randint(0, 4000))
        if i % 29 == 0 and t:
            ts = t[-1][4]  # equal timestamps
        amt = None if i % 41 == 7 else f"{rnd.choice([-1, 1]) * rnd.randint(1, 90000) / 100:.2f}"
        typ = rnd.choice(["deposit", "WITHDRAWAL", "Withdrawal", "emi"])
        t.append(tx(i, acc, typ, amt, ts))
    accounts = [acct(a) for a in range(10, 17)]
    ca = [(1, 10, date(2020, 1, 1)), (2, 10, date(2020, 1, 1))] + [(3 + k, 11 + k, date(2020, 1, 1)) for k in range(6)]
    custs = [(c, "F", f"L{c}", "x") for c in range(1, 9)]
    return Fixture(spark, transactions=t, accounts=accounts, customer_accounts=ca, customers=custs)


@pytest.mark.parametrize("key", HOT_KEYS)
def test_hot_account_matches_oracle(hot, key):
    assert hot.run(key) is not None


def test_case_insensitive_grouping_option(spark):
    t = [
        tx(1, 10, "deposit", "10.00", datetime(2023, 1, 1)),
        tx(2, 10, "Deposit", "20.00", datetime(2023, 1, 2)),
        tx(3, 10, "DEPOSIT", "30.00", datetime(2023, 1, 3)),
        tx(4, 10, "EMI", "-5.00", datetime(2023, 1, 4)),
    ]
    f = Fixture(spark, transactions=t, accounts=[acct(10)])
    # Case variants are one group by default, shown as the smallest variant, as in the oracle.
    merged = f.run("q025_transaction_types_by_impact")
    assert sorted((r["transaction_type"], r["total_impact"]) for r in merged) == [("DEPOSIT", 60.0), ("EMI", -5.0)]
    avg = {r["transaction_type"]: r["avg_transaction_size"] for r in f.run("q011_avg_size_by_transaction_type")}
    assert avg == {"DEPOSIT": 20.0, "EMI": 5.0}
    assert PLANS["q025_transaction_types_by_impact"](f.bank, case_insensitive=False).count() == 4
    cards = [(1, 10, "Debit", "active"), (2, 10, "debit", "active"), (3, 10, "credit", "active")]
    g = Fixture(spark, cards=cards, customers=CUSTOMERS[:1], customer_accounts=[(1, 10, date(2020, 1, 1))])
    assert g.run("q048_customers_multiple_card_types")[0]["distinct_card_types"] == 2
    as_written = PLANS["q048_customers_multiple_card_types"](g.bank, case_insensitive=False).collect()
    assert as_written[0]["distinct_card_types"] == 3
    loans = [
        (i, 1, 10, kind, D(rate), D(1000), date(2020, 1, 1), None, 0, "active")
        for i, kind, rate in [(1, "Home", "4.00"), (2, "home", "6.00"), (3, "HOME", "8.00")]
    ]
    h = Fixture(spark, loans=loans)
    assert [(r["loan_type"], r["avg_interest_rate"]) for r in h.run("q014_loan_type_averages")] == [("HOME", 6.0)]
    assert [r["loan_id"] for r in h.run("q062_loans_above_type_avg_rate")] == [3]
    assert PLANS["q062_loans_above_type_avg_rate"](h.bank, case_insensitive=False).collect() == []


def test_accents_and_case_are_one_text(spark):
    """As under MySQL 8's default collation: é, É, e and E are one letter in groups, DISTINCT and joins."""
    t = [tx(i, 10, kind, amt, datetime(2023, 1, 1 + i)) for i, (kind, amt) in enumerate([("dépôt", "10.00"), ("DEPOT", "20.00"), ("Dépot", "60.00"), ("x", "-1.00"), (None, "3.00")])]
    f = Fixture(spark, transactions=t, accounts=[acct(10)])
    assert {(r["transaction_type"], r["total_impact"]) for r in f.run("q025_transaction_types_by_impact")} == {("DEPOT", 90.0), ("x", -1.0), (None, 3.0)}
    assert {(r["transaction_type"], r["avg_transaction_size"]) for r in f.run("q011_avg_size_by_transaction_type")} == {("DEPOT", 30.0), ("x", 1.0), (None, 3.0)}
    ca = [(c, 10, date(2020, 1, 1)) for c in (1, 2, 3, 4)]
    customers = [(1, "Zoé", "A", None), (2, "ZOE", "a", None), (3, "Ann", "B", None), (4, "zoe", "Á", None)]
    cards = [(i, 10, kind, "active") for i, kind in enumerate(["Débit", "debit", "DEBIT", "credit"])]
    g = Fixture(spark, customer_accounts=ca, customers=customers, cards=cards)
    assert [(r["owners"], r["owner_count"]) for r in g.run("q028_multi_owner_account_owner_list")] == [("Zoé A, Ann B", 4)]
    assert {r["distinct_card_types"] for r in g.run("q048_customers_multiple_card_types")} == {2}
    loans = [
        (i, 1, 10, kind, D(rate), D(1000), date(2020, 1, 1), None, 0, "active")
        for i, kind, rate in [(1, "Prêt", "4.00"), (2, "pret", "6.00"), (3, "PRÉT", "8.00"), (4, "Auto", "1.00")]
    ]
    h = Fixture(spark, loans=loans)
    assert {(r["loan_type"], r["avg_interest_rate"]) for r in h.run("q014_loan_type_averages")} == {("Auto", 1.0), ("PRÉT", 6.0)}
    assert [r["loan_id"] for r in h.run("q062_loans_above_type_avg_rate")] == [3]


@pytest.fixture(scope="module")
def empty(spark):
    return Fixture(spark)


@pytest.mark.parametrize("key", sorted(PLANS))
def test_empty_tables_match_oracle(empty, key):
    rows = empty.run(key)
    if key in ("q017_frozen_account_percentage", "q023_joint_vs_single_owner_counts"):
        assert len(rows) == 1 and all(v is None for v in rows[0].values())  # global aggregates
    else:
        assert rows == []


@pytest.mark.parametrize(
    "key", ["q067_running_balance", "q073_cumulative_deposit_withdrawal", "q080_gap_between_transactions",
            "q085_transaction_spikes"],
)
def test_hot_account_in_small_leaves_matches_oracle(hot, key):
    df = PLANS[key](hot.bank, leaf_rows=5)
    ok, msg = compare(df, hot.con, SQL[key])
    assert ok, msg
