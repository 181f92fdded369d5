"""NULL accounts, dates, branches and months: the plans against plain window SQL written here."""

import random
from datetime import date, datetime
from decimal import Decimal as D

import pytest

from tallyspark.plans.registry import plan_functions
from tallyspark.sources.banking import FixtureBank
from tallyspark.sources.schema import SCHEMAS

PLANS = plan_functions()
T = datetime


def transactions():
    rows = []
    stamps = [None, T(2023, 1, 5), T(2023, 1, 5), T(2023, 1, 5, 10, 30), T(2023, 2, 1), T(2023, 3, 7, 1), T(2023, 3, 7, 1, 0, 0, 5), None]
    for a, account in enumerate([1, 2, None, 3]):
        for i, ts in enumerate(stamps):
            amount = None if (a + i) % 7 == 6 else D(10 * (i + 1) * (-1) ** (i % 3)) * (40 if i == 6 else 1)
            rows.append((100 * a + i, account, ["Deposit", "withdrawal", None][i % 3], amount, ts, [5, None, 6][i % 3]))
    return rows


@pytest.fixture(scope="module")
def bank(spark):
    given = {
        "transactions": transactions(),
        "customers": [(c, f"f{c}", f"l{c}", None) for c in (1, 2, 3)],
        "accounts": [(1, 10, "savings", "active", D(50), date(2020, 1, 1)), (2, None, None, None, D(70), None), (3, None, None, None, None, None)],
        "customer_accounts": [(1, 1, None), (2, 2, None), (3, 3, None), (3, 1, None)],
        "employees": [(5, None), (6, None), (7, 10)],
        "branches": [(10, "B", "c")],
    }
    tables = {n: spark.createDataFrame(rows, SCHEMAS[n]) for n, rows in given.items()}
    for n in SCHEMAS:
        tables.setdefault(n, spark.createDataFrame([], SCHEMAS[n]))
        tables[n].createOrReplaceTempView(f"nk_{n}")
    return FixtureBank(spark, tables)


ORDER = "PARTITION BY account_id ORDER BY transaction_date, transaction_id"
LITERAL = {
    "q067_running_balance": f"SELECT account_id, transaction_id, CAST(SUM(amount) OVER ({ORDER} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_balance FROM nk_transactions",
    "q068_rank_tx_within_account": "SELECT account_id, transaction_id, DENSE_RANK() OVER (PARTITION BY account_id ORDER BY abs(amount) DESC) AS txn_rank FROM nk_transactions",
    "q073_cumulative_deposit_withdrawal": f"""SELECT account_id, transaction_id,
        CAST(SUM(IF(lower(transaction_type) = 'deposit', amount, 0)) OVER ({ORDER} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_deposit,
        CAST(SUM(IF(lower(transaction_type) = 'withdrawal', abs(amount), 0)) OVER ({ORDER} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_withdrawal
        FROM nk_transactions""",
    "q075_rank_customers_in_branch_by_balance": """SELECT branch_id, customer_id, DENSE_RANK() OVER (PARTITION BY branch_id ORDER BY SUM(current_balance) DESC) AS branch_rank
        FROM nk_customer_accounts JOIN nk_accounts USING (account_id) GROUP BY branch_id, customer_id""",
    "q079_rank_employees_in_branch": """SELECT branch_id, employee_id, DENSE_RANK() OVER (PARTITION BY branch_id ORDER BY COUNT(transaction_id) DESC) AS branch_rank
        FROM nk_employees LEFT JOIN nk_transactions ON employee_id = created_by_employee_id GROUP BY branch_id, employee_id""",
    "q080_gap_between_transactions": f"""SELECT * FROM (SELECT account_id, transaction_id, LAG(transaction_date) OVER ({ORDER}) AS prev_dt FROM nk_transactions)
        WHERE prev_dt IS NOT NULL""",
    "q085_transaction_spikes": f"""SELECT account_id, transaction_id FROM (SELECT *, AVG(abs(amount)) OVER ({ORDER} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS r
        FROM nk_transactions) WHERE abs(amount) > 3 * r""",
    "q090_customers_percentile_drop": """SELECT DISTINCT customer_id FROM (SELECT customer_id, pr, LAG(pr) OVER (PARTITION BY customer_id ORDER BY ym) AS p FROM (
        SELECT customer_id, ym, PERCENT_RANK() OVER (PARTITION BY ym ORDER BY n) AS pr FROM (
        SELECT customer_id, date_format(transaction_date, 'yyyy-MM') AS ym, COUNT(*) AS n
        FROM nk_customer_accounts JOIN nk_transactions USING (account_id) GROUP BY 1, 2))) WHERE pr < p""",
    "q033_same_day_multiple_withdrawals": """SELECT DISTINCT a.account_id, to_date(a.transaction_date) AS txn_day FROM nk_transactions a JOIN nk_transactions b
        ON a.account_id = b.account_id AND to_date(a.transaction_date) = to_date(b.transaction_date) AND a.transaction_id < b.transaction_id
        WHERE lower(a.transaction_type) = 'withdrawal' AND lower(b.transaction_type) = 'withdrawal'""",
}


@pytest.mark.parametrize("key", sorted(LITERAL))
def test_equals_plain_sql(spark, bank, key):
    want = spark.sql(LITERAL[key])
    got = PLANS[key](bank).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), key


def test_null_month_has_no_calendar_average(bank):
    rows = PLANS["q099_rolling_3_month_avg_calendar"](bank).collect()
    assert any(r["ym"] is None for r in rows) and all(r["rolling_3m_avg"] is None for r in rows if r["ym"] is None)


def test_constant_accounts_do_not_vary(spark):
    rows = [(i, 1, "x", D("5234567.89"), T(2023, 1, 1 + i), None) for i in range(7)]
    rows += [(10 + i, 2, "x", D("523456789012.34"), T(2023, 1, 1 + i), None) for i in range(7)]
    rows += [(20 + i, 3, "x", D(100 + i), T(2023, 1, 1 + i), None) for i in range(7)]
    bank = FixtureBank(spark, {"transactions": spark.createDataFrame(rows, SCHEMAS["transactions"])})
    got = {r["account_id"]: (r["volatility"], r["volatility_rank"]) for r in PLANS["q089_rank_accounts_by_volatility"](bank).collect()}
    assert got == {3: (2.0, 1), 1: (0.0, 2), 2: (0.0, 2)}


def test_close_deviations_keep_their_order(spark):
    """Deviations that round to the same four places still have different ranks."""
    rows = [(i, 1, "x", D(1000) + D(i % 2) / 100, T(2023, 1, 1), None) for i in range(10_000)]
    rows += [(20_000 + i, 2, "x", D(1000) + D(i % 2) / 100, T(2023, 1, 1), None) for i in range(10_001)]
    bank = FixtureBank(spark, {"transactions": spark.createDataFrame(rows, SCHEMAS["transactions"])})
    got = {r["account_id"]: r["volatility_rank"] for r in PLANS["q089_rank_accounts_by_volatility"](bank).collect()}
    assert got == {1: 1, 2: 2}


def test_equal_deviations_share_a_rank(spark):
    """The same amounts written 1, 3, 5 and 7 times, shifted too, have one deviation, whatever floats say."""
    rows, n = [], 0
    for account, (times, shift) in enumerate([(1, 0), (3, 0), (5, 0), (7, 0), (3, D("523456789012.34")), (11, D("-0.07"))]):
        for amount in [D("0.00"), D("0.02"), D("0.00")] * times:
            rows.append((n, account, "x", amount + shift, T(2023, 1, 1), None))
            n += 1
    rows += [(n, 90, "x", None, T(2023, 1, 1), None), (n + 1, 91, "x", D("0.00"), T(2023, 1, 1), None), (n + 2, 91, "x", D("9.00"), T(2023, 1, 1), None)]
    bank = FixtureBank(spark, {"transactions": spark.createDataFrame(rows, SCHEMAS["transactions"])})
    got = {r["account_id"]: (r["volatility"], r["volatility_rank"]) for r in PLANS["q089_rank_accounts_by_volatility"](bank).collect()}
    assert got == {91: (4.5, 1), **{a: (0.0094, 2) for a in range(6)}, 90: (None, 3)}


def test_exact_variance_equals_fractions(spark):
    """The key's digits are those of the exact fraction, and it orders as the fractions do."""
    from fractions import Fraction

    from pyspark.sql import functions as F

    from tallyspark.functions.core import cent_moments, with_exact_variance

    rnd = random.Random(4)
    groups = {g: [rnd.randint(-10 ** rnd.randint(1, 11), 10 ** rnd.randint(1, 11)) for _ in range(rnd.randint(1, 30))] for g in range(60)}
    groups |= {100 + g: [10**10 + (i < g) for i in range(1000)] for g in range(1, 6)}
    rows = [(g, D(c) / 100) for g, cents in groups.items() for c in cents]
    df = spark.createDataFrame(rows, "g long, a decimal(18,2)").groupBy("g").agg(*cent_moments("a"))
    got = {r["g"]: r["v"] for r in with_exact_variance(df, "v").collect()}
    exact = {g: Fraction(sum(c * c for c in cs), len(cs)) - Fraction(sum(cs), len(cs)) ** 2 for g, cs in groups.items()}
    for g, v in exact.items():
        digits = int(v * 10**60)
        whole, rest = divmod(digits, 10**60)
        assert int(got[g]["whole"]) == whole
        assert [got[g][f"d{i}"] for i in range(5)] == [rest // 10 ** (48 - 12 * i) % 10**12 for i in range(5)]
    ordered = sorted(exact, key=lambda g: tuple(got[g]))
    assert [exact[g] for g in ordered] == sorted(exact.values())


LITERAL_100 = """
WITH out_tr AS (SELECT from_account_id AS account_id, to_date(transaction_date) AS d, COUNT(*) AS out_cnt, SUM(amount) AS out_amt FROM nk_tr GROUP BY 1, 2),
in_tr AS (SELECT to_account_id AS account_id, to_date(transaction_date) AS d, COUNT(*) AS in_cnt, SUM(amount) AS in_amt FROM nk_tr GROUP BY 1, 2),
combo AS (
  SELECT o.account_id, o.d, COALESCE(i.in_cnt, 0) AS in_cnt, o.out_cnt, COALESCE(i.in_amt, 0) AS in_amt, COALESCE(o.out_amt, 0) AS out_amt
  FROM out_tr o LEFT JOIN in_tr i ON i.account_id = o.account_id AND i.d = o.d
  UNION ALL
  SELECT i.account_id, i.d, i.in_cnt, 0, i.in_amt, 0 FROM in_tr i LEFT ANTI JOIN out_tr o ON o.account_id = i.account_id AND o.d = i.d)
SELECT account_id, d, in_cnt, out_cnt, CAST(in_amt AS DOUBLE) AS in_amt, CAST(out_amt AS DOUBLE) AS out_amt FROM combo
WHERE in_cnt >= {min_in} AND out_cnt >= {min_out} AND ABS(in_amt - out_amt) * {den} <= GREATEST(in_amt, out_amt)"""


@pytest.fixture(scope="module")
def transfers(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        a, b = rnd.choice([None, 1, 1, 2, 3, 4, 5, 6]), rnd.choice([None, 1, 2, 2, 3, 7, 8])
        day = rnd.choice([None, T(2024, 1, 1, 5), T(2024, 1, 1, 9), T(2024, 1, 2), T(2024, 1, 3)])
        rows.append((i, a, b, None if rnd.random() < 0.05 or b == 8 else D(rnd.randint(0, 30)), day, day))
    rows += [(500 + i, 77, 78, D(10), T(2024, 1, 5), None) for i in range(6)]
    rows += [(600, 79, 80, D(0), T(2024, 1, 6), None), (601, 81, 82, None, T(2024, 1, 6), None)]
    df = spark.createDataFrame(rows, SCHEMAS["transfers"])
    df.createOrReplaceTempView("nk_tr")
    return FixtureBank(spark, {"transfers": df})


@pytest.mark.parametrize("den", [10, 1])
@pytest.mark.parametrize("min_out", [0, 1, 5])
@pytest.mark.parametrize("min_in", [0, 1, 5])
def test_one_sided_transfer_days_are_kept(spark, transfers, min_in, min_out, den):
    want = sorted(map(str, spark.sql(LITERAL_100.format(min_in=min_in, min_out=min_out, den=den)).collect()))
    got = PLANS["q100_rapid_in_out_transfers"](transfers, min_in=min_in, min_out=min_out, tolerance_den=den)
    assert sorted(map(str, got.collect())) == want
    if den == 1 and min_in == 0:
        assert any("account_id=77," in r for r in want)


def test_full_outer_keeps_each_row_once(spark):
    from tallyspark.operators.relational import full_outer

    a = spark.createDataFrame([(1, 1, "a"), (1, None, "b"), (None, 2, "c"), (3, 3, "d")], "k long, j long, x string")
    b = spark.createDataFrame([(1, 1, 10), (1, None, 20), (None, 2, 30), (4, 4, 40)], "k long, j long, y long")
    got = {tuple(r) for r in full_outer(a, b, ["k", "j"], "l", "r").select("k", "j", "x", "y", "l", "r").collect()}
    assert got == {
        (1, 1, "a", 10, True, True), (1, None, "b", None, True, False), (None, 2, "c", None, True, False), (3, 3, "d", None, True, False),
        (1, None, None, 20, False, True), (None, 2, None, 30, False, True), (4, 4, None, 40, False, True),
    }
