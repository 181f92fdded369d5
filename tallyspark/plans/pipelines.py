"""Section 5: layered pipelines (operators 91-100).

Each pipeline aggregates every source on its own key first (fees and ledger per account,
transfers per (account, day)) and joins the small aggregates afterwards, as the
reference's CTE layering does; the planner picks broadcast or sort-merge for those joins
from their measured sizes (AQE).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.core import avg_of, cent_moments, fround, money, month_label, pop_std, ratio
from tallyspark.operators.relational import branch_names, customer_names, full_outer, owners, population
from tallyspark.plans.windows import customer_month_counts, top_customers
from tallyspark.sources.banking import AS_OF, Bank

DROP_RATIO_DEN = 2  # txn_count < prev / 2
CALENDAR_MONTHS = 24
OVERDRAFT_WEIGHT = 200
RISK_FLOOR = 500
ABNORMAL_FACTOR = 2
LAUNDER_MIN_IN = 5
LAUNDER_MIN_OUT = 5
LAUNDER_TOLERANCE_DEN = 10  # |in - out| <= max(in, out) / 10


def q91_negative_balance_cte(b: Bank) -> DataFrame:
    bal = b.transactions.groupBy("account_id").agg(F.sum("amount").alias("bal"))
    return bal.where(F.col("bal") < 0).select("account_id", money("bal").alias("ledger_balance")).orderBy(
        "ledger_balance", "account_id"
    )


def q92_customer_activity_dropoff(b: Bank, ratio_den: int = DROP_RATIO_DEN) -> DataFrame:
    m = customer_month_counts(b)
    x = m.withColumn("prev_cnt", F.lag("txn_count").over(Window.partitionBy("customer_id").orderBy("ym")))
    # txn_count < 0.5 * prev_cnt, in exact integer arithmetic
    x = x.where(F.col("prev_cnt").isNotNull() & (F.col("txn_count") * ratio_den < F.col("prev_cnt")))
    return x.select("customer_id", month_label("ym").alias("ym"), "prev_cnt", "txn_count").orderBy("customer_id", "ym")


def month_calendar(spark: SparkSession, as_of: dt.date = AS_OF, months: int = CALENDAR_MONTHS) -> DataFrame:
    """Operator 93: the months from ``as_of`` - ``months`` to ``as_of`` as 'yyyy-MM' labels.

    The reference's recursive CTE becomes ``sequence`` + ``explode``. It reads no table, so
    it is a library function (unit-tested) rather than a registered query.
    """
    first = F.trunc(F.add_months(F.lit(as_of), -months), "MM")
    last = F.trunc(F.lit(as_of), "MM")
    months_col = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("month_start")
    return spark.range(1).select(months_col).select(month_label("month_start").alias("ym"))


def q94_high_risk_accounts(b: Bank, weight: int = OVERDRAFT_WEIGHT, floor: int = RISK_FLOOR) -> DataFrame:
    fee = b.fees.groupBy("account_id").agg(F.sum("amount").alias("fees"))
    over = (
        b.ledger.where((F.col("type_lc") == "withdrawal") & (F.col("amount") < 0))
        .groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("od"))
    )
    x = b.accounts.select("account_id").join(fee, "account_id", "left").join(over, "account_id", "left")
    tf, oc = F.coalesce("fees", F.lit(0)), F.coalesce("od", F.lit(0))
    risk = x.select("account_id", tf.alias("tf"), oc.alias("oc"), (tf + weight * oc).alias("risk"))
    return (
        risk.where(F.col("risk") >= floor)
        .select(
            "account_id", money("tf").alias("total_fees"), F.col("oc").cast("long").alias("overdraft_count"),
            money("risk").alias("risk_score"),
        )
        .orderBy(F.desc("risk_score"), "account_id")
    )


def q95_customer_lifetime_value(b: Bank) -> DataFrame:
    dep = F.when(F.col("type_lc") == "deposit", F.col("amount")).otherwise(F.lit(0))
    wd = F.when(F.col("type_lc") == "withdrawal", F.abs("amount")).otherwise(F.lit(0))
    per_acc = b.ledger.groupBy("account_id").agg(F.sum(dep).alias("d"), F.sum(wd).alias("w"))
    cust_tx = owners(b, per_acc).groupBy("customer_id").agg(F.sum("d").alias("d"), F.sum("w").alias("w"))
    fee_acc = b.fees.groupBy("account_id").agg(F.sum("amount").alias("f"))
    cust_fee = owners(b, fee_acc).groupBy("customer_id").agg(F.sum("f").alias("f"))
    clv = cust_tx.join(cust_fee, "customer_id", "left").select(
        "customer_id", ((F.col("d") - F.col("w")) + F.coalesce("f", F.lit(0))).alias("lv")
    )
    return (
        clv.join(customer_names(b), "customer_id")
        .select("customer_id", "customer_name", money("lv").alias("lifetime_value"))
        .orderBy(F.desc("lifetime_value"), "customer_id")
    )


def q96_abnormal_branches(b: Bank, factor: int = ABNORMAL_FACTOR) -> DataFrame:
    per_acc = b.transactions.groupBy("account_id").agg(F.sum(F.abs("amount")).alias("s"), *cent_moments(F.abs("amount")))
    br = (
        per_acc.join(b.accounts.select("account_id", "branch_id"), "account_id")
        .groupBy("branch_id")
        .agg(*[F.sum(c).alias(c) for c in ("s", "n")], *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("c1", "c2")])
        .withColumn("avg_amt", ratio("s", "n"))
    )
    overall = population(br, F.avg("avg_amt"))  # unweighted mean of branch means
    hit = br.where(F.col("avg_amt") > factor * overall)
    return (
        hit.join(branch_names(b), "branch_id")
        .select("branch_id", "branch_name", avg_of("s", "n").alias("avg_amt"), fround(pop_std(), 4).alias("std_amt"))
        .orderBy(F.desc("avg_amt"), "branch_id")
    )


def q97_before_after_first_loan(b: Bank) -> DataFrame:
    first = b.loans.groupBy("customer_id").agg(F.min("start_date").alias("first_loan"))
    # Ledger reduced to one row per (account, day): the comparison with a loan's start date
    # (a midnight) only needs the day.
    per_day = b.transactions.groupBy("account_id", F.to_date("transaction_date").alias("day")).agg(
        F.sum(F.abs("amount")).alias("s"), F.count("amount").alias("n")
    )
    tx = owners(b, per_day)
    before, after = F.col("day") < F.col("first_loan"), F.col("day") >= F.col("first_loan")
    s = (
        first.join(tx, "customer_id", "left")
        .groupBy("customer_id")
        .agg(
            F.sum(F.when(before, F.col("s"))).alias("sb"), F.sum(F.when(before, F.col("n"))).alias("nb"),
            F.sum(F.when(after, F.col("s"))).alias("sa"), F.sum(F.when(after, F.col("n"))).alias("na"),
        )
    )
    return s.join(customer_names(b), "customer_id").select(
        "customer_id", "customer_name", avg_of("sb", "nb").alias("avg_before_loan"),
        avg_of("sa", "na").alias("avg_after_loan"),
    )


def q98_customers_top5pct_value(b: Bank, tiles: int = 20) -> DataFrame:
    per_acc = b.transactions.groupBy("account_id").agg(F.sum(F.abs("amount")).alias("s"))
    val = owners(b, per_acc).groupBy("customer_id").agg(F.sum("s").alias("total_abs_amount"))
    top = top_customers(b, val, "total_abs_amount", tiles)
    return top.select("customer_id", "customer_name", money("total_abs_amount").alias("total_abs_amount")).orderBy(
        F.desc("total_abs_amount"), "customer_id"
    )


def q99_rolling_3_month_avg_calendar(b: Bank, months: int = 3) -> DataFrame:
    start = F.trunc("transaction_date", "MM")
    m = b.transactions.groupBy("account_id", start.alias("month_start")).agg(F.sum(F.abs("amount")).alias("total"))
    m = m.withColumn("mi", F.year("month_start") * 12 + F.month("month_start"))
    # Calendar window: months within [m - (months - 1), m], present or not (RANGE on a month index).
    w = Window.partitionBy("account_id").orderBy("mi").rangeBetween(-(months - 1), Window.currentRow)
    return m.select(
        "account_id", month_label("month_start").alias("ym"),
        # No month is between NULL and NULL: a NULL month has no average.
        F.when(F.col("mi").isNotNull(), avg_of(F.sum("total").over(w), F.count("total").over(w))).alias("rolling_3m_avg"),
    ).orderBy("account_id", "ym")


def q100_rapid_in_out_transfers(
    b: Bank, min_in: int = LAUNDER_MIN_IN, min_out: int = LAUNDER_MIN_OUT, tolerance_den: int = LAUNDER_TOLERANCE_DEN
) -> DataFrame:
    tr = b.transfers.select("from_account_id", "to_account_id", "amount", F.to_date("transaction_date").alias("d"))
    out = tr.groupBy(F.col("from_account_id").alias("account_id"), "d").agg(
        F.count(F.lit(1)).alias("out_cnt"), F.sum("amount").alias("out_amt")
    )
    inn = tr.groupBy(F.col("to_account_id").alias("account_id"), "d").agg(
        F.count(F.lit(1)).alias("in_cnt"), F.sum("amount").alias("in_amt")
    )
    # The reference's LEFT JOIN + UNION ALL of unmatched rows is a full outer join; the planner makes it
    # inner where the limits reject one-sided rows. As there, the sum of a day without transfers
    # out stays NULL when all its amounts are.
    both = full_outer(out, inn, ["account_id", "d"], "_out", "_in")
    zero = F.lit(0)
    x = both.select(
        "account_id", "d", F.coalesce("in_cnt", zero).alias("in_cnt"), F.coalesce("out_cnt", zero).alias("out_cnt"),
        F.when(F.col("_out"), F.coalesce("in_amt", zero)).otherwise(F.col("in_amt")).alias("in_amt"),
        F.coalesce("out_amt", zero).alias("out_amt"),
    )
    balanced = F.abs(F.col("in_amt") - F.col("out_amt")) * tolerance_den <= F.greatest("in_amt", "out_amt")
    return (
        x.where((F.col("in_cnt") >= min_in) & (F.col("out_cnt") >= min_out) & balanced)
        .select(
            "account_id", "d", "in_cnt", "out_cnt", money("in_amt").alias("in_amt"), money("out_amt").alias("out_amt")
        )
        .orderBy(F.desc(F.col("in_cnt") + F.col("out_cnt")), F.desc("d"), "account_id")
    )
