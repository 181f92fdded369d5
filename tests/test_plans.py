
import contextlib
import io
import re

import pytest

from tallyspark.plans.registry import plan_functions, queries
from tallyspark.sources.banking import Bank

QUERIES = queries()
RANKS = [
    "q020_median_amount_per_account", "q061_customers_top5pct_tx_count", "q066_rank_customers_by_value",
    "q068_rank_tx_within_account", "q072_rank_branches_by_default_rate", "q075_rank_customers_in_branch_by_balance",
    "q076_outlier_transactions", "q082_rank_loans_by_remaining_term", "q084_customers_top10pct_account_count",
    "q088_largest_tx_in_last_tenth", "q089_rank_accounts_by_volatility", "q098_customers_top5pct_value",
]


def plan(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("key", RANKS)
def test_ranks_store_nothing_and_sort_no_table_in_one_task(spark, sf_dir, key):
    p = plan(spark, sf_dir, key)
    assert "Scan ExistingRDD" not in p
    # What goes to one partition is aggregated: one row per value bucket, or a single total.
    for line in re.findall(r"Exchange SinglePartition.*\n(.*)", p):
        assert "HashAggregate(" in line, line


def test_no_cross_or_nested_loop_joins(spark, sf_dir):
    for key in QUERIES:
        p = plan(spark, sf_dir, key)
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, key


def test_population_values_are_scalar_subqueries(spark, sf_dir):
    for key in ["q024_customers_above_overall_avg", "q058_top_deposit_branch", "q096_abnormal_branches"]:
        assert "Subquery" in plan(spark, sf_dir, key), key


def test_scan_reads_only_needed_columns(spark, sf_dir):
    p = plan(spark, sf_dir, "q018_negative_ledger_accounts")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    unused = ("transaction_type", "created_by_employee_id", "transaction_date", "o_orderpriority", "props")
    assert schemas and all(u not in s for s in schemas for u in unused), schemas


def test_partial_aggregation_before_shuffle(spark, sf_dir):
    p = plan(spark, sf_dir, "q025_transaction_types_by_impact")
    assert "partial_sum" in p


@pytest.mark.parametrize("key", ["q059_latest_tx_is_largest", "q064_accounts_last_tx_large_withdrawal"])
def test_latest_row_queries_scan_the_ledger_once(spark, sf_dir, key):
    p = plan(spark, sf_dir, key)
    assert len(re.findall(r"FileScan parquet \[o_orderkey", p)) + len(re.findall(r"FileScan parquet \[o_custkey", p)) == 1, p


@pytest.mark.parametrize("key", ["q058_top_deposit_branch", "q094_high_risk_accounts"])
def test_type_filters_reach_the_staged_files(spark, sf_dir, tmp_path, key):
    Bank(spark, sf_dir).write_staged(str(tmp_path / "staged"))
    df = plan_functions()[key](Bank.from_staged(spark, str(tmp_path / "staged")))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(type_lc,", out.getvalue()), out.getvalue()


@pytest.fixture(scope="module")
def staged_plans(spark, sf_dir, tmp_path_factory):
    """Plans over staged tables with broadcasts off; without adaptive execution, so that explain()
    shows which exchanges are read twice."""
    path = str(tmp_path_factory.mktemp("staged"))
    Bank(spark, sf_dir).write_staged(path)
    bank = Bank.from_staged(spark, path)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}

    def text(key):
        try:
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                plan_functions()[key](bank).explain()
            return out.getvalue()
        finally:
            for k, v in kept.items():
                spark.conf.set(k, v)

    return text


def shuffles(p):
    return len(re.findall(r"^[^A-Z]*Exchange (?:hash|range|Single)", p, re.M))


def scans(p, table):
    return len(re.findall(rf"FileScan parquet .*/{table}\]", p))


@pytest.mark.parametrize("key", ["q067_running_balance", "q073_cumulative_deposit_withdrawal", "q080_gap_between_transactions", "q085_transaction_spikes"])
def test_ledger_windows_read_the_ledger_twice(staged_plans, key):
    p = staged_plans(key)
    assert scans(p, "transactions") == 2 and shuffles(p) <= 5, p


@pytest.mark.parametrize(("key", "table"), [("q061_customers_top5pct_tx_count", "transactions"), ("q084_customers_top10pct_account_count", "customer_accounts"), ("q098_customers_top5pct_value", "transactions")])
def test_top_buckets_read_their_input_at_most_twice(staged_plans, key, table):
    assert scans(staged_plans(key), table) <= 2


@pytest.mark.parametrize("key", ["q032_branches_staffed_without_transactions", "q046_customers_without_interest", "q055_joint_owners_no_activity"])
def test_mapped_sources_are_not_copied_into_joins(spark, sf_dir, key):
    """Semi and anti joins over the mapped tables read each source once for each use of a table."""
    p = plan(spark, sf_dir, key)
    for column, most in (("o_orderkey|o_custkey", 1), ("event_id|user_id", 1), ("c_custkey", 4)):
        assert len(re.findall(rf"FileScan parquet \[(?:{column})", p)) <= most, p


UNIQUE = {"account_id", "customer_id", "branch_id", "transaction_id", "employee_id", "card_id", "ym", "transaction_type", "loan_type"}


def test_final_sorts_end_in_a_unique_key(spark, sf_dir):
    """A sort key with few values would send all rows of a value to one task."""
    found = 0
    for key in QUERIES:
        for order in re.findall(r"rangepartitioning\((.*), \d+\)", plan(spark, sf_dir, key)):
            found += 1
            last = re.findall(r"(\w+)#\d+L? (?:ASC|DESC)", order)[-1]
            assert last in UNIQUE, (key, order)
    assert found > 25
