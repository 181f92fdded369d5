"""Staging: the ten banking tables, their keys and references, and equality with DuckDB."""

import pytest
from oracle_harness import compare
from pyspark.sql import functions as F

from tallyspark.oracle_mapping import with_mapping
from tallyspark.sources.banking import Bank
from tallyspark.sources.schema import SCHEMAS

KEYS = {
    "customers": ["customer_id"], "accounts": ["account_id"], "customer_accounts": ["customer_id", "account_id"],
    "transactions": ["transaction_id"], "branches": ["branch_id"], "employees": ["employee_id"],
    "loans": ["loan_id"], "cards": ["card_id", "account_id"], "fees": ["fee_id"], "transfers": ["transfer_id"],
}


@pytest.fixture(scope="module")
def bank(spark, sf_dir):
    return Bank(spark, sf_dir)


@pytest.mark.parametrize("table", Bank.TABLES)
def test_schema_and_key(bank, table):
    df = bank.table(table)
    assert [f.name for f in df.schema.fields] == [f.name for f in SCHEMAS[table].fields]
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in SCHEMAS[table].fields]
    assert df.groupBy(*KEYS[table]).count().where("count > 1").count() == 0


@pytest.mark.parametrize(
    "child,col,parent,pcol",
    [
        ("customer_accounts", "customer_id", "customers", "customer_id"),
        ("customer_accounts", "account_id", "accounts", "account_id"),
        ("transactions", "account_id", "accounts", "account_id"),
        ("transactions", "created_by_employee_id", "employees", "employee_id"),
        ("accounts", "branch_id", "branches", "branch_id"),
        ("employees", "branch_id", "branches", "branch_id"),
        ("loans", "customer_id", "customers", "customer_id"),
        ("fees", "account_id", "accounts", "account_id"),
        ("cards", "account_id", "accounts", "account_id"),
        ("transfers", "from_account_id", "accounts", "account_id"),
        ("transfers", "to_account_id", "accounts", "account_id"),
    ],
)
def test_references_resolve(bank, child, col, parent, pcol):
    c = bank.table(child).where(F.col(col).isNotNull()).select(F.col(col).alias("k"))
    p = bank.table(parent).select(F.col(pcol).alias("k"))
    assert c.join(p, "k", "left_anti").count() == 0


@pytest.mark.parametrize("table", Bank.TABLES)
def test_staging_equals_duckdb_mapping(bank, con, table):
    ok, msg = compare(bank.table(table), con, with_mapping(f"SELECT * FROM {table}"))
    assert ok, msg


def test_staging_job_roundtrip(spark, sf_dir, con, tmp_path_factory):
    """Tables written by the staging job and read back give the same operator results."""
    from tallyspark.oracle import oracle_sql
    from tallyspark.plans.registry import plan_functions

    path = str(tmp_path_factory.mktemp("staged"))
    Bank(spark, sf_dir).write_staged(path)
    staged = Bank.from_staged(spark, path)
    sql = oracle_sql()
    for key in ["q018_negative_ledger_accounts", "q066_rank_customers_by_value", "q074_month_balance_drop", "q094_high_risk_accounts"]:
        ok, msg = compare(plan_functions()[key](staged), con, sql[key])
        assert ok, f"{key}: {msg}"
