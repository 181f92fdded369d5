"""Fixed schemas of the ten banking tables, validated when a table is staged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(5, 2)


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


L, S, D, TS, I = T.LongType(), T.StringType(), T.DateType(), T.TimestampNTZType(), T.IntegerType()

SCHEMAS: dict[str, T.StructType] = {
    "customers": _s(("customer_id", L, False), ("first_name", S, True), ("last_name", S, True), ("city", S, True)),
    "accounts": _s(
        ("account_id", L, False), ("branch_id", L, True), ("account_type", S, True), ("status", S, True),
        ("current_balance", MONEY, True), ("opened_date", D, True),
    ),
    "customer_accounts": _s(("customer_id", L, False), ("account_id", L, False), ("ownership_start_date", D, True)),
    "transactions": _s(
        ("transaction_id", L, False), ("account_id", L, True), ("transaction_type", S, True), ("amount", MONEY, True),
        ("transaction_date", TS, True), ("created_by_employee_id", L, True),
    ),
    "branches": _s(("branch_id", L, False), ("name", S, True), ("city", S, True)),
    "employees": _s(("employee_id", L, False), ("branch_id", L, True)),
    "loans": _s(
        ("loan_id", L, False), ("customer_id", L, True), ("account_id", L, True), ("loan_type", S, True),
        ("interest_rate", RATE, True), ("principal_amount", MONEY, True), ("start_date", D, True),
        ("end_date", D, True), ("default_flag", I, True), ("status", S, True),
    ),
    "cards": _s(("card_id", L, False), ("account_id", L, False), ("card_type", S, True), ("status", S, True)),
    "fees": _s(("fee_id", L, False), ("account_id", L, True), ("amount", MONEY, True), ("fee_date", D, True)),
    "transfers": _s(
        ("transfer_id", L, False), ("from_account_id", L, True), ("to_account_id", L, True), ("amount", MONEY, True),
        ("transaction_date", TS, True), ("initiated_at", TS, True),
    ),
}

#: Stored with the staged ledger, so that filters on them reach the files.
LEDGER_DERIVED = [T.StructField("type_lc", S, True), T.StructField("tx_day", D, True), T.StructField("tx_month", D, True)]


def with_ledger_columns(df: DataFrame) -> DataFrame:
    """Lower-case type, day and first day of the month of each transaction."""
    return df.withColumns({
        "type_lc": F.lower("transaction_type"), "tx_day": F.to_date("transaction_date"),
        "tx_month": F.trunc("transaction_date", "MM"),
    })


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types, and check names.

    Casting is a no-op projection when the staging already produced the right type, so the
    check costs nothing at run time; a missing column fails at analysis, before any job runs.
    """
    schema = SCHEMAS[table]
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
