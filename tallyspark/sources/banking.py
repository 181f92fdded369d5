"""Staging: the ten banking tables derived from the driver's Parquet tables.

The mapping is the deterministic one of FIXTURES.md section 3. Every table is a narrow
projection of one source scan (column arithmetic, rows of several kinds by ``explode``, no shuffle); the only join is
``customer`` with the 25-row ``nation`` dimension, which the planner broadcasts by its own
size check. Scans read only the columns a table needs, so Parquet column pruning and
predicate pushdown reach the files.

Queries read this mapping directly and write nothing. In production the staging job
(``tallyspark.stage``) writes the tables once as plain Parquet, the ledger with the derived
columns of ``schema.LEDGER_DERIVED``, and ``Bank.from_staged`` reads them back.
"""

from __future__ import annotations

import datetime as dt
import threading
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources.schema import LEDGER_DERIVED, SCHEMAS, conform, with_ledger_columns

AS_OF = dt.date(2024, 2, 1)

# Fixed values of the staging mapping (FIXTURES.md section 3); they must be equal in the
# DuckDB oracle (tallyspark/oracle.py), so they are kept together here.
SECOND_ACCOUNT_OFFSET = 10_000_000
OPENED_BASE = "1994-06-01"
ACCOUNT_STATUS_BY_MOD10 = ["Frozen", "inactive", "CLOSED", "Active", "active"]  # index 4 = all remaining
ORDER_TX_TYPE_BY_MOD8 = ["deposit", "Deposit", "DEPOSIT", "withdrawal", "WITHDRAWAL", "Interest", "EMI", "transfer"]
EVENT_TX_TYPE = {"purchase": "Withdrawal", "click": "deposit", "signup": "DEPOSIT", "view": "transfer", "error": "repayment"}
LOAN_TYPE_BY_MOD4 = ["home", "auto", "personal", "education"]
PINNED_DAYS = ["2000-01-10", "2000-02-10", "2000-03-10", "2000-04-10"]  # for o % 10 < 4, < 7, < 9, else

S = SECOND_ACCOUNT_OFFSET


def dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _ntz(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def opened_date(cust: Column, second: bool) -> Column:
    """Opening date of a customer's primary or second account, a pure function of the id."""
    primary = F.date_add(F.lit(OPENED_BASE).cast("date"), ((cust * 37) % 700).cast("int"))
    if not second:
        return primary
    return F.when(cust % 16 == 4, primary).otherwise(F.date_add(primary, 100))


def _kinds(*present: Column) -> Column:
    """A row for each kind of row that a source row gives (their numbers): one scan instead of a union
    of scans, and joins are not copied into the branches of a union."""
    return F.explode(F.array_compact(F.array(*[F.when(p, k) for k, p in enumerate(present)])))


def _pick(key: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, v) if expr is None else expr.when(key == i, v)
    return expr


_SHARED: dict[tuple, "Bank"] = {}
_SHARED_LOCK = threading.Lock()


class Bank:
    """Lazy access to the banking tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = as_of
        self._sources: dict[str, DataFrame] = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> Bank:
        """One Bank per (session, directory, as_of): tables are lazy plans over the files, so
        reusing them only saves re-reading Parquet footers and re-analysing the mapping."""
        key = (id(spark), sf_dir.rstrip("/"), as_of)
        with _SHARED_LOCK:
            bank = _SHARED.get(key)
            if bank is None or bank.spark is not spark:
                bank = _SHARED[key] = cls(spark, sf_dir, as_of)
            return bank

    def write_staged(self, path: str) -> None:
        """Write all ten tables under ``path`` (one folder per table), the ledger with its derived
        columns. Plain Parquet, not bucketed: a bucket is never split, so an account holding a third
        of the ledger would be one task."""
        for name in self.TABLES:
            table = self.ledger if name == "transactions" else self.table(name)
            table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")

    @classmethod
    def from_staged(cls, spark: SparkSession, path: str, as_of: dt.date = AS_OF) -> Bank:
        """A Bank over tables written by ``write_staged``."""
        tables = {n: spark.read.schema(SCHEMAS[n]).parquet(f"{path.rstrip('/')}/{n}") for n in cls.TABLES}
        bank = FixtureBank(spark, tables, as_of)
        ledger = T.StructType([*SCHEMAS["transactions"].fields, *LEDGER_DERIVED])
        bank.__dict__["ledger"] = spark.read.schema(ledger).parquet(f"{path.rstrip('/')}/transactions")
        return bank

    def src(self, name: str, *cols: str) -> DataFrame:
        df = self._sources.get(name)
        if df is None:
            df = self._sources[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.select(*cols) if cols else df

    @property
    def as_of_col(self) -> Column:
        return F.lit(self.as_of)

    # ------------------------------------------------------------------ dimensions
    @cached_property
    def branches(self) -> DataFrame:
        nat = self.src("nation", "n_nationkey", "n_name").select(
            F.col("n_nationkey").cast("long").alias("branch_id"),
            F.col("n_name").alias("name"),
            F.upper("n_name").alias("city"),
        )
        hub = self.src("region", "r_regionkey", "r_name").select(
            (F.col("r_regionkey") + 100).cast("long").alias("branch_id"),
            F.concat(F.lit("HUB_"), "r_name").alias("name"),
            F.concat(F.lit("HUB_"), "r_name").alias("city"),
        )
        return conform(nat.unionByName(hub), "branches")

    @cached_property
    def customers(self) -> DataFrame:
        c = F.col("c_custkey")
        cust = self.src("customer", "c_custkey", "c_name", "c_nationkey")
        nat = self.src("nation", "n_nationkey", "n_name")
        df = cust.join(nat, cust.c_nationkey == nat.n_nationkey).select(
            c.alias("customer_id"),
            F.when(c % 97 == 5, None).otherwise(F.concat(F.lit("First"), (c % 50).cast("string"))).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(c % 89 == 7, None).otherwise(F.lower("n_name")).alias("city"),
        )
        return conform(df, "customers")

    @cached_property
    def employees(self) -> DataFrame:
        s = F.col("s_suppkey")
        df = self.src("supplier", "s_suppkey", "s_nationkey").select(
            s.alias("employee_id"),
            F.when(s % 20 == 0, 100 + F.expr("s_suppkey div 20") % 5).otherwise(F.col("s_nationkey")).alias("branch_id"),
        )
        return conform(df, "employees")

    # ------------------------------------------------------------------ accounts and owners
    @cached_property
    def accounts(self) -> DataFrame:
        c, main = F.col("c_custkey"), F.col("_kind") == 0
        rows = self.src("customer", "c_custkey", "c_acctbal").withColumn("_kind", _kinds(F.lit(True), c % 4 == 0))
        second_branch = F.when(c % 40 == 0, 100 + F.expr("c_custkey div 40") % 5).when(c % 16 == 8, c % 25).otherwise((c + 5) % 25)
        own_status = F.coalesce(_pick(c % 10, ACCOUNT_STATUS_BY_MOD10[:4]), F.lit(ACCOUNT_STATUS_BY_MOD10[4]))
        balance = dec(F.col("c_acctbal"))
        df = rows.select(
            F.when(main, c).otherwise(c + S).alias("account_id"),
            F.when(main, c % 25).otherwise(second_branch).alias("branch_id"),
            F.when(main, F.when(c % 2 == 0, "Savings").otherwise("current")).otherwise("SAVINGS").alias("account_type"),
            F.when(main, own_status).otherwise("active").alias("status"),
            F.when(main, balance).otherwise(dec(balance + 100)).alias("current_balance"),
            F.when(main, opened_date(c, second=False)).otherwise(opened_date(c, second=True)).alias("opened_date"),
        )
        return conform(df, "accounts")

    @cached_property
    def customer_accounts(self) -> DataFrame:
        # Kinds: own primary, own second, joint owner of the previous customer's primary, of its second.
        c, kind = F.col("c_custkey"), F.col("_kind")
        rows = self.src("customer", "c_custkey").withColumn("_kind", _kinds(F.lit(True), c % 4 == 0, c % 5 == 1, c % 8 == 1))
        df = rows.select(
            c.alias("customer_id"),
            _pick(kind, [c, c + S, c - 1, c - 1 + S]).alias("account_id"),
            _pick(kind, [
                opened_date(c, second=False), opened_date(c, second=True),
                F.date_add(opened_date(c - 1, second=False), 30), opened_date(c - 1, second=True),
            ]).alias("ownership_start_date"),
        )
        return conform(df, "customer_accounts")

    # ------------------------------------------------------------------ ledgers
    @cached_property
    def transactions(self) -> DataFrame:
        o, k = F.col("o_orderkey"), F.col("o_custkey")
        orders = self.src("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        sign = F.when((o % 8).isin(3, 4, 6), -1).otherwise(1)
        boost = F.when(k % 25 == 7, 10).otherwise(1)
        pinned = (
            F.when(o % 10 < 4, _ntz(PINNED_DAYS[0]))
            .when(o % 10 < 7, _ntz(PINNED_DAYS[1]))
            .when(o % 10 < 9, _ntz(PINNED_DAYS[2]))
            .otherwise(_ntz(PINNED_DAYS[3]))
        )
        emp_k = F.expr("o_custkey div 15")
        from_orders = orders.select(
            (o * 2).alias("transaction_id"),
            F.when((k % 8 == 4) & (o % 3 == 0), k + S).otherwise(k).alias("account_id"),
            _pick(o % 8, ORDER_TX_TYPE_BY_MOD8).alias("transaction_type"),
            # A decimal(3,0) factor keeps the product at decimal(18,2), evaluated on compact longs.
            dec((sign * boost).cast("decimal(3,0)") * F.col("o_totalprice").cast("decimal(14,2)")).alias("amount"),
            F.when(k % 50 == 3, pinned)
            .otherwise(F.timestamp_add("HOUR", (o % 24).cast("int"), F.col("o_orderdate")))
            .alias("transaction_date"),
            F.when((o % 2 == 0) & (emp_k % 10 != 9), emp_k).alias("created_by_employee_id"),
        )
        e, u = F.col("event_id"), F.col("user_id")
        emp_u = F.expr("user_id div 15")
        etype = F.col("event_type")
        ev_type = None
        for src_type, tx_type in EVENT_TX_TYPE.items():
            ev_type = F.when(etype == src_type, tx_type) if ev_type is None else ev_type.when(etype == src_type, tx_type)
        from_events = self.src("events", "event_id", "ts", "user_id", "event_type", "value").select(
            (e * 2 + 1).alias("transaction_id"),
            u.alias("account_id"),
            ev_type.alias("transaction_type"),
            F.when(etype == "purchase", -dec(F.col("value"))).otherwise(dec(F.col("value"))).alias("amount"),
            F.col("ts").alias("transaction_date"),
            F.when((e % 3 != 0) & (emp_u % 10 != 9), emp_u).alias("created_by_employee_id"),
        )
        return conform(from_orders.unionByName(from_events), "transactions")

    @cached_property
    def ledger(self) -> DataFrame:
        """The transactions with the columns that queries filter and group by (stored when staged)."""
        return with_ledger_columns(self.transactions)

    @cached_property
    def loans(self) -> DataFrame:
        o = F.col("o_orderkey")
        start = F.to_date("o_orderdate")
        df = (
            self.src("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
            .where(o % 10 == 4)
            .select(
                o.alias("loan_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("o_custkey").alias("account_id"),
                _pick(F.expr("o_orderkey div 10") % 4, LOAN_TYPE_BY_MOD4).alias("loan_type"),
                ((500 + (o * 37) % 1000).cast("double") / 100).cast("decimal(5,2)").alias("interest_rate"),
                dec(F.col("o_totalprice")).alias("principal_amount"),
                start.alias("start_date"),
                F.when(o % 70 == 4, None).otherwise(F.date_add(start, (3650 + (o % 21) * 365).cast("int"))).alias("end_date"),
                F.when(o % 7 == 0, 1).otherwise(0).alias("default_flag"),
                F.when(o % 9 == 0, "Default").otherwise("active").alias("status"),
            )
        )
        return conform(df, "loans")

    @cached_property
    def cards(self) -> DataFrame:
        # Kinds: the main card, the same card on the second account, a prepaid card.
        c, kind = F.col("c_custkey"), F.col("_kind")
        rows = self.src("customer", "c_custkey").withColumn("_kind", _kinds(F.lit(True), c % 12 == 0, c % 7 == 0))
        df = rows.select(
            F.when(kind == 2, c * 2 + 1).otherwise(c * 2).alias("card_id"),
            F.when(kind == 1, c + S).otherwise(c).alias("account_id"),
            F.when(kind == 2, "prepaid").when(c % 3 == 0, "credit").otherwise("debit").alias("card_type"),
            F.when((kind == 0) & (c % 11 == 0), "blocked").otherwise("active").alias("status"),
        )
        return conform(df, "cards")

    @cached_property
    def fees(self) -> DataFrame:
        o = F.col("o_orderkey")
        df = (
            self.src("orders", "o_orderkey", "o_custkey", "o_orderdate")
            .where(o % 6 == 1)
            .select(
                o.alias("fee_id"),
                F.col("o_custkey").alias("account_id"),
                dec(50 + o % 200).alias("amount"),
                F.date_add(F.to_date("o_orderdate"), (o % 10).cast("int")).alias("fee_date"),
            )
        )
        return conform(df, "fees")

    @cached_property
    def transfers(self) -> DataFrame:
        e, u = F.col("event_id"), F.col("user_id")
        ring = e % 10 < 3
        ring_from = e % 7
        df = self.src("events", "event_id", "ts", "user_id", "value").select(
            e.alias("transfer_id"),
            F.when(ring, ring_from).otherwise(u).alias("from_account_id"),
            F.when(ring, (ring_from + 1 + F.expr("event_id div 7") % 6) % 7).otherwise(u + 1 + e % 13).alias("to_account_id"),
            dec(F.col("value")).alias("amount"),
            F.col("ts").alias("transaction_date"),
            F.timestamp_add("HOUR", -(e % 36).cast("int"), F.col("ts")).alias("initiated_at"),
        )
        return conform(df, "transfers")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    TABLES = (
        "customers", "accounts", "customer_accounts", "transactions", "branches",
        "employees", "loans", "cards", "fees", "transfers",
    )


class FixtureBank(Bank):
    """A Bank over given DataFrames (unit fixtures); missing tables are empty."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], as_of: dt.date = AS_OF):
        super().__init__(spark, "<fixtures>", as_of)
        for name in self.TABLES:
            df = tables.get(name)
            if df is None:
                df = spark.createDataFrame([], SCHEMAS[name])
            self.__dict__[name] = conform(df, name)
