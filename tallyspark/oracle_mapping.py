"""The staging mapping written as DuckDB CTEs, for the oracle.

It repeats, in SQL, the fixed values of ``tallyspark.sources.banking`` (FIXTURES.md
section 3); the staging test checks that both produce the same ten tables.
"""

MAPPING_CTES = r"""
branches AS (
    SELECT CAST(n_nationkey AS BIGINT) AS branch_id, n_name AS name, upper(n_name) AS city FROM nation
    UNION ALL
    SELECT CAST(100 + r_regionkey AS BIGINT), 'HUB_' || r_name, 'HUB_' || r_name FROM region
),
customers AS (
    SELECT c_custkey AS customer_id,
           CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE 'First' || CAST(c_custkey % 50 AS VARCHAR) END AS first_name,
           c_name AS last_name,
           CASE WHEN c_custkey % 89 = 7 THEN NULL ELSE lower(n_name) END AS city
    FROM customer JOIN nation ON c_nationkey = n_nationkey
),
acc_base AS (
    SELECT c_custkey AS c, c_acctbal,
           DATE '1994-06-01' + CAST((c_custkey * 37) % 700 AS INTEGER) AS od
    FROM customer
),
accounts AS (
    SELECT c AS account_id,
           CAST(c % 25 AS BIGINT) AS branch_id,
           CASE WHEN c % 2 = 0 THEN 'Savings' ELSE 'current' END AS account_type,
           CASE c % 10 WHEN 0 THEN 'Frozen' WHEN 1 THEN 'inactive' WHEN 2 THEN 'CLOSED' WHEN 3 THEN 'Active'
                ELSE 'active' END AS status,
           CAST(c_acctbal AS DECIMAL(18,2)) AS current_balance,
           od AS opened_date
    FROM acc_base
    UNION ALL
    SELECT c + 10000000,
           CAST(CASE WHEN c % 40 = 0 THEN 100 + (c // 40) % 5 WHEN c % 16 = 8 THEN c % 25 ELSE (c + 5) % 25 END AS BIGINT),
           'SAVINGS', 'active',
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 100 AS DECIMAL(18,2)),
           CASE WHEN c % 16 = 4 THEN od ELSE od + 100 END
    FROM acc_base WHERE c % 4 = 0
),
customer_accounts AS (
    SELECT CASE WHEN account_id >= 10000000 THEN account_id - 10000000 ELSE account_id END AS customer_id,
           account_id, opened_date AS ownership_start_date
    FROM accounts
    UNION ALL
    SELECT b.c, b.c - 1, a.opened_date + 30
    FROM acc_base b JOIN accounts a ON a.account_id = b.c - 1
    WHERE b.c % 5 = 1
    UNION ALL
    SELECT b.c, b.c - 1 + 10000000, a.opened_date
    FROM acc_base b JOIN accounts a ON a.account_id = b.c - 1 + 10000000
    WHERE b.c % 8 = 1
),
employees AS (
    SELECT s_suppkey AS employee_id,
           CAST(CASE WHEN s_suppkey % 20 = 0 THEN 100 + (s_suppkey // 20) % 5 ELSE s_nationkey END AS BIGINT) AS branch_id
    FROM supplier
),
transactions AS (
    SELECT 2 * o_orderkey AS transaction_id,
           CASE WHEN o_custkey % 8 = 4 AND o_orderkey % 3 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS account_id,
           CASE o_orderkey % 8 WHEN 0 THEN 'deposit' WHEN 1 THEN 'Deposit' WHEN 2 THEN 'DEPOSIT' WHEN 3 THEN 'withdrawal'
                WHEN 4 THEN 'WITHDRAWAL' WHEN 5 THEN 'Interest' WHEN 6 THEN 'EMI' ELSE 'transfer' END AS transaction_type,
           CAST((CASE WHEN o_orderkey % 8 IN (3, 4, 6) THEN -1 ELSE 1 END)
                * (CASE WHEN o_custkey % 25 = 7 THEN 10 ELSE 1 END)
                * CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(18,2)) AS amount,
           CASE WHEN o_custkey % 50 = 3 THEN
                    CASE WHEN o_orderkey % 10 < 4 THEN TIMESTAMP '2000-01-10 00:00:00'
                         WHEN o_orderkey % 10 < 7 THEN TIMESTAMP '2000-02-10 00:00:00'
                         WHEN o_orderkey % 10 < 9 THEN TIMESTAMP '2000-03-10 00:00:00'
                         ELSE TIMESTAMP '2000-04-10 00:00:00' END
                ELSE o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR END AS transaction_date,
           CASE WHEN o_orderkey % 2 = 0 AND (o_custkey // 15) % 10 <> 9 THEN o_custkey // 15 END AS created_by_employee_id
    FROM orders
    UNION ALL
    SELECT 2 * event_id + 1,
           user_id,
           CASE event_type WHEN 'purchase' THEN 'Withdrawal' WHEN 'click' THEN 'deposit' WHEN 'signup' THEN 'DEPOSIT'
                WHEN 'view' THEN 'transfer' WHEN 'error' THEN 'repayment' END,
           CASE WHEN event_type = 'purchase' THEN -CAST(value AS DECIMAL(18,2)) ELSE CAST(value AS DECIMAL(18,2)) END,
           ts,
           CASE WHEN event_id % 3 <> 0 AND (user_id // 15) % 10 <> 9 THEN user_id // 15 END
    FROM events
),
loans AS (
    SELECT o_orderkey AS loan_id, o_custkey AS customer_id, o_custkey AS account_id,
           CASE (o_orderkey // 10) % 4 WHEN 0 THEN 'home' WHEN 1 THEN 'auto' WHEN 2 THEN 'personal' ELSE 'education' END
               AS loan_type,
           CAST(CAST(500 + (o_orderkey * 37) % 1000 AS DOUBLE) / 100 AS DECIMAL(5,2)) AS interest_rate,
           CAST(o_totalprice AS DECIMAL(18,2)) AS principal_amount,
           CAST(o_orderdate AS DATE) AS start_date,
           CASE WHEN o_orderkey % 70 = 4 THEN NULL
                ELSE CAST(o_orderdate AS DATE) + CAST(3650 + (o_orderkey % 21) * 365 AS INTEGER) END AS end_date,
           CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS default_flag,
           CASE WHEN o_orderkey % 9 = 0 THEN 'Default' ELSE 'active' END AS status
    FROM orders WHERE o_orderkey % 10 = 4
),
cards AS (
    SELECT 2 * c_custkey AS card_id, c_custkey AS account_id,
           CASE WHEN c_custkey % 3 = 0 THEN 'credit' ELSE 'debit' END AS card_type,
           CASE WHEN c_custkey % 11 = 0 THEN 'blocked' ELSE 'active' END AS status
    FROM customer
    UNION ALL
    SELECT 2 * c_custkey, c_custkey + 10000000, CASE WHEN c_custkey % 3 = 0 THEN 'credit' ELSE 'debit' END, 'active'
    FROM customer WHERE c_custkey % 12 = 0
    UNION ALL
    SELECT 2 * c_custkey + 1, c_custkey, 'prepaid', 'active'
    FROM customer WHERE c_custkey % 7 = 0
),
fees AS (
    SELECT o_orderkey AS fee_id, o_custkey AS account_id,
           CAST(50 + o_orderkey % 200 AS DECIMAL(18,2)) AS amount,
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) AS fee_date
    FROM orders WHERE o_orderkey % 6 = 1
),
transfers AS (
    SELECT event_id AS transfer_id,
           CASE WHEN event_id % 10 < 3 THEN event_id % 7 ELSE user_id END AS from_account_id,
           CASE WHEN event_id % 10 < 3 THEN (event_id % 7 + 1 + (event_id // 7) % 6) % 7
                ELSE user_id + 1 + event_id % 13 END AS to_account_id,
           CAST(value AS DECIMAL(18,2)) AS amount,
           ts AS transaction_date,
           ts - (event_id % 36) * INTERVAL 1 HOUR AS initiated_at
    FROM events
)
"""


def with_mapping(sql: str) -> str:
    """Prefix a query with the mapping CTEs, merging with the query's own WITH list."""
    body = sql.strip()
    head = body[:5].upper()
    if head == "WITH ":
        return "WITH " + MAPPING_CTES.strip() + ",\n" + body[5:]
    return "WITH " + MAPPING_CTES.strip() + "\n" + body
