"""The expected result of every registered query, as SQL on the source tables.

Stated from the fixture rules (see FIXTURES.md) and the meaning of each operator: no bronze row, JSON
body or unparsed time appears here, so these statements share nothing with the code they check.
"""

from __future__ import annotations

CREATED = "TIMESTAMP '2024-01-01' + to_days(CAST(n % 28 + version AS INTEGER)) + to_hours(n % 24)"
CURRENCY = "CASE n % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'PKR' END"
NO_MEASURE = "CAST(NULL AS VARCHAR)"

ACCOUNTS = f"""
account_versions AS (
  SELECT c_custkey AS n, c_acctbal, unnest(CASE WHEN c_custkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS version
  FROM customer
),
account_rows AS (
  SELECT
    CASE WHEN n % 41 <> 0 THEN 'ACC-' || n END AS account_id,
    CASE WHEN n % 82 <> 0 THEN 'CUST-' || n END AS customer_id,
    CASE n % 5 WHEN 0 THEN 'Savings' WHEN 1 THEN 'Current' ELSE 'Fixed' END AS account_type,
    c_acctbal + 100 * version AS balance,
    CASE WHEN n % 53 = 0 THEN 'GBP' ELSE {CURRENCY} END AS currency,
    CASE WHEN n % 59 <> 0 THEN {CREATED} END AS created_at,
    CASE WHEN n % 47 = 0 THEN NULL WHEN n % 3 = 0 THEN 'active' WHEN n % 3 = 1 THEN 'inactive'
      ELSE 'blocked' END AS status
  FROM account_versions
  WHERE n % 43 <> 0 AND n % 82 <> 0
),
accounts AS (
  SELECT * FROM account_rows
  QUALIFY row_number() OVER (
    PARTITION BY account_id
    ORDER BY created_at DESC NULLS LAST, customer_id DESC NULLS LAST, balance DESC NULLS LAST
  ) = 1
),
accounts_enriched AS (
  SELECT *,
    CAST(created_at AS DATE) AS created_date,
    CASE WHEN status = 'active' THEN 1 ELSE 0 END AS is_active_flag,
    CASE WHEN status = 'blocked' THEN 'HIGH' WHEN status = 'inactive' THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
    balance * CASE currency WHEN 'USD' THEN CAST(1.0 AS DOUBLE) WHEN 'EUR' THEN CAST(1.08 AS DOUBLE)
      WHEN 'PKR' THEN CAST(0.0036 AS DOUBLE) END AS balance_usd
  FROM accounts
)"""

TRANSACTIONS = f"""
transactions AS (
  SELECT
    'TX-' || n AS Transaction_ID,
    'ACC-' || o_custkey AS Account_ID,
    CASE WHEN n % 2 = 0 THEN 'CREDIT' ELSE ' DEBIT' END AS Transaction_Type,
    CASE WHEN n % 71 <> 0 THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) END AS Amount,
    CASE WHEN n % 73 = 0 THEN 'USD ' ELSE {CURRENCY} END AS Currency,
    CASE WHEN n % 79 <> 0 THEN date_trunc('day', o_orderdate) + INTERVAL 10 HOUR END AS Transaction_Date,
    'order ' || o_orderpriority AS Description
  FROM (SELECT o_orderkey AS n, * FROM orders)
  WHERE n % 61 <> 0 AND n % 67 <> 0
),
trimmed AS (
  SELECT Transaction_ID, Account_ID, trim(Transaction_Type) AS Transaction_Type, Amount,
    trim(Currency) AS Currency, Transaction_Date AS transaction_ts, Description
  FROM transactions
)"""

BRANCHES = """
branch_versions AS (
  SELECT s_suppkey AS n, s_name, n_name,
    unnest(CASE WHEN s_suppkey % 4 = 0 THEN [0, 1] ELSE [0] END) AS version
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
branch_rows AS (
  SELECT
    'BR-' || n AS branch_id,
    s_name AS branch_name,
    '1- High St- Block ' || (n % 8) AS address,
    CASE WHEN version = 1 THEN 'CITY_Z' WHEN n % 9 <> 0 THEN 'CITY_' || (n % 6) END AS city,
    CASE WHEN n % 7 <> 0 THEN n_name END AS country,
    CASE WHEN n % 5 = 0 THEN NULL WHEN n % 6 = 0 THEN 'unknown' ELSE '20' || (10 + n % 10) || '-03-04' END AS opened_on
  FROM branch_versions
  WHERE n % 17 <> 0
),
branches AS (
  SELECT * FROM branch_rows
  QUALIFY row_number() OVER (
    PARTITION BY branch_id
    ORDER BY branch_name DESC NULLS LAST, address DESC NULLS LAST, city DESC NULLS LAST,
      country DESC NULLS LAST, opened_on DESC NULLS LAST
  ) = 1
),
branches_clean AS (
  SELECT *, coalesce(country, 'Unknown') AS country_region,
    CAST(try_strptime(opened_on, '%Y-%m-%d') AS DATE) AS opened_on_clean
  FROM branches
)"""

CUSTOMERS = f"""
customer_versions AS (
  SELECT c_custkey AS n, n_name,
    unnest(CASE WHEN c_custkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS version
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
customers AS (
  SELECT
    'CUST-' || n AS Customer_ID,
    CASE WHEN n % 11 <> 0 THEN 'Customer ' || n END AS Full_Name,
    'c' || n || '@example.org' AS Email,
    '1555000' || n AS Phone,
    n || ' Main St' || CASE n % 3
      WHEN 0 THEN chr(10) || 'Springfield, CA 9' || lpad(CAST(n % 10000 AS VARCHAR), 4, '0')
      WHEN 1 THEN chr(10) || 'PSC 12, Box 3' || chr(10) || 'APO AA 34021'
      ELSE '' END AS Address,
    'CITY_' || (n % 6) AS City,
    n_name AS Country,
    CASE WHEN NOT (version = 1 AND n % 20 = 0) THEN {CREATED} END AS Created_At
  FROM customer_versions
  WHERE n % 37 <> 0
),
latest AS (
  SELECT * FROM customers
  QUALIFY row_number() OVER (
    PARTITION BY Customer_ID ORDER BY Created_At DESC NULLS LAST, Full_Name DESC NULLS LAST
  ) = 1
)"""

EVENTS = """
sent AS (
  SELECT event_id AS n, user_id, value,
    CASE event_type WHEN 'signup' THEN 'customers' WHEN 'view' THEN 'accounts'
      WHEN 'purchase' THEN 'transactions' WHEN 'error' THEN 'transactions'
      WHEN 'click' THEN 'branches' END AS entity
  FROM events
),
visible AS (
  SELECT n, user_id, value, entity, entity || '-topic' AS topic,
    CASE WHEN n % 17 = 0 THEN 'not json' WHEN n % 19 = 0 THEN '[1]'
      WHEN n % 23 = 0 THEN '{"account_id":"x","zzz":1}'
      WHEN n % 29 = 0 THEN '{"amount":1},{"end-of-body":""}] junk'
      WHEN n % 31 = 0 THEN '5,"end-of-body"] junk'
      WHEN entity = 'customers' THEN '{"CustomerID":"CUST-' || user_id || '"}'
      ELSE '{"account_id":"ACC-' || user_id || '","amount":' || value || '}' END AS body,
    CASE WHEN n % 17 = 0 THEN 'raw' WHEN n % 19 = 0 OR n % 23 = 0 THEN 'reject'
      WHEN n % 29 = 0 OR n % 31 = 0 THEN 'raw' ELSE 'parsed' END AS kind
  FROM sent
  WHERE n % 13 <> 0
),
landed AS (
  SELECT *, CASE WHEN entity IN ('customers', 'transactions') AND kind = 'reject' THEN 'rejects'
    ELSE entity END AS target
  FROM visible
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _raw_table(entity: str, columns: list[str]) -> str:
    nulls = ", ".join(f"{NO_MEASURE} AS {name}" for name in columns)
    return _with(EVENTS, f"SELECT {nulls}, body AS raw_data FROM landed WHERE target = '{entity}'")


STATUS_LOOKUP = """(VALUES ('active', 'Account is active and usable'),
  ('inactive', 'Account exists but disabled'), ('blocked', 'Account is restricted/flagged'))
  AS lookup(status, status_meaning)"""

DIM_CUSTOMER = """
SELECT Customer_ID, Full_Name, Email, City, Country, Phone AS Phone_Number,
  split_part(Address, chr(10), 1) AS Address_Line1,
  CASE WHEN contains(Address, chr(10)) THEN split_part(Address, chr(10), 2) END AS Address_Line2,
  CASE WHEN NOT contains(Address, chr(10)) THEN NULL WHEN Address LIKE '%, CA 9%' THEN 'CA' ELSE '' END AS State,
  CASE WHEN NOT contains(Address, chr(10)) THEN NULL WHEN Address LIKE '%, CA 9%' THEN right(Address, 5)
    ELSE '' END AS Postal_Code,
  TIMESTAMP '2026-01-01 00:00:00' AS record_created_date,
  TRUE AS is_active,
  'core_banking_system' AS source_system
FROM latest"""

def _exact_sum(value: str) -> str:
    """Sum of doubles that are whole multiples of 2**-60, in any order, then one rounding of its two halves."""
    total = f"sum(CAST({value} * 1152921504606846976.0 AS HUGEINT))"
    unit = "CAST(1152921504606846976 AS HUGEINT)"
    return (
        f"sign({total}) * (CAST(abs({total}) // {unit} AS DOUBLE) + CAST(abs({total}) % {unit} AS DOUBLE) / 1152921504606846976.0)"
    )


TOTALS = {
    "currency_balance": f"SELECT currency, {_exact_sum('balance')} AS total_balance FROM accounts GROUP BY currency",
    "status_counts": "SELECT status, count(*) AS total_accounts FROM accounts GROUP BY status",
    "avg_balance_type": f"SELECT account_type, {_exact_sum('balance')} / count(balance) AS average_balance FROM accounts GROUP BY account_type",
    "daily_openings": "SELECT CAST(created_at AS DATE) AS date, count(*) AS accounts_created FROM accounts GROUP BY 1",
}

COUNTRY = """
SELECT country_region, count(*) AS total_branches,
  avg(CAST(date_diff('day', opened_on_clean, DATE '2026-01-01') AS INTEGER)) AS avg_branch_age_days
FROM branches_clean GROUP BY country_region"""

CITY = "SELECT city, count(*) AS branches_in_city FROM branches GROUP BY city"

DAILY = """
SELECT CAST(transaction_ts AS DATE) AS transaction_date, sum(Amount) AS total_amount_per_day,
  count(*) AS transactions_per_day
FROM trimmed GROUP BY 1"""

TRIPLES = "SELECT DISTINCT Account_ID, Transaction_Type, Currency FROM trimmed"

METRICS = f"""
SELECT * FROM ({TOTALS["currency_balance"]}) CROSS JOIN ({TOTALS["status_counts"]})
  CROSS JOIN ({TOTALS["avg_balance_type"]}) CROSS JOIN ({TOTALS["daily_openings"]})"""

STAR = """
SELECT t.Transaction_ID, t.Account_ID, t.Transaction_Type, t.Amount, t.Currency, t.transaction_ts,
  a.customer_id, a.account_type, a.status AS account_status, a.risk_level,
  c.Full_Name, c.City, c.Country
FROM trimmed t
LEFT JOIN accounts_enriched a ON t.Account_ID = a.account_id
LEFT JOIN latest c ON a.customer_id = c.Customer_ID"""

DIM_ACCOUNT = "SELECT account_id, customer_id, account_type, currency, created_at, status, risk_level FROM accounts_enriched"
DIM_BRANCH = "SELECT branch_id, branch_name, address, city, country_region, opened_on_clean FROM branches_clean"
DIM_TRANSACTION = "SELECT Transaction_ID, Account_ID, Transaction_Type, Currency, Description, transaction_ts FROM trimmed"


def _by(key: str, suffix: str) -> str:
    return f"""SELECT {key}, sum(Amount) AS total_amount{suffix}, avg(Amount) AS avg_amount{suffix},
          count(*) AS num_transactions{suffix} FROM trimmed GROUP BY {key}"""


# The sixteen gold tables after a full refresh, and their columns, those of doubles marked.
REFRESH = {
    "dim_customer": (
        DIM_CUSTOMER,
        "Address_Line1 Address_Line2 City Country Customer_ID Email Full_Name is_active Phone_Number Postal_Code "
        "record_created_date source_system State",
    ),
    "dim_account": (DIM_ACCOUNT, "account_id account_type created_at currency customer_id risk_level status"),
    "dim_branch": (DIM_BRANCH, "address branch_id branch_name city country_region opened_on_clean"),
    "dim_transaction": (DIM_TRANSACTION, "Account_ID Currency Description Transaction_ID transaction_ts Transaction_Type"),
    "dim_account_transaction_type": (TRIPLES, "Account_ID Currency Transaction_Type"),
    "currency_balance": (TOTALS["currency_balance"], "currency total_balance:double"),
    "status_counts": (TOTALS["status_counts"], "status total_accounts"),
    "avg_balance_type": (TOTALS["avg_balance_type"], "account_type average_balance:double"),
    "daily_openings": (TOTALS["daily_openings"], "accounts_created date"),
    "fact_account_metrics": (
        METRICS,
        "account_type accounts_created average_balance:double currency date status total_accounts total_balance:double",
    ),
    "fact_branch_country": (COUNTRY, "avg_branch_age_days:double country_region total_branches"),
    "fact_branch_city": (CITY, "branches_in_city city"),
    "fact_transaction_account": (_by("Account_ID", ""), "Account_ID avg_amount:double num_transactions total_amount:double"),
    "fact_transaction_type": (
        _by("Transaction_Type", "_by_type"),
        "avg_amount_by_type:double num_transactions_by_type total_amount_by_type:double Transaction_Type",
    ),
    "fact_transaction_currency": (
        _by("Currency", "_by_currency"),
        "avg_amount_by_currency:double Currency num_transactions_by_currency total_amount_by_currency:double",
    ),
    "fact_transaction_daily": (DAILY, "total_amount_per_day:double transaction_date transactions_per_day"),
}


def _contents(name: str) -> str:
    """Rows of a table and the sum of a part of the MD5 of each."""
    select, columns = REFRESH[name]
    kinds = [c.partition(":") for c in columns.split()]
    texts = [f"CAST({c} AS DECIMAL(38,3))" if kind else c for c, _, kind in kinds]
    row = "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({t} AS VARCHAR), '~')" for t in texts) + "))"
    number = f"CAST('0x' || substr({row}, 1, 12) AS BIGINT)"
    return (
        f"SELECT '{name}' AS gold_table, count(*) AS table_rows, CAST(sum({number}) % 1000000000000000000 AS BIGINT) AS contents "
        f"FROM ({select})"
    )


# Second versions of every twentieth transaction; every other one of them has no date, and loses.
UPDATES = TRANSACTIONS.replace(
    "FROM (SELECT o_orderkey AS n, * FROM orders)",
    """FROM (
    SELECT n, o_custkey, o_totalprice + 5 * version AS o_totalprice, o_orderdate + to_days(version) AS o_orderdate,
      CASE WHEN version = 1 THEN '0-UPDATED' ELSE o_orderpriority END AS o_orderpriority, version
    FROM (SELECT o_orderkey AS n, *, unnest(CASE WHEN o_orderkey % 20 = 0 THEN [0, 1] ELSE [0] END) AS version FROM orders)
  )""",
).replace("WHEN n % 79 <> 0 THEN date_trunc", "WHEN n % 79 <> 0 AND NOT (version = 1 AND n % 40 = 0) THEN date_trunc").replace(
    "WHERE n % 61 <> 0 AND n % 67 <> 0",
    """WHERE n % 61 <> 0 AND n % 67 <> 0
  QUALIFY row_number() OVER (
    PARTITION BY n ORDER BY Transaction_Date DESC NULLS LAST, Amount DESC NULLS LAST, Currency DESC, Description DESC
  ) = 1""",
)


def _stack(parts: dict[str, tuple[str, dict[str, str]]], columns: dict[str, str]) -> str:
    """Tables one above the other: a FROM clause and the columns that a table has."""
    rows = [
        f"SELECT '{name}' AS gold_table, " + ", ".join(f"CAST({own.get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in columns.items()) + f" FROM {source}"
        for name, (source, own) in parts.items()
    ]
    return "\nUNION ALL ".join(rows)


_MEASURES = {"total_amount": "sum(Amount)", "avg_amount": "avg(Amount)", "num_transactions": "count(*)"}
_KEYS = {"Account_ID": "VARCHAR", "Transaction_Type": "VARCHAR", "Currency": "VARCHAR", "transaction_date": "DATE"}
TRANSACTION_TABLES = _stack(
    {
        "dim_account_transaction_type": (f"({TRIPLES})", {c: c for c in ("Account_ID", "Transaction_Type", "Currency")}),
        "fact_transaction_account": ("trimmed GROUP BY Account_ID", {"Account_ID": "Account_ID", **_MEASURES}),
        "fact_transaction_type": ("trimmed GROUP BY Transaction_Type", {"Transaction_Type": "Transaction_Type", **_MEASURES}),
        "fact_transaction_currency": ("trimmed GROUP BY Currency", {"Currency": "Currency", **_MEASURES}),
        "fact_transaction_daily": (
            "trimmed GROUP BY CAST(transaction_ts AS DATE)",
            {"transaction_date": "CAST(transaction_ts AS DATE)", "total_amount": "sum(Amount)", "num_transactions": "count(*)"},
        ),
    },
    {**_KEYS, **{m: "DOUBLE" for m in _MEASURES}},
)
ACCOUNT_TABLES = _stack(
    {
        "currency_balance": (f"({TOTALS['currency_balance']})", {"currency": "currency", "total_balance": "total_balance"}),
        "status_counts": (f"({TOTALS['status_counts']})", {"status": "status", "accounts": "total_accounts"}),
        "avg_balance_type": (f"({TOTALS['avg_balance_type']})", {"account_type": "account_type", "average_balance": "average_balance"}),
        "daily_openings": (f"({TOTALS['daily_openings']})", {"date": "date", "accounts": "accounts_created"}),
    },
    {
        "currency": "VARCHAR", "status": "VARCHAR", "account_type": "VARCHAR", "date": "DATE",
        "total_balance": "DOUBLE", "average_balance": "DOUBLE", "accounts": "DOUBLE",
    },
)
BRANCH_TABLES = _stack(
    {
        "fact_branch_country": (f"({COUNTRY})", {c: c for c in ("country_region", "total_branches", "avg_branch_age_days")}),
        "fact_branch_city": (f"({CITY})", {"city": "city", "total_branches": "branches_in_city"}),
    },
    {"country_region": "VARCHAR", "city": "VARCHAR", "total_branches": "DOUBLE", "avg_branch_age_days": "DOUBLE"},
)


EXPECTED = {
    # silver
    "silver_customers": _with(CUSTOMERS, "SELECT * FROM customers"),
    "silver_customers_dedup": _with(CUSTOMERS, "SELECT * FROM latest"),
    "silver_transactions": _with(TRANSACTIONS, "SELECT * FROM transactions"),
    "silver_transactions_dedup": _with(TRANSACTIONS, "SELECT * FROM transactions"),
    "silver_accounts": _with(ACCOUNTS, "SELECT * FROM accounts"),
    "silver_branches": _with(BRANCHES, "SELECT * FROM branches"),
    "account_json_flag": _with(
        ACCOUNTS,
        "SELECT n % 43 <> 0 AS is_json, count(*) AS bodies FROM account_versions GROUP BY 1",
    ),
    # gold dimensions
    "customer_latest": _with(CUSTOMERS, "SELECT * FROM latest"),
    "dim_customer": _with(CUSTOMERS, DIM_CUSTOMER),
    "dim_account": _with(ACCOUNTS, DIM_ACCOUNT),
    "dim_branch": _with(BRANCHES, DIM_BRANCH),
    "dim_transaction": _with(TRANSACTIONS, DIM_TRANSACTION),
    "dim_account_transaction_type": _with(TRANSACTIONS, TRIPLES),
    "account_enriched": _with(ACCOUNTS, "SELECT * FROM accounts_enriched"),
    "account_status_lookup": _with(
        ACCOUNTS,
        f"SELECT account_id, accounts.status, status_meaning FROM accounts LEFT JOIN {STATUS_LOOKUP} USING (status)",
    ),
    # gold facts
    **{name: _with(ACCOUNTS, sql) for name, sql in TOTALS.items()},
    "fact_account_metrics": _with(ACCOUNTS, METRICS),
    "fact_branch_country": _with(BRANCHES, COUNTRY),
    "fact_branch_city": _with(BRANCHES, CITY),
    "fact_transaction_account": _with(TRANSACTIONS, _by("Account_ID", "")),
    "fact_transaction_type": _with(TRANSACTIONS, _by("Transaction_Type", "_by_type")),
    "fact_transaction_currency": _with(TRANSACTIONS, _by("Currency", "_by_currency")),
    "fact_transaction_daily": _with(TRANSACTIONS, DAILY),
    "transaction_tables": _with(TRANSACTIONS, TRANSACTION_TABLES),
    "star_transactions": _with(f"{ACCOUNTS.strip()},{TRANSACTIONS},{CUSTOMERS}", STAR),
    "star_bucketed": _with(f"{ACCOUNTS.strip()},{TRANSACTIONS},{CUSTOMERS}", STAR),
    "star_of_high_risk": _with(f"{ACCOUNTS.strip()},{TRANSACTIONS},{CUSTOMERS}", f"{STAR} WHERE a.risk_level = 'HIGH'"),
    "preview_transactions": _with(
        TRANSACTIONS,
        """SELECT Transaction_ID, Account_ID, Transaction_Type, Currency, Description, transaction_ts
           FROM trimmed ORDER BY Transaction_ID LIMIT 10""",
    ),
    # ingest
    "ingest_nonblank": _with(EVENTS, "SELECT topic, body FROM visible"),
    "ingest_customers": _with(
        EVENTS,
        f"""
        SELECT CASE WHEN kind = 'parsed' THEN 'CUST-' || user_id END AS CustomerID,
          {NO_MEASURE} AS FirstName, {NO_MEASURE} AS LastName, {NO_MEASURE} AS Email,
          {NO_MEASURE} AS Phone, {NO_MEASURE} AS Address, {NO_MEASURE} AS City,
          {NO_MEASURE} AS Country, {NO_MEASURE} AS CreatedAt,
          CASE WHEN kind = 'raw' THEN body END AS raw_data
        FROM landed WHERE target = 'customers'""",
    ),
    "ingest_transactions": _with(
        EVENTS,
        f"""
        SELECT {NO_MEASURE} AS transaction_id,
          CASE WHEN kind = 'parsed' THEN 'ACC-' || user_id END AS account_id,
          {NO_MEASURE} AS transaction_type,
          CASE WHEN kind = 'parsed' THEN CAST(value AS VARCHAR) END AS amount,
          {NO_MEASURE} AS currency, {NO_MEASURE} AS transaction_date, {NO_MEASURE} AS description,
          CASE WHEN kind = 'raw' THEN body END AS raw_data
        FROM landed WHERE target = 'transactions'""",
    ),
    "ingest_accounts": _raw_table(
        "accounts",
        ["account_id", "customer_id", "account_type", "balance", "currency", "created_at", "status"],
    ),
    "ingest_branches": _raw_table(
        "branches",
        ["branch_id", "branch_name", "address", "city", "country", "phone", "manager_name"],
    ),
    "ingest_rejects": _with(
        EVENTS, "SELECT topic, body AS raw_data FROM landed WHERE target = 'rejects'"
    ),
    "stream_route_counts": _with(
        EVENTS, "SELECT target, count(*) AS events FROM landed GROUP BY target"
    ),
    "parquet_payloads": _with(
        TRANSACTIONS,
        f"""
        SELECT CASE WHEN n % 61 <> 0 THEN 'TX-' || n END AS transaction_id,
          'ACC-' || o_custkey AS account_id,
          CASE WHEN n % 2 = 0 THEN 'credit' ELSE ' debit' END AS transaction_type,
          CASE WHEN n % 71 <> 0 THEN CAST(o_totalprice AS DOUBLE) END AS amount,
          CASE WHEN n % 73 = 0 THEN 'USD ' ELSE {CURRENCY} END AS currency,
          CASE WHEN n % 79 = 0 THEN 'bad-date' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 10:00:00' END AS transaction_date,
          'order ' || o_orderpriority AS description, {NO_MEASURE} AS raw_text
        FROM (SELECT o_orderkey AS n, * FROM orders) WHERE n % 67 <> 0
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'order ' || o_orderpriority
        FROM orders WHERE o_orderkey % 67 = 0""",
    ),
    # whole refresh
    "run_all": _with(
        f"{ACCOUNTS.strip()},{TRANSACTIONS},{BRANCHES},{CUSTOMERS}", "\nUNION ALL ".join(map(_contents, REFRESH))
    ),
    "run_all_dedup": _with(
        f"{ACCOUNTS.strip()},{UPDATES},{BRANCHES},{CUSTOMERS}", "\nUNION ALL ".join(map(_contents, REFRESH))
    ),
    "silver_transactions_updates": _with(UPDATES, "SELECT * FROM transactions"),
    # streams that keep tables current
    "customer_latest_stream": _with(CUSTOMERS, "SELECT * FROM latest"),
    "account_latest_stream": _with(ACCOUNTS, "SELECT * FROM accounts"),
    "maintained_account_facts": _with(ACCOUNTS, ACCOUNT_TABLES),
    "maintained_transaction_facts": _with(UPDATES, TRANSACTION_TABLES),
    "maintained_branch_facts": _with(BRANCHES, BRANCH_TABLES),
}

# Landing tables one above the other: columns that a table lacks are NULL there.
LANDED = " UNION ALL BY NAME ".join(
    f"SELECT '{table}' AS target, * FROM ({EXPECTED[f'ingest_{table}']})" for table in ("customers", "accounts", "transactions", "branches")
)
# Bronze is a copy of the landing tables.
EXPECTED["bronze_copy"] = LANDED
EXPECTED["stream_landing_rows"] = f"{LANDED} UNION ALL BY NAME SELECT 'rejects' AS target, * FROM ({EXPECTED['ingest_rejects']})"
# What was sent again lands once.
EXPECTED["stream_dedup"] = EXPECTED["stream_landing_rows"]
EXPECTED["stream_landing_once"] = EXPECTED["stream_landing_rows"]
EXPECTED["bronze_by_ledger"] = LANDED
EXPECTED["fact_transaction_daily_by_day"] = EXPECTED["fact_transaction_daily"]
EXPECTED["quality_flags"] = _with(
    f"{ACCOUNTS.strip()},{BRANCHES},{CUSTOMERS}",
    """
    SELECT 'customers' AS "table", 'CreatedAt' AS "column", count(*) AS malformed
      FROM customer_versions WHERE n % 37 <> 0 AND version = 1 AND n % 20 = 0
    UNION ALL SELECT 'transactions', 'amount', count(*) FROM orders
      WHERE o_orderkey % 61 <> 0 AND o_orderkey % 67 <> 0 AND o_orderkey % 71 = 0
    UNION ALL SELECT 'transactions', 'transaction_date', count(*) FROM orders
      WHERE o_orderkey % 61 <> 0 AND o_orderkey % 67 <> 0 AND o_orderkey % 79 = 0
    UNION ALL SELECT 'accounts', 'created_at', count(*) FROM account_versions WHERE n % 43 <> 0 AND n % 82 <> 0 AND n % 59 = 0
    UNION ALL SELECT 'branches', 'opened_on', count(*) FROM branch_versions WHERE n % 17 <> 0 AND n % 5 <> 0 AND n % 6 = 0""",
)
