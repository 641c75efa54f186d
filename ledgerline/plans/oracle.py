"""Independent DuckDB SQL for every registered query.

The SQL is written from the operator definitions (the reference's own
T-SQL shapes where it has them), not generated from the Spark plans. The
test-table mapping of ``plans.adapter`` is restated here as CTEs; the
fixed scenario values are repeated literally.
"""

from __future__ import annotations

# Fixed values of the test scenario (same as plans.adapter).
EPOCH = "TIMESTAMP '1995-01-01 00:00:00'"
PREV_RUN_END = "TIMESTAMP '2000-01-01 00:00:00'"
BATCH_TS = "TIMESTAMP '2002-01-01 00:00:00'"
CORE_LOADED_AT = "TIMESTAMP '2000-01-01 00:00:00'"


def _audited(name: str, select_sql: str, key: str, created: str) -> str:
    return f"""{name}_src AS (
  SELECT *, CASE WHEN {key} % 5 = 0
                 THEN dtmcrt + to_days(CAST({key} % 900 + 1 AS INTEGER)) END AS dtmupd
  FROM (SELECT *, CAST({created} AS TIMESTAMP) AS dtmcrt FROM ({select_sql}) q_{name}) a_{name})"""


def _key_day(key: str) -> str:
    return f"{EPOCH} + to_days(CAST({key} % 2400 AS INTEGER))"


SRC_CTES = ",\n".join([
    _audited("customer", """
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS address,
           CAST(c_nationkey AS BIGINT) AS city_id,
           CAST(18 + c_custkey % 60 AS INTEGER) AS age,
           CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
           'customer' || CAST(c_custkey AS VARCHAR) || '@bank.test' AS email
    FROM customer""", "customer_id", _key_day("customer_id")),
    _audited("city", """
    SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name,
           CAST(n_regionkey AS BIGINT) AS state_id FROM nation""",
             "city_id", _key_day("city_id")),
    _audited("state", """
    SELECT CAST(r_regionkey AS BIGINT) AS state_id, r_name AS state_name FROM region""",
             "state_id", _key_day("state_id")),
    _audited("branch", """
    SELECT s_suppkey AS branch_id, s_name AS branch_name, n_name AS branch_location
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
             "branch_id", _key_day("branch_id")),
    _audited("account", """
    SELECT o_orderkey AS account_id, o_custkey AS customer_id, o_orderstatus AS account_type,
           o_totalprice AS balance, o_orderdate AS date_opened, o_orderpriority AS status
    FROM orders""", "account_id", "date_opened"),
    _audited("transaction", """
    SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_orderkey AS account_id,
           l_shipdate AS transaction_date, l_extendedprice AS amount,
           CASE l_returnflag WHEN 'A' THEN 'Deposit' WHEN 'N' THEN 'Withdrawal'
                             WHEN 'R' THEN 'Payment' END AS transaction_type,
           l_suppkey AS branch_id
    FROM lineitem""", "transaction_id", "transaction_date"),
])

TABLES = ("customer", "city", "state", "branch", "account", "transaction")


def _raw(name: str) -> str:
    return f"""{name}_raw AS (
  SELECT * EXCLUDE (dtmupd),
         CAST(date_trunc('day', COALESCE(dtmupd, dtmcrt)) AS TIMESTAMP) + INTERVAL 1 DAY AS dtmload
  FROM {name}_src)"""


def _staged_before(name: str) -> str:
    return f"""{name}_stg AS (
  SELECT * EXCLUDE (dtmupd),
         CAST(date_trunc('month', dtmcrt) AS TIMESTAMP) + INTERVAL 1 MONTH AS dtmload
  FROM {name}_src WHERE dtmcrt < {PREV_RUN_END})"""


RAW_CTES = ",\n".join(_raw(t) for t in TABLES)
STG_CTES = ",\n".join(_staged_before(t) for t in TABLES)

# value columns of each raw table, in the order the adapter produces them
VALUE_COLS = {
    "customer": ("customer_name", "address", "city_id", "age", "gender", "email"),
    "city": ("city_name", "state_id"),
    "state": ("state_name",),
    "branch": ("branch_name", "branch_location"),
    "account": ("customer_id", "account_type", "balance", "date_opened", "status"),
    "transaction": ("account_id", "transaction_date", "amount", "transaction_type",
                    "branch_id"),
}
KEYS = {t: f"{t}_id" for t in TABLES}


def staged_order(table: str) -> str:
    cols = ["dtmload", "dtmcrt", *VALUE_COLS[table]]
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def latest_cte(name: str, source: str, table: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, row_number() OVER (PARTITION BY {KEYS[table]} ORDER BY {staged_order(table)}) AS rn_
    FROM {source} WHERE {KEYS[table]} IS NOT NULL) WHERE rn_ = 1)"""


DIM_DATE_CTE = """bounds AS (
  SELECT min(lo) AS lo, max(hi) AS hi FROM (
    SELECT min(CAST(date_opened AS DATE)) AS lo, max(CAST(date_opened AS DATE)) AS hi FROM account_raw
    UNION ALL
    SELECT min(CAST(transaction_date AS DATE)), max(CAST(transaction_date AS DATE)) FROM transaction_raw)),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS DateID,
         d AS FullDate, CAST(day(d) AS INTEGER) AS Day, CAST(month(d) AS INTEGER) AS Month,
         CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS Quarter,
         CAST(weekofyear(d) AS INTEGER) AS WeekOfYear,
         CAST(dayofweek(d) + 1 AS INTEGER) AS DayOfWeek,
         dayofweek(d) IN (0, 6) AS IsWeekend
  FROM days)"""


def core_ctes(batch: str = BATCH_TS, suffix: str = "") -> str:
    """First load of the core from the raw tables (dims, fact)."""
    s = suffix
    return f"""{latest_cte('cust_l' + s, 'customer_raw', 'customer')},
{latest_cte('city_l' + s, 'city_raw', 'city')},
{latest_cte('state_l' + s, 'state_raw', 'state')},
{latest_cte('branch_l' + s, 'branch_raw', 'branch')},
{latest_cte('account_l' + s, 'account_raw', 'account')},
dim_customer{s} AS (
  SELECT c.customer_id AS CustomerID, upper(c.customer_name) AS CustomerName,
         upper(c.address) AS Address, upper(ci.city_name) AS CityName,
         upper(st.state_name) AS StateName, c.age AS Age, upper(c.gender) AS Gender,
         c.email AS Email, {batch} AS dtmload, CAST(NULL AS TIMESTAMP) AS dtmupd
  FROM cust_l{s} c LEFT JOIN city_l{s} ci ON c.city_id = ci.city_id
       LEFT JOIN state_l{s} st ON ci.state_id = st.state_id
  WHERE ci.city_name IS NOT NULL AND st.state_name IS NOT NULL),
dim_branch{s} AS (
  SELECT branch_id AS BranchID, upper(branch_name) AS BranchName,
         upper(branch_location) AS BranchLocation, {batch} AS dtmload,
         CAST(NULL AS TIMESTAMP) AS dtmupd
  FROM branch_l{s}),
dim_account{s} AS (
  SELECT a.account_id AS AccountID, a.customer_id AS CustomerID,
         upper(a.account_type) AS AccountType, CAST(a.balance AS DECIMAL(18,2)) AS Balance,
         d.DateID AS DateOpenedID, upper(a.status) AS Status, {batch} AS dtmload,
         CAST(NULL AS TIMESTAMP) AS dtmupd
  FROM account_l{s} a JOIN dim_date d ON CAST(a.date_opened AS DATE) = d.FullDate),
fact_ranked{s} AS (
  SELECT t.*, d.DateID AS TransactionDateID,
         row_number() OVER (PARTITION BY t.transaction_id
                            ORDER BY t.transaction_date DESC NULLS LAST, t.amount DESC NULLS LAST,
                                     t.branch_id ASC NULLS FIRST,
                                     t.transaction_type ASC NULLS FIRST) AS rn
  FROM transaction_raw t
  JOIN dim_account{s} a ON t.account_id = a.AccountID
  JOIN dim_branch{s} b ON t.branch_id = b.BranchID
  JOIN dim_date d ON CAST(t.transaction_date AS DATE) = d.FullDate
  WHERE t.transaction_id IS NOT NULL),
fact{s} AS (
  SELECT transaction_id AS TransactionID, account_id AS AccountID, TransactionDateID,
         CAST(amount AS DECIMAL(18,2)) AS Amount, upper(transaction_type) AS TransactionType,
         branch_id AS BranchID, {batch} AS dtmload, CAST(NULL AS TIMESTAMP) AS dtmupd
  FROM fact_ranked{s} WHERE rn = 1)"""


EXISTING_CTES = f"""{core_ctes(CORE_LOADED_AT, '_old')},
ex_customer AS (
  SELECT * REPLACE ('UNKNOWN' AS Address, 'UNKNOWN' AS Email)
  FROM dim_customer_old WHERE CustomerID % 3 = 0),
ex_branch AS (
  SELECT * REPLACE ('UNKNOWN' AS BranchLocation) FROM dim_branch_old WHERE BranchID % 3 = 0),
ex_account AS (
  SELECT * REPLACE ('UNKNOWN' AS Status, CAST(0 AS DECIMAL(18,2)) AS Balance)
  FROM dim_account_old WHERE AccountID % 3 = 0),
ex_fact AS (
  SELECT * REPLACE ('UNKNOWN' AS TransactionType, CAST(0 AS DECIMAL(18,2)) AS Amount)
  FROM fact_old WHERE TransactionID % 3 = 0)"""


def with_core(select_sql: str, existing: bool = False) -> str:
    parts = [SRC_CTES, RAW_CTES, DIM_DATE_CTE, core_ctes()]
    if existing:
        parts.append(EXISTING_CTES)
    return "WITH " + ",\n".join(parts) + "\n" + select_sql


def with_src(select_sql: str, *extra: str) -> str:
    return "WITH " + ",\n".join([SRC_CTES, RAW_CTES, STG_CTES, *extra]) + "\n" + select_sql


SQL: dict[str, str] = {}

SQL["dim_date"] = with_core("SELECT * FROM dim_date")
SQL["dim_customer"] = with_core("SELECT * FROM dim_customer")
SQL["dim_branch"] = with_core("SELECT * FROM dim_branch")
SQL["dim_account"] = with_core("SELECT * FROM dim_account")
SQL["fact_transaction"] = with_core("SELECT * FROM fact")

SQL["customer_mart"] = with_core("""
SELECT c.CustomerID, c.CustomerName, a.AccountID, a.AccountType,
       a.Balance AS BaseBalance,
       CAST(a.Balance + COALESCE(SUM(CASE WHEN upper(rtrim(f.TransactionType)) = 'DEPOSIT'
                                          THEN COALESCE(f.Amount, 0)
                                          ELSE COALESCE(-f.Amount, 0) END), 0)
            AS DECIMAL(18,2)) AS CurrentBalance
FROM dim_customer c
JOIN dim_account a ON c.CustomerID = a.CustomerID
LEFT JOIN fact f ON a.AccountID = f.AccountID
GROUP BY c.CustomerID, c.CustomerName, a.AccountID, a.AccountType, a.Balance""")

SQL["daily_summary"] = with_core("""
SELECT d.FullDate AS TransactionDate, COUNT(f.TransactionID) AS TotalTransactions,
       CAST(COALESCE(SUM(f.Amount), 0) AS DECIMAL(18,2)) AS TotalTransactionAmount
FROM fact f JOIN dim_date d ON f.TransactionDateID = d.DateID
GROUP BY d.FullDate""")

# --- merge family ------------------------------------------------------------------

SQL["new_keys_customer"] = with_core(
    "SELECT * FROM dim_customer WHERE CustomerID NOT IN (SELECT CustomerID FROM ex_customer)",
    existing=True)
SQL["new_keys_branch"] = with_core(
    "SELECT * FROM dim_branch WHERE BranchID NOT IN (SELECT BranchID FROM ex_branch)",
    existing=True)
SQL["new_keys_account"] = with_core(
    "SELECT * FROM dim_account WHERE AccountID NOT IN (SELECT AccountID FROM ex_account)",
    existing=True)
SQL["new_keys_fact"] = with_core(
    "SELECT * FROM fact WHERE TransactionID NOT IN (SELECT TransactionID FROM ex_fact)",
    existing=True)


def _mark_of(table: str) -> str:
    return (f"(SELECT COALESCE(CAST(strftime(max(dtmload), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP), "
            f"TIMESTAMP '1900-01-01 00:00:00') FROM {table})")


def _changes(name: str, raw: str, table: str, target: str) -> str:
    return latest_cte(name, f"(SELECT * FROM {raw} WHERE dtmload > {_mark_of(target)})", table)


def _merge_select(target: str, key: str, change: str, ckey: str, sets: dict, cols: list) -> str:
    out = []
    for c in cols:
        if c in sets:
            out.append(f"CASE WHEN ch.{ckey} IS NOT NULL THEN {sets[c]} ELSE t.{c} END AS {c}")
        elif c == "dtmupd":
            out.append(f"CASE WHEN ch.{ckey} IS NOT NULL THEN {BATCH_TS} ELSE t.dtmupd END AS dtmupd")
        else:
            out.append(f"t.{c}")
    return (f"SELECT {', '.join(out)} FROM {target} t "
            f"LEFT JOIN {change} ch ON t.{key} = ch.{ckey}")


_CUST_COLS = ["CustomerID", "CustomerName", "Address", "CityName", "StateName", "Age",
              "Gender", "Email", "dtmload", "dtmupd"]
SQL["merge_type1_customer"] = with_core(",\n" + _changes(
    "cust_ch0", "customer_raw", "customer", "ex_customer") + """,
cust_ch AS (
  SELECT c.customer_id, upper(c.customer_name) AS CustomerName, upper(c.address) AS Address,
         upper(ci.city_name) AS CityName, upper(st.state_name) AS StateName, c.age AS Age,
         upper(c.gender) AS Gender, c.email AS Email
  FROM cust_ch0 c LEFT JOIN city_l ci ON c.city_id = ci.city_id
       LEFT JOIN state_l st ON ci.state_id = st.state_id)
""" + _merge_select("ex_customer", "CustomerID", "cust_ch", "customer_id",
                    {c: f"ch.{c}" for c in _CUST_COLS[1:8]}, _CUST_COLS),
    existing=True)

SQL["merge_type1_branch"] = with_core(",\n" + _changes(
    "branch_ch", "branch_raw", "branch", "ex_branch") + "\n" + _merge_select(
    "ex_branch", "BranchID", "branch_ch", "branch_id",
    {"BranchName": "upper(ch.branch_name)", "BranchLocation": "upper(ch.branch_location)"},
    ["BranchID", "BranchName", "BranchLocation", "dtmload", "dtmupd"]), existing=True)

SQL["merge_type1_account"] = with_core(",\n" + _changes(
    "account_ch", "account_raw", "account", "ex_account") + "\n" + _merge_select(
    "ex_account", "AccountID", "account_ch", "account_id",
    {"AccountType": "upper(ch.account_type)",
     "Balance": "CAST(ch.balance AS DECIMAL(18,2))", "Status": "upper(ch.status)"},
    ["AccountID", "CustomerID", "AccountType", "Balance", "DateOpenedID", "Status",
     "dtmload", "dtmupd"]), existing=True)

SQL["merge_type1_fact"] = with_core(",\n" + _changes(
    "txn_ch", "transaction_raw", "transaction", "ex_fact") + "\n" + _merge_select(
    "ex_fact", "TransactionID", "txn_ch", "transaction_id",
    {"Amount": "CAST(ch.amount AS DECIMAL(18,2))",
     "TransactionType": "upper(ch.transaction_type)"},
    ["TransactionID", "AccountID", "TransactionDateID", "Amount", "TransactionType",
     "BranchID", "dtmload", "dtmupd"]), existing=True)

SQL["latest_per_key"] = with_core("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY transaction_date DESC NULLS LAST, amount DESC NULLS LAST,
                                        branch_id ASC NULLS FIRST,
                                        transaction_type ASC NULLS FIRST) AS rn
  FROM transaction_raw) WHERE rn = 1""")

SQL["dedup_by_key"] = with_core(",\n" + latest_cte("txn_l", "transaction_raw", "transaction")
                                + "\nSELECT * FROM txn_l")

SQL["core_run"] = with_core("""
SELECT 'DimCustomer' AS table_name, 'inserted' AS action, count(*) AS n_rows
  FROM dim_customer WHERE CustomerID NOT IN (SELECT CustomerID FROM ex_customer)
UNION ALL SELECT 'DimBranch', 'inserted', count(*)
  FROM dim_branch WHERE BranchID NOT IN (SELECT BranchID FROM ex_branch)
UNION ALL SELECT 'DimAccount', 'inserted', count(*)
  FROM dim_account WHERE AccountID NOT IN (SELECT AccountID FROM ex_account)
UNION ALL SELECT 'FactTransaction', 'inserted', count(*)
  FROM fact WHERE TransactionID NOT IN (SELECT TransactionID FROM ex_fact)
UNION ALL SELECT 'DimCustomer', 'updated', count(*) FROM dim_customer t WHERE EXISTS (
  SELECT 1 FROM customer_raw c WHERE c.customer_id = t.CustomerID
    AND c.dtmload > """ + _mark_of("ex_customer") + """)
UNION ALL SELECT 'DimBranch', 'updated', count(*) FROM dim_branch t WHERE EXISTS (
  SELECT 1 FROM branch_raw c WHERE c.branch_id = t.BranchID
    AND c.dtmload > """ + _mark_of("ex_branch") + """)
UNION ALL SELECT 'DimAccount', 'updated', count(*) FROM dim_account t WHERE EXISTS (
  SELECT 1 FROM account_raw c WHERE c.account_id = t.AccountID
    AND c.dtmload > """ + _mark_of("ex_account") + """)
UNION ALL SELECT 'FactTransaction', 'updated', count(*) FROM fact t WHERE EXISTS (
  SELECT 1 FROM transaction_raw c WHERE c.transaction_id = t.TransactionID
    AND c.dtmload > """ + _mark_of("ex_fact") + ")", existing=True)

SQL["stage_counts"] = with_core("""
SELECT 'DimDate' AS table_name, count(*) AS n_rows FROM dim_date
UNION ALL SELECT 'DimCustomer', count(*) FROM dim_customer
UNION ALL SELECT 'DimBranch', count(*) FROM dim_branch
UNION ALL SELECT 'DimAccount', count(*) FROM dim_account
UNION ALL SELECT 'FactTransaction', count(*) FROM fact""")

SQL["signed_amount"] = with_core("""
SELECT TransactionID, TransactionType, Amount,
       CASE WHEN upper(rtrim(TransactionType)) = 'DEPOSIT' THEN COALESCE(Amount, 0)
            ELSE COALESCE(-Amount, 0) END AS SignedAmount
FROM fact""")

SQL["balance_per_customer"] = (
    SQL["customer_mart"].replace("\nSELECT c.CustomerID", "\nSELECT * FROM (SELECT c.CustomerID", 1)
    + ") WHERE upper(CustomerName) = upper('Customer#000000007')")

SQL["daily_summary_range"] = (
    SQL["daily_summary"].replace("\nSELECT d.FullDate", "\nSELECT * FROM (SELECT d.FullDate", 1)
    + ") WHERE TransactionDate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")

# --- staging family ---------------------------------------------------------------

_SPEC_COLS = {
    "customer": "customer_id, customer_name, address, city_id, age, gender, email, dtmcrt",
    "city": "city_id, city_name, state_id, dtmcrt",
    "account": "account_id, customer_id, account_type, balance, date_opened, status, dtmcrt",
    "branch": "branch_id, branch_name, branch_location, dtmcrt",
    "state": "state_id, state_name, dtmcrt",
    "transaction": ("transaction_id, account_id, transaction_date, amount, transaction_type, "
                    "branch_id, dtmcrt"),
}


def _extract(t: str, pred: str | None = None) -> str:
    m = _mark_of(f"{t}_stg")
    pred = pred or f"(dtmcrt > {m} OR COALESCE(dtmupd, TIMESTAMP '1900-01-01') > {m})"
    return f"SELECT {_SPEC_COLS[t]}, {BATCH_TS} AS dtmload FROM {t}_src WHERE {pred}"


def _purged(t: str) -> str:
    return (f"SELECT {_SPEC_COLS[t]}, dtmload FROM {t}_stg s WHERE NOT EXISTS ("
            f"SELECT 1 FROM {t}_src src WHERE src.{t}_id = s.{t}_id AND src.dtmupd > s.dtmload)")


SQL["scan_project"] = with_src(f"SELECT {_SPEC_COLS['customer']} FROM customer_src")
SQL["high_water_mark"] = with_src("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, COALESCE(strftime(max(dtmload), '%Y-%m-%d %H:%M:%S'), "
    f"'1900-01-01 00:00:00') AS mark FROM {t}_stg" for t in
    ("customer", "city", "account", "branch", "state", "transaction")))
SQL["incremental_extract"] = with_src(_extract("transaction"))
SQL["incremental_create_only"] = with_src(
    _extract("account", f"dtmcrt > {_mark_of('account_stg')}"))
SQL["incremental_by_day"] = with_src(_extract(
    "customer",
    "(strftime(dtmcrt, '%Y%m%d') > strftime(" + _mark_of("customer_stg") + ", '%Y%m%d') OR "
    "strftime(COALESCE(dtmupd, TIMESTAMP '1900-01-01'), '%Y%m%d') > strftime("
    + _mark_of("customer_stg") + ", '%Y%m%d'))"))
SQL["staging_purge"] = with_src(
    "SELECT * FROM transaction_stg s WHERE NOT EXISTS (SELECT 1 FROM transaction_src src "
    "WHERE src.transaction_id = s.transaction_id AND src.dtmupd > s.dtmload)")
SQL["staging_upsert"] = with_src(_purged("account") + "\nUNION ALL\n" + _extract("account"))
SQL["append_staging"] = with_src(
    f"SELECT {_SPEC_COLS['transaction']}, dtmload FROM transaction_stg\nUNION ALL\n"
    + _extract("transaction"))
for _t in ("customer", "city", "account", "branch", "state", "transaction"):
    SQL[f"staging_load_{_t}"] = with_src(_purged(_t) + "\nUNION ALL\n" + _extract(_t))
SQL["in_list"] = with_src(
    f"SELECT {_SPEC_COLS['customer']} FROM customer_src WHERE customer_id IN (4, 5, 7, 8)")
SQL["sorted_extract"] = with_src(
    _extract("account", f"dtmcrt > {_mark_of('account_stg')}") + " ORDER BY dtmcrt, account_id")

# --- quality -------------------------------------------------------------------------

SQL["pk_violations"] = with_core("""
SELECT transaction_id, count(*) AS n_rows FROM transaction_raw GROUP BY transaction_id
HAVING count(*) > 1 OR transaction_id IS NULL""")

SQL["fk_violations"] = with_core("""
SELECT 'transaction_account' AS constraint_name, CAST(account_id AS BIGINT) AS key_value,
       count(*) AS n_rows
FROM transaction_raw t WHERE account_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM account_raw a WHERE a.account_id = t.account_id)
GROUP BY account_id
UNION ALL
SELECT 'transaction_branch', CAST(branch_id AS BIGINT), count(*)
FROM transaction_raw t WHERE branch_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM branch_raw b WHERE b.branch_id = t.branch_id
                  AND b.branch_id % 10 <> 3)
GROUP BY branch_id
UNION ALL
SELECT 'account_customer', CAST(customer_id AS BIGINT), count(*)
FROM account_raw a WHERE customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer_raw c WHERE c.customer_id = a.customer_id)
GROUP BY customer_id""")

SQL["not_null_violations"] = with_core("\nUNION ALL ".join(
    f"SELECT 'FactTransaction' AS table_name, '{c}' AS column_name, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM fact"
    for c in ("TransactionID", "AccountID", "TransactionDateID", "Amount", "TransactionType",
              "BranchID")))

SQL["length_violations"] = with_core("\nUNION ALL ".join(
    f"SELECT 'account_raw' AS table_name, '{c}' AS column_name, {n} AS max_allowed, "
    f"CAST(sum(CASE WHEN length({c}) > {n} THEN 1 ELSE 0 END) AS BIGINT) AS n_too_long, "
    f"CAST(max(length({c})) AS INTEGER) AS max_length FROM account_raw"
    for c, n in (("account_type", 10), ("status", 10))))

SQL["rejects"] = with_core("""
SELECT reject_reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN t.transaction_id IS NULL THEN 'null_key'
              WHEN a.AccountID IS NULL THEN 'no_account'
              WHEN b.BranchID IS NULL THEN 'no_branch'
              WHEN d.FullDate IS NULL THEN 'no_date' END AS reject_reason
  FROM transaction_raw t
  LEFT JOIN dim_account a ON t.account_id = a.AccountID
  LEFT JOIN (SELECT BranchID FROM dim_branch WHERE BranchID % 10 <> 3) b ON t.branch_id = b.BranchID
  LEFT JOIN dim_date d ON CAST(t.transaction_date AS DATE) = d.FullDate)
WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")

# --- banks -------------------------------------------------------------------------

BANKS_CTE = """banks AS (
  SELECT s_suppkey AS Rank, s_name AS Country, s_acctbal AS MC_USD_Billion FROM supplier),
conv AS (
  SELECT *,
    round_even(MC_USD_Billion * CAST(0.93 AS DOUBLE) * 100, 0) / 100 AS MC_EUR_Billion,
    round_even(MC_USD_Billion * CAST(0.8 AS DOUBLE) * 100, 0) / 100 AS MC_GBP_Billion,
    round_even(MC_USD_Billion * CAST(82.95 AS DOUBLE) * 100, 0) / 100 AS MC_INR_Billion
  FROM banks)
"""


def with_banks(select_sql: str) -> str:
    return "WITH " + BANKS_CTE + select_sql


SQL["fx_convert"] = with_banks("SELECT * FROM conv")
SQL["avg_gbp"] = with_banks("SELECT round(avg(MC_GBP_Billion), 6) AS avg_gbp FROM conv")
SQL["limit5"] = with_banks("SELECT Country FROM conv ORDER BY Rank LIMIT 5")
SQL["select_all"] = with_banks("SELECT * FROM conv")
SQL["adhoc_sql"] = with_banks(
    "SELECT Country, MC_GBP_Billion FROM conv WHERE MC_USD_Billion >= 5000.0")
SQL["replace_table"] = with_banks("SELECT * FROM conv")
SQL["csv_roundtrip"] = with_banks("SELECT * FROM conv")
SQL["drop_last_char"] = """
SELECT s_suppkey AS Rank, printf('%.2f', s_acctbal) AS mc_text,
       substr(printf('%.2f', s_acctbal), 1, length(printf('%.2f', s_acctbal)) - 1) AS mc_trimmed,
       TRY_CAST(substr(printf('%.2f', s_acctbal), 1, length(printf('%.2f', s_acctbal)) - 1)
                AS DOUBLE) AS MC_USD_Billion
FROM supplier"""
SQL["safe_numeric"] = """
SELECT s_suppkey AS key,
       TRY_CAST(CASE WHEN s_suppkey % 7 = 0 THEN 'n/a' ELSE CAST(s_suppkey AS VARCHAR) END
                AS BIGINT) AS Rank,
       TRY_CAST(CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE printf('%.2f', s_acctbal) END
                AS DOUBLE) AS MC_USD_Billion
FROM supplier"""

# --- dates and formats --------------------------------------------------------------

# Text of a line number (transaction_id % 10) by account_id % 3, and the patterns
# that read such a text.
_TEXT_FORMS = {
    1: ("%d-%m-%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S.%gZ", "%Y-%m-%dT%H:%M:%S+05:30"),
    2: ("%Y-%m-%d", "%Y-%b-%d", "%Y/%m/%d %H:%M:%S.%g"),
    3: ("%d/%m/%Y", "%a, %d %b %Y", "%d.%m.%Y %H:%M"),
    4: ("%Y%m%d", "%Y%m%d%H%M%S", "%Y%m%dT%H%M"),
    5: ("%d-%b-%Y", "%B %-d, %Y", "%d-%B-%Y %I:%M %p"),
    6: ("%-d/%-m/%y", "%-d %b %Y", "%A %-d %B %Y"),
}


def _text_case() -> str:
    lines = []
    for n, forms in _TEXT_FORMS.items():
        of = [f"strftime(transaction_date{' + INTERVAL 330 MINUTE' if f.endswith('+05:30') else ''}, '{f}')" for f in forms]
        lines.append(f"WHEN {n} THEN CASE account_id % 3 WHEN 0 THEN {of[0]} WHEN 1 THEN {of[1]} ELSE {of[2]} END")
    return "CASE transaction_id % 10 " + "\n      ".join(lines) + " ELSE '31-02-' || strftime(transaction_date, '%Y') END"


def _text_read() -> str:
    """Every text is tried with the patterns whose own output it is."""
    tries = []
    for f in (f for forms in _TEXT_FORMS.values() for f in forms):
        shift = " - INTERVAL 330 MINUTE" if f.endswith("+05:30") else ""
        read = f"try_strptime(date_text, '{f}')"
        written = f"strftime({read}, '{f}')"
        tries.append(f"CASE WHEN {written} = date_text THEN {read}{shift} END")
    return "COALESCE(" + ",\n    ".join(tries) + ")"


TEXTS_CTE = f"""texts AS (
  SELECT *, {_text_case()} AS date_text
  FROM transaction_src),
parsed AS (SELECT *, {_text_read()} AS parsed FROM texts)"""

SQL["parse_mixed_dates"] = with_src("SELECT transaction_id, date_text, parsed FROM parsed",
                                    TEXTS_CTE)
SQL["date_id"] = with_src("""
SELECT transaction_id, strftime(transaction_date, '%Y%m%d') AS day_key,
       CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS DateID
FROM transaction_src""")
SQL["format_ts"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS f_iso,
       strftime(ts, '%Y%m%d_%H%M%S') AS f_snapshot, strftime(ts, '%Y%m%d %H:%M:%S') AS f_compact,
       strftime(ts, '%Y-%b-%d-%H:%M:%S') AS f_log
FROM events"""

# --- bronze bars ----------------------------------------------------------------------

BARS_CTE = """bars AS (
  SELECT event_type AS Company, CAST(ts AS DATE) AS Date,
         arg_min(value, (ts, event_id)) AS Open, max(value) AS High, min(value) AS Low,
         arg_max(value, (ts, event_id)) AS Close, count(*) AS Volume
  FROM events GROUP BY event_type, CAST(ts AS DATE)),
tickers AS (SELECT * FROM (VALUES ('click'), ('purchase'), ('view'), ('refund')) v(Company)),
last5 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY Company ORDER BY Date DESC) AS rn FROM bars)
  WHERE rn <= 5)
"""
SQL["bronze_last5"] = "WITH " + BARS_CTE + "SELECT * FROM last5"
SQL["ticker_semi"] = ("WITH " + BARS_CTE
                      + "SELECT * FROM last5 WHERE Company IN (SELECT Company FROM tickers)")
SQL["bronze_rejects"] = ("WITH " + BARS_CTE + "SELECT Company, 'no data returned' AS reject_reason "
                         "FROM tickers WHERE Company NOT IN (SELECT Company FROM bars)")
SQL["bronze_partitions"] = ("WITH " + BARS_CTE + "SELECT *, '20020101_000000' AS snapshot_ts "
                            "FROM last5 WHERE Company IN (SELECT Company FROM tickers)")
SQL["bronze_path"] = """
SELECT event_type AS Company,
       'bronze/' || event_type || '/' || event_type || '_' || strftime(max(ts), '%Y%m%d_%H%M%S')
       || '.parquet' AS object_path
FROM events GROUP BY event_type"""

# --- files ---------------------------------------------------------------------------

_FILE_GOOD = ("SELECT transaction_id, account_id, transaction_date, amount, transaction_type, "
              f"branch_id, transaction_date AS dtmcrt, {BATCH_TS} AS dtmload "
              "FROM transaction_src WHERE transaction_id % 10 <> 7")
SQL["file_ingest_csv"] = with_src(_FILE_GOOD)
SQL["invalid_dates"] = with_src(
    "SELECT transaction_id, date_text, 'invalid_date' AS reject_reason FROM parsed "
    "WHERE parsed IS NULL", TEXTS_CTE)
SQL["file_isolation"] = """
SELECT 'missing columns: branch_id' AS reject_reason, CAST(1 AS BIGINT) AS n_files,
       count(*) AS n_rows
FROM lineitem WHERE l_linenumber = 1"""
SQL["union_sources"] = with_src(_purged("transaction") + "\nUNION ALL\n" + _extract("transaction")
                                + "\nUNION ALL\n" + _FILE_GOOD)
SQL["parquet_roundtrip"] = SQL["incremental_extract"]

# --- html ----------------------------------------------------------------------------

SQL["html_rows"] = """
SELECT page_id, CAST(row_no AS INTEGER) AS row_no, link_text FROM (
  SELECT page_id, unnest(range(1, len(l) + 1)) AS row_no, unnest(l) AS link_text
  FROM (SELECT page_id,
               regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a></li>', 1) AS l FROM pages))"""

# --- streaming, run log, whole run ----------------------------------------------

SQL["stream_file_ingest"] = SQL["file_ingest_csv"]
SQL["stream_daily_summary"] = with_src(f"""
SELECT CAST(transaction_date AS DATE) AS TransactionDate, count(*) AS TotalTransactions,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS TotalTransactionAmount
FROM ({_FILE_GOOD}) g GROUP BY CAST(transaction_date AS DATE)""")

# The stages of the banks run log and their messages.
_STAGES = (
    ("start", "Preliminaries complete. Initiating ETL process", False),
    ("extract", "Data extraction complete. Initiating Transformation process", True),
    ("transform", "Data transformation complete. Initiating Loading process", True),
    ("load_csv", "Data saved to CSV file", True),
    ("load_db", "Data loaded to Database as a table, Executing queries", True),
    ("done", "Process Complete", False),
)
SQL["run_log"] = "\nUNION ALL ".join(
    f"SELECT 'banks-run' AS run_id, {i} AS seq, '{s}' AS stage, {BATCH_TS} AS ts, "
    f"'{m}' AS message, "
    + ("(SELECT count(*) FROM supplier)" if counted else "CAST(NULL AS BIGINT)")
    + f" AS rows, strftime({BATCH_TS}, '%Y-%b-%d-%H:%M:%S') || ' : {m}' AS line"
    for i, (s, m, counted) in enumerate(_STAGES, start=1))

SQL["warehouse_run"] = SQL["customer_mart"]
SQL["warehouse_run_daily"] = SQL["daily_summary"]

# --- parameterised reads as SQL, missing lookups --------------------------------

SQL["balance_per_customer_sql"] = SQL["balance_per_customer"]
SQL["daily_summary_range_sql"] = SQL["daily_summary_range"]

_ORPHAN_CUST = """
SELECT c.customer_id AS CustomerID, ci.city_name, st.state_name, c.customer_name, c.address,
       c.age, c.gender, c.email
FROM cust_l c
LEFT JOIN (SELECT * FROM city_l WHERE city_id % 5 <> 3) ci ON c.city_id = ci.city_id
LEFT JOIN state_l st ON ci.state_id = st.state_id"""

SQL["customer_rejects"] = with_core(f"""
SELECT CustomerID, CASE WHEN city_name IS NULL THEN 'no_city' ELSE 'no_state' END AS reject_reason
FROM ({_ORPHAN_CUST}) j WHERE city_name IS NULL OR state_name IS NULL
UNION ALL
SELECT customer_id AS CustomerID, 'null_key' AS reject_reason FROM customer_raw
WHERE customer_id IS NULL""")

SQL["dim_customer_orphans"] = with_core(f"""
SELECT CustomerID, upper(customer_name) AS CustomerName, upper(address) AS Address,
       upper(city_name) AS CityName, upper(state_name) AS StateName, age AS Age,
       upper(gender) AS Gender, email AS Email, {BATCH_TS} AS dtmload,
       CAST(NULL AS TIMESTAMP) AS dtmupd
FROM ({_ORPHAN_CUST}) j WHERE city_name IS NOT NULL AND state_name IS NOT NULL""")

# --- whole run: one log record per table written, with its row count ------------

SQL["warehouse_run_log"] = with_core(f"""
SELECT '20020101_000000' AS run_id, 1 AS seq, 'customer_raw' AS stage, {BATCH_TS} AS ts, 'customer_raw written' AS message, CAST((SELECT count(*) FROM customer_src) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 2 AS seq, 'city_raw' AS stage, {BATCH_TS} AS ts, 'city_raw written' AS message, CAST((SELECT count(*) FROM city_src) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 3 AS seq, 'account_raw' AS stage, {BATCH_TS} AS ts, 'account_raw written' AS message, CAST((SELECT count(*) FROM account_src) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 4 AS seq, 'branch_raw' AS stage, {BATCH_TS} AS ts, 'branch_raw written' AS message, CAST((SELECT count(*) FROM branch_src) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 5 AS seq, 'state_raw' AS stage, {BATCH_TS} AS ts, 'state_raw written' AS message, CAST((SELECT count(*) FROM state_src) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 6 AS seq, 'transaction_raw' AS stage, {BATCH_TS} AS ts, 'transaction_raw written' AS message, CAST((SELECT count(*) FROM transaction_src) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 7 AS seq, 'DimDate' AS stage, {BATCH_TS} AS ts, 'DimDate written' AS message, CAST((SELECT count(*) FROM dim_date) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 8 AS seq, 'DimCustomer' AS stage, {BATCH_TS} AS ts, 'DimCustomer written' AS message, CAST((SELECT count(*) FROM dim_customer) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 9 AS seq, 'DimBranch' AS stage, {BATCH_TS} AS ts, 'DimBranch written' AS message, CAST((SELECT count(*) FROM dim_branch) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 10 AS seq, 'DimAccount' AS stage, {BATCH_TS} AS ts, 'DimAccount written' AS message, CAST((SELECT count(*) FROM dim_account) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 11 AS seq, 'FactTransaction' AS stage, {BATCH_TS} AS ts, 'FactTransaction written' AS message, CAST((SELECT count(*) FROM fact) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 12 AS seq, 'CustomerMart' AS stage, {BATCH_TS} AS ts, 'CustomerMart written' AS message, CAST((SELECT count(*) FROM dim_customer c JOIN dim_account a ON c.CustomerID = a.CustomerID) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 13 AS seq, 'DailySummaryMart' AS stage, {BATCH_TS} AS ts, 'DailySummaryMart written' AS message, CAST((SELECT count(DISTINCT f.TransactionDateID) FROM fact f JOIN dim_date d ON f.TransactionDateID = d.DateID) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 14 AS seq, 'rejects_customer' AS stage, {BATCH_TS} AS ts, 'rejects_customer written' AS message, CAST((SELECT count(*) FROM cust_l c LEFT JOIN city_l ci ON c.city_id = ci.city_id LEFT JOIN state_l st ON ci.state_id = st.state_id WHERE ci.city_name IS NULL OR st.state_name IS NULL) AS BIGINT) AS rows
UNION ALL SELECT '20020101_000000' AS run_id, 15 AS seq, 'rejects_transaction' AS stage, {BATCH_TS} AS ts, 'rejects_transaction written' AS message, CAST((SELECT count(*) FROM transaction_raw t LEFT JOIN dim_account a ON t.account_id = a.AccountID LEFT JOIN dim_branch b ON t.branch_id = b.BranchID LEFT JOIN dim_date d ON CAST(t.transaction_date AS DATE) = d.FullDate WHERE t.transaction_id IS NULL OR a.AccountID IS NULL OR b.BranchID IS NULL OR d.FullDate IS NULL) AS BIGINT) AS rows""")

SQL["bronze_run"] = SQL["bronze_partitions"]

# --- merges and checks over every declared table --------------------------------------

SQL["merge_type1_customer_orphans"] = with_core(",\n" + _changes(
    "cust_ch0", "customer_raw", "customer", "ex_customer") + """,
cust_ch AS (
  SELECT c.customer_id, upper(c.customer_name) AS CustomerName, upper(c.address) AS Address,
         upper(ci.city_name) AS CityName, upper(st.state_name) AS StateName, c.age AS Age,
         upper(c.gender) AS Gender, c.email AS Email
  FROM cust_ch0 c JOIN (SELECT * FROM city_l WHERE city_id % 5 <> 3) ci ON c.city_id = ci.city_id
       JOIN state_l st ON ci.state_id = st.state_id
  WHERE ci.city_name IS NOT NULL AND st.state_name IS NOT NULL)
""" + _merge_select("ex_customer", "CustomerID", "cust_ch", "customer_id",
                    {c: f"ch.{c}" for c in _CUST_COLS[1:8]}, _CUST_COLS),
    existing=True)

_MARTS = f"""
, branch_less AS (SELECT * FROM dim_branch WHERE BranchID % 10 <> 3),
customer_mart AS (SELECT * FROM ({SQL["customer_mart"][SQL["customer_mart"].rindex("SELECT c.CustomerID, c.CustomerName, a.AccountID"):]})),
daily AS (SELECT * FROM ({SQL["daily_summary"][SQL["daily_summary"].rindex("SELECT d.FullDate AS TransactionDate"):]}))
"""
_DECLARED = {"DimDate": "dim_date", "DimCustomer": "dim_customer", "DimAccount": "dim_account",
             "DimBranch": "branch_less", "FactTransaction": "fact", "DailySummaryMart": "daily",
             "CustomerMart": "customer_mart"}


def _keys(name: str, table: str, keys: str) -> str:
    null = " OR ".join(f"{k.strip()} IS NULL" for k in keys.split(","))
    return (f"SELECT '{name}' AS table_name, "
            f"CAST((SELECT count(*) FROM (SELECT {keys} FROM {table} WHERE NOT ({null}) GROUP BY {keys} "
            f"HAVING count(*) > 1)) AS BIGINT) AS n_duplicate_keys, "
            f"CAST((SELECT count(*) FROM {table} WHERE {null}) AS BIGINT) AS n_null_keys")


SQL["declared_primary_keys"] = with_core(_MARTS + "\nUNION ALL ".join(
    [_keys(n, _DECLARED[n], k) for n, k in (
        ("DimDate", "DateID"), ("DimCustomer", "CustomerID"), ("DimAccount", "AccountID"),
        ("DimBranch", "BranchID"), ("FactTransaction", "TransactionID"),
        ("DailySummaryMart", "TransactionDate"), ("CustomerMart", "CustomerID, AccountID"))]
    + [_keys(f"{t}_raw", f"{t}_raw", f"{t}_id") for t in TABLES]))


def _reference(child: str, fk: str, parent: str, pk: str) -> str:
    orphans = (f"FROM {_DECLARED[child]} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
               f"(SELECT 1 FROM {_DECLARED[parent]} p WHERE p.{pk} = c.{fk})")
    return (f"SELECT '{child}_{fk}' AS constraint_name, CAST((SELECT count(DISTINCT c.{fk}) {orphans}) AS BIGINT) AS n_keys, "
            f"CAST((SELECT count(*) {orphans}) AS BIGINT) AS n_rows")


SQL["declared_foreign_keys"] = with_core(_MARTS + "\nUNION ALL ".join(
    _reference(*x) for x in (("DimAccount", "CustomerID", "DimCustomer", "CustomerID"),
                             ("DimAccount", "DateOpenedID", "DimDate", "DateID"),
                             ("FactTransaction", "AccountID", "DimAccount", "AccountID"),
                             ("FactTransaction", "BranchID", "DimBranch", "BranchID"))))

_NOT_NULL = {
    "DimDate": "DateID FullDate",
    "DimCustomer": "CustomerID CustomerName Address CityName StateName Age Gender Email",
    "DimAccount": "AccountID CustomerID AccountType Balance DateOpenedID Status",
    "DimBranch": "BranchID BranchName BranchLocation",
    "FactTransaction": "TransactionID AccountID TransactionDateID Amount TransactionType BranchID",
}
_RAW_NOT_NULL = {"customer": "dtmload", "city": "dtmload", "account": "dtmcrt dtmload", "branch": "dtmcrt dtmload",
                 "state": "dtmcrt dtmload", "transaction": "dtmcrt dtmload"}


def _nulls(name: str, table: str, cols: str) -> list[str]:
    return [f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
            f"CAST((SELECT count(*) FROM {table} WHERE {c} IS NULL) AS BIGINT) AS n_null" for c in cols.split()]


SQL["declared_not_null"] = with_core(_MARTS + "\nUNION ALL ".join(
    [q for n, cols in _NOT_NULL.items() for q in _nulls(n, _DECLARED[n], cols)]
    + [q for t, cols in _RAW_NOT_NULL.items() for q in _nulls(f"{t}_raw", f"{t}_raw", cols)]))

# Declared VARCHAR limits.
_LENGTHS = (
    ("DimCustomer", "CustomerName", 200), ("DimCustomer", "Address", 300), ("DimCustomer", "CityName", 200),
    ("DimCustomer", "StateName", 200), ("DimCustomer", "Gender", 20), ("DimCustomer", "Email", 200),
    ("DimAccount", "AccountType", 50), ("DimAccount", "Status", 50),
    ("DimBranch", "BranchName", 200), ("DimBranch", "BranchLocation", 300),
    ("FactTransaction", "TransactionType", 50),
    ("CustomerMart", "CustomerName", 200), ("CustomerMart", "AccountType", 50),
    ("customer_raw", "customer_name", 100), ("customer_raw", "address", 200), ("customer_raw", "gender", 10),
    ("customer_raw", "email", 100), ("city_raw", "city_name", 50),
    ("account_raw", "account_type", 10), ("account_raw", "status", 10),
    ("branch_raw", "branch_name", 50), ("branch_raw", "branch_location", 50),
    ("state_raw", "state_name", 50), ("transaction_raw", "transaction_type", 50),
)
SQL["declared_lengths"] = with_core(_MARTS + "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_allowed, "
    f"CAST(COALESCE(sum(CASE WHEN length({c}) > {n} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_too_long, "
    f"CAST(max(length({c})) AS INTEGER) AS max_length FROM {_DECLARED.get(t, t)}" for t, c, n in _LENGTHS))

# --- workbooks, banks from pages, snapshots, further runs -------------------------------

SQL["file_ingest_xlsx"] = SQL["file_ingest_csv"]
SQL["xlsx_rejected_files"] = with_src("""
SELECT 'invalid_date' AS reject_reason, CAST(0 AS BIGINT) AS n_files, count(*) AS n_bad_rows
FROM parsed WHERE parsed IS NULL
UNION ALL SELECT 'unreadable workbook: BadZipFile', CAST(1 AS BIGINT), CAST(0 AS BIGINT)""", TEXTS_CTE)
SQL["stream_rejected_files"] = SQL["file_isolation"]

SQL["html_table"] = """
SELECT CAST(floor((s_suppkey - 1) / 25) AS BIGINT) AS page_id,
       CAST(1 + row_number() OVER (PARTITION BY floor((s_suppkey - 1) / 25) ORDER BY s_suppkey) AS INTEGER) AS row_no,
       s_suppkey AS Rank, s_name AS Country, CAST(printf('%.2f', s_acctbal) AS DOUBLE) AS MC_USD_Billion
FROM supplier"""
SQL["banks_pipeline"] = SQL["fx_convert"]
SQL["bronze_rerun"] = SQL["bronze_partitions"]

SQL["warehouse_run_files"] = (SQL["customer_mart"].replace("transaction_raw AS (\n", "transaction_raw0 AS (\n").replace(
    "bounds AS (", f"""transaction_raw AS (
  SELECT * FROM transaction_raw0
  UNION ALL BY NAME
  SELECT transaction_id + 1000000000000 AS transaction_id, account_id, transaction_date, amount, transaction_type,
         branch_id, transaction_date AS dtmcrt, {BATCH_TS} AS dtmload
  FROM transaction_src WHERE transaction_id % 10 <> 7),
bounds AS (""", 1))

# Sources of two runs; the rows that the first run staged; the staged rows after the second one.
_TWO_RUNS = f"""
first_run AS (
  SELECT * EXCLUDE (dtmupd), {PREV_RUN_END} AS dtmload FROM transaction_src WHERE dtmcrt < {PREV_RUN_END}),
second_src AS (
  SELECT * REPLACE (
    CASE WHEN year(dtmcrt) = 1995 AND month(dtmcrt) = 3 THEN dtmcrt + INTERVAL 2 MONTH ELSE dtmcrt END AS dtmcrt,
    CASE WHEN year(dtmcrt) = 1995 AND month(dtmcrt) = 3 THEN TIMESTAMP '2001-06-01' ELSE dtmupd END AS dtmupd)
  FROM transaction_src),
second_run AS (
  SELECT {_SPEC_COLS['transaction']}, dtmload FROM first_run s WHERE NOT EXISTS (
    SELECT 1 FROM second_src src WHERE src.transaction_id = s.transaction_id AND src.dtmupd > s.dtmload)
  UNION ALL
  SELECT {_SPEC_COLS['transaction']}, {BATCH_TS} AS dtmload FROM second_src
  WHERE dtmcrt > {PREV_RUN_END} OR COALESCE(dtmupd, TIMESTAMP '1900-01-01') > {PREV_RUN_END})"""

SQL["warehouse_second_run"] = with_src(f"SELECT {_SPEC_COLS['transaction']}, dtmload FROM second_run", _TWO_RUNS)

SQL["warehouse_recovered_run"] = with_src(f"""
SELECT {_SPEC_COLS['transaction']}, dtmload FROM second_run
UNION ALL
SELECT transaction_id + 1000000000000, account_id, transaction_date, amount, transaction_type, branch_id,
       transaction_date AS dtmcrt, {BATCH_TS} AS dtmload
FROM transaction_src WHERE transaction_id % 10 <> 7""", _TWO_RUNS)


def _ranked(name: str, source: str, where: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT t.*, d.DateID, row_number() OVER (
             PARTITION BY t.transaction_id ORDER BY t.transaction_date DESC NULLS LAST, t.amount DESC NULLS LAST,
             t.branch_id ASC NULLS FIRST, t.transaction_type ASC NULLS FIRST) AS rn
    FROM {source} t JOIN dim_date d ON CAST(t.transaction_date AS DATE) = d.FullDate WHERE {where}) WHERE rn = 1)"""


# The fact after both runs: rows keep their account and day, amounts follow the latest staged change.
_FACT_TWO_RUNS = f""",
{_TWO_RUNS},
{_ranked('fact_one', 'first_run', "t.account_id IN (SELECT account_id FROM account_src WHERE dtmcrt < " + PREV_RUN_END
         + ") AND t.branch_id IN (SELECT branch_id FROM branch_src WHERE dtmcrt < " + PREV_RUN_END + ")")},
{_ranked('fact_two', 'second_run', "t.account_id IN (SELECT account_id FROM account_src) AND t.branch_id IN "
         "(SELECT branch_id FROM branch_src) AND t.transaction_id NOT IN (SELECT transaction_id FROM fact_one)")},
{latest_cte('change_one', 'first_run', 'transaction')},
{latest_cte('change_two', f"(SELECT * FROM second_run WHERE dtmload > {PREV_RUN_END})", 'transaction')},
fact_rows AS (SELECT transaction_id, account_id, DateID FROM fact_one
              UNION ALL SELECT transaction_id, account_id, DateID FROM fact_two),
fact_after AS (
  SELECT f.transaction_id AS TransactionID, f.account_id AS AccountID, f.DateID AS TransactionDateID,
         CAST(CASE WHEN c2.transaction_id IS NOT NULL THEN c2.amount ELSE c1.amount END AS DECIMAL(18,2)) AS Amount,
         upper(CASE WHEN c2.transaction_id IS NOT NULL THEN c2.transaction_type ELSE c1.transaction_type END) AS TransactionType
  FROM fact_rows f LEFT JOIN change_one c1 ON f.transaction_id = c1.transaction_id
       LEFT JOIN change_two c2 ON f.transaction_id = c2.transaction_id)
"""


def _after_two_runs(query: str) -> str:
    """A mart's SQL with its last SELECT over the fact after both runs."""
    head, tail = query[:query.rindex("\nSELECT ")], query[query.rindex("\nSELECT "):]
    return head + _FACT_TWO_RUNS + tail.replace("JOIN fact f", "JOIN fact_after f").replace("FROM fact f", "FROM fact_after f")


SQL["mart_incremental"] = _after_two_runs(SQL["customer_mart"])
SQL["mart_incremental_daily"] = _after_two_runs(SQL["daily_summary"])
SQL["daily_summary_range_pruned"] = SQL["daily_summary_range"]
SQL["collated_balances"] = (
    SQL["customer_mart"].replace("\nSELECT c.CustomerID", "\nSELECT CustomerID, count(*) AS n_accounts, "
                                 "CAST(sum(CurrentBalance) AS DECIMAL(18,2)) AS balance FROM (SELECT c.CustomerID", 1)
    + ") GROUP BY CustomerID")

SQL["namespaces"] = with_core("""
SELECT 'staging' AS namespace, 'branch_raw' AS table_name, true AS listed, count(*) AS n_rows FROM branch_raw
UNION ALL SELECT 'core', 'dimbranch', true, count(*) FROM dim_branch
UNION ALL SELECT 'mart', 'dailysummarymart', true, count(DISTINCT f.TransactionDateID)
  FROM fact f JOIN dim_date d ON f.TransactionDateID = d.DateID""")

# --- streams: versions in state, both kinds of files ---------------------------------------

SQL["stream_daily_totals"] = with_src(f"""
SELECT CAST(transaction_date AS DATE) AS TransactionDate, count(*) AS TotalTransactions,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS TotalTransactionAmount
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
                                   ORDER BY transaction_date DESC NULLS LAST, amount DESC NULLS LAST,
                                            branch_id ASC NULLS FIRST, transaction_type ASC NULLS FIRST) AS rn
      FROM ({_FILE_GOOD}) g) WHERE rn = 1 GROUP BY CAST(transaction_date AS DATE)""")
SQL["stream_mixed_files"] = with_src(
    _FILE_GOOD + "\nUNION ALL\n" + _FILE_GOOD.replace("SELECT transaction_id,", "SELECT transaction_id + 1000000000000,", 1))
SQL["stream_mixed_rejects"] = SQL["file_isolation"] + """
UNION ALL SELECT 'unreadable workbook: BadZipFile', CAST(1 AS BIGINT), CAST(0 AS BIGINT)"""

SQL["new_keys_fact_bucketed"] = SQL["new_keys_fact"]
SQL["merge_type1_fact_bucketed"] = SQL["merge_type1_fact"]
