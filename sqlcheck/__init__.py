"""DuckDB oracle SQL, one statement per query of `cardflow.registry`.

Written independently of the Spark code: the fixture mapping, the ordered
rules (with `row_number()` for the one-row-per-key pick) and the metrics are
restated as CTEs over the driver's tables.
"""

from __future__ import annotations

# Fixed values, restated for the oracle (see cardflow.functions.fixed).
ID_CHARS = r"[a-zA-Z!@#$%^&*()_+={}\[\]:;<>,.?~\\/ ]"
ALPHA_ONLY_CHARS = r"[0-9!@#$%^&*()_+={}\[\]:;<>,.?~\\/]"
ACCOUNT_CHARS = r"[a-zA-Z-!@#$%^&*()_+={}\[\]:;<>,.?~\\/ ]"
AS_OF = "DATE '2024-01-01'"

CUSTOMER_TEXT = {
    "duplicate": "Record is rejected due to duplicate Customer Id",
    "null": "Record is rejected due to NULL value in the column",
    "alpha": "Record is rejected due to presence of alpha or special characters in CUSTOMER_ID/DOB fields",
    "number": "Record is rejected as integer and special character found in fields which should only have Alphabets",
    "pep": "The customer does not satisfy PEP exposed condition",
    "sanctioned": "Customer is from country which comes under sanctioned category",
    "negative_income": "The annual income mentioned is negative",
}
ACCOUNT_TEXT = {
    "duplicate": "Record is rejected due to duplicate Customer Id",
    "null": "Record is rejected due to NULL value in the column",
    "closed": "Account for this customer has already bee closed",
    "special": "special character present in one of the column",
    "card": "card nummber is not valid",
}
TRANSACTION_TEXT = {
    "duplicate": "Record is rejected due to presence of duplicate transaction",
    "null": "Record is rejected due to presence of null values",
    "number": "Record is rejected as integer and special character found in fields which should only have Alphabets",
}
ORPHAN_TEXT = "Transaction made through an account/card which is not registered or an Invalid transaction due to customer data not available"

# Column names and order of the raw files.
CUSTOMER_COLS = ["CUSTOMER_ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "DOB", "ADDRESS1", "ADDRESS2", "STATE",
                 "CITY", "COUNTRY", "PIN_CODE", "CUST_PEP_EXPOSED", "ANNUAL_INCOME"]
ACCOUNT_COLS = ["cust_id", "Account_num", "card_num", "acct_open_dt", "acct_close_dt", "acct_cycle_dt", "defaulted"]
TXN_COLS = ["Cust_Id", "Account_Num", "Card_Num", "Transaction_Dt", "Transaction_Amount", "Transaction_Purpose",
            "Transaction_Place", "Opt_EMI"]


def _case(code_col: str, texts: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in texts.items())
    return f"CASE {code_col} {whens} END"


def _order(cols) -> str:
    return ", ".join(f'"{c}" ASC NULLS LAST' for c in cols)


def _q(cols) -> str:
    return ", ".join(f'"{c}"' for c in cols)


def _rx(col: str, pattern: str) -> str:
    return f"regexp_matches(\"{col}\", '{pattern}')"


# name -> (dependencies, body)
CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTE[name] = (deps, body)


# ---------------------------------------------------------------- fixtures
cte("geo", [], "SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
cte("cust_base", ["geo"], """
SELECT c.c_custkey AS k, c.c_nationkey, c.c_acctbal, c.c_mktsegment AS seg, g.r_name
FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey""")
cte("cust_rows", ["cust_base"], """
SELECT *, 0 AS cp FROM cust_base
UNION ALL SELECT *, 1 AS cp FROM cust_base WHERE k % 50 = 7
UNION ALL SELECT *, 2 AS cp FROM cust_base WHERE k % 60 = 11""")
cte("raw_customer", ["cust_rows"], """
SELECT
  CASE WHEN k % 97 = 5 THEN 'A' || CAST(k AS VARCHAR)
       WHEN k % 101 = 9 THEN CAST(k AS VARCHAR) || '-1'
       ELSE CAST(k AS VARCHAR) END AS CUSTOMER_ID,
  CASE WHEN k % 41 = 3 THEN NULL WHEN k % 43 = 4 THEN 'Cust0mer' ELSE 'Customer' END AS FIRST_NAME,
  CASE WHEN k % 3 = 0 THEN NULL ELSE seg END AS MIDDLE_NAME,
  seg AS LAST_NAME,
  CASE WHEN k % 89 = 6 THEN '1990/01/01'
       ELSE strftime(DATE '1950-01-01' + CAST((k * 37) % 18000 AS INTEGER), '%d-%m-%Y') END AS DOB,
  CAST(NULL AS VARCHAR) AS ADDRESS1,
  'STREET' AS ADDRESS2,
  seg AS STATE,
  r_name || CASE WHEN cp = 1 THEN ' TOWN' ELSE ' CITY' END AS CITY,
  lower(r_name) AS COUNTRY,
  lpad(CAST(c_nationkey AS VARCHAR), 6, '1') AS PIN_CODE,
  CASE WHEN k % 11 = 2 THEN 'false' ELSE 'true' END AS CUST_PEP_EXPOSED,
  CAST(c_acctbal * 400 AS DOUBLE) AS ANNUAL_INCOME
FROM cust_rows""")
cte("raw_sanctioned", ["geo"], """
SELECT g.r_name AS COUNTRY FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey WHERE g.r_name = 'AMERICA'""")
cte("acct_base", [], """
SELECT c_custkey AS k, FALSE AS second FROM customer
UNION ALL SELECT c_custkey AS k, TRUE AS second FROM customer WHERE c_custkey % 4 = 0""")
cte("acct_rows", ["acct_base"], """
SELECT *, 0 AS cp FROM acct_base
UNION ALL SELECT *, 1 AS cp FROM acct_base WHERE k % 45 = 6
UNION ALL SELECT *, 2 AS cp FROM acct_base WHERE k % 60 = 11""")
cte("raw_account", ["acct_rows"], """
SELECT
  CAST(k AS VARCHAR) AS cust_id,
  CAST(CASE WHEN second THEN 900000 + k ELSE 500000 + k END AS VARCHAR) AS Account_num,
  CASE WHEN k % 31 = 8
       THEN substr(CAST(CASE WHEN second THEN 371000000000000 + k ELSE 370000000000000 + k END AS VARCHAR), 1, 14)
       ELSE CAST(CASE WHEN second THEN 371000000000000 + k ELSE 370000000000000 + k END AS VARCHAR) END AS card_num,
  CASE WHEN k % 83 = 10 THEN 'n/a'
       ELSE strftime(DATE '2019-06-01' + CAST((k * 53) % 1650 AS INTEGER), '%d-%b-%y') END AS acct_open_dt,
  CASE WHEN k % 13 = 1 THEN '01-Jan-23' ELSE NULL END AS acct_close_dt,
  CASE WHEN k % 29 = 4 THEN NULL
       WHEN k % 37 = 9 THEN 'x'
       WHEN cp = 1 THEN CAST(1 + (k + 1) % 28 AS VARCHAR)
       ELSE CAST(1 + k % 28 AS VARCHAR) END AS acct_cycle_dt,
  CAST(k % 5 AS VARCHAR) AS defaulted
FROM acct_rows""")


def _raw_txn(shift_years: int = 0) -> str:
    dt = "CAST(o_orderdate AS DATE)"
    if shift_years:
        dt = f"CAST(CAST(o_orderdate AS DATE) + INTERVAL {shift_years} YEAR AS DATE)"
    return f"""
SELECT
  CAST(o_custkey AS BIGINT) AS Cust_Id,
  CAST(CASE WHEN o_custkey % 4 = 0 AND o_orderkey % 2 = 1 THEN 900000 + o_custkey ELSE 500000 + o_custkey END
       AS BIGINT) AS Account_Num,
  CAST(CASE WHEN o_orderkey % 17 = 3 THEN 999999999999999
            WHEN o_custkey % 4 = 0 AND o_orderkey % 2 = 1 THEN 371000000000000 + o_custkey
            ELSE 370000000000000 + o_custkey END AS BIGINT) AS Card_Num,
  {dt} AS Transaction_Dt,
  CAST(o_totalprice AS DOUBLE) AS Transaction_Amount,
  CASE WHEN o_orderkey % 23 = 5 THEN NULL
       WHEN o_orderkey % 19 = 2 THEN o_orderpriority
       ELSE substr(o_orderpriority, 3) END AS Transaction_Purpose,
  'PLACE' AS Transaction_Place,
  CASE WHEN o_orderkey % 3 <> 0 THEN 'Y' ELSE 'N' END AS Opt_EMI
FROM orders"""


cte("raw_txn", [], _raw_txn())
cte("raw_txn_shifted", [], _raw_txn(10))

# ---------------------------------------------------------------- customers
cte("cust_norm", ["raw_customer"], """
SELECT CUSTOMER_ID, FIRST_NAME, MIDDLE_NAME, LAST_NAME,
       CAST(try_strptime(DOB, '%d-%m-%Y') AS DATE) AS DOB,
       ADDRESS1, ADDRESS2, STATE, CITY, upper(COUNTRY) AS COUNTRY, PIN_CODE,
       upper(CUST_PEP_EXPOSED) AS CUST_PEP_EXPOSED, CAST(ANNUAL_INCOME AS DOUBLE) AS ANNUAL_INCOME,
       CAST(year(CAST(try_strptime(DOB, '%d-%m-%Y') AS DATE)) AS INTEGER) AS "YEAR",
       CAST(month(CAST(try_strptime(DOB, '%d-%m-%Y') AS DATE)) AS INTEGER) AS "MONTH"
FROM raw_customer""")
_CUST_NORM_COLS = CUSTOMER_COLS + ["YEAR", "MONTH"]
cte("cust_ranked", ["cust_norm"], f"""
SELECT *, row_number() OVER (PARTITION BY CUSTOMER_ID ORDER BY {_order(_CUST_NORM_COLS)}) AS rn
FROM (SELECT DISTINCT * FROM cust_norm) d""")
cte("sanct", ["raw_sanctioned"], "SELECT DISTINCT COUNTRY AS s_country FROM raw_sanctioned")
_NULL11 = ["CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "DOB", "ADDRESS2", "STATE", "CITY", "COUNTRY", "PIN_CODE",
           "CUST_PEP_EXPOSED", "ANNUAL_INCOME"]
_NAMES = ["STATE", "CITY", "COUNTRY", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME"]
cte("cust_checked", ["cust_ranked", "sanct"], f"""
SELECT c.* EXCLUDE (rn, s_country), {_case('reason_code', CUSTOMER_TEXT)} AS Rejection_Reason, reason_code
FROM (
  SELECT c.*, s.s_country,
    CASE WHEN rn > 1 THEN 'duplicate'
         WHEN {' OR '.join(f'"{x}" IS NULL' for x in _NULL11)} THEN 'null'
         WHEN coalesce({_rx('CUSTOMER_ID', ID_CHARS)}, TRUE) THEN 'alpha'
         WHEN coalesce({' OR '.join(_rx(x, ALPHA_ONLY_CHARS) for x in _NAMES)}, FALSE) THEN 'number'
         WHEN NOT coalesce(CUST_PEP_EXPOSED IN ('TRUE'), FALSE) THEN 'pep'
         WHEN s.s_country IS NOT NULL THEN 'sanctioned'
         WHEN coalesce(ANNUAL_INCOME < 0, FALSE) THEN 'negative_income'
    END AS reason_code
  FROM cust_ranked c LEFT JOIN sanct s ON c.COUNTRY = s.s_country
) c""")
cte("cust_stage", ["cust_checked"], """
SELECT TRY_CAST(CUSTOMER_ID AS BIGINT) AS CUSTOMER_ID, FIRST_NAME, MIDDLE_NAME, LAST_NAME, DOB, ADDRESS1, ADDRESS2,
       STATE, CITY, COUNTRY, PIN_CODE, CUST_PEP_EXPOSED, ANNUAL_INCOME, "YEAR", "MONTH"
FROM cust_checked WHERE reason_code IS NULL""")

# ---------------------------------------------------------------- accounts
cte("acct_ranked", ["raw_account"], f"""
SELECT *, row_number() OVER (PARTITION BY cust_id, Account_num ORDER BY {_order(ACCOUNT_COLS)}) AS rn
FROM (SELECT DISTINCT * FROM raw_account) d""")
_ACCT_NULL = ["cust_id", "Account_num", "card_num", "acct_open_dt", "acct_cycle_dt", "defaulted"]
_ACCT_CHARS = ["cust_id", "Account_num", "card_num", "acct_cycle_dt", "defaulted"]
cte("acct_checked", ["acct_ranked"], f"""
SELECT a.* EXCLUDE (rn), {_case('reason_code', ACCOUNT_TEXT)} AS Rejection_Reason, reason_code
FROM (
  SELECT *,
    CASE WHEN rn > 1 THEN 'duplicate'
         WHEN {' OR '.join(f'"{x}" IS NULL' for x in _ACCT_NULL)} THEN 'null'
         WHEN acct_close_dt IS NOT NULL THEN 'closed'
         WHEN coalesce({' OR '.join(_rx(x, ACCOUNT_CHARS) for x in _ACCT_CHARS)}, TRUE) THEN 'special'
         WHEN coalesce(length(card_num) <> 15, FALSE) THEN 'card'
    END AS reason_code
  FROM acct_ranked
) a""")
cte("acct_stage", ["acct_checked"], """
SELECT TRY_CAST(cust_id AS BIGINT) AS cust_id, TRY_CAST(Account_num AS BIGINT) AS Account_num,
       TRY_CAST(card_num AS BIGINT) AS card_num, CAST(try_strptime(acct_open_dt, '%d-%b-%y') AS DATE) AS acct_open_dt,
       CAST(acct_close_dt AS VARCHAR) AS acct_close_dt, TRY_CAST(acct_cycle_dt AS INTEGER) AS acct_cycle_dt,
       TRY_CAST(defaulted AS INTEGER) AS defaulted
FROM acct_checked WHERE reason_code IS NULL""")

# ---------------------------------------------------------------- transactions
cte("txn_ranked", ["raw_txn"], f"""
SELECT *, row_number() OVER (PARTITION BY Cust_Id, Account_Num ORDER BY {_order(TXN_COLS)}) AS rn
FROM (SELECT DISTINCT * FROM raw_txn) d""")
cte("txn_checked", ["txn_ranked"], f"""
SELECT t.* EXCLUDE (rn), {_case('reason_code', TRANSACTION_TEXT)} AS Rejection_Reason, reason_code
FROM (
  SELECT *,
    CASE WHEN rn > 1 THEN 'duplicate'
         WHEN {' OR '.join(f'"{x}" IS NULL' for x in TXN_COLS)} THEN 'null'
         WHEN coalesce({_rx('Transaction_Purpose', ALPHA_ONLY_CHARS)} OR {_rx('Transaction_Place', ALPHA_ONLY_CHARS)},
                       FALSE) THEN 'number'
    END AS reason_code
  FROM txn_ranked
) t""")
cte("txn_stage", ["txn_checked"], f"SELECT {_q(TXN_COLS)} FROM txn_checked WHERE reason_code IS NULL")

# ---------------------------------------------------------------- transform
cte("joined_acct", ["txn_stage", "acct_stage"], """
SELECT t.*, a.acct_open_dt AS Acct_open_dt,
       CAST(try_strptime(a.acct_close_dt, '%d-%b-%y') AS DATE) AS Acct_close_dt,
       a.acct_cycle_dt AS Acct_Cycle_dt, a.defaulted AS Defaulted
FROM txn_stage t LEFT JOIN acct_stage a
  ON t.Cust_Id = a.cust_id AND t.Account_Num = a.Account_num AND t.Card_Num = a.card_num""")
cte("joined", ["joined_acct", "cust_stage"], """
SELECT j.*, c.FIRST_NAME, c.MIDDLE_NAME, c.LAST_NAME, c.DOB, c.ADDRESS1, c.ADDRESS2, c.STATE, c.CITY, c.COUNTRY,
       c.PIN_CODE, c.CUST_PEP_EXPOSED, c.ANNUAL_INCOME, c."YEAR", c."MONTH"
FROM joined_acct j LEFT JOIN cust_stage c ON j.Cust_Id = c.CUSTOMER_ID""")
cte("valid_joined", ["joined"], "SELECT * FROM joined WHERE Acct_open_dt IS NOT NULL AND FIRST_NAME IS NOT NULL")


def _emi(months: int, pct: int) -> str:
    r = f"(CAST({pct} AS DOUBLE) / CAST(1200 AS DOUBLE))"
    g = f"pow(CAST(1 AS DOUBLE) + {r}, CAST({months} AS DOUBLE))"
    return (f"Transaction_Amount * {r} * {g} AS EMI_{months}_month_check1, "
            f"{g} - CAST(1 AS DOUBLE) AS EMI_{months}_month_check2, "
            f"(Transaction_Amount * {r} * {g}) / ({g} - CAST(1 AS DOUBLE)) AS EMI_{months}_month")


cte("m0", ["valid_joined"], f"""
SELECT *, CAST(date_diff('day', Acct_open_dt, {AS_OF}) AS INTEGER) AS tenure,
       ANNUAL_INCOME * CAST(2 AS DOUBLE) AS Credit_Limit
FROM valid_joined""")
cte("m1", ["m0"], """
SELECT *,
  CAST(CASE WHEN tenure < 365 THEN 200 WHEN tenure >= 365 AND tenure < 720 THEN 400 WHEN tenure >= 720 THEN 500 END
       AS INTEGER) AS CS_Metric_1,
  CAST(CASE WHEN Defaulted = 0 THEN 100 WHEN Defaulted >= 1 AND Defaulted < 3 THEN 50 WHEN Defaulted >= 3 THEN 0
            ELSE 0 END AS INTEGER) AS CS_Metric_2,
  CAST(CASE WHEN ANNUAL_INCOME < 1000000 THEN 100
            WHEN ANNUAL_INCOME >= 1000000 AND ANNUAL_INCOME < 2000000 THEN 200
            WHEN ANNUAL_INCOME >= 2000000 AND ANNUAL_INCOME < 3000000 THEN 400 ELSE 500 END AS INTEGER) AS CS_Metric_3,
  Credit_Limit - Transaction_Amount AS Cust_credit_limit_remaining,
  CASE WHEN Acct_close_dt IS NULL THEN tenure END AS Customer_Since
FROM m0""")
cte("metrics", ["m1"], f"""
SELECT *,
  CASE WHEN Defaulted >= 1 THEN 'Y' ELSE 'N' END AS Account_Current_Status,
  CS_Metric_3 + CS_Metric_2 + CS_Metric_1 AS Credit_Score,
  Cust_credit_limit_remaining + Transaction_Amount AS Cust_credit_limit_used,
  CASE WHEN Acct_close_dt IS NULL THEN 'Y' ELSE 'N' END AS Acct_Active,
  Cust_credit_limit_remaining - Transaction_Amount AS DIff_Trans_Limit,
  CASE WHEN Opt_EMI = 'Y' AND (CS_Metric_3 + CS_Metric_2 + CS_Metric_1) >= 500 AND Customer_Since >= 720
            AND Transaction_Amount > 56000 AND (Cust_credit_limit_remaining - Transaction_Amount) > 0
       THEN 'Y' ELSE 'N' END AS EMI_Eligible,
  {_emi(3, 9)}, {_emi(6, 11)}, {_emi(9, 13)}
FROM m1""")
INTER_COLS = ["Cust_Id", "Account_Num", "Card_Num", "Transaction_Dt", "Transaction_Amount", "Transaction_Purpose",
              "Transaction_Place", "Opt_EMI", "Acct_open_dt", "Acct_close_dt", "Acct_Cycle_dt", "Defaulted",
              "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "DOB", "ADDRESS1", "ADDRESS2", "STATE", "CITY", "COUNTRY",
              "PIN_CODE", "CUST_PEP_EXPOSED", "ANNUAL_INCOME", "YEAR", "MONTH", "Account_Current_Status",
              "Credit_Limit", "CS_Metric_1", "CS_Metric_2", "CS_Metric_3", "Credit_Score", "Cust_credit_limit_used",
              "Cust_credit_limit_remaining", "Customer_Since", "Acct_Active", "DIff_Trans_Limit", "EMI_Eligible",
              "EMI_3_month_check1", "EMI_3_month_check2", "EMI_3_month", "EMI_6_month_check1", "EMI_6_month_check2",
              "EMI_6_month", "EMI_9_month_check1", "EMI_9_month_check2", "EMI_9_month"]
cte("inter", ["metrics"], f"SELECT {_q(INTER_COLS)} FROM metrics WHERE Cust_credit_limit_remaining >= 0")
cte("card_totals", ["inter"], """
SELECT Cust_Id, Card_Num, "YEAR", "MONTH", FIRST_NAME, LAST_NAME,
       round(sum(Transaction_Amount), 2) AS Latest_Transaction
FROM inter GROUP BY Cust_Id, Card_Num, "YEAR", "MONTH", FIRST_NAME, LAST_NAME""")
cte("orphans", ["joined"], f"""
SELECT '{ORPHAN_TEXT}' AS Rejection_Reason, {_q(TXN_COLS)}, 'orphan' AS reason_code
FROM joined WHERE Acct_open_dt IS NULL OR FIRST_NAME IS NULL""")


def with_history(body: str, *needed: str) -> str:
    """`with_`, but transactions of an account with another date or amount all survive."""
    return with_(body, *needed).replace("PARTITION BY Cust_Id, Account_Num ORDER",
                                        "PARTITION BY Cust_Id, Account_Num, Transaction_Dt, Transaction_Amount ORDER")


def with_(body: str, *needed: str) -> str:
    """`WITH` clause holding `needed` and their dependencies, then `body`."""
    seen: list[str] = []

    def visit(n: str):
        if n in seen:
            return
        for dep in CTE[n][0]:
            visit(dep)
        seen.append(n)

    for n in needed:
        visit(n)
    if not seen:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in seen) + "\n" + body
