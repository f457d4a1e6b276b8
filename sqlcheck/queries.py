"""Oracle SQL per query key (see `cardflow.registry`)."""

from __future__ import annotations

from sqlcheck import (ACCOUNT_COLS, CUSTOMER_COLS, CUSTOMER_TEXT, ID_CHARS, ALPHA_ONLY_CHARS, AS_OF, TXN_COLS,
                      _q, _rx, with_, with_history)

# Column lists of the stage and of the checks.
_CUST_STAGE_COLS = ["CUSTOMER_ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "DOB", "ADDRESS1", "ADDRESS2", "STATE",
                    "CITY", "COUNTRY", "PIN_CODE", "CUST_PEP_EXPOSED", "ANNUAL_INCOME", "YEAR", "MONTH"]
_NULL11 = ["CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "DOB", "ADDRESS2", "STATE", "CITY", "COUNTRY", "PIN_CODE",
           "CUST_PEP_EXPOSED", "ANNUAL_INCOME"]
_NAMES = ["STATE", "CITY", "COUNTRY", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME"]
_not_null11 = " AND ".join(f'"{c}" IS NOT NULL' for c in _NULL11)

ORACLE: dict[str, str] = {}

ORACLE["scan_customer_csv"] = with_("SELECT * FROM raw_customer", "raw_customer")
ORACLE["scan_failfast"] = ORACLE["scan_customer_csv"]
ORACLE["scan_corrupt_records"] = with_(f"""
SELECT TRY_CAST(cust_id AS BIGINT) AS cust_id, TRY_CAST(Account_num AS BIGINT) AS Account_num,
       TRY_CAST(card_num AS BIGINT) AS card_num, CAST(try_strptime(acct_open_dt, '%d-%b-%y') AS DATE) AS acct_open_dt,
       acct_close_dt, TRY_CAST(acct_cycle_dt AS INTEGER) AS acct_cycle_dt, TRY_CAST(defaulted AS INTEGER) AS defaulted,
       concat_ws(',', {', '.join(f"coalesce({c}, '')" for c in ACCOUNT_COLS)}) AS raw_line FROM raw_account
WHERE (acct_open_dt IS NOT NULL AND try_strptime(acct_open_dt, '%d-%b-%y') IS NULL)
   OR (acct_cycle_dt IS NOT NULL AND TRY_CAST(acct_cycle_dt AS INTEGER) IS NULL)""", "raw_account")
ORACLE["scan_corrupt_customers"] = with_(f"""
SELECT {_q(CUSTOMER_COLS[:-1])}, NULL::DOUBLE AS ANNUAL_INCOME,
       concat_ws(',', {', '.join(f"coalesce({c}, '')" for c in CUSTOMER_COLS[:-1])}, 'n/a') AS raw_line
FROM raw_customer WHERE TRY_CAST(CUSTOMER_ID AS BIGINT) % 53 = 8""", "raw_customer")
ORACLE["scan_account_csv"] = with_("SELECT * FROM raw_account", "raw_account")
ORACLE["scan_transaction_csv"] = with_("SELECT * FROM raw_txn_shifted", "raw_txn_shifted")
ORACLE["scan_sanctioned"] = with_("SELECT * FROM raw_sanctioned", "raw_sanctioned")
ORACLE["scan_stage_table"] = with_("SELECT * FROM acct_stage", "acct_stage")

_CASTS = [("customer", "CUSTOMER_ID", "TRY_CAST(CUSTOMER_ID AS BIGINT)"), ("account", "cust_id", "TRY_CAST(cust_id AS BIGINT)"),
          ("account", "Account_num", "TRY_CAST(Account_num AS BIGINT)"), ("account", "card_num", "TRY_CAST(card_num AS BIGINT)"),
          ("account", "acct_open_dt", "try_strptime(acct_open_dt, '%d-%b-%y')"),
          ("account", "acct_cycle_dt", "TRY_CAST(acct_cycle_dt AS INTEGER)"), ("account", "defaulted", "TRY_CAST(defaulted AS INTEGER)")]
ORACLE["cast_losses"] = with_("\nUNION ALL ".join(
    f"""SELECT '{source}' AS source, '{c}' AS "column", count({c}) AS present,
       count(*) FILTER (WHERE {c} IS NOT NULL AND {cast} IS NULL) AS lost
FROM {'cust' if source == 'customer' else 'acct'}_checked WHERE reason_code IS NULL""" for source, c, cast in _CASTS),
    "cust_checked", "acct_checked")

ORACLE["sink_customer_stage"] = with_("SELECT * FROM cust_stage", "cust_stage")
ORACLE["sink_rejects"] = with_(
    f"SELECT Rejection_Reason, {_q(CUSTOMER_COLS)}, 'Customer Information' AS FileName, reason_code "
    "FROM cust_checked WHERE reason_code IS NOT NULL", "cust_checked")
ORACLE["sink_account_stage"] = with_("""
SELECT CAST(TRY_CAST(cust_id AS BIGINT) AS VARCHAR) AS cust_id,
       CAST(TRY_CAST(Account_num AS BIGINT) AS VARCHAR) AS Account_num, NULL::VARCHAR AS reason_code
FROM acct_checked WHERE reason_code IS NULL
UNION ALL SELECT cust_id, Account_num, reason_code FROM acct_checked WHERE reason_code IS NOT NULL""", "acct_checked")
ORACLE["sink_transaction_stage"] = with_("SELECT * FROM txn_stage", "txn_stage")
ORACLE["sink_intermediate"] = with_("SELECT * FROM inter", "inter")
ORACLE["cache_intermediate"] = ORACLE["sink_intermediate"]
ORACLE["stage_counts"] = with_("""
SELECT 'customer' AS step, coalesce(reason_code, 'accepted') AS outcome, count(*) AS "rows"
FROM cust_checked GROUP BY ALL
UNION ALL SELECT 'account', coalesce(reason_code, 'accepted'), count(*) FROM acct_checked GROUP BY ALL
UNION ALL SELECT 'transaction', coalesce(reason_code, 'accepted'), count(*) FROM txn_checked GROUP BY ALL
UNION ALL SELECT 'transform',
  CASE WHEN Acct_open_dt IS NULL OR FIRST_NAME IS NULL THEN 'orphan'
       WHEN ANNUAL_INCOME * CAST(2 AS DOUBLE) - Transaction_Amount >= 0 THEN 'accepted'
       ELSE 'over_limit' END, count(*)
FROM joined GROUP BY ALL""", "cust_checked", "acct_checked", "txn_checked", "joined")
ORACLE["run_summary"] = with_("""
SELECT 'customer_stage' AS table_name, count(*) AS "rows" FROM cust_stage
UNION ALL SELECT 'customer_rejects', count(*) FROM cust_checked WHERE reason_code IS NOT NULL
UNION ALL SELECT 'account_stage', count(*) FROM acct_stage
UNION ALL SELECT 'account_rejects', count(*) FROM acct_checked WHERE reason_code IS NOT NULL
UNION ALL SELECT 'transaction_stage', count(*) FROM txn_stage
UNION ALL SELECT 'transaction_rejects', count(*) FROM txn_checked WHERE reason_code IS NOT NULL
UNION ALL SELECT 'orphans', count(*) FROM orphans
UNION ALL SELECT 'intermediate', count(*) FROM inter
UNION ALL SELECT 'geography_summary', count(*) FROM (SELECT DISTINCT COUNTRY, STATE FROM inter)
UNION ALL SELECT 'emi_offers', count(*) FROM inter WHERE EMI_Eligible = 'Y'
UNION ALL SELECT 'previous_transaction', count(*) FROM card_totals
UNION ALL SELECT 'credit_threshold', count(*) FROM inter
  WHERE CASE WHEN Credit_Limit = 0 THEN NULL ELSE Cust_credit_limit_remaining / Credit_Limit END * 100 <= 75
""", "cust_stage", "cust_checked", "acct_stage", "acct_checked", "txn_stage", "txn_checked", "orphans", "inter",
                              "card_totals")

ORACLE["reject_projection"] = with_(
    f"SELECT Rejection_Reason, {_q(CUSTOMER_COLS)} FROM cust_checked WHERE reason_code IS NOT NULL", "cust_checked")
ORACLE["transaction_metrics"] = with_("""
SELECT Cust_Id, Account_Num, Card_Num, Transaction_Amount, Account_Current_Status, Credit_Limit,
       Cust_credit_limit_remaining, Cust_credit_limit_used, DIff_Trans_Limit FROM metrics""", "metrics")
ORACLE["customer_valid"] = with_(
    f"SELECT {_q(_CUST_STAGE_COLS)} FROM cust_checked WHERE reason_code IS NULL", "cust_checked")
ORACLE["customer_stage"] = with_("SELECT * FROM cust_stage", "cust_stage")
ORACLE["customer_rejects"] = ORACLE["sink_rejects"]
ORACLE["account_valid"] = with_(f"SELECT {_q(ACCOUNT_COLS)} FROM acct_checked WHERE reason_code IS NULL",
                                "acct_checked")
ORACLE["account_stage"] = ORACLE["scan_stage_table"]
ORACLE["account_rejects"] = with_(
    f"SELECT Rejection_Reason, {_q(ACCOUNT_COLS)}, reason_code FROM acct_checked WHERE reason_code IS NOT NULL",
    "acct_checked")
ORACLE["transaction_valid"] = ORACLE["sink_transaction_stage"]
ORACLE["transaction_rejects"] = with_(
    f"SELECT Rejection_Reason, {_q(TXN_COLS)}, reason_code FROM txn_checked WHERE reason_code IS NOT NULL",
    "txn_checked")
ORACLE["intermediate"] = ORACLE["sink_intermediate"]

ORACLE["filter_not_null"] = with_(f"SELECT * FROM cust_norm WHERE {_not_null11}", "cust_norm")
ORACLE["filter_regex"] = with_(f"""
SELECT * FROM cust_norm
WHERE NOT {_rx('CUSTOMER_ID', ID_CHARS)}
  AND NOT coalesce({' OR '.join(_rx(c, ALPHA_ONLY_CHARS) for c in _NAMES)}, FALSE)""", "cust_norm")
ORACLE["filter_isin"] = with_("SELECT * FROM cust_norm WHERE CUST_PEP_EXPOSED IN ('TRUE')", "cust_norm")
ORACLE["filter_open_accounts"] = with_("SELECT * FROM raw_account WHERE acct_close_dt IS NULL", "raw_account")
ORACLE["filter_negative_income"] = with_("SELECT * FROM cust_norm WHERE ANNUAL_INCOME < 0", "cust_norm")
ORACLE["filter_within_limit"] = with_("""
SELECT Cust_Id, Account_Num, Card_Num, Transaction_Amount, Credit_Limit, Cust_credit_limit_remaining
FROM metrics WHERE Cust_credit_limit_remaining >= 0""", "metrics")
ORACLE["filter_card_length"] = with_("""
SELECT cust_id, Account_num, card_num, CAST(length(card_num) AS INTEGER) AS card_length
FROM raw_account WHERE length(card_num) <> 15""", "raw_account")

ORACLE["join_txn_account"] = with_("SELECT * FROM joined_acct", "joined_acct")
ORACLE["join_txn_customer"] = with_("SELECT * FROM joined", "joined")
ORACLE["join_by_buckets"] = ORACLE["join_txn_customer"]
ORACLE["anti_join_sanctioned"] = with_(
    "SELECT * FROM cust_norm c WHERE NOT EXISTS (SELECT 1 FROM sanct s WHERE s.s_country = c.COUNTRY)",
    "cust_norm", "sanct")

ORACLE["set_subtract"] = with_(
    f"SELECT * FROM cust_norm EXCEPT SELECT * FROM cust_norm WHERE {_not_null11}", "cust_norm")
ORACLE["set_union_all"] = with_("""
SELECT 'customer' AS source, CUSTOMER_ID AS record_key, Rejection_Reason, reason_code
FROM cust_checked WHERE reason_code IS NOT NULL
UNION ALL SELECT 'account', cust_id || '|' || Account_num, Rejection_Reason, reason_code
FROM acct_checked WHERE reason_code IS NOT NULL
UNION ALL SELECT 'transaction', CAST(Cust_Id AS VARCHAR) || '|' || CAST(Account_Num AS VARCHAR), Rejection_Reason,
  reason_code FROM txn_checked WHERE reason_code IS NOT NULL
UNION ALL SELECT 'joined', CAST(Cust_Id AS VARCHAR) || '|' || CAST(Account_Num AS VARCHAR), Rejection_Reason,
  reason_code FROM orphans""", "cust_checked", "acct_checked", "txn_checked", "orphans")
ORACLE["distinct_rows"] = with_("SELECT DISTINCT * FROM raw_account", "raw_account")
ORACLE["dedup_customers"] = with_("SELECT * EXCLUDE (rn) FROM cust_ranked WHERE rn = 1", "cust_ranked")
ORACLE["dedup_transactions"] = with_("SELECT * EXCLUDE (rn) FROM txn_ranked WHERE rn = 1", "txn_ranked")
ORACLE["duplicate_rejects"] = with_(
    f"SELECT * EXCLUDE (rn), '{CUSTOMER_TEXT['duplicate']}' AS Rejection_Reason FROM cust_ranked WHERE rn > 1",
    "cust_ranked")

ORACLE["report_geography"] = with_("""
SELECT COUNTRY, STATE, count(Cust_Id) AS CUST_ID_COUNT, round(avg(ANNUAL_INCOME), 2) AS AVG_ANNUAL_INCOME,
       max(Credit_Score) AS MAX_CREDIT_SCORE, min(Credit_Score) AS MIN_CREDIT_SCORE
FROM inter GROUP BY COUNTRY, STATE ORDER BY COUNTRY, STATE""", "inter")
ORACLE["view_scan_geography"] = ORACLE["report_geography"]
ORACLE["agg_card_totals"] = with_("SELECT * FROM card_totals", "card_totals")
ORACLE["agg_card_totals_history"] = with_history("SELECT * FROM card_totals", "card_totals")
_LAG = ('lag(Latest_Transaction) OVER (PARTITION BY Cust_Id, "YEAR", "MONTH" '
        'ORDER BY "YEAR" ASC NULLS FIRST, "MONTH" DESC NULLS LAST, Card_Num ASC NULLS FIRST)')
ORACLE["window_lag"] = with_(
    f'SELECT Cust_Id, Card_Num, "YEAR", "MONTH", Latest_Transaction, {_LAG} AS PREVIOUS_TRANSACTION '
    'FROM card_totals', "card_totals")
ORACLE["report_emi_offers"] = with_("""
SELECT FIRST_NAME, LAST_NAME, Cust_Id, Account_Num, Card_Num, Transaction_Dt, Transaction_Amount, Transaction_Purpose,
       EMI_3_month, EMI_3_month * 3 AS PayAfter3month, EMI_6_month, EMI_6_month * 6 AS PayAfter6month,
       EMI_9_month, EMI_9_month * 9 AS PayAfter9month
FROM inter WHERE EMI_Eligible = 'Y'""", "inter")
ORACLE["view_scan"] = ORACLE["report_emi_offers"]
ORACLE["report_previous_transaction"] = with_(
    f'SELECT Cust_Id, "YEAR", "MONTH", FIRST_NAME, LAST_NAME, Latest_Transaction, {_LAG} AS PREVIOUS_TRANSACTION '
    'FROM card_totals ORDER BY "YEAR", Cust_Id', "card_totals")
ORACLE["view_scan_previous"] = ORACLE["report_previous_transaction"]
_CHANGED = """(SELECT * REPLACE (CASE WHEN "YEAR" % 7 = 0 THEN Transaction_Amount * 2 ELSE Transaction_Amount END AS Transaction_Amount,
                    CASE WHEN "YEAR" % 7 = 0 THEN ANNUAL_INCOME + 1 ELSE ANNUAL_INCOME END AS ANNUAL_INCOME) FROM inter)"""
ORACLE["incremental_previous"] = with_(
    f"""SELECT Cust_Id, "YEAR", "MONTH", FIRST_NAME, LAST_NAME, Latest_Transaction, {_LAG} AS PREVIOUS_TRANSACTION
FROM (SELECT Cust_Id, Card_Num, "YEAR", "MONTH", FIRST_NAME, LAST_NAME, round(sum(Transaction_Amount), 2) AS Latest_Transaction
      FROM {_CHANGED} GROUP BY Cust_Id, Card_Num, "YEAR", "MONTH", FIRST_NAME, LAST_NAME)""", "inter")
ORACLE["incremental_geography"] = with_(f"""
SELECT COUNTRY, STATE, count(Cust_Id) AS CUST_ID_COUNT, round(avg(ANNUAL_INCOME), 2) AS AVG_ANNUAL_INCOME,
       max(Credit_Score) AS MAX_CREDIT_SCORE, min(Credit_Score) AS MIN_CREDIT_SCORE
FROM {_CHANGED} GROUP BY COUNTRY, STATE""", "inter")
ORACLE["report_credit_threshold"] = with_("""
SELECT * FROM (
  SELECT FIRST_NAME, LAST_NAME, COUNTRY, Cust_credit_limit_remaining, Credit_Limit AS Total_Credit_Limit,
         CASE WHEN Credit_Limit = 0 THEN NULL ELSE Cust_credit_limit_remaining / Credit_Limit END * 100 AS Ratio
  FROM inter) t
WHERE Ratio <= 75""", "inter")

ORACLE["view_scan_threshold"] = ORACLE["report_credit_threshold"]

ORACLE["fn_parse_dates"] = with_("""
SELECT cust_id, Account_num, acct_open_dt, CAST(try_strptime(acct_open_dt, '%d-%b-%y') AS DATE) AS open_date,
       CAST(try_strptime(acct_close_dt, '%d-%b-%y') AS DATE) AS close_date
FROM raw_account""", "raw_account")
ORACLE["fn_date_parts"] = with_("""
SELECT CUSTOMER_ID, DOB AS DOB_TEXT, CAST(try_strptime(DOB, '%d-%m-%Y') AS DATE) AS DOB,
       CAST(year(CAST(try_strptime(DOB, '%d-%m-%Y') AS DATE)) AS INTEGER) AS "YEAR",
       CAST(month(CAST(try_strptime(DOB, '%d-%m-%Y') AS DATE)) AS INTEGER) AS "MONTH"
FROM raw_customer""", "raw_customer")
ORACLE["fn_upper"] = with_(
    "SELECT CUSTOMER_ID, upper(COUNTRY) AS COUNTRY, upper(CUST_PEP_EXPOSED) AS CUST_PEP_EXPOSED FROM raw_customer",
    "raw_customer")
ORACLE["tenure_days"] = with_(f"""
SELECT Cust_Id, Account_Num, Acct_open_dt, CAST(date_diff('day', Acct_open_dt, {AS_OF}) AS INTEGER) AS tenure_days,
       CASE WHEN Acct_close_dt IS NULL THEN CAST(date_diff('day', Acct_open_dt, {AS_OF}) AS INTEGER) END
         AS Customer_Since,
       CASE WHEN Acct_close_dt IS NULL THEN 'Y' ELSE 'N' END AS Acct_Active
FROM valid_joined""", "valid_joined")
ORACLE["credit_score"] = with_(
    "SELECT Cust_Id, Account_Num, CS_Metric_1, CS_Metric_2, CS_Metric_3, Credit_Score FROM metrics", "metrics")
ORACLE["emi_schedule"] = with_("""
SELECT Cust_Id, Account_Num, Transaction_Amount, EMI_3_month_check1, EMI_3_month_check2, EMI_3_month,
       EMI_6_month_check1, EMI_6_month_check2, EMI_6_month, EMI_9_month_check1, EMI_9_month_check2, EMI_9_month
FROM metrics""", "metrics")
ORACLE["emi_eligible"] = with_("""
SELECT Cust_Id, Account_Num, Opt_EMI, Credit_Score, Customer_Since, Transaction_Amount, Cust_credit_limit_remaining,
       EMI_Eligible FROM metrics""", "metrics")
ORACLE["transaction_orphans"] = with_("SELECT * FROM orphans", "orphans")
