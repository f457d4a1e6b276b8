"""One rule at a time on tiny frames, plus rows that break two rules."""

import datetime as dt

from pyspark.sql import functions as F

from cardflow.config import Settings
from cardflow.functions import fixed
from cardflow.plans import ingest, transform
from cardflow.sources.csv import ACCOUNT_DDL, CUSTOMER_DDL, TRANSACTION_DDL


def _cust(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER_DDL)


def _good(cid="1", **kw):
    base = dict(CUSTOMER_ID=cid, FIRST_NAME="Ann", MIDDLE_NAME=None, LAST_NAME="Lee", DOB="01-02-1990",
                ADDRESS1=None, ADDRESS2="STREET", STATE="TEXAS", CITY="AUSTIN", COUNTRY="india", PIN_CODE="111111",
                CUST_PEP_EXPOSED="true", ANNUAL_INCOME=1000.0)
    base.update(kw)
    return tuple(base[c] for c in ["CUSTOMER_ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "DOB", "ADDRESS1",
                                   "ADDRESS2", "STATE", "CITY", "COUNTRY", "PIN_CODE", "CUST_PEP_EXPOSED",
                                   "ANNUAL_INCOME"])


def _sanct(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "COUNTRY string")


def _codes(checked):
    return {r["CUSTOMER_ID"] if "CUSTOMER_ID" in r else r[0]: r["reason_code"] for r in checked.collect()}


def test_customer_rules_in_order(spark):
    rows = [
        _good("1"),
        _good("2", CITY="B TOWN"), _good("2", CITY="A TOWN"),          # duplicate key: 'A TOWN' is kept
        _good("3", FIRST_NAME=None),                                   # null
        _good("4", DOB="1990/01/01"),                                  # unparseable DOB -> NULL -> null rule
        _good("A5"),                                                   # alpha in id
        _good("6", LAST_NAME="L33"),                                   # digit in a name
        _good("7", CUST_PEP_EXPOSED="false"),                          # PEP
        _good("8", COUNTRY="iran"),                                    # sanctioned (after upper-casing)
        _good("9", ANNUAL_INCOME=-1.0),                                # negative income
        _good("10", FIRST_NAME=None, ANNUAL_INCOME=-5.0),              # two rules: first (null) wins
        _good("11-1"),                                                 # '-' passes the id rule
        _good("12", MIDDLE_NAME=None),                                 # NULL middle name passes
    ]
    checked = ingest.check_customers(_cust(spark, rows), _sanct(spark, "IRAN", "IRAN"), Settings())
    got = {(r["CUSTOMER_ID"], r["CITY"]): r["reason_code"] for r in checked.collect()}
    assert got[("1", "AUSTIN")] is None
    assert got[("2", "A TOWN")] is None and got[("2", "B TOWN")] == "duplicate"
    assert got[("3", "AUSTIN")] == "null"
    assert got[("4", "AUSTIN")] == "null"
    assert got[("A5", "AUSTIN")] == "alpha"
    assert got[("6", "AUSTIN")] == "number"
    assert got[("7", "AUSTIN")] == "pep"
    assert got[("8", "AUSTIN")] == "sanctioned"
    assert got[("9", "AUSTIN")] == "negative_income"
    assert got[("10", "AUSTIN")] == "null"
    assert got[("11-1", "AUSTIN")] is None
    assert got[("12", "AUSTIN")] is None
    texts = {r["reason_code"]: r["Rejection_Reason"] for r in checked.collect() if r["reason_code"]}
    assert texts["duplicate"] == fixed.CUSTOMER_DUPLICATE
    assert texts["sanctioned"] == fixed.CUSTOMER_SANCTIONED
    ids = sorted((r["CUSTOMER_ID"] for r in ingest.customer_stage(checked).collect()), key=str)
    assert ids == sorted([1, 2, 12, None], key=str)  # '11-1' is accepted but is no number


def test_exact_copies_vanish(spark):
    rows = [_good("1"), _good("1"), _good("1")]
    checked = ingest.check_customers(_cust(spark, rows), _sanct(spark, "X"), Settings())
    assert checked.count() == 1
    assert checked.first()["reason_code"] is None


def test_null_key_rows_are_one_group(spark):
    rows = [_good(None, CITY="A"), _good(None, CITY="B")]
    checked = ingest.check_customers(_cust(spark, rows), _sanct(spark, "X"), Settings())
    got = {r["CITY"]: r["reason_code"] for r in checked.collect()}
    assert got == {"A": "null", "B": "duplicate"}


def test_account_rules(spark):
    rows = [
        ("1", "501", "370000000000001", "01-Jun-19", None, "5", "0"),
        ("1", "501", "370000000000001", "01-Jun-19", None, "6", "0"),      # duplicate key ('5' < '6' kept)
        ("2", "502", "370000000000002", "01-Jun-19", None, None, "0"),     # null
        ("3", "503", "370000000000003", "01-Jun-19", "01-Jan-23", "5", "0"),  # closed
        ("4", "504", "370000000000004", "01-Jun-19", None, "x", "0"),      # special
        ("5", "5-05", "370000000000005", "01-Jun-19", None, "5", "0"),     # '-' is special here
        ("6", "506", "37000000000006", "01-Jun-19", None, "5", "0"),       # card length 14
        ("7", "507", "370000000000007", "n/a", None, "5", "0"),            # accepted, open date NULL
    ]
    checked = ingest.check_accounts(spark.createDataFrame(rows, ACCOUNT_DDL))
    got = {(r["cust_id"], r["acct_cycle_dt"]): r["reason_code"] for r in checked.collect()}
    assert got[("1", "5")] is None and got[("1", "6")] == "duplicate"
    assert got[("2", None)] == "null"
    assert got[("3", "5")] == "closed"
    assert got[("4", "x")] == "special"
    assert got[("5", "5")] == "special"
    assert got[("6", "5")] == "card"
    assert got[("7", "5")] is None
    stage = {r["cust_id"]: r for r in ingest.account_stage(checked).collect()}
    assert stage[1]["acct_open_dt"] == dt.date(2019, 6, 1)
    assert stage[7]["acct_open_dt"] is None
    assert stage[1]["acct_cycle_dt"] == 5


def test_transaction_rules(spark):
    d = dt.date(2020, 1, 1)
    rows = [
        (1, 501, 370000000000001, d, 10.0, "LOW", "PLACE", "Y"),
        (1, 501, 370000000000001, d, 5.0, "LOW", "PLACE", "Y"),            # same account: 5.0 kept
        (2, 502, 370000000000002, d, 10.0, None, "PLACE", "Y"),           # null
        (3, 503, 370000000000003, d, 10.0, "3-MEDIUM", "PLACE", "Y"),     # digit in purpose
    ]
    checked = ingest.check_transactions(spark.createDataFrame(rows, TRANSACTION_DDL))
    got = {(r["Cust_Id"], r["Transaction_Amount"]): r["reason_code"] for r in checked.collect()}
    assert got == {(1, 5.0): None, (1, 10.0): "duplicate", (2, 10.0): "null", (3, 10.0): "number"}


def test_metrics_boundaries(spark):
    s = Settings(as_of=dt.date(2024, 1, 1))
    as_of = dt.date(2024, 1, 1)
    rows = []
    for i, (days, defaulted, income, amount) in enumerate([
            (364, 0, 999999.0, 100.0), (365, 1, 1000000.0, 100.0), (719, 2, 1999999.0, 100.0),
            (720, 3, 2000000.0, 56000.0), (800, 0, 3000000.0, 56000.01), (800, 0, 3000000.0, 5000000.0)]):
        rows.append((i, 500 + i, 370 + i, as_of, amount, "LOW", "PLACE", "Y",
                     as_of - dt.timedelta(days=days), None, 1, defaulted,
                     "A", None, "B", as_of, None, "S", "ST", "C", "CO", "1", "TRUE", income, 1990, 1))
    schema = ("Cust_Id long, Account_Num long, Card_Num long, Transaction_Dt date, Transaction_Amount double, "
              "Transaction_Purpose string, Transaction_Place string, Opt_EMI string, Acct_open_dt date, "
              "Acct_close_dt date, Acct_Cycle_dt int, Defaulted int, FIRST_NAME string, MIDDLE_NAME string, "
              "LAST_NAME string, DOB date, ADDRESS1 string, ADDRESS2 string, STATE string, CITY string, "
              "COUNTRY string, PIN_CODE string, CUST_PEP_EXPOSED string, ANNUAL_INCOME double, YEAR int, MONTH int")
    m = {r["Cust_Id"]: r for r in transform.metrics(spark.createDataFrame(rows, schema), s).collect()}
    assert [m[i]["CS_Metric_1"] for i in range(6)] == [200, 400, 400, 500, 500, 500]
    assert [m[i]["CS_Metric_2"] for i in range(6)] == [100, 50, 50, 0, 100, 100]
    assert [m[i]["CS_Metric_3"] for i in range(6)] == [100, 200, 200, 400, 500, 500]
    assert m[0]["Credit_Score"] == 400
    assert m[4]["EMI_Eligible"] == "Y" and m[3]["EMI_Eligible"] == "N"   # 56,000 is not > 56,000
    assert m[5]["Cust_credit_limit_remaining"] == 1000000.0
    r = 9 / 1200
    emi = 56000.01 * r * (1 + r) ** 3 / ((1 + r) ** 3 - 1)
    assert abs(m[4]["EMI_3_month"] - emi) < 1e-6
    assert m[0]["Cust_credit_limit_used"] == m[0]["Credit_Limit"]
    assert transform.within_limit(transform.metrics(spark.createDataFrame(rows, schema), s)).count() == 6
    closed = transform.metrics(spark.createDataFrame([(*rows[4][:9], as_of, *rows[4][10:])], schema), s).first()
    assert closed["Acct_Active"] == "N" and closed["Customer_Since"] is None and closed["EMI_Eligible"] == "N"


def test_an_unreadable_close_date_closes_the_account(spark):
    d = dt.date(2020, 1, 1)
    txn = spark.createDataFrame([(i, 500 + i, 370 + i, d, 10.0, "LOW", "PLACE", "Y") for i in range(3)], TRANSACTION_DDL)
    acct = spark.createDataFrame([(0, 500, 370, d, None, 1, 0), (1, 501, 371, d, "no date", 1, 0), (2, 502, 372, d, "01-Feb-21", 1, 0)],
                                 "cust_id long, Account_num long, card_num long, acct_open_dt date, acct_close_dt string, "
                                 "acct_cycle_dt int, defaulted int")
    joined = transform.join_accounts(txn, acct).withColumn("ANNUAL_INCOME", F.lit(1000.0))
    got = {r["Cust_Id"]: r for r in transform.metrics(joined, Settings(as_of=dt.date(2024, 1, 1))).collect()}
    assert [got[i]["Acct_Active"] for i in range(3)] == ["Y", "N", "N"]
    assert got[1]["Acct_close_dt"] is None and got[1]["Customer_Since"] is None and got[0]["Customer_Since"] == 1461


def test_transaction_history_key(spark):
    d = dt.date(2020, 1, 1)
    rows = [(1, 501, 370000000000001, d, 10.0, "LOW", "PLACE", "Y"),
            (1, 501, 370000000000001, d + dt.timedelta(days=1), 5.0, "LOW", "PLACE", "Y")]
    raw = spark.createDataFrame(rows, TRANSACTION_DDL)
    assert ingest.transaction_stage(ingest.check_transactions(raw)).count() == 1
    history = ("Cust_Id", "Account_Num", "Transaction_Dt", "Transaction_Amount")
    assert ingest.transaction_stage(ingest.check_transactions(raw, history)).count() == 2
