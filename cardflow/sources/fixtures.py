"""Raw domain tables derived, by Spark, from the driver's TPC-H-like tables.

The reference ships no input files; these mappings give every rule and every
report rows to work on, and they grow with the source tables.  `k` is
`c_custkey`, `o` is `o_orderkey`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.sources.tables import table

# Fixed values of the fixture mapping (dates, card and account number bases).
DOB_BASE = "1950-01-01"
ACCOUNT_OPEN_BASE = "2019-06-01"
FIRST_ACCOUNT_BASE = 500000
SECOND_ACCOUNT_BASE = 900000
FIRST_CARD_BASE = 370000000000000
SECOND_CARD_BASE = 371000000000000
UNKNOWN_CARD = 999999999999999
SANCTIONED_REGION = "AMERICA"

CUSTOMER_COLUMNS = ["CUSTOMER_ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "DOB", "ADDRESS1", "ADDRESS2",
                    "STATE", "CITY", "COUNTRY", "PIN_CODE", "CUST_PEP_EXPOSED", "ANNUAL_INCOME"]
ACCOUNT_COLUMNS = ["cust_id", "Account_num", "card_num", "acct_open_dt", "acct_close_dt", "acct_cycle_dt",
                   "defaulted"]
TRANSACTION_COLUMNS = ["Cust_Id", "Account_Num", "Card_Num", "Transaction_Dt", "Transaction_Amount",
                       "Transaction_Purpose", "Transaction_Place", "Opt_EMI"]


def _m(c: Column, n: int, r: int) -> Column:
    return (c % n) == r


def _s(c: Column) -> Column:
    return c.cast("string")


def _copies(k: Column, changed: tuple[int, int], exact: tuple[int, int]) -> Column:
    """Copy number of each source row, exploded in one scan: 0 = the row,
    1 = a changed copy when k % n = r, 2 = an exact copy when k % n = r."""
    return F.explode(F.array_compact(F.array(
        F.lit(0), F.when(_m(k, *changed), F.lit(1)), F.when(_m(k, *exact), F.lit(2)))))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer file: customer x nation x region, plus a changed copy
    (duplicate key) for k%50=7 and an exact copy for k%60=11."""
    geo = (table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"),
                                               F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    # A customer without a nation stays (its country is NULL, which a rule rejects).
    # nation x region is a dimension of a few rows: the planner broadcasts it
    # from its file-size statistics, no hint or extra job needed.
    base = cust.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = base.withColumn("_copy", _copies(F.col("c_custkey"), (50, 7), (60, 11)))
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    dob_days = ((k * 37) % 18000).cast("int")
    return rows.select(
        F.when(_m(k, 97, 5), F.concat(F.lit("A"), _s(k)))
         .when(_m(k, 101, 9), F.concat(_s(k), F.lit("-1")))
         .otherwise(_s(k)).alias("CUSTOMER_ID"),
        F.when(_m(k, 41, 3), F.lit(None).cast("string"))
         .when(_m(k, 43, 4), F.lit("Cust0mer"))
         .otherwise(F.lit("Customer")).alias("FIRST_NAME"),
        F.when(_m(k, 3, 0), F.lit(None).cast("string")).otherwise(seg).alias("MIDDLE_NAME"),
        seg.alias("LAST_NAME"),
        F.when(_m(k, 89, 6), F.lit("1990/01/01"))
         .otherwise(F.date_format(F.date_add(F.lit(DOB_BASE).cast("date"), dob_days), "dd-MM-yyyy")).alias("DOB"),
        F.lit(None).cast("string").alias("ADDRESS1"),
        F.lit("STREET").alias("ADDRESS2"),
        seg.alias("STATE"),
        F.concat(F.col("r_name"), F.when(F.col("_copy") == 1, F.lit(" TOWN")).otherwise(F.lit(" CITY"))).alias("CITY"),
        F.lower(F.col("r_name")).alias("COUNTRY"),
        F.lpad(_s(F.col("c_nationkey")), 6, "1").alias("PIN_CODE"),
        F.when(_m(k, 11, 2), F.lit("false")).otherwise(F.lit("true")).alias("CUST_PEP_EXPOSED"),
        (F.col("c_acctbal") * 400).cast("double").alias("ANNUAL_INCOME"),
    )


def raw_sanctioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sanctioned-country list: a line for every customer of the region named
    AMERICA, so the list repeats its one name and grows with the customers."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").filter(F.col("r_name") == SANCTIONED_REGION), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("r_name").alias("COUNTRY"))


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw account file, all strings: one account per customer, a second one
    for k%4=0; a copy with another cycle day for k%45=6 (duplicate key) and an
    exact copy for k%60=11."""
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    accts = cust.withColumn("_second", F.explode(F.array_compact(F.array(
        F.lit(False), F.when(_m(k, 4, 0), F.lit(True))))))
    rows = accts.withColumn("_copy", _copies(k, (45, 6), (60, 11)))
    second = F.col("_second")
    card = _s(F.when(second, F.lit(SECOND_CARD_BASE) + k).otherwise(F.lit(FIRST_CARD_BASE) + k))
    open_days = ((k * 53) % 1650).cast("int")
    cycle = (F.when(_m(k, 29, 4), F.lit(None).cast("string"))
             .when(_m(k, 37, 9), F.lit("x"))
             .when(F.col("_copy") == 1, _s(1 + (k + 1) % 28))
             .otherwise(_s(1 + k % 28)))
    return rows.select(
        _s(k).alias("cust_id"),
        _s(F.when(second, F.lit(SECOND_ACCOUNT_BASE) + k).otherwise(F.lit(FIRST_ACCOUNT_BASE) + k)).alias("Account_num"),
        F.when(_m(k, 31, 8), F.substring(card, 1, 14)).otherwise(card).alias("card_num"),
        F.when(_m(k, 83, 10), F.lit("n/a"))
         .otherwise(F.date_format(F.date_add(F.lit(ACCOUNT_OPEN_BASE).cast("date"), open_days), "dd-MMM-yy"))
         .alias("acct_open_dt"),
        F.when(_m(k, 13, 1), F.lit("01-Jan-23")).otherwise(F.lit(None).cast("string")).alias("acct_close_dt"),
        cycle.alias("acct_cycle_dt"),
        _s(k % 5).alias("defaulted"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str, year_shift: int = 0) -> DataFrame:
    """Raw transaction file from orders (typed as the reference's schema,
    with long ids).  `year_shift` moves dates so that a two-digit-year text
    layout reads them back in the same century."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                              "o_orderpriority")
    ok, c = F.col("o_orderkey"), F.col("o_custkey")
    second = _m(c, 4, 0) & _m(ok, 2, 1)
    dt = F.to_date(F.col("o_orderdate"))
    if year_shift:
        dt = F.add_months(dt, 12 * year_shift)
    return o.select(
        c.cast("long").alias("Cust_Id"),
        F.when(second, F.lit(SECOND_ACCOUNT_BASE) + c).otherwise(F.lit(FIRST_ACCOUNT_BASE) + c).cast("long")
         .alias("Account_Num"),
        F.when(_m(ok, 17, 3), F.lit(UNKNOWN_CARD))
         .when(second, F.lit(SECOND_CARD_BASE) + c)
         .otherwise(F.lit(FIRST_CARD_BASE) + c).cast("long").alias("Card_Num"),
        dt.alias("Transaction_Dt"),
        F.col("o_totalprice").cast("double").alias("Transaction_Amount"),
        F.when(_m(ok, 23, 5), F.lit(None).cast("string"))
         .when(_m(ok, 19, 2), F.col("o_orderpriority"))
         .otherwise(F.substring(F.col("o_orderpriority"), 3, 1 << 30)).alias("Transaction_Purpose"),
        F.lit("PLACE").alias("Transaction_Place"),
        F.when(~_m(ok, 3, 0), F.lit("Y")).otherwise(F.lit("N")).alias("Opt_EMI"),
    )
