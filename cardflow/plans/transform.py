"""Step 4: join accepted transactions with accounts and customers, split off
orphans, compute the credit metrics and build the intermediate table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.config import Settings
from cardflow.functions import credit, fixed
from cardflow.operators.joins import broadcast_if_small
from cardflow.operators.validate import CODE, REASON
from cardflow.session import materialize
from cardflow.sources.fixtures import TRANSACTION_COLUMNS


# Whether the account file gives a close date, readable or not.
CLOSED = "_closed"


def join_accounts(txn: DataFrame, accounts: DataFrame) -> DataFrame:
    """Left join on (customer, account, card); both sides are unique on the
    key, so this is a plain sort-merge (or AQE broadcast) equi-join."""
    a = accounts.select(
        F.col("cust_id").alias("_a_cust"), F.col("Account_num").alias("_a_acct"), F.col("card_num").alias("_a_card"),
        F.col("acct_open_dt").alias("Acct_open_dt"),
        F.try_to_date(F.col("acct_close_dt").cast("string"), fixed.ACCOUNT_DATE_FORMAT).alias("Acct_close_dt"),
        F.col("acct_close_dt").isNotNull().alias(CLOSED),
        F.col("acct_cycle_dt").alias("Acct_Cycle_dt"), F.col("defaulted").alias("Defaulted"))
    cond = ((txn["Cust_Id"] == a["_a_cust"]) & (txn["Account_Num"] == a["_a_acct"])
            & (txn["Card_Num"] == a["_a_card"]))
    return txn.join(a, cond, "left").drop("_a_cust", "_a_acct", "_a_card")


CUSTOMER_PART = ["FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "DOB", "ADDRESS1", "ADDRESS2", "STATE", "CITY",
                 "COUNTRY", "PIN_CODE", "CUST_PEP_EXPOSED", "ANNUAL_INCOME", "YEAR", "MONTH"]


def join_customers(txn: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join on the customer id.  Customers grow with the data, so no
    broadcast hint: the optimizer/AQE broadcasts when the side is small and
    splits skewed partitions of a hot customer otherwise."""
    c = customers.select(F.col("CUSTOMER_ID").alias("_c_id"), *CUSTOMER_PART)
    return txn.join(c, txn["Cust_Id"] == c["_c_id"], "left").drop("_c_id")


def enrich(txn: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    return join_customers(join_accounts(txn, accounts), customers)


def hot_customers(txn: DataFrame, buckets: int) -> DataFrame:
    """(Cust_Id) of the customers with more transactions than a fourth of an average bucket:
    at most 4 per bucket."""
    counts = materialize(txn.groupBy("Cust_Id").count(), "txn-counts")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    return counts.filter(F.col("count") * (4 * buckets) > total).select("Cust_Id")


def enrich_by_buckets(txn: DataFrame, accounts: DataFrame, customers: DataFrame, buckets: int) -> DataFrame:
    """`enrich` of tables that are all bucketed by the customer id: both joins read the buckets
    and nothing is shuffled (in a session where `co_partitioned` holds).  A bucket is one
    task, so the rows of hot customers leave it: they are joined by account and card, which
    cuts a customer over many tasks, and to the few rows of their customers."""
    hot = broadcast_if_small(materialize(hot_customers(txn, buckets), "hot-customers"))
    cold = enrich(txn.join(hot, "Cust_Id", "left_anti"), accounts, customers)
    few = customers.join(hot, F.col("CUSTOMER_ID") == F.col("Cust_Id"), "left_semi")
    own = accounts.withColumnRenamed("cust_id", "_own").join(hot, F.col("_own") == F.col("Cust_Id"), "left_semi")
    theirs = join_accounts(
        txn.join(hot, "Cust_Id", "left_semi").repartition(buckets, "Cust_Id", "Account_Num", "Card_Num"),
        own.withColumnRenamed("_own", "cust_id").repartition(buckets, "cust_id", "Account_num", "card_num"))
    return cold.unionByName(join_customers(theirs, broadcast_if_small(few)))


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """A bucket column that is a part of the join key is enough for a join of buckets."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _orphan(df: DataFrame):
    return F.col("Acct_open_dt").isNull() | F.col("FIRST_NAME").isNull()


def orphans(joined: DataFrame) -> DataFrame:
    """Transactions without a valid account (or a parseable open date) or
    without a valid customer."""
    return joined.filter(_orphan(joined)).select(
        F.lit(fixed.ORPHAN).alias(REASON), *TRANSACTION_COLUMNS, F.lit("orphan").alias(CODE))


def metrics(joined: DataFrame, s: Settings) -> DataFrame:
    """All derived columns of one enriched transaction (no filter)."""
    as_of = s.as_of_col()
    amount, income = F.col("Transaction_Amount"), F.col("ANNUAL_INCOME")
    tenure = F.datediff(as_of, F.col("Acct_open_dt"))
    limit = income * F.lit(float(s.credit_limit_multiplier))
    remaining = limit - amount
    cs1 = credit.tenure_score(tenure)
    cs2 = credit.default_score(F.col("Defaulted"))
    cs3 = credit.income_score(income, s)
    # closed by what the account file says, if the frame has it, else by the date read from it
    closed = F.col(CLOSED) if CLOSED in joined.columns else F.col("Acct_close_dt").isNotNull()
    is_open = ~F.coalesce(closed, F.lit(False))
    since = F.when(is_open, tenure)
    cols = {
        "Account_Current_Status": F.when(F.col("Defaulted") >= 1, "Y").otherwise("N"),
        "Credit_Limit": limit,
        "CS_Metric_1": cs1,
        "CS_Metric_2": cs2,
        "CS_Metric_3": cs3,
        "Credit_Score": cs3 + cs2 + cs1,
        "Cust_credit_limit_remaining": remaining,
        "Cust_credit_limit_used": remaining + amount,
        "Customer_Since": since,
        "Acct_Active": F.when(is_open, "Y").otherwise("N"),
        "DIff_Trans_Limit": remaining - amount,
        "EMI_Eligible": F.when((F.col("Opt_EMI") == "Y") & ((cs3 + cs2 + cs1) >= credit.EMI_MIN_SCORE)
                               & (since >= credit.EMI_MIN_TENURE_DAYS) & (amount > credit.EMI_MIN_AMOUNT)
                               & ((remaining - amount) > 0), "Y").otherwise("N"),
    }
    for months, pct in s.emi_percentages:
        num, den, emi = credit.emi_parts(amount, months, pct)
        cols[f"EMI_{months}_month_check1"] = num
        cols[f"EMI_{months}_month_check2"] = den
        cols[f"EMI_{months}_month"] = emi
    return joined.withColumns(cols)


def within_limit(df: DataFrame) -> DataFrame:
    """Keep transactions that do not exceed the credit limit."""
    return df.filter(F.col("Cust_credit_limit_remaining") >= 0)


def intermediate_columns(s: Settings) -> list:
    # Names, order and types of the 47 columns.
    emi = []
    for months, _ in s.emi_percentages:
        emi += [F.col(f"EMI_{months}_month_check1").cast("double"), F.col(f"EMI_{months}_month_check2").cast("double"),
                F.col(f"EMI_{months}_month").cast("double")]
    return [
        F.col("Cust_Id").cast("long"), F.col("Account_Num").cast("long"), F.col("Card_Num").cast("long"),
        F.col("Transaction_Dt").cast("date"), F.col("Transaction_Amount").cast("double"),
        F.col("Transaction_Purpose").cast("string"), F.col("Transaction_Place").cast("string"),
        F.col("Opt_EMI").cast("string"), F.col("Acct_open_dt").cast("date"), F.col("Acct_close_dt").cast("date"),
        F.col("Acct_Cycle_dt").cast("int"), F.col("Defaulted").cast("int"),
        F.col("FIRST_NAME").cast("string"), F.col("MIDDLE_NAME").cast("string"), F.col("LAST_NAME").cast("string"),
        F.col("DOB").cast("date"), F.col("ADDRESS1").cast("string"), F.col("ADDRESS2").cast("string"),
        F.col("STATE").cast("string"), F.col("CITY").cast("string"), F.col("COUNTRY").cast("string"),
        F.col("PIN_CODE").cast("string"), F.col("CUST_PEP_EXPOSED").cast("string"),
        F.col("ANNUAL_INCOME").cast("double"), F.col("YEAR").cast("int"), F.col("MONTH").cast("int"),
        F.col("Account_Current_Status").cast("string"), F.col("Credit_Limit").cast("double"),
        F.col("CS_Metric_1").cast("int"), F.col("CS_Metric_2").cast("int"), F.col("CS_Metric_3").cast("int"),
        F.col("Credit_Score").cast("int"), F.col("Cust_credit_limit_used").cast("double"),
        F.col("Cust_credit_limit_remaining").cast("double"), F.col("Customer_Since").cast("int"),
        F.col("Acct_Active").cast("string"), F.col("DIff_Trans_Limit").cast("double"),
        F.col("EMI_Eligible").cast("string"), *emi,
    ]


def valid_joined(joined: DataFrame) -> DataFrame:
    return joined.filter(~_orphan(joined))


def intermediate(txn: DataFrame, accounts: DataFrame, customers: DataFrame, s: Settings) -> DataFrame:
    """The 47-column enriched table: valid joins, metrics, within the limit."""
    joined = valid_joined(enrich(txn, accounts, customers))
    return within_limit(metrics(joined, s)).select(*intermediate_columns(s))
