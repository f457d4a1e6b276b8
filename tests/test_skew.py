"""A customer holding most transactions: AQE splits the hot join partition,
and the dedup and lag operators keep the hot key off a single task."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cardflow.plans import sinks, transform
from cardflow.session import scratch_path


@pytest.mark.parametrize("written", [False, True])
def test_hot_customer_join_is_split(spark, written):
    """Also when the customers come from their bucketed stage table, read as the
    run's own steps read it."""
    n = 60000
    d = dt.date(2020, 1, 1)
    # 2/3 of the transactions belong to customer 0 (one account per transaction).
    txn = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id")).alias("Cust_Id"),
        F.col("id").alias("Account_Num"), F.col("id").alias("Card_Num"), F.lit(d).alias("Transaction_Dt"),
        F.lit(10.0).alias("Transaction_Amount"), F.lit("LOW").alias("Transaction_Purpose"),
        F.lit("PLACE").alias("Transaction_Place"), F.lit("Y").alias("Opt_EMI"))
    acct = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id")).alias("cust_id"),
        F.col("id").alias("Account_num"), F.col("id").alias("card_num"), F.lit(d).alias("acct_open_dt"),
        F.lit(None).cast("string").alias("acct_close_dt"), F.lit(1).alias("acct_cycle_dt"),
        F.lit(0).alias("defaulted"))
    cust = spark.range(n).select(
        F.col("id").alias("CUSTOMER_ID"), F.lit("A").alias("FIRST_NAME"), F.lit(None).cast("string").alias("MIDDLE_NAME"),
        F.lit("B").alias("LAST_NAME"), F.lit(d).alias("DOB"), F.lit(None).cast("string").alias("ADDRESS1"),
        F.lit("S").alias("ADDRESS2"), F.lit("ST").alias("STATE"), F.lit("C").alias("CITY"), F.lit("CO").alias("COUNTRY"),
        F.lit("1").alias("PIN_CODE"), F.lit("TRUE").alias("CUST_PEP_EXPOSED"), F.lit(5e6).alias("ANNUAL_INCOME"),
        F.lit(1990).alias("YEAR"), F.lit(1).alias("MONTH"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        if written:
            root, db = scratch_path(spark, "t-skew"), f"cardflow_h_{uuid.uuid4().hex[:8]}"
            sinks.create_database(spark, db, f"{root}/_db")
            t = sinks.write_customer_stage(cust, db, f"{root}/customer_stage", 4)
            cust = sinks.read_files(spark, t, f"{root}/customer_stage")
        joined = transform.join_customers(transform.join_accounts(txn, acct), cust)
        assert len(joined.collect()) == n   # runs this plan, so the adaptive plan is final
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
