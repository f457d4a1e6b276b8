"""Joins of tables that are bucketed by the customer id: no shuffle but for hot customers."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from cardflow.plans import runner, sinks, transform
from cardflow.registry import QUERIES, SETTINGS
from cardflow.session import scratch_path

OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def no_broadcasts(spark):
    before = {k: spark.conf.get(k, None) for k in OFF}
    for k, v in OFF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tables(spark, txn, acct, cust, buckets):
    root, db = scratch_path(spark, "t-buckets"), f"cardflow_k_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, db, f"{root}/_db")
    names = (sinks.write_transaction_stage(txn, db, f"{root}/t", buckets=buckets),
             sinks.write_account_stage(acct, db, f"{root}/a", buckets=buckets), sinks.write_customer_stage(cust, db, f"{root}/c", buckets))
    return db, [spark.table(n) for n in names]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_buckets_shuffle_nothing(spark, no_broadcasts):
    stages = [QUERIES[n](spark, SF0001) for n in ("transaction_valid", "account_stage", "customer_stage")]
    db, tables = _tables(spark, *stages, 16)
    with transform.co_partitioned(spark):
        cold = transform.enrich(*tables)
        plan = _plan(cold)
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        got = cold.collect()
    want = transform.enrich(*stages).select(*cold.columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    sinks.drop_database(spark, db)


def test_a_hot_customer_is_joined_by_account_and_card(spark, no_broadcasts):
    d = dt.date(2020, 1, 1)
    txn = spark.range(4000).select(
        F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("Cust_Id"), F.col("id").alias("Account_Num"),
        (F.col("id") + 1).alias("Card_Num"), F.lit(d).alias("Transaction_Dt"), F.lit(5.0).alias("Transaction_Amount"),
        *[F.lit("x").alias(c) for c in ("Transaction_Purpose", "Transaction_Place", "Opt_EMI")])
    acct = txn.select(F.col("Cust_Id").alias("cust_id"), F.col("Account_Num").alias("Account_num"), F.col("Card_Num").alias("card_num"),
                      F.lit(d).alias("acct_open_dt"), F.lit(None).cast("string").alias("acct_close_dt"), F.lit(1).alias("acct_cycle_dt"),
                      F.lit(0).alias("defaulted")).filter("Account_num % 5 != 0")
    cust = txn.select(F.col("Cust_Id").alias("CUSTOMER_ID")).distinct().filter("CUSTOMER_ID % 7 = 0")
    cust = cust.select("*", *[F.lit(d if c == "DOB" else 1 if c in ("YEAR", "MONTH") else 2.0 if c == "ANNUAL_INCOME" else "v").alias(c)
                              for c in transform.CUSTOMER_PART])
    db, tables = _tables(spark, txn, acct, cust, 8)
    assert [r[0] for r in transform.hot_customers(tables[0], 8).collect()] == [7]
    with transform.co_partitioned(spark):
        joined = transform.enrich_by_buckets(*tables, 8)
        plan = _plan(joined)
        # the only shuffles are those of the hot rows, by account and card too
        shuffles = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
        assert shuffles and all("Account" in ln and "card" in ln.lower() for ln in shuffles)
        got = joined.collect()
    want = transform.enrich(txn, acct, cust).select(*joined.columns).collect()
    assert len(got) == 4000 and sorted(map(str, got)) == sorted(map(str, want))
    sinks.drop_database(spark, db)


def test_a_run_with_co_partitioned_stages(spark):
    from dataclasses import replace
    db = f"cardflow_n_{uuid.uuid4().hex[:8]}"
    res = runner.run_steps(spark, runner.inputs_from_tables(spark, SF0001), replace(SETTINGS, co_partition=4), database=db)
    assert res.counts["intermediate"] == 86 and res.counts["orphans"] == 88
    sinks.drop_database(spark, db)
