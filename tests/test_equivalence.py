"""The single pass equals a chain of filters and EXCEPTs, one per rule."""

from pyspark.sql import functions as F

from conftest import SF001
from cardflow.operators.dedup import flag_first_per_key
from cardflow.plans import ingest
from cardflow.registry import SETTINGS
from cardflow.session import materialize
from cardflow.sources import fixtures as fx


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_customer_chain_equals_single_pass(spark):
    raw, listed = fx.raw_customers(spark, SF001), fx.raw_sanctioned(spark, SF001)
    base = ingest.normalize_customers(raw)
    names = [r["COUNTRY"] for r in ingest.sanctioned_list(listed).collect()]
    left = flag_first_per_key(base, ["CUSTOMER_ID"], ingest.FIRST).withColumn(
        "_sanctioned", F.coalesce(F.col("COUNTRY").isin(names), F.lit(False)))
    checked = ingest.check_customers(raw, listed, SETTINGS).cache()
    for rule in ingest.customer_rules(SETTINGS):
        hit = left.filter(rule.rejects)
        left = materialize(left.exceptAll(hit), "t-left")
        assert _rows(hit.select(*base.columns)) == _rows(
            checked.filter(F.col("reason_code") == rule.code).select(*base.columns)), rule.code
    assert _rows(left.select(*base.columns)) == _rows(checked.filter("reason_code IS NULL").select(*base.columns))
    checked.unpersist()
