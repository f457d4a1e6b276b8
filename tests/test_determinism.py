"""Same results with 1, 2 and 8 shuffle partitions and a reshuffled input."""

from conftest import SF0001
from cardflow.plans import ingest
from cardflow.registry import QUERIES
from cardflow.sources import fixtures as fx


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_partitions_do_not_change_results(spark):
    keys = ["customer_rejects", "account_rejects", "transaction_rejects", "intermediate",
            "report_previous_transaction"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = {}
    try:
        for n in ("1", "2", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results[n] = {k: _rows(QUERIES[k](spark, SF0001)) for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results["1"] == results["2"] == results["8"]


def test_input_order_does_not_change_results(spark):
    raw = fx.raw_transactions(spark, SF0001)
    a = _rows(ingest.check_transactions(raw))
    b = _rows(ingest.check_transactions(raw.repartition(7).sortWithinPartitions("Transaction_Amount")))
    assert a == b
