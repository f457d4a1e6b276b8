"""Counts of FIXTURES.md at sf 0.001 and 0.01, plus conservation."""

import pytest

from conftest import SF0001, SF001
from cardflow.registry import SETTINGS
from cardflow.plans import ingest, reports, transform
from cardflow.sources import fixtures as fx

EXPECTED = {
    SF0001: dict(cust={"duplicate": 3, "null": 6, "alpha": 2, "number": 4, "pep": 13, "sanctioned": 23,
                       "negative_income": 10, None: 92},
                 acct={"duplicate": 5, "null": 8, "closed": 15, "special": 3, "card": 7, None: 155},
                 txn={"duplicate": 1314, "null": 4, "number": 8, None: 174},
                 orphans=88, inter=86, geo=20, emi=31, thr=10, prev=(86, 15)),
    SF001: dict(cust={"duplicate": 30, "null": 54, "alpha": 16, "number": 34, "pep": 129, "sanctioned": 252,
                      "negative_income": 84, None: 931},
                acct={"duplicate": 39, "null": 65, "closed": 140, "special": 45, "card": 54, None: 1571},
                txn={"duplicate": 13130, "null": 85, "number": 93, None: 1692},
                orphans=824, inter=830, geo=20, emi=261, thr=86, prev=(830, 148)),
}


def _by_code(df):
    return {r["reason_code"]: r["count"] for r in df.groupBy("reason_code").count().collect()}


@pytest.mark.parametrize("d", [SF0001, SF001])
def test_counts(spark, d):
    e = EXPECTED[d]
    cc = ingest.check_customers(fx.raw_customers(spark, d), fx.raw_sanctioned(spark, d), SETTINGS)
    ca = ingest.check_accounts(fx.raw_accounts(spark, d))
    ct = ingest.check_transactions(fx.raw_transactions(spark, d))
    assert _by_code(cc) == e["cust"]
    assert _by_code(ca) == e["acct"]
    assert _by_code(ct) == e["txn"]
    stages = (ingest.transaction_stage(ct), ingest.account_stage(ca), ingest.customer_stage(cc))
    assert transform.orphans(transform.enrich(*stages)).count() == e["orphans"]
    inter = transform.intermediate(*stages, SETTINGS).cache()
    assert inter.count() == e["inter"]
    assert len(inter.columns) == 47
    assert reports.geography(inter).count() == e["geo"]
    assert reports.emi_offers(inter, SETTINGS).count() == e["emi"]
    assert reports.credit_threshold(inter, SETTINGS).count() == e["thr"]
    prev = reports.previous_transaction(inter)
    assert (prev.count(), prev.filter("PREVIOUS_TRANSACTION IS NOT NULL").count()) == e["prev"]
    inter.unpersist()


def test_conservation(spark):
    """distinct input = accepted + rejected, and no row is both."""
    d = SF001
    raw = ingest.normalize_customers(fx.raw_customers(spark, d))
    cc = ingest.check_customers(fx.raw_customers(spark, d), fx.raw_sanctioned(spark, d), SETTINGS).cache()
    acc = ingest.accepted(cc)
    rej = ingest.rejected(cc).drop("Rejection_Reason", "reason_code")
    assert raw.distinct().count() == acc.count() + rej.count()
    assert acc.intersect(rej).count() == 0
    cc.unpersist()
