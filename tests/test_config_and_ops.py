"""Settings from the parameter file, and the generic operators."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cardflow.config import Settings
from cardflow.operators import sets
from cardflow.operators.dedup import first_per_key, flag_first_per_key
from cardflow.operators.joins import broadcast_if_small

# The reference's parameter file (paths replaced).
CONFIG = """Parameter,Value
Annual_Income_Limit1,1000000
Annual_Income_Limit2,2000000
Annual_Income_Limit3,3000000
Annual_Income_Score1,100
Annual_Income_Score2,200
Annual_Income_Score3,400
Annual_Income_Score4,500
Credit_Limit_Multiplier,2
InputFilePath,/in
TempFilePath,/tmp-out
OutputFilePath,/out
RejectFilePath,/out/rejects
Month_EMI_Percentage_3,9
Month_EMI_Percentage_6,11
Month_EMI_Percentage_9,13
Inter_Table_Path,/out/inter
DatabaseName,cards
Date_Format_trn,dd/MM/yyyy
TransactionOPPath,/out/txn
Cred_Notify_Threshold,75
"""


def test_settings_from_csv(spark):
    d = tempfile.mkdtemp(prefix="cardflow-cfg-")
    p = os.path.join(d, "Config.csv")
    with open(p, "w") as f:
        f.write(CONFIG)
    s = Settings.from_csv(spark, p)
    assert s.income_limits == (1000000, 2000000, 3000000)
    assert s.income_scores == (100, 200, 400, 500)
    assert s.credit_limit_multiplier == 2
    assert s.emi_percentages == ((3, 9), (6, 11), (9, 13))
    assert s.notify_threshold == 75
    assert s.database == "cards" and s.output_path == "/out" and s.transaction_path == "/out/txn"


def test_first_per_key_orders_nulls_last_and_numbers_numerically(spark):
    df = spark.createDataFrame([("a", None, 10.0), ("a", "x", 9.5), ("b", "y", 10.0), ("b", "y", 9.0),
                                ("c", None, None)], "k string, s string, v double")
    got = {r["k"]: (r["s"], r["v"]) for r in first_per_key(df, ["k"]).collect()}
    assert got == {"a": ("x", 9.5), "b": ("y", 9.0), "c": (None, None)}
    flags = flag_first_per_key(df, ["k"]).groupBy("is_first").count().collect()
    assert {r["is_first"]: r["count"] for r in flags} == {True: 3, False: 2}


def test_first_per_key_hot_key(spark):
    """One key holding most rows: still one winner, every other row flagged."""
    n = 20000
    df = spark.range(n).select(F.when(F.col("id") < n * 2 // 3, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               (F.col("id") * 7 % 1000).alias("v"))
    f = flag_first_per_key(df, ["k"])
    assert f.filter("is_first AND k = 0").collect()[0]["v"] == 0
    assert f.filter("is_first").count() == 1 + (n - n * 2 // 3)


def test_broadcast_if_small_and_sets(spark):
    small = spark.range(5)
    big = spark.range(50)
    assert "ResolvedHint" in small.hint("broadcast")._jdf.queryExecution().analyzed().toString()
    assert broadcast_if_small(big, 100) is big
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (None,)], "x int")
    assert sorted(r.x for r in sets.subtract(a, b).collect()) == [1]
    assert sets.union_all([a, b]).count() == 6


def test_cluster_conf_sizes_partitions():
    from cardflow.session import cluster_conf
    c = cluster_conf(100 << 40, executor_cores=4, executors=1000)      # 100 TB on 4,000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    small = cluster_conf(1 << 30, executor_cores=4, executors=10)      # 1 GB: at least 2 waves
    assert int(small["spark.sql.shuffle.partitions"]) == 80


def test_broadcast_counts_distinct_rows(spark):
    small = spark.range(3000).selectExpr("id % 3 as c").distinct()        # repeats do not count
    assert "ResolvedHint" in broadcast_if_small(small, 100)._jdf.queryExecution().analyzed().toString()
    assert broadcast_if_small(small, 10) is small


def test_dedup_treats_signed_zero_and_nan_as_one_value(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", -0.0), ("b", float("nan")), ("b", float("nan")), ("c", None)],
                               "k string, v double")
    f = flag_first_per_key(df, ["k"]).collect()
    assert sorted(r["k"] for r in f) == ["a", "b", "c"]
    assert all(r["is_first"] for r in f)
    assert [r["v"] for r in f if r["k"] == "a"] == [0.0]


def test_unknown_parameters_are_warned_of(spark, tmp_path):
    import warnings
    from cardflow.config import Settings
    config = tmp_path / "Config.csv"
    config.write_text("Parameter,Value\nCred_Notify_Threshold,60\nDate_Format_trn,dd/MM/yyyy\nNotify_Treshold,5\n")
    with pytest.warns(UserWarning, match="unknown parameters: Notify_Treshold$"):
        assert Settings.from_csv(spark, str(config)).notify_threshold == 60
    config.write_text("Parameter,Value\nCred_Notify_Threshold,60\nDate_Format_trn,dd/MM/yyyy\n")
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        Settings.from_csv(spark, str(config))
