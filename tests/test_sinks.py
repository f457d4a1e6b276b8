"""Written tables keep the reference's layout: partitions, buckets, sort."""

import os
import re
import uuid

from pyspark.sql import functions as F

from conftest import SF0001
from cardflow.config import Settings
from cardflow.plans import sinks
from cardflow.registry import SETTINGS, QUERIES
from cardflow.session import scratch_path


def _describe(spark, table):
    return {r["col_name"].strip(): (r["data_type"] or "").strip()
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def test_customer_stage_layout(spark):
    root = scratch_path(spark, "t-sinks")
    db = f"cardflow_s_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, db, f"{root}/it's a db")
    stage = QUERIES["customer_stage"](spark, SF0001)
    t = sinks.write_customer_stage(stage, db, f"{root}/it's here", sinks.sized_buckets(100, SETTINGS))
    d = _describe(spark, t)
    assert d["Num Buckets"] == "4"
    assert "CUSTOMER_ID" in d["Bucket Columns"] and "CUSTOMER_ID" in d["Sort Columns"]
    assert d["Type"] == "EXTERNAL" and d["Provider"] == "parquet"
    parts = [r["COUNTRY"] for r in spark.sql(f"SHOW PARTITIONS {t}").selectExpr(
        "split(split(partition, '/')[0], '=')[1] AS COUNTRY").collect()]
    assert sorted(set(parts)) == ["AFRICA", "ASIA", "EUROPE", "MIDDLE EAST"]   # AMERICA is sanctioned
    assert spark.table(t).count() == stage.count()


def test_reject_table_partitioned_by_code(spark):
    root = scratch_path(spark, "t-sinks")
    db = f"cardflow_r_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, db, f"{root}/_db")
    t = sinks.write_rejects(QUERIES["customer_rejects"](spark, SF0001), db, f"{root}/rejects", "customer_rejects")
    codes = {r["partition"].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()}
    assert codes == {"duplicate", "null", "alpha", "number", "pep", "sanctioned", "negative_income"}


def test_buckets_follow_the_rows():
    from cardflow.config import Settings
    assert sinks.sized_buckets(1000, Settings()) == 4
    assert sinks.sized_buckets(10 ** 9, Settings()) == 500
    assert sinks.sized_buckets(10 ** 9, Settings(buckets=7)) == 7


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_files_follow_rows_directories_and_the_target(spark, tmp_path, monkeypatch):
    """Small directories give one file each; a hot one is cut into files of the target size by several tasks."""
    monkeypatch.setattr(sinks, "ROWS_PER_TASK", 500)
    monkeypatch.setattr(sinks, "ROWS_PER_BUCKET", 500)
    df = spark.range(6000).select(F.col("id").alias("Cust_Id"), F.when(F.col("id") < 4000, "hot").otherwise(
        F.concat(F.lit("d"), F.col("id") % 40)).alias("STATE"))
    buckets = sinks.directory_buckets(df, ["STATE"], Settings())
    assert buckets == 1                                                # 6000 rows in 41 directories
    db = f"cardflow_f_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, db, str(tmp_path / "db"))
    for buckets in (1, 3):
        path = str(tmp_path / f"t{buckets}")
        sinks.save_table(df, f"{db}.t{buckets}", path, ["STATE"], "Cust_Id", buckets)
        files = _files(path)
        hot = [f for f in files if "STATE=hot" in f]
        assert len(files) - len(hot) == 40 * buckets                   # one file per small directory and bucket
        assert 4000 // 500 // 2 <= len(hot) <= 4 * (4000 // 500)
        sizes = [spark.read.parquet(f).count() for f in hot]
        assert sum(sizes) == 4000 and max(sizes) <= 1000
        assert len({re.search(r"part-(\d+)", f).group(1) for f in hot}) >= 4      # several write tasks
        assert spark.table(f"{db}.t{buckets}").count() == 6000
    sinks.drop_database(spark, db)


def test_small_buckets_are_not_cut_finer_than_directories(spark):
    assert sinks.sized_buckets(10 ** 9, Settings(), directories=1000) == 1
    assert sinks.sized_buckets(10 ** 11, Settings(), directories=1000) == 50
    assert sinks.sized_buckets(10 ** 11, Settings(buckets=4), directories=1000) == 4
