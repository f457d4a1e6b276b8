"""Tables derived from the intermediate one: only changed years are rewritten."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF0001
from cardflow.plans import incremental, reports, runner, sinks
from cardflow.registry import SETTINGS
from cardflow.session import materialize


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path)
            for f in names if f.startswith("part-")}


def test_only_changed_years_are_recomputed(spark):
    db = f"cardflow_i_{uuid.uuid4().hex[:8]}"
    res = runner.run_steps(spark, runner.inputs_from_tables(spark, SF0001), SETTINGS, database=db)
    table, path = res.tables["intermediate"], res.paths["intermediate"]
    assert incremental.refresh(spark, db) == []
    years = sorted(r[0] for r in spark.table(table).select("YEAR").distinct().collect())
    changed, gone = years[3], years[5]
    rows = materialize(res.files(spark, "intermediate"), "t-inter")
    before = _files(f"{path}_previous") | _files(f"{path}_geography")

    # one year gets a customer's second card and other incomes, another loses its rows
    more = rows.filter(F.col("YEAR") == changed).withColumn("ANNUAL_INCOME", F.col("ANNUAL_INCOME") / 3)
    more = more.unionByName(more.withColumns({"Card_Num": F.col("Card_Num") + 1, "Transaction_Amount": F.lit(12.345678)}))
    incremental.replace_partitions(more, table)
    for r in rows.filter(F.col("YEAR") == gone).select("COUNTRY", "STATE").distinct().collect():
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (YEAR = {gone}, COUNTRY = '{r[0]}', STATE = '{r[1]}')")
    assert incremental.refresh(spark, db) == [changed, gone]

    after = _files(f"{path}_previous") | _files(f"{path}_geography")
    same = {f for f in before if f"YEAR={changed}" not in f}
    assert len(same) >= 2 * (len(years) - 1) and all(after[f] == before[f] for f in same)        # other years' files were not touched
    assert not any(f in after for f in before if f"YEAR={changed}" in f)
    whole = materialize(spark.table(table), "t-whole")
    assert whole.count() == rows.count() + rows.filter(F.col("YEAR") == changed).count() - rows.filter(F.col("YEAR") == gone).count()
    for view, full in (("previous_transaction", reports.previous_transaction(whole)), ("geography_summary", reports.geography(whole)),
                       ("geography_summary", reports.geography_from_states(reports.geography_states(whole)))):
        got = spark.table(res.views[view]).select(*full.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)   # bit for bit
    assert incremental.refresh(spark, db) == []
    sinks.drop_database(spark, db)
