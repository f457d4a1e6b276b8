"""All steps in one session: tables, views, observed counts."""

import datetime as dt
import os
import re
import threading
import uuid
from dataclasses import replace

import pytest

from conftest import SF0001
from cardflow.plans import reports, runner, sinks, transform
from cardflow.registry import AS_OF, SETTINGS
from cardflow.session import materialize
from cardflow.sources import csv, fixtures as fx


def test_run_steps_tables_views_and_counts(spark):
    res = runner.run_steps(spark, runner.inputs_from_tables(spark, SF0001), SETTINGS,
                           database=f"cardflow_t_{uuid.uuid4().hex[:8]}", cache=True)
    assert res.counts == {"customer_stage": 92, "customer_rejects": 61, "account_stage": 155,
                          "account_rejects": 38, "transaction_stage": 174, "transaction_rejects": 1326,
                          "orphans": 88, "intermediate": 86}
    for name, table in res.tables.items():
        assert spark.table(table).count() == res.counts[name]
    inter = spark.table(res.tables["intermediate"])
    assert inter.columns[-3:] == ["YEAR", "COUNTRY", "STATE"]          # partition columns move to the end
    assert spark.catalog.isCached(res.tables["intermediate"])
    assert not any(t.isTemporary for t in spark.catalog.listTables(res.database))
    assert spark.table(res.views["geography_summary"]).count() == 20
    assert spark.table(res.views["emi_offers"]).count() == 31
    assert spark.table(res.views["credit_threshold"]).count() == 10
    assert spark.table(res.views["previous_transaction"]).count() == 86
    sinks.drop_database(spark, res.database)
    assert not spark.catalog.databaseExists(res.database)


def test_run_steps_from_csv_files(spark):
    """The same steps on CSV files (the reference's inputs) give the same counts."""
    paths = {
        "customers": csv.stage(spark, fx.raw_customers(spark, SF0001), "t-cust"),
        "sanctioned": csv.stage(spark, fx.raw_sanctioned(spark, SF0001), "t-sanct"),
        "accounts": csv.stage(spark, fx.raw_accounts(spark, SF0001), "t-acct"),
        "transactions": csv.stage(spark, fx.raw_transactions(spark, SF0001, year_shift=10), "t-txn", "dd-MMM-yy"),
    }
    inputs = runner.RawInputs(csv.read_customers(spark, paths["customers"]),
                              csv.read_sanctioned(spark, paths["sanctioned"]),
                              csv.read_accounts(spark, paths["accounts"]),
                              csv.read_transactions(spark, paths["transactions"]))
    res = runner.run_steps(spark, inputs, SETTINGS, database=f"cardflow_c_{uuid.uuid4().hex[:8]}")
    assert res.counts["customer_stage"] == 92
    assert res.counts["intermediate"] == 86
    sinks.drop_database(spark, res.database)


def _stage_file(spark, df, folder, name, date_format=None):
    df.coalesce(1).write.option("header", True).options(**({"dateFormat": date_format} if date_format else {})).csv(
        os.path.join(folder, name))


def test_run_from_a_parameter_file(spark, tmp_path):
    """One call goes from the file and the raw CSVs to each table at its configured path."""
    inbox, out = tmp_path / "in", tmp_path / "out"
    _stage_file(spark, fx.raw_customers(spark, SF0001), str(inbox), "people.csv")
    _stage_file(spark, fx.raw_sanctioned(spark, SF0001), str(inbox), "sanctioned.csv")
    _stage_file(spark, fx.raw_accounts(spark, SF0001), str(inbox), "accounts.csv")
    _stage_file(spark, fx.raw_transactions(spark, SF0001, year_shift=10), str(inbox), "transactions.csv", "dd-MMM-yy")
    db = f"cardflow_p_{uuid.uuid4().hex[:8]}"
    lines = {"InputFilePath": inbox, "TempFilePath": out / "tmp", "OutputFilePath": out / "main",
             "RejectFilePath": out / "rejects", "Inter_Table_Path": out / "inter", "TransactionOPPath": out / "txn",
             "CustomerFile": "people.csv", "DatabaseName": db, "Cred_Notify_Threshold": 75}
    config = tmp_path / "Config.csv"
    config.write_text("Parameter,Value\n" + "".join(f"{k},{v}\n" for k, v in lines.items())
                      + "Cred_Notify_Threshold,10\n")                    # the first value counts
    res = runner.run_from_config(spark, str(config), root=str(out / "root"), as_of=AS_OF)
    assert res.paths["transaction_stage"] == str(out / "txn")
    assert res.paths["customer_rejects"] == str(out / "rejects" / "customer_rejects")
    for name, rows in {"customer_stage": 92, "customer_rejects": 61, "account_stage": 155, "account_rejects": 38,
                       "transaction_stage": 174, "transaction_rejects": 1326, "orphans": 88, "intermediate": 86}.items():
        assert spark.read.parquet(res.paths[name]).count() == rows == res.counts[name]
    assert spark.table(res.views["credit_threshold"]).count() == 10
    sinks.drop_database(spark, db)


def test_views_follow_the_intermediate_table(spark, tmp_path):
    db = f"cardflow_v_{uuid.uuid4().hex[:8]}"
    res = runner.run_steps(spark, runner.inputs_from_tables(spark, SF0001), SETTINGS, database=db)
    before = {n: spark.table(v).count() for n, v in res.views.items()}
    half = materialize(res.files(spark, "intermediate").orderBy("Cust_Id", "Card_Num").limit(50), "t-half")
    sinks.write_intermediate(half, db, res.paths["intermediate"], 4)
    after = {n: spark.table(v).count() for n, v in res.views.items()}
    assert before["previous_transaction"] == 86 and after["previous_transaction"] == 50
    assert all(after[n] < before[n] for n in before)
    sinks.drop_database(spark, db)


def test_buckets_bind_no_plan_of_the_run(spark):
    """With broadcasts off and 32 shuffle partitions, neither the joins over the stage
    tables nor a report over the intermediate run in as many tasks as a table has buckets."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    db = f"cardflow_b_{uuid.uuid4().hex[:8]}"
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        res = runner.run_steps(spark, runner.inputs_from_tables(spark, SF0001), SETTINGS, database=db)
        joined = transform.enrich(*[res.files(spark, n) for n in ("transaction_stage", "account_stage", "customer_stage")])
        totals = reports.card_totals(res.files(spark, "intermediate"))
        frames = [joined, totals, *[spark.table(v) for v in res.views.values()]]
        for df in frames:
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"hashpartitioning\([^)]*, 4\)", plan)
            assert "SelectedBucketsCount: 4 out of 4" not in plan.split("Initial Plan")[0] or "Exchange" not in plan
        assert "hashpartitioning" in totals._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        sinks.drop_database(spark, db)


def _tables(spark, db):
    """Rows of every published table, and the location of its files."""
    return {n: (spark.table(f"{db}.{n}").count(),
                next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{n}").collect() if r["col_name"] == "Location"))
            for n in runner.NAMES.values()}


def test_a_failed_run_leaves_the_tables_and_goes_on(spark, tmp_path, monkeypatch):
    """A run that dies in step 4 changes no published table; the next one starts at step 4."""
    root, db = str(tmp_path / "root"), f"cardflow_f_{uuid.uuid4().hex[:8]}"
    inputs = lambda: runner.inputs_from_tables(spark, SF0001)
    first = runner.run_steps(spark, inputs(), SETTINGS, root=root, database=db)
    before, views = _tables(spark, db), {n: spark.table(v).count() for n, v in first.views.items()}
    assert first.resumed == []

    whole = sinks.write_intermediate
    monkeypatch.setattr(sinks, "write_intermediate", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runner.run_steps(spark, inputs(), SETTINGS, root=root, database=db)
    assert _tables(spark, db) == before and {n: spark.table(v).count() for n, v in first.views.items()} == views

    monkeypatch.setattr(sinks, "write_intermediate", whole)
    for step in ("check_customers", "check_accounts", "check_transactions"):
        monkeypatch.setattr(runner.ingest, step, lambda *a: 1 / 0)
    second = runner.run_steps(spark, inputs(), SETTINGS, root=root, database=db)
    assert second.resumed == ["customers", "accounts", "transactions"] and second.counts == first.counts
    after = _tables(spark, db)
    assert {n: rows for n, (rows, _) in after.items()} == {n: rows for n, (rows, _) in before.items()}
    assert all(after[n][1] != before[n][1] for n in after)             # other files, the same names
    assert {t.name for t in spark.catalog.listTables(db) if t.tableType != "VIEW"} == set(runner.NAMES.values())

    monkeypatch.undo()
    third = runner.run_steps(spark, inputs(), SETTINGS, root=root, database=db)
    assert third.resumed == []                                         # a published run is not gone on with
    sinks.drop_database(spark, db)


def test_other_inputs_repeat_only_their_steps(spark, tmp_path, monkeypatch):
    folder, root, db = tmp_path / "in", str(tmp_path / "root"), f"cardflow_g_{uuid.uuid4().hex[:8]}"

    def inputs():
        return runner.RawInputs(csv.read_customers(spark, str(folder / "c")), csv.read_sanctioned(spark, str(folder / "s")),
                                csv.read_accounts(spark, str(folder / "a")), csv.read_transactions(spark, str(folder / "t")))

    _stage_file(spark, fx.raw_customers(spark, SF0001), str(folder), "c")
    _stage_file(spark, fx.raw_sanctioned(spark, SF0001), str(folder), "s")
    _stage_file(spark, fx.raw_accounts(spark, SF0001), str(folder), "a")
    _stage_file(spark, fx.raw_transactions(spark, SF0001, year_shift=10), str(folder), "t", "dd-MMM-yy")
    whole = transform.enrich
    monkeypatch.setattr(transform, "enrich", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runner.run_steps(spark, inputs(), SETTINGS, root=root, database=db)
    assert not [t for t in spark.catalog.listTables(db) if t.name in runner.NAMES.values()]
    monkeypatch.setattr(transform, "enrich", whole)
    fx.raw_accounts(spark, SF0001).limit(100).coalesce(1).write.mode("overwrite").option("header", True).csv(str(folder / "a"))
    res = runner.run_steps(spark, inputs(), SETTINGS, root=root, database=db)
    assert res.resumed == ["customers", "transactions"]
    assert res.counts["account_stage"] + res.counts["account_rejects"] <= 100
    sinks.drop_database(spark, db)


def test_one_day_for_the_whole_run(spark, tmp_path, monkeypatch):
    """Without a day in the settings the run's day is fixed when it begins, also for the run that goes on with it."""
    root, db = str(tmp_path / "root"), f"cardflow_d_{uuid.uuid4().hex[:8]}"
    inputs = lambda: runner.inputs_from_tables(spark, SF0001)
    s = replace(SETTINGS, as_of=None)
    whole = transform.metrics
    monkeypatch.setattr(transform, "metrics", lambda *a: 1 / 0)
    monkeypatch.setattr(runner.Manifest, "day", lambda self: None)
    real = runner.F.current_date
    monkeypatch.setattr(runner.F, "current_date", lambda: runner.F.lit(dt.date(2023, 12, 31)))
    with pytest.raises(ZeroDivisionError):
        runner.run_steps(spark, inputs(), s, root=root, database=db)
    monkeypatch.undo()
    assert real is runner.F.current_date
    res = runner.run_steps(spark, inputs(), s, root=root, database=db)   # on another day
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {res.tables['intermediate']}").collect()}
    assert props["as_of"] == "2023-12-31" and len(res.resumed) == 3
    t = spark.table(res.tables["intermediate"]).filter("Customer_Since IS NOT NULL")
    assert t.filter("Customer_Since != datediff(DATE'2023-12-31', Acct_open_dt)").count() == 0
    assert transform.metrics is whole
    sinks.drop_database(spark, db)


def test_a_bad_file_stops_the_run_before_it_writes(spark, tmp_path):
    inbox, root, db = tmp_path / "in", tmp_path / "root", f"cardflow_q_{uuid.uuid4().hex[:8]}"
    _stage_file(spark, fx.raw_customers(spark, SF0001), str(inbox), "customers.csv")
    _stage_file(spark, fx.raw_sanctioned(spark, SF0001), str(inbox), "sanctioned.csv")
    _stage_file(spark, fx.raw_accounts(spark, SF0001), str(inbox), "accounts.csv")
    _stage_file(spark, fx.raw_transactions(spark, SF0001, year_shift=10), str(inbox), "transactions.csv", "dd-MMM-yy")
    config = tmp_path / "Config.csv"
    config.write_text(f"Parameter,Value\nInputFilePath,{inbox}\nDatabaseName,{db}\n")
    res = runner.run_from_config(spark, str(config), root=str(root), as_of=AS_OF, bad_share=0.01)
    before = _tables(spark, db)
    (inbox / "customers.csv" / "part-bad.csv").write_text("CUSTOMER_ID,FIRST_NAME\n" + "1,short\n" * 90)
    with pytest.raises(ValueError, match="customers 3"):
        runner.run_from_config(spark, str(config), root=str(root), as_of=AS_OF, bad_share=0.01)
    assert _tables(spark, db) == before and res.counts["customer_stage"] == 92
    audit = {(r["source"], r["column"]): r for n in ("customer", "account") for r in spark.table(f"{db}.{n}_cast_losses").collect()}
    assert audit["customer", "CUSTOMER_ID"]["present"] == 92 and audit["account", "cust_id"]["lost"] == 0
    sinks.drop_database(spark, db)


def test_the_first_three_steps_run_together(spark, monkeypatch):
    """None waits for another's tables: each goes on when all three have begun."""
    met = threading.Barrier(3, timeout=120)

    def meeting(check):
        return lambda *a: (met.wait(), check(*a))[1]

    for step in ("check_customers", "check_accounts", "check_transactions"):
        monkeypatch.setattr(runner.ingest, step, meeting(getattr(runner.ingest, step)))
    db = f"cardflow_m_{uuid.uuid4().hex[:8]}"
    res = runner.run_steps(spark, runner.inputs_from_tables(spark, SF0001), SETTINGS, database=db)
    assert res.counts["intermediate"] == 86 and list(res.tables) == [n for n in runner.NAMES if n not in runner.BESIDE]
    sinks.drop_database(spark, db)


def test_a_failed_first_step_leaves_the_others_done(spark, tmp_path, monkeypatch):
    """It stops the transform; the next run repeats it and takes the others' tables."""
    root, db = str(tmp_path / "root"), f"cardflow_o_{uuid.uuid4().hex[:8]}"
    inputs = lambda: runner.inputs_from_tables(spark, SF0001)
    whole, joined = runner.ingest.check_customers, []
    monkeypatch.setattr(runner.ingest, "check_customers", lambda *a: 1 / 0)
    monkeypatch.setattr(transform, "enrich", lambda *a: joined.append(a))
    with pytest.raises(ZeroDivisionError):
        runner.run_steps(spark, inputs(), SETTINGS, root=root, database=db)
    assert not joined and not [t for t in spark.catalog.listTables(db) if t.name in runner.NAMES.values()]
    monkeypatch.undo()
    assert runner.ingest.check_customers is whole
    res = runner.run_steps(spark, inputs(), SETTINGS, root=root, database=db)
    assert res.resumed == ["accounts", "transactions"] and res.counts["intermediate"] == 86
    sinks.drop_database(spark, db)
