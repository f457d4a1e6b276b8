"""Named queries over a data directory: one per operator of the inventory.

Each callable takes (spark, sf_dir) and returns a DataFrame.  Queries of several
steps, sinks and CSV scans write their inputs into the shared folder while they are
built.  Column names match the DuckDB oracle of `sqlcheck`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.config import Settings
from cardflow.functions import fixed
from cardflow.functions.scalars import parse_date
from cardflow.operators import sets
from cardflow.operators.dedup import first_per_key, flag_first_per_key
from cardflow.operators.joins import broadcast_if_small
from cardflow.operators.ordered import lag_by_range
from cardflow.operators.validate import CODE, REASON, any_match, not_all_clear
from cardflow.plans import incremental, ingest, reports, runner, sinks, transform
from cardflow.session import materialize, scratch_path
from cardflow.sources import csv, fixtures

# Tests and the oracle pin "today" so that tenure is reproducible.
AS_OF = dt.date(2024, 1, 1)
SETTINGS = Settings(as_of=AS_OF)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------ shared parts

def _checked_customers(spark, d):
    return ingest.check_customers(fixtures.raw_customers(spark, d), fixtures.raw_sanctioned(spark, d), SETTINGS)


def _checked_accounts(spark, d):
    return ingest.check_accounts(fixtures.raw_accounts(spark, d))


def _checked_transactions(spark, d):
    return ingest.check_transactions(fixtures.raw_transactions(spark, d))


def _stages(spark, d):
    """Validated stage tables, written and read back (one step boundary).
    The three are independent, so their jobs are submitted together."""
    builds = [
        lambda: materialize(ingest.transaction_stage(_checked_transactions(spark, d)), "stage-txn"),
        lambda: materialize(ingest.account_stage(_checked_accounts(spark, d)), "stage-acct"),
        lambda: materialize(ingest.customer_stage(_checked_customers(spark, d)), "stage-cust"),
    ]
    return sinks.together(builds)


def _checked_written(spark, d):
    """The three checked tables (accepted and rejected rows), written once."""
    return sinks.together([
        lambda: materialize(_checked_customers(spark, d), "checked-cust"),
        lambda: materialize(_checked_accounts(spark, d), "checked-acct"),
        lambda: materialize(_checked_transactions(spark, d), "checked-txn"),
    ])


def _joined(spark, d):
    return transform.enrich(*_stages(spark, d))


def _metrics(spark, d):
    return transform.metrics(transform.valid_joined(_joined(spark, d)), SETTINGS)


def _intermediate(spark, d):
    return transform.intermediate(*_stages(spark, d), SETTINGS)


def _normalized_customers(spark, d):
    return ingest.normalize_customers(fixtures.raw_customers(spark, d))


#: Databases (with the folder of their files) that queries of this process created.
CREATED: list[tuple[str, str]] = []


def _database(spark) -> tuple[str, str]:
    """A fresh database in the shared folder for one sink query."""
    root = scratch_path(spark, "tables")
    db = f"cardflow_{uuid.uuid4().hex[:10]}"
    sinks.create_database(spark, db, f"{root}/_db")
    CREATED.append((db, root))
    return db, root


def release(spark) -> list[str]:
    """Uncache and drop what the queries created, once their results are no longer
    needed; returns the folders whose files the caller may remove."""
    roots = []
    while CREATED:
        db, root = CREATED.pop()
        sinks.drop_database(spark, db)
        roots.append(root)
    return roots


def _run(spark, d):
    db, root = _database(spark)
    return runner.run_steps(spark, runner.inputs_from_tables(spark, d), SETTINGS, root=root, database=db)


def _cents(*names):
    return {n: F.round(F.col(n), 2) for n in names}


# ------------------------------------------------------------ 2.1 scans

@query
def scan_customer_csv(spark, d):
    path = csv.stage(spark, fixtures.raw_customers(spark, d), "raw-customer")
    return csv.read_customers(spark, path)


@query
def scan_failfast(spark, d):
    path = csv.stage(spark, fixtures.raw_customers(spark, d), "raw-customer")
    return csv.read_customers(spark, path, mode="FAILFAST")


@query
def scan_corrupt_records(spark, d):
    """Raw account rows that do not fit the typed account layout."""
    path = csv.stage(spark, fixtures.raw_accounts(spark, d), "raw-account")
    bad = csv.corrupt_records(spark, path, csv.ACCOUNT_TYPED_DDL, fixed.ACCOUNT_DATE_FORMAT)
    return bad.withColumnRenamed(csv.CORRUPT, "raw_line")


@query
def scan_corrupt_customers(spark, d):
    """Raw customer rows that do not fit the customer layout: every 53rd customer
    gets an income that is no number."""
    raw = fixtures.raw_customers(spark, d)
    bad = F.coalesce(F.col("CUSTOMER_ID").try_cast("long") % 53 == 8, F.lit(False))
    raw = raw.withColumn("ANNUAL_INCOME", F.when(bad, F.lit("n/a")).otherwise(F.col("ANNUAL_INCOME").cast("string")))
    path = csv.stage(spark, raw, "raw-customer")
    return csv.corrupt_records(spark, path, csv.CUSTOMER_DDL).withColumnRenamed(csv.CORRUPT, "raw_line")


@query
def scan_account_csv(spark, d):
    path = csv.stage(spark, fixtures.raw_accounts(spark, d), "raw-account")
    return csv.read_accounts(spark, path)


@query
def scan_transaction_csv(spark, d):
    # Two-digit years: dates move 10 years ahead so 'yy' reads them back as 20yy.
    raw = fixtures.raw_transactions(spark, d, year_shift=10)
    path = csv.stage(spark, raw, "raw-transaction", fixed.ACCOUNT_DATE_FORMAT)
    return csv.read_transactions(spark, path)


@query
def scan_sanctioned(spark, d):
    path = csv.stage(spark, fixtures.raw_sanctioned(spark, d), "sanctioned")
    return csv.read_sanctioned(spark, path)


@query
def scan_stage_table(spark, d):
    db, root = _database(spark)
    t = sinks.write_account_stage(ingest.account_stage(_checked_accounts(spark, d)), db, f"{root}/account_stage")
    return spark.table(t)


# ------------------------------------------------------------ 2.2 sinks

@query
def sink_customer_stage(spark, d):
    db, root = _database(spark)
    stage = materialize(ingest.customer_stage(_checked_customers(spark, d)), "stage-cust")
    t = sinks.write_customer_stage(stage, db, f"{root}/customer_stage",
                                   sinks.directory_buckets(stage, sinks.CUSTOMER_DIRECTORIES, SETTINGS))
    return spark.table(t)


@query
def sink_rejects(spark, d):
    db, root = _database(spark)
    t = sinks.write_rejects(ingest.customer_rejects(_checked_customers(spark, d)), db, f"{root}/rejects",
                            "customer_rejects")
    return spark.table(t)


@query
def sink_account_stage(spark, d):
    """The account table beside its rejects, as one run writes them."""
    db, root = _database(spark)
    checked = materialize(_checked_accounts(spark, d), "checked-acct")
    t = sinks.write_account_stage(ingest.account_stage(checked), db, f"{root}/account_stage")
    r = sinks.write_rejects(ingest.account_rejects(checked), db, f"{root}/rejects", "account_rejects")
    rows = lambda name, key: spark.table(name).select(
        F.col("cust_id").cast("string").alias("cust_id"), F.col("Account_num").cast("string").alias("Account_num"),
        key.alias("reason_code"))
    return rows(t, F.lit(None).cast("string")).unionByName(rows(r, F.col("reason_code")))


@query
def sink_transaction_stage(spark, d):
    db, root = _database(spark)
    t = sinks.write_transaction_stage(ingest.transaction_stage(_checked_transactions(spark, d)), db,
                                      f"{root}/transaction_stage")
    return spark.table(t)


def _written_intermediate(spark, d):
    db, root = _database(spark)
    inter = materialize(_intermediate(spark, d), "intermediate")
    t, _ = sinks.write_intermediate(inter, db, f"{root}/card_intermediate",
                                    sinks.directory_buckets(inter, sinks.INTERMEDIATE_DIRECTORIES, SETTINGS))
    return t


@query
def sink_intermediate(spark, d):
    return spark.table(_written_intermediate(spark, d))


@query
def cache_intermediate(spark, d):
    """Cached until `release`."""
    return sinks.cache_table(spark, _written_intermediate(spark, d))


@query
def stage_counts(spark, d):
    """Rows per step and outcome; each checked table is written once."""
    return runner.counts_from_checked(*_checked_written(spark, d), SETTINGS)


@query
def cast_losses(spark, d):
    """Texts of accepted customers and accounts that have no value of their column's type."""
    customers, accounts = sinks.together([lambda: materialize(_checked_customers(spark, d), "checked-cust"),
                                     lambda: materialize(_checked_accounts(spark, d), "checked-acct")])
    return sets.union_all([ingest.cast_losses(customers, "customer", ingest.customer_casts()),
                           ingest.cast_losses(accounts, "account", ingest.account_casts())])


@query
def run_summary(spark, d):
    """All steps with their tables and views; rows per written table."""
    res = _run(spark, d)
    return sets.union_all([spark.table(t).groupBy().agg(F.count(F.lit(1)).alias("rows"))
                           .select(F.lit(name).alias("table_name"), "rows")
                           for name, t in [*res.tables.items(), *res.views.items()]])


@query
def view_scan(spark, d):
    """All steps, then the EMI-offer view read back by SQL (`select *`)."""
    return spark.sql(f"SELECT * FROM {_run(spark, d).views['emi_offers']}")


@query
def view_scan_geography(spark, d):
    v = spark.sql(f"SELECT * FROM {_run(spark, d).views['geography_summary']}")
    return v.withColumns(_cents("AVG_ANNUAL_INCOME"))


@query
def view_scan_previous(spark, d):
    v = spark.sql(f"SELECT * FROM {_run(spark, d).views['previous_transaction']}")
    return v.withColumns(_cents("Latest_Transaction", "PREVIOUS_TRANSACTION"))


def _changed_years(spark, d) -> str:
    """A written intermediate table of which some years were replaced (amounts doubled and
    incomes one higher in every seventh year), with its derived tables refreshed."""
    db, root = _database(spark)
    inter = materialize(_intermediate(spark, d), "intermediate")
    t, _ = sinks.write_intermediate(inter, db, f"{root}/card_intermediate",
                                    sinks.directory_buckets(inter, sinks.INTERMEDIATE_DIRECTORIES, SETTINGS))
    sinks.create_report_views(spark, db, SETTINGS)
    other = inter.filter("YEAR % 7 = 0").withColumns({"Transaction_Amount": F.col("Transaction_Amount") * 2,
                                                      "ANNUAL_INCOME": F.col("ANNUAL_INCOME") + 1})
    incremental.replace_partitions(other, t)
    incremental.refresh(spark, db)
    return sinks.quoted(db)


@query
def incremental_previous(spark, d):
    """The previous-card view after some years were replaced and only those recomputed."""
    v = spark.sql(f"SELECT * FROM {_changed_years(spark, d)}.previous_transaction")
    return v.withColumns(_cents("Latest_Transaction", "PREVIOUS_TRANSACTION"))


@query
def incremental_geography(spark, d):
    """The geography view from mergeable states, after some years were replaced."""
    v = spark.sql(f"SELECT * FROM {_changed_years(spark, d)}.geography_summary")
    return v.withColumns(_cents("AVG_ANNUAL_INCOME"))


@query
def view_scan_threshold(spark, d):
    return spark.sql(f"SELECT * FROM {_run(spark, d).views['credit_threshold']}")


# ------------------------------------------------------------ 2.3 projections

@query
def reject_projection(spark, d):
    return ingest.customer_rejects(_checked_customers(spark, d)).select(REASON, *fixtures.CUSTOMER_COLUMNS)


@query
def transaction_metrics(spark, d):
    m = _metrics(spark, d)
    return m.select("Cust_Id", "Account_Num", "Card_Num", "Transaction_Amount", "Account_Current_Status",
                    "Credit_Limit", "Cust_credit_limit_remaining", "Cust_credit_limit_used", "DIff_Trans_Limit")


@query
def customer_valid(spark, d):
    return ingest.accepted(_checked_customers(spark, d))


@query
def customer_stage(spark, d):
    return ingest.customer_stage(_checked_customers(spark, d))


@query
def customer_rejects(spark, d):
    return ingest.customer_rejects(_checked_customers(spark, d))


@query
def account_valid(spark, d):
    return ingest.accepted(_checked_accounts(spark, d))


@query
def account_stage(spark, d):
    return ingest.account_stage(_checked_accounts(spark, d))


@query
def account_rejects(spark, d):
    return ingest.account_rejects(_checked_accounts(spark, d))


@query
def transaction_valid(spark, d):
    return ingest.transaction_stage(_checked_transactions(spark, d))


@query
def transaction_rejects(spark, d):
    return ingest.transaction_rejects(_checked_transactions(spark, d))


@query
def intermediate(spark, d):
    return _intermediate(spark, d)


# ------------------------------------------------------------ 2.4 filters

@query
def filter_not_null(spark, d):
    return _normalized_customers(spark, d).dropna(how="any", subset=ingest.CUSTOMER_NULL_CHECK)


@query
def filter_regex(spark, d):
    """Customers whose id has no letter/special and whose names, state, city
    and country have no digit/special (NULL MIDDLE_NAME passes)."""
    return _normalized_customers(spark, d).filter(
        ~not_all_clear(["CUSTOMER_ID"], fixed.ID_CHARS) & ~any_match(ingest.CUSTOMER_ALPHA_ONLY, fixed.ALPHA_ONLY_CHARS))


@query
def filter_isin(spark, d):
    return _normalized_customers(spark, d).filter(F.col("CUST_PEP_EXPOSED").isin(list(fixed.PEP_ACCEPTED)))


@query
def filter_open_accounts(spark, d):
    return fixtures.raw_accounts(spark, d).filter(F.col("acct_close_dt").isNull())


@query
def filter_negative_income(spark, d):
    return _normalized_customers(spark, d).filter(F.col("ANNUAL_INCOME") < 0)


@query
def filter_within_limit(spark, d):
    return transform.within_limit(_metrics(spark, d)).select(
        "Cust_Id", "Account_Num", "Card_Num", "Transaction_Amount", "Credit_Limit", "Cust_credit_limit_remaining")


@query
def filter_card_length(spark, d):
    a = fixtures.raw_accounts(spark, d)
    return a.filter(F.length("card_num") != fixed.CARD_LENGTH).select(
        "cust_id", "Account_num", "card_num", F.length("card_num").alias("card_length"))


# ------------------------------------------------------------ 2.5 joins

@query
def join_txn_account(spark, d):
    txn, acct = sinks.together([
        lambda: materialize(ingest.transaction_stage(_checked_transactions(spark, d)), "stage-txn"),
        lambda: materialize(ingest.account_stage(_checked_accounts(spark, d)), "stage-acct")])
    return transform.join_accounts(txn, acct).drop(transform.CLOSED)


@query
def join_txn_customer(spark, d):
    return _joined(spark, d).drop(transform.CLOSED)


@query
def join_by_buckets(spark, d):
    """Transactions with accounts and customers from tables bucketed by the customer id."""
    db, root = _database(spark)
    txn, acct, cust = _stages(spark, d)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = (sinks.write_transaction_stage(txn, db, f"{root}/transaction_stage", buckets=n),
              sinks.write_account_stage(acct, db, f"{root}/account_stage", buckets=n),
              sinks.write_customer_stage(cust, db, f"{root}/customer_stage", n))
    with transform.co_partitioned(spark):
        return materialize(transform.enrich_by_buckets(*map(spark.table, tables), n).drop(transform.CLOSED), "joined")


@query
def anti_join_sanctioned(spark, d):
    c = _normalized_customers(spark, d)
    s = ingest.sanctioned_list(fixtures.raw_sanctioned(spark, d)).withColumnRenamed("COUNTRY", "_s_country")
    return c.join(broadcast_if_small(s), F.col("COUNTRY") == F.col("_s_country"), "left_anti")


# ------------------------------------------------------------ 2.6 sets and duplicates

@query
def set_subtract(spark, d):
    """Customers (distinct) that the NULL rule rejects, as EXCEPT DISTINCT."""
    c = _normalized_customers(spark, d)
    return sets.subtract(c, c.dropna(how="any", subset=ingest.CUSTOMER_NULL_CHECK))


@query
def set_union_all(spark, d):
    """All rejects of all steps in one frame (source, key, reason).  Each
    checked table is written once; stages and rejects are filters of it."""
    cc, ca, ct = _checked_written(spark, d)
    joined = transform.enrich(ingest.transaction_stage(ct), ingest.account_stage(ca), ingest.customer_stage(cc))
    cr = ingest.customer_rejects(cc).select(
        F.lit("customer").alias("source"), F.col("CUSTOMER_ID").alias("record_key"), REASON, CODE)
    ar = ingest.account_rejects(ca).select(
        F.lit("account").alias("source"), F.concat_ws("|", "cust_id", "Account_num").alias("record_key"), REASON, CODE)
    tr = ingest.transaction_rejects(ct).select(
        F.lit("transaction").alias("source"),
        F.concat_ws("|", F.col("Cust_Id").cast("string"), F.col("Account_Num").cast("string")).alias("record_key"),
        REASON, CODE)
    orph = transform.orphans(joined).select(
        F.lit("joined").alias("source"),
        F.concat_ws("|", F.col("Cust_Id").cast("string"), F.col("Account_Num").cast("string")).alias("record_key"),
        REASON, CODE)
    return sets.union_all([cr, ar, tr, orph])


@query
def distinct_rows(spark, d):
    return fixtures.raw_accounts(spark, d).distinct()


@query
def dedup_customers(spark, d):
    return first_per_key(_normalized_customers(spark, d), ["CUSTOMER_ID"])


@query
def dedup_transactions(spark, d):
    return first_per_key(fixtures.raw_transactions(spark, d), ["Cust_Id", "Account_Num"])


@query
def duplicate_rejects(spark, d):
    f = flag_first_per_key(_normalized_customers(spark, d), ["CUSTOMER_ID"], "is_first")
    return f.filter(~F.col("is_first")).drop("is_first").withColumn(REASON, F.lit(fixed.CUSTOMER_DUPLICATE))


# ------------------------------------------------------------ 2.7-2.9 aggregates, windows, sorts

@query
def report_geography(spark, d):
    return reports.geography(_intermediate(spark, d), ordered=True).withColumns(_cents("AVG_ANNUAL_INCOME"))


@query
def agg_card_totals(spark, d):
    return reports.card_totals(_intermediate(spark, d)).withColumns(_cents("Latest_Transaction"))


@query
def agg_card_totals_history(spark, d):
    """Totals where transactions with another date or amount survive, so that a
    card's sum has several rows."""
    ct = ingest.check_transactions(fixtures.raw_transactions(spark, d),
                                   ("Cust_Id", "Account_Num", "Transaction_Dt", "Transaction_Amount"))
    txn, acct, cust = sinks.together([
        lambda: materialize(ingest.transaction_stage(ct), "stage-txn"),
        lambda: materialize(ingest.account_stage(_checked_accounts(spark, d)), "stage-acct"),
        lambda: materialize(ingest.customer_stage(_checked_customers(spark, d)), "stage-cust")])
    return reports.card_totals(transform.intermediate(txn, acct, cust, SETTINGS)).withColumns(
        _cents("Latest_Transaction"))


@query
def window_lag(spark, d):
    agg = reports.card_totals(_intermediate(spark, d))
    return lag_by_range(agg, ["Cust_Id", "YEAR", "MONTH"], reports.previous_order(), "Latest_Transaction",
                        "PREVIOUS_TRANSACTION").select(
        "Cust_Id", "Card_Num", "YEAR", "MONTH", "Latest_Transaction", "PREVIOUS_TRANSACTION").withColumns(
        _cents("Latest_Transaction", "PREVIOUS_TRANSACTION"))


@query
def report_emi_offers(spark, d):
    return reports.emi_offers(_intermediate(spark, d), SETTINGS)


@query
def report_previous_transaction(spark, d):
    out = reports.previous_transaction(_intermediate(spark, d), ordered=True)
    return out.withColumns(_cents("Latest_Transaction", "PREVIOUS_TRANSACTION"))


@query
def report_credit_threshold(spark, d):
    return reports.credit_threshold(_intermediate(spark, d), SETTINGS)


# ------------------------------------------------------------ 2.10 scalar functions

@query
def fn_parse_dates(spark, d):
    a = fixtures.raw_accounts(spark, d)
    return a.select("cust_id", "Account_num", "acct_open_dt",
                    parse_date(F.col("acct_open_dt"), fixed.ACCOUNT_DATE_FORMAT).alias("open_date"),
                    parse_date(F.col("acct_close_dt"), fixed.ACCOUNT_DATE_FORMAT).alias("close_date"))


@query
def fn_date_parts(spark, d):
    c = fixtures.raw_customers(spark, d)
    dob = parse_date(F.col("DOB"), fixed.DOB_FORMAT)
    return c.select("CUSTOMER_ID", F.col("DOB").alias("DOB_TEXT"), dob.alias("DOB"), F.year(dob).alias("YEAR"),
                    F.month(dob).alias("MONTH"))


@query
def fn_upper(spark, d):
    c = fixtures.raw_customers(spark, d)
    return c.select("CUSTOMER_ID", F.upper("COUNTRY").alias("COUNTRY"),
                    F.upper("CUST_PEP_EXPOSED").alias("CUST_PEP_EXPOSED"))


@query
def tenure_days(spark, d):
    j = transform.valid_joined(_joined(spark, d))
    days = F.datediff(SETTINGS.as_of_col(), F.col("Acct_open_dt"))
    return j.select("Cust_Id", "Account_Num", "Acct_open_dt", days.alias("tenure_days"),
                    F.when(~F.col(transform.CLOSED), days).alias("Customer_Since"),
                    F.when(~F.col(transform.CLOSED), "Y").otherwise("N").alias("Acct_Active"))


@query
def credit_score(spark, d):
    return _metrics(spark, d).select("Cust_Id", "Account_Num", "CS_Metric_1", "CS_Metric_2", "CS_Metric_3",
                                     "Credit_Score")


@query
def emi_schedule(spark, d):
    cols = ["Cust_Id", "Account_Num", "Transaction_Amount"]
    for months, _ in SETTINGS.emi_percentages:
        cols += [f"EMI_{months}_month_check1", f"EMI_{months}_month_check2", f"EMI_{months}_month"]
    return _metrics(spark, d).select(*cols)


@query
def emi_eligible(spark, d):
    return _metrics(spark, d).select("Cust_Id", "Account_Num", "Opt_EMI", "Credit_Score", "Customer_Since",
                                     "Transaction_Amount", "Cust_credit_limit_remaining", "EMI_Eligible")


# ------------------------------------------------------------ 2.11 domain

@query
def transaction_orphans(spark, d):
    return transform.orphans(_joined(spark, d))
