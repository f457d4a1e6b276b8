"""Tables, views and cache of the pipeline (writer API, external paths)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.config import Settings
from cardflow.operators.joins import broadcast_if_small
from cardflow.plans import reports

#: Rows per output file, and per bucket of a directory.
MAX_RECORDS_PER_FILE = 5_000_000
ROWS_PER_BUCKET = 2_000_000
#: Buckets of a table in one directory (the reference's number), and Spark's limit.
MIN_BUCKETS, MAX_BUCKETS = 4, 100_000
#: What one write task takes: rows, and files to open.
ROWS_PER_TASK, FILES_PER_TASK = 2_000_000, 128


def sized_buckets(rows: int, s: Settings, directories: int = 1) -> int:
    """The bucket count asked for, else one that follows the rows of a directory: every
    bucket exists in every directory, so a count that followed all rows would cut the
    directories of a finely partitioned table into tiny files."""
    least = MIN_BUCKETS if directories <= 1 else 1
    return s.buckets or min(MAX_BUCKETS, max(least, -(-rows // (max(1, directories) * ROWS_PER_BUCKET))))


def directory_buckets(df: DataFrame, partition_by: list[str], s: Settings) -> int:
    """`sized_buckets` for a frame that is written into directories by `partition_by`."""
    counted = df.groupBy(*partition_by).count().agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("dirs")).first()
    return sized_buckets(counted["rows"] or 0, s, max(2, counted["dirs"]))


def planned(df: DataFrame, partition_by: list[str], bucket_by: str | None = None, buckets: int = 1) -> DataFrame:
    """`df` dealt to write tasks by a plan of its (directory, bucket) groups.

    A histogram counts the groups.  Each group goes to one task, so it gives one file, but
    groups with more rows than a task should write, which are cut by a salt: a hot directory
    is written by many tasks.  The number of tasks follows from rows and from files, so small
    directories are many to a task, and many directories are not left to one task."""
    group: list[Column] = [F.col(c) for c in partition_by]
    if bucket_by:
        group.append(F.pmod(F.hash(bucket_by), F.lit(buckets)))  # as the writer assigns buckets
    key = F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("")) for c in group]).alias("_group")
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("groups"), F.max("_n").alias("most")).first()
    rows, groups, most = (total[c] or 0 for c in ("rows", "groups", "most"))
    tasks = max(1, -(-rows // ROWS_PER_TASK), -(-groups // FILES_PER_TASK))
    keyed = df.withColumn("_group", key)
    if most <= ROWS_PER_TASK:
        return keyed.repartition(tasks, "_group").drop("_group")
    # at most rows / ROWS_PER_TASK groups are hot
    hot = counts.filter(F.col("_n") > ROWS_PER_TASK).select("_group", F.ceil(F.col("_n") / ROWS_PER_TASK).alias("_cuts"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.coalesce("_cuts", F.lit(1))).alias("_salt")
    salted = keyed.join(broadcast_if_small(hot), "_group", "left").select("*", salt)
    return salted.repartition(tasks, "_group", "_salt").drop("_group", "_cuts", "_salt")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_database(spark: SparkSession, name: str, location: str) -> None:
    text = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)} LOCATION '{text}'")


def drop_database(spark: SparkSession, name: str) -> None:
    """Release the caches of a database and drop it with its tables and views.
    Files of its (external) tables stay under the root it was given."""
    if spark.catalog.databaseExists(name):
        for t in spark.catalog.listTables(name):
            if t.tableType != "VIEW" and spark.catalog.isCached(f"{quoted(name)}.{quoted(t.name)}"):
                spark.catalog.uncacheTable(f"{quoted(name)}.{quoted(t.name)}")
        spark.sql(f"DROP DATABASE {quoted(name)} CASCADE")


def save_table(df: DataFrame, table: str, path: str, partition_by: list[str] | None = None,
               bucket_by: str | None = None, buckets: int = 4, observe=None) -> None:
    """Snappy Parquet table at an external path, overwritten.  Partition columns move to
    the end of the schema; their directories are written by plan (`planned`, for which
    `df` is read twice).  Bucketed tables are sorted by the bucket column within each
    file.  `observe` is applied to the rows as they are written."""
    whole = observe or (lambda d: d)
    if partition_by:
        df = whole(planned(df, partition_by, bucket_by, buckets))
    elif bucket_by:
        df = whole(df).repartition(buckets, bucket_by)
    else:
        df = whole(df).hint("rebalance")  # AQE sizes the tasks by bytes
    w = (df.write.format("parquet").mode("overwrite").option("compression", "snappy")
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("path", path))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    w.saveAsTable(table)


def read_files(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The rows of a written table, read by path: its buckets then bind no plan
    (a join or an aggregate on the bucket column would run in as many tasks)."""
    return spark.read.schema(spark.table(table).schema).parquet(path)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


CUSTOMER_DIRECTORIES = ["COUNTRY", "STATE"]
INTERMEDIATE_DIRECTORIES = ["YEAR", "COUNTRY", "STATE"]


def write_customer_stage(df: DataFrame, db: str, path: str, buckets: int, name: str = "customer_stage", observe=None) -> str:
    t = f"{quoted(db)}.{quoted(name)}"
    save_table(df, t, path, CUSTOMER_DIRECTORIES, "CUSTOMER_ID", buckets, observe)
    return t


def write_rejects(df: DataFrame, db: str, path: str, name: str, observe=None) -> str:
    """Reject table partitioned by the short reason code (the text holds '/')."""
    t = f"{quoted(db)}.{quoted(name)}"
    save_table(df, t, path, ["reason_code"], observe=observe)
    return t


def write_account_stage(df: DataFrame, db: str, path: str, name: str = "account_stage", observe=None,
                        buckets: int | None = None) -> str:
    t = f"{quoted(db)}.{quoted(name)}"
    save_table(df, t, path, bucket_by="cust_id" if buckets else None, buckets=buckets or 1, observe=observe)
    return t


def write_transaction_stage(df: DataFrame, db: str, path: str, name: str = "transaction_stage", observe=None,
                            buckets: int | None = None) -> str:
    """Transactions as a plain table; no single-file coalesce (one task would
    write all data), file size is bounded by `maxRecordsPerFile`."""
    t = f"{quoted(db)}.{quoted(name)}"
    save_table(df, t, path, bucket_by="Cust_Id" if buckets else None, buckets=buckets or 1, observe=observe)
    return t


def write_intermediate(df: DataFrame, db: str, path: str, buckets: int, suffix: str = "", version: str = "") -> tuple[str, str]:
    """The intermediate table and, beside it, the tables that are derived from it by year
    (`incremental`): card totals with their predecessors, which a view cannot compute by
    range, the states of the geography report, and the fingerprints of the years.  All are
    written here, so one does not change without the others.  `df` is a written frame: it is
    read for each (the table's own files are many and small), so the writes are independent
    and submitted together."""
    from cardflow.plans import incremental
    t, p = (f"{quoted(db)}.{quoted(name + suffix)}" for name in ("card_intermediate", "card_previous"))
    together([lambda: save_table(df, t, path + version, INTERMEDIATE_DIRECTORIES, "Cust_Id", buckets),
              *incremental.derived_writes(df, db, suffix, path, version)])
    return t, p


def together(builds: list) -> tuple:
    """Run independent builds (each ends in a write job) from driver threads, so their jobs
    share the cluster instead of queueing one after another."""
    with ThreadPoolExecutor(max_workers=max(1, len(builds))) as pool:
        return tuple(f.result() for f in [pool.submit(b) for b in builds])


def publish(spark: SparkSession, db: str, name: str, staged: str) -> None:
    """Let a staged table take the place of the published one.  Only the catalog changes:
    the old table's files stay, and no data is written in between.  A staged table that is
    no longer there was published by an earlier call."""
    if spark.catalog.tableExists(f"{quoted(db)}.{quoted(staged)}"):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(db)}.{quoted(name)}")
        spark.sql(f"ALTER TABLE {quoted(db)}.{quoted(staged)} RENAME TO {quoted(db)}.{quoted(name)}")


def cache_table(spark: SparkSession, table: str) -> DataFrame:
    spark.catalog.cacheTable(table)
    return spark.table(table)


def view_queries(db: str, s: Settings) -> dict[str, str]:
    """SQL of the four report views over the tables of `write_intermediate`.  None of
    them joins or groups by the bucket column."""
    inter, previous, geography = (f"{quoted(db)}.card_{n}" for n in ("intermediate", "previous", "geography"))
    emi = ", ".join(f"EMI_{m}_month, EMI_{m}_month * {m} AS PayAfter{m}month" for m, _ in s.emi_percentages)
    return {
        "geography_summary": f"""
            SELECT COUNTRY, STATE, sum(customers) AS CUST_ID_COUNT,
                   try_divide(cast(sum(income) AS double), sum(incomes)) AS AVG_ANNUAL_INCOME,
                   max(best) AS MAX_CREDIT_SCORE, min(worst) AS MIN_CREDIT_SCORE
            FROM {geography} GROUP BY COUNTRY, STATE""",
        "emi_offers": f"""
            SELECT FIRST_NAME, LAST_NAME, Cust_Id, Account_Num, Card_Num, Transaction_Dt, Transaction_Amount,
                   Transaction_Purpose, {emi}
            FROM {inter} WHERE EMI_Eligible = 'Y'""",
        "previous_transaction": f"SELECT {', '.join(reports.PREVIOUS_COLUMNS)} FROM {previous}",
        "credit_threshold": f"""
            WITH used AS (
              SELECT FIRST_NAME, LAST_NAME, COUNTRY, Cust_credit_limit_remaining, Credit_Limit AS Total_Credit_Limit,
                     try_divide(Cust_credit_limit_remaining, Credit_Limit) * 100 AS Ratio FROM {inter})
            SELECT FIRST_NAME, LAST_NAME, COUNTRY, Cust_credit_limit_remaining, Total_Credit_Limit, Ratio
            FROM used WHERE Ratio <= {float(s.notify_threshold)}D""",
    }


def create_report_views(spark: SparkSession, db: str, s: Settings) -> dict[str, str]:
    """Create the four reports as views in the database: they outlive the session
    and always show the tables as they are.  Returns report name -> view name."""
    out = {}
    for name, query in view_queries(db, s).items():
        out[name] = f"{quoted(db)}.{name}"
        spark.sql(f"CREATE OR REPLACE VIEW {out[name]} AS {query}")
    return out
