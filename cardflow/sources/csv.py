"""CSV scans of the raw files, with fixed schemas (no inference).

`stage_*` helpers write a DataFrame as a headed CSV file set into the shared
folder (`spark.checkpoint.dir`), so that the scans run on real files derived
from the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StructType

from cardflow.functions import fixed
from cardflow.operators.joins import broadcast_if_small
from cardflow.session import materialize, scratch_path

CUSTOMER_DDL = ("CUSTOMER_ID string, FIRST_NAME string, MIDDLE_NAME string, LAST_NAME string, DOB string, "
                "ADDRESS1 string, ADDRESS2 string, STATE string, CITY string, COUNTRY string, PIN_CODE string, "
                "CUST_PEP_EXPOSED string, ANNUAL_INCOME double")
ACCOUNT_DDL = ("cust_id string, Account_num string, card_num string, acct_open_dt string, acct_close_dt string, "
               "acct_cycle_dt string, defaulted string")
# Typed view of the account file: which raw rows do not fit it.
ACCOUNT_TYPED_DDL = ("cust_id long, Account_num long, card_num long, acct_open_dt date, acct_close_dt string, "
                     "acct_cycle_dt int, defaulted int")
TRANSACTION_DDL = ("Cust_Id long, Account_Num long, Card_Num long, Transaction_Dt date, Transaction_Amount double, "
                   "Transaction_Purpose string, Transaction_Place string, Opt_EMI string")
CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession, ddl: str | None, mode: str = "PERMISSIVE", date_format: str | None = None):
    r = spark.read.format("csv").option("header", True).option("mode", mode)
    if ddl:
        r = r.schema(ddl)
    if date_format:
        r = r.option("dateFormat", date_format)
    return r


def read_customers(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Raw customer file.  With mode FAILFAST a malformed row fails the first
    action that reads it (not the load call)."""
    return _reader(spark, CUSTOMER_DDL, mode).load(path)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Raw account file, every column as text (dates are parsed by the rules)."""
    return _reader(spark, ACCOUNT_DDL, date_format=fixed.ACCOUNT_DATE_FORMAT).load(path)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Raw transaction file, typed; a field that does not parse becomes NULL."""
    return _reader(spark, TRANSACTION_DDL, date_format=fixed.ACCOUNT_DATE_FORMAT).load(path)


def read_sanctioned(spark: SparkSession, path: str) -> DataFrame:
    """Sanctioned-country list: header, all columns text."""
    return _reader(spark, None).load(path)


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, at, record): the records of the CSV files at `path`, whole, with their file and
    their number in it (the first is the header).

    A line end inside quotes belongs to its record.  Files are read as lines of text, which
    hold any character; a line that begins inside quotes is one with an odd number of quotes
    before it in its file.  The quotes of the lines are counted range by range of lines, so
    a large file is cut into records by many tasks, and a record of many lines is joined in
    one.  Empty lines outside of quotes are no records."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.col("value").alias("text"))
    quotes = F.length("text") - F.length(F.replace("text", F.lit(quote), F.lit("")))
    # a block of a file is read by one task, in order; its lines rise in number
    lines = materialize(lines.withColumn("quotes", quotes), "csv-lines")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (lines.groupBy("file", "block").agg(F.sum("quotes").alias("q"))
              .select("file", "block", F.coalesce(F.sum("q").over(before), F.lit(0)).alias("earlier")))
    inside = Window.partitionBy("file", "block").orderBy("line")
    opened = (lines.join(broadcast_if_small(blocks), ["file", "block"])
              .withColumn("open", (F.col("earlier") + F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, 0))
                                   - F.col("quotes")) % 2 == 1))
    # a record is known by its first line: the last one, up to here, that did not begin inside quotes
    first = F.when(~F.col("open"), F.struct("block", "line"))
    carried = (opened.groupBy("file", "block").agg(F.max(first).alias("last"))
               .select("file", "block", F.max("last").over(before).alias("carried")))
    owned = (opened.join(broadcast_if_small(carried), ["file", "block"])
             .withColumn("owner", F.coalesce(F.max(first).over(inside.rowsBetween(Window.unboundedPreceding, 0)), "carried")))
    joined = owned.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "line", "text"))).alias("l"))
    whole = joined.select("file", "owner", F.concat_ws("\n", F.transform("l", lambda x: x["text"])).alias("record"))
    whole = whole.filter("record != ''")
    numbers = (whole.groupBy("file", "owner.block").agg(F.count(F.lit(1)).alias("n"))
               .select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    at = F.row_number().over(Window.partitionBy("file", "owner.block").orderBy("owner.line")) - 1
    return (whole.withColumn("in_block", at).withColumn("block", F.col("owner.block"))
            .join(broadcast_if_small(numbers), ["file", "block"])
            .select("file", (F.col("earlier") + F.col("in_block")).alias("at"), "record"))


def judged(spark: SparkSession, path: str, ddl: str, date_format: str | None = None) -> DataFrame:
    """The records of headed CSV files as the fields of `ddl`, with `_misfit`, the raw record
    in `_corrupt_record`, its file in `_file` and its number there in `_record`.

    A row does not fit if it has another number of fields or if a field's text is there but
    has no value of its type.  Records are read whole (`records`) and split into text
    fields, and the test names every field, so which columns a query uses later cannot
    change the rows it sees."""
    schema = StructType.fromDDL(ddl)
    texts = ", ".join(f"`{f.name}` string" for f in schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
    parsed = (records(spark, path).filter("at > 0")
              .withColumn("f", F.from_csv("record", f"{texts}, {CORRUPT} string", options)))

    def typed(name: str, kind: DataType):
        text = F.col(f"f.`{name}`")
        if isinstance(kind, DateType):
            return F.try_to_date(text, date_format) if date_format else text.try_cast("date")
        return text.try_cast(kind)

    values = [typed(f.name, f.dataType).alias(f.name) for f in schema]
    misfit = F.col(f"f.{CORRUPT}").isNotNull()
    for f in schema:
        misfit = misfit | (F.col(f"f.`{f.name}`").isNotNull() & typed(f.name, f.dataType).isNull())
    return parsed.select(*values, misfit.alias("_misfit"), F.col("record").alias(CORRUPT), F.col("file").alias("_file"),
                         F.col("at").alias("_record"))


def corrupt_records(spark: SparkSession, path: str, ddl: str, date_format: str | None = None,
                    with_place: bool = False) -> DataFrame:
    """Rows of headed CSV files that do not fit `ddl` (see `judged`): the raw record in
    `_corrupt_record`, with the fields that did parse alongside and, `with_place`, its file
    and its number in it."""
    bad = judged(spark, path, ddl, date_format).filter("_misfit").drop("_misfit")
    return bad if with_place else bad.drop("_file", "_record")


def bad_shares(spark: SparkSession, files: dict[str, tuple[str, str, str | None]]) -> dict[str, float]:
    """The share of records that do not fit, per name of (path, ddl, date format); 0 without records."""
    shares = {}
    for name, (path, ddl, date_format) in files.items():
        row = judged(spark, path, ddl, date_format).agg(F.count_if("_misfit").alias("bad"), F.count(F.lit(1)).alias("all")).first()
        shares[name] = row["bad"] / row["all"] if row["all"] else 0.0
    return shares


def stage_csv(df: DataFrame, path: str, date_format: str | None = None) -> str:
    w = df.write.mode("overwrite").option("header", True)
    if date_format:
        w = w.option("dateFormat", date_format)
    w.csv(path)
    return path


def stage(spark: SparkSession, df: DataFrame, name: str, date_format: str | None = None) -> str:
    """Write `df` as CSV under a fresh path of the shared folder; return it."""
    return stage_csv(df, scratch_path(spark, name), date_format)
