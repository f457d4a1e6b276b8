"""Step 1-3: validate raw customers, accounts and transactions.

Each table goes through `distinct`, a deterministic skew-safe one-row-per-key
pick, and its ordered rules in a single pass.  The result is one "checked"
frame with `Rejection_Reason`/`reason_code` (NULL = accepted); the accepted
stage frame and the reject frame are two filters of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.config import Settings
from cardflow.functions import fixed
from cardflow.functions.scalars import parse_date
from cardflow.operators.dedup import flag_first_per_key
from cardflow.operators.joins import broadcast_if_small
from cardflow.operators.validate import (CODE, REASON, Rule, accepted, any_match, any_null, apply_rules,
                                         not_all_clear, rejected)
from cardflow.sources.fixtures import ACCOUNT_COLUMNS, CUSTOMER_COLUMNS, TRANSACTION_COLUMNS

FIRST = "is_first"

# ---------------------------------------------------------------- customers

# The columns that the rules test.
CUSTOMER_NULL_CHECK = ["CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "DOB", "ADDRESS2", "STATE", "CITY", "COUNTRY",
                       "PIN_CODE", "CUST_PEP_EXPOSED", "ANNUAL_INCOME"]
CUSTOMER_ALPHA_ONLY = ["STATE", "CITY", "COUNTRY", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME"]


def normalize_customers(raw: DataFrame) -> DataFrame:
    """DOB text to date (unparseable -> NULL), YEAR/MONTH of birth, PEP flag and
    country upper-cased."""
    dob = parse_date(F.col("DOB"), fixed.DOB_FORMAT)
    return raw.select(
        "CUSTOMER_ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME",
        dob.alias("DOB"),
        "ADDRESS1", "ADDRESS2", "STATE", "CITY",
        F.upper("COUNTRY").alias("COUNTRY"),
        "PIN_CODE",
        F.upper("CUST_PEP_EXPOSED").alias("CUST_PEP_EXPOSED"),
        F.col("ANNUAL_INCOME").cast("double").alias("ANNUAL_INCOME"),
        F.year(dob).alias("YEAR"),
        F.month(dob).alias("MONTH"),
    )


def customer_rules(settings: Settings) -> list[Rule]:
    # The reference also tests DOB against the id class, but DOB is a date by
    # then (text yyyy-MM-dd) and can never match, so that half is left out.
    return [
        Rule("duplicate", fixed.CUSTOMER_DUPLICATE, ~F.col(FIRST)),
        Rule("null", fixed.CUSTOMER_NULL, any_null(CUSTOMER_NULL_CHECK)),
        Rule("alpha", fixed.CUSTOMER_ALPHA, not_all_clear(["CUSTOMER_ID"], fixed.ID_CHARS)),
        Rule("number", fixed.CUSTOMER_NUMBER, any_match(CUSTOMER_ALPHA_ONLY, fixed.ALPHA_ONLY_CHARS)),
        Rule("pep", fixed.CUSTOMER_PEP,
             ~F.coalesce(F.col("CUST_PEP_EXPOSED").isin(list(settings.pep_accepted)), F.lit(False))),
        Rule("sanctioned", fixed.CUSTOMER_SANCTIONED, F.col("_sanctioned")),
        Rule("negative_income", fixed.CUSTOMER_NEGATIVE_INCOME,
             F.coalesce(F.col("ANNUAL_INCOME") < 0, F.lit(False))),
    ]


def sanctioned_list(sanctioned: DataFrame) -> DataFrame:
    """Distinct sanctioned country names (compared as given, not upper-cased)."""
    return sanctioned.select("COUNTRY").distinct()


def check_customers(raw: DataFrame, sanctioned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Normalized, distinct customers with the first reject reason (or NULL)."""
    flagged = flag_first_per_key(normalize_customers(raw), ["CUSTOMER_ID"], FIRST)
    flags = sanctioned_list(sanctioned).select(F.col("COUNTRY").alias("_s_country"),
                                               F.lit(True).alias("_sanctioned"))
    joined = flagged.join(broadcast_if_small(flags), F.col("COUNTRY") == F.col("_s_country"),
                          "left")
    joined = joined.withColumn("_sanctioned", F.coalesce(F.col("_sanctioned"), F.lit(False)))
    return apply_rules(joined, customer_rules(settings)).drop("_s_country", "_sanctioned", FIRST)


def customer_casts() -> dict[str, Column]:
    """The text columns of customers that the stage table types."""
    return {"CUSTOMER_ID": F.col("CUSTOMER_ID").try_cast("long")}


def customer_stage(checked: DataFrame) -> DataFrame:
    """Accepted customers in the stage layout (CUSTOMER_ID as a number; ids
    such as `12-1` pass the rules but are no number: NULL, see `cast_losses`)."""
    ok = accepted(checked)
    return ok.select(
        customer_casts()["CUSTOMER_ID"].alias("CUSTOMER_ID"),
        "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "DOB", "ADDRESS1", "ADDRESS2", "STATE", "CITY", "COUNTRY",
        "PIN_CODE", "CUST_PEP_EXPOSED", "ANNUAL_INCOME",
        F.col("YEAR").cast("int").alias("YEAR"), F.col("MONTH").cast("int").alias("MONTH"),
    )


def customer_rejects(checked: DataFrame) -> DataFrame:
    """Rejected customers: reason, the 13 normalized raw columns, file name."""
    return rejected(checked).select(REASON, *CUSTOMER_COLUMNS,
                                    F.lit(fixed.CUSTOMER_FILE_NAME).alias("FileName"), CODE)


# ----------------------------------------------------------------- accounts

# The columns that the rules test.
ACCOUNT_NULL_CHECK = ["cust_id", "Account_num", "card_num", "acct_open_dt", "acct_cycle_dt", "defaulted"]
ACCOUNT_CHAR_CHECK = ["cust_id", "Account_num", "card_num", "acct_cycle_dt", "defaulted"]


def account_rules() -> list[Rule]:
    # The reference drops duplicate keys silently before its (then empty)
    # duplicate rule; the same rows are reported here with that rule's text.
    return [
        Rule("duplicate", fixed.ACCOUNT_DUPLICATE, ~F.col(FIRST)),
        Rule("null", fixed.ACCOUNT_NULL, any_null(ACCOUNT_NULL_CHECK)),
        Rule("closed", fixed.ACCOUNT_CLOSED, F.col("acct_close_dt").isNotNull()),
        Rule("special", fixed.ACCOUNT_SPECIAL, not_all_clear(ACCOUNT_CHAR_CHECK, fixed.ACCOUNT_CHARS)),
        Rule("card", fixed.ACCOUNT_CARD, F.coalesce(F.length("card_num") != fixed.CARD_LENGTH, F.lit(False))),
    ]


def check_accounts(raw: DataFrame) -> DataFrame:
    flagged = flag_first_per_key(raw.select(*ACCOUNT_COLUMNS), ["cust_id", "Account_num"], FIRST)
    return apply_rules(flagged, account_rules()).drop(FIRST)


def account_casts() -> dict[str, Column]:
    """The text columns of accounts that the stage table types."""
    return {
        "cust_id": F.col("cust_id").try_cast("long"),
        "Account_num": F.col("Account_num").try_cast("long"),
        "card_num": F.col("card_num").try_cast("long"),
        "acct_open_dt": parse_date(F.col("acct_open_dt"), fixed.ACCOUNT_DATE_FORMAT),
        "acct_cycle_dt": F.col("acct_cycle_dt").try_cast("int"),
        "defaulted": F.col("defaulted").try_cast("int"),
    }


def account_stage(checked: DataFrame) -> DataFrame:
    """Accepted accounts, typed (ids and card as long; open date parsed,
    unparseable -> NULL, found later as an orphan; see `cast_losses`)."""
    typed = account_casts() | {"acct_close_dt": F.col("acct_close_dt").cast("string")}
    return accepted(checked).select(*[typed[c].alias(c) for c in ACCOUNT_COLUMNS])


def cast_losses(checked: DataFrame, source: str, casts: dict[str, Column]) -> DataFrame:
    """(source, column, present, lost) per typed column of the accepted rows: values that
    are there as text, and those of them that have no value of the type.  One pass and
    one aggregate for all columns."""
    counts = [F.struct(F.lit(c).alias("column"), F.count(c).alias("present"),
                       F.count_if(F.col(c).isNotNull() & cast.isNull()).alias("lost")) for c, cast in casts.items()]
    found = accepted(checked).agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c"))
    return found.select(F.lit(source).alias("source"), "c.*")


def account_rejects(checked: DataFrame) -> DataFrame:
    """Rejected accounts with the raw (text) columns."""
    return rejected(checked).select(REASON, *ACCOUNT_COLUMNS, CODE)


# ------------------------------------------------------------- transactions

# The columns that the rules test.
TRANSACTION_ALPHA_ONLY = ["Transaction_Purpose", "Transaction_Place"]


def transaction_rules() -> list[Rule]:
    return [
        Rule("duplicate", fixed.TRANSACTION_DUPLICATE, ~F.col(FIRST)),
        Rule("null", fixed.TRANSACTION_NULL, any_null(TRANSACTION_COLUMNS)),
        Rule("number", fixed.TRANSACTION_NUMBER, any_match(TRANSACTION_ALPHA_ONLY, fixed.ALPHA_ONLY_CHARS)),
    ]


def check_transactions(raw: DataFrame, key: tuple[str, ...] = ("Cust_Id", "Account_Num")) -> DataFrame:
    """One transaction per `key` survives (the reference keeps one per account)."""
    flagged = flag_first_per_key(raw.select(*TRANSACTION_COLUMNS), list(key), FIRST)
    return apply_rules(flagged, transaction_rules()).drop(FIRST)


def transaction_stage(checked: DataFrame) -> DataFrame:
    return accepted(checked).select(*TRANSACTION_COLUMNS)


def transaction_rejects(checked: DataFrame) -> DataFrame:
    return rejected(checked).select(REASON, *TRANSACTION_COLUMNS, CODE)
