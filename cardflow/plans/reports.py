"""Step 5: the four reports over the intermediate table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.config import Settings
from cardflow.operators.ordered import lag_by_range

# Money is summed as exact decimals, so a total does not depend on the order of its rows.
MONEY = "decimal(28,6)"


def geography_states(inter: DataFrame, by: tuple[str, ...] = ("YEAR", "COUNTRY", "STATE")) -> DataFrame:
    """Mergeable states of the geography report: exact counts and sums, best and worst."""
    income = F.col("ANNUAL_INCOME").cast(MONEY)
    return inter.groupBy(*by).agg(
        F.count("Cust_Id").alias("customers"), F.count(income).alias("incomes"), F.sum(income).alias("income"),
        F.max("Credit_Score").alias("best"), F.min("Credit_Score").alias("worst"))


def geography_from_states(states: DataFrame, ordered: bool = False) -> DataFrame:
    """The geography report from states of any parts of the rows: the same numbers, bit
    for bit, as from the rows, since sums of decimals are exact."""
    out = states.groupBy("COUNTRY", "STATE").agg(
        F.sum("customers").alias("CUST_ID_COUNT"),
        F.try_divide(F.sum("income").cast("double"), F.sum("incomes")).alias("AVG_ANNUAL_INCOME"),
        F.max("best").alias("MAX_CREDIT_SCORE"), F.min("worst").alias("MIN_CREDIT_SCORE"))
    return out.orderBy("COUNTRY", "STATE") if ordered else out


def geography(inter: DataFrame, ordered: bool = False) -> DataFrame:
    """Per country and state: rows with a customer id (transactions), mean
    income, best and worst credit score.
    The group count is bounded by the geography, so ordering it is cheap."""
    out = geography_states(inter, ("COUNTRY", "STATE")).select(
        "COUNTRY", "STATE", F.col("customers").alias("CUST_ID_COUNT"),
        F.try_divide(F.col("income").cast("double"), F.col("incomes")).alias("AVG_ANNUAL_INCOME"),
        F.col("best").alias("MAX_CREDIT_SCORE"), F.col("worst").alias("MIN_CREDIT_SCORE"))
    return out.orderBy("COUNTRY", "STATE") if ordered else out


def emi_offers(inter: DataFrame, s: Settings = Settings()) -> DataFrame:
    """EMI-eligible transactions with instalments and totals per tenure."""
    cols = ["FIRST_NAME", "LAST_NAME", "Cust_Id", "Account_Num", "Card_Num", "Transaction_Dt",
            "Transaction_Amount", "Transaction_Purpose"]
    for months, _ in s.emi_percentages:
        cols += [F.col(f"EMI_{months}_month"), (F.col(f"EMI_{months}_month") * months).alias(f"PayAfter{months}month")]
    return inter.filter(F.col("EMI_Eligible") == "Y").select(*cols)


def card_totals(inter: DataFrame) -> DataFrame:
    """Sum of transaction amounts per customer, card, (birth) year and month."""
    return inter.groupBy("Cust_Id", "Card_Num", "YEAR", "MONTH", "FIRST_NAME", "LAST_NAME").agg(
        F.sum(F.col("Transaction_Amount").cast(MONEY)).cast("double").alias("Latest_Transaction"))


def previous_order() -> list:
    """The reference's window order (YEAR, MONTH desc) plus the card as tie-break."""
    return [F.col("YEAR").asc(), F.col("MONTH").desc(), F.col("Card_Num").asc()]


PREVIOUS_COLUMNS = ["Cust_Id", "YEAR", "MONTH", "FIRST_NAME", "LAST_NAME", "Latest_Transaction", "PREVIOUS_TRANSACTION"]


def previous_transaction(inter: DataFrame, ordered: bool = False) -> DataFrame:
    """Card totals with the total of the previous card of the same customer,
    year and month.  The reference orders by YEAR, MONTH desc -- constant
    inside the group -- so the card number breaks the tie (deterministic).
    The lag is computed by range so a customer with very many cards is
    spread over many tasks."""
    lagged = lag_by_range(card_totals(inter), ["Cust_Id", "YEAR", "MONTH"], previous_order(), "Latest_Transaction",
                          "PREVIOUS_TRANSACTION")
    # The rows of a hot customer differ in month and card, so the sort's ranges can cut them.
    out = lagged.orderBy("YEAR", "Cust_Id", F.col("MONTH").desc(), "Card_Num") if ordered else lagged
    return out.select(*PREVIOUS_COLUMNS)


def credit_threshold(inter: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Customers whose remaining limit is at most the threshold percentage."""
    ratio = F.try_divide(F.col("Cust_credit_limit_remaining"), F.col("Credit_Limit")) * 100
    return (inter.select("FIRST_NAME", "LAST_NAME", "COUNTRY", "Cust_credit_limit_remaining",
                         F.col("Credit_Limit").alias("Total_Credit_Limit"), ratio.alias("Ratio"))
            .filter(F.col("Ratio") <= F.lit(float(s.notify_threshold))))
