"""Pipeline settings, with the defaults of the reference's parameter file."""

from __future__ import annotations

import datetime as dt
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Names of the parameter file that are read: the names of the raw files, which the
# reference has in its code, then the reference's own (fixed values).
PARAMETERS = (
    "CustomerFile", "AccountFile", "TransactionFile", "SanctionedFile",
    "InputFilePath", "TempFilePath", "OutputFilePath", "RejectFilePath", "TransactionOPPath", "Inter_Table_Path",
    "DatabaseName", "Annual_Income_Limit1", "Annual_Income_Limit2", "Annual_Income_Limit3", "Annual_Income_Score1",
    "Annual_Income_Score2", "Annual_Income_Score3", "Annual_Income_Score4", "Credit_Limit_Multiplier",
    "Month_EMI_Percentage_3", "Month_EMI_Percentage_6", "Month_EMI_Percentage_9", "Cred_Notify_Threshold",
)
# Fixed value: a name of the parameter file that the reference sets and does not use.
UNUSED = ("Date_Format_trn",)


@dataclass(frozen=True)
class Settings:
    # Defaults of the parameter file (limits, scores, multiplier,
    # EMI percentages per tenure in months, notification threshold in percent).
    income_limits: tuple[float, float, float] = (1000000, 2000000, 3000000)
    income_scores: tuple[int, int, int, int] = (100, 200, 400, 500)
    credit_limit_multiplier: float = 2
    emi_percentages: tuple[tuple[int, float], ...] = ((3, 9), (6, 11), (9, 13))
    notify_threshold: float = 75

    # Names of the raw files in the input folder.
    customer_file: str = "customers.csv"
    account_file: str = "accounts.csv"
    transaction_file: str = "transactions.csv"
    sanctioned_file: str = "sanctioned.csv"
    database: str = "cardflow"
    input_path: str | None = None
    temp_path: str | None = None
    output_path: str | None = None
    reject_path: str | None = None
    inter_table_path: str | None = None
    transaction_path: str | None = None
    # Day the tenure is measured at; None means current_date() of the session.
    as_of: dt.date | None = None
    # Accepted values of CUST_PEP_EXPOSED after upper-casing.
    pep_accepted: tuple[str, ...] = ("TRUE",)
    # Bucket count of the partitioned output tables; None sizes it from their rows.
    buckets: int | None = None
    # Buckets by customer id of all three stage tables, whose joins then read them without a
    # shuffle; choose as many as shuffle partitions.  None: the joins shuffle, and AQE sizes them.
    co_partition: int | None = None
    # Share of a raw file's records that may not fit its layout; more stops a run from a
    # parameter file before it writes anything.  None: no such gate.
    bad_share: float | None = None
    # Key of the transaction dedup: the reference keeps one transaction per
    # account; add e.g. the date and amount to keep the full history.
    transaction_key: tuple[str, ...] = ("Cust_Id", "Account_Num")

    def as_of_col(self) -> Column:
        return F.lit(self.as_of) if self.as_of is not None else F.current_date()

    @classmethod
    def from_rows(cls, pairs: dict[str, str], **overrides) -> "Settings":
        """Build settings from the parameter names of the reference's file."""
        def num(name, default):
            return float(pairs[name]) if name in pairs else default

        d = cls()
        kw = dict(
            income_limits=tuple(num(f"Annual_Income_Limit{i}", d.income_limits[i - 1]) for i in (1, 2, 3)),
            income_scores=tuple(int(num(f"Annual_Income_Score{i}", d.income_scores[i - 1])) for i in (1, 2, 3, 4)),
            credit_limit_multiplier=num("Credit_Limit_Multiplier", d.credit_limit_multiplier),
            emi_percentages=tuple((n, num(f"Month_EMI_Percentage_{n}", p)) for n, p in d.emi_percentages),
            notify_threshold=num("Cred_Notify_Threshold", d.notify_threshold),
            customer_file=pairs.get("CustomerFile", d.customer_file),
            account_file=pairs.get("AccountFile", d.account_file),
            transaction_file=pairs.get("TransactionFile", d.transaction_file),
            sanctioned_file=pairs.get("SanctionedFile", d.sanctioned_file),
            database=pairs.get("DatabaseName", d.database),
            input_path=pairs.get("InputFilePath"),
            temp_path=pairs.get("TempFilePath"),
            output_path=pairs.get("OutputFilePath"),
            reject_path=pairs.get("RejectFilePath"),
            inter_table_path=pairs.get("Inter_Table_Path"),
            transaction_path=pairs.get("TransactionOPPath"),
        )
        kw.update(overrides)
        return cls(**kw)

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str, **overrides) -> "Settings":
        """Read a `Parameter,Value` CSV into settings.  Only the known names are
        kept, so at most one row per name reaches the driver however long the
        file is; a repeated name keeps its first value.  Other names are warned of, up
        to ten of them."""
        df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
        first = (df.withColumn("_at", F.monotonically_increasing_id())
                 .filter(F.col("Parameter").isin(list(PARAMETERS)))
                 .groupBy("Parameter").agg(F.min_by("Value", "_at").alias("Value")))
        other = df.filter(~F.col("Parameter").isin([*PARAMETERS, *UNUSED])).select("Parameter").distinct().limit(10).collect()
        if other:
            warnings.warn("unknown parameters: " + ", ".join(sorted(r["Parameter"] for r in other)), stacklevel=2)
        return cls.from_rows({r["Parameter"]: r["Value"] for r in first.collect() if r["Value"] is not None}, **overrides)
