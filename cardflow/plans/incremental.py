"""What is derived from the intermediate table, kept up by the years that changed.

Three tables lie beside the intermediate one, each with a directory per year (of birth, as
the reference has it): the card totals with their predecessors, whose groups lie inside a
year; the geography report's mergeable states; and a fingerprint of the rows of each year.
After some years of the intermediate table were replaced, `refresh` finds them by their
fingerprints and rewrites these years alone; the files of all others stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.plans import reports, sinks


def year_fingerprints(inter: DataFrame) -> DataFrame:
    """(YEAR, rows, digest): a sum of row hashes, so equal rows count each and order does not."""
    columns = [c for c in inter.columns if c != "YEAR"]
    return inter.groupBy("YEAR").agg(F.count(F.lit(1)).alias("rows"),
                                     F.sum(F.xxhash64(*sorted(columns)).cast("decimal(38,0)")).alias("digest"))


#: How each derived table follows from (any whole years of) the intermediate one.
DERIVED = {"previous": reports.previous_transaction, "geography": reports.geography_states, "years": year_fingerprints}


def replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrite the partitions of a table that `df` has rows of, and no others."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # insertInto reads the setting, not the writer's option
    try:
        df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)


def drop_years(spark: SparkSession, table: str, years: list[int]) -> None:
    for year in years:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (YEAR = {int(year)})")


def changed_years(spark: SparkSession, db: str) -> tuple[list[int], list[int]]:
    """(years with other rows than when the derived tables were written, those of them that
    have no rows any more).  One number per changed year reaches the driver."""
    known = spark.table(f"{sinks.quoted(db)}.card_years").select(
        F.col("YEAR").alias("_year"), F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
    now = year_fingerprints(spark.table(f"{sinks.quoted(db)}.card_intermediate"))
    both = now.join(known, F.col("YEAR") == F.col("_year"), "full_outer")
    other = both.filter(~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))))
    found = other.select(F.coalesce("YEAR", "_year").alias("year"), F.col("YEAR").isNull().alias("gone")).collect()
    return sorted(r["year"] for r in found), sorted(r["year"] for r in found if r["gone"])


def refresh(spark: SparkSession, db: str) -> list[int]:
    """Bring the derived tables up to date with the intermediate one; returns the years that
    were rewritten.  The fingerprints are written last, so a refresh that failed is repeated."""
    names = {n: f"{sinks.quoted(db)}.{n}" for n in ("card_intermediate", "card_previous", "card_geography", "card_years")}
    years, gone = changed_years(spark, db)
    if not years:
        return []
    rows = spark.table(names["card_intermediate"]).filter(F.col("YEAR").isin(years))
    for kind, derived in DERIVED.items():
        replace_partitions(derived(rows), names[f"card_{kind}"])
        drop_years(spark, names[f"card_{kind}"], gone)
    return years


def derived_writes(inter: DataFrame, db: str, suffix: str, path: str, version: str) -> list[Callable[[], None]]:
    """The writes of the derived tables of a whole intermediate frame, below `path` + _previous,
    _geography, _years."""
    def write(kind: str, derived: Callable[[DataFrame], DataFrame]) -> None:
        sinks.save_table(derived(inter), f"{sinks.quoted(db)}.{sinks.quoted(f'card_{kind}{suffix}')}",
                         f"{path.rstrip('/')}_{kind}{version}", ["YEAR"])

    return [partial(write, kind, derived) for kind, derived in DERIVED.items()]
