"""lag_by_range equals a plain window lag, also with one huge group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cardflow.operators import ordered
from cardflow.operators.ordered import lag_by_range


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lag_by_range_matches_window(spark):
    n = 30000
    df = spark.range(n).select(
        # two thirds of all rows in group 0, the rest in small groups, a few NULL groups and values
        F.when(F.col("id") % 3 != 0, F.lit(0)).when(F.col("id") % 97 == 0, F.lit(None))
         .otherwise(F.col("id") % 500).alias("g"),
        ((F.col("id") * 7919) % n).alias("o"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") * 1.5).alias("v"))
    w = Window.partitionBy("g").orderBy(F.col("o").asc_nulls_first())
    expected = df.withColumn("prev", F.lag("v").over(w))
    for parts in (1, 3, 16):
        got = lag_by_range(df, ["g"], [F.col("o").asc_nulls_first()], "v", "prev", num_partitions=parts)
        assert _rows(got) == _rows(expected)
    w_desc = Window.partitionBy("g").orderBy(F.col("o").desc_nulls_last())
    expected = df.withColumn("prev", F.lag("v").over(w_desc))
    got = lag_by_range(df, ["g"], [F.col("o").desc_nulls_last()], "v", "prev", num_partitions=5)
    assert _rows(got) == _rows(expected)


def test_lag_by_range_under_a_later_sort(spark):
    """Aggregated input, then a sort on top: the optimizer prunes the two
    branches differently and each would sample its own range boundaries;
    the checkpointed range assignment keeps them consistent."""
    n = 20000
    base = spark.range(n).select((F.col("id") % 997).alias("c"), ((F.col("id") * 31) % 5003).alias("card"),
                                 (F.col("id") % 3).alias("y"), (F.col("id") * 1.5).alias("amt"))
    agg = base.groupBy("c", "card", "y").agg(F.round(F.sum("amt"), 2).alias("tot"), F.first(F.lit("N")).alias("nm"))
    w = Window.partitionBy("c", "y").orderBy("card")
    expected = agg.withColumn("prev", F.lag("tot").over(w)).select("c", "y", "nm", "tot", "prev")
    got = lag_by_range(agg, ["c", "y"], [F.col("card").asc()], "tot", "prev") \
        .select("c", "y", "nm", "tot", "prev").orderBy("y", "c")
    assert _rows(got) == _rows(expected)


def test_ranges_follow_the_rows(spark, monkeypatch):
    """Few rows are not cut into as many ranges as there are shuffle partitions, each of which writes to all of them."""
    assert [ordered.range_count(n, 200) for n in (0, 1000, 495_360, 3_000_000, 50_000_000, 10 ** 9)] == [
        1, 1, 10, 60, 200, 1000]
    monkeypatch.setattr(ordered, "LEAST_ROWS_PER_RANGE", 1000)
    df = spark.range(6000).select(F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
                                  ((F.col("id") * 7919) % 6000).alias("o"), (F.col("id") * 1.5).alias("v"))
    expected = df.withColumn("prev", F.lag("v").over(Window.partitionBy("g").orderBy("o")))
    assert _rows(lag_by_range(df, ["g"], [F.col("o").asc_nulls_first()], "v", "prev")) == _rows(expected)
