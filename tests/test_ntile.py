"""Histogram-numbered NTILE equals the window NTILE, including a group holding most rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from dugout.operators.ntile import ntile


def test_ntile_matches_window_with_hot_group(spark):
    df = (spark.range(0, 5000)
          .withColumn("g", F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 3).cast("string")))
          .withColumn("v", (F.col("id") * 7919) % 101))
    order = [F.col("v").asc(), F.col("id").asc()]
    want = df.withColumn("b", F.ntile(100).over(Window.partitionBy("g").orderBy(*order)))
    got = ntile(df, 100, ["g"], "v", ["id"], "b")
    assert got.count() == df.count()
    diff = got.select("id", "g", "v", "b").exceptAll(want.select("id", "g", "v", "b")).count()
    assert diff == 0
    small = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "g string, v int")
    rows = {(r.g, r.v): r.b for r in ntile(small, 100, ["g"], "v", [], "b").collect()}
    assert rows == {("a", 1): 1, ("a", 2): 2, ("a", 3): 3, ("b", 1): 1}


def test_median_by_matches_percentile(spark):
    from decimal import Decimal

    from dugout.operators.median import median_by
    df = (spark.range(0, 3001)
          .withColumn("g", F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 3).cast("string")))
          .withColumn("v", (((F.col("id") * 7919) % 1013) / F.lit(100)).cast("decimal(12,2)")))
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile(F.col("v") * 100, F.lit(0.5)).alias("m")).collect()}
    got = {r.g: r.median * 100 for r in median_by(df, ["g"], "v", 2).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    small = spark.createDataFrame([("a", Decimal(x)) for x in (1, 2, 3, 10)] + [("b", None), ("c", Decimal(7))],
                                  "g string, v decimal(12,2)")
    assert {r.g: r.median for r in median_by(small, ["g"], "v", 2).collect()} == {"a": 2.5, "c": 7.0}
