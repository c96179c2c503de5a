"""Top-k over an inner join by slices, and exact deviations, medians and ranks from one pass."""

import math
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from dugout.functions.aggregates import moments, with_stddev
from dugout.operators.median import summaries
from dugout.operators.ntile import ranked
from dugout.operators.topk import ordering, top_k, top_k_inner

ORDER = [("v", False, False), ("id", True, True)]


def plain(rows, dim, k, order=ORDER):
    return [tuple(r) for r in top_k(rows.join(dim, "id"), ordering(order), k).select("id", "v", "name").collect()]


@pytest.mark.parametrize("missing", [0, 50, 95, 100])
def test_refill_when_the_best_rows_have_no_match(spark, missing):
    rows = spark.range(100).select("id", F.when(F.col("id") % 9 == 8, F.lit(None)).otherwise(F.floor((99 - F.col("id")) / 7)).cast("int").alias("v"))
    dim = spark.range(missing, 300).select("id", F.concat(F.lit("n"), "id").alias("name"))
    got = [tuple(r) for r in top_k_inner(rows, dim, "id", ORDER, 10, slack=3).select("id", "v", "name").collect()]
    assert got == plain(rows, dim, 10) and len(got) == min(10, 100 - missing)


def test_refill_keeps_rows_that_tie_with_the_last_key(spark):
    rows = spark.createDataFrame([(i, 1) for i in [1] * 30 + [2] * 3 + [None] * 2], "id long, v int")
    dim = spark.createDataFrame([(2, "b"), (1, "a")], "id long, name string").where("id = 2")
    got = top_k_inner(rows, dim, "id", [("v", True, False), ("id", True, True)], 3, slack=1)
    assert [tuple(r) for r in got.select("id", "v", "name").collect()] == [(2, 1, "b")] * 3


@pytest.mark.parametrize(("up", "first"), [(True, True), (True, False), (False, True), (False, False)])
def test_refill_in_every_null_order(spark, up, first):
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else i % 5) for i in range(40)], "id long, v int")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 40, 3)], "id long, name string")
    order = [("v", up, first), ("id", up, first)]
    got = [tuple(r) for r in top_k_inner(rows, dim, "id", order, 14, slack=1).select("id", "v", "name").collect()]
    assert got == plain(rows, dim, 14, order)


def test_rank_one_rows_only(spark):
    rows = spark.createDataFrame([(1, 9), (2, 9), (3, 9), (4, 8)], "id long, v int")
    names = lambda *ids: spark.createDataFrame([(i, "n") for i in ids], "id long, name string")
    assert [r.id for r in top_k_inner(rows, names(3, 4), "id", ORDER, 2, ["v"], slack=0).collect()] == [3]
    assert top_k_inner(rows, names(4), "id", ORDER, 1, ["v"]).collect() == []


def test_only_the_slice_is_looked_up(spark, tmp_path):
    spark.range(5000).select("id", F.lit("n").alias("name")).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    asked = []
    real = type(dim).where

    def where(self, cond):
        if "IN" in str(cond).upper():
            asked.append(real(self, cond))
        return real(self, cond)

    type(dim).where = where
    try:
        top_k_inner(spark.range(3000).withColumn("v", F.col("id") % 7), dim, "id", ORDER, 10)
    finally:
        type(dim).where = real
    plan = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert len(asked) == 1 and asked[0].count() == 50 and "PushedFilters: [In(id" in plan


# ---------------------------------------------------------------- standard deviation

def rooted(values, scale, population):
    n = len(values)
    d = n - (0 if population else 1)
    if d < 1:
        return None
    mean = sum(values) / Fraction(n)
    var = sum((v - mean) ** 2 for v in values) / d
    unit = Fraction(1, 10 ** scale)
    c = math.isqrt(math.floor(var / unit ** 2))
    return (c + 1 if (c + Fraction(1, 2)) ** 2 * unit ** 2 <= var else c) * unit


def units(decimals):
    return st.lists(st.integers(-10 ** 6, 10 ** 6).map(lambda u: Decimal(u).scaleb(-decimals)), min_size=1, max_size=12)


def deviations(spark, groups, decimals, scale, population=False, parts=3):
    rows = [(i, v) for i, g in enumerate(groups) for v in g]
    df = spark.createDataFrame(rows, f"g int, v decimal(20,{decimals})").repartition(parts)
    out = with_stddev(df.groupBy("g").agg(*moments(F.col("v"), decimals, "sd")), "sd", decimals, scale, 18, population)
    return {r.g: r.sd for r in out.collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(units(2), min_size=1, max_size=25), st.sampled_from([0, 1, 2, 3]), st.booleans())
def test_deviations_are_the_rounded_rational_root(spark, groups, scale, population):
    got = deviations(spark, groups, 2, scale, population)
    for i, values in enumerate(groups):
        want = rooted([Fraction(v) for v in values], scale, population)
        assert (got[i] is None) == (want is None) and (want is None or Fraction(got[i]) == want)


def test_deviations_at_ties_and_over_any_partitions(spark):
    # two values x and x + w: sample deviation w / sqrt 2, population deviation w / 2, exactly on a tie
    groups = [[Decimal("10.00"), Decimal(f"10.{w:02d}")] for w in range(1, 60, 2)] + [[Decimal("9999999.99")] * 5] + [[Decimal(1)]]
    runs = [deviations(spark, groups, 2, 2, True, parts) for parts in (1, 7, 200)]
    assert runs[0] == runs[1] == runs[2]
    assert [runs[0][i] for i in range(30)] == [Decimal((w + 1) // 2).scaleb(-2) for w in range(1, 60, 2)]
    assert runs[0][30] == 0 and runs[0][31] == 0


def test_deviation_of_fine_units(spark):
    values = [Decimal("1234.000000001"), Decimal("1234.000000001"), Decimal("0.000000002"), Decimal("77.5")]
    got = deviations(spark, [values], 9, 2, True)[0]
    assert Fraction(got) == rooted([Fraction(v) for v in values], 2, True)


# ---------------------------------------------------------------- one histogram, one ranking

def test_summaries_read_the_input_once(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 101).cast("int").alias("a"),
                             F.when(F.col("id") % 5 > 0, F.col("id") % 17).cast("int").alias("b")).write.parquet(path)
    df = spark.read.parquet(path)
    out = summaries(df, ["g"], {"a": ("a", 0), "b": ("b", 0)}, {"ma": "a", "mb": "b"})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert path not in plan                                # only the written histogram is read from here on
    want = df.groupBy("g").agg(F.count("*").alias("n"), F.percentile("a", F.lit(0.5)).alias("ma"), F.percentile("b", F.lit(0.5)).alias("mb"),
                               F.sum("b").alias("s"), F.sum(F.col("b") * F.col("b")).alias("q"), F.max("b").alias("m"), F.count("b").alias("c"))
    got = {r.g: (r._rows, r.ma, r.mb, int(r._s_b), int(r._q_b), r._max_b, r._n_b) for r in out.collect()}
    assert got == {r.g: (r.n, r.ma, r.mb, r.s, r.q, r.m, r.c) for r in want.collect()}


def test_rows_are_ranked_without_meeting_other_rows(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.lit(None)).alias("g"), (F.col("id") % 3).alias("v"))
    got = ranked(df, ["g"], "v", ["id"])
    w = Window.partitionBy("g")
    want = df.withColumn("_row", F.row_number().over(w.orderBy("v", "id"))).withColumn("_size", F.count("*").over(w))
    assert got.exceptAll(want.withColumn("_row", F.col("_row").cast("long")).select(got.columns)).isEmpty() and got.count() == 6000


def test_era_plus_leaderboard_ranks_nothing_it_drops(spark):
    from dugout.params import Params
    from dugout.plans import sabermetrics as K
    from dugout.sources.warehouse import Warehouse
    wh = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
    plan = K.era_scored(wh.pitching, Params.fixture())._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "monotonically" not in plan
