"""Property test: exact half-away-from-zero division equals rational arithmetic."""

from decimal import Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dugout.functions.numeric import div_half_up, div_half_up_sql


def _expected(n, d, scale):
    if n is None or d is None or d == 0:
        return None
    x = Fraction(n, d) * 10 ** scale
    q = (2 * abs(x.numerator) + x.denominator) // (2 * x.denominator)
    q = -q if x < 0 else q
    return Decimal(q).scaleb(-scale)


pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**9, 10**9)),
                           st.one_of(st.none(), st.integers(-10**6, 10**6))), min_size=1, max_size=200)


@settings(max_examples=8, deadline=None)
@given(rows=pairs, scale=st.sampled_from([0, 1, 2, 3, 6, 7, 9, 12]), wide=st.booleans())
def test_div_half_up_is_exact(spark, rows, scale, wide):
    if scale > 6 and not wide:          # 10**12 * 1e9 does not fit 64 bits: the wide path's job
        rows = [(n if n is None else n % 1000, d) for n, d in rows]
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select(div_half_up(F.col("n"), F.col("d"), scale, 30, wide).alias("a"),
                    F.expr(div_half_up_sql("n", "d", scale, 30, wide)).alias("b")).collect()
    assert "E-" not in div_half_up_sql("n", "d", scale, 30, wide)
    out = df.select(div_half_up(F.col("n"), F.col("d"), scale, 30, wide).alias("a"),
                    F.expr(div_half_up_sql("n", "d", scale, 30, wide)).alias("b"))
    # no intermediate may have lost scale: both results are DECIMAL(30, scale)
    assert [f.dataType.simpleString() for f in out.schema.fields] == [f"decimal(30,{scale})"] * 2
    for (n, d), r in zip(rows, got):
        want = _expected(n, d, scale)
        assert r.a == want and r.b == want, (n, d, scale, r, want)


def test_ratio_sql_and_column_forms_agree(spark):
    from dugout.functions.numeric import ratio
    df = spark.createDataFrame([(Decimal("10.50"), 4), (Decimal("-0.05"), 2), (Decimal("7.00"), 0), (None, 3)],
                               "s decimal(12,2), n int")
    got = df.select(ratio("s", "n", 2, 20, num_scale=2).alias("a"),
                    ratio(F.col("s"), F.col("n"), 2, 20, num_scale=2).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(Decimal("2.63"), Decimal("2.63")), (Decimal("-0.03"), Decimal("-0.03")),
                                         (None, None), (None, None)]


groups = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-50, 50))),
                  min_size=1, max_size=120)


@settings(max_examples=6, deadline=None)
@given(rows=groups, n=st.integers(1, 12))
def test_ntile_and_median_match_builtins(spark, rows, n):
    from pyspark.sql import Window

    from dugout.operators.median import median_by
    from dugout.operators.ntile import ntile
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, g string, v int")
    want = {r.id: r.b for r in df.select(
        "id", F.ntile(n).over(Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first(), "id")).alias("b")).collect()}
    got = {r.id: r.b for r in ntile(df, n, ["g"], "v", ["id"], "b").collect()}
    assert got == want
    pct = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    med = {r.g: r.median for r in median_by(df, ["g"], "v").collect()}
    assert med == {k: v for k, v in pct.items() if v is not None}



def test_wide_path_handles_quotients_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**13 + 7, 3), (-(10**13 + 7), 3)], "n long, d long")
    r = df.select(div_half_up(F.col("n"), F.col("d"), 12, 30, wide=True).alias("a"),
                  F.expr(div_half_up_sql("n", "d", 12, 30, True)).alias("b")).collect()
    want = Decimal("3333333333335.666666666667")
    assert [(x.a, x.b) for x in r] == [(want, want), (-want, -want)]


@settings(max_examples=5, deadline=None)
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**8, 10**8)),
                               st.one_of(st.none(), st.integers(-10**4, 10**4))), min_size=1, max_size=100),
       scale=st.integers(0, 4), num_scale=st.integers(0, 3), den_scale=st.integers(0, 2))
def test_ratio_forms_match_rationals(spark, rows, scale, num_scale, den_scale):
    from dugout.functions.numeric import ratio
    df = spark.createDataFrame(
        [(None if a is None else Decimal(a).scaleb(-num_scale), None if b is None else Decimal(b).scaleb(-den_scale))
         for a, b in rows], f"a decimal(20,{num_scale}), b decimal(12,{den_scale})")
    got = df.select(ratio("a", "b", scale, 30, num_scale=num_scale, den_scale=den_scale).alias("x"),
                    ratio(F.col("a"), F.col("b"), scale, 30, num_scale=num_scale, den_scale=den_scale).alias("y")
                    ).collect()
    for (a, b), r in zip(rows, got):
        want = None if a is None or b is None or b == 0 else _expected(a * 10 ** den_scale, b * 10 ** num_scale, scale)
        assert r.x == want and r.y == want, (a, b, r, want)
