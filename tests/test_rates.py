"""Derived columns: the edge cases of FIXTURES.md §3."""

from conftest import D


def P(pid, ipouts, so=0, bb=0, era=None, lg="L0", team="T0", year=2000, stint=1, gs=0, hr=0, hbp=0):
    return (pid, year, stint, team, lg, gs, ipouts, 0, hr, bb, so, hbp, D(era))


def test_innings_pitched_thirds(make_wh):
    wh = make_wh(pitching=[P("a", 300), P("b", 100), P("c", 0), P("d", None)])
    got = {r.player_id: r.innings_pitched for r in wh.pitching.collect()}
    assert got == {"a": D("100.0"), "b": D("33.3"), "c": D("0.0"), "d": None}
    assert str(wh.pitching.schema["innings_pitched"].dataType) == "DecimalType(12,1)"


def test_per_nine_guard(make_wh):
    wh = make_wh(pitching=[P("a", 0, so=5), P("b", 27, so=5, bb=1)])
    got = {r.player_id: (r.k_per_9, r.bb_per_9) for r in wh.pitching.collect()}
    assert got == {"a": (None, None), "b": (D("5.00"), D("1.00"))}


def B(pid, ab=0, h=0, b2=0, b3=0, hr=0, bb=0, ibb=0, hbp=0, sh=0, sf=0):
    return (pid, 2000, 1, "T0", "L0", ab, h, b2, b3, hr, bb, ibb, hbp, sh, sf)


def test_no_plate_appearances_and_ops_rounding(make_wh):
    wh = make_wh(batting=[B("zero"), B("third", ab=3, h=1)])
    got = {r.player_id: (r.pa, r.obp, r.slg, r.ops) for r in wh.batting.collect()}
    assert got["zero"] == (0, None, None, D("0.000"))
    # rounded once: 1/3 + 1/3 = 0.667, not 0.333 + 0.333
    assert got["third"] == (3, D("0.333"), D("0.333"), D("0.667"))


def test_full_name_never_null(make_wh):
    wh = make_wh(people=[("a", None, "X", 1, 1, None, "c"), ("b", "X", None, 1, 1, None, "c"),
                         ("c", None, None, 1, 1, None, "c")])
    got = {r.player_id: r.full_name for r in wh.people.collect()}
    assert got == {"a": "X", "b": "X", "c": ""}


def test_div_half_up_signs(spark):
    from pyspark.sql import functions as F

    from dugout.functions.numeric import div_half_up
    rows = spark.createDataFrame([(5, 2), (-5, 2), (5, -2), (1, 3), (2, 3), (7, 0), (None, 1)], "n long, d long")
    got = [r.x for r in rows.select(div_half_up(F.col("n"), F.col("d"), 0, 10).alias("x")).collect()]
    assert got == [D(3), D(-3), D(-3), D(0), D(1), None, None]
    got1 = [r.x for r in rows.select(div_half_up(F.col("n"), F.col("d"), 1, 10, wide=True).alias("x")).collect()]
    assert got1 == [D("2.5"), D("-2.5"), D("-2.5"), D("0.3"), D("0.7"), None, None]
