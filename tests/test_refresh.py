"""Refresh of the seasons that changed, against a full rebuild."""

import re

import pytest
from pyspark.sql import functions as F

from dugout.params import Params
from dugout.sources import sinks
from dugout.sources.fixtures import persist_raw
from dugout.sources.warehouse import Warehouse

P = Params.fixture()
FACTS = ("batting", "pitching", "salaries")


def changed(wh):
    """One season's salaries, another's batting rows, and a player's weight."""
    out = wh.tables()
    pay = out["salaries"].schema["salary"].dataType
    out["salaries"] = out["salaries"].withColumn("salary", F.when(F.col("year_id") == 1997, F.col("salary") + 5).otherwise(F.col("salary")).cast(pay))
    out["batting"] = out["batting"].where("NOT (year_id = 1996 AND stint = 1)")
    # a player who bats in few seasons, 1999 among them
    seasons = out["batting"].groupBy("player_id").agg(F.count_distinct("year_id").alias("n"), F.max(F.col("year_id") == 1999).alias("then"))
    who = seasons.where("then").orderBy("n", "player_id").first()[0]
    out["people"] = out["people"].withColumn("weight", F.when(F.col("player_id") == who, F.coalesce("weight", F.lit(180)) + 11).otherwise(F.col("weight")))
    return out, who


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("refresh"))
    persist_raw(spark, "/root/testdata/sf0.001", root)
    wh = Warehouse.from_parquet(spark, root)
    sinks.refresh_aggregates(wh, root, P)
    before = sinks.read_set(spark, root, "raw")
    tables, who = changed(wh)
    sinks.commit(spark, root, "raw", {t: sinks.stage(df, root, "raw", t, ("year_id",) if t in FACTS else ()) for t, df in tables.items()})
    return root, before, who


def test_seasons_that_differ(spark, roots):
    root, before, who = roots
    old, new = Warehouse.from_parquet(spark, root, before), Warehouse.from_parquet(spark, root)
    bats = {r["year_id"] for r in new.batting.where(F.col("player_id") == who).select("year_id").distinct().collect()}
    assert sinks.changed_seasons(old, new) == sorted({1996, 1997} | bats) and 1999 in bats and len(bats | {1996, 1997}) < 7
    assert sinks.changed_seasons(new, new) == []


def test_a_null_counts_by_its_place(spark, make_wh):
    row = lambda *x: ("p", 2000, 1, "T", "L", *x, 1, 1, 1, 1, 1, 1, 1, 1, 1)[:15]
    a, b = make_wh(batting=[row(None, 3)]), make_wh(batting=[row(3, None)])
    assert sinks.changed_seasons(a, b) == [2000] and sinks.changed_seasons(a, a) == []


def test_changed_seasons_equal_a_full_rebuild(spark, roots, tmp_path):
    root, before, _ = roots
    seasons = sinks.refresh_changed(spark, root, before, P)
    assert seasons
    wh, full = Warehouse.from_parquet(spark, root), str(tmp_path)
    names = sinks.refresh_aggregates(wh, full, P)
    assert len(names) == 7
    for name in names:
        got, want = (sinks.read_layer(spark, r, "analytics", name) for r in (root, full))
        assert got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 0
    version = sinks.read_set(spark, root, "analytics")
    assert sinks.refresh_changed(spark, root, sinks.read_set(spark, root, "raw"), P) == []
    assert sinks.read_set(spark, root, "analytics") == version


def test_only_the_seasons_folders_are_read(spark, roots):
    wh = Warehouse.from_parquet(spark, roots[0]).of_seasons([1997])
    for t in FACTS:
        df = getattr(wh, t)
        assert {r[0] for r in df.select(F.input_file_name()).distinct().collect() if "year_id=1997" not in r[0]} == set()
        assert re.search(r"PartitionFilters: \[[^\]]*year_id", df._jdf.queryExecution().executedPlan().toString())


def test_a_season_without_rows_goes(spark, roots, tmp_path):
    wh, root = Warehouse.from_parquet(spark, roots[0]), str(tmp_path)
    sinks.refresh_aggregates(wh, root, P)
    kept = Warehouse({t: (df.where("year_id <> 1997") if t in FACTS else df) for t, df in wh.tables().items()})
    sinks.refresh_aggregates(kept, root, P, [1997])
    for name in sinks.read_set(spark, root, "analytics"):
        df = sinks.read_layer(spark, root, "analytics", name)
        assert df.where("year_id = 1997").isEmpty() and not df.isEmpty()
