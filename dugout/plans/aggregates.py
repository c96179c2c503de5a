"""The three analytical aggregates (payroll, physiques, league pitching baseline).

Each is a single grouped aggregation with map-side partial aggregation; the outputs are
small (one row per team-season / league-season) and are what awards and metrics read.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.functions.aggregates import mean_half_up, moments, with_stddev
from dugout.functions.numeric import div_half_up_sql
from dugout.operators.median import summaries
from dugout.params import Params


def team_payroll(salaries: DataFrame, salary_col: str = "salary", with_max: bool = True) -> DataFrame:
    """Per (year, team, league): roster size, total (bigint), mean, median, max salary, all from one histogram of cents."""
    keys = ["year_id", "team_id", "lg_id"]
    s = summaries(salaries, keys, {"pay": (salary_col, 2)}, {"median_salary_usd": "pay"})
    cols = [F.col("_rows").alias("roster_size"),
            F.expr(f"CAST({div_half_up_sql('_s_pay', '100', 0, 38, wide=True)} AS BIGINT)").alias("total_payroll_usd"),
            F.expr(div_half_up_sql("_s_pay", "_n_pay * 100", 2, 18, wide=True)).alias("avg_salary_usd"), "median_salary_usd"]
    top = (F.col("_max_pay").cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(salaries.schema[salary_col].dataType)
    return s.select(*keys, *cols, *([top.alias("max_salary_usd")] if with_max else []))


def team_physiques(batting: DataFrame, people: DataFrame, weight: str = "weight",
                   height: str = "height", with_median: bool = False) -> DataFrame:
    """Per (team, year): batting rows of players with a known weight or height, and the
    mean / sample-stddev (and optionally median) of their weight and height.

    The facts are read once: medians, means and deviations come from one histogram of both columns."""
    keys = ["team_id", "year_id"]
    bodies = (people.select("player_id", F.col(weight).alias("w"), F.col(height).alias("h"))
              .where(F.col("w").isNotNull() | F.col("h").isNotNull()))
    rows = batting.select("team_id", "year_id", "player_id").join(bodies, "player_id")
    if with_median:
        out = summaries(rows, keys, {"w": ("w", 0), "h": ("h", 0)}, {"median_weight_lbs": "w", "median_height_in": "h"})
    else:
        out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *moments(F.col("w"), 0, "w"), *moments(F.col("h"), 0, "h"))
    # the moments are dropped with each deviation: the means come first
    out = out.withColumns({f"avg_{x}": F.expr(div_half_up_sql(f"_s_{x}", f"_n_{x}", 2, 6, wide=True)) for x in "wh"})
    out = with_stddev(with_stddev(out, "w", 0, 2, 6), "h", 0, 2, 6)
    medians = ["median_weight_lbs", "median_height_in"] if with_median else []
    return out.select(*keys, F.col("_rows").alias("batter_appearances"), F.col("avg_w").alias("avg_weight_lbs"), F.col("avg_h").alias("avg_height_in"),
                      F.col("w").alias("stddev_weight_lbs"), F.col("h").alias("stddev_height_in"), *medians)


def league_pitching_baseline(pitching: DataFrame, params: Params = Params()) -> DataFrame:
    """Per (year, league) over rows with era > 0: row count (all such rows, qualified or not),
    and mean / sample stddev of ERA over rows with ipouts >= floor, as numeric(6,3)."""
    qualified = F.col("ipouts") >= params.ip_floor
    out = (pitching.where(F.col("era").isNotNull() & (F.col("era") > 0))
            .groupBy("year_id", "lg_id")
            .agg(F.count(F.lit(1)).alias("qualified_pitchers"),
                 mean_half_up("era", 2, 3, 6, cond=f"ipouts >= {params.ip_floor}", wide=True).alias("league_era_mean"),
                 *moments(F.col("era"), 2, "league_era_stddev", qualified)))
    return with_stddev(out, "league_era_stddev", 2, 3, 6)
