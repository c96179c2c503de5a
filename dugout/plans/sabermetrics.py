"""Advanced pitching/batting metrics: FIP, wOBA, era-adjusted ERA, WAR proxies, leaderboards.

Each metric is "detail rows joined to their own league-season constants".  The constants are a
grouped aggregate (one row per year x league); the join back is on (year_id, lg_id) so rows with
a NULL league drop out, as in the reference.  All ratios are exact rationals rounded half away
from zero (see ``dugout.functions.numeric``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.functions.aggregates import mean_half_up
from dugout.functions.numeric import WIDE, div_half_up, div_half_up_sql, scaled
from dugout.operators.ntile import ntile
from dugout.operators.topk import Order, top_k_inner
from dugout.params import Params
from dugout.plans.aggregates import league_pitching_baseline
from dugout.sources.warehouse import Warehouse

c = F.col
KEYS = ["year_id", "lg_id"]

# wOBA linear weights (post-2010 scale), in thousandths, applied to
# unintentional walks, hit-by-pitch, singles, doubles, triples and home runs.
WOBA_WEIGHTS_MILLI = {"ubb": 690, "hbp": 722, "1b": 888, "2b": 1271, "3b": 1616, "hr": 2101}
# FIP coefficients 13*HR + 3*(BB + HBP) - 2*K.
FIP_HR, FIP_BB, FIP_K = 13, 3, 2


def _z(col):
    return F.coalesce(col, F.lit(0))


def fip_raw(hr, bb, hbp, so):
    """13*HR + 3*(BB + HBP) - 2*K (the FIP numerator before dividing by innings)."""
    return F.lit(FIP_HR) * hr + F.lit(FIP_BB) * (bb + hbp) - F.lit(FIP_K) * so


# ---- FIP (league-calibrated) ---------------------------------------------------------------

def fip_league_sums(pitching: DataFrame, params: Params = Params()) -> DataFrame:
    """Exact per-league sums behind the FIP constant (rows: ipouts >= floor, era not null)."""
    return (pitching.where((c("ipouts") >= params.ip_floor) & c("era").isNotNull())
            .groupBy(*KEYS)
            .agg(F.count("era").alias("_n"), F.sum(scaled(c("era"), 2)).alias("_se"),
                 F.sum(fip_raw(c("hr"), c("bb"), _z(c("hbp")), c("so"))).alias("_s"),
                 F.sum("ipouts").alias("_i")))


def _cfip_num_den(n, se, s, i):
    # c_fip = se/(100 n) - 3 s / i  =  (se*i - 300*s*n) / (100*n*i)
    w = lambda x: x.cast(WIDE)
    return w(se) * w(i) - w(s) * w(n) * 300, w(n) * w(i) * 100


def fip_constants(pitching: DataFrame, params: Params = Params()) -> DataFrame:
    """Per (year, league): mean ERA, weighted raw FIP (sum of numerators / sum of innings) and
    the constant c_fip that makes league FIP equal league ERA (scale 6)."""
    sums = fip_league_sums(pitching, params)
    num, den = _cfip_num_den(c("_n"), c("_se"), c("_s"), c("_i"))
    i_nz = F.nullif(c("_i"), F.lit(0))
    return sums.select(*KEYS,
                       div_half_up(c("_se"), c("_n") * 100, 6, 12, wide=True).alias("lg_era"),
                       div_half_up(c("_s") * 3, i_nz, 6, 12, wide=True).alias("lg_raw_fip"),
                       div_half_up(num, F.when(i_nz.isNotNull(), den), 6, 12, wide=True).alias("c_fip"))


def fip(pitching: DataFrame, params: Params = Params(), sums: DataFrame | None = None) -> DataFrame:
    """Qualified rows (ipouts >= floor) with FIP = raw/IP + c_fip rounded to 2 decimals.

    ``sums``: a written table of :func:`fip_league_sums` (see ``plans.constants``)."""
    sums = fip_league_sums(pitching, params) if sums is None else sums
    cnum, cden = _cfip_num_den(c("_n"), c("_se"), c("_s"), c("_i"))
    rows = pitching.where(c("ipouts") >= params.ip_floor).join(sums, KEYS)
    r = fip_raw(c("hr"), c("bb"), _z(c("hbp")), c("so")).cast(WIDE)
    ip = c("ipouts").cast(WIDE)
    i_nz = F.nullif(c("_i"), F.lit(0))
    # fip = 3r/ipouts + cnum/cden = (300*r*n*i + ipouts*cnum) / (ipouts*cden)
    num = r * c("_n").cast(WIDE) * c("_i").cast(WIDE) * 300 + ip * cnum
    return rows.select(
        "player_id", "year_id", "team_id", "lg_id", "stint", "innings_pitched", "era",
        div_half_up(num, F.when(i_nz.isNotNull(), ip * cden), 2, 8, wide=True).alias("fip"),
        div_half_up(cnum, F.when(i_nz.isNotNull(), cden), 6, 12, wide=True).alias("c_fip"))


NATURAL_KEY: Order = [("player_id", True, True), ("year_id", True, True), ("stint", True, True)]


def _leaderboard(df: DataFrame, people: DataFrame, name_col: str, order: Order, k: int, cols) -> DataFrame:
    """The first k rows that have a person: only the best few are looked up (see ``top_k_inner``)."""
    names = people.select("player_id", c("full_name").alias(name_col))
    rows = df.select("player_id", "stint", *[x for x in dict.fromkeys([*(o[0] for o in order), *cols]) if x not in ("player_id", "stint")])
    return top_k_inner(rows, names, "player_id", order, k).select(name_col, *cols)


def fip_leaderboard(wh: Warehouse, params: Params = Params(), k: int = 10, sums: DataFrame | None = None) -> DataFrame:
    return _leaderboard(fip(wh.pitching, params, sums), wh.people, "pitcher",
                        [("fip", True, False), *NATURAL_KEY], k,
                        ["year_id", "team_id", "innings_pitched", "era", "fip"])


# ---- wOBA ----------------------------------------------------------------------------------

def woba(batting: DataFrame, params: Params = Params()) -> DataFrame:
    """Qualified stints (pa >= floor, per stint row): linear-weights wOBA rounded to 3 decimals.

    BB, AB and H are deliberately not coalesced: a NULL there makes wOBA NULL (row kept)."""
    w = WOBA_WEIGHTS_MILLI
    z = {x: f"coalesce(`{x}`, 0)" for x in ("ibb", "hbp", "2b", "3b", "hr", "sf")}
    num = (f"{w['ubb']} * (bb - {z['ibb']}) + {w['hbp']} * {z['hbp']}"
           f" + {w['1b']} * (h - {z['2b']} - {z['3b']} - {z['hr']}) + {w['2b']} * {z['2b']}"
           f" + {w['3b']} * {z['3b']} + {w['hr']} * {z['hr']}")
    den = f"CAST(ab + bb - {z['ibb']} + {z['sf']} + {z['hbp']} AS BIGINT) * 1000"
    return (batting.where(c("pa") >= params.pa_floor)
            .select("player_id", "year_id", "team_id", "lg_id", "stint", "pa", "ab", "obp", "slg",
                    "ops", F.expr(div_half_up_sql(num, den, 3, 10)).alias("woba")))


def woba_leaderboard(wh: Warehouse, params: Params = Params(), k: int = 10) -> DataFrame:
    return _leaderboard(woba(wh.batting, params), wh.people, "batter",
                        [("woba", False, False), *NATURAL_KEY], k,
                        ["year_id", "team_id", "pa", "obp", "slg", "ops", "woba"])


# ---- era-adjusted ERA ------------------------------------------------------------------------

def era_scored(pitching: DataFrame, params: Params = Params(), baseline: DataFrame | None = None) -> DataFrame:
    """Qualified rows vs their league baseline: z-score (negative = better) and ERA+."""
    b = baseline if baseline is not None else league_pitching_baseline(pitching, params)
    rows = (pitching.where((c("ipouts") >= params.ip_floor) & c("era").isNotNull() & (c("era") > 0))
            .join(b.select(*KEYS, "league_era_mean", "league_era_stddev"), KEYS))
    e, m, s = "CAST(era * 100 AS BIGINT)", "CAST(league_era_mean * 1000 AS BIGINT)", \
        "CAST(league_era_stddev * 1000 AS BIGINT)"
    return rows.select(
        "player_id", "year_id", "team_id", "lg_id", "stint", "innings_pitched", "era",
        "league_era_mean", "league_era_stddev",
        F.expr(div_half_up_sql(f"{e} * 10 - {m}", s, 3, 10)).alias("era_z_score"),
        F.expr(f"CAST({div_half_up_sql(f'{m} * 10', e, 0, 10)} AS INT)").alias("era_plus"))


def era_adjusted(pitching: DataFrame, params: Params = Params(),
                 baseline: DataFrame | None = None) -> DataFrame:
    """``era_scored`` with the in-league percentile bucket: NTILE(100) per league-season, lowest ERA first (1 = best)."""
    return ntile(era_scored(pitching, params, baseline), 100, KEYS, "era", ["player_id", "stint"], "era_percentile")


def era_plus_leaderboard(wh: Warehouse, params: Params = Params(), k: int = 10,
                         baseline: DataFrame | None = None) -> DataFrame:
    return _leaderboard(era_scored(wh.pitching, params, baseline), wh.people, "pitcher",
                        [("era_plus", False, False), *NATURAL_KEY], k,
                        ["year_id", "team_id", "innings_pitched", "era", "league_era_mean",
                         "era_z_score", "era_plus"])


# ---- WAR proxies ---------------------------------------------------------------------------

def league_fip(rows: DataFrame) -> DataFrame:
    """Mean FIP of each league-season as numeric(6,3)."""
    return rows.groupBy(*KEYS).agg(mean_half_up("fip", 2, 3, 6, wide=True).alias("lg_fip"))


def league_woba(rows: DataFrame) -> DataFrame:
    """Mean wOBA of each league-season as numeric(5,3)."""
    return rows.groupBy(*KEYS).agg(mean_half_up("woba", 3, 3, 5, wide=True).alias("lg_woba"))


def pitching_war(pitching: DataFrame, params: Params = Params(), sums: DataFrame | None = None,
                 league: DataFrame | None = None) -> DataFrame:
    """((lg_fip - fip) * IP / 9) / 10, lg_fip = mean FIP of the league-season as numeric(6,3)."""
    f = fip(pitching, params, sums)
    j = f.join(league_fip(f) if league is None else league, KEYS)
    num = ("(CAST(lg_fip * 1000 AS BIGINT) - CAST(fip * 100 AS BIGINT) * 10)"
           " * CAST(innings_pitched * 10 AS BIGINT)")
    return j.select("player_id", "year_id", "team_id", "lg_id", "stint", "innings_pitched", "era",
                    "fip", "lg_fip", F.expr(div_half_up_sql(num, "9000", 2, 10)).alias("war_proxy"))


def batting_war(batting: DataFrame, params: Params = Params(), league: DataFrame | None = None) -> DataFrame:
    """(((woba - lg_woba) / scale) * PA) / 10, lg_woba = league mean wOBA as numeric(5,3)."""
    w = woba(batting, params)
    lg = league_woba(w) if league is None else league
    scale_c = Decimal(params.woba_scale) * 100          # 1.20 -> 120
    if scale_c != scale_c.to_integral_value():
        raise ValueError("woba_scale must have at most 2 decimals")
    num = "(CAST(woba * 1000 AS BIGINT) - CAST(lg_woba * 1000 AS BIGINT)) * CAST(pa AS BIGINT)"
    return (w.join(lg, KEYS)
            .select("player_id", "year_id", "team_id", "lg_id", "stint", "pa", "woba", "lg_woba",
                    F.expr(div_half_up_sql(num, str(int(scale_c)), 2, 10)).alias("war_proxy")))


def war_leaderboard(wh: Warehouse, params: Params = Params(), k: int = 10, sums: DataFrame | None = None,
                    fip_mean: DataFrame | None = None, woba_mean: DataFrame | None = None) -> DataFrame:
    """Batters and pitchers in one list (role B/P; IP NULL for batters), best WAR first."""
    names = wh.people.select("player_id", c("full_name").alias("player"))
    bat = (batting_war(wh.batting, params, woba_mean)
           .select("player_id", "year_id", "team_id", "stint", F.lit("B").alias("role"),
                   F.lit(None).cast("decimal(12,1)").alias("ip"), "war_proxy"))
    pit = (pitching_war(wh.pitching, params, sums, fip_mean)
           .select("player_id", "year_id", "team_id", "stint", F.lit("P").alias("role"),
                   c("innings_pitched").cast("decimal(12,1)").alias("ip"), "war_proxy"))
    order = [("war_proxy", False, False), ("role", True, True), *NATURAL_KEY]
    return (top_k_inner(bat.unionByName(pit), names, "player_id", order, k)
            .select("player", "year_id", "team_id", "role", "ip", "war_proxy"))
