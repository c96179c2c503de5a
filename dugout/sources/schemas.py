"""Declared schemas of the five raw tables (columns in file order; never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType)

S, I, L, D = StringType(), IntegerType(), LongType(), DateType()    # L: counts, so a season of any number of games fits


def _struct(cols):
    return StructType([StructField(n, t, True) for n, t in cols])


PEOPLE = _struct([
    ("player_id", S), ("birth_year", I), ("birth_month", I), ("birth_day", I),
    ("birth_country", S), ("birth_state", S), ("birth_city", S),
    ("death_year", I), ("death_month", I), ("death_day", I),
    ("death_country", S), ("death_state", S), ("death_city", S),
    ("name_first", S), ("name_last", S), ("name_given", S), ("weight", I), ("height", I),
    ("bats", S), ("throws", S), ("debut", D), ("final_game", D), ("retro_id", S), ("bbref_id", S),
])

TEAMS = _struct([
    ("year_id", I), ("lg_id", S), ("team_id", S), ("franch_id", S), ("div_id", S),
    ("team_rank", I), ("g", I), ("ghome", I), ("w", I), ("l", I),
    ("div_win", S), ("wc_win", S), ("lg_win", S), ("ws_win", S),
    ("r", I), ("ab", I), ("h", I), ("2b", I), ("3b", I), ("hr", I), ("bb", I), ("so", I),
    ("sb", I), ("cs", I), ("hbp", I), ("sf", I), ("ra", I), ("er", I), ("era", DecimalType(5, 2)),
    ("cg", I), ("sho", I), ("sv", I), ("ipouts", I), ("ha", I), ("hra", I), ("bba", I), ("soa", I),
    ("e", I), ("dp", I), ("fp", DecimalType(5, 3)), ("name", S), ("park", S),
    ("attendance", I), ("bpf", I), ("ppf", I),
    ("team_id_br", S), ("team_id_lahman45", S), ("team_id_retro", S),
])

BATTING = _struct([
    ("player_id", S), ("year_id", I), ("stint", I), ("team_id", S), ("lg_id", S),
    ("g", L), ("ab", L), ("r", L), ("h", L), ("2b", L), ("3b", L), ("hr", L), ("rbi", L),
    ("sb", L), ("cs", L), ("bb", L), ("so", L), ("ibb", L), ("hbp", L), ("sh", L), ("sf", L),
    ("gidp", L),
])

PITCHING = _struct([
    ("player_id", S), ("year_id", I), ("stint", I), ("team_id", S), ("lg_id", S),
    ("w", L), ("l", L), ("g", L), ("gs", L), ("cg", L), ("sho", L), ("sv", L), ("ipouts", L),
    ("h", L), ("er", L), ("hr", L), ("bb", L), ("so", L), ("baopp", DecimalType(5, 3)),
    ("era", DecimalType(6, 2)), ("ibb", L), ("wp", L), ("hbp", L), ("bk", L), ("bfp", L),
    ("gf", L), ("r", L), ("sh", L), ("sf", L), ("gidp", L),
])

SALARIES = _struct([
    ("year_id", I), ("team_id", S), ("lg_id", S), ("player_id", S), ("salary", DecimalType(18, 2)),
])

SCHEMAS = {"people": PEOPLE, "teams": TEAMS, "batting": BATTING, "pitching": PITCHING,
           "salaries": SALARIES}

PRIMARY_KEYS = {
    "people": ("player_id",),
    "teams": ("year_id", "team_id"),
    "batting": ("player_id", "year_id", "stint"),
    "pitching": ("player_id", "year_id", "stint"),
    "salaries": ("year_id", "team_id", "lg_id", "player_id"),
}

TABLES = tuple(sorted(SCHEMAS))
