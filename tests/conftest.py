import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dugout.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="dugout-tests", shuffle_partitions=8)
    yield s
    s.stop()


def D(x):
    return None if x is None else Decimal(str(x))


PITCH_COLS = "player_id string, year_id int, stint int, team_id string, lg_id string, gs long, ipouts long, er long, hr long, bb long, so long, hbp long, era decimal(6,2)"
BAT_COLS = "player_id string, year_id int, stint int, team_id string, lg_id string, ab long, h long, `2b` long, `3b` long, hr long, bb long, ibb long, hbp long, sh long, sf long"
PEOPLE_COLS = "player_id string, name_first string, name_last string, weight int, height int, death_year int, birth_country string"
TEAM_COLS = "year_id int, lg_id string, team_id string, name string, g int, w int, l int"
SAL_COLS = "year_id int, team_id string, lg_id string, player_id string, salary decimal(18,2)"


@pytest.fixture
def make_wh(spark):
    from pyspark.sql import functions as F

    from dugout.sources.schemas import SCHEMAS
    from dugout.sources.warehouse import Warehouse

    def whole(name, df):
        """The rows a test gives, with the table's other columns as nulls."""
        return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields if f.name not in df.columns])

    def build(people=(), teams=(), batting=(), pitching=(), salaries=()):
        raw = {
            "people": spark.createDataFrame(list(people), PEOPLE_COLS),
            "teams": spark.createDataFrame(list(teams), TEAM_COLS),
            "batting": spark.createDataFrame(list(batting), BAT_COLS),
            "pitching": spark.createDataFrame(list(pitching), PITCH_COLS),
            "salaries": spark.createDataFrame(list(salaries), SAL_COLS),
        }
        return Warehouse.derive({n: whole(n, df) for n, df in raw.items()})
    return build
