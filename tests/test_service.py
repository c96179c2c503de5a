"""Envelopes and bounded leaderboards over the sf0.001 fixture warehouse."""

import json

import pytest

from dugout.operators.envelope import as_json, require_winner
from dugout.params import Params
from dugout.plans import service as S
from dugout.sources.warehouse import Warehouse

P = Params.fixture()


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_testdata(spark, "/root/testdata/sf0.001")


def test_award_envelopes(wh):
    cases = [(S.heaviest_hitters(wh), "Heaviest Hitters"), (S.shortest_sluggers(wh), "Shortest Sluggers"),
             (S.biggest_spenders(wh), "Biggest Spenders"), (S.biggest_spenders(wh, 2000), "Biggest Spenders (2000)"),
             (S.bang_for_buck(wh, 2000), "Most Bang for the Buck (2000)"),
             (S.priciest_starter(wh, params=P), "Priciest Starter"),
             (S.team_ace(wh, params=P), "Canadian Ace")]
    for env, title in cases:
        row = require_winner(env)
        assert row.award == title
        doc = json.loads(as_json(env).first().json)
        assert set(doc) == {"award", "winner", "metric"}
    with pytest.raises(LookupError):
        require_winner(S.bang_for_buck(wh, 1900))
    with pytest.raises(ValueError):
        S.team_ace(wh, min_ipouts=0, params=P)


def test_leaderboard_limits(wh):
    assert S.fip_leaderboard(wh, 5, P).count() == 5
    assert S.woba_leaderboard(wh, 3, P).columns == ["batter", "year_id", "team_id", "pa", "obp", "slg", "woba"]
    assert S.era_plus_leaderboard(wh, 1, P).count() == 1
    for bad in (0, 101):
        with pytest.raises(ValueError):
            S.fip_leaderboard(wh, bad, P)
