"""The original method names return the original result types."""

import pytest

from aloft.plans import FlightAnalytics, PlaceAnalytics, PlayerModel, SocialGraph
from tests.conftest import write_text
from tests.test_flights import COLS, TEN, flight_line
from tests.test_graph import DUMP
from tests.test_places import CODES, PLACES, place_line
from tests.test_players import ROWS, player_line


def test_flight_names(spark, tmp_path):
    path = write_text(tmp_path, "s.csv", COLS + "\n" + "\n".join(
        flight_line(i, *r) for i, r in enumerate(TEN)) + "\n")
    fa = FlightAnalytics(spark)
    df = fa.loadDataAndRegister(path)
    assert fa.flightCount(df).first()["TailNum"] == "N961DL"
    assert fa.leastSquares(df) == (0.0, 0.0)
    assert fa.distanceMedian(df).first()[0] == 719.0
    assert fa.runningAverage(df).first()["date"] == "2008-05-10"
    assert fa.cancelledDueToSecurity(df).count() == 0
    assert fa.longestWeatherDelay(df).first()[0] is None
    assert fa.timeSpentTaxiing(df).count() == 4


def test_place_and_graph_names(spark, tmp_path):
    path = write_text(tmp_path, "p.txt", "\n".join(place_line(i, *p)
                                                  for i, p in enumerate(PLACES)) + "\n")
    codes = write_text(tmp_path, "c.csv", CODES)
    pa = PlaceAnalytics(spark, path)
    data = pa.filterData()
    assert pa.elevationAverage(pa.filterElevation("US", data)) == pytest.approx(110.7)
    assert pa.mostCommonWords(data).first()["word"] == "Inn"
    assert pa.mostCommonCountry(data, codes) == "United States"
    assert pa.hotelsInArea(37.80626, -122.41628) == 2
    g = SocialGraph.loadSocial(spark, write_text(tmp_path, "g.txt", DUMP))
    assert g.mostActiveUser() == 1 and g.pageRankHighest() == 1


def test_player_names(spark, tmp_path):
    path = write_text(tmp_path, "d.data", "\n".join(player_line(i, *r)
                                                   for i, r in enumerate(ROWS)) + "\n")
    pm = PlayerModel(spark)
    scaled = pm.scaler(pm.featureAssembler(pm.indexer(pm.convert(path))), "scaledFeatures")
    model = pm.createModel(scaled, "scaledFeatures", "paid_customer", "prediction")
    assert pm.predict(model, scaled).count() == len(ROWS)
