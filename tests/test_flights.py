"""Q01-Q12 on the ten-flight fixture and the moving-average example."""

import pytest
from pyspark.sql import functions as F

from aloft.plans import FlightAnalytics
from aloft.sources import table_exists
from tests.conftest import write_text

# The documented input rows and their layout.
COLS = ("Year,Month,DayofMonth,DayOfWeek,DepTime,CRSDepTime,ArrTime,CRSArrTime,UniqueCarrier,"
        "FlightNum,TailNum,ActualElapsedTime,CRSElapsedTime,AirTime,ArrDelay,DepDelay,Origin,Dest,"
        "Distance,TaxiIn,TaxiOut,Cancelled,CancellationCode,Diverted,CarrierDelay,WeatherDelay,"
        "NASDelay,SecurityDelay,LateAircraftDelay")

# (TailNum, Origin, Dest, Distance, DepDelay, TaxiIn, TaxiOut, CarrierDelay, WeatherDelay)
TEN = [
    ("N961DL", "TPA", "CVG", 773, -3, 7, 11, "NA", "NA"),
    ("N3741S", "PIT", "CVG", 256, 58, 5, 9, 0, 0),
    ("N921DL", "CVG", "TPA", 773, 21, 4, 10, "NA", "NA"),
    ("N3732J", "CVG", "BWI", 430, -9, 4, 11, "NA", "NA"),
    ("N961DL", "CVG", "TPA", 773, -3, 5, 11, "NA", "NA"),
    ("N968DL", "ATL", "PHL", 665, -6, 9, 17, "NA", "NA"),
    ("N397DA", "MCO", "LGA", 950, -4, 11, 10, "NA", "NA"),
    ("N973DL", "CVG", "TPA", 773, -4, 4, 9, "NA", "NA"),
    ("N904DA", "SNA", "SLC", 588, -5, 3, 21, "NA", "NA"),
    ("N908DA", "SLC", "SNA", 588, -8, 8, 26, "NA", "NA"),
]


def flight_line(i, tail, org, dst, dist, dep, tin, tout, cd, wd, month=5, day=10, year=2008,
                cancelled=0, code="", carrier="DL"):
    return (f"{year},{month},{day},6,1000,1000,1200,1200,{carrier},{1000 + i},{tail},120,120,100,"
            f"0,{dep},{org},{dst},{dist},{tin},{tout},{cancelled},{code},0,{cd},{wd},NA,NA,NA")


@pytest.fixture(scope="module")
def ten(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("flights")
    body = "\n".join(flight_line(i, *r) for i, r in enumerate(TEN))
    path = write_text(d, "flights.csv", COLS + "\n" + body + "\n")
    fa = FlightAnalytics(spark)
    return fa, fa.load_data_and_register(path)


def test_q01_load_registers_view_and_types(spark, ten):
    fa, df = ten
    assert table_exists(spark, "airtraffic")
    assert len(df.columns) == 29
    types = dict(df.dtypes)
    assert types["TailNum"] == "string" and types["DepDelay"] == "int"
    assert df.where(F.col("WeatherDelay").isNull()).count() == 9
    assert df.count() == 10


def test_q02_flight_count(ten):
    fa, df = ten
    rows = fa.flight_count(df).collect()
    assert rows[0]["TailNum"] == "N961DL" and rows[0]["count"] == 2
    assert len(rows) == 9 and all(r["count"] == 1 for r in rows[1:])


def test_q03_security_empty(ten):
    fa, df = ten
    assert fa.cancelled_due_to_security(df).collect() == []


def test_q04_longest_weather_delay_null(ten):
    fa, df = ten
    rows = fa.longest_weather_delay(df).collect()
    assert len(rows) == 1 and rows[0][0] is None


def test_q07_taxi_both_sides(ten):
    fa, df = ten
    got = {r["airport"]: r["taxi"] for r in fa.time_spent_taxiing(df).collect()}
    assert got == pytest.approx({"CVG": 6.166666666666667, "TPA": 9.25, "SNA": 14.5,
                                 "SLC": 14.5})
    assert list(got) == ["CVG", "TPA", "SLC", "SNA"]


def test_q08_q09_percentiles(ten):
    fa, df = ten
    assert fa.distance_median(df).first()[0] == 719.0
    assert fa.score95(df).first()[0] == 0.0
    assert fa.distance_median(df, exact_bracket=False).first()[0] == 719.0


def test_q11_least_squares_degenerate(ten):
    fa, df = ten
    r = fa.least_squares(df).first()
    assert (r["intercept"], r["slope"]) == (0.0, 0.0)


def test_q12_running_average_single_day(ten):
    fa, df = ten
    rows = fa.running_average(df).collect()
    assert [(r["date"], round(r["moving_average"], 9)) for r in rows] == [("2008-05-10", 3.7)]


def _delay_frame(spark, rows):
    return spark.createDataFrame(
        [(2008, m, d, v) for m, d, v in rows], "Year int, Month int, DayofMonth int, DepDelay int")


DOC_EXAMPLE = [(3, 27, 12), (3, 27, -2), (3, 28, 3), (3, 29, -5), (3, 29, 12), (3, 30, 5),
               (3, 31, 47), (4, 1, 45), (4, 1, 2), (4, 2, -6), (4, 3, 0), (4, 3, 4), (4, 3, -2),
               (4, 4, 2), (4, 5, 27)]
DOC_EXPECTED = [13.222222222222221, 11.3, 8.846153846153847, 8.357142857142858, 9.6, 9.6,
                10.307692307692308, 10.916666666666666, 12.4, 13.222222222222221]


def test_q12_running_average_documented_example(spark):
    fa = FlightAnalytics(spark)
    rows = fa.running_average(_delay_frame(spark, DOC_EXAMPLE)).collect()
    assert [r["date"] for r in rows][0] == "2008-03-27" and len(rows) == 10
    assert [r["moving_average"] for r in rows] == pytest.approx(DOC_EXPECTED)


def test_q12_calendar_gap(spark):
    # a gap of more than five days: a row frame would mix 01-01 with 01-20
    fa = FlightAnalytics(spark)
    rows = fa.running_average(_delay_frame(spark, [(1, 1, 10), (1, 3, 20), (1, 20, 100),
                                                   (1, 24, 0)])).collect()
    got = {r["date"]: r["moving_average"] for r in rows}
    assert got == {"2008-01-01": 15.0, "2008-01-03": 15.0, "2008-01-20": 50.0,
                   "2008-01-24": 50.0}


@pytest.fixture(scope="module")
def dims(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("dims")
    carriers = write_text(d, "carriers.csv", "Code,Description\n"
                          "DL,Delta Air Lines Inc.\nAA,American Airlines Inc.\n"
                          "B6,JetBlue Airways\nZZ,Never Flew Air\n,Unknown Carrier\n"
                          "Y1,Twin Name Air\nY2,Twin Name Air\nZZ,Never Flew Air\n")
    airports = write_text(d, "airports.csv", "iata,airport,city,state,country,lat,long\n"
                          "LAS,Mc Carran Intl,Las Vegas,NV,USA,36.08,-115.15\n"
                          "JFK,John F Kennedy Intl,New York,NY,USA,40.64,-73.78\n"
                          "SFO,San Francisco Intl,San Francisco,CA,USA,37.62,-122.37\n"
                          "OAK,Metropolitan,Oakland,CA,USA,37.72,-122.22\n"
                          "MTR,Metropolitan,Montreal,QC,Canada,45.47,-73.74\n")
    return carriers, airports


@pytest.fixture(scope="module")
def routes(spark, tmp_path_factory, dims):
    d = tmp_path_factory.mktemp("routes")
    rows = [("N1", "LAS", "JFK", "B6"), ("N2", "LAS", "JFK", "B6"), ("N3", "LAS", "JFK", "DL"),
            ("N4", "JFK", "LAS", "AA"), ("N5", "SFO", "JFK", "DL"), ("N6", "OAK", "SFO", "Y1"),
            ("N7", "MTR", "SFO", "DL")]
    lines = []
    for i, (t, o, de, c) in enumerate(rows):
        canc = 1 if i in (4, 5) else 0
        code = "D" if i == 4 else ("B" if i == 5 else "")
        lines.append(flight_line(i, t, o, de, 100, 0, 5, 5, 0, 0, cancelled=canc, code=code,
                                 carrier=c))
    path = write_text(d, "routes.csv", COLS + "\n" + "\n".join(lines) + "\n")
    carriers, airports = dims
    fa = FlightAnalytics(spark, airports_path=airports, carriers_path=carriers)
    return fa, fa.load_data_and_register(path)


def test_q03_security_rows(routes):
    fa, df = routes
    assert [tuple(r) for r in fa.cancelled_due_to_security(df).collect()] == [(1004, "JFK")]


def test_q05_did_not_fly(routes):
    fa, df = routes
    got = sorted(r["Description"] for r in fa.did_not_fly(df).collect())
    # the duplicate ZZ row collapses (set semantics); the NULL code is kept;
    # both never-flown twins keep their own row
    assert got == ["Never Flew Air", "Twin Name Air", "Unknown Carrier"]


def test_q06_vegas_to_jfk(routes):
    fa, df = routes
    rows = [tuple(r) for r in fa.flights_from_vegas_to_jfk(df).collect()]
    assert rows == [("JetBlue Airways", 2), ("Delta Air Lines Inc.", 1)]


def test_q10_cancelled_share(routes):
    fa, df = routes
    rows = [tuple(r) for r in fa.cancelled_flights(df).collect()]
    # SFO 1 of 1, OAK 1 of 1 (Metropolitan shares its name with a Canadian airport)
    assert rows == [("San Francisco Intl", "San Francisco", 1.0),
                    ("Metropolitan", "Oakland", 1.0)]


def test_q07_domestic_filter(routes):
    fa, df = routes
    got = {r["airport"] for r in fa.time_spent_taxiing(df, domestic=True).collect()}
    assert "MTR" not in got and got == {"LAS", "JFK", "SFO"}


def test_q01_empty_and_quoted_fields(spark, tmp_path):
    line = flight_line(0, '""', "AAA", "BBB", 1, 1, 1, 1, 1, 1)
    line2 = flight_line(1, "", "AAA", "BBB", 1, 1, 1, 1, 1, 1)
    path = write_text(tmp_path, "e.csv", COLS + "\n" + line + "\n" + line2 + "\n")
    df = FlightAnalytics(spark).load_data_and_register(path)
    tails = sorted((r["TailNum"] is None, r["TailNum"]) for r in df.collect())
    assert tails == [(False, ""), (True, None)]


def test_q12_date_type_is_string(ten):
    fa, df = ten
    assert dict(fa.running_average(df).dtypes) == {"date": "string", "moving_average": "double"}
