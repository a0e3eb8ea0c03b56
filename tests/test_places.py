"""Q13-Q18 on the 50-place fixture (name, lat, lon, dem; all US)."""

import pytest

from aloft.plans import PlaceAnalytics
from tests.conftest import write_text

# The documented input rows and their layout.
PLACES = [
    ("Courtyard Long Beach Downtown", 33.76801, -118.18572, 19),
    ("Comfort Inn & Suites Near Universal Studios", 34.18204, -118.38508, 208),
    ("Best Western Meridian Inn & Suites. Anaheim-Orange", 33.77628, -117.8908, 42),
    ("Eurostars Dylan", 40.7521, -73.97882, 39),
    ("Best Western San Mateo Los Prados Inn", 37.54443, -122.28571, 1),
    ("Americas Best Value Inn Extended Stay Civic Center Ex.Abigail", 37.78075, -122.41607, 25),
    ("Holiday Inn Express Hotel & Suites San Francisco Fishermans Wharf", 37.80626, -122.41628, 7),
    ("Aida Shared Bathroom", 37.78072, -122.4121, 17),
    ("Citigarden Formerly Ramada Airport North", 37.65447, -122.40798, 6),
    ("Holiday Inn Express & Suites Sfo North", 37.65538, -122.40752, 5),
    ("Holiday Inn In'Tl Airport", 37.64685, -122.40428, 7),
    ("Galaxy Motel", 40.65659, -73.88925, 6),
    ("Ymca Greenpoint Shared Bathroom", 40.727, -73.95317, 8),
    ("Ymca Flushing Shared Bathroom", 40.76361, -73.82654, 21),
    ("Seton", 40.74976, -73.9762, 13),
    ("The Roosevelt", 40.7547, -73.97747, 29),
    ("The Village At Squaw Valley", 39.19824, -120.23279, 1896),
    ("Ritz Carlton Highlands Lake Tahoe", 39.3567, -120.18798, 1967),
    ("The Tuscan A Kimpton Hotel", 37.8065, -122.41408, 8),
    ("Comfort Inn Watsonville", 36.93776, -121.77689, 37),
    ("Days Inn & Suites Santa Barbara", 34.42746, -119.70977, 43),
    ("Best Western Plus Pepper Tree", 34.4407, -119.7487, 61),
    ("Hyatt", 34.41717, -119.6691, 9),
    ("Comfort Inn By The Bay - San F", 37.80112, -122.42411, 41),
    ("Comfort Inn & Suites Airport", 37.65447, -122.40488, 5),
    ("Indigo Santa Barbara", 34.41355, -119.69127, 6),
    ("Canary Hotel", 34.42048, -119.70266, 25),
    ("Motel 6 Ventura Beach 218", 34.26623, -119.27275, 6),
    ("Comfort Inn Ventura Beach", 34.26795, -119.27289, 5),
    ("Crowne Plaza Ventura", 34.27662, -119.29313, 14),
    ("Four Seasons The Biltmore Santa Barbara", 34.4167, -119.64219, 26),
    ("Inn By The Harbor - Santa Barb", 34.40949, -119.69802, 11),
    ("Fess Parker'S Doubletree - San", 34.41571, -119.67826, 3),
    ("Best Western Encinita Lodge", 34.43064, -119.72007, 50),
    ("Best Western Plus Pepper Tree Inn", 34.4407, -119.7487, 61),
    ("Canary A Kimpton Hotel", 34.421, -119.702, 22),
    ("Hotel Goleta - Santa Barbara", 34.4411, -119.82122, 17),
    ("Holiday Inn Express Santa Barbara", 34.41636, -119.69599, 11),
    ("Dolphin Bay Resort & Spa", 35.16421, -120.68949, 24),
    ("Best Western Plus Sonora Oaks", 37.97814, -120.33419, 653),
    ("Comfort Inn & Suites Sfo Airport", 37.65499, -122.40465, 6),
    ("Hilton Garden Inn San Francisco Arpt North", 37.6569, -122.401, 12),
    ("Embassy Suites San Fran", 37.65082, -122.40417, 4),
    ("Best Western Plus Grosvenor Ai", 37.64381, -122.40425, 4),
    ("Comfort Inn & Suites San Franc", 37.65483, -122.40524, 6),
    ("Days Inn San Francisco South Oyster Point Airport", 37.66366, -122.40075, 12),
    ("Baymont Inn & Suites Miami Airport West", 25.80923, -80.36934, 7),
    ("Best Western Premier Miami International Airport", 25.77172, -80.26293, 11),
    ("Residence Inn Miami Airport South", 25.78389, -80.2632, 10),
    ("Ramada Inn Miami Airport North", 25.8652, -80.32159, 9),
]


def place_line(i, name, lat, lon, dem):
    f = [str(9000000 + i), name, name, "", str(lat), str(lon), "S", "HTL", "US", "", "CA", "",
         "", "", "0", "", str(dem), "America/Los_Angeles", "2014-11-05"]
    return "\t".join(f)


CODES = ('Name,Code\nAfghanistan,AF\n"Bonaire, Sint Eustatius and Saba",BQ\nNamibia,NA\n'
         'United States,US\n')


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("places")
    path = write_text(d, "places.tsv", "\n".join(place_line(i, *p) for i, p in
                                                 enumerate(PLACES)) + "\n")
    codes = write_text(d, "codes.csv", CODES)
    pa = PlaceAnalytics(spark, path)
    return pa, pa.filter_data(), codes


def test_q13_filter_data(places):
    pa, data, _ = places
    rows = [tuple(r) for r in data.collect()]
    assert rows == [(n, "US", dem) for n, _, _, dem in PLACES]


def test_q14_q15_elevation(places):
    pa, data, _ = places
    elev = pa.filter_elevation("US", data)
    assert [r[0] for r in elev.collect()] == [p[3] for p in PLACES]
    assert pa.elevation_average(elev).first()[0] == pytest.approx(110.7)
    assert pa.filter_elevation("", data).count() == 0  # exact code, not substring


def test_q16_most_common_words(places):
    pa, data, _ = places
    rows = [tuple(r) for r in pa.most_common_words(data).collect()]
    assert len(rows) == 117
    assert rows[:4] == [("Inn", 22), ("&", 10), ("Airport", 9), ("Best", 9)]
    got = dict(rows)
    for w, c in [("Suites", 9), ("San", 8), ("Western", 8), ("Comfort", 7), ("-", 4),
                 ("In'Tl", 1), ("Suites.", 1), ("Ex.Abigail", 1), ("6", 1), ("A", 2)]:
        assert got[w] == c
    assert sum(got.values()) == sum(len(p[0].split()) for p in PLACES)


def test_q17_most_common_country(places):
    pa, data, codes = places
    assert [r[0] for r in pa.most_common_country(data, codes).collect()] == ["United States"]


def test_q17_quoted_and_missing_codes(spark, places, tmp_path):
    pa, _, codes = places
    df = spark.createDataFrame([("x", "BQ", 1), ("y", "BQ", 1), ("z", "NA", 2)],
                               "name string, country_code string, dem int")
    assert pa.most_common_country(df, codes).first()[0] == "Bonaire, Sint Eustatius and Saba"
    df2 = spark.createDataFrame([("z", "NA", 2)], "name string, country_code string, dem int")
    assert pa.most_common_country(df2, codes).first()[0] == "Namibia"
    df3 = spark.createDataFrame([("z", "QQ", 2)], "name string, country_code string, dem int")
    assert pa.most_common_country(df3, codes).first()[0] == ""


def test_q18_hotels_in_area(places):
    pa, _, _ = places
    assert pa.hotels_in_area(37.80626, -122.41628).first()[0] == 2
    assert pa.hotels_in_area(0.0, 0.0).first()[0] == 0
