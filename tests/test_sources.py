"""Reader edge cases: quotes in TSV names, malformed numbers, NA in strings,
social dump noise."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aloft.operators import exact_percentile, field_mean
from aloft.sources import (load_flights, parse_flight_lines, read_airports, read_country_codes,
                           read_csv_lines, read_places, read_players, read_social)
from tests.conftest import write_text
from tests.test_flights import COLS, flight_line
from tests.test_places import place_line

# a failed task reaches Python as one or the other
FAILS = (PySparkException, Py4JJavaError)


def test_places_keep_quotes_in_names(spark, tmp_path):
    path = write_text(tmp_path, "p.txt", place_line(0, 'The "Grand" Hotel', 1.0, 2.0, 5) + "\n"
                      + place_line(1, "Joe's Inn", 1.0, 2.0, 7) + "\n")
    rows = [tuple(r) for r in read_places(spark, path).select("name", "dem").collect()]
    assert rows == [('The "Grand" Hotel', 5), ("Joe's Inn", 7)]


def test_players_malformed_number_fails(spark, tmp_path):
    line = "id,N,e,male,notanumber,addr,USA,1,0,0,0,0,0,0,0,no"
    path = write_text(tmp_path, "bad.data", line + "\n")
    with pytest.raises(FAILS):
        read_players(spark, path).collect()


def test_flights_na_in_string_column_is_null(spark, tmp_path):
    path = write_text(tmp_path, "f.csv", COLS + "\n" +
                      flight_line(0, "NA", "NA", "BBB", 1, 1, 1, 1, 1, 1) + "\n")
    r = load_flights(spark, path, view=None).first()
    assert r["TailNum"] is None and r["Origin"] is None and r["Dest"] == "BBB"


def test_country_codes_namibia_and_quoted(spark, tmp_path):
    path = write_text(tmp_path, "c.csv", 'Name,Code\n"Korea, Republic of",KR\nNamibia,NA\n')
    got = {r["Code"]: r["Name"] for r in read_country_codes(spark, path).collect()}
    assert got == {"KR": "Korea, Republic of", "NA": "Namibia"}


def test_social_dump_skips_noise(spark, tmp_path):
    path = write_text(tmp_path, "g.txt", " a | b \n 1|2\n3 | 4 | 5\n  7 |  8  \n|9\n\n10 | x\n")
    assert sorted(tuple(r) for r in read_social(spark, path).collect()) == [(1, 2), (7, 8)]


def test_csv_lines_with_na(spark):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([StructField("a", DoubleType()), StructField("b", StringType())])
    lines = spark.createDataFrame([("1.5,x",), ("NA,NA",), (",y",)], "value string")
    got = [tuple(r) for r in read_csv_lines(lines, schema, options={"nullValue": "NA"})
           .collect()]
    assert got == [(1.5, "x"), (None, None), (None, "y")]


def test_flights_bz2_compressed(spark, tmp_path):
    import bz2
    body = COLS + "\n" + "\n".join(flight_line(i, f"N{i}", "AAA", "BBB", 100 + i, 1, 1, 1, 1, 1)
                                   for i in range(50)) + "\n"
    path = tmp_path / "2008.csv.bz2"
    path.write_bytes(bz2.compress(body.encode()))
    df = load_flights(spark, str(path), view=None)
    assert df.count() == 50 and df.agg(F.sum("Distance")).first()[0] == sum(range(100, 150))


def _flights(tmp_path, name, *lines, header=COLS):
    return write_text(tmp_path, name, header + "\n" + "\n".join(lines) + "\n")


def test_malformed_flight_numbers_fail(spark, tmp_path):
    good = flight_line(0, "N1", "AAA", "BBB", 10, 1, 1, 1, 1, 1)
    fields = good.split(",")
    for column, bad in (("DepDelay", "abc"), ("Distance", "7.5")):
        broken = list(fields)
        broken[COLS.split(",").index(column)] = bad
        path = _flights(tmp_path, f"{column}.csv", good, ",".join(broken))
        df = load_flights(spark, path, view=None)
        with pytest.raises(FAILS):
            exact_percentile(df, column, 0.5, "m").collect()
        loose = load_flights(spark, path, view=None, permissive=True)
        assert loose.where(F.col(column).isNull()).count() == 1


def test_flight_columns_are_found_by_name(spark, tmp_path):
    names = COLS.split(",")
    fields = dict(zip(names, flight_line(0, "N1", "LAS", "JFK", 10, 1, 1, 1, 1, 1).split(",")))
    swapped = [{"Origin": "Dest", "Dest": "Origin"}.get(n, n) for n in names] + ["Extra"]
    fields["Extra"] = "e"
    line = ",".join(fields[n] for n in swapped)
    path = _flights(tmp_path, "swapped.csv", line, header=",".join(swapped))
    r = load_flights(spark, path, view=None).first()
    assert (r["Origin"], r["Dest"], r["TailNum"]) == ("LAS", "JFK", "N1")
    lines = spark.createDataFrame([(line,)], "value string")
    r = parse_flight_lines(lines, swapped).first()
    assert (r["Origin"], r["Dest"]) == ("LAS", "JFK")
    with pytest.raises(ValueError, match="Dest"):
        load_flights(spark, _flights(tmp_path, "short.csv", "1", header="Year"), view=None)


def test_airport_columns_are_found_by_name(spark, tmp_path):
    path = write_text(tmp_path, "a.csv", "iata,airport,city,country,state,lat,long\n"
                      "LAS,McCarran,Las Vegas,USA,NV,36.1,-115.1\n")
    r = read_airports(spark, path).first()
    assert (r["country"], r["state"]) == ("USA", "NV")


def test_files_with_another_header_order_fail(spark, tmp_path):
    (tmp_path / "d").mkdir()
    write_text(tmp_path / "d", "1.csv", "Name,Code\nA,AA\n")
    write_text(tmp_path / "d", "2.csv", "Code,Name\nBB,B\n")
    with pytest.raises(FAILS):
        read_country_codes(spark, str(tmp_path / "d")).collect()


def test_malformed_elevation_fails(spark, tmp_path):
    path = write_text(tmp_path, "p.txt", place_line(0, "a", 1.0, 2.0, 10) + "\n"
                      + place_line(1, "b", 1.0, 2.0, "xx") + "\n")
    with pytest.raises(FAILS):
        field_mean(read_places(spark, path), "dem", "m").collect()


@pytest.mark.parametrize("line", ["id,N,e,male,1,addr,USA,1,0,0",
                                  "id,N,e,male,,addr,USA,1,0,0,0,0,0,0,0,no",
                                  "id,N,e,male,1,addr,USA,1,0,0,0,0,0,,0,no",
                                  "id,N,e,male,1,addr,USA,1,0,0,0,0,0,0,0,no,17"])
def test_bad_player_lines_fail(spark, tmp_path, line):
    path = write_text(tmp_path, "bad.data", line + "\n")
    with pytest.raises(FAILS):
        read_players(spark, path).collect()
    assert read_players(spark, path, permissive=True).count() == 1
