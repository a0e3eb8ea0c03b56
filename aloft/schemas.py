"""Explicit schemas of the raw inputs (no inference passes over large files).

Fixed values: column names, order and types are those of the input files.
"""

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)


def _struct(ddl_pairs, nullable=True):
    return StructType([StructField(n, t, nullable) for n, t in ddl_pairs])


# Flight table: 29 columns, all nullable; 'NA' marks NULL in the CSV.
_FLIGHT_INT = IntegerType()
FLIGHT = _struct([
    ("Year", _FLIGHT_INT), ("Month", _FLIGHT_INT), ("DayofMonth", _FLIGHT_INT),
    ("DayOfWeek", _FLIGHT_INT), ("DepTime", _FLIGHT_INT), ("CRSDepTime", _FLIGHT_INT),
    ("ArrTime", _FLIGHT_INT), ("CRSArrTime", _FLIGHT_INT), ("UniqueCarrier", StringType()),
    ("FlightNum", _FLIGHT_INT), ("TailNum", StringType()), ("ActualElapsedTime", _FLIGHT_INT),
    ("CRSElapsedTime", _FLIGHT_INT), ("AirTime", _FLIGHT_INT), ("ArrDelay", _FLIGHT_INT),
    ("DepDelay", _FLIGHT_INT), ("Origin", StringType()), ("Dest", StringType()),
    ("Distance", _FLIGHT_INT), ("TaxiIn", _FLIGHT_INT), ("TaxiOut", _FLIGHT_INT),
    ("Cancelled", _FLIGHT_INT), ("CancellationCode", StringType()), ("Diverted", _FLIGHT_INT),
    ("CarrierDelay", _FLIGHT_INT), ("WeatherDelay", _FLIGHT_INT), ("NASDelay", _FLIGHT_INT),
    ("SecurityDelay", _FLIGHT_INT), ("LateAircraftDelay", _FLIGHT_INT),
])

CARRIER = _struct([("Code", StringType()), ("Description", StringType())])

AIRPORT = _struct([
    ("iata", StringType()), ("airport", StringType()), ("city", StringType()),
    ("state", StringType()), ("country", StringType()), ("lat", DoubleType()),
    ("long", DoubleType()),
])

# Places: the 19-field tab-separated gazetteer layout.
PLACE = _struct([
    ("geonameid", IntegerType()), ("name", StringType()), ("asciiname", StringType()),
    ("alternatenames", StringType()), ("latitude", DoubleType()), ("longitude", DoubleType()),
    ("feature_class", StringType()), ("feature_code", StringType()),
    ("country_code", StringType()), ("cc2", StringType()), ("admin1", StringType()),
    ("admin2", StringType()), ("admin3", StringType()), ("admin4", StringType()),
    ("population", LongType()), ("elevation", IntegerType()), ("dem", IntegerType()),
    ("timezone", StringType()), ("modification_date", DateType()),
])

COUNTRY_CODE = _struct([("Name", StringType()), ("Code", StringType())])

# Players: 16 comma-separated fields, read positionally.
PLAYER_RAW = _struct([
    ("id", StringType()), ("name", StringType()), ("email", StringType()),
    ("gender", StringType()), ("age", StringType()), ("address", StringType()),
    ("country", StringType()), ("registered_ms", StringType()),
    ("friend_count", StringType()), ("lifetime", StringType()),
    ("citygame", StringType()), ("pictionarygame", StringType()),
    ("scramblegame", StringType()), ("snipergame", StringType()),
    ("revenue", StringType()), ("paid", StringType()),
])

PLAYER = StructType(
    [StructField("gender", DoubleType(), False), StructField("age", DoubleType(), False),
     StructField("country", StringType(), True)]
    + [StructField(c, DoubleType(), False) for c in
       ["friend_count", "lifetime", "game1", "game2", "game3", "game4", "paid_customer"]])

# The nine documented model features (the label is not one of them).
PLAYER_FEATURES = ["gender", "age", "country_index", "friend_count", "lifetime",
                   "game1", "game2", "game3", "game4"]
