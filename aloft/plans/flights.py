"""Flight questions (Q01-Q12) over the 29-column flight table.

Method names follow the original API in snake_case, so a caller can switch
one for one.  Every method returns a DataFrame (Q11 too: one row with ``intercept`` and
``slope``).  They are lazy, except that loading reads the header line and the two percentiles
count values when called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.constants import (AIRPORT_VIEW, CARRIER_VIEW, DOMESTIC_COUNTRY, MEDIAN_P,
                             MOVING_AVERAGE_DAYS, SCORE_P, SECURITY_CANCELLATION_CODE,
                             VEGAS_TO_JFK, WEATHER_MONTHS)
from aloft.functions.columns import date_from_parts
from aloft.operators import (anti_lookup, builtin_percentile, conditional_share, count_by_key,
                             domestic_only, exact_percentile, filter_project, filtered_max,
                             least_squares, moving_average, route_counts, two_sided_mean)
from aloft.sources import load_flights, read_airports, read_carriers


class FlightAnalytics:
    def __init__(self, spark: SparkSession, airports_path: str | None = None,
                 carriers_path: str | None = None, airports: DataFrame | None = None,
                 carriers: DataFrame | None = None):
        self.spark = spark
        self.airports = airports if airports is not None else (
            read_airports(spark, airports_path) if airports_path else None)
        self.carriers = carriers if carriers is not None else (
            read_carriers(spark, carriers_path) if carriers_path else None)
        if self.airports is not None:
            self.airports.createOrReplaceTempView(AIRPORT_VIEW)
        if self.carriers is not None:
            self.carriers.createOrReplaceTempView(CARRIER_VIEW)

    # Q01
    def load_data_and_register(self, path: str) -> DataFrame:
        return load_flights(self.spark, path)

    # Q02
    def flight_count(self, df: DataFrame) -> DataFrame:
        return count_by_key(df, "TailNum", "count")

    # Q03
    def cancelled_due_to_security(self, df: DataFrame) -> DataFrame:
        return filter_project(df, (F.col("Cancelled") == 1)
                              & (F.col("CancellationCode") == SECURITY_CANCELLATION_CODE),
                              ["FlightNum", "Dest"])

    # Q04
    def longest_weather_delay(self, df: DataFrame) -> DataFrame:
        return filtered_max(df, "WeatherDelay", F.col("Month").between(*WEATHER_MONTHS),
                            "max_weather_delay")

    # Q05
    def did_not_fly(self, df: DataFrame) -> DataFrame:
        return anti_lookup(self.carriers, df, "Code", "UniqueCarrier",
                           select=["Description"], distinct=True)

    # Q06
    def flights_from_vegas_to_jfk(self, df: DataFrame, origin: str = VEGAS_TO_JFK[0],
                                  dest: str = VEGAS_TO_JFK[1]) -> DataFrame:
        return route_counts(df, self.carriers, "UniqueCarrier", "Code", "Description",
                            predicate=(F.col("Origin") == origin) & (F.col("Dest") == dest),
                            out_col="Num")

    # Q07
    def time_spent_taxiing(self, df: DataFrame, require_both: bool = True,
                           domestic: bool | None = None) -> DataFrame:
        """Flights within one country only; by default if the airports are known."""
        if domestic is None:
            domestic = self.airports is not None
        if domestic:
            if self.airports is None:
                raise ValueError("domestic flights need the airport table")
            df = domestic_only(df, self.airports, country=DOMESTIC_COUNTRY)
        return two_sided_mean(df, "Origin", "TaxiIn", "Dest", "TaxiOut",
                              out_key="airport", out_value="taxi", require_both=require_both)

    # Q08
    def distance_median(self, df: DataFrame, exact_bracket: bool = True) -> DataFrame:
        op = exact_percentile if exact_bracket else builtin_percentile
        return op(df, "Distance", MEDIAN_P, "median_distance")

    # Q09
    def score95(self, df: DataFrame, exact_bracket: bool = True) -> DataFrame:
        op = exact_percentile if exact_bracket else builtin_percentile
        return op(df, "CarrierDelay", SCORE_P, "p95_carrier_delay")

    # Q10
    def cancelled_flights(self, df: DataFrame) -> DataFrame:
        share = conditional_share(df, self.airports.select("iata", "airport", "city"),
                                  "Origin", "iata", F.col("Cancelled") == 1,
                                  ["iata", "airport", "city"], out_col="percentage")
        return (share.select("airport", "city", "percentage")
                .orderBy(F.desc("percentage"), F.desc("airport")))

    # Q11
    def least_squares(self, df: DataFrame) -> DataFrame:
        return least_squares(df, "DepDelay", "WeatherDelay", x_min=0)

    # Q12
    def running_average(self, df: DataFrame, days: int = MOVING_AVERAGE_DAYS) -> DataFrame:
        return moving_average(df, date_from_parts("Year", "Month", "DayofMonth"), "DepDelay",
                              days=days)

    # ------------------------------------------------------------------
    # Original method names.  They return what the original methods
    # returned: DataFrames, except ``leastSquares`` which gives the
    # (intercept, slope) tuple (one small aggregate collected).
    def loadDataAndRegister(self, path: str) -> DataFrame:  # noqa: N802
        return self.load_data_and_register(path)

    def flightCount(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.flight_count(df)

    def cancelledDueToSecurity(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.cancelled_due_to_security(df)

    def longestWeatherDelay(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.longest_weather_delay(df)

    def didNotFly(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.did_not_fly(df)

    def flightsFromVegasToJFK(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.flights_from_vegas_to_jfk(df)

    def timeSpentTaxiing(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.time_spent_taxiing(df)

    def distanceMedian(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.distance_median(df)

    def cancelledFlights(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.cancelled_flights(df)

    def leastSquares(self, df: DataFrame) -> tuple[float, float]:  # noqa: N802
        row = self.least_squares(df).first()
        return float(row["intercept"]), float(row["slope"])

    def runningAverage(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.running_average(df)
