"""Typed readers.

Every reader passes an explicit schema, so no inference job scans the input
and column pruning / predicate pushdown reach the file scan.

Malformed input fails the job (``FAILFAST``): a value that does not parse never turns into
NULL.  ``permissive=True`` asks for NULLs instead.  Spark parses only the columns a query
reads, so a bad value in an unread column goes unnoticed.  Headered files bind columns
by name: any order, further columns ignored, a missing one is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aloft import schemas
from aloft.constants import FLIGHT_NULL_TOKEN, FLIGHT_VIEW, MALE_TOKEN, PAID_TOKEN, SOCIAL_LINE
from aloft.functions.columns import text_flag


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the shared test data."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mode(permissive: bool) -> str:
    return "PERMISSIVE" if permissive else "FAILFAST"


def schema_in_order(schema: StructType, names: list[str], what: str) -> StructType:
    """``schema``'s fields in the order of a header's ``names``; other columns are strings."""
    types = {f.name: f.dataType for f in schema.fields}
    missing = [n for n in types if n not in names]
    if missing:
        raise ValueError(f"{what} lacks the column(s) {', '.join(missing)}")
    return StructType([StructField(n, types.get(n, StringType())) for n in names])


def read_headered(spark: SparkSession, path: str, schema: StructType, permissive: bool = False,
                  **options) -> DataFrame:
    """Headered CSV bound by column name.  The order is taken from the first file's header;
    ``enforceSchema=false`` makes Spark compare every file's header with it."""
    names = spark.read.option("header", True).csv(path).columns
    return (spark.read.schema(schema_in_order(schema, names, path))
            .options(header=True, mode=_mode(permissive), enforceSchema=permissive, **options)
            .csv(path).select(*schema.names))


def load_flights(spark: SparkSession, path: str, view: str | None = FLIGHT_VIEW,
                 permissive: bool = False) -> DataFrame:
    """Headered flight CSV, ``NA`` -> NULL, registered as a temp view.

    Empty unquoted fields also read as NULL; quoted empty strings stay ''.
    """
    df = read_headered(spark, path, schemas.FLIGHT, permissive, nullValue=FLIGHT_NULL_TOKEN)
    if view:
        df.createOrReplaceTempView(view)
    return df


def parse_flight_lines(lines: DataFrame, header: list[str], col: str = "value",
                       permissive: bool = False) -> DataFrame:
    """Q01 on a column of flight CSV lines whose columns are in the order of ``header``."""
    return _parse_headered(lines, schemas.FLIGHT, header, "the flight header", col, permissive,
                           {"nullValue": FLIGHT_NULL_TOKEN})


def _parse_headered(lines: DataFrame, schema: StructType, header: list[str], what: str, col: str, permissive: bool,
                    options: dict | None = None) -> DataFrame:
    return read_csv_lines(lines, schema_in_order(schema, header, what), col, options,
                          permissive=permissive).select(*schema.names)


def parse_carrier_lines(lines: DataFrame, header: list[str], col: str = "value", permissive: bool = False) -> DataFrame:
    """S01 on a column of carrier lines whose columns are in the order of ``header``."""
    return _parse_headered(lines, schemas.CARRIER, header, "the carrier header", col, permissive)


def parse_airport_lines(lines: DataFrame, header: list[str], col: str = "value", permissive: bool = False) -> DataFrame:
    """S02 on a column of airport lines whose columns are in the order of ``header``."""
    return _parse_headered(lines, schemas.AIRPORT, header, "the airport header", col, permissive)


def parse_country_code_lines(lines: DataFrame, header: list[str], col: str = "value",
                             permissive: bool = False) -> DataFrame:
    """S05 on a column of country-code lines: quoted names may hold commas, the code NA stays a text."""
    return _parse_headered(lines, schemas.COUNTRY_CODE, header, "the country-code header", col, permissive)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog lookup."""
    return spark.catalog.tableExists(name)


def read_carriers(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """Carrier dimension (Code, Description)."""
    return read_headered(spark, path, schemas.CARRIER, permissive)


def read_airports(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """Airport dimension (iata, airport, city, state, country, lat, long)."""
    return read_headered(spark, path, schemas.AIRPORT, permissive)


def read_places(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """19-field tab-separated place dump; quoting off because names hold quotes."""
    return (spark.read.schema(schemas.PLACE)
            .options(sep="\t", quote="", header=False, mode=_mode(permissive))
            .csv(path))


def parse_place_lines(lines: DataFrame, col: str = "value", permissive: bool = False) -> DataFrame:
    """Q13 on a column of raw place lines."""
    return read_csv_lines(lines, schemas.PLACE, col, {"sep": "\t", "quote": ""},
                          permissive=permissive)


def read_country_codes(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """(Name, Code) with quoted names.  'NA' is Namibia, so no nullValue."""
    return read_headered(spark, path, schemas.COUNTRY_CODE, permissive)


def parse_social_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Keep the ``a | b`` lines of a text dump and capture (src, dst)."""
    v = F.col(col)
    return (lines.where(v.rlike(SOCIAL_LINE))
            .select(F.regexp_extract(v, SOCIAL_LINE, 1).cast("bigint").alias("src"),
                    F.regexp_extract(v, SOCIAL_LINE, 2).cast("bigint").alias("dst")))


def read_social(spark: SparkSession, path: str) -> DataFrame:
    """Text-line scan of a table dump -> (src, dst) pairs, one per line."""
    return parse_social_lines(spark.read.text(path))


def read_csv_lines(lines: DataFrame, schema: StructType, col: str = "value",
                   options: dict | None = None, keep: list[str] | None = None,
                   permissive: bool = False) -> DataFrame:
    """Parse a column of CSV lines with the CSV reader's own parser (``from_csv``);
    ``keep`` carries other columns of ``lines`` through."""
    keep = list(keep or [])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col(col), ddl, {**(options or {}), "mode": _mode(permissive)})
    return lines.select(*keep, parsed.alias("__r")).select(*keep, "__r.*")


def quarantine_csv_lines(lines: DataFrame, schema: StructType, col: str = "value", options: dict | None = None,
                         keep: list[str] | None = None, reason_col: str = "reason", raw_col: str = "raw") -> DataFrame:
    """Every line once, parsed or rejected, in one pass.

    A good line gives its fields and nulls in ``reason_col`` and ``raw_col``.  A rejected one gives null fields,
    the reason (``field count``, or the name of the first field whose text is no value of its type) and the line
    itself.  A missing line (null) is rejected as ``no line``."""
    keep, bad = list(keep or []), "__bad"
    texts = ", ".join(f"`{f.name}` string" for f in schema.fields) + f", {bad} string"
    parsed = F.from_csv(F.col(col), texts, {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})

    def wrong(f: StructField) -> Column:
        text = F.col(f"__r.`{f.name}`")
        return text.isNotNull() & text.try_cast(f.dataType).isNull()
    empty = (F.col(col) == "") & F.lit(len(schema) > 1)  # the parser takes an empty line for nulls
    reason = (F.when(F.col(col).isNull(), "no line")
              .when(empty | F.col(f"__r.{bad}").isNotNull(), "field count"))
    for f in schema.fields:
        reason = reason.when(wrong(f), f.name)
    rows = lines.withColumn("__r", parsed).withColumn("__reason", reason)
    good = F.col("__reason").isNull()
    return rows.select(*keep, *[F.when(good, F.col(f"__r.`{f.name}`").try_cast(f.dataType)).alias(f.name) for f in schema.fields],
                       F.col("__reason").alias(reason_col), F.when(~good, F.col(col)).alias(raw_col))


def _player_row(lines: DataFrame, col: str, keep: list[str] | None,
                permissive: bool) -> DataFrame:
    fields = schemas.PLAYER_RAW.names
    parts = F.split(F.col(col), ",", -1)
    if not permissive:
        parts = F.when(F.size(parts) == len(fields), parts).otherwise(F.raise_error(F.concat(
            F.lit(f"a player line needs {len(fields)} fields: "), F.col(col))))
    raw = lines.select(*(keep or []), parts.alias("__p"))
    raw = raw.select(*(keep or []), *[F.get("__p", i).alias(n) for i, n in enumerate(fields)])

    def num(c: str) -> Column:
        # TRY_CAST gives NULL for anything but a number, the empty field included
        value = F.col(c).try_cast("double")
        if permissive:
            return value
        return F.coalesce(value, F.raise_error(F.concat(
            F.lit(f"player field {c} is no number: "), F.coalesce(F.col(c), F.lit("(none)")))))

    return raw.select(
        *(keep or []),
        text_flag("gender", MALE_TOKEN).alias("gender"),
        num("age").alias("age"),
        F.col("country").alias("country"),
        num("friend_count").alias("friend_count"),
        num("lifetime").alias("lifetime"),
        num("citygame").alias("game1"),
        num("pictionarygame").alias("game2"),
        num("scramblegame").alias("game3"),
        num("snipergame").alias("game4"),
        text_flag("paid", PAID_TOKEN).alias("paid_customer"),
    )


def parse_player_lines(lines: DataFrame, col: str = "value", keep: list[str] | None = None,
                       permissive: bool = False) -> DataFrame:
    """Q22 on a column of raw 16-field comma lines (``keep``: extra columns first)."""
    return _player_row(lines, col, keep, permissive)


def read_players(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """16-field comma lines -> 10-column player table.

    A line with another number of fields, or whose numeric fields hold no number (empty ones
    included), fails the job.  ``permissive`` gives NULLs instead.
    """
    lines = spark.read.text(path).where(F.col("value") != "")
    return _player_row(lines, "value", None, permissive)
