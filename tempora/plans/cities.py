"""The list of cities of one country from the ';'-separated city file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.constants import CITY_COLUMNS, DEFAULT_COUNTRY
from tempora.functions.scalar import split_pair
from tempora.operators.projections import where_equals
from tempora.sources.files import CITY_COLUMN_TYPES, read_csv


def country_cities(spark: SparkSession, path: str, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """A3 -> B13 -> H7 / G1 -> B9: keep five columns, split "lat,lon", keep one country.

    Fails when the country has no city (the collector has nothing to do then).
    """
    cities = read_csv(spark, path, sep=";", columns=CITY_COLUMN_TYPES)
    lat, lon = split_pair(F.col(f"`{CITY_COLUMNS[4]}`"))
    cities = cities.withColumns({"lat": lat, "lon": lon}).drop(CITY_COLUMNS[4])
    return where_equals(cities, CITY_COLUMNS[3], country, required=True)


def write_city_csv(customer: DataFrame, nation: DataFrame, path: str) -> None:
    """Benchmark stand-in for the city file: one line per customer, its nation as the country,
    "acctbal,nationkey" as coordinates, plus a column the reader must skip."""
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias(CITY_COLUMNS[0]),
        F.col("c_name").alias(CITY_COLUMNS[1]),
        F.upper("c_name").alias(CITY_COLUMNS[2]),
        F.col("n_name").alias(CITY_COLUMNS[3]),
        F.concat_ws(",", F.col("c_acctbal").cast("string"), F.col("c_nationkey").cast("string")).alias(CITY_COLUMNS[4]),
        F.col("c_mktsegment").alias("Feature Class"),
    )
    rows.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
