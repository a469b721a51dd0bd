"""Fact-to-dimension joins and reference checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def measurements_with_station(measurements: DataFrame, sampling_points: DataFrame) -> DataFrame:
    """Inner join that adds ``station_code`` to each measurement."""
    stations = sampling_points.select("sampling_point_id", "station_code")
    return measurements.join(stations, "sampling_point_id")


def decode_flags(measurements: DataFrame, validity: DataFrame, verification: DataFrame) -> DataFrame:
    """Add the names of both flags; unknown or NULL codes give NULL names."""
    valid = validity.select(F.col("validity_code").alias("validity"), "validity_name")
    verified = verification.select(
        F.col("verification_code").alias("verification"), "verification_name"
    )
    return measurements.join(valid, "validity", "left").join(verified, "verification", "left")


def _references(rows: DataFrame, table: str, columns: list[str], count: str) -> DataFrame:
    """One row for each non-NULL foreign-key value: ``table_name, column_name, key_value``."""
    values = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"), F.col(column).cast("string").alias("key_value")
            )
            for column in columns
        ]
    )
    return (
        rows.select(F.explode(values).alias("key"), F.expr(count).alias("rows"))
        .select(F.lit(table).alias("table_name"), "key.*", "rows")
        .filter("key_value is not null")
    )


def fk_violations(
    measurements: DataFrame,
    sampling_points: DataFrame,
    stations: DataFrame,
    countries: DataFrame,
    pollutants: DataFrame,
    validity: DataFrame,
    verification: DataFrame,
) -> DataFrame:
    """Every foreign-key value without a parent and the number of rows holding it; NULL passes.

    The fact table is scanned once and reduced to its distinct key combinations; then all
    references of all tables go through one anti-join.
    """
    fact_columns = ["sampling_point_id", "pollutant_code", "validity", "verification"]
    fact_keys = measurements.groupBy(*fact_columns).agg(F.count("*").alias("n"))
    children = [
        _references(fact_keys, "measurements", fact_columns, "n"),
        _references(
            sampling_points,
            "sampling_points",
            ["station_code", "country_code", "pollutant_code"],
            "1L",
        ),
        _references(stations, "stations", ["country_code"], "1L"),
    ]
    parents = [
        (sampling_points, "sampling_point_id", "sampling_point_id"),
        (stations, "station_code", "station_code"),
        (countries, "country_code", "country_code"),
        (pollutants, "pollutant_code", "pollutant_code"),
        (validity, "validity_code", "validity"),
        (verification, "verification_code", "verification"),
    ]
    known = [
        table.select(F.lit(name).alias("column_name"), F.col(key).cast("string").alias("key_value"))
        for table, key, name in parents
    ]
    return (
        reduce(DataFrame.unionByName, children)
        .groupBy("table_name", "column_name", "key_value")
        .agg(F.sum("rows").alias("rows"))
        .join(reduce(DataFrame.unionByName, known), ["column_name", "key_value"], "left_anti")
        .select("table_name", "column_name", "key_value", "rows")
    )
