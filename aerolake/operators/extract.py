"""Dimensions and error report of a station extract.

The rules describe a row-by-row reading; here they are set operations. Rows are ordered by
``row_num``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.clean import blank_to_null, extract_date, sentinel_float, strip
from aerolake.functions.codes import country_of_station, prefixed_sampling_point
from aerolake.operators.keys import keep_first

_STATION_METADATA = ["nat_code", "network", "network_name", "timezone"]
_SAMPLING_METADATA = ["sample_id", "process_id", "measurement_type", "measurement_method"]


def _metadata(names: list[str]):
    """Nested text map; blanks stay as empty text."""
    return F.create_map(*[part for name in names for part in (F.lit(name), strip(F.col(name)))])


def complete_rows(extract: DataFrame) -> DataFrame:
    """Rows that have both a station code and a sampling point, with stripped keys."""
    return (
        extract.withColumn("station_code", blank_to_null(F.col("eoi_code")))
        .withColumn("sampling_point", blank_to_null(F.col("sampling_point")))
        .filter("station_code is not null and sampling_point is not null")
        .withColumn("country_code", country_of_station(F.col("station_code")))
    )


def known_country(rows: DataFrame, countries: DataFrame) -> DataFrame:
    return rows.join(countries.select("country_code"), "country_code", "left_semi")


def unknown_country(rows: DataFrame, countries: DataFrame) -> DataFrame:
    """Rows whose country is not in the table; a NULL country is unknown too."""
    return rows.join(countries.select("country_code"), "country_code", "left_anti")


def pollutant_code_by_name(pollutants: DataFrame) -> DataFrame:
    """Name -> code. Names repeat; the largest code is taken."""
    return pollutants.groupBy("pollutant_name").agg(F.max("pollutant_code").alias("pollutant_code"))


def stations_from_extract(extract: DataFrame, countries: DataFrame) -> DataFrame:
    """First row of each station code among complete rows of known countries."""
    rows = known_country(complete_rows(extract), countries)
    first = keep_first(rows, ["station_code"], ["row_num"])
    return first.select(
        "station_code",
        "country_code",
        blank_to_null(F.col("station_name")).alias("station_name"),
        blank_to_null(F.col("station_type")).alias("station_type"),
        blank_to_null(F.col("area_type")).alias("area_type"),
        sentinel_float(F.col("latitude")).alias("latitude"),
        sentinel_float(F.col("longitude")).alias("longitude"),
        sentinel_float(F.col("altitude")).alias("altitude"),
        blank_to_null(F.col("municipality")).alias("municipality"),
        F.lit(None).cast("string").alias("region"),
        F.to_date(extract_date(F.col("activity_begin"))).alias("start_date"),
        F.to_date(extract_date(F.col("activity_end"))).alias("end_date"),
        _metadata(_STATION_METADATA).alias("metadata"),
    )


def _with_pollutant(extract: DataFrame, countries: DataFrame, pollutants: DataFrame) -> DataFrame:
    """Complete rows of known countries with their prefixed id and pollutant code, if any."""
    rows = known_country(complete_rows(extract), countries)
    return (
        rows.withColumn(
            "sampling_point_id", prefixed_sampling_point(F.col("country_code"), F.col("sampling_point"))
        )
        .withColumn("pollutant_name", strip(F.col("pollutant_name")))
        .join(pollutant_code_by_name(pollutants), "pollutant_name", "left")
    )


def sampling_points_from_extract(
    extract: DataFrame, countries: DataFrame, pollutants: DataFrame
) -> DataFrame:
    """First row of each id whose pollutant is known; others do not claim the id."""
    accepted = _with_pollutant(extract, countries, pollutants).filter("pollutant_code <> 0")
    first = keep_first(accepted, ["sampling_point_id"], ["row_num"])
    return first.select(
        "sampling_point_id",
        "station_code",
        "country_code",
        "pollutant_code",
        extract_date(F.col("activity_begin")).alias("start_date"),
        extract_date(F.col("activity_end")).alias("end_date"),
        _metadata(_SAMPLING_METADATA).alias("metadata"),
    )


def all_extract_errors(
    extract: DataFrame, countries: DataFrame, pollutants: DataFrame
) -> DataFrame:
    """``row_num, message`` of every rejected row.

    An unknown pollutant is reported only until its id has been accepted by an earlier row.
    """
    bad_country = unknown_country(complete_rows(extract), countries).select(
        "row_num",
        F.format_string(
            "line %d: station %s left out, its country (%s) is not registered",
            "row_num",
            "station_code",
            F.coalesce("country_code", F.lit("none")),
        ).alias("message"),
    )
    rows = _with_pollutant(extract, countries, pollutants)
    known = F.coalesce(F.col("pollutant_code") != 0, F.lit(False))
    accepted = (
        rows.filter(known)
        .groupBy("sampling_point_id")
        .agg(F.min("row_num").alias("accepted_at"))
    )
    bad_pollutant = (
        rows.filter(~known)
        .join(accepted, "sampling_point_id", "left")
        .filter("accepted_at is null or row_num < accepted_at")
        .select(
            "row_num",
            F.format_string(
                "line %d: sampling point %s left out, its pollutant (%s) is not registered",
                "row_num",
                "sampling_point_id",
                "pollutant_name",
            ).alias("message"),
        )
    )
    return bad_country.unionByName(bad_pollutant)


def extract_errors(
    extract: DataFrame, countries: DataFrame, pollutants: DataFrame, first: int = 100
) -> DataFrame:
    """The first errors in row order."""
    return all_extract_errors(extract, countries, pollutants).orderBy("row_num").limit(first)


def extract_summary(
    stations: DataFrame, sampling_points: DataFrame, errors: DataFrame
) -> DataFrame:
    """One row of totals over merged dimensions (see ``merge_dimension``) and all errors."""
    rows = (
        stations.select(F.concat(F.lit("stations_"), "change").alias("what"))
        .unionByName(
            sampling_points.select(F.concat(F.lit("sampling_points_"), "change").alias("what"))
        )
        .unionByName(errors.select(F.lit("errors").alias("what")))
    )

    def total(*names: str):
        return F.count_if(F.col("what").isin(*names))

    return rows.agg(
        total("stations_created", "stations_updated").alias("stations_processed"),
        total("stations_created").alias("stations_created"),
        total("stations_updated").alias("stations_updated"),
        total("sampling_points_created", "sampling_points_updated").alias("sampling_points_processed"),
        total("sampling_points_created").alias("sampling_points_created"),
        total("sampling_points_updated").alias("sampling_points_updated"),
        total("errors").alias("errors"),
    )
