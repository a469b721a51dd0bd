"""Station codes, sampling-point ids and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def country_of_sampling_point(sampling_point_id: Column) -> Column:
    """``PT/SPO-PT02022_00008_100`` -> ``PT``; NULL without a slash."""
    return F.when(
        sampling_point_id.contains("/"),
        F.split_part(sampling_point_id, F.lit("/"), F.lit(1)),
    )


def station_of_sampling_point(sampling_point_id: Column) -> Column:
    """``PT/SPO-PT02022_00008_100`` -> ``PT/PT02022``; NULL without a slash."""
    local_id = F.replace(
        F.split_part(sampling_point_id, F.lit("/"), F.lit(2)), F.lit("SPO-"), F.lit("")
    )
    station = F.split_part(local_id, F.lit("_"), F.lit(1))
    return F.concat(country_of_sampling_point(sampling_point_id), F.lit("/"), station)


def country_of_station(station_code: Column) -> Column:
    """First two characters, NULL for shorter codes."""
    return F.when(F.length(station_code) >= 2, F.substring(station_code, 1, 2))


def prefixed_sampling_point(country_code: Column, sampling_point_id: Column) -> Column:
    """Extract id in the form the raw files use: ``ES`` + ``SP_1`` -> ``ES/SP_1``."""
    return F.concat(country_code, F.lit("/"), sampling_point_id)


def file_name_of_url(url: Column) -> Column:
    """Last path part, with ``.parquet`` added where it is missing."""
    name = F.element_at(F.split(url, "/"), -1)
    return F.when(name.endswith(".parquet"), name).otherwise(F.concat(name, F.lit(".parquet")))
