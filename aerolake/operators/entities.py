"""Stations and sampling points found in raw measurement files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.clean import nan_to_null
from aerolake.functions.codes import country_of_sampling_point, station_of_sampling_point
from aerolake.operators.harmonise import raw_name
from aerolake.operators.keys import keep_first
from aerolake.schemas import STATION_NAMES, STATIONS

_STATION_TYPES = {f.name: f.dataType.simpleString() for f in STATIONS.fields}
FILE_ORDER = ["file_path", "row_index"]


def _station_rows(raw: DataFrame, order: list[str]) -> DataFrame:
    columns = []
    for target in STATION_NAMES:
        name = raw_name(raw, target)
        if name:
            value = F.col(f"`{name}`").try_cast(_STATION_TYPES[target])
            if _STATION_TYPES[target] == "double":
                value = nan_to_null(value)
            columns.append(value.alias(target))
    return raw.select(*columns, *order).filter("station_code is not null")


def stations_from_attributes(raw: DataFrame, order: list[str] = FILE_ORDER) -> DataFrame:
    """First row for each station code, with the attribute columns the file has."""
    return keep_first(_station_rows(raw, order), ["station_code"], order).drop(*order)


def stations_from_sampling_ids(sampling_ids: DataFrame) -> DataFrame:
    """Distinct (station, country) behind ``sampling_point_id``; ids without ``/`` give none."""
    sp = F.col("sampling_point_id")
    return (
        sampling_ids.filter(sp.contains("/"))
        .select(
            station_of_sampling_point(sp).alias("station_code"),
            country_of_sampling_point(sp).alias("country_code"),
        )
        .distinct()
    )


def parse_stations(raw: DataFrame, order: list[str] = FILE_ORDER) -> DataFrame | None:
    """Stations of a raw frame, from attributes if it has them, else from ids; or None."""
    if raw_name(raw, "station_code"):
        return stations_from_attributes(raw, order)
    name = raw_name(raw, "sampling_point_id")
    if name:
        return stations_from_sampling_ids(
            raw.select(F.col(f"`{name}`").cast("string").alias("sampling_point_id"))
        )
    return None


def sampling_points_from(pairs: DataFrame) -> DataFrame:
    """Distinct (sampling point, pollutant) with station and country from the id.

    Drops a NULL or empty id and a NULL or zero pollutant. A sampling point with two
    pollutants gives two rows.
    """
    sp = F.col("sampling_point_id")
    return (
        pairs.select("sampling_point_id", "pollutant_code")
        .filter((sp != "") & (F.col("pollutant_code") != 0))
        .distinct()
        .select(
            "sampling_point_id",
            "pollutant_code",
            station_of_sampling_point(sp).alias("station_code"),
            country_of_sampling_point(sp).alias("country_code"),
        )
    )


def _pairs(raw: DataFrame, extra: list[str]) -> DataFrame | None:
    sp, pollutant = raw_name(raw, "sampling_point_id"), raw_name(raw, "pollutant_code")
    if not sp or not pollutant:
        return None
    return raw.select(
        F.col(f"`{sp}`").cast("string").alias("sampling_point_id"),
        F.col(f"`{pollutant}`").try_cast("double").try_cast("int").alias("pollutant_code"),
        *extra,
    )


def parse_sampling_points(raw: DataFrame) -> DataFrame | None:
    """Sampling points of a raw frame, None if it lacks the id or pollutant column."""
    pairs = _pairs(raw, [])
    return None if pairs is None else sampling_points_from(pairs)


def stations_to_upsert(raws: list[DataFrame]) -> DataFrame | None:
    """One row for each station over many files, as loading file after file would leave it.

    Each file gives the first row of a station; the attributes it has replace those of earlier
    files, the ones it lacks do not. Needs ``file_path`` and ``row_index``.
    """
    found = []
    for raw in raws:
        if raw_name(raw, "station_code"):
            rows = _station_rows(raw, FILE_ORDER)
            found.append(keep_first(rows, ["station_code", "file_path"], ["row_index"]))
        elif raw_name(raw, "sampling_point_id"):
            ids = raw.select(
                F.col(f"`{raw_name(raw, 'sampling_point_id')}`").cast("string").alias("sp"),
                "file_path",
            ).filter(F.col("sp").contains("/"))
            found.append(
                ids.select(
                    station_of_sampling_point(F.col("sp")).alias("station_code"),
                    country_of_sampling_point(F.col("sp")).alias("country_code"),
                    "file_path",
                ).distinct()
            )
    if not found:
        return None
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    attributes = [c for c in rows.columns if c not in ("station_code", *FILE_ORDER)]
    newest = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("file_path"))).alias(c) for c in attributes
    ]
    if not newest:
        return rows.select("station_code").distinct()
    return rows.groupBy("station_code").agg(*newest)


def sampling_points_to_upsert(raws: list[DataFrame]) -> DataFrame | None:
    """One row for each sampling point over many files.

    A file upserts its distinct (sampling point, pollutant) pairs in the order of their first
    row, so of several pairs the one that comes last in (file, first row) stays.
    """
    pairs = [_pairs(raw, FILE_ORDER) for raw in raws if _pairs(raw, FILE_ORDER) is not None]
    if not pairs:
        return None
    first_seen = (
        reduce(DataFrame.unionByName, pairs)
        .filter("sampling_point_id <> '' and pollutant_code <> 0")
        .groupBy("sampling_point_id", "pollutant_code", "file_path")
        .agg(F.min("row_index").alias("row_index"))
    )
    last = first_seen.groupBy("sampling_point_id").agg(
        F.max_by("pollutant_code", F.struct(*FILE_ORDER)).alias("pollutant_code")
    )
    return sampling_points_from(last)


def entity_counts(stations: DataFrame, sampling_points: DataFrame, measurements: DataFrame) -> DataFrame:
    """One row: how many of each a parse gave."""
    parts = [
        (stations, "stations"),
        (sampling_points, "sampling_points"),
        (measurements, "measurements"),
    ]
    tagged = [
        frame.select(F.lit(name).alias("entity")) for frame, name in parts
    ]
    rows = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return rows.agg(
        *[F.count_if(F.col("entity") == name).alias(name) for _, name in parts]
    )
