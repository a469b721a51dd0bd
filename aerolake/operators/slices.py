"""Slices, newest-N reads and windows of time."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.functions.times import as_utc, instant


def in_period(measurements: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows with ``start <= time < end``.

    On a stored table use ``MeasurementStore.between``, which also prunes partitions: Spark
    cannot derive them from ``time``.
    """
    if start is not None:
        measurements = measurements.filter(F.col("time") >= instant(start))
    if end is not None:
        measurements = measurements.filter(F.col("time") < instant(end))
    return measurements


def slice_measurements(
    measurements: DataFrame,
    sampling_points: DataFrame,
    country: str | None = None,
    pollutant: int | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Measurements of one country, pollutant and period; every part may be left out."""
    rows = in_period(measurements, start, end)
    if pollutant is not None:
        rows = rows.filter(F.col("pollutant_code") == F.lit(pollutant))
    if country is not None:
        points = sampling_points.filter(F.col("country_code") == F.lit(country))
        rows = rows.join(points.select("sampling_point_id"), "sampling_point_id", "left_semi")
    return rows


def slice_daily(
    daily: DataFrame,
    first_day: date | None = None,
    last_day: date | None = None,
    station: str | None = None,
    pollutant: int | None = None,
) -> DataFrame:
    """Daily rows by day (both ends included), station or pollutant, newest first."""
    if first_day is not None:
        daily = daily.filter(F.col("day") >= F.lit(first_day))
    if last_day is not None:
        daily = daily.filter(F.col("day") <= F.lit(last_day))
    if station is not None:
        daily = daily.filter(F.col("station_code") == F.lit(station))
    if pollutant is not None:
        daily = daily.filter(F.col("pollutant_code") == F.lit(pollutant))
    return daily.orderBy(F.desc("day"), "station_code", "pollutant_code")


def latest_of(measurements: DataFrame, sampling_point_id: str, limit: int = 100) -> DataFrame:
    """Newest rows of one sampling point, without a full sort."""
    return (
        measurements.filter(F.col("sampling_point_id") == F.lit(sampling_point_id))
        .orderBy(F.desc("time"))
        .limit(limit)
    )


def latest_by_sampling_point(
    measurements: DataFrame, limit: int = 100, salts: int = 64
) -> DataFrame:
    """Newest ``limit`` rows of every sampling point.

    Ranked twice: within a salted part of each sampling point, then over what is left. Both
    ranks stop at ``limit`` before the shuffle, and no task gets more than a salt's share of a
    hot sampling point.
    """
    newest = F.desc("time")
    salted = Window.partitionBy("sampling_point_id", "_salt").orderBy(newest)
    whole = Window.partitionBy("sampling_point_id").orderBy(newest)
    rank = F.row_number()
    return (
        measurements.withColumn("_salt", F.pmod(F.xxhash64("time"), F.lit(salts)))
        .withColumn("_rank", rank.over(salted))
        .filter(F.col("_rank") <= limit)
        .withColumn("_rank", rank.over(whole))
        .filter(F.col("_rank") <= limit)
        .drop("_salt", "_rank")
    )


def latest_overall(measurements: DataFrame, limit: int = 10) -> DataFrame:
    """Newest rows of the table; the id breaks ties."""
    return measurements.orderBy(F.desc("time"), "sampling_point_id").limit(limit)


def policy_window(
    now: datetime, start_offset_days: int = 30, end_offset_days: int = 1
) -> tuple[datetime, datetime]:
    """The span that the scheduled refresh recomputes."""
    return now - timedelta(days=start_offset_days), now - timedelta(days=end_offset_days)


def whole_days(start: datetime | None, end: datetime | None) -> tuple[date, date] | None:
    """Days that lie fully inside ``[start, end)`` as (first, one past last).

    Both bounds are needed; with one alone, as with none, the answer is None: everything. An
    end of 23:59:59 therefore leaves its last day out.
    """
    if start is None or end is None:
        return None
    start, end = as_utc(start), as_utc(end)
    first = start.date()
    if start.time() > time.min:
        first += timedelta(days=1)
    return first, max(first, end.date())


def late_rows(measurements: DataFrame, now: datetime, start_offset_days: int = 30) -> DataFrame:
    """Per day, the rows too old for the scheduled refresh: their days need a manual one."""
    horizon = (as_utc(now) - timedelta(days=start_offset_days)).date()
    return (
        measurements.filter(F.col("time") < instant(datetime.combine(horizon, time.min)))
        .groupBy(F.to_date("time").alias("day"))
        .agg(F.count("*").alias("rows"))
    )
