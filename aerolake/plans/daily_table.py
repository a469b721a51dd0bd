"""The stored daily aggregate and its refresh."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.times import start_of
from aerolake.operators.aggregates import DAILY_KEY, daily_measurements, daily_of_points
from aerolake.operators.slices import policy_window, whole_days
from aerolake.plans.measurement_store import MeasurementStore
from aerolake.plans.point_days import PointDayTable
from aerolake.plans.tables import (
    drop_dates,
    partition_dates,
    read_dates,
    read_table,
    staged,
    write_dates,
)
from aerolake.schemas import DAILY


class DailyTable:
    """Parquet partitioned by day; refreshed by recomputing whole days."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        return read_table(self.spark, self.path, DAILY).select(*DAILY.names)

    def days(self) -> set[date]:
        return partition_dates(self.spark, self.path)

    def _publish(self, daily: DataFrame, stale: set[date]) -> int:
        """Replace the days in ``stale`` by ``daily``, also where a day has no rows any more.

        The small result is staged, so that the days it has are known without computing it twice.
        """
        with staged(daily, "daily") as fresh:
            counts = fresh.groupBy("day").agg(F.count("*").alias("rows")).collect()
            if counts:
                write_dates(fresh, self.path, "overwrite")
        drop_dates(self.spark, self.path, stale - {row["day"] for row in counts})
        return sum(row["rows"] for row in counts)

    def refresh(
        self,
        store: MeasurementStore,
        sampling_points: DataFrame,
        start: datetime | None = None,
        end: datetime | None = None,
    ) -> int:
        """Recompute the whole days inside ``[start, end)``, or all days unless both are given.

        Returns the number of daily rows written.
        """
        window = whole_days(start, end)
        if window is None:
            return self._publish(daily_measurements(store.read(), sampling_points), self.days())
        first, past = window
        # midnight to midnight, so no row of another day comes along
        rows = store.between(start_of(first), start_of(past))
        stale = {day for day in self.days() if first <= day < past}
        return self._publish(daily_measurements(rows, sampling_points), stale)

    def refresh_policy(self, store: MeasurementStore, sampling_points: DataFrame, now: datetime) -> int:
        """The hourly refresh: from 30 days to 1 day before ``now``."""
        return self.refresh(store, sampling_points, *policy_window(now))

    def refresh_days(self, store: MeasurementStore, sampling_points: DataFrame, days: set[date]) -> int:
        """Recompute just these days, however far apart they lie."""
        if not days:
            return 0
        rows = store.read_days(days).filter(F.to_date("time").isin(sorted(days)))
        daily = daily_measurements(rows, sampling_points)
        return self._publish(daily, days & self.days())

    def refresh_from(self, points: PointDayTable, sampling_points: DataFrame, days: set[date]) -> int:
        """Recompute just these days from stored point-days; no measurement is read."""
        if not days:
            return 0
        daily = daily_of_points(points.read(days), sampling_points)
        return self._publish(daily, days & self.days())

    def upsert(self, changed: DataFrame) -> int:
        """Overwrite single rows, as a stream in update mode hands them out."""
        with staged(changed.select(*DAILY.names), "daily-rows") as fresh:
            days = {row["day"] for row in fresh.select("day").distinct().collect()}
            touched = days & self.days()
            merged = fresh
            if touched:
                kept = read_dates(self.spark, self.path, DAILY, touched).select(*DAILY.names)
                # station_code may be NULL, so the key is compared null-safe
                same = [F.col(f"k.{c}").eqNullSafe(F.col(f"f.{c}")) for c in DAILY_KEY]
                keys = fresh.select(*DAILY_KEY).alias("f")
                merged = kept.alias("k").join(keys, same, "left_anti").unionByName(fresh)
            if days:
                write_dates(merged, self.path, "overwrite")
        return len(days)

    def truncate(self) -> int:
        """Remove all rows; returns how many there were."""
        rows = self.read().count()
        drop_dates(self.spark, self.path, self.days())
        return rows
