"""Stored statistics of sampling points per day, kept by changes instead of recomputed.

A row is what one change knows about one day, sampling point and pollutant: count, mean, squared
deviation and extremes, which merge. The table is partitioned by day and by the number of the
change, and a change only ever adds partitions:

* *appended* measurements add their own statistics;
* *recomputed* sampling points (after upserts and deletes) add rows marked ``whole``, which stand for
  all that earlier changes said about that day and sampling point, or a row without measurements
  if none is left;
* a *compacted* day is one change of whole rows, after which the earlier ones can go.

Numbers order the changes; the same change written again under its number replaces itself, so a
replayed micro-batch or a load that broke off is simply repeated. The dimension has no part in the
table: points of unknown stations are kept like any other and count from the day they are known.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.operators.aggregates import merge_moments, point_days
from aerolake.plans.measurement_store import MeasurementStore
from aerolake.plans.tables import (
    child_names,
    drop_folders,
    partition_dates,
    read_dates,
    staged,
    write_parts,
)

POINT_KEY = ["day", "sampling_point_id", "pollutant_code"]
POINT_DAYS = T.StructType(
    [
        T.StructField("day", T.DateType(), False),
        T.StructField("sampling_point_id", T.StringType(), False),
        T.StructField("pollutant_code", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("m2", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("rows", T.LongType()),
        T.StructField("first", T.TimestampType()),
        T.StructField("last", T.TimestampType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("change", T.LongType()),
    ]
)


class PointDayTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def days(self) -> set[date]:
        return partition_dates(self.spark, self.path)

    def changes(self, day: date) -> list[int]:
        """Numbers of the changes that a day holds, from a listing."""
        names = child_names(self.spark, f"{self.path}/day={day.isoformat()}")
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("change="))

    def _parts(self, days: set[date]) -> DataFrame:
        return read_dates(self.spark, self.path, POINT_DAYS, days).select(*POINT_DAYS.names)

    def read(self, days: Iterable[date] | None = None) -> DataFrame:
        """One row for each day, sampling point and pollutant; only the folders of ``days`` are listed."""
        wanted = self.days() if days is None else set(days) & self.days()
        parts = self._parts(wanted)
        point = ["day", "sampling_point_id"]
        replaced = parts.filter("whole").groupBy(*point).agg(F.max("change").alias("_from"))
        current = parts.join(replaced, point, "left").filter(
            (F.col("change") >= F.coalesce("_from", F.lit(-1))) & (F.col("rows") > 0)
        )
        return merge_moments(current, POINT_KEY)

    def _write(self, parts: DataFrame, number: int, whole: bool) -> set[date]:
        if number < 0:
            raise ValueError("changes are numbered from 0")
        rows = parts.withColumns({"whole": F.lit(whole), "change": F.lit(number).cast("bigint")})
        with staged(rows.select(*POINT_DAYS.names), "point-days") as fresh:
            days = {r["day"] for r in fresh.select("day").distinct().collect()}
            if days:
                write_parts(fresh, self.path, ["day", "change"])
        return days

    def append(self, measurements: DataFrame, number: int) -> set[date]:
        """Add new measurements; returns the days they lie in. Nothing stored is read."""
        return self.add(point_days(measurements), number)

    def add(self, parts: DataFrame, number: int) -> set[date]:
        """Add statistics that ``point_days`` made of new measurements."""
        return self._write(parts, number, whole=False)

    def recompute(self, store: MeasurementStore, changed: DataFrame, number: int) -> set[date]:
        """Replace what is known of the days and sampling points of ``changed`` by what is stored now.

        ``changed`` has ``day, sampling_point_id``; only the chunks of these days are read, and of
        them only these sampling points.
        """
        point = ["day", "sampling_point_id"]
        with staged(changed.select(*point).distinct(), "changed-points") as keys:
            days = {r["day"] for r in keys.select("day").distinct().collect()}
            if not days:
                return set()
            rows = store.read_days(days).withColumn("day", F.to_date("time"))
            now = point_days(rows.join(keys, point, "left_semi").drop("day"))
            gone = keys.join(now.select(*point), point, "left_anti")
            nothing = [
                F.lit(0 if f.name in ("n", "rows") else None).cast(f.dataType).alias(f.name)
                for f in POINT_DAYS.fields[2:-2]
            ]
            return self._write(now.unionByName(gone.select(*point, *nothing)), number, whole=True)

    def compact(self, days: Iterable[date], number: int, least: int = 2) -> set[date]:
        """Write days of ``least`` changes or more as one; returns them.

        ``number`` is larger than that of any change so far. The new rows hold without the old
        ones being gone, which are removed oldest first, so that a marker outlives what it replaces.
        """
        many = {day: found for day in days if len(found := self.changes(day)) >= least}
        if not many:
            return set()
        newest = max(found[-1] for found in many.values())
        if number <= newest:
            raise ValueError(f"change {newest} is there already; compact under a larger number")
        written = self._write(self.read(many), number, whole=True)
        for day, found in many.items():
            folders = [f"{self.path}/day={day.isoformat()}/change={old}" for old in found]
            if day not in written:  # nothing is left of it
                folders.append(f"{self.path}/day={day.isoformat()}")
            drop_folders(self.spark, folders)
        return set(many)
