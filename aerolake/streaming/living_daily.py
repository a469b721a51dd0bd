"""The daily aggregate as a stream, with a dimension that grows and rows that come late.

Each micro-batch is reduced to statistics of sampling points and appended to a ``PointDayTable``
under its batch number; then the days it touched are merged again from that table with the
dimension as it is now. So

* a row is never late: rows behind the watermark take the same way, and are only reported, as the
  days that a scheduled refresh would have missed;
* a row is never lost for want of a sampling point: its statistics wait in the table. Which days wait
  for which points is kept in a small *parked* table. As soon as the dimension knows a point, with
  the next micro-batch or ``release``, its days are merged again;
* a replayed micro-batch replaces itself.

State is the stored tables; the engine keeps none, whatever the age of the rows. A day costs what its
point-days cost; no measurement is read twice.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerolake.operators.aggregates import point_days
from aerolake.plans.daily_table import DailyTable
from aerolake.plans.dimension_tables import DimensionTable
from aerolake.plans.point_days import PointDayTable
from aerolake.plans.tables import child_names, drop_folders, read_table, staged, write_parts

PARKED = T.StructType(
    [
        T.StructField("day", T.DateType(), False),
        T.StructField("sampling_point_id", T.StringType(), False),
        T.StructField("change", T.LongType()),
    ]
)
LATE = T.StructType(
    [
        T.StructField("day", T.DateType(), False),
        T.StructField("rows", T.LongType()),
        T.StructField("change", T.LongType()),
    ]
)


class LivingDaily:
    """A daily table, the point-days it is merged from, and what waits for the dimension.

    ``watermark_days`` is how far behind the newest stored day a row counts as late.
    """

    def __init__(
        self,
        points: PointDayTable,
        daily: DailyTable,
        sampling_points: DimensionTable,
        path: str,
        watermark_days: int = 30,
    ):
        self.spark: SparkSession = points.spark
        self.points, self.daily, self.sampling_points = points, daily, sampling_points
        self.parked_path, self.late_path = f"{path}/parked", f"{path}/late"
        self.watermark_days = watermark_days

    def parked(self) -> DataFrame:
        """Days and sampling points that the dimension did not know when they were merged."""
        return read_table(self.spark, self.parked_path, PARKED).select("day", "sampling_point_id").distinct()

    def late(self) -> DataFrame:
        """Rows that came behind the watermark, by day and change."""
        return read_table(self.spark, self.late_path, LATE)

    def apply(self, measurements: DataFrame, number: int) -> set[date]:
        """Take in the rows of one change; returns the days that were merged again."""
        newest = self._newest_before(number)
        with staged(point_days(measurements), "arrived") as arrived:
            days = self.points.add(arrived, number)
            if newest:
                self._report_late(arrived, newest - timedelta(days=self.watermark_days), number)
            known = self.sampling_points.read().select("sampling_point_id")
            unknown = arrived.select("day", "sampling_point_id").distinct().join(known, "sampling_point_id", "left_anti")
            waiting = unknown.withColumn("change", F.lit(number).cast("bigint")).select(*PARKED.names)
            write_parts(waiting, self.parked_path, ["change"])
        return self._merge(days)

    def release(self) -> set[date]:
        """Merge the days of parked points that the dimension knows by now."""
        return self._merge(set())

    def _newest_before(self, number: int) -> date | None:
        """The newest day that another change brought, so that a replay sees the same watermark."""
        days = sorted(self.points.days(), reverse=True)
        return next((day for day in days if self.points.changes(day) != [number]), None)

    def _report_late(self, arrived: DataFrame, horizon: date, number: int) -> None:
        late = arrived.filter(F.col("day") < F.lit(horizon)).groupBy("day").agg(F.sum("rows").alias("rows"))
        write_parts(late.withColumn("change", F.lit(number).cast("bigint")), self.late_path, ["change"])

    def _merge(self, days: set[date]) -> set[date]:
        """Merge these days and those of released points; the parked table changes last."""
        known = self.sampling_points.read().select("sampling_point_id")
        parked = read_table(self.spark, self.parked_path, PARKED)
        released = parked.join(known, "sampling_point_id", "left_semi").select("day").distinct()
        found = {r["day"] for r in released.collect()}
        self.daily.refresh_from(self.points, self.sampling_points.read(), days | found)
        if found:
            self._keep_parked(parked.join(known, "sampling_point_id", "left_anti").select(*PARKED.names))
        return days | found

    def _keep_parked(self, rest: DataFrame) -> None:
        with staged(rest, "parked") as kept:
            numbers = {f"change={r['change']}" for r in kept.select("change").distinct().collect()}
            write_parts(kept, self.parked_path, ["change"])
        names = child_names(self.spark, self.parked_path)
        emptied = [name for name in names if name.startswith("change=") and name not in numbers]
        drop_folders(self.spark, [f"{self.parked_path}/{name}" for name in emptied])

    def run(
        self,
        measurements: DataFrame,
        checkpoint: str,
        first_number: int = 0,
        trigger: dict[str, object] | None = None,
    ) -> StreamingQuery:
        """Take in a stream of measurements with distinct keys.

        Batch numbers start at ``first_number``: other changes of the point-days need numbers of
        their own. ``trigger`` is that of ``DataStreamWriter``, by default all that is there now.
        """
        return (
            measurements.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda rows, batch: self.apply(rows, first_number + batch) and None)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
