"""The daily aggregate as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake.functions.flags import at_least_valid, hourly
from aerolake.plans.daily_table import DailyTable
from aerolake.schemas import DAILY


def stream_daily(
    measurements: DataFrame, sampling_points: DataFrame, delay: str = "30 days"
) -> DataFrame:
    """One-day tumbling windows per station and pollutant over arriving valid hourly rows.

    State holds one row for each open day, station and pollutant. Rows that arrive after the
    watermark has passed their day are dropped, and so are rows of sampling points that
    ``sampling_points``, which is read as it was at the start, does not hold; ``living_daily`` keeps
    both. In append mode a day comes out once it is
    closed, in update mode with each change.
    """
    stations = sampling_points.select("sampling_point_id", "station_code")
    return (
        measurements.filter(
            at_least_valid(F.col("validity")) & hourly(F.col("aggregation_type"))
        )
        .select("time", "sampling_point_id", "pollutant_code", "value")
        .withWatermark("time", delay)
        .join(stations, "sampling_point_id")
        .groupBy(F.window("time", "1 day"), "station_code", "pollutant_code")
        .agg(
            F.avg("value").alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.stddev_samp("value").alias("stddev_value"),
            F.count("*").alias("count"),
            F.min("time").alias("first_measurement"),
            F.max("time").alias("last_measurement"),
        )
        .withColumn("day", F.to_date("window.start"))
        .select(*DAILY.names)
    )


def maintain_daily(
    daily: DataFrame, table: DailyTable, checkpoint: str, trigger: dict[str, object] | None = None
) -> StreamingQuery:
    """Keep the stored daily table current; by default stops when all available input is done.

    ``trigger`` is that of ``DataStreamWriter``, such as ``{"processingTime": "1 minute"}``. Replaying a micro-batch writes the same rows again, so a restart is harmless.
    """
    return (
        daily.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda rows, _: table.upsert(rows) and None)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
