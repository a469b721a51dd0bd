"""The daily aggregate and the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.flags import at_least_valid, hourly
from aerolake.schemas import DAILY

DAILY_KEY = ["day", "station_code", "pollutant_code"]
MERGE_BUCKETS = 64


def point_days(measurements: DataFrame) -> DataFrame:
    """Mergeable statistics of each day, sampling point and pollutant over valid hourly rows.

    ``n`` values have the ``mean`` and the squared deviation ``m2`` from it; ``rows`` counts those
    without a value too.
    """
    wanted = measurements.filter(
        at_least_valid(F.col("validity")) & hourly(F.col("aggregation_type"))
    ).select(
        F.to_date("time").alias("day"), "sampling_point_id", "pollutant_code", "value", "time"
    )
    return wanted.groupBy("day", "sampling_point_id", "pollutant_code").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.count("*").alias("rows"),
        F.min("time").alias("first"),
        F.max("time").alias("last"),
    )


def merge_moments(parts: DataFrame, key: list[str]) -> DataFrame:
    """Merge statistics by key in one aggregate.

    The moments of a key are gathered, partly before the shuffle, and merged pair by pair in the
    order of their values: no digits are lost to large sums of squares, and the result is the same
    to the last digit however the rows came. A key should have a bounded number of parts.
    """
    moments = F.when(F.col("n") > 0, F.struct("mean", "n", "m2"))
    start = F.struct(F.lit(0.0).alias("mean"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("m2"))

    def add(one: Column, two: Column) -> Column:
        n = one["n"] + two["n"]
        apart = two["mean"] - one["mean"]
        share = two["n"] / n
        return F.struct(
            (one["mean"] + apart * share).alias("mean"),
            n.alias("n"),
            (one["m2"] + two["m2"] + apart * apart * one["n"] * share).alias("m2"),
        )

    merged = parts.groupBy(*key).agg(
        F.aggregate(F.sort_array(F.collect_list(moments)), start, add).alias("_all"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("rows").alias("rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    n = F.col("_all.n")
    mean = F.when(n > 0, F.col("_all.mean")).alias("mean")
    return merged.select(*key, n.alias("n"), mean, F.col("_all.m2").alias("m2"), "low", "high", "rows", "first", "last")


def daily_of_points(points: DataFrame, sampling_points: DataFrame) -> DataFrame:
    """Daily rows of stations from the statistics of their sampling points.

    Sampling points that the dimension does not know have no part. Points are merged in buckets
    first, so that a station with very many of them is spread over tasks.
    """
    stations = sampling_points.select("sampling_point_id", "station_code")
    bucket = F.pmod(F.xxhash64("sampling_point_id"), F.lit(MERGE_BUCKETS))
    bucketed = points.join(stations, "sampling_point_id").withColumn("_bucket", bucket)
    merged = merge_moments(merge_moments(bucketed, [*DAILY_KEY, "_bucket"]), DAILY_KEY)
    return merged.select(
        *DAILY_KEY,
        F.col("mean").alias("avg_value"),
        F.col("low").alias("min_value"),
        F.col("high").alias("max_value"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev_value"),
        F.col("rows").alias("count"),
        F.col("first").alias("first_measurement"),
        F.col("last").alias("last_measurement"),
    ).select(*DAILY.names)


def daily_measurements(measurements: DataFrame, sampling_points: DataFrame) -> DataFrame:
    """Statistics per UTC day, station and pollutant over valid hourly rows.

    Rows are first reduced to one per sampling point and day, so a sampling point holding a
    large share of all rows brings one row a day to the join, not its whole history. How the
    join runs is left to adaptive execution; the figures are the same either way.
    """
    return daily_of_points(point_days(measurements), sampling_points)


def daily_status(daily: DataFrame) -> DataFrame:
    """One row about the daily table; zeros and NULL days when it is empty."""
    return daily.agg(
        F.count("*").alias("total_rows"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count_distinct("station_code").alias("stations"),
        F.count_distinct("pollutant_code").alias("pollutants"),
    )


def table_counts(stations: DataFrame, sampling_points: DataFrame, measurements: DataFrame) -> DataFrame:
    """``table_name, rows`` for the three tables; each count is a metadata-light scan."""
    counts = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, frame in [
            ("stations", stations),
            ("sampling_points", sampling_points),
            ("measurements", measurements),
        ]
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _percent(part: Column, whole: Column) -> Column:
    share = part.cast("double") / whole.cast("double") * 100.0
    return F.when(whole > 0, F.round(share, 2)).otherwise(F.lit(0.0))


def data_quality(measurements: DataFrame) -> DataFrame:
    """One row of validity counts. Code 4 and NULL count only in the total."""
    flag = F.col("validity")
    counts = measurements.agg(
        F.count("*").alias("total_measurements"),
        F.count_if(flag == 1).alias("valid_measurements"),
        F.count_if(flag.isin(-1, -99)).alias("invalid_measurements"),
        F.count_if(flag.isin(2, 3)).alias("below_detection_measurements"),
        F.count_if(flag == -99).alias("maintenance_measurements"),
    )
    total = F.col("total_measurements")
    return counts.select(
        "*",
        _percent(F.col("valid_measurements"), total).alias("valid_percentage"),
        _percent(F.col("invalid_measurements"), total).alias("invalid_percentage"),
    )
