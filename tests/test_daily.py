"""Daily aggregate: both plans, refresh windows, streams."""

from datetime import date, datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerolake.operators.aggregates import daily_measurements, daily_status, data_quality
from aerolake.operators.slices import (
    latest_by_sampling_point,
    latest_of,
    policy_window,
    whole_days,
)
from aerolake.plans.daily_table import DailyTable
from aerolake.plans.load import read_files
from aerolake.sources.parquet_files import list_files
from aerolake.streaming.daily_stream import maintain_daily, stream_daily
from aerolake.streaming.ingest import file_stream, stream_ingest

DAY = datetime(2024, 1, 1)


def facts(spark, n=20_000):
    """A third of all rows belong to one sampling point of a station that has many."""
    i = F.col("id")
    point = F.when(i % 3 == 0, F.lit("X/hot")).otherwise(F.concat(F.lit("X/p"), (i % 50).cast("string")))
    return spark.range(n).select(
        F.timestamp_seconds(i * 37 + 1_704_067_200).alias("time"),
        point.alias("sampling_point_id"),
        F.when(i % 5 == 0, 1).otherwise(8).alias("pollutant_code"),
        F.when(i % 11 == 0, None).otherwise((i * 7919 % 1000) / 10.0 + 1000.0).alias("value"),
        F.when(i % 13 == 0, "day").otherwise("hour").alias("aggregation_type"),
        F.when(i % 7 == 0, -1).when(i % 17 == 0, None).otherwise(1).alias("validity"),
    )


def points(spark):
    rows = [("X/hot", "A")] + [(f"X/p{i}", "AB"[i % 2] if i % 9 else None) for i in range(50)]
    ids, stations = zip(*rows)
    return spark.createDataFrame(pa.table({"sampling_point_id": ids, "station_code": stations}))


def rounded(daily):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else str(v) for v in row) for row in daily.collect()
    )


def test_both_joins_agree(spark):
    direct = daily_measurements(facts(spark), points(spark).hint("broadcast")).collect()
    shuffled = daily_measurements(facts(spark), points(spark).hint("merge")).collect()
    # to the last digit: the algorithm is the same
    assert sorted(map(str, direct)) == sorted(map(str, shuffled)) and len(direct) > 10


def test_rows_are_reduced_before_the_join(spark):
    text = plan(daily_measurements(facts(spark), points(spark)))
    assert "Join" in text
    assert text.index("Join") < text.index("HashAggregate(keys=[day#", text.index("Join"))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_constant_values_have_no_spread(spark):
    rows = facts(spark).withColumn("value", F.lit(1e9 + 0.1))
    daily = daily_measurements(rows, points(spark))
    assert all((r["stddev_value"] or 0.0) < 1e-5 for r in daily.collect())


def test_one_row_group_has_null_stddev(spark):
    one = facts(spark, 2)  # row 0 is not valid
    rows = daily_measurements(one, points(spark)).collect()
    assert [(r["count"], r["stddev_value"]) for r in rows] == [(1, None)]


@pytest.mark.parametrize(
    "start, end, days",
    [
        (None, None, None),
        (DAY, None, None),
        (None, DAY, None),
        (DAY, DAY + timedelta(days=3), (date(2024, 1, 1), date(2024, 1, 4))),
        (DAY + timedelta(seconds=1), DAY + timedelta(days=3), (date(2024, 1, 2), date(2024, 1, 4))),
        # the last day of a window that ends at 23:59:59 is not whole
        (DAY, datetime(2024, 1, 31, 23, 59, 59), (date(2024, 1, 1), date(2024, 1, 31))),
        (DAY + timedelta(hours=1), DAY + timedelta(hours=9), (date(2024, 1, 2), date(2024, 1, 2))),
    ],
)
def test_whole_days(start, end, days):
    assert whole_days(start, end) == days


def test_policy_window():
    now = datetime(2024, 3, 31, 12)
    assert policy_window(now) == (datetime(2024, 3, 1, 12), datetime(2024, 3, 30, 12))


def test_refresh_window_and_emptied_days(spark, store, tmp_path):
    store.upsert(facts(spark).withColumn("seq", F.lit(0)), ["seq"])
    table = DailyTable(spark, str(tmp_path / "daily"))
    assert table.read().count() == 0 and daily_status(table.read()).first()["total_rows"] == 0
    full = table.refresh(store, points(spark))
    expected = rounded(daily_measurements(store.read(), points(spark)))
    assert rounded(table.read()) == expected and full == len(expected)

    store.delete_time_range("X/hot", datetime(2024, 1, 3), datetime(2024, 1, 3, 23, 59, 59))
    doomed = store.read().filter("chunk_1d = '2024-01-03'").withColumn("validity", F.lit(-1))
    store.upsert(doomed.withColumn("seq", F.lit(0)), ["seq"])
    table.refresh(store, points(spark), datetime(2024, 1, 5), datetime(2024, 1, 6))
    assert date(2024, 1, 3) in table.days()  # outside the window: stale but untouched
    table.refresh(store, points(spark), datetime(2024, 1, 3), datetime(2024, 1, 4))
    assert date(2024, 1, 3) not in table.days()
    assert rounded(table.read()) == [r for r in expected if r[0] != "2024-01-03"]

    assert table.truncate() == len([r for r in expected if r[0] != "2024-01-03"])
    assert table.read().count() == 0 and table.days() == set()


def test_refresh_prunes_partitions(spark, store):
    store.upsert(facts(spark).withColumn("seq", F.lit(0)), ["seq"])
    files = store.between(datetime(2024, 1, 2, 6), datetime(2024, 1, 4)).inputFiles()
    assert {f.split("chunk_1d=")[1][:10] for f in files} == {"2024-01-02", "2024-01-03"}


def test_quality_of_nothing(spark):
    row = data_quality(facts(spark).limit(0)).first()
    assert (row["total_measurements"], row["valid_percentage"]) == (0, 0.0)


def test_latest(spark):
    rows = facts(spark)
    newest = latest_by_sampling_point(rows, limit=7, salts=4).collect()
    want = {}
    for row in rows.collect():
        want.setdefault(row["sampling_point_id"], []).append(row["time"])
    have = {}
    for row in newest:
        have.setdefault(row["sampling_point_id"], []).append(row["time"])
    assert {p: sorted(t) for p, t in have.items()} == {p: sorted(t)[-7:] for p, t in want.items()}
    assert latest_of(rows, "X/hot", 5).first()["time"] == max(want["X/hot"])


# --- streams --------------------------------------------------------------------------------


def test_append_mode_stream_drops_late_rows(spark, tmp_path):
    rows = facts(spark, 8000)
    checkpoint = str(tmp_path / "check")

    def run():
        arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in" / "*"))
        query = (
            stream_daily(arriving, points(spark), delay="1 day")
            .writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        query.awaitTermination()

    first_day = F.to_date("time") == F.lit(date(2024, 1, 1))
    on_time = rows.filter(~(first_day & (F.col("sampling_point_id") == "X/p1")))
    on_time.write.parquet(str(tmp_path / "in" / "a"))
    run()
    late = rows.filter(first_day & (F.col("sampling_point_id") == "X/p1"))
    late.write.parquet(str(tmp_path / "in" / "b"))
    run()
    done = spark.read.parquet(str(tmp_path / "out")).filter("day = '2024-01-01'")
    assert rounded(done) == rounded(
        daily_measurements(on_time, points(spark)).filter("day = '2024-01-01'")
    )


def test_update_mode_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    facts(spark, 6000).repartition(5).write.parquet(folder)
    table = DailyTable(spark, str(tmp_path / "daily"))
    arriving = spark.readStream.schema(facts(spark).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    maintain_daily(stream_daily(arriving, points(spark)), table, str(tmp_path / "c")).awaitTermination()
    assert rounded(table.read()) == rounded(daily_measurements(facts(spark, 6000), points(spark)))


def raw(frame):
    return frame.select(
        F.col("time").alias("Start"),
        F.col("sampling_point_id").alias("Samplingpoint"),
        F.col("pollutant_code").alias("Pollutant"),
        F.col("value").alias("Value"),
        F.col("aggregation_type").alias("AggType"),
        F.col("validity").alias("Validity"),
    )


def test_stream_ingest_replay(spark, store, tmp_path):
    folder, table = str(tmp_path / "in"), DailyTable(spark, str(tmp_path / "daily"))
    source = raw(facts(spark, 5000))
    source.repartition(3).write.parquet(folder)

    def run(checkpoint):
        stream = file_stream(spark, folder, max_files=1)
        stream_ingest(stream, store, str(tmp_path / checkpoint), table, points(spark)).awaitTermination()
        return rounded(store.read().select("time", "sampling_point_id", "value")), rounded(table.read())

    once = run("a")
    assert once[1] == rounded(daily_measurements(facts(spark, 5000), points(spark)))
    assert len(once[0]) == 5000
    assert run("a") == once  # nothing new
    assert run("b") == once  # all again, from the start
    # a late file with one old row: its day is recomputed at once
    raw(facts(spark, 1).withColumn("time", F.lit(datetime(2020, 5, 5))).withColumn("validity", F.lit(1)).withColumn("aggregation_type", F.lit("hour"))).write.mode("append").parquet(folder)
    late = run("b")
    assert len(late[0]) == 5001 and any(r[0] == "2020-05-05" for r in late[1])


def test_stream_matches_batch_load(spark, store, tmp_path):
    folder = str(tmp_path / "in")
    raw(facts(spark, 500)).write.parquet(folder)
    result = read_files(spark, list_files(spark, folder))
    assert store.copy(result.measurements) == 500
