"""Stored point-days, and the daily stream that keeps them."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from test_daily import facts, plan, points, rounded

from aerolake.operators.aggregates import daily_measurements, daily_of_points, merge_moments, point_days
from aerolake.plans.daily_table import DailyTable
from aerolake.plans.dimension_tables import sampling_points_table
from aerolake.plans.point_days import POINT_KEY, PointDayTable
from aerolake.streaming.living_daily import LivingDaily

NOW = datetime(2024, 2, 5)


def day():
    return F.to_date("time").alias("day")



@pytest.fixture
def table(spark, tmp_path):
    return PointDayTable(spark, str(tmp_path / "point-days"))


@pytest.fixture
def living(spark, tmp_path, table):
    dimension = sampling_points_table(spark, str(tmp_path / "dimension"))
    daily = DailyTable(spark, str(tmp_path / "daily"))
    return LivingDaily(table, daily, dimension, str(tmp_path / "living"), watermark_days=2)


def merged(table, spark, days=None):
    return rounded(daily_of_points(table.read(days), points(spark)))


def test_no_window_in_the_plan(spark):
    text = plan(daily_measurements(facts(spark), points(spark)))
    assert "Window" not in text and "partial_collect_list" in text


def test_merged_moments_keep_their_digits(spark):
    """Parts far from zero, without values, and of one value each."""
    rows = [(1, 1e9 + i, 0.0, 1e9 + i, 1e9 + i) for i in range(5)] + [(0, None, None, None, None), (3, 1e9, 0.5, 1e9, 1e9)]
    parts = spark.createDataFrame(
        [("k", *r[:3], *r[3:], 4, None, None) for r in rows],
        "k string, n bigint, mean double, m2 double, low double, high double, rows bigint, first timestamp, last timestamp",
    )
    out = merge_moments(parts, ["k"]).first()
    values = [1e9 + i for i in range(5)] + [1e9] * 3
    mean = sum(v - 1e9 for v in values) / 8
    assert out["n"] == 8 and out["rows"] == 28 and out["mean"] == pytest.approx(1e9 + mean, abs=1e-6)
    assert out["m2"] == pytest.approx(0.5 + sum((v - 1e9 - mean) ** 2 for v in values), rel=1e-6)  # a value of 1e9 has steps of 1e-7
    empty = merge_moments(parts.filter("n = 0"), ["k"]).first()
    assert (empty["n"], empty["rows"], empty["mean"]) == (0, 4, None)


def test_appended_changes_merge(spark, table):
    whole = facts(spark, 6000)
    for number in range(3):
        days = table.append(whole.filter(F.pmod(F.xxhash64("time"), F.lit(3)) == number), number)
        assert days <= table.days()
    assert merged(table, spark) == rounded(daily_measurements(whole, points(spark)))
    # the same change again replaces itself
    table.append(whole.filter(F.pmod(F.xxhash64("time"), F.lit(3)) == 1), 1)
    assert merged(table, spark) == rounded(daily_measurements(whole, points(spark)))
    with pytest.raises(ValueError):
        table.append(whole, -1)


def test_only_the_days_asked_for_are_read(spark, table):
    table.append(facts(spark, 20_000), 0)
    days = sorted(table.days())
    assert len(days) > 3
    files = table.read({days[1]}).inputFiles()
    assert files and all(f"day={days[1]}" in name for name in files)
    assert table.read(set()).count() == 0 and table.read({date(1999, 1, 1)}).count() == 0


def test_recomputed_points_replace_what_was_known(spark, store, table):
    whole = facts(spark, 6000).dropDuplicates(["time", "sampling_point_id"])
    store.insert(whole)
    table.append(whole, 0)
    hot = F.col("sampling_point_id") == "X/hot"
    changed = whole.filter(hot).withColumn("value", F.col("value") * 2)
    store.upsert(changed, ["time"])
    table.recompute(store, changed.select(day(), "sampling_point_id"), 1)
    # a point that loses all its rows on a day, and one that was never there
    first = min(table.days())
    gone = spark.createDataFrame([(first, "X/p1"), (first, "X/none")], "day date, sampling_point_id string")
    store.delete_time_range("X/p1", datetime(2024, 1, 1), datetime(2024, 1, 1, 23, 59, 59))
    assert table.recompute(store, gone, 2) == {first}
    want = rounded(daily_measurements(store.read(), points(spark)))
    assert merged(table, spark) == want
    assert table.read({first}).filter("sampling_point_id in ('X/p1', 'X/none')").count() == 0
    # later rows of a replaced point count again
    late = whole.filter((F.col("sampling_point_id") == "X/p1") & (F.to_date("time") == F.lit(first)))
    store.insert(late)
    table.append(late, 3)
    assert merged(table, spark) == rounded(daily_measurements(store.read(), points(spark)))
    nothing = spark.createDataFrame([], "day date, sampling_point_id string")
    assert table.recompute(store, nothing, 4) == set()


def test_compaction_changes_nothing(spark, store, table, monkeypatch):
    whole = facts(spark, 6000).dropDuplicates(["time", "sampling_point_id"])
    store.insert(whole)
    for number in range(3):
        table.append(whole.filter(F.pmod(F.xxhash64("time"), F.lit(3)) == number), number)
    first = min(table.days())
    store.delete_time_range("X/p1", datetime(2024, 1, 1), datetime(2024, 1, 1, 23, 59, 59))
    table.recompute(store, spark.createDataFrame([(first, "X/p1")], "day date, sampling_point_id string"), 3)
    want = rounded(daily_measurements(store.read(), points(spark)))
    with pytest.raises(ValueError):
        table.compact(table.days(), 3)
    # a compaction that stops before it removes anything already holds
    with monkeypatch.context() as stopped:
        stopped.setattr("aerolake.plans.point_days.drop_folders", lambda spark, paths: None)
        table.compact({first}, 8)
    assert len(table.changes(first)) > 1 and merged(table, spark) == want
    assert table.compact(table.days(), 9) == table.days()
    assert all(table.changes(day) == [9] for day in table.days()) and merged(table, spark) == want
    assert table.compact(table.days(), 10) == set()
    # a day of which nothing is left goes
    keys = table.read({first}).select("day", "sampling_point_id")
    store.delete_time_range("X/hot", datetime(2024, 1, 1), datetime(2024, 1, 2))
    empty = store.read().filter(F.to_date("time") == F.lit(first)).select("sampling_point_id").distinct().collect()
    for row in empty:
        store.delete_time_range(row[0], datetime(2024, 1, 1), datetime(2024, 1, 1, 23, 59, 59))
    table.recompute(store, keys, 11)
    table.compact({first}, 12)
    assert first not in table.days()


def test_stream_of_growing_dimension_and_late_rows(spark, tmp_path, living):
    whole, every = facts(spark, 20_000), points(spark)
    known = every.filter("sampling_point_id <> 'X/hot' and sampling_point_id <> 'X/p3'")
    living.sampling_points.upsert(known, NOW)
    folder, schema = str(tmp_path / "in"), whole.schema
    newest = F.to_date("time") >= F.lit(date(2024, 1, 8))

    def step(rows):
        rows.repartition(2).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        living.run(stream, str(tmp_path / "c"), first_number=100).awaitTermination()

    step(whole.filter(newest))
    assert rounded(living.daily.read()) == rounded(daily_measurements(whole.filter(newest), known))
    assert {r["sampling_point_id"] for r in living.parked().collect()} == {"X/hot", "X/p3"}
    assert living.late().count() == 0
    living.sampling_points.upsert(every.filter("sampling_point_id = 'X/hot'"), NOW)
    step(whole.filter(~newest))
    now = every.filter("sampling_point_id <> 'X/p3'")
    assert rounded(living.daily.read()) == rounded(daily_measurements(whole, now))
    assert {r["sampling_point_id"] for r in living.parked().collect()} == {"X/p3"}
    horizon = max(living.points.days()).toordinal() - 2
    valid = whole.filter("validity >= 1 and aggregation_type = 'hour'").filter(~newest)
    want = {r["day"]: r["count"] for r in valid.groupBy(day()).count().collect() if r["day"].toordinal() < horizon}
    assert {r["day"]: r["rows"] for r in living.late().collect()} == want and want
    living.sampling_points.upsert(every.filter("sampling_point_id = 'X/p3'"), NOW)
    assert living.release() and living.parked().isEmpty() and living.release() == set()
    assert rounded(living.daily.read()) == rounded(daily_measurements(whole, every))


def test_replayed_change_is_harmless(spark, living):
    living.sampling_points.upsert(points(spark), NOW)
    whole = facts(spark, 8000)
    early = F.dayofmonth("time") <= 2
    living.apply(whole.filter(~early), 0)
    living.apply(whole.filter(early), 1)
    late = sorted(map(str, living.late().collect()))
    living.apply(whole.filter(early), 1)
    assert rounded(living.daily.read()) == rounded(daily_measurements(whole, points(spark)))
    assert sorted(map(str, living.late().collect())) == late
    assert living.apply(whole.limit(0), 2) == set()


def test_point_days_have_one_row_each(spark):
    found = point_days(facts(spark, 5000))
    assert found.count() == found.select(*POINT_KEY).distinct().count()
