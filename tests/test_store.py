"""Stored measurements: inserts, upserts, deletes, failures."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerolake.plans.dimension_tables import (
    pollutants_table,
    sampling_points_table,
    stations_table,
)
from aerolake.plans.measurement_store import (
    DuplicateKeyError,
    MeasurementStore,
    MissingKeyError,
    copy_text,
)
from aerolake.sources.lookups import country_seed, pollutant_seed, seed

DAY = datetime(2024, 1, 1)


def batch(spark, rows):
    """Rows of (time, sampling point, value, seq)."""
    frame = spark.createDataFrame(rows, "time timestamp, sampling_point_id string, value double, seq long")
    return frame.withColumn("pollutant_code", F.lit(8))


def hours(spark, count, point="P", start=DAY):
    return batch(spark, [(start + timedelta(hours=i), point, float(i), i) for i in range(count)])


def keys(store):
    return {(r["time"], r["sampling_point_id"]): r["value"] for r in store.read().collect()}


def test_insert_counts_and_refuses(spark, store):
    assert store.insert(hours(spark, 0)) == 0
    assert store.insert(hours(spark, 48)) == 48
    with pytest.raises(DuplicateKeyError, match="exists"):
        store.insert(hours(spark, 1, start=DAY + timedelta(hours=47)))
    with pytest.raises(DuplicateKeyError, match="repeated"):
        store.insert(hours(spark, 3, "Q").union(hours(spark, 1, "Q")))
    assert store.read().count() == 48
    assert store.insert(hours(spark, 48, "Q")) == 48
    assert sorted(d.day for d in store.chunks()) == [1, 2]


@pytest.mark.parametrize("rows, points", [(2500, 1), (10_000, 10)])
def test_repeated_keys(spark, store, rows, points):
    """Minute and hour run together, so only 120 keys are distinct."""
    numbered = spark.range(rows).select(
        F.make_timestamp(
            F.lit(2024), F.lit(1), F.lit(1), F.col("id") % 24, F.col("id") % 60, F.lit(0)
        ).alias("time"),
        F.concat(F.lit("P"), F.col("id") % points).alias("sampling_point_id"),
        F.lit(8).alias("pollutant_code"),
        F.col("id").cast("double").alias("value"),
        F.col("id").alias("seq"),
    )
    with pytest.raises(DuplicateKeyError):
        store.insert(numbered)
    assert store.upsert(numbered, ["seq"]) == rows
    assert store.read().count() == 120
    last = numbered.groupBy("time", "sampling_point_id").agg(F.max("value").alias("value"))
    assert keys(store) == {(r["time"], r["sampling_point_id"]): r["value"] for r in last.collect()}


def test_upsert_overwrites_with_null_and_keeps_the_rest(spark, store):
    store.insert(hours(spark, 48))
    fresh = batch(spark, [(DAY, "P", 5.0, 2), (DAY, "P", None, 3), (DAY, "P", 7.0, 1), (DAY, "Z", 1.0, 0)])
    before = {p.name: p.stat().st_mtime_ns for p in files_of(store, "chunk_1d=2024-01-02")}
    assert store.upsert(fresh, ["seq"]) == 4
    found = keys(store)
    assert found[(DAY, "P")] is None and found[(DAY, "Z")] == 1.0 and len(found) == 49
    # a day the batch does not touch is not rewritten
    assert before == {p.name: p.stat().st_mtime_ns for p in files_of(store, "chunk_1d=2024-01-02")}
    assert store.upsert(fresh, ["seq"]) == 4 and keys(store) == found


def files_of(store, folder):
    from pathlib import Path

    return sorted((Path(store.path) / folder).glob("*.parquet"))


def test_upsert_keeps_zero_flags_copy_does_not(spark, store):
    flagged = hours(spark, 2).withColumns({"validity": F.lit(0), "verification": F.lit(1)})
    store.upsert(flagged, ["seq"])
    assert {r["validity"] for r in store.read().collect()} == {0}
    later = hours(spark, 2, start=DAY + timedelta(days=3)).withColumns(
        {"validity": F.lit(0), "validity_flag_id": F.lit(2), "verification_status_id": F.lit(3)}
    ).withColumn("observation_id", F.lit(""))
    assert store.copy(later) == 2
    row = store.read().filter("chunk_1d = '2024-01-04'").first()
    assert (row["validity"], row["verification"], row["observation_id"]) == (2, 3, None)
    assert copy_text(later).first()[0].split("\t")[6] == "2"


@pytest.mark.parametrize("column", ["time", "sampling_point_id", "pollutant_code"])
def test_rows_without_key_are_refused(spark, store, column):
    torn = hours(spark, 3).withColumn(column, F.when(F.col("seq") != 1, F.col(column)))
    for write in (store.insert, store.copy, lambda b: store.upsert(b, ["seq"])):
        with pytest.raises(MissingKeyError, match="1 rows"):
            write(torn)
    assert store.read().count() == 0


def test_failed_write_leaves_table_intact(spark, store):
    store.insert(hours(spark, 48))
    before = keys(store)
    bad = hours(spark, 30).withColumn(
        "value", F.when(F.col("seq") == 29, F.raise_error(F.lit("torn"))).otherwise(F.lit(-1.0))
    )
    for write in (lambda: store.upsert(bad, ["seq"]), lambda: store.insert(bad)):
        with pytest.raises(Exception):  # noqa: B017
            write()
        assert keys(store) == before


def test_failure_while_rewriting_leaves_table_intact(spark, store):
    from aerolake.plans.tables import write_dates

    store.insert(hours(spark, 48))
    before = keys(store)
    torn = store.read().withColumn(
        "value", F.when(F.hour("time") == 23, F.raise_error(F.lit("torn"))).otherwise(F.lit(0.0))
    )
    with pytest.raises(Exception):  # noqa: B017
        write_dates(torn, store.path, "overwrite", store.column)
    assert keys(store) == before


def test_delete_range_is_inclusive(spark, store):
    store.insert(hours(spark, 24).union(hours(spark, 24, "Q")))
    removed = store.delete_time_range("P", DAY + timedelta(hours=10), DAY + timedelta(hours=15))
    assert removed == 6
    left = [p for _, p in keys(store)]
    assert left.count("P") == 18 and left.count("Q") == 24
    assert store.delete_time_range("nobody", DAY, DAY + timedelta(days=9)) == 0


def test_delete_drops_emptied_days(spark, store):
    store.insert(hours(spark, 72))
    assert store.delete_time_range("P", DAY + timedelta(days=1), DAY + timedelta(days=2)) == 25
    assert sorted(d.day for d in store.chunks()) == [1, 3]
    assert store.read().count() == 47


def test_cascade(spark, store):
    store.insert(hours(spark, 24).union(hours(spark, 30, "Q")))
    gone = spark.createDataFrame([("Q",), ("Q",), ("none",)], "sampling_point_id string")
    assert store.cascade_delete(gone) == 30
    assert {p for _, p in keys(store)} == {"P"} and sorted(d.day for d in store.chunks()) == [1]


def test_hot_key_upsert(spark, store):
    """A third of the rows share one key; the last of them must win."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(DAY))
        .otherwise(F.timestamp_seconds(F.col("id") + 1_704_153_600))
        .cast("timestamp")
        .alias("time"),
        F.lit("P").alias("sampling_point_id"),
        F.lit(8).alias("pollutant_code"),
        F.col("id").cast("double").alias("value"),
        F.col("id").alias("seq"),
    )
    assert store.upsert(rows, ["seq"]) == 60_000
    assert store.read().count() == 40_001
    assert keys(store)[(DAY, "P")] == 59_997.0


def test_dimension_upserts(spark, tmp_path):
    table = stations_table(spark, str(tmp_path / "stations"))
    one = spark.createDataFrame([("S1", "IT", "one")], "station_code string, country_code string, station_name string")
    assert table.upsert(one, DAY) == {"created": 1, "updated": 0}
    change = spark.createDataFrame([("S1", None), ("S2", "two")], "station_code string, station_name string")
    later = DAY + timedelta(days=1)
    assert table.upsert(change, later) == {"created": 1, "updated": 1}
    rows = {r["station_code"]: r for r in table.read().collect()}
    assert rows["S1"]["station_name"] is None and rows["S1"]["country_code"] == "IT"
    assert (rows["S1"]["created_at"], rows["S1"]["updated_at"]) == (DAY, later)
    with pytest.raises(ValueError, match="unknown"):
        table.upsert(one.withColumn("colour", F.lit("red")), later)
    twice = spark.createDataFrame(
        [("S2", "late", 2), ("S2", "early", 1)], "station_code string, station_name string, n int"
    )
    with pytest.raises(DuplicateKeyError):
        table.upsert(twice.drop("n"), later)
    table.upsert(twice, later, order=["n"])
    with pytest.raises(MissingKeyError):
        table.upsert(spark.createDataFrame([(None, "x")], "station_code string, station_name string"), later)
    assert table.read().filter("station_code is null").count() == 0
    assert table.read().filter("station_code = 'S2'").first()["station_name"] == "late"
    assert table.delete(one) == 1 and table.read().count() == 1


def test_seed_keeps_existing(spark, tmp_path):
    table = pollutants_table(spark, str(tmp_path / "pollutants"))
    table.upsert(spark.createDataFrame([(1, "mine", 3)], "pollutant_code int, pollutant_name string, colour int"), DAY)
    table.seed(pollutant_seed(spark))
    rows = {r["pollutant_code"]: r["pollutant_name"] for r in table.read().collect()}
    assert len(rows) == 21 and rows[1] == "mine" and rows[6001] == "PM2.5"
    table.seed(pollutant_seed(spark))
    assert table.read().count() == 21
    assert seed(country_seed(spark), country_seed(spark), "country_code").count() == 3


def test_sampling_points_table(spark, tmp_path):
    table = sampling_points_table(spark, str(tmp_path / "points"))
    row = spark.createDataFrame([("IT/a", "IT/S", 8)], "sampling_point_id string, station_code string, pollutant_code int")
    assert table.upsert(row, DAY)["created"] == 1
    assert table.upsert(row, DAY)["updated"] == 1


def test_wide_chunks(spark, tmp_path):
    store = MeasurementStore(spark, str(tmp_path / "weeks"), chunk_days=7)
    assert store.insert(hours(spark, 24 * 10, start=datetime(2024, 1, 5))) == 240
    # 1 January 2024 is a Monday
    assert sorted(str(c) for c in store.chunks()) == ["2024-01-01", "2024-01-08"]
    assert store.between(datetime(2024, 1, 7), datetime(2024, 1, 9)).count() == 48
    assert store.delete_time_range("P", datetime(2024, 1, 5), datetime(2024, 1, 8)) == 73
    assert [str(c) for c in store.chunks()] == ["2024-01-08"]
    assert store.upsert(hours(spark, 24, start=datetime(2024, 1, 14)), ["seq"]) == 24
    assert store.read().count() == 240 - 73
    with pytest.raises(ValueError, match="chunk_7d"):
        MeasurementStore(spark, store.path)


def test_newest_of_every_point_reads_few_chunks(spark, store, monkeypatch):
    """Daily points are done after the newest chunks; a point that stopped leads further back."""
    hours = spark.range(24 * 16).select(
        F.timestamp_seconds(F.col("id") * 3600 + 1_704_067_200).alias("time"), F.lit(8).alias("pollutant_code")
    )
    daily = hours.withColumn("sampling_point_id", F.explode(F.array(F.lit("A"), F.lit("B"))))
    stopped = hours.filter("time < '2024-01-13'").withColumn("sampling_point_id", F.lit("C"))
    rare = hours.filter("time < '2024-01-01 02:00:00'").withColumn("sampling_point_id", F.lit("D"))
    every = daily.unionByName(stopped).unionByName(rare)
    store.insert(every)
    asked = []
    read = type(store)._read_chunks
    monkeypatch.setattr(type(store), "_read_chunks", lambda self, chunks: asked.append(len(chunks)) or read(self, chunks))

    def newest(ids, limit):
        asked.clear()
        points = spark.createDataFrame([(i,) for i in ids], "sampling_point_id string")
        rows = store.latest_by_sampling_point(points, limit).select("sampling_point_id", "time").collect()
        want = {
            (r[0], r[1])
            for i in ids
            for r in every.filter(F.col("sampling_point_id") == i).orderBy(F.desc("time")).limit(limit)
            .select("sampling_point_id", "time").collect()
        }
        assert len(rows) == len(want) and {tuple(r) for r in rows} == want
        return [n for n in asked if n]

    assert newest("AB", 24) == [1]
    assert newest("AB", 30) == [1, 2]
    assert newest("ABC", 5) == [1, 2, 4]
    assert newest("ABCD", 3) == [1, 2, 4, 8, 1]
    assert newest("Z", 3) == [1, 2, 4, 8, 1]
    assert store.latest_by_sampling_point(spark.createDataFrame([], "sampling_point_id string"), 3).count() == 0
