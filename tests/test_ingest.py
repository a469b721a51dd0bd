"""Manifests, the ledger, whole loads and maintenance."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerolake.operators import ledger
from aerolake.operators.aggregates import table_counts
from aerolake.plans import maintenance
from aerolake.plans.dimension_tables import sampling_points_table, stations_table
from aerolake.plans.load import load_entities, load_manifest, read_files, read_ledger, remove_loaded
from aerolake.schemas import LEDGER
from aerolake.sources.manifest import (
    EmptyManifestError,
    first_files,
    local_copies,
    read_url_list,
    read_url_manifest,
)
from aerolake.sources.parquet_files import list_files
from test_parse import minimal, write

NOW = datetime(2024, 6, 1, 12)


def manifest_file(tmp_path, text):
    path = tmp_path / "urls.txt"
    path.write_text(text)
    return str(path)


def test_manifest(spark, tmp_path):
    path = manifest_file(tmp_path, "# head\nhttps://h/a\n\n  https://h/b.parquet  \n  # tail\nhttps://h/c")
    urls = read_url_manifest(spark, path).orderBy("position").collect()
    assert [(r["position"], r["url"]) for r in urls] == [
        (0, "https://h/a"),
        (1, "https://h/b.parquet"),
        (2, "https://h/c"),
    ]
    assert first_files(read_url_manifest(spark, path), 2).count() == 2
    assert first_files(read_url_manifest(spark, path), None).count() == 3
    with pytest.raises(EmptyManifestError):
        read_url_manifest(spark, manifest_file(tmp_path, "\n# nothing\n"))


def test_manifest_over_many_splits(spark, tmp_path):
    path = manifest_file(tmp_path, "\n".join(f"https://host/{i:06d}" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        urls = read_url_manifest(spark, path)
        assert all(r["url"].endswith(f"{r['position']:06d}") for r in urls.collect())
        batches = ledger.cut_batches(urls.filter("position < 120")).orderBy("batch_no").collect()
        assert [b["urls_count"] for b in batches] == [50, 50, 20]
        assert batches[2]["urls"][0].endswith("000100") and batches[0]["urls"] == sorted(batches[0]["urls"])
        first = read_url_list(spark, path, max_urls=3).collect()
        assert [r["url"][-6:] for r in first] == ["000001", "000002", "000003"]  # header line skipped
        assert read_url_list(spark, path).count() == 2999
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_numbered(spark):
    rows = spark.range(1000).select((F.col("id") * 977 % 100_003).alias("n"))
    numbered = ledger.numbered(rows, "n", span=1000).orderBy("n").collect()
    assert [r["position"] for r in numbered] == list(range(1000))


def test_direct_batch_limits():
    assert ledger.check_direct_batch(["u"] * 50)
    for urls in ([], ["u"] * 51):
        with pytest.raises(ValueError):
            ledger.check_direct_batch(urls)


def batches(spark, *states):
    rows = [("j", i, s, 3 if s == "completed" else 0, f) for i, (s, f) in enumerate(states)]
    return spark.createDataFrame(rows, "job_id string, batch_no int, status string, succeeded int, failed int")


@pytest.mark.parametrize(
    "states, status, strict",
    [
        ([], "created", "created"),
        ([("completed", 0)] * 2, "completed", "completed"),
        ([("completed", 1), ("completed", 0)], "completed", "failed"),
        ([("failed", 0)] * 2, "failed", "failed"),
        ([("completed", 0), ("failed", 0)], "running", "failed"),
        ([("completed", 0), ("running", 0)], "running", "running"),
        ([("pending", 0), ("failed", 0)], "running", "running"),
        ([("pending", 0)] * 2, "pending", "pending"),
    ],
)
def test_job_status(spark, states, status, strict):
    jobs = spark.createDataFrame([("j",)], "job_id string")
    assert ledger.job_status(jobs, batches(spark, *states)).first()["status"] == status
    assert ledger.job_status(jobs, batches(spark, *states), strict=True).first()["status"] == strict


def test_progress(spark):
    rows = batches(spark, ("completed", 1), ("completed", 0), ("running", 0))
    row = ledger.job_progress(rows).first()
    assert (row["completion_pct"], row["urls_succeeded"], row["urls_failed"]) == (66.67, 6, 1)
    assert (row["batches_completed"], row["batches_running"]) == (2, 1)


def test_batch_states(spark):
    def event(batch, url, status, at, error=None):
        time = NOW + timedelta(seconds=at)
        ended = time if status in ("completed", "failed") else None
        return ("j", batch, url, status, 5, error, NOW, NOW, ended, time)

    events = [
        event(0, "a", "pending", 0), event(0, "a", "running", 0), event(0, "a", "completed", 4),
        event(0, "b", "pending", 0), event(0, "b", "failed", 9, "HTTP 500"),
        event(1, "c", "pending", 0), event(1, "c", "running", 1), event(1, "d", "pending", 0),
        event(2, "e", "pending", 0),
        event(3, "f", "pending", 0), event(3, None, "failed", 3, "aborted"),
    ]
    files = ledger.current_state(spark.createDataFrame(events, LEDGER))
    states = {r["batch_no"]: r for r in ledger.batch_states(files).collect()}
    assert {n: r["status"] for n, r in states.items()} == {0: "completed", 1: "running", 2: "pending", 3: "failed"}
    assert (states[0]["succeeded"], states[0]["failed"], states[3]["error"]) == (1, 1, "aborted")
    seconds = {r["batch_no"]: r["duration_seconds"] for r in ledger.batch_durations(ledger.batch_states(files)).collect()}
    assert seconds == {0: 9.0, 1: None, 2: None, 3: 3.0}
    totals = ledger.batch_load_stats(files).first()
    assert (totals["files_processed"], totals["measurements"], totals["errors"]) == (1, 5, 1)


def test_load_manifest(spark, store, tmp_path):
    folder = tmp_path / "in"
    write(folder / "a.parquet", minimal(2, DatetimeBegin=[NOW, NOW + timedelta(hours=1)]))
    (folder / "b.parquet").write_text("junk")
    urls = read_url_manifest(spark, manifest_file(tmp_path, "https://h/a\nhttps://h/b.parquet\nhttps://h/c"))
    listing = list_files(spark, str(folder))
    assert {r["url"][-1]: r["path"] is None for r in local_copies(urls, listing).collect()}["c"]
    rows = {r["url"]: r for r in load_manifest(spark, store, urls, listing, "job").collect()}
    assert rows["https://h/a"]["status"] == "completed" and rows["https://h/a"]["measurements"] == 2
    assert rows["https://h/b.parquet"]["status"] == "failed" and "ValueError" in rows["https://h/b.parquet"]["error"]
    assert rows["https://h/c"]["error"] == "no local copy"
    assert store.read().count() == 2
    again = load_manifest(spark, store, urls, listing, "job").filter("url = 'https://h/a'").first()
    assert again["status"] == "failed" and "duplicate" in again["error"]
    upserted = load_manifest(spark, store, urls, listing, "job", upsert=True).filter("url = 'https://h/a'").first()
    assert upserted["status"] == "completed" and store.read().count() == 2


def test_ledger_of_a_load(spark, store, tmp_path):
    write(tmp_path / "in" / "a.parquet", minimal(1))
    urls = read_url_manifest(spark, manifest_file(tmp_path, "https://h/a\nhttps://h/c"))
    path = str(tmp_path / "ledger")
    ticks = iter(NOW + timedelta(seconds=s) for s in (0, 1, 5))
    listing = list_files(spark, str(tmp_path / "in"))
    load_manifest(spark, store, urls, listing, "job", batch_size=1, ledger_path=path, clock=lambda: next(ticks))
    events = read_ledger(spark, path)
    assert events.count() == 6
    batches = ledger.batch_states(ledger.current_state(events))
    assert {(r["batch_no"], r["status"], r["failed"]) for r in batches.collect()} == {(0, "completed", 0), (1, "completed", 1)}
    assert {r["duration_seconds"] for r in ledger.batch_durations(batches).collect()} == {4.0}
    message = ledger.failed_files(urls, ledger.current_state(events).filter("status = 'completed'"), events)
    assert [r["message"] for r in message.collect()] == ["https://h/c: no local copy"]


def test_load_entities_twice(spark, store, tmp_path):
    folder = tmp_path / "in"
    write(folder / "a.parquet", minimal(2, AirQualityStationEoICode=["A", "B"], SamplingPoint=["IT/SPO-A_8", "IT/SPO-B_8"]))
    result = read_files(spark, list_files(spark, str(folder)))
    stations = stations_table(spark, str(tmp_path / "stations"))
    points = sampling_points_table(spark, str(tmp_path / "points"))
    counts = load_entities(spark, result, stations, points, store, NOW)
    assert counts == {"stations": 2, "sampling_points": 2, "measurements": 2}
    with pytest.raises(ValueError):
        load_entities(spark, result, stations, points, store, NOW)
    counts = {r["table_name"]: r["rows"] for r in table_counts(stations.read(), points.read(), store.read()).collect()}
    assert counts == {"stations": 2, "sampling_points": 2, "measurements": 2}


def test_remove_loaded_keeps_bad_files(spark, store, tmp_path):
    folder = tmp_path / "in"
    write(folder / "a.parquet", minimal(1))
    (folder / "b.parquet").write_text("junk")
    result = read_files(spark, list_files(spark, str(folder)))
    store.copy(result.measurements)
    assert remove_loaded(spark, result.files) == 1
    assert [p.name for p in folder.glob("*.parquet")] == ["b.parquet"]


def days_of_rows(spark, days):
    return spark.range(24 * days * 20).select(
        F.timestamp_seconds((F.col("id") / 20).cast("int") * 3600 + 1_704_067_200).alias("time"),
        F.concat(F.lit("P"), F.col("id") % 20).alias("sampling_point_id"),
        F.lit(8).alias("pollutant_code"),
        F.col("id").cast("double").alias("value"),
    )


def test_compaction(spark, store, tmp_path):
    ledger_path = str(tmp_path / "compaction")
    store.insert(days_of_rows(spark, 5), batch_size=30)
    rows = sorted(map(tuple, store.read().collect()), key=str)
    files_before = maintenance.chunk_files(store).count()
    now = datetime(2024, 2, 3)  # 30 days earlier is 4 January
    assert maintenance.compact_old_partitions(store, ledger_path, now) == 3
    assert sorted(map(tuple, store.read().collect()), key=str) == rows
    files = maintenance.chunk_files(store)
    assert files.count() < files_before
    notes = maintenance.read_compaction_ledger(spark, ledger_path)
    status = maintenance.compaction_status(files, notes).first()
    assert (status["total_partitions"], status["compacted_partitions"], status["uncompacted_partitions"]) == (5, 3, 2)
    report = maintenance.storage_report(files, notes).first()
    assert report["compression_ratio"] > 1 and report["compaction_effective"]
    assert report["table_size"].endswith("B") and 0 < report["space_saved_percentage"] < 100
    # done days are passed over
    assert maintenance.compact_old_partitions(store, ledger_path, now) == 0
    path = files.filter("chunk = '2024-01-01'").first()["path"]
    ordered = [r[0] for r in spark.read.parquet(path).select("sampling_point_id").collect()]
    assert ordered == sorted(ordered)


def test_compaction_goes_on_past_a_bad_day(spark, store, tmp_path):
    from pathlib import Path

    ledger_path = str(tmp_path / "compaction")
    store.insert(days_of_rows(spark, 3))
    bad = next((Path(store.path) / "chunk_1d=2024-01-02").glob("*.parquet"))
    bad.with_name("." + bad.name + ".crc").unlink(missing_ok=True)
    bad.write_bytes(b"PAR1 torn PAR1")
    assert maintenance.compact_old_partitions(store, ledger_path, NOW) == 2
    notes = {r["chunk"]: r["error"] for r in maintenance.read_compaction_ledger(spark, ledger_path).collect()}
    assert notes[date(2024, 1, 2)] and notes[date(2024, 1, 1)] is None and notes[date(2024, 1, 3)] is None


def test_storage_report_without_compaction(spark, store, tmp_path):
    store.insert(days_of_rows(spark, 1))
    notes = maintenance.read_compaction_ledger(spark, str(tmp_path / "none"))
    report = maintenance.storage_report(maintenance.chunk_files(store), notes).first()
    assert (report["compression_ratio"], report["space_saved_percentage"]) == (1.0, 0.0)
    assert report["uncompacted_size"] == report["compacted_size"] == report["table_size"]


def test_files_that_give_nothing_stay(spark, store, tmp_path):
    """A missing or odd column, or no whole row: an error for the file, and the file is kept."""
    folder = tmp_path / "in"
    write(folder / "good.parquet", minimal(1))
    whole = minimal(2)
    names = {c: c for c in whole.columns} if hasattr(whole, "columns") else {}
    point = next(c for c in names if c.lower() == "samplingpoint")
    value = next(c for c in names if c in ("Value", "Concentration"))
    write(folder / "short.parquet", whole.drop(columns=[point]))
    write(folder / "odd.parquet", whole.assign(**{value: [[1.0]] * len(whole)}))
    write(folder / "none.parquet", whole.assign(**{point: [None] * len(whole)}))
    write(folder / "nothing.parquet", whole.head(0))
    result = read_files(spark, list_files(spark, str(folder)))
    found = {r["path"].rsplit("/", 1)[1]: r for r in result.files.collect()}
    assert found["good.parquet"]["error"] is None and found["nothing.parquet"]["error"] is None
    assert found["nothing.parquet"]["measurements"] == 0
    assert "no column for sampling_point_id" in found["short.parquet"]["error"]
    assert value in found["odd.parquet"]["error"] and "none of" in found["none.parquet"]["error"]
    assert found["none.parquet"]["measurements"] is None
    store.copy(result.measurements)
    remove_loaded(spark, result.files)
    assert {p.name for p in folder.glob("*.parquet")} == {"short.parquet", "odd.parquet", "none.parquet"}
