"""The ledger's snapshots, and intermediate tables that go when their work is done."""

import os
import random
from datetime import datetime, timedelta

import pytest

from aerolake.operators import ledger
from aerolake.plans import tables
from aerolake.plans.dimension_tables import sampling_points_table, stations_table
from aerolake.plans.ledger_table import LedgerTable
from aerolake.plans.load import load_manifest, read_ledger
from aerolake.plans.tables import stage, staging
from aerolake.schemas import LEDGER
from aerolake.sources.manifest import read_url_manifest
from aerolake.sources.parquet_files import list_files
from aerolake.streaming.ingest import file_stream, stream_ingest
from test_ingest import manifest_file
from test_parse import minimal, write

NOW = datetime(2024, 6, 1, 12)


def some_events(count):
    rng = random.Random(3)
    rows = []
    for number in range(count):
        url = None if number % 17 == 0 else f"u{number % 9}"
        at = NOW + timedelta(seconds=number)  # distinct, so that every last event is a definite one
        status = rng.choice(["pending", "running", "completed", "failed"])
        rows.append((f"j{number % 3}", number % 2, url, status, number, None, NOW, None, None, at))
    rng.shuffle(rows)
    return rows


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def segments_read(frame):
    return {part for name in frame.inputFiles() for part in name.split("/") if "=" in part}


def test_snapshot_equals_all_events(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path / "ledger"))
    assert table.current().count() == 0 and not table.fold() and table.events().count() == 0
    rows, given = some_events(120), []
    for start in range(0, 120, 20):
        part = rows[start : start + 20]
        given += part
        table.append(spark.createDataFrame(part, LEDGER))
        expected = rows_of(ledger.current_state(spark.createDataFrame(given, LEDGER)))
        assert rows_of(table.current()) == expected
        table.fold()
        assert rows_of(table.current()) == expected
    # of six folds the last sealed the sixth segment; five are in the snapshot
    table.append(spark.createDataFrame(rows[:20], LEDGER))  # again, and long after
    assert rows_of(table.current()) == expected
    assert segments_read(table.current()) == {"before=5", "segment=5", "segment=6"}
    assert table.events().count() == 140
    assert table.forget() == 4 and table.forget() == 0
    assert rows_of(table.current()) == expected and table.events().count() == 60


def test_appends_under_way_and_broken_folds(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path / "ledger"))
    rows = some_events(60)
    table.append(spark.createDataFrame(rows[:20], LEDGER))
    table.fold()
    # an append that chose its segment before the fold sealed it
    spark.createDataFrame(rows[20:40], LEDGER).write.mode("append").parquet(table._events(0))
    table.append(spark.createDataFrame(rows[40:], LEDGER))
    os.makedirs(f"{tmp_path}/ledger/states/before=1")  # what a fold that broke off leaves
    expected = rows_of(ledger.current_state(spark.createDataFrame(rows, LEDGER)))
    assert rows_of(table.current()) == expected
    assert table.fold() and rows_of(table.current()) == expected
    # folds without new events
    assert table.fold() and table.fold() and rows_of(table.current()) == expected


@pytest.fixture
def work(tmp_path, monkeypatch):
    made = []

    def folder(_, label):
        made.append(label)
        return str(tmp_path / "work" / f"{label}-{len(made)}")

    monkeypatch.setattr(tables, "work_dir", folder)
    return lambda: sorted(os.listdir(tmp_path / "work")), made


def test_scopes_own_what_is_staged(spark, work):
    left, _ = work
    outside = stage(spark.range(3), "outside")
    with staging(spark):
        inner = stage(spark.range(4), "inner")
        with staging(spark):
            assert stage(inner, "deep").count() == 4
            kept = stage(spark.range(5), "deep-kept", kept=True)
        assert left() == ["deep-kept-4", "inner-2", "outside-1"] and kept.count() == 5
        final = stage(kept, "final", kept=True)
    assert left() == ["final-5", "outside-1"] and (outside.count(), final.count()) == (3, 5)
    with pytest.raises(ZeroDivisionError), staging(spark):
        stage(spark.range(1), "lost")
        1 / 0
    assert left() == ["final-5", "outside-1"]


def test_a_load_leaves_its_result_only(spark, store, tmp_path, work):
    left, made = work
    write(tmp_path / "in" / "a.parquet", minimal(1))
    urls = read_url_manifest(spark, manifest_file(tmp_path, "https://h/a\nhttps://h/c"))
    listing = list_files(spark, str(tmp_path / "in"))
    table = LedgerTable(spark, str(tmp_path / "ledger"))
    stations = stations_table(spark, str(tmp_path / "stations"))
    points = sampling_points_table(spark, str(tmp_path / "points"))
    final = load_manifest(
        spark, store, urls, listing, "job", ledger_path=table, stations=stations, sampling_points=points
    )
    assert [name.split("-")[0] for name in left()] == ["events"] and len(made) > 4
    assert {r["status"] for r in final.collect()} == {"completed", "failed"}
    assert rows_of(table.current()) == rows_of(final) and table.events().count() == 6
    assert read_ledger(spark, f"{tmp_path}/ledger/events/segment=0").count() == 6
    with pytest.raises(Exception):  # the store cannot be written
        load_manifest(spark, None, urls, listing, "job-2", ledger_path=table)
    assert len(left()) == 2 and table.current().filter("job_id = 'job-2' and status = 'failed'").count() == 2


def test_a_stream_leaves_nothing(spark, store, tmp_path, work):
    _, made = work
    for name in "abc":
        write(tmp_path / "in" / f"{name}.parquet", minimal(1))
    stream = file_stream(spark, str(tmp_path / "in"), max_files=1)
    query = stream_ingest(stream, store, str(tmp_path / "ck"), report=str(tmp_path / "report"))
    query.awaitTermination()
    assert len(made) > 6 and os.listdir(tmp_path / "work") == []
    assert spark.read.parquet(str(tmp_path / "report")).count() == 3
