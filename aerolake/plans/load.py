"""Loading raw files: one Spark job over all files, with a ledger of what happened."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.times import instant, utc_now
from aerolake.operators.entities import sampling_points_to_upsert, stations_to_upsert
from aerolake.operators.extract import (
    extract_errors,
    sampling_points_from_extract,
    stations_from_extract,
)
from aerolake.operators.harmonise import count_losses
from aerolake.operators.ledger import BATCH_SIZE, COMPLETED, FAILED, PENDING, RUNNING
from aerolake.plans.dimension_tables import DimensionTable
from aerolake.plans.ledger_table import LedgerTable
from aerolake.plans.measurement_store import MeasurementStore
from aerolake.plans.tables import delete_file, read_table, stage, staged, staging
from aerolake.schemas import LEDGER, MEASUREMENT_KEY, MEASUREMENT_NAMES
from aerolake.sources.manifest import local_copies
from aerolake.sources.station_extract import read_station_extract
from aerolake.sources.parquet_files import inspect_files, measurements_of, read_inspected

_FILE_ORDER = ["file_path", "row_index"]


@dataclass
class LoadedFiles:
    """What a multi-file read gave: typed measurements, and one row for each file."""

    raws: list[DataFrame]
    measurements: DataFrame
    files: DataFrame


def with_required_columns(inspected: DataFrame) -> DataFrame:
    """Inspected files, with an error for those that lack a column every measurement needs."""
    names = F.transform(F.from_json("columns", "array<array<string>>"), lambda column: column[0])
    missing = [
        F.when(~F.arrays_overlap(names, F.array(*map(F.lit, MEASUREMENT_NAMES[name]))), name)
        for name in (*MEASUREMENT_KEY, "pollutant_code")
    ]
    text = F.concat(F.lit("no column for "), F.array_join(F.array_compact(F.array(*missing)), ", "))
    lacking = F.when(F.size(F.array_compact(F.array(*missing))) > 0, text)
    return inspected.withColumn("error", F.coalesce("error", F.when(F.col("is_parquet"), lacking)))


def read_files(spark: SparkSession, listing: DataFrame) -> LoadedFiles:
    """Read every usable file of a listing (``path, length``) and go on past bad ones.

    ``files`` has ``path, measurements, dropped, error``. A file fails as a whole if its footer
    or pages are damaged, or if a time, sampling point or pollutant cannot be read; its counts
    are then NULL. So does a file without a column for one of the three, or with a known column of
    a kind that cannot be read. Rows that lack one of the three are left out and counted as
    ``dropped``; a file with rows of which none is left has failed as well.
    """
    inspected = stage(with_required_columns(inspect_files(listing)), "footers")
    raws = read_inspected(spark, inspected, tolerant=True)
    counts = [count_losses(raw) for raw in raws]
    kind = "file_path string, read bigint, dropped bigint, unreadable bigint, touched bigint"
    empty = spark.createDataFrame([], kind)
    counted = stage(reduce(DataFrame.unionByName, counts, empty), "file-counts")
    read = F.coalesce("read", F.lit(0))
    error = F.coalesce(
        F.col("error"),
        F.when(read < F.col("rows"), F.format_string("only %d of %d rows can be read", read, "rows")),
        F.when(
            F.col("unreadable") > 0,
            F.format_string("%d rows with an unreadable time, sampling point or pollutant", "unreadable"),
        ),
        F.when(
            (read > 0) & (F.coalesce("dropped", F.lit(0)) == read),
            F.format_string("none of %d rows has a time, sampling point and pollutant", read),
        ),
    )
    files = stage(
        inspected.join(counted.withColumnRenamed("file_path", "path"), "path", "left")
        .withColumn("problem", error)
        .select(
            "path",
            F.when(F.col("problem").isNull(), read - F.coalesce("dropped", F.lit(0))).alias("measurements"),
            F.when(F.col("problem").isNull(), F.coalesce("dropped", F.lit(0))).alias("dropped"),
            F.col("problem").alias("error"),
        ),
        "files",
    )
    bad = files.filter("error is not null").select(F.col("path").alias("file_path"))
    raws = [raw.join(bad, "file_path", "left_anti").select(*raw.columns) for raw in raws]
    return LoadedFiles(raws, measurements_of(spark, raws), files)


def repeated_keys(
    measurements: DataFrame, stored: DataFrame, order: list[str]
) -> DataFrame:
    """``file_path, reason`` of files that cannot be appended.

    A key may occur once: a file is refused for a key that it holds twice, that the store has,
    or that a file earlier in ``order`` (refused or not) has.
    """
    held = measurements.groupBy(*MEASUREMENT_KEY, "file_path").agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("place")
    )
    first = held.groupBy(*MEASUREMENT_KEY).agg(F.min("place").alias("first"))
    inside = held.join(first, MEASUREMENT_KEY).select(
        "file_path",
        F.when(F.col("n") > 1, "holds a duplicate key")
        .when(F.col("place") > F.col("first"), "has a duplicate key of an earlier file")
        .alias("reason"),
    )
    known = held.join(stored.select(*MEASUREMENT_KEY), MEASUREMENT_KEY, "left_semi").select(
        "file_path", F.lit("has a duplicate key of the store").alias("reason")
    )
    both = inside.filter("reason is not null").unionByName(known)
    return both.groupBy("file_path").agg(F.min("reason").alias("reason"))


def ledger_events(
    manifest: DataFrame, job_id: str, status: str, created: datetime, at: datetime, batch_size: int
) -> DataFrame:
    """One ledger event with the same state for each URL of a numbered manifest."""
    started = instant(at) if status != PENDING else F.lit(None).cast("timestamp")
    return manifest.select(
        F.lit(job_id).alias("job_id"),
        F.floor(F.col("position") / batch_size).cast("int").alias("batch_no"),
        "url",
        F.lit(status).alias("status"),
        F.lit(None).cast("bigint").alias("measurements"),
        F.lit(None).cast("string").alias("error"),
        instant(created).alias("created_at"),
        started.alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        instant(at).alias("event_time"),
    )


def append_events(events: DataFrame, ledger_path: str) -> None:
    events.select(*LEDGER.names).write.mode("append").parquet(ledger_path)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    return read_table(spark, ledger_path, LEDGER)


def load_manifest(
    spark: SparkSession,
    store: MeasurementStore,
    manifest: DataFrame,
    listing: DataFrame,
    job_id: str,
    upsert: bool = False,
    batch_size: int = BATCH_SIZE,
    ledger_path: str | LedgerTable | None = None,
    clock: Callable[[], datetime] = utc_now,
    stations: DimensionTable | None = None,
    sampling_points: DimensionTable | None = None,
) -> DataFrame:
    """Load the local copies of a manifest's URLs; returns the final event of each URL.

    All good files go into the store in one write; of rows with one key the file later in the
    manifest wins an upsert. A file that is damaged, or whose keys an append cannot take, fails
    alone, and so does a URL with no copy or with several. With dimension tables, new stations
    and sampling points are written before the measurements. With ``ledger_path`` the events
    pending, running and completed or failed are appended to that ledger (a folder of events or a
    ``LedgerTable``) as they occur; every URL gets a final event, even if the load breaks off,
    which then raises. Of its intermediate tables only the returned one stays.
    """
    created = clock()

    def note(events: DataFrame) -> None:
        if isinstance(ledger_path, LedgerTable):
            ledger_path.append(events)
        elif ledger_path:
            append_events(events, ledger_path)

    note(ledger_events(manifest, job_id, PENDING, created, created, batch_size))
    started = clock()
    running = ledger_events(manifest, job_id, RUNNING, created, started, batch_size)
    note(running)

    def finish(outcome: DataFrame) -> DataFrame:
        ended = clock()
        final = stage(
            running.drop("measurements", "error")
            .join(outcome, "url")
            .withColumn("status", F.when(F.col("error").isNull(), COMPLETED).otherwise(FAILED))
            .withColumns({"ended_at": instant(ended), "event_time": instant(ended)})
            .select(*LEDGER.names),
            "events",
            kept=True,
        )
        note(final)
        return final

    urls = manifest.select("url").distinct()
    with staging(spark):
        try:
            outcome = _load_copies(
                spark, store, manifest, listing, upsert, stations, sampling_points, created
            )
        except Exception as problem:
            text = f"the load broke off: {type(problem).__name__}: {problem}"
            finish(urls.select("url", F.lit(None).cast("bigint").alias("measurements"), F.lit(text).alias("error")))
            raise
        return finish(outcome)


def _load_copies(
    spark: SparkSession,
    store: MeasurementStore,
    manifest: DataFrame,
    listing: DataFrame,
    upsert: bool,
    stations: DimensionTable | None,
    sampling_points: DimensionTable | None,
    now: datetime,
) -> DataFrame:
    """Load what can be loaded; ``url, measurements, error`` of every URL."""
    copies = local_copies(manifest, listing).groupBy("url").agg(
        F.count("path").alias("n"), F.min("path").alias("path")
    )
    copies = stage(copies, "copies")
    single = copies.filter("n = 1").select("path").distinct()
    result = read_files(spark, listing.join(single, "path", "left_semi"))
    places = (
        copies.filter("n = 1")
        .join(manifest.select("url", "position"), "url")
        .groupBy(F.col("path").alias("file_path"))
        .agg(F.min("position").alias("position"))
    )
    order = ["position", "row_index"]
    with staged(result.measurements.join(places, "file_path"), "parsed") as parsed:
        good, refused = parsed, None
        if not upsert:
            span = parsed.agg(F.min("time").alias("low"), F.max("time").alias("high")).first()
            stored = store.read().limit(0) if span["low"] is None else store.between(
                span["low"], span["high"] + timedelta(seconds=1)
            )
            refused = stage(repeated_keys(parsed, stored, ["position", "file_path"]), "refused")
            good = parsed.join(refused.select("file_path"), "file_path", "left_anti")
        if stations is not None and sampling_points is not None:
            upsert_entities(result.raws, stations, sampling_points, now)
        plain = good.drop("file_path")
        if upsert:
            store.upsert(plain, order)
        else:
            store.copy(plain)
    outcome = copies.join(result.files.withColumnRenamed("error", "file_error"), "path", "left")
    if refused is not None:
        outcome = outcome.join(refused.withColumnRenamed("file_path", "path"), "path", "left")
    else:
        outcome = outcome.withColumn("reason", F.lit(None).cast("string"))
    failure = (
        F.when(F.col("n") == 0, F.lit("no local copy"))
        .when(F.col("n") > 1, F.lit("several local copies"))
        .otherwise(F.coalesce("file_error", "reason"))
    )
    return outcome.select(
        "url", F.when(failure.isNull(), F.col("measurements")).alias("measurements"), failure.alias("error")
    )


def upsert_entities(
    raws: list[DataFrame], stations: DimensionTable, sampling_points: DimensionTable, now: datetime
) -> dict[str, int]:
    """Parents before children; returns how many rows were written to each."""
    counts = {"stations": 0, "sampling_points": 0}
    for name, table, batch in [
        ("stations", stations, stations_to_upsert(raws)),
        ("sampling_points", sampling_points, sampling_points_to_upsert(raws)),
    ]:
        if batch is not None:
            counts[name] = sum(table.upsert(batch, now, null_overwrites=False).values())
    return counts


def load_entities(
    spark: SparkSession,
    result: LoadedFiles,
    stations: DimensionTable,
    sampling_points: DimensionTable,
    store: MeasurementStore,
    now: datetime,
) -> dict[str, int]:
    """Load stations, then sampling points, then measurements; returns the counts.

    The order keeps references intact: parents are written before their children.
    """
    counts = upsert_entities(result.raws, stations, sampling_points, now)
    counts["measurements"] = store.insert(result.measurements)
    return counts


def load_extract(
    spark: SparkSession,
    path: str,
    countries: DataFrame,
    pollutants: DataFrame,
    stations: DimensionTable,
    sampling_points: DimensionTable,
    now: datetime,
    first_errors: int = 100,
) -> dict[str, object]:
    """Load a station extract: stations, then their sampling points; returns totals and errors."""
    with staging(spark), staged(read_station_extract(spark, path), "extract") as extract:
        found_stations = stations_from_extract(extract, countries)
        found_points = sampling_points_from_extract(extract, countries, pollutants)
        station_changes = stations.upsert(found_stations, now)
        point_changes = sampling_points.upsert(found_points, now)
        errors = extract_errors(extract, countries, pollutants, first_errors).collect()
    return {
        "stations_processed": sum(station_changes.values()),
        "stations_created": station_changes["created"],
        "stations_updated": station_changes["updated"],
        "sampling_points_processed": sum(point_changes.values()),
        "sampling_points_created": point_changes["created"],
        "sampling_points_updated": point_changes["updated"],
        "errors": [row["message"] for row in errors],
    }


def remove_loaded(spark: SparkSession, files: DataFrame) -> int:
    """Delete the input files that loaded without error, as far as possible.

    ``files`` as in ``LoadedFiles``. Read it before the files are gone: frames derived from
    them cannot be computed afterwards.
    """
    loaded = [row["path"] for row in files.filter("error is null").select("path").collect()]
    return sum(delete_file(spark, path) for path in loaded)
