"""Continuous loading of raw measurement files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake.functions.times import utc_now
from aerolake.plans.daily_table import DailyTable
from aerolake.plans.dimension_tables import DimensionTable
from aerolake.plans.load import read_files, remove_loaded, upsert_entities
from aerolake.plans.measurement_store import MeasurementStore
from aerolake.plans.tables import staged, staging

_FILE_ORDER = ["file_path", "row_index"]
_LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """``path, length`` of arriving files; their contents are not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_LISTED)
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")  # a replayed batch may list files since removed
        .load(folder)
        .select("path", "length")
    )


def stream_ingest(
    files: DataFrame,
    store: MeasurementStore,
    checkpoint: str,
    daily: DailyTable | None = None,
    sampling_points: DataFrame | DimensionTable | None = None,
    upsert: bool = True,
    stations: DimensionTable | None = None,
    after_load: str | None = None,
    report: str | None = None,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Load the files of each micro-batch into the store, then recompute the days it touched.

    Files of either naming generation may arrive together: each is read by its own footer, as
    in ``read_files``. A bad file loads nothing and stays where it is. ``after_load="delete"``
    removes the files that did load, once their rows are stored. ``report`` is a folder to which
    ``path, measurements, dropped, error`` of every file are appended. With dimension tables,
    new stations and sampling points are written before the measurements. ``trigger`` is that of
    ``DataStreamWriter``; by default the stream ends when all that is there is loaded.

    A micro-batch deletes its intermediate tables when it ends, so a stream may run for ever.
    An upsert of the same rows changes nothing, so a replayed micro-batch is harmless. Late
    rows are as good as timely ones: their day is recomputed whatever its age.
    """
    if after_load not in (None, "delete"):
        raise ValueError(after_load)
    known = isinstance(sampling_points, DimensionTable)
    if stations is not None and not known:
        raise ValueError("new stations need a sampling-point table beside them")

    def load(listing: DataFrame, _: int) -> None:
        with staging(listing.sparkSession):
            load_files(listing)

    def load_files(listing: DataFrame) -> None:
        spark = listing.sparkSession
        result = read_files(spark, listing)
        if stations is not None:
            upsert_entities(result.raws, stations, sampling_points, utc_now())
        with staged(result.measurements, "micro-batch") as batch:
            touched = batch.select(F.to_date("time").alias("day")).distinct().collect()
            if upsert:
                store.upsert(batch, _FILE_ORDER)
            else:
                store.copy(batch)
        if daily is not None and sampling_points is not None:
            points = sampling_points.read() if known else sampling_points
            daily.refresh_days(store, points, {row["day"] for row in touched})
        if report:
            result.files.write.mode("append").parquet(report)
        if after_load == "delete":
            remove_loaded(spark, result.files)

    return (
        files.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
