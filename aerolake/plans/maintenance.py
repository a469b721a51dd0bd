"""Compaction of old partitions and reports on storage."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.clean import format_bytes
from aerolake.functions.times import as_utc
from aerolake.plans.measurement_store import MeasurementStore
from aerolake.plans.tables import exists, read_dates, read_table

COMPACTION_LEDGER = T.StructType(
    [
        T.StructField("chunk", T.DateType(), False),
        T.StructField("before_bytes", T.LongType()),
        T.StructField("after_bytes", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("compacted_at", T.TimestampType()),
    ]
)
TARGET_FILE_BYTES = 256 * 1024 * 1024


def chunk_files(store: MeasurementStore, chunks: list[date] | None = None) -> DataFrame:
    """``chunk, path, length`` of the store's data files (of some chunks), from the listing alone."""
    spark = store.spark
    folders = [store.path]
    if chunks is not None:
        there = store.chunks()
        folders = [f"{store.path}/{store.column}={c.isoformat()}" for c in chunks if c in there]
    if not folders or not exists(spark, store.path):
        return spark.createDataFrame([], "chunk date, path string, length long")
    chunk = F.regexp_extract("path", rf"/{store.column}=(\d{{4}}-\d{{2}}-\d{{2}})/", 1)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folders)
        .select(chunk.try_cast("date").alias("chunk"), "path", "length")
    )


def _chunk_bytes(store: MeasurementStore, chunks: list[date] | None = None) -> dict[date, int]:
    """Bytes of all chunks, or of some: then only their folders are listed."""
    files = chunk_files(store, chunks).groupBy("chunk").agg(F.sum("length").alias("bytes"))
    return {row["chunk"]: row["bytes"] for row in files.collect()}


def read_compaction_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, COMPACTION_LEDGER)


def compacted(ledger: DataFrame) -> DataFrame:
    """Chunks done, with their first size before and last size after."""
    return (
        ledger.filter("error is null")
        .groupBy("chunk")
        .agg(
            F.min_by("before_bytes", "compacted_at").alias("before_bytes"),
            F.max_by("after_bytes", "compacted_at").alias("after_bytes"),
        )
    )


def compact_old_partitions(
    store: MeasurementStore,
    ledger_path: str,
    now: datetime,
    older_than_days: int = 30,
    chunks_at_once: int = 32,
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite chunks that ended some days ago into large sorted files; returns how many.

    Rows are ordered by sampling point, newest first, then pollutant, so that a filter on a
    sampling point skips most row groups. Range partitioning also cuts a chunk, or a sampling
    point within it, that is too large for one file. Chunks that still have the size that the
    ledger notes are skipped; one that was written to since is compacted again. They are taken
    in groups, and if a group fails its chunks are tried one by one, so that a failing one is
    noted and passed over.
    """
    spark, now = store.spark, as_utc(now)
    limit = (now - timedelta(days=older_than_days)).date() - timedelta(days=store.chunk_days)
    noted = compacted(read_compaction_ledger(spark, ledger_path)).collect()
    done = {row["chunk"]: row["after_bytes"] for row in noted}
    old = sorted(chunk for chunk in store.chunks() if chunk <= limit)
    before = _chunk_bytes(store, old)
    todo = [chunk for chunk in old if chunk not in done or before.get(chunk) != done[chunk]]
    count = 0
    for first in range(0, len(todo), chunks_at_once):
        group = todo[first : first + chunks_at_once]
        errors: dict[date, str] = {}
        try:
            _rewrite(store, group, before, target_file_bytes)
        except Exception:  # noqa: BLE001 - find the failing one
            for chunk in group:
                try:
                    _rewrite(store, [chunk], before, target_file_bytes)
                except Exception as problem:  # noqa: BLE001 - noted, the rest goes on
                    errors[chunk] = str(problem)
        after = _chunk_bytes(store, group)
        entries = [(c, before.get(c), after.get(c), errors.get(c), now) for c in group]
        spark.createDataFrame(entries, COMPACTION_LEDGER).coalesce(1).write.mode("append").parquet(
            ledger_path
        )
        count += len(group) - len(errors)
    return count


def _rewrite(
    store: MeasurementStore, chunks: list[date], sizes: dict[date, int], target: int
) -> None:
    parts = max(1, sum(sizes.get(chunk, 0) for chunk in chunks) // target) + len(chunks) - 1
    order = [store.column, "sampling_point_id", F.desc("time"), "pollutant_code"]
    (
        read_dates(store.spark, store.path, store.schema, chunks, store.column)
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(store.column)
        .parquet(store.path)
    )


def compaction_status(files: DataFrame, ledger: DataFrame, enabled: bool = True) -> DataFrame:
    """One row: partitions in all, compacted and not. ``files`` as from ``chunk_files``.

    A chunk whose size differs from the ledger's was written to since and is not compacted.
    """
    chunks = files.groupBy("chunk").agg(F.sum("length").alias("bytes"))
    done = compacted(ledger).select(
        "chunk", F.col("after_bytes").alias("bytes"), F.lit(True).alias("done")
    )
    return chunks.join(done, ["chunk", "bytes"], "left").agg(
        F.count("*").alias("total_partitions"),
        F.count_if(F.col("done")).alias("compacted_partitions"),
        F.count_if(F.col("done").isNull()).alias("uncompacted_partitions"),
        F.lit(enabled).alias("compaction_enabled"),
    )


def storage_report(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row on table size and what compaction saved.

    Without compacted chunks both sizes are the table's and the ratio is 1.
    """
    table = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("table_bytes"))
    saved = compacted(ledger).agg(
        F.coalesce(F.sum("before_bytes"), F.lit(0)).alias("before"),
        F.coalesce(F.sum("after_bytes"), F.lit(0)).alias("after"),
    )
    have = (F.col("before") > 0) & (F.col("after") > 0)
    sizes = table.crossJoin(saved).select(  # one row each
        "table_bytes",
        F.when(have, F.col("before")).otherwise(F.col("table_bytes")).alias("uncompacted_bytes"),
        F.when(have, F.col("after")).otherwise(F.col("table_bytes")).alias("compacted_bytes"),
        F.when(have, F.col("before") / F.col("after")).otherwise(F.lit(1.0)).alias("ratio"),
    )
    gain = F.col("uncompacted_bytes") - F.col("compacted_bytes")
    return sizes.select(
        "table_bytes",
        format_bytes(F.col("table_bytes")).alias("table_size"),
        (F.col("ratio") > 1.0).alias("compaction_effective"),
        format_bytes(F.col("uncompacted_bytes")).alias("uncompacted_size"),
        format_bytes(F.col("compacted_bytes")).alias("compacted_size"),
        F.round("ratio", 2).alias("compression_ratio"),
        format_bytes(gain).alias("space_saved"),
        F.when(
            F.col("uncompacted_bytes") > 0,
            F.round(gain / F.col("uncompacted_bytes") * 100.0, 2),
        )
        .otherwise(F.lit(0.0))
        .alias("space_saved_percentage"),
    )
