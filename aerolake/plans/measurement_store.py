"""The stored fact table: Parquet, partitioned by spans of UTC days, unique by time and
sampling point.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.copytext import copy_line
from aerolake.functions.times import as_utc, instant
from aerolake.operators.keys import insert_conflicts
from aerolake.operators.slices import (
    in_period,
    late_rows,
    latest_by_sampling_point,
    latest_of,
    latest_overall,
)
from aerolake.plans.tables import (
    check_partition_column,
    drop_dates,
    partition_dates,
    read_dates,
    read_table,
    stage,
    staged,
    write_dates,
)
from aerolake.schemas import MEASUREMENT_KEY, MEASUREMENTS

_ORIGIN = date(1970, 1, 5)  # chunks are counted from this Monday


class DuplicateKeyError(ValueError):
    """A key repeats in a batch or is there already."""


class UnknownReferenceError(ValueError):
    """Rows name parents that are not there."""


class MissingKeyError(ValueError):
    """A measurement lacks its time, sampling point or pollutant."""


def _has_holes() -> Column:
    required = [*MEASUREMENT_KEY, "pollutant_code"]
    return reduce(Column.__or__, [F.col(name).isNull() for name in required])


def normalise_copy_flags(batch: DataFrame) -> DataFrame:
    """What the bulk-load text does to a batch.

    Flags fall back to their older names, 0 and empty ids become NULL.
    """

    def flag(name: str, older: str) -> Column:
        value = F.nullif(F.col(name), F.lit(0)) if name in batch.columns else F.lit(None)
        if older in batch.columns:
            value = F.coalesce(value, F.nullif(F.col(older), F.lit(0)))
        return value.cast("int").alias(name)

    changed = {
        "validity": flag("validity", "validity_flag_id"),
        "verification": flag("verification", "verification_status_id"),
    }
    if "observation_id" in batch.columns:
        changed["observation_id"] = F.nullif(F.col("observation_id"), F.lit(""))
    return conform(batch.withColumns(changed))


def conform(batch: DataFrame) -> DataFrame:
    """Warehouse columns and types in table order; absent optional columns are NULL."""
    return batch.select(
        *[
            (F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MEASUREMENTS.fields
        ]
    )


def copy_text(batch: DataFrame) -> DataFrame:
    """The bulk-load text of a batch, one column ``line``."""
    return normalise_copy_flags(batch).select(copy_line().alias("line"))


class MeasurementStore:
    """Inserts, upserts and deletes on one table path.

    A partition ("chunk") holds ``chunk_days`` days: one by default, which suits large tables,
    since a chunk is what an upsert or delete rewrites; more for sparse ones. The partition
    column carries the number in its name, so a table cannot be opened with another one. One
    writer at a time; readers keep seeing the old files of a chunk until a write commits.
    """

    def __init__(self, spark: SparkSession, path: str, chunk_days: int = 1):
        self.spark = spark
        self.path = path
        self.chunk_days = chunk_days
        self.column = f"chunk_{chunk_days}d"
        self.schema = T.StructType(MEASUREMENTS.fields + [T.StructField(self.column, T.DateType())])
        check_partition_column(spark, path, self.column)

    def chunk_of(self, day: date) -> date:
        """First day of the chunk that holds a day."""
        return day - timedelta(days=(day - _ORIGIN).days % self.chunk_days)

    def _with_chunk(self, rows: DataFrame) -> DataFrame:
        day = F.to_date("time")
        past = F.pmod(F.datediff(day, F.lit(_ORIGIN)), F.lit(self.chunk_days))
        return rows.withColumn(self.column, F.date_sub(day, past))

    def chunks(self) -> set[date]:
        return partition_dates(self.spark, self.path, self.column)

    def read(self) -> DataFrame:
        """All rows, with the partition column."""
        return read_table(self.spark, self.path, self.schema)

    def _read_chunks(self, chunks: set[date]) -> DataFrame:
        return read_dates(self.spark, self.path, self.schema, chunks & self.chunks(), self.column)

    def read_days(self, days: set[date]) -> DataFrame:
        """The chunks that hold these days, without listing the rest of the table."""
        return self._read_chunks({self.chunk_of(day) for day in days})

    def between(self, start: datetime | None, end: datetime | None) -> DataFrame:
        """Rows with ``start <= time < end``; only the chunks of that span are listed."""
        first = self.chunk_of(as_utc(start).date()) if start else date.min
        last = (as_utc(end) - timedelta(microseconds=1)).date() if end else date.max
        chunks = {chunk for chunk in self.chunks() if first <= chunk <= last}
        return in_period(self._read_chunks(chunks), start, end)

    def _newest(self, wanted: Callable[[DataFrame], DataFrame], limit: int) -> DataFrame:
        """The fewest newest chunks that hold ``limit`` wanted rows, or all.

        Looks at one chunk, then at two, four and so on, so that a full table costs little and
        a sparse one few rounds.
        """
        chunks = sorted(self.chunks(), reverse=True)
        size = 1
        while size < len(chunks):
            rows = wanted(self._read_chunks(set(chunks[:size])))
            if rows.limit(limit).count() == limit:
                return rows
            size *= 2
        return wanted(self._read_chunks(set(chunks)))

    def latest(self, limit: int = 10) -> DataFrame:
        """Newest rows of the table, reading only the newest chunks."""
        return latest_overall(self._newest(lambda rows: rows, limit), limit)

    def latest_of(self, sampling_point_id: str, limit: int = 100) -> DataFrame:
        """Newest rows of one sampling point, reading only as many chunks as they lie in."""
        own = F.col("sampling_point_id") == F.lit(sampling_point_id)
        return latest_of(self._newest(lambda rows: rows.filter(own), limit), sampling_point_id, limit)

    def latest_by_sampling_point(self, points: DataFrame, limit: int = 100) -> DataFrame:
        """Newest ``limit`` rows of every sampling point of ``points``, newest chunks first.

        Chunks are walked in rounds of one, two, four and so on. A round reads rows of the points
        that are still short, keeps their newest, and those that have enough leave the walk, which
        ends when none is short. So points that report daily cost a few chunks, and only a point
        with fewer rows than ``limit`` leads back to the first chunk.
        """
        if limit < 1:
            return self._read_chunks(set())
        chunks = sorted(self.chunks(), reverse=True)
        short = stage(
            points.select("sampling_point_id", F.lit(0).cast("bigint").alias("held")).distinct(), "short-points"
        )
        found: list[DataFrame] = []
        start, size = 0, 1
        while start < len(chunks) and not short.isEmpty():
            rows = self._read_chunks(set(chunks[start : start + size]))
            wanted = rows.join(short.select("sampling_point_id"), "sampling_point_id", "left_semi")
            found.append(stage(latest_by_sampling_point(wanted, limit), "newest-rows"))
            new = found[-1].groupBy("sampling_point_id").agg(F.count("*").alias("new"))
            held = (F.col("held") + F.coalesce("new", F.lit(0))).alias("held")
            counted = short.join(new, "sampling_point_id", "left").select("sampling_point_id", held)
            short = stage(counted.filter(F.col("held") < limit), "short-points")
            start, size = start + size, 2 * size
        every = reduce(DataFrame.unionByName, found, self._read_chunks(set()))
        # a later round may have found more than a point lacked
        return latest_by_sampling_point(every, limit)

    def late_rows(self, now: datetime, start_offset_days: int = 30) -> DataFrame:
        """``slices.late_rows`` over the chunks before the horizon alone."""
        horizon = datetime.combine(
            (as_utc(now) - timedelta(days=start_offset_days)).date(), time.min, tzinfo=timezone.utc
        )
        return late_rows(self.between(None, horizon), now, start_offset_days)

    def _append(self, batch: DataFrame, **options: object) -> int:
        """Append after the key check; returns the number of rows."""
        rows = self._with_chunk(batch)
        # one pass over the batch: row count, repeats and touched chunks
        summary = (
            rows.groupBy(self.column, *MEASUREMENT_KEY)
            .agg(F.count("*").alias("copies"), F.count_if(_has_holes()).alias("holes"))
            .groupBy(F.col(self.column).alias("chunk"))
            .agg(
                F.sum("copies").alias("rows"),
                F.count_if(F.col("copies") > 1).alias("repeated"),
                F.sum("holes").alias("holes"),
            )
            .collect()  # one row for each chunk in the batch
        )
        self._check_holes(summary)
        if not summary:
            return 0
        touched = {row["chunk"] for row in summary} & self.chunks()
        if any(row["repeated"] for row in summary):
            self._refuse(insert_conflicts(batch, self._read_chunks(set()), MEASUREMENT_KEY))
        if touched:
            there = rows.filter(F.col(self.column).isin(sorted(touched)))
            self._refuse(insert_conflicts(there, self._read_chunks(touched), MEASUREMENT_KEY))
        write_dates(rows, self.path, "append", self.column, **options)
        return sum(row["rows"] for row in summary)

    @staticmethod
    def _check_holes(summary: list[Row]) -> None:
        holes = sum(row["holes"] for row in summary)
        if holes:
            raise MissingKeyError(f"{holes} rows lack a time, sampling point or pollutant")

    @staticmethod
    def _refuse(conflicts: DataFrame) -> None:
        examples = conflicts.limit(5).collect()
        if examples:
            keys = ", ".join(f"{r['time']} {r['sampling_point_id']} ({r['reason']})" for r in examples)
            raise DuplicateKeyError(f"duplicate keys, for example: {keys}")

    def insert(
        self,
        batch: DataFrame,
        batch_size: int | None = None,
        references: dict[str, DataFrame] | None = None,
    ) -> int:
        """Append, refusing the whole batch if any key repeats. Returns rows written.

        ``batch_size`` limits the rows of one written file. ``references`` maps columns to
        frames that hold their parents in a column of that name; a batch with another value
        (NULL passes) is refused.
        """
        options = {"maxRecordsPerFile": batch_size} if batch_size else {}
        rows = conform(batch)
        check_references(rows, references)
        return self._append(rows, **options)

    def copy(
        self,
        batch: DataFrame,
        batch_size: int | None = None,
        references: dict[str, DataFrame] | None = None,
    ) -> int:
        """Append with the flag rules of the bulk-load text."""
        options = {"maxRecordsPerFile": batch_size} if batch_size else {}
        rows = normalise_copy_flags(batch)
        check_references(rows, references)
        return self._append(rows, **options)

    def upsert(
        self, batch: DataFrame, order: list[str], references: dict[str, DataFrame] | None = None
    ) -> int:
        """Insert or overwrite by key; of repeated keys the last in ``order`` wins.

        Returns the number of rows handed in. Only chunks that occur in the batch are rewritten.
        """
        check_references(batch, references)
        types = {f.name: f.dataType for f in MEASUREMENTS.fields}
        typed = batch.select(
            *[
                (F.col(n) if n in batch.columns else F.lit(None)).cast(t).alias(n)
                for n, t in types.items()
            ],
            *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)],
        ).withColumn("_copies", F.lit(1).cast("bigint"))
        places = [f"_order_{i}" for i in range(len(order))]
        with staged(self._with_chunk(keep_last_counted(typed, places)), "upsert") as fresh:
            summary = (
                fresh.groupBy(F.col(self.column).alias("chunk"))
                .agg(F.sum("_copies").alias("rows"), F.count_if(_has_holes()).alias("holes"))
                .collect()
            )
            self._check_holes(summary)
            latest = fresh.select(*self.schema.names)
            touched = {row["chunk"] for row in summary} & self.chunks()
            merged = latest
            if touched:
                keys = latest.select(*MEASUREMENT_KEY)
                kept = self._read_chunks(touched).join(keys, MEASUREMENT_KEY, "left_anti")
                merged = kept.unionByName(latest)
            if summary:
                write_dates(merged, self.path, "overwrite", self.column)
        return sum(row["rows"] for row in summary)

    def _delete(self, counts: DataFrame, kept_of: Callable[[DataFrame], DataFrame]) -> int:
        """Rewrite the chunks that lose rows and drop the chunks that lose all of them.

        ``counts`` has ``chunk, deleted, rows``: one row for each chunk.
        """
        affected = counts.filter("deleted > 0").collect()
        rewritten = {r["chunk"] for r in affected if r["deleted"] < r["rows"]}
        emptied = {r["chunk"] for r in affected if r["deleted"] == r["rows"]}
        if rewritten:
            kept = kept_of(self._read_chunks(rewritten))
            write_dates(kept, self.path, "overwrite", self.column)
        drop_dates(self.spark, self.path, emptied, self.column)
        return sum(r["deleted"] for r in affected)

    def delete_time_range(self, sampling_point_id: str, start: datetime, end: datetime) -> int:
        """Delete one sampling point's rows from ``start`` to ``end``, both included."""
        doomed = F.coalesce(
            (F.col("sampling_point_id") == F.lit(sampling_point_id))
            & F.col("time").between(instant(start), instant(end)),
            F.lit(False),
        )
        first, last = self.chunk_of(as_utc(start).date()), as_utc(end).date()
        chunks = {chunk for chunk in self.chunks() if first <= chunk <= last}
        counts = (
            self._read_chunks(chunks)
            .groupBy(F.col(self.column).alias("chunk"))
            .agg(F.count_if(doomed).alias("deleted"), F.count("*").alias("rows"))
        )
        return self._delete(counts, lambda rows: rows.filter(~doomed))

    def cascade_delete(self, deleted_points: DataFrame) -> int:
        """Delete the rows of sampling points that are gone. Returns rows deleted.

        Counting reads one column and reduces it to sampling points before the join.
        """
        ids = deleted_points.select("sampling_point_id").distinct()
        counts = (
            self.read()
            .groupBy(F.col(self.column).alias("chunk"), "sampling_point_id")
            .agg(F.count("*").alias("rows"))
            .join(ids.withColumn("gone", F.lit(True)), "sampling_point_id", "left")
            .groupBy("chunk")
            .agg(
                F.coalesce(F.sum(F.when(F.col("gone"), F.col("rows"))), F.lit(0)).alias("deleted"),
                F.sum("rows").alias("rows"),
            )
        )
        return self._delete(
            counts,
            lambda rows: rows.join(ids, "sampling_point_id", "left_anti"),
        )


def check_references(batch: DataFrame, references: dict[str, DataFrame] | None) -> None:
    """Raise if a column holds a value that its parent table lacks."""
    for column, parents in (references or {}).items():
        if column not in batch.columns:
            continue
        values = batch.select(column).filter(F.col(column).isNotNull()).distinct()
        unknown = values.join(parents.select(column), column, "left_anti").limit(5).collect()
        if unknown:
            names = ", ".join(str(row[0]) for row in unknown)
            raise UnknownReferenceError(f"{column} without a parent, for example: {names}")


def keep_last_counted(rows: DataFrame, order: list[str]) -> DataFrame:
    """Last row of each key, with ``_copies`` = how many rows it stands for.

    Keys are counted by hash first; only rows of repeated keys, mostly few, go on to be compared
    by order, which needs a sort. The others are not moved.
    """
    others = [c for c in rows.columns if c not in (*MEASUREMENT_KEY, "_copies")]
    repeated = (
        rows.groupBy(*MEASUREMENT_KEY).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    )
    single = rows.join(repeated, MEASUREMENT_KEY, "left_anti").drop(*order)
    last = (
        rows.join(repeated, MEASUREMENT_KEY, "left_semi")
        .groupBy(*MEASUREMENT_KEY)
        .agg(
            F.max_by(F.struct(*others), F.struct(*order)).alias("_row"),
            F.sum("_copies").alias("_copies"),
        )
        .select(*MEASUREMENT_KEY, "_row.*", "_copies")
        .drop(*order)
    )
    return single.unionByName(last)
