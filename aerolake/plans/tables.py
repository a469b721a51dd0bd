"""Small helpers around Parquet tables: staging, replacing, dropping partitions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aerolake.session import work_dir

# the folders staged by the open scopes of this thread, the innermost last
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("staging scopes", default=())


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop_path = _filesystem(spark, path)
    return filesystem.exists(hadoop_path)


def partition_dates(spark: SparkSession, path: str, column: str = "day") -> set[date]:
    """Dates that have a ``column=`` folder: a listing of one level, no data is read."""
    filesystem, hadoop_path = _filesystem(spark, path)
    if not filesystem.exists(hadoop_path):
        return set()
    names = [status.getPath().getName() for status in filesystem.listStatus(hadoop_path)]
    values = [name.split("=", 1)[1] for name in names if name.startswith(f"{column}=")]
    return {date.fromisoformat(value) for value in values if value[:1].isdigit()}


def check_partition_column(spark: SparkSession, path: str, column: str) -> None:
    """Refuse to open a table that is partitioned by another column."""
    filesystem, hadoop_path = _filesystem(spark, path)
    if filesystem.exists(hadoop_path):
        names = [status.getPath().getName() for status in filesystem.listStatus(hadoop_path)]
        others = {n.split("=", 1)[0] for n in names if "=" in n} - {column}
        if others:
            raise ValueError(f"{path} is partitioned by {sorted(others)}, not by {column}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    filesystem, hadoop_path = _filesystem(spark, path)
    if not filesystem.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(hadoop_path)]


def make_folder(spark: SparkSession, path: str) -> None:
    filesystem, hadoop_path = _filesystem(spark, path)
    filesystem.mkdirs(hadoop_path)


def drop_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders of a table, in the order given."""
    for path in paths:
        filesystem, hadoop_path = _filesystem(spark, path)
        filesystem.delete(hadoop_path, True)


def drop_dates(
    spark: SparkSession, path: str, dates: Iterable[date], column: str = "day"
) -> None:
    """Remove whole partitions. Dynamic overwrite never does, as it only sees new rows."""
    filesystem, _ = _filesystem(spark, path)
    for value in sorted(dates):
        folder = f"{path}/{column}={value.isoformat()}"
        filesystem.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)


def delete_file(spark: SparkSession, path: str) -> bool:
    """Delete one file; False if that did not work."""
    filesystem, hadoop_path = _filesystem(spark, path)
    try:
        return filesystem.delete(hadoop_path, False)
    except Py4JJavaError:
        return False


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or an empty frame of its schema before the first write."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_dates(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    dates: Iterable[date],
    column: str = "day",
) -> DataFrame:
    """Some partitions of a table; only their folders are listed.

    ``schema`` is that of the table, with or without the partition column.
    """
    fields = [f for f in schema.fields if f.name != column]
    full = T.StructType(fields).add(column, T.DateType())
    folders = [f"{path}/{column}={value.isoformat()}" for value in sorted(dates)]
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*folders)


def _write_aside(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def stage(frame: DataFrame, label: str, kept: bool = False) -> DataFrame:
    """Write to the shared working folder and read back.

    Cuts lineage with a table that survives lost executors, and makes sure that whatever is
    derived next sees one fixed result. Inside ``staging`` the copy goes with the block; a
    ``kept`` one outlives that block and belongs to the one around it, if there is one.
    """
    path = work_dir(frame.sparkSession, label)
    owners = _scopes.get()[:-1] if kept else _scopes.get()
    if owners:
        owners[-1].append(path)
    return _write_aside(frame, path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Owns what ``stage`` writes inside the block: the copies are deleted at its end.

    Frames that read them must have been written or counted by then. Also after a failure.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        drop_folders(spark, paths)


@contextmanager
def staged(frame: DataFrame, label: str, precious: bool = False) -> Iterator[DataFrame]:
    """``stage`` for the length of a block.

    After a failure the copy goes with the ``staging`` block around it; without one, or if it is
    ``precious``, it is kept.
    """
    spark = frame.sparkSession
    path = work_dir(spark, label)
    if _scopes.get() and not precious:
        _scopes.get()[-1].append(path)
    yield _write_aside(frame, path)
    filesystem, hadoop_path = _filesystem(spark, path)
    filesystem.delete(hadoop_path, True)


def replace_table(frame: DataFrame, path: str) -> None:
    """Overwrite an unpartitioned table with a frame that may read the table itself.

    The staged copy is complete before the old files go, so a failure never loses both.
    """
    with staged(frame, "replace", precious=True) as copy:
        copy.write.mode("overwrite").parquet(path)


def write_parts(frame: DataFrame, path: str, columns: list[str]) -> None:
    """Replace the partitions that ``frame`` has rows of, and leave all others as they are."""
    (
        frame.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_dates(
    frame: DataFrame, path: str, mode: str, column: str = "day", **options: object
) -> None:
    """Write rows into their ``column=`` partitions.

    The rebalance brings the rows of a partition together for few files, and AQE splits one
    that is too large for a task. ``overwrite`` replaces only the partitions that have rows,
    and does so at job commit: until then the old files stay readable, also by this very job.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(mode)
    wanted = [column, "sampling_point_id", "station_code", "time"]
    (
        frame.hint("rebalance", column)
        .sortWithinPartitions(*[name for name in wanted if name in frame.columns])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(column)
        .parquet(path)
    )
