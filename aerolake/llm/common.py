"""What several training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import ship_package

# Words of a text are runs without ASCII white space.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of one of the given tables."""
    frame = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def words_of(text) -> F.Column:
    """Array of the words of a text column; empty for null."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.filter(parts, lambda word: word != "")


def in_batches(
    frame: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with the package sent to the executors first."""
    ship_package(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def batch_of(columns: dict[str, tuple[object, pa.DataType]]) -> pa.RecordBatch:
    """A record batch from name: (values, type)."""
    arrays = [
        values if isinstance(values, pa.Array) else pa.array(values, kind)
        for values, kind in columns.values()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
