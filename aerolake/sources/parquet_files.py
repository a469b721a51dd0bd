"""Raw measurement files: listing, integrity, schema discovery and reading.

A raw file may use either of two column naming generations, its integer columns may be
stored as doubles, and its times may be nanoseconds, which Spark reads as 64-bit integers.
One scan can only have one schema, so files are first grouped by what their footers say and
each group is read with its own explicit schema.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from aerolake.operators.harmonise import cast_measurements, empty_measurements
from aerolake.schemas import RAW_NAMES
from aerolake.session import ship_package

_FOOTERS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("is_parquet", T.BooleanType()),
        T.StructField("rows", T.LongType()),
        T.StructField("columns", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
_KNOWN = {name for names in RAW_NAMES.values() for name in names}


def list_files(spark: SparkSession, *paths: str, pattern: str | None = None) -> DataFrame:
    """``path, length`` of the files; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(list(paths)).select("path", "length")


def _spark_type(field: pa.Field, physical: str | None) -> str | None:
    """Spark type that reads a Parquet column of this Arrow and physical type."""
    kind = field.type
    if pa.types.is_dictionary(kind):
        kind = kind.value_type
    if pa.types.is_timestamp(kind):
        if physical == "INT96":
            return "timestamp"
        if kind.unit == "ns":
            return "bigint"
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_boolean(kind):
        return "boolean"
    if pa.types.is_integer(kind) or pa.types.is_null(kind):  # a column without any value has no kind
        return "bigint"
    if pa.types.is_floating(kind):
        return "double"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    if pa.types.is_date(kind):
        return "date"
    return None


def _arrow_uri(path: str) -> str:
    """A path as Hadoop prints it (``file:/a b``, ``s3a://bucket/a b``) as a URI for Arrow."""
    scheme, rest = path.split(":", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if not rest.startswith("//"):
        return f"{scheme}://{quote(rest)}"
    authority, _, tail = rest[2:].partition("/")
    return f"{scheme}://{authority}/{quote(tail)}"


def _literal(path: str) -> str:
    """A path without glob meaning, for a reader that expands globs."""
    return re.sub(r"([\[\]{}*?\\,])", r"\\\1", path)


def plain_path(file_path: Column) -> Column:
    """``_metadata.file_path``, which is URL-encoded, in the form of a file listing."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last four bytes and the footer of each file; never the data pages."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        found = []
        for listed in batch.to_pylist():
            path, length = listed["path"], listed["length"]
            record = {**listed, "is_parquet": False}
            try:
                filesystem, inner = pafs.FileSystem.from_uri(_arrow_uri(path))
                opened = filesystem.open_input_file(inner)
                head = opened.read_at(4, 0)
                tail = opened.read_at(4, max(length - 4, 0))
            except FileNotFoundError:
                found.append({**record, "error": "the file is gone"})
                continue
            except Exception as problem:
                # the store, not the file: nothing may pass for a bad file because of it
                raise OSError(f"cannot open {path}: {problem}") from problem
            try:
                with opened as handle:
                    record["is_parquet"] = length >= 12 and head == b"PAR1" and tail == b"PAR1"
                    if not record["is_parquet"]:
                        raise ValueError("not a Parquet file")
                    handle.seek(0)
                    footer = pq.ParquetFile(handle)
                    record["rows"] = footer.metadata.num_rows
                    leaves = [footer.schema.column(i) for i in range(len(footer.schema))]
                    physical = {leaf.path: leaf.physical_type for leaf in leaves}
                    types = [
                        (f.name, _spark_type(f, physical.get(f.name))) for f in footer.schema_arrow
                    ]
                known = [t for t in types if t[0] in _KNOWN]
                record["columns"] = json.dumps([t for t in known if t[1]])
                if odd := [name for name, kind in known if not kind]:
                    kinds = ", ".join(f"{n} ({footer.schema_arrow.field(n).type})" for n in odd)
                    raise TypeError(f"columns of a kind that cannot be read: {kinds}")
            except Exception as problem:  # noqa: BLE001 - a bad file is a result here
                record["error"] = f"{type(problem).__name__}: {problem}"
            found.append(record)
        yield pa.RecordBatch.from_pylist(found, schema=to_arrow_schema(_FOOTERS))


def inspect_files(files: DataFrame) -> DataFrame:
    """Check magic bytes and read the schema of each listed file.

    ``files`` has ``path, length``. Adds ``is_parquet``, ``rows``, ``columns`` (JSON of the
    known raw columns with their Spark types) and ``error`` (NULL for a usable file). A known column
    of a kind that cannot be read is an error; columns of other names are not looked at.
    """
    ship_package(files.sparkSession)
    return files.select("path", "length").mapInArrow(_read_footers, _FOOTERS)


def file_integrity(files: DataFrame) -> DataFrame:
    return inspect_files(files).select("path", "length", "is_parquet")


def _schema(columns: list[list[str]]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in columns]
    )


def read_group(
    spark: SparkSession, columns: list[list[str]], paths: list[str], tolerant: bool = False
) -> DataFrame:
    """Files of one schema, with ``file_path`` and ``row_index`` for file order.

    A ``tolerant`` read goes on past damaged pages; the caller has to compare row counts.
    """
    names = [name for name, _ in columns]
    folded = [name.lower() for name in names]
    if len(set(folded)) < len(folded) and spark.conf.get("spark.sql.caseSensitive") != "true":
        raise ValueError(
            "files hold column names that differ only in case; "
            "set spark.sql.caseSensitive=true to read them"
        )
    return (
        spark.read.schema(_schema(columns))
        .option("ignoreCorruptFiles", str(tolerant).lower())
        .parquet(*[_literal(path) for path in paths])
        .select(
            "*",
            plain_path(F.col("_metadata.file_path")).alias("file_path"),
            F.col("_metadata.row_index").alias("row_index"),
        )
    )


def read_measurement_files(spark: SparkSession, *paths: str) -> list[DataFrame]:
    """Raw frames of all usable files, one frame for each distinct schema.

    What reaches the driver is the path list, which Spark's own file index holds as well.
    """
    return read_inspected(spark, inspect_files(list_files(spark, *paths)))


def read_inspected(
    spark: SparkSession, inspected: DataFrame, tolerant: bool = False
) -> list[DataFrame]:
    usable = inspected.filter("error is null").select("path", "columns").toPandas()
    return [
        read_group(spark, json.loads(columns), sorted(group["path"]), tolerant)
        for columns, group in usable.groupby("columns", sort=True)
    ]


def measurements_of(spark: SparkSession, raws: list[DataFrame]) -> DataFrame:
    """Typed measurements of several raw frames, keeping file and row order."""
    parsed = [cast_measurements(raw, keep=["file_path", "row_index"]) for raw in raws]
    if not parsed:
        return empty_measurements(spark, keep=["file_path", "row_index"])
    return reduce(DataFrame.unionByName, parsed)
