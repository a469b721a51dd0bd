"""Raw measurement frames to the warehouse schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.clean import nan_to_null, utc_time
from aerolake.schemas import MEASUREMENT_NAMES, MEASUREMENTS, RAW_NAMES

REQUIRED = ["time", "sampling_point_id", "pollutant_code"]


def raw_name(raw: DataFrame, target: str) -> str | None:
    """The raw column behind a warehouse column: the first accepted name that is present.

    Compared case by case on purpose; ``SamplingPoint`` and ``Samplingpoint`` belong to
    different generations.
    """
    present = set(raw.columns)
    return next((name for name in RAW_NAMES[target] if name in present), None)


def harmonise_columns(raw: DataFrame) -> DataFrame:
    """Keep the known columns under their warehouse names, values untouched."""
    chosen = {target: raw_name(raw, target) for target in RAW_NAMES}
    return raw.select(*[F.col(f"`{name}`").alias(target) for target, name in chosen.items() if name])


def has_required_columns(raw: DataFrame) -> bool:
    return all(raw_name(raw, target) for target in REQUIRED)


def require_not_null(frame: DataFrame) -> DataFrame:
    return frame.dropna(subset=REQUIRED)


def empty_measurements(spark: SparkSession, keep: list[str] | None = None) -> DataFrame:
    extra = {"file_path": "string", "row_index": "bigint"}
    return spark.createDataFrame([], MEASUREMENTS).select(
        "*", *[F.lit(None).cast(extra[name]).alias(name) for name in keep or []]
    )


def _typed(raw: DataFrame, target: str, type_name: str) -> Column:
    name = raw_name(raw, target)
    if name is None:
        return F.lit(None).cast(type_name)
    column, raw_type = F.col(f"`{name}`"), dict(raw.dtypes)[name]
    if type_name == "timestamp":
        return utc_time(column, raw_type)
    if type_name == "double":
        return nan_to_null(column.try_cast("double"))
    if type_name == "int" and raw_type == "string":
        return column.try_cast("double").try_cast("int")
    return column.try_cast(type_name)


def _measurement_types() -> dict[str, str]:
    return {
        field.name: field.dataType.simpleString()
        for field in MEASUREMENTS.fields
        if field.name in MEASUREMENT_NAMES
    }


def cast_measurements(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed measurements of a raw frame.

    Rows without a time, sampling point or pollutant are dropped (``count_losses`` counts
    them); without one of those columns the result is empty. Absent optional columns become
    NULL, and so do NaN and values that do not fit the type. ``keep`` carries further columns
    through.
    """
    keep = keep or []
    if not has_required_columns(raw):
        return empty_measurements(raw.sparkSession, keep)
    columns = [_typed(raw, n, kind).alias(n) for n, kind in _measurement_types().items()]
    return require_not_null(raw.select(*columns, *keep))


def count_losses(raw: DataFrame) -> DataFrame:
    """For each ``file_path`` what a load would lose: one row of counts.

    ``read`` rows; ``dropped`` ones lack a required value; ``unreadable`` ones have a required
    value that its type cannot hold. Every column is read, so that damaged pages show.
    """
    types = _measurement_types()
    lost, bad = F.lit(False), F.lit(False)
    for target in REQUIRED:
        name = raw_name(raw, target)
        typed = _typed(raw, target, types[target])
        if name is None:
            lost = F.lit(True)
            continue
        column = F.col(f"`{name}`")
        given = column.isNotNull()
        if dict(raw.dtypes)[name] == "string":
            given = given & (F.trim(column) != "")
        elif dict(raw.dtypes)[name] == "double":
            given = given & ~F.isnan(column)
        lost = lost | ~given
        bad = bad | (given & typed.isNull())
    values = [F.col(f"`{name}`") for name in raw.columns]
    return raw.groupBy("file_path").agg(
        F.count("*").alias("read"),
        F.count_if(lost & ~bad).alias("dropped"),
        F.count_if(bad).alias("unreadable"),
        F.max(F.xxhash64(*values)).alias("touched"),
    )
