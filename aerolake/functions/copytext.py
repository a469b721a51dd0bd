"""The tab-separated bulk-load text form of a measurement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NULL = "\\N"


def _digits(value: Column, scale: int) -> Column:
    """Positional digits, keeping one decimal: ``12000000.50`` -> ``12000000.5``."""
    text = value.cast(f"decimal(38,{scale})").cast("string")
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")


def _number(value: Column) -> Column:
    """Shortest text of a double: positional from 1e-4 up to 1e16, else ``1.5e+20``."""
    size = F.abs(value)
    text = value.cast("string")
    scientific = F.regexp_replace(text, r"(\.0)?E(\d)", "e+$2")
    scientific = F.regexp_replace(scientific, r"(\.0)?E-", "e-")
    scientific = F.regexp_replace(scientific, r"e-(\d)$", "e-0$1")
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.replace(F.lower(text), F.lit("infinity"), F.lit("inf")))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e-4) & (size < 1e-3), _digits(value, 21))
        .when((size >= 1e7) & (size < 1e16), _digits(value, 10))
        .otherwise(scientific)
    )


def copy_time(time: Column) -> Column:
    """The text of a time: UTC with whole seconds; parts of a second are cut off."""
    return F.concat(F.date_format(time, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))


def _text(text: Column) -> Column:
    """Escape what would otherwise end the field or the line."""
    for plain, escaped in [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def copy_line() -> Column:
    """One line over the measurement columns, ``\\N`` for NULL."""
    fields = [
        copy_time(F.col("time")),
        _text(F.col("sampling_point_id")),
        F.col("pollutant_code").cast("string"),
        _number(F.col("value")),
        _text(F.col("unit")),
        _text(F.col("aggregation_type")),
        F.col("validity").cast("string"),
        F.col("verification").cast("string"),
        _number(F.col("data_capture")),
        copy_time(F.col("result_time")),
        _text(F.col("observation_id")),
    ]
    return F.concat_ws("\t", *[F.coalesce(field, F.lit(_NULL)) for field in fields])
