"""Cleaning and parsing of dirty text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes in ASCII text.
_BLANKS = " \t\n\r\x0b\x0c"
_NUMBER = r"(?i)^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"
_EXTRACT_DATE = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$"
_UNITS = ["B", "KB", "MB", "GB", "TB"]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def blank_to_null(text: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def sentinel_float(text: Column) -> Column:
    """Text to double; blank, the exact texts ``-999`` / ``-999.0`` and bad numbers give NULL.

    The pattern keeps out spellings that a cast would take but a plain number parser
    refuses, such as ``1.5d``; digit separators (``1_000``) and ``nan`` give NULL too.
    """
    bare = strip(text)
    return F.when(
        ~text.isin("-999", "-999.0") & bare.rlike(_NUMBER), bare.try_cast("double")
    )


def extract_date(text: Column) -> Column:
    """``DD/MM/YYYY HH:MM:SS`` (parts may be unpadded) to timestamp, anything else NULL."""
    return F.when(
        text.rlike(_EXTRACT_DATE), F.try_to_timestamp(text, F.lit("d/M/yyyy H:m:s"))
    )


def iso_date(text: Column) -> Column:
    """ISO date or date-time text to date, invalid gives NULL."""
    bare = strip(text)
    return F.coalesce(bare.try_cast("date"), F.to_date(F.try_to_timestamp(bare)))


def utc_time(column: Column, type_name: str) -> Column:
    """Any raw time column as a UTC instant.

    ``type_name`` is the column's Spark type: zone-less timestamps are taken as UTC (the
    session zone), zoned ones keep their instant, 64-bit integers are epoch nanoseconds
    (how Spark exposes nanosecond Parquet), unparsable text gives NULL.
    """
    if type_name == "bigint":
        micros = F.call_function("div", column - F.pmod(column, F.lit(1000)), F.lit(1000))
        return F.timestamp_micros(micros)
    if type_name == "string":
        return F.try_to_timestamp(strip(column))
    return column.cast("timestamp")


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def format_bytes(size: Column) -> Column:
    """``1536`` -> ``1.5 KB``; 1024 steps up to PB, one decimal, exact halves to even."""
    size = size.cast("double")
    text = None
    for step, unit in enumerate(_UNITS):
        shown = F.format_string(f"%.1f {unit}", F.bround(size / float(1024**step), 1))
        below = size < float(1024 ** (step + 1))
        text = F.when(below, shown) if text is None else text.when(below, shown)
    return text.otherwise(F.format_string("%.1f PB", F.bround(size / float(1024**5), 1)))
