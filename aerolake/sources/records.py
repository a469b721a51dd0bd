"""CSV records of split files, where a quoted value may hold line breaks.

Whether a line starts inside quotes depends on all lines before it, but each line is only one of
four functions of that state: keep it, swap it, or end inside or outside whatever it was. Functions
chain, so the lines of a split are chained within the split and the splits of a file over a table of
one row each, as row numbers are. Complete lines never move; only the lines of broken records are
brought together. A file with breaks is split like any other, and rows keep their numbers.

A quote opens a value only at its start, is doubled inside one, and is an ordinary character
elsewhere.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.plans.tables import stage
from aerolake.sources.order import with_file_order

# A quoted run up to where its quote could close, and whole fields of which the last stays open.
_INSIDE = '[^"]*+(?:""[^"]*+)*+'
_ENDS_OPEN = f'^(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+"{_INSIDE}$'
_SPLIT = ["_file", "_block"]


def _ends_open(line: Column, starts_open: bool) -> Column:
    """Does a line end inside quotes?"""
    if not starts_open:
        return line.rlike(_ENDS_OPEN)
    rest = F.regexp_replace(line, f'^{_INSIDE}"[^,]*+', "")
    return line.rlike(f"^{_INSIDE}$") | (rest.startswith(",") & F.substring(rest, 2, 2**31 - 1).rlike(_ENDS_OPEN))


def _chained(rows: DataFrame, per: list[str], order: list[str]) -> DataFrame:
    """Add ``_open_out`` and ``_open_in``: the state before a row, by that at the start of ``per``.

    The last row that forgets the state (``_out`` equals ``_in``) decides, and the swaps since.
    """
    before = Window.partitionBy(*per).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out, inside = F.col("_out"), F.col("_in")
    swaps = F.coalesce(F.sum((out & ~inside).cast("int")).over(before), F.lit(0))
    forgets = F.when(out == inside, F.struct(out.alias("state"), F.col("_swaps").alias("swaps")))
    counted = rows.withColumn("_swaps", swaps)
    counted = counted.withColumn("_known", F.last(forgets, ignorenulls=True).over(before))

    def state(start: bool) -> Column:
        value = F.coalesce(F.col("_known.state"), F.lit(start))
        since = F.col("_swaps") - F.coalesce(F.col("_known.swaps"), F.lit(0))
        return value != (since % 2 == 1)

    return counted.withColumns({"_open_out": state(False), "_open_in": state(True)}).drop("_swaps", "_known")


def _after(out: Column, inside: Column, state: Column) -> Column:
    return F.when(state, inside).otherwise(out)


def _numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines with ``_start`` (do they begin a record?), ``_whole`` (are they all of it?) and ``record``."""
    value = F.col("value")
    functions = lines.withColumns({"_out": _ends_open(value, False), "_in": _ends_open(value, True)})
    # as many tasks as the scan has: lines are short, but parsing them is the work
    dealt = functions.repartition(max(lines.rdd.getNumPartitions(), 1), *_SPLIT)
    rows = _chained(dealt, _SPLIT, ["_seq"])
    filled = F.trim(value) != ""
    upto = Window.partitionBy(*_SPLIT).orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    for name in ("out", "in"):
        starts = (~F.col(f"_open_{name}") & filled).cast("bigint")
        rows = rows.withColumn(f"_count_{name}", F.sum(starts).over(upto))
    # one row for each split: what it does to the state, and how many records start in it
    last = F.max_by(F.struct("_out", "_in", "_open_out", "_open_in"), "_seq")
    splits = rows.groupBy(*_SPLIT).agg(
        last.alias("last"), F.max("_count_out").alias("_count_out"), F.max("_count_in").alias("_count_in")
    )
    splits = splits.select(
        *_SPLIT,
        *(
            _after(F.col("last._out"), F.col("last._in"), F.col(f"last._open_{name}")).alias(f"_{name}")
            for name in ("out", "in")
        ),
        "_count_out",
        "_count_in",
    )
    splits = _chained(splits, ["_file"], ["_block"]).withColumn("_open", F.col("_open_out"))
    splits = splits.withColumn("_records", _after(F.col("_count_out"), F.col("_count_in"), F.col("_open")))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = stage(
        splits.select(
            *_SPLIT,
            F.col("_open").alias("_from"),
            F.coalesce(F.sum("_records").over(earlier), F.lit(0)).alias("_earlier"),
            _after(F.col("_out"), F.col("_in"), F.col("_open")).alias("_to"),
        ),
        "csv-splits",
    )
    ends = splits.groupBy("_file").agg(F.max_by("_to", "_block").alias("open")).filter("open")
    unclosed = [row["_file"] for row in ends.limit(5).collect()]
    if unclosed:
        raise ValueError(f"a quote is left open at the end of {', '.join(unclosed)}")
    placed = rows.join(splits.drop("_to"), _SPLIT)
    opened = _after(F.col("_open_out"), F.col("_open_in"), F.col("_from"))
    count = _after(F.col("_count_out"), F.col("_count_in"), F.col("_from"))
    start = ~opened & filled
    return placed.filter(opened | filled).select(
        *_SPLIT,
        "_seq",
        "value",
        (F.col("_earlier") + count - 1).alias("record"),
        (start & ~F.col("_out")).alias("_whole"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``_file, record, text`` of the records of CSV files, numbered from 0 in each file.

    Blank lines between records are no records. Breaks inside a record read as one line feed each.
    """
    lines = _numbered_lines(with_file_order(spark.read.text(path)))
    whole = lines.filter("_whole").select("_file", "record", F.col("value").alias("text"))
    parts = F.sort_array(F.collect_list(F.struct("_block", "_seq", "value")))
    broken = lines.filter("NOT _whole").groupBy("_file", "record").agg(F.array_join(parts["value"], "\n").alias("text"))
    return whole.unionByName(broken)


def read_csv_text(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Rows of CSV files (``_file``, ``record`` from 1, and text columns c0, c1, ...), and the header.

    Values are as they stand: an empty one is empty text, a missing one NULL. A file with another
    header than the first is an error. The records are stored once, as their readers come back often.
    """
    records = stage(read_records(spark, path), "csv-records")
    headers = records.filter("record = 0")
    first = headers.orderBy("_file").first()
    if first is None:
        raise ValueError(f"{path} has no header")
    names = next(csv.reader(io.StringIO(first["text"], newline="")))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"escape": '"', "nullValue": "\x01", "emptyValue": "", "mode": "PERMISSIVE"}
    row = F.from_csv("text", F.lit(schema), options)
    have = F.transform(
        F.array(*[F.col(f"row.c{i}") for i in range(len(names))]), lambda name: F.coalesce(name, F.lit(""))
    )
    others = headers.select("_file", row.alias("row")).filter(have != F.array(*map(F.lit, names)))
    if wrong := [r["_file"] for r in others.select("_file").limit(5).collect()]:
        raise ValueError(f"another header in {', '.join(wrong)}")
    rows = records.filter("record > 0").select("_file", "record", row.alias("row"))
    return rows.select("_file", "record", "row.*"), names
