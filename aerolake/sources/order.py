"""Row order of line-oriented files, without a global sort or a single task.

Spark keeps the order inside one file split, and a split knows its file and offset. So a
row's place in its file is (rows in the earlier splits of that file) + (place in its split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILE_ORDER = ["_file", "_block", "_seq"]


def with_file_order(rows: DataFrame) -> DataFrame:
    """Add the sortable triple (file, split offset, place in the task) to a file scan."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    )


def number_rows(
    rows: DataFrame,
    bucket: list[str],
    order: list[str],
    name: str = "position",
    per: list[str] | None = None,
) -> DataFrame:
    """Number rows from 0 in the order (``bucket``, ``order``), in parallel.

    ``bucket`` must be a deterministic coarse key that sorts before ``order``, such as file
    and split offset, with a bounded number of rows for each value. Only the table of bucket
    sizes, one small row for each bucket, is summed in one place. ``per`` (leading columns of
    ``bucket``) restarts the numbers.
    """
    per = per or []
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("_rows"))
    scope = Window.partitionBy(*per) if per else Window
    earlier = scope.orderBy(*[c for c in bucket if c not in per]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        *bucket, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy(*bucket).orderBy(*order)) - 1
    return (
        rows.withColumn("_place", place)
        .join(starts, bucket)
        .withColumn(name, (F.col("_start") + F.col("_place")).cast("bigint"))
        .drop("_start", "_place")
    )
