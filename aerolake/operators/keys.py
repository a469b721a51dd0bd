"""Keep-first, keep-last and duplicate checks by key.

All of them are plain aggregates, so map tasks combine the copies of a key before the
shuffle. A key that holds a large share of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(rows: DataFrame, key: list[str], order: list[str], pick) -> DataFrame:
    others = [name for name in rows.columns if name not in key]
    place: Column = F.struct(*order) if len(order) > 1 else F.col(order[0])
    chosen = rows.groupBy(*key).agg(pick(F.struct(*others), place).alias("_row"))
    return chosen.select(*key, "_row.*").select(*rows.columns)


def keep_first(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` for each key."""
    return _pick(rows, key, order, F.min_by)


def keep_last(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` for each key."""
    return _pick(rows, key, order, F.max_by)


def key_counts(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("copies"))


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return key_counts(rows, key).filter("copies > 1")


def insert_conflicts(batch: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Keys that a plain insert of ``batch`` would violate.

    ``reason`` is ``repeated`` for keys that occur more than once in the batch and
    ``exists`` for keys the target has already; a key can be reported for both.
    """
    counts = key_counts(batch, key)
    repeated = counts.filter("copies > 1").select(*key, F.lit("repeated").alias("reason"))
    exists = counts.join(target.select(*key), key, "left_semi").select(
        *key, F.lit("exists").alias("reason")
    )
    return repeated.unionByName(exists)


def merge_latest(
    target: DataFrame, batch: DataFrame, key: list[str], order: list[str]
) -> DataFrame:
    """``target`` after an upsert of ``batch``; in a repeated key the last row wins.

    All non-key columns are overwritten, also by NULL.
    """
    latest = keep_last(batch, key, order).select(*target.columns)
    return target.join(latest.select(*key), key, "left_anti").unionByName(latest)
