"""Stored dimension tables: one Parquet folder each, replaced as a whole."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.times import instant, utc_now
from aerolake.operators.dimensions import merge_dimension, merge_pollutants
from aerolake.operators.keys import repeated_keys
from aerolake.plans.measurement_store import DuplicateKeyError, MissingKeyError
from aerolake.plans.tables import read_table, replace_table, staged
from aerolake.schemas import POLLUTANTS, SAMPLING_POINTS, STATIONS
from aerolake.sources.lookups import seed


class DimensionTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.key = key

    def read(self) -> DataFrame:
        return read_table(self.spark, self.path, self.schema)

    def upsert(
        self,
        batch: DataFrame,
        now: datetime,
        order: list[str] | None = None,
        null_overwrites: bool = True,
    ) -> dict[str, int]:
        """Create or update; returns how many of each.

        Without an ``order`` that says which row is last, repeated keys are refused.
        """
        keyless = batch.filter(F.col(self.key).isNull()).count()
        if keyless:
            raise MissingKeyError(f"{keyless} rows lack {self.key}")
        if not order and not repeated_keys(batch, [self.key]).isEmpty():
            raise DuplicateKeyError(f"{self.key} repeats in the batch, and no order is given")
        if self.schema is POLLUTANTS:
            merged = merge_pollutants(self.read(), batch, now)
        else:
            merged = merge_dimension(
                self.read(), batch, self.key, now, order, null_overwrites=null_overwrites
            )
        with staged(merged, "dimension") as fresh:
            counts = {r["change"]: r["count"] for r in fresh.groupBy("change").count().collect()}
            fresh.drop("change").write.mode("overwrite").parquet(self.path)
        return {name: counts.get(name, 0) for name in ("created", "updated")}

    def seed(self, rows: DataFrame, now: datetime | None = None) -> None:
        """Add seed rows whose key is not there yet, created now."""
        table = seed(self.read(), rows, self.key)
        if "created_at" in self.schema.names:
            created = instant(now or utc_now())
            added = table.join(self.read().select(self.key), self.key, "left_anti")
            stamped = added.withColumn("created_at", F.coalesce("created_at", created))
            table = self.read().select(*table.columns).unionByName(stamped.select(*table.columns))
        replace_table(table.select(*self.schema.names), self.path)

    def delete(self, keys: DataFrame) -> int:
        """Delete rows by key; returns how many went."""
        table = self.read()
        gone = keys.select(self.key).distinct()
        deleted = table.join(gone, self.key, "left_semi").agg(F.count("*")).first()[0]
        if deleted:
            replace_table(table.join(gone, self.key, "left_anti").select(*self.schema.names), self.path)
        return deleted


def stations_table(spark: SparkSession, path: str) -> DimensionTable:
    return DimensionTable(spark, path, STATIONS, "station_code")


def sampling_points_table(spark: SparkSession, path: str) -> DimensionTable:
    return DimensionTable(spark, path, SAMPLING_POINTS, "sampling_point_id")


def pollutants_table(spark: SparkSession, path: str) -> DimensionTable:
    return DimensionTable(spark, path, POLLUTANTS, "pollutant_code")
