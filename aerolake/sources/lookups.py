"""Seeded lookup tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from aerolake import schemas

# The seed rows of the four lookup tables.
COUNTRY_SEED = [
    ("IT", "Italy", "Southern Europe"),
    ("PT", "Portugal", "Southern Europe"),
    ("ES", "Spain", "Southern Europe"),
]
POLLUTANT_SEED = [
    (1, "PM10", "Particulate matter < 10 µm", "µg/m³"),
    (5, "PM2.5", "Particulate matter < 2.5 µm", "µg/m³"),
    (6, "NO2", "Nitrogen dioxide (air)", "µg/m³"),
    (7, "O3", "Ozone", "µg/m³"),
    (8, "NO2", "Nitrogen dioxide", "µg/m³"),
    (9, "NOx", "Nitrogen oxides", "µg/m³"),
    (10, "CO", "Carbon monoxide", "mg/m³"),
    (14, "SO2", "Sulphur dioxide", "µg/m³"),
    (20, "C6H6", "Benzene", "µg/m³"),
    (21, "Cd", "Cadmium", "ng/m³"),
    (38, "NO", "Nitrogen monoxide", "µg/m³"),
    (46, "PM1", "Particulate matter < 1 µm", "µg/m³"),
    (47, "BC", "Black Carbon", "µg/m³"),
    (48, "UFP", "Ultrafine particles", "#/cm³"),
    (49, "PN", "Particle number", "#/cm³"),
    (59, "BaP", "Benzo(a)pyrene", "ng/m³"),
    (5012, "Ni", "Nickel", "ng/m³"),
    (5014, "As", "Arsenic", "ng/m³"),
    (5015, "Pb", "Lead", "µg/m³"),
    (5029, "BaP", "Benzo(a)pyrene (PM10)", "ng/m³"),
    (6001, "PM2.5", "Particulate matter < 2.5 µm (legacy)", "µg/m³"),
]
VALIDITY_SEED = [
    (-99, "Not valid (maintenance)", "Not valid due to station maintenance or calibration"),
    (-1, "Not valid", "Not valid"),
    (1, "Valid", "Valid measurement"),
    (2, "Valid (below detection)", "Valid, but below detection limit"),
    (3, "Valid (below detection/LOQ)", "Valid, but below detection limit and limit of quantification"),
    (4, "Valid (CCQM.O3.2019)", "Valid (Ozone only) using CCQM.O3.2019"),
]
VERIFICATION_SEED = [
    (1, "Verified", "Data verified and approved"),
    (2, "Preliminary", "Preliminary data verification"),
    (3, "Not verified", "Data not verified"),
]


def _rows(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A local relation, so that Spark knows how small it is."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)))


def country_seed(spark: SparkSession) -> DataFrame:
    return _rows(spark, COUNTRY_SEED, "country_code string, country_name string, region string")


def pollutant_seed(spark: SparkSession) -> DataFrame:
    return _rows(
        spark,
        POLLUTANT_SEED,
        "pollutant_code int, pollutant_name string, pollutant_label string, unit string",
    )


def validity_seed(spark: SparkSession) -> DataFrame:
    return _rows(spark, VALIDITY_SEED, schemas.VALIDITY_FLAGS)


def verification_seed(spark: SparkSession) -> DataFrame:
    return _rows(spark, VERIFICATION_SEED, schemas.VERIFICATION_STATUS)


def seed(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Existing rows plus the seed rows whose key is not there yet."""
    added = rows.join(existing.select(key), key, "left_anti")
    return existing.unionByName(added, allowMissingColumns=True)


def get_by_key(table: DataFrame, **key: object) -> DataFrame:
    """The row with this key, or none. The predicate is pushed to the scan."""
    for name, value in key.items():
        table = table.filter(F.col(name) == F.lit(value))
    return table
