"""The driver's tables seen as air-quality data: the fixed mapping of FIXTURES.md, part B."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import prepare
from aerolake.sources.lookups import pollutant_seed, validity_seed, verification_seed
from aerolake.sources.station_extract import EXTRACT_COLUMNS


def _letter_code(nation_key):
    return F.concat(F.lit("N"), F.char(nation_key + 65))


def _padded(key, width: int):
    return F.lpad(key.cast("string"), width, "0")


@dataclass
class Fixtures:
    spark: SparkSession
    folder: str

    def __post_init__(self) -> None:
        prepare(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def countries(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            _letter_code(F.col("n_nationkey")).alias("country_code"),
            F.col("n_name").alias("country_name"),
            F.col("r_name").alias("region"),
        )

    @cached_property
    def stations(self) -> DataFrame:
        key = F.col("s_suppkey")
        country = _letter_code(F.col("s_nationkey"))
        return self.table("supplier").select(
            F.concat(country, F.lit("/"), country, _padded(key, 5)).alias("station_code"),
            country.alias("country_code"),
            F.col("s_name").alias("station_name"),
            F.when(key % 3 == 0, "traffic").when(key % 3 == 1, "background").otherwise("industrial").alias("station_type"),
            F.when(key % 2 == 0, "urban").otherwise("rural").alias("area_type"),
            "s_suppkey",
        )

    @cached_property
    def measurements(self) -> DataFrame:
        kind = F.col("event_type")
        events = self.table("events").select(
            F.col("ts").cast("timestamp").alias("time"),
            F.floor(F.col("user_id") / 3).alias("s_suppkey"),
            F.when(kind == "click", 1)
            .when(kind == "error", 5)
            .when(kind == "purchase", 7)
            .when(kind == "signup", 8)
            .otherwise(10)
            .alias("pollutant_code"),
            F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
            "value",
            "user_id",
            "event_id",
        )
        station = self.stations.select("s_suppkey", "country_code")
        k, flag = F.col("k"), F.col("k") % 10
        return events.join(station, "s_suppkey").select(
            "time",
            F.concat(
                F.col("country_code"),
                F.lit("/SPO-"),
                F.col("country_code"),
                _padded(F.col("s_suppkey"), 5),
                F.lit("_"),
                _padded(F.col("pollutant_code"), 5),
                F.lit("_"),
                F.col("user_id").cast("string"),
            ).alias("sampling_point_id"),
            "pollutant_code",
            "value",
            F.when(F.col("pollutant_code") == 10, "mg/m3").otherwise("ug/m3").alias("unit"),
            F.when(flag == 9, "day").otherwise("hour").alias("aggregation_type"),
            F.when(flag == 0, -99)
            .when(flag == 1, -1)
            .when(flag.isin(2, 3, 4), flag)
            .when(flag == 5, None)
            .otherwise(1)
            .alias("validity"),
            (k % 3 + 1).alias("verification"),
            k.cast("double").alias("data_capture"),
            F.col("event_id").cast("string").alias("observation_id"),
        )

    @cached_property
    def sampling_points(self) -> DataFrame:
        from aerolake.operators.entities import sampling_points_from

        return sampling_points_from(self.measurements)

    @cached_property
    def upsert_batch(self) -> DataFrame:
        return self.measurements.withColumns(
            {
                "time": F.date_trunc("hour", "time"),
                "value": F.col("value") + 1,
                "seq": F.col("observation_id").cast("bigint"),
            }
        )

    @cached_property
    def upsert_target(self) -> DataFrame:
        """The earliest row of each hourly key, for the keys where its ``seq`` is even."""
        from aerolake.operators.keys import keep_first

        first = keep_first(self.upsert_batch, ["time", "sampling_point_id"], ["seq"])
        return first.filter("seq % 2 = 0").drop("seq")

    @cached_property
    def extract(self) -> DataFrame:
        """Dirty extract rows under our column names; unused fields are empty text."""
        key = F.col("s_suppkey")
        twice = self.table("supplier").withColumn("dup", F.explode(F.array(F.lit(0), F.lit(1))))
        nation = _letter_code(F.col("s_nationkey"))
        columns = {
            "eoi_code": F.when(key % 13 == 5, "")
            .when(key % 11 == 4, F.concat(F.lit("ZZ"), _padded(key, 4)))
            .otherwise(F.concat(nation, _padded(key, 4), F.lit("A"))),
            "sampling_point": F.concat(
                F.lit(" SP_"),
                key.cast("string"),
                F.lit("_"),
                (F.col("dup") * (key % 2)).cast("string"),
                F.lit(" "),
            ),
            "pollutant_name": F.when((F.col("dup") == 0) & (key % 4 == 0), "UNKNOWN")
            .when(key % 4 == 1, "NO2")
            .when(key % 4 == 2, "PM10")
            .otherwise("O3"),
            "altitude": F.when(key % 5 == 0, "-999")
            .when(key % 5 == 1, "")
            .when(key % 5 == 2, "n/a")
            .when(key % 5 == 3, "-999.0")
            .otherwise(F.col("s_acctbal").cast("string")),
            "activity_begin": F.when(key % 3 == 0, "01/02/2020 00:00:00")
            .when(key % 3 == 1, "2020-02-01")
            .otherwise(" "),
            "station_name": F.concat(F.lit("  "), F.col("s_name"), F.lit(" ")),
        }
        return twice.select(
            (key * 2 + 2 + F.col("dup")).alias("row_num"),
            *[columns.get(name, F.lit("")).alias(name) for name in EXTRACT_COLUMNS.values()],
        )

    def raw(self, generation: str) -> DataFrame:
        """Measurements under the raw column names of one generation (``old`` or ``new``)."""
        if generation == "old":
            names = {
                "time": "DatetimeBegin",
                "sampling_point_id": "SamplingPoint",
                "pollutant_code": "AirPollutantCode",
                "value": "Concentration",
                "unit": "UnitOfMeasurement",
                "aggregation_type": "AggregationType",
                "observation_id": "ObservationId",
            }
        else:
            names = {
                "time": "Start",
                "sampling_point_id": "Samplingpoint",
                "pollutant_code": "Pollutant",
                "value": "Value",
                "unit": "Unit",
                "aggregation_type": "AggType",
                "observation_id": "FkObservationLog",
            }
        names |= {"validity": "Validity", "verification": "Verification", "data_capture": "DataCapture"}
        return self.measurements.select(*[F.col(c).alias(name) for c, name in names.items()])

    @cached_property
    def raw_with_stations(self) -> DataFrame:
        """Old-generation rows with station attributes; ``observation_id`` gives the file order."""
        station = self.stations
        rows = self.measurements.withColumn(
            "s_suppkey",
            F.regexp_extract("sampling_point_id", r"SPO-N.([0-9]+)_", 1).cast("bigint"),
        ).drop("country_code")
        return rows.join(station, "s_suppkey").select(
            F.concat(F.col("country_code"), _padded(F.col("s_suppkey"), 5)).alias("AirQualityStationEoICode"),
            F.col("country_code").alias("Countrycode"),
            F.concat("station_name", F.lit(" "), "observation_id").alias("AirQualityStationName"),
            F.col("station_type").alias("AirQualityStationType"),
            F.col("data_capture").alias("Altitude"),
            F.col("sampling_point_id").alias("SamplingPoint"),
            F.col("pollutant_code").alias("AirPollutantCode"),
            F.col("time").alias("DatetimeBegin"),
            F.col("value").alias("Concentration"),
            F.col("observation_id").cast("bigint").alias("seq"),
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """Orders as ingest events: a job per order month, a batch per five days of it.

        Every file is submitted; unless it is still waiting (status O with an even key) it
        starts, and status F and P end it, completed or failed. Orders of 5-LOW priority whose
        key is divisible by 50 stand for an error of their whole batch.
        """
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        created = F.col("o_orderdate").cast("timestamp")
        job = F.concat(F.lit("job-"), F.date_format("o_orderdate", "yyyyMM"))
        batch = F.floor((F.dayofmonth("o_orderdate") - 1) / 5).cast("int")
        orders = self.table("orders").withColumns({"job_id": job, "batch_no": batch})
        started = F.timestamp_micros(F.unix_micros(created) + (key % 60) * 1000000)
        ended = F.timestamp_micros(
            F.unix_micros(created) + (key % 60) * 1000000 + (key % 977 + 1) * 250000
        )

        no_time, no_text = F.lit(None).cast("timestamp"), F.lit(None).cast("string")

        def event(occurs, name, at, begun, ended_at, url, error, loaded=None):
            return F.when(
                occurs,
                F.struct(
                    url.alias("url"),
                    F.lit(name).alias("status"),
                    F.lit(loaded).cast("bigint").alias("measurements"),
                    error.alias("error"),
                    created.alias("created_at"),
                    begun.alias("started_at"),
                    ended_at.alias("ended_at"),
                    at.alias("event_time"),
                ),
            )

        url = F.concat(F.lit("https://host/"), key.cast("string"), F.lit(".parquet"))
        http_error = F.concat(F.lit("HTTP "), (key % 5 + 500).cast("string"))
        waiting = (status == "O") & (key % 2 == 0)
        aborted = (F.col("o_orderpriority") == "5-LOW") & (key % 50 == 0)
        events = F.array(
            event(F.lit(True), "pending", created, no_time, no_time, url, no_text),
            event(~waiting, "running", started, started, no_time, url, no_text),
            event(
                status == "F", "completed", ended, started, ended, url, no_text, F.round("o_totalprice")
            ),
            event(status == "P", "failed", ended, started, ended, url, http_error),
            event(aborted, "failed", ended, started, ended, no_text, F.lit("batch aborted")),
        )
        return orders.select(
            "job_id", "batch_no", F.explode(F.array_compact(events)).alias("event")
        ).select("job_id", "batch_no", "event.*")

    @cached_property
    def urls(self) -> DataFrame:
        return self.table("pages").select("page_id", "url")

    @cached_property
    def pollutants(self) -> DataFrame:
        return pollutant_seed(self.spark)

    @cached_property
    def validity_flags(self) -> DataFrame:
        return validity_seed(self.spark)

    @cached_property
    def verification_status(self) -> DataFrame:
        return verification_seed(self.spark)
