"""One query for each operator, over the mapped tables (see ``fixtures``).

Queries about stored tables really write: into a fresh folder under the shared working
folder, from where the result is read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.fixtures import Fixtures
from aerolake.functions import clean, codes, copytext, flags
from aerolake.functions.times import instant
from aerolake.operators import (
    aggregates,
    dimensions,
    entities,
    extract,
    harmonise,
    joins,
    keys,
    ledger,
    slices,
)
from aerolake.plans import load, maintenance, measurement_store
from aerolake.plans.daily_table import DailyTable
from aerolake.plans.dimension_tables import sampling_points_table, stations_table
from aerolake.plans.ledger_table import LedgerTable
from aerolake.plans.measurement_store import MeasurementStore
from aerolake.plans.point_days import PointDayTable
from aerolake.schemas import MEASUREMENT_KEY, SAMPLING_POINTS, STATIONS
from aerolake.session import work_dir
from aerolake.sources import lookups, manifest, parquet_files, station_extract
from aerolake.streaming import daily_stream, ingest, living_daily

NOW = datetime(2024, 2, 5, 12, 0)
WINDOW = (datetime(2024, 1, 10, 6, 0), datetime(2024, 1, 20, 0, 0))
MEASURED = [
    "time",
    "sampling_point_id",
    "pollutant_code",
    "value",
    "unit",
    "aggregation_type",
    "validity",
    "verification",
    "data_capture",
    "observation_id",
]

_QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}


def query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def _plain(frame: DataFrame) -> DataFrame:
    """Zone-less timestamps, so that a reader's own time zone does not matter."""
    zoned = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build):
        return lambda spark, folder: _plain(build(Fixtures(spark, folder)))

    return {name: runner(build) for name, build in _QUERIES.items()}


def _rounded(daily: DataFrame) -> DataFrame:
    return daily.withColumns(
        {name: F.round(name, 6) for name in ("avg_value", "stddev_value")}
    )


def _store(fx: Fixtures, *batches: DataFrame) -> MeasurementStore:
    store = MeasurementStore(fx.spark, work_dir(fx.spark, "measurements"))
    for batch in batches:
        store.insert(batch)
    return store


def _written(fx: Fixtures, frame: DataFrame, label: str) -> str:
    path = work_dir(fx.spark, label)
    frame.write.parquet(path)
    return path


def _measured(frame: DataFrame) -> DataFrame:
    return frame.select(*MEASURED)


# --- sources -----------------------------------------------------------------------------


@query
def read_measurement_parquet(fx):
    raws = parquet_files.read_measurement_files(fx.spark, _written(fx, fx.raw("new"), "raw"))
    return _measured(parquet_files.measurements_of(fx.spark, raws))


def _extract_csv(fx) -> str:
    return _csv_of(fx, fx.extract.orderBy("row_num"))


def _csv_of(fx, extract: DataFrame) -> str:
    path = work_dir(fx.spark, "extract") + ".csv"
    headers = {name: header for header, name in station_extract.EXTRACT_COLUMNS.items()}
    rows = extract.drop("row_num").withColumnsRenamed(headers)
    rows.write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query
def read_station_extract(fx):
    """Names hold line breaks and quotes; each row also carries its place in its file."""
    name = F.concat(F.coalesce("station_name", F.lit("")), F.lit('\n"'), "eoi_code", F.lit('"'))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    broken = fx.extract.orderBy("row_num").withColumns({"station_name": name, "sample_id": place})
    rows = station_extract.read_station_extract(fx.spark, _csv_of(fx, broken))
    return rows.select(
        "eoi_code", "sampling_point", "pollutant_name", "altitude", "activity_begin", "station_name",
        (F.col("row_num") == F.col("sample_id").cast("bigint") + 2).alias("numbered"),
    )


def _manifest_file(fx) -> str:
    """A comment, a blank line and a padded URL for each page, in page order."""
    path = work_dir(fx.spark, "urls")
    lines = F.array(
        F.concat(F.lit("  # page "), F.col("page_id").cast("string")),
        F.lit("   "),
        F.concat(F.lit(" "), "url", F.lit("\t")),
    )
    ordered = fx.urls.orderBy("page_id").select(F.explode(lines).alias("value"))
    ordered.write.text(path)
    return path


@query
def read_url_manifest(fx):
    return manifest.read_url_manifest(fx.spark, _manifest_file(fx))


@query
def manifest_csv_limit(fx):
    path = work_dir(fx.spark, "url-list")
    fx.urls.orderBy("page_id").select(F.col("url").alias("ParquetFileUrl")).write.option(
        "header", True
    ).csv(path)
    return manifest.read_url_list(fx.spark, path, max_urls=20)


def _mixed_folder(fx) -> str:
    """Both generations and some text files in one folder; together they hold every row once."""
    path = work_dir(fx.spark, "mixed")
    fx.raw("old").filter("AirPollutantCode < 7").write.parquet(f"{path}/old")
    fx.raw("new").filter("Pollutant >= 7").write.parquet(f"{path}/new")
    fx.urls.select("url").write.text(f"{path}/junk")
    return path


@query
def load_many_files(fx):
    listing = parquet_files.list_files(fx.spark, _mixed_folder(fx))
    return _measured(load.read_files(fx.spark, listing).measurements)


@query
def load_dropped_rows(fx):
    """Rows without a pollutant are left out of their files and counted."""
    missing = F.when(F.coalesce(F.col("Verification") != 3, F.lit(True)), F.col("Pollutant"))
    folder = _written(fx, fx.raw("new").withColumn("Pollutant", missing), "gaps")
    files = load.read_files(fx.spark, parquet_files.list_files(fx.spark, folder)).files
    return files.agg(F.sum("measurements").alias("measurements"), F.sum("dropped").alias("dropped"))


@query
def file_integrity(fx):
    inspected = parquet_files.inspect_files(parquet_files.list_files(fx.spark, _mixed_folder(fx)))
    kind = F.element_at(F.split("path", r"\."), -1)
    return inspected.groupBy(kind.alias("kind"), "is_parquet").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )


@query
def seed_lookups(fx):
    return lookups.seed(fx.countries, lookups.country_seed(fx.spark), "country_code")


@query
def read_from_local_copy(fx):
    listing = parquet_files.list_files(fx.spark, _written(fx, fx.raw("new"), "copies"))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.parquet$", "")
    known = listing.select(F.concat(F.lit("https://host/data/"), name).alias("url"))
    gone = fx.urls.select("url")
    found = manifest.local_copies(known.unionByName(gone), listing)
    at_hand = listing.join(found.select("path"), "path", "left_semi")
    return _measured(load.read_files(fx.spark, at_hand).measurements)


# --- sinks and table maintenance -----------------------------------------------------------


@query
def bulk_insert(fx):
    cut = F.col("time") < instant(datetime(2024, 1, 15))
    store = _store(fx, fx.measurements.filter(cut), fx.measurements.filter(~cut))
    return _measured(store.read())


@query
def bulk_insert_conflicts(fx):
    return keys.insert_conflicts(fx.upsert_batch, fx.upsert_target, MEASUREMENT_KEY)


@query
def bulk_upsert(fx):
    store = _store(fx, fx.upsert_target)
    store.upsert(fx.upsert_batch, ["seq"])
    return _measured(store.read())


@query
def upsert_merge(fx):
    merged = keys.merge_latest(
        _measured(fx.upsert_target), fx.upsert_batch, MEASUREMENT_KEY, ["seq"]
    )
    return _measured(merged)


def _copy_batch(fx) -> DataFrame:
    """Measurements with zero flags, an older flag name and empty observation ids."""
    return fx.measurements.withColumns(
        {
            "validity": F.when(F.col("validity") == -99, 0).otherwise(F.col("validity")),
            "validity_flag_id": F.when(F.col("pollutant_code") == 7, 4).otherwise(0),
            "verification": F.col("verification") - 1,
            "observation_id": F.when(F.col("pollutant_code") == 10, "").otherwise(
                F.col("observation_id")
            ),
        }
    )


@query
def bulk_copy(fx):
    store = _store(fx)
    store.copy(_copy_batch(fx))
    return _measured(store.read())


@query
def copy_text_export(fx):
    path = work_dir(fx.spark, "copy-text")
    measurement_store.copy_text(_copy_batch(fx)).write.text(path)
    return fx.spark.read.text(path).withColumnRenamed("value", "line")


@query
def write_in_batches(fx):
    store = _store(fx)
    store.insert(fx.measurements, batch_size=1000)
    files = store.read().groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return files.agg(
        F.sum("n").alias("rows"), (F.max("n") <= 1000).alias("within_limit")
    )


def _station_target(fx, rows: DataFrame) -> DataFrame:
    """Given station columns, the others of the table NULL."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in STATIONS.fields
        ]
    )


@query
def upsert_stations(fx):
    target = _station_target(fx, fx.stations.filter("area_type = 'urban'"))
    batch = fx.stations.filter("station_type <> 'traffic'").select(
        "station_code",
        "country_code",
        F.when(F.col("station_type") == "industrial", F.upper("station_name")).alias("station_name"),
    )
    merged = dimensions.merge_dimension(target, batch, "station_code", NOW)
    return merged.select(
        "station_code", "country_code", "station_name", "station_type", "area_type", "updated_at", "change"
    )


@query
def upsert_sampling_points(fx):
    points = fx.sampling_points
    target = points.filter("pollutant_code < 8").select(
        *[
            (F.col(f.name) if f.name in points.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SAMPLING_POINTS.fields
        ]
    )
    batch = points.filter("pollutant_code > 1").select(
        "sampling_point_id", "station_code", F.lit("automatic").alias("instrument_type"), "pollutant_code"
    )
    merged = dimensions.merge_dimension(target, batch, "sampling_point_id", NOW)
    return merged.select(
        "sampling_point_id",
        "station_code",
        "country_code",
        "pollutant_code",
        "instrument_type",
        "updated_at",
        "change",
    )


@query
def upsert_pollutants(fx):
    part = fx.table("part").select(
        F.col("p_partkey").cast("int").alias("pollutant_code"),
        F.col("p_name").alias("pollutant_name"),
        F.col("p_type").alias("pollutant_label"),
        "p_size",
    )
    target = part.filter("p_size < 30").select(
        "pollutant_code",
        "pollutant_name",
        "pollutant_label",
        F.lit(None).cast("string").alias("unit"),
    )
    batch = part.filter("p_size >= 20").select(
        "pollutant_code",
        F.upper("pollutant_name").alias("pollutant_name"),
        F.lit("ug/m3").alias("unit"),
        "p_size",  # not a column of the table
    )
    return dimensions.merge_pollutants(target, batch, NOW)


@query
def load_entities(fx):
    spark = fx.spark
    listing = parquet_files.list_files(spark, _written(fx, fx.raw_with_stations, "raw"))
    stations = stations_table(spark, work_dir(spark, "stations"))
    points = sampling_points_table(spark, work_dir(spark, "points"))
    store = _store(fx)
    load.load_entities(spark, load.read_files(spark, listing), stations, points, store, NOW)
    return aggregates.table_counts(stations.read(), points.read(), store.read())


def _first_point(fx) -> str:
    return fx.measurements.agg(F.min("sampling_point_id")).first()[0]


@query
def delete_time_range(fx):
    store = _store(fx, fx.measurements)
    store.delete_time_range(_first_point(fx), datetime(2024, 1, 5), datetime(2024, 1, 20, 12))
    return _measured(store.read())


@query
def cascade_delete(fx):
    store = _store(fx, fx.measurements)
    store.cascade_delete(fx.sampling_points.filter("pollutant_code = 8 and country_code < 'NM'"))
    return _measured(store.read())


def _daily(fx, store: MeasurementStore, start=None, end=None) -> DailyTable:
    table = DailyTable(fx.spark, work_dir(fx.spark, "daily"))
    table.refresh(store, fx.sampling_points, start, end)
    return table


@query
def truncate_daily(fx):
    table = _daily(fx, _store(fx, fx.measurements))
    removed = table.truncate()
    return table.read().agg(
        F.lit(removed).cast("bigint").alias("rows_deleted"), F.count("*").alias("rows_left")
    )


@query
def compact_old_partitions(fx):
    store = _store(fx, fx.measurements)
    maintenance.compact_old_partitions(
        store, work_dir(fx.spark, "compaction"), datetime(2024, 2, 15)
    )
    return _measured(store.read())


@query
def cleanup_processed(fx):
    folder = _written(fx, fx.raw("new"), "arriving")
    files = ingest.file_stream(fx.spark, folder)
    store = _store(fx)
    checkpoint = work_dir(fx.spark, "stream")
    ingest.stream_ingest(files, store, checkpoint, after_load="delete").awaitTermination()
    if parquet_files.list_files(fx.spark, folder).filter(F.col("path").endswith(".parquet")).count():
        raise AssertionError("loaded files are left")
    return _measured(store.read())


@query
def insert_fk_refused(fx):
    """A batch with unknown sampling points is refused; the rest of it is taken."""
    store = _store(fx)
    known = {"sampling_point_id": fx.sampling_points.filter("pollutant_code < 8")}
    try:
        store.insert(fx.measurements, references=known)
    except measurement_store.UnknownReferenceError:
        store.insert(fx.measurements.filter("pollutant_code < 8"), references=known)
    return _measured(store.read())


# --- projections, filters, casts ------------------------------------------------------------


@query
def harmonise_columns(fx):
    return harmonise.harmonise_columns(fx.raw("old"))


@query
def require_columns(fx):
    complete = fx.raw("old")
    parts = [
        harmonise.cast_measurements(raw).select(F.lit(name).alias("variant"))
        for name, raw in [("complete", complete), ("no time", complete.drop("DatetimeBegin"))]
    ]
    return parts[0].unionByName(parts[1]).agg(
        F.count_if(F.col("variant") == "complete").alias("complete"),
        F.count_if(F.col("variant") == "no time").alias("without_time"),
    )


@query
def require_not_null(fx):
    holes = fx.measurements.withColumns(
        {
            "time": F.when(F.col("verification") != 3, F.col("time")),
            "pollutant_code": F.nullif(F.col("pollutant_code"), F.lit(8)),
        }
    )
    return _measured(harmonise.require_not_null(holes))


@query
def to_utc(fx):
    seconds = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(F.col("pollutant_code") == 1, seconds)
        .when(F.col("pollutant_code") == 5, F.concat(F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(F.col("pollutant_code") == 7, "soon")
        .otherwise(F.concat(seconds, F.lit("Z")))
    )
    nanos = F.unix_micros("time") * 1000 + 999
    return fx.measurements.select(
        "observation_id",
        clean.utc_time(text, "string").alias("from_text"),
        clean.utc_time(F.col("time").cast("timestamp_ntz"), "timestamp_ntz").alias("from_zoneless"),
        clean.utc_time(nanos, "bigint").alias("from_nanoseconds"),
    )


@query
def cast_measurements(fx):
    raw = fx.raw("new").withColumns(
        {
            "Pollutant": F.col("Pollutant").cast("double"),
            "Value": F.when(F.col("Validity") == -1, F.lit(float("nan"))).otherwise(F.col("Value")),
            "Validity": F.col("Validity").cast("double"),
            "Verification": F.when(F.col("Verification") == 2, "n/a").otherwise(
                F.col("Verification").cast("string")
            ),
            "Start": F.col("Start").cast("timestamp_ntz"),
        }
    )
    return _measured(harmonise.cast_measurements(raw))


@query
def parse_extract_date(fx):
    key = F.col("o_orderkey")
    text = (
        F.when(key % 4 == 0, F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss"))
        .when(key % 4 == 1, F.date_format("o_orderdate", "d/M/yyyy H:m:s"))
        .when(key % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("31/02/2020 00:00:00")
    )
    return fx.table("orders").select("o_orderkey", clean.extract_date(text).alias("parsed"))


@query
def parse_iso_date(fx):
    key = F.col("o_orderkey")
    text = (
        F.when(key % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(key % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise("not a date")
    )
    return fx.table("orders").select("o_orderkey", clean.iso_date(text).alias("parsed"))


@query
def parse_sentinel_float(fx):
    return fx.extract.select("row_num", clean.sentinel_float(F.col("altitude")).alias("altitude"))


@query
def blank_to_null(fx):
    return fx.extract.select(
        "row_num",
        clean.blank_to_null(F.col("station_name")).alias("station_name"),
        clean.blank_to_null(F.col("activity_begin")).alias("activity_begin"),
    )


@query
def skip_incomplete_extract_rows(fx):
    return extract.complete_rows(fx.extract).select("row_num", "station_code", "sampling_point")


@query
def country_from_station_code(fx):
    return fx.extract.select("row_num", codes.country_of_station(F.col("eoi_code")).alias("country_code"))


@query
def file_name_from_url(fx):
    return fx.urls.select("page_id", codes.file_name_of_url(F.col("url")).alias("file_name"))


@query
def parse_sampling_point_id(fx):
    sp = F.col("sampling_point_id")
    return fx.measurements.select(
        "observation_id",
        codes.country_of_sampling_point(sp).alias("country_code"),
        codes.station_of_sampling_point(sp).alias("station_code"),
    )


@query
def prefix_sampling_point_id(fx):
    return extract.complete_rows(fx.extract).select(
        "row_num",
        codes.prefixed_sampling_point(F.col("country_code"), F.col("sampling_point")).alias("sampling_point_id"),
    )


def _filled_extract(fx) -> DataFrame:
    return fx.extract.withColumns(
        {
            "nat_code": F.concat(F.lit(" "), "eoi_code"),
            "timezone": F.lit("UTC+01 "),
            "process_id": F.concat(F.lit("P"), F.col("row_num").cast("string")),
        }
    )


@query
def station_metadata_map(fx):
    stations = extract.stations_from_extract(_filled_extract(fx), fx.countries)
    return stations.select("station_code", F.to_json("metadata").alias("metadata"))


@query
def sampling_metadata_map(fx):
    points = extract.sampling_points_from_extract(_filled_extract(fx), fx.countries, fx.pollutants)
    return points.select("sampling_point_id", F.to_json("metadata").alias("metadata"))


@query
def normalise_copy_flags(fx):
    return _measured(measurement_store.normalise_copy_flags(_copy_batch(fx)))


@query
def truncate_copy_time(fx):
    text = copytext.copy_time(F.col("time"))
    return fx.measurements.select("observation_id", F.to_timestamp(text).alias("time"))


@query
def valid_measurements(fx):
    return _measured(fx.measurements.filter(flags.at_least_valid(F.col("validity"))))


@query
def flag_classes(fx):
    flag = F.col("validity")
    return fx.measurements.select(
        "observation_id",
        flags.declared_valid(flag).alias("valid"),
        flags.declared_invalid(flag).alias("invalid"),
        flags.strictly_valid(flag).alias("strictly_valid"),
    )


@query
def min_data_capture(fx):
    return _measured(fx.measurements.filter(flags.enough_capture(F.col("data_capture"))))


@query
def hourly_only(fx):
    return _measured(fx.measurements.filter(flags.hourly(F.col("aggregation_type"))))


@query
def decode_flags(fx):
    decoded = joins.decode_flags(fx.measurements, fx.validity_flags, fx.verification_status)
    return decoded.select(
        "observation_id",
        "validity_name",
        "verification_name",
        flags.text_of(F.col("validity"), flags.VALIDITY_TEXT).alias("validity_text"),
        flags.text_of(F.col("verification"), flags.VERIFICATION_TEXT).alias("verification_text"),
        flags.text_of(F.col("verification"), flags.DATASET_TEXT).alias("dataset_text"),
    )


@query
def format_bytes(fx):
    size = F.col("o_orderkey") * F.pow(F.lit(10.0), (F.col("o_orderkey") % 14).cast("double"))
    return fx.table("orders").select("o_orderkey", clean.format_bytes(size).alias("size"))


@query
def slice_measurements(fx):
    return _measured(
        slices.slice_measurements(fx.measurements, fx.sampling_points, "NB", 7, *WINDOW)
    )


def _daily_view(fx) -> DataFrame:
    return aggregates.daily_measurements(fx.measurements, fx.sampling_points)


@query
def slice_daily(fx):
    return _rounded(slices.slice_daily(_daily_view(fx), date(2024, 1, 10), date(2024, 1, 12), pollutant=5))


# --- entities ---------------------------------------------------------------------------------


@query
def stations_from_attributes(fx):
    stations = entities.stations_from_attributes(fx.raw_with_stations, order=["seq"])
    return stations.select("station_code", "country_code", "station_name", "station_type", "altitude")


@query
def stations_from_sampling_ids(fx):
    return entities.stations_from_sampling_ids(fx.measurements)


@query
def sampling_points_from_file(fx):
    return entities.parse_sampling_points(fx.raw("old"))


@query
def stations_from_extract(fx):
    return extract.stations_from_extract(fx.extract, fx.countries).select(
        "station_code", "country_code", "station_name", "altitude", "start_date"
    )


@query
def sampling_points_from_extract(fx):
    points = extract.sampling_points_from_extract(fx.extract, fx.countries, fx.pollutants)
    return points.select("sampling_point_id", "station_code", "country_code", "pollutant_code", "start_date")


@query
def parse_all(fx):
    raw = fx.raw_with_stations
    return entities.entity_counts(
        entities.parse_stations(raw, ["seq"]),
        entities.parse_sampling_points(raw),
        harmonise.cast_measurements(raw),
    )


@query
def extract_errors(fx):
    return extract.extract_errors(fx.extract, fx.countries, fx.pollutants)


@query
def all_extract_errors(fx):
    return extract.all_extract_errors(fx.extract, fx.countries, fx.pollutants)


@query
def extract_summary(fx):
    stations = extract.stations_from_extract(fx.extract, fx.countries)
    points = extract.sampling_points_from_extract(fx.extract, fx.countries, fx.pollutants)
    have = stations.filter("altitude is null").select("station_code", "country_code")
    target = _station_target(fx, have)
    no_points = fx.spark.createDataFrame([], SAMPLING_POINTS)
    return extract.extract_summary(
        dimensions.merge_dimension(target, stations, "station_code", NOW),
        dimensions.merge_dimension(no_points, points, "sampling_point_id", NOW),
        extract.all_extract_errors(fx.extract, fx.countries, fx.pollutants),
    )


# --- joins --------------------------------------------------------------------------------------


@query
def measurements_with_station(fx):
    joined = joins.measurements_with_station(fx.measurements, fx.sampling_points)
    return joined.select(*MEASURED, "station_code")


@query
def known_country(fx):
    return extract.known_country(extract.complete_rows(fx.extract), fx.countries).select("row_num", "station_code")


@query
def unknown_country(fx):
    return extract.unknown_country(extract.complete_rows(fx.extract), fx.countries).select("row_num", "station_code")


@query
def pollutant_code_by_name(fx):
    names = extract.pollutant_code_by_name(fx.pollutants)
    return fx.extract.join(names, "pollutant_name", "left").select("row_num", "pollutant_name", "pollutant_code")


@query
def fk_violations(fx):
    return joins.fk_violations(
        fx.measurements.withColumn("validity", F.coalesce("validity", F.lit(0))),
        fx.sampling_points.filter("pollutant_code <> 5"),
        fx.stations.filter("station_type <> 'traffic'"),
        fx.countries.filter("region <> 'EUROPE'"),
        fx.pollutants.filter("pollutant_code <> 10"),
        fx.validity_flags,
        fx.verification_status,
    )


# --- aggregates -----------------------------------------------------------------------------------


@query
def daily_measurements(fx):
    return _rounded(_daily_view(fx))


@query
def daily_measurements_preaggregated(fx):
    """With a join that shuffles, as for a large sampling-point table."""
    return _rounded(aggregates.daily_measurements(fx.measurements, fx.sampling_points.hint("merge")))


@query
def refresh_daily(fx):
    """Only the whole days of the window; nothing else was ever computed."""
    return _rounded(_daily(fx, _store(fx, fx.measurements), *WINDOW).read())


@query
def refresh_daily_emptied_day(fx):
    """A full table, a day turned invalid by an upsert, then a refresh around it."""
    store = _store(fx, fx.measurements)
    table = _daily(fx, store)
    day = fx.measurements.filter(F.to_date("time") == F.lit(date(2024, 1, 12)))
    store.upsert(day.withColumn("validity", F.lit(-1)), ["observation_id"])
    table.refresh(store, fx.sampling_points, *WINDOW)
    return _rounded(table.read())


@query
def daily_status(fx):
    return aggregates.daily_status(_daily_view(fx))


@query
def table_counts(fx):
    return aggregates.table_counts(fx.stations, fx.sampling_points, fx.measurements)


@query
def data_quality(fx):
    return aggregates.data_quality(fx.measurements)


@query
def file_load_stats(fx):
    stats = ledger.file_load_stats(ledger.current_state(fx.ledger))
    return stats.withColumns({"seconds": F.round("seconds", 6), "throughput": F.round("throughput", 4)})


@query
def batch_load_stats(fx):
    return ledger.batch_load_stats(ledger.current_state(fx.ledger))


def _batches(fx) -> DataFrame:
    return ledger.batch_states(ledger.current_state(fx.ledger))


@query
def batch_states(fx):
    return _batches(fx)


@query
def job_progress(fx):
    return ledger.job_progress(_batches(fx))


def _jobs(fx) -> DataFrame:
    """Jobs of the ledger and one job for each nation, which has no batch yet."""
    submitted = fx.ledger.select("job_id").distinct()
    empty = fx.countries.select(F.concat(F.lit("job-"), "country_code").alias("job_id"))
    return submitted.unionByName(empty)


@query
def job_status(fx):
    return ledger.job_status(_jobs(fx), _batches(fx))


@query
def job_status_strict(fx):
    return ledger.job_status(_jobs(fx), _batches(fx), strict=True)


def _compacted_store(fx):
    store = _store(fx, fx.measurements)
    notes = work_dir(fx.spark, "compaction")
    maintenance.compact_old_partitions(store, notes, datetime(2024, 2, 15))
    return (
        maintenance.chunk_files(store),
        maintenance.read_compaction_ledger(fx.spark, notes),
    )


@query
def storage_report(fx):
    return maintenance.storage_report(*_compacted_store(fx))


@query
def storage_report_of_listing(fx):
    """The report over a listing and a ledger made of orders: a day is a chunk, an order a file."""
    orders = fx.table("orders").withColumn("chunk", F.col("o_orderdate").cast("date"))
    files = orders.select(
        "chunk", F.col("o_orderkey").cast("string").alias("path"),
        (F.col("o_custkey") * 1000).cast("bigint").alias("length"),
    )
    noted = orders.filter("o_custkey % 3 > 0").groupBy("chunk").agg(
        F.sum(F.col("o_custkey") * 5).alias("before_bytes"),
        F.sum("o_custkey").alias("after_bytes"),
        F.lit(None).cast("string").alias("error"),
        F.max(F.col("chunk").cast("timestamp")).alias("compacted_at"),
    )
    return maintenance.storage_report(files, noted).select(
        "table_bytes", "compaction_effective", "compression_ratio", "space_saved_percentage"
    )


@query
def compaction_status(fx):
    return maintenance.compaction_status(*_compacted_store(fx))


@query
def manifest_batches(fx):
    """The URLs of each batch are joined into one text, to keep the result flat."""
    batches = ledger.cut_batches(manifest.read_url_manifest(fx.spark, _manifest_file(fx)))
    return batches.select("batch_no", "urls_count", F.array_join("urls", " ").alias("urls"))


@query
def load_estimate(fx):
    jobs = ledger.current_state(fx.ledger).groupBy("job_id").agg(F.count("url").alias("total_urls"))
    few = ledger.load_estimate(jobs, 3).withColumnRenamed("estimated_minutes", "with_3_batches")
    return ledger.load_estimate(few, 10).select(
        "job_id", "total_urls", "with_3_batches", F.col("estimated_minutes").alias("with_10_batches")
    )


# --- sort, limit, point reads -----------------------------------------------------------------------


@query
def latest_by_sampling_point(fx):
    return _measured(slices.latest_by_sampling_point(fx.measurements, limit=5))


@query
def store_latest_by_sampling_point(fx):
    store = _store(fx, fx.measurements)
    return _measured(store.latest_by_sampling_point(fx.sampling_points, limit=5))


@query
def latest_of_one(fx):
    return _measured(slices.latest_of(fx.measurements, _first_point(fx), limit=5))


@query
def latest_overall(fx):
    return _measured(slices.latest_overall(fx.measurements))


@query
def store_latest(fx):
    """Over the stored table: only the newest chunks are read."""
    return _measured(_store(fx, fx.measurements).latest())


@query
def store_latest_of_one(fx):
    return _measured(_store(fx, fx.measurements).latest_of(_first_point(fx), limit=5))


@query
def store_late_rows(fx):
    return _store(fx, fx.measurements).late_rows(NOW)


@query
def recent_jobs(fx):
    return ledger.recent_jobs(ledger.current_state(fx.ledger))


@query
def get_by_key(fx):
    rows = lookups.get_by_key(fx.stations, station_code="NB/NB00001").select(
        F.lit("station").alias("kind"), F.col("station_code").alias("key")
    )
    point = _first_point(fx)
    others = [
        lookups.get_by_key(fx.sampling_points, sampling_point_id=point).select(
            F.lit("sampling point").alias("kind"), F.col("sampling_point_id").alias("key")
        ),
        lookups.get_by_key(fx.countries, country_code="NC").select(
            F.lit("country").alias("kind"), F.col("country_code").alias("key")
        ),
        lookups.get_by_key(_jobs(fx), job_id="job-199703").select(
            F.lit("job").alias("kind"), F.col("job_id").alias("key")
        ),
    ]
    for other in others:
        rows = rows.unionByName(other)
    return rows


@query
def get_all(fx):
    return fx.countries


@query
def get_all_stations(fx):
    table = stations_table(fx.spark, work_dir(fx.spark, "stations"))
    table.upsert(fx.stations.select("station_code", "country_code", "station_name"), NOW)
    return table.read().select("station_code", "country_code", "station_name", "created_at")


@query
def job_detail(fx):
    return ledger.job_detail(_batches(fx), "job-199703")


# --- incremental and streaming ------------------------------------------------------------------------


@query
def stream_daily(fx):
    """The daily table kept by a stream over the measurements, file by file."""
    spark = fx.spark
    folder = _written(fx, fx.measurements.repartition(6), "arriving")
    arriving = spark.readStream.schema(spark.read.parquet(folder).schema).option(
        "maxFilesPerTrigger", 2
    ).parquet(folder)
    points = spark.read.parquet(_written(fx, fx.sampling_points, "points"))
    table = DailyTable(spark, work_dir(spark, "daily"))
    changes = daily_stream.stream_daily(arriving, points)
    daily_stream.maintain_daily(changes, table, work_dir(spark, "stream")).awaitTermination()
    return _rounded(table.read())


def _living(fx, points: DataFrame, watermark_days: int = 30) -> living_daily.LivingDaily:
    spark = fx.spark
    dimension = sampling_points_table(spark, work_dir(spark, "points"))
    dimension.upsert(points, NOW)
    table = PointDayTable(spark, work_dir(spark, "point-days"))
    daily = DailyTable(spark, work_dir(spark, "daily"))
    return living_daily.LivingDaily(table, daily, dimension, work_dir(spark, "living"), watermark_days)


def _arriving(fx, *parts: DataFrame):
    """A stream over a folder, and a step that adds the next part to it and runs the stream."""
    spark, folder, checkpoint = fx.spark, work_dir(fx.spark, "arriving"), work_dir(fx.spark, "stream")
    waiting = list(parts)

    def step(living: living_daily.LivingDaily) -> None:
        waiting.pop(0).repartition(3).write.mode("append").parquet(folder)
        schema = spark.read.parquet(folder).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(folder)
        living.run(stream, checkpoint).awaitTermination()

    return step


@query
def stream_daily_new_points(fx):
    """Two thirds of the sampling points become known while the stream runs, some of them last."""
    third = F.pmod(F.xxhash64("sampling_point_id"), F.lit(3))
    living = _living(fx, fx.sampling_points.filter(third == 0))
    early = F.dayofmonth("time") <= 12
    step = _arriving(fx, fx.measurements.filter(early), fx.measurements.filter(~early))
    step(living)
    living.sampling_points.upsert(fx.sampling_points.filter(third == 1), NOW)
    step(living)
    living.sampling_points.upsert(fx.sampling_points.filter(third == 2), NOW)
    living.release()
    if not living.parked().isEmpty():
        raise AssertionError("points that are known still wait")
    return _rounded(living.daily.read())


def _late_stream(fx) -> living_daily.LivingDaily:
    """The newest days arrive first, then all others, most of them behind the watermark."""
    living = _living(fx, fx.sampling_points, watermark_days=3)
    newest = F.to_date("time") >= F.lit(date(2024, 1, 20))
    step = _arriving(fx, fx.measurements.filter(newest), fx.measurements.filter(~newest))
    step(living)
    step(living)
    return living


@query
def stream_daily_late_rows(fx):
    return _rounded(_late_stream(fx).daily.read())


@query
def refresh_daily_incremental(fx):
    """Point-days follow two loads, an upsert and a delete; the daily table reads them alone."""
    half = F.col("observation_id").cast("bigint") % 2 == 0
    store = _store(fx)
    points = PointDayTable(fx.spark, work_dir(fx.spark, "point-days"))
    daily = DailyTable(fx.spark, work_dir(fx.spark, "daily"))
    dimension = fx.spark.read.parquet(_written(fx, fx.sampling_points, "points"))
    for number, batch in enumerate([fx.measurements.filter(half), fx.measurements.filter(~half)]):
        store.insert(batch)
        daily.refresh_from(points, dimension, points.append(batch, number))
    changed = fx.measurements.filter("pollutant_code = 8").withColumn("value", F.col("value") + 1)
    store.upsert(changed, ["observation_id"])
    day = F.to_date("time").alias("day")
    keys = changed.select(day, "sampling_point_id")
    daily.refresh_from(points, dimension, points.recompute(store, keys, 2))
    first, start, end = _first_point(fx), datetime(2024, 1, 5), datetime(2024, 1, 20, 12)
    doomed = store.between(start, datetime(2024, 1, 21)).filter(F.col("sampling_point_id") == first)
    keys = fx.spark.read.parquet(_written(fx, doomed.select(day, "sampling_point_id").distinct(), "doomed"))
    store.delete_time_range(first, start, end)
    daily.refresh_from(points, dimension, points.recompute(store, keys, 3))
    return _rounded(daily.read())


@query
def refresh_policy(fx):
    table = DailyTable(fx.spark, work_dir(fx.spark, "daily"))
    table.refresh_policy(_store(fx, fx.measurements), fx.sampling_points, NOW)
    return _rounded(table.read())


@query
def stream_ingest(fx):
    """Raw files arrive as a stream; the daily table follows each micro-batch."""
    spark = fx.spark
    raw_rows = fx.raw("old").repartition(4)
    folder = _written(fx, raw_rows, "arriving")
    files = ingest.file_stream(spark, folder, max_files=2)
    store = _store(fx)
    points = spark.read.parquet(_written(fx, fx.sampling_points, "points"))
    table = DailyTable(spark, work_dir(spark, "daily"))
    query = ingest.stream_ingest(files, store, work_dir(spark, "stream"), table, points)
    query.awaitTermination()
    return _rounded(table.read())


@query
def stream_ingest_mixed(fx):
    """Both generations and text files arrive together; what loaded is removed, the rest stays."""
    folder, report = _mixed_folder(fx), work_dir(fx.spark, "report")
    store, checkpoint = _store(fx), work_dir(fx.spark, "stream")
    files = ingest.file_stream(fx.spark, folder, max_files=5)
    ingest.stream_ingest(files, store, checkpoint, after_load="delete", report=report).awaitTermination()
    left = parquet_files.list_files(fx.spark, folder).select("path")
    failed = fx.spark.read.parquet(report).filter("error is not null").select("path")
    if left.exceptAll(failed).count() or failed.exceptAll(left).count():
        raise AssertionError("the files left are not those that failed")
    return _measured(store.read())


@query
def stream_ingest_unreadable_columns(fx):
    """Files without a sampling point, of an odd kind, or without any whole row stay where they are."""
    spark, path = fx.spark, work_dir(fx.spark, "odd")
    raw = fx.raw("new")
    raw.filter("Pollutant < 5").write.parquet(f"{path}/good")
    raw.filter("Pollutant = 5").drop("Samplingpoint").write.parquet(f"{path}/short")
    raw.filter("Pollutant = 7").withColumn("Value", F.array("Value")).write.parquet(f"{path}/kind")
    raw.filter("Pollutant = 8").withColumn("Start", F.lit(None).cast("timestamp")).write.parquet(f"{path}/empty")
    raw.filter("Pollutant > 8").write.parquet(f"{path}/more")
    store, report = _store(fx), work_dir(spark, "report")
    files = ingest.file_stream(spark, path, max_files=5)
    checkpoint = work_dir(spark, "stream")
    ingest.stream_ingest(files, store, checkpoint, after_load="delete", report=report).awaitTermination()
    folder = F.element_at(F.split("path", "/"), -2)
    left = parquet_files.list_files(spark, path, pattern="*.parquet").select(folder.alias("folder"), "path")
    told = spark.read.parquet(report)
    silent = left.join(told.filter("error is not null"), "path", "left_anti").count()
    lost = told.filter("error is not null").join(left, "path", "left_anti").count()
    folders = {r["folder"] for r in left.select("folder").distinct().collect()}
    if silent or lost or not folders <= {"short", "kind", "empty"} or (told.count() and not folders):
        raise AssertionError(f"files left: {folders}, {silent} without a reason, {lost} lost")
    return _measured(store.read())


@query
def late_rows(fx):
    return slices.late_rows(fx.measurements, NOW)


@query
def ingest_ledger(fx):
    return ledger.current_state(fx.ledger)


@query
def ingest_ledger_snapshot(fx):
    """The ledger appended in four parts, out of order, and folded after each."""
    table = LedgerTable(fx.spark, work_dir(fx.spark, "ledger"))
    part = F.pmod(F.xxhash64("url", "status"), F.lit(4))
    for number in range(4):
        table.append(fx.ledger.filter(part == number))
        table.fold()
    return table.current()


@query
def batch_duration(fx):
    return ledger.batch_durations(_batches(fx)).withColumn(
        "duration_seconds", F.round("duration_seconds", 6)
    )


@query
def failed_files(fx):
    current = ledger.current_state(fx.ledger).filter("url is not null")
    listed = current.select("url")
    unknown = fx.urls.select("url")
    loaded = current.filter("status = 'completed'")
    return ledger.failed_files(listed.unionByName(unknown), loaded, current)


@query
def load_manifest_partial_failure(fx):
    """Good files, text files, files with repeated keys and a missing one, loaded as one job."""
    spark, path = fx.spark, work_dir(fx.spark, "partial")
    fx.raw("new").filter("Pollutant >= 7").write.parquet(f"{path}/good")
    doubled = fx.raw("old").filter("AirPollutantCode < 7")
    doubled.union(doubled).coalesce(1).write.parquet(f"{path}/repeated")
    fx.urls.select("url").coalesce(1).write.text(f"{path}/junk")
    listing = parquet_files.list_files(spark, path)
    name = F.element_at(F.split("path", "/"), -1)
    present = listing.select(
        F.concat(F.lit("https://host/"), name).alias("url"),
        F.element_at(F.split("path", "/"), -2).alias("kind"),
    )
    gone = spark.createDataFrame([("https://host/gone.parquet", "gone")], "url string, kind string")
    jobs = present.unionByName(gone).withColumn("position", F.crc32("url"))
    rows = load.load_manifest(spark, _store(fx), jobs.drop("kind"), listing, "job-2")
    return (
        rows.join(jobs.select("url", "kind"), "url")
        .groupBy("kind", "status")
        .agg(F.coalesce(F.sum("measurements"), F.lit(0)).alias("measurements"))
    )


@query
def load_manifest_ledger(fx):
    """A manifest of present, broken and missing files, loaded as one job; its ledger."""
    spark = fx.spark
    listing = parquet_files.list_files(spark, _mixed_folder(fx))
    name = F.element_at(F.split("path", "/"), -1)
    present = listing.filter(name.endswith(".parquet")).select(
        F.concat(F.lit("https://host/"), name).alias("url")
    )
    urls = present.unionByName(fx.urls.select("url"))
    jobs = urls.withColumn("position", F.crc32("url"))  # any fixed order will do here
    rows = load.load_manifest(spark, _store(fx), jobs, listing, "job-1")
    return rows.groupBy("job_id", "status", "error").agg(
        F.coalesce(F.sum("measurements"), F.lit(0)).alias("measurements")
    )
