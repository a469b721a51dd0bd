"""Headline timings; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)

Sessions start and a warm-up run come first and are not timed. ``rates`` are records per second.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from datetime import date, datetime  # noqa: E402

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from aerolake import prepare  # noqa: E402
from aerolake.fixtures import Fixtures  # noqa: E402
from aerolake.operators import aggregates, extract, joins, ledger, slices  # noqa: E402
from aerolake.plans.daily_table import DailyTable  # noqa: E402
from aerolake.plans.load import load_manifest  # noqa: E402
from aerolake.plans.maintenance import compact_old_partitions  # noqa: E402
from aerolake.plans.measurement_store import MeasurementStore, copy_text  # noqa: E402
from aerolake.plans.point_days import PointDayTable  # noqa: E402
from aerolake.session import work_dir  # noqa: E402
from aerolake.sources.parquet_files import (  # noqa: E402
    list_files,
    measurements_of,
    read_measurement_files,
)
from aerolake.streaming.ingest import file_stream, stream_ingest  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def raw_lineitem(fx: Fixtures) -> DataFrame:
    """Line items as raw measurements under the new column names."""
    supplier = F.lpad(F.col("l_suppkey").cast("string"), 5, "0")
    return fx.table("lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("Start"),
        F.concat(F.lit("NL/SPO-NL"), supplier, F.lit("_00008_"), F.col("l_linenumber").cast("string")).alias("Samplingpoint"),
        F.lit(8).alias("Pollutant"),
        F.col("l_quantity").alias("Value"),
        F.lit("ug/m3").alias("Unit"),
        F.lit("hour").alias("AggType"),
        F.when(F.col("l_returnflag") == "R", -1).otherwise(1).alias("Validity"),
        F.lit(1).alias("Verification"),
        (F.col("l_discount") * 1000).alias("DataCapture"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("FkObservationLog"),
    )


def run_all(
    spark: SparkSession, fx: Fixtures, raw_path: str, times: dict[str, float]
) -> dict[str, int]:
    """Time every headline query; returns the rows that the rated ones handle."""
    def timed(name, action):
        begin = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - begin, 3)
        return result

    def consume(frame: DataFrame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    def parsed() -> DataFrame:
        return measurements_of(spark, read_measurement_files(spark, raw_path))

    def fresh(chunk_days: int) -> MeasurementStore:
        return MeasurementStore(spark, work_dir(spark, "bench"), chunk_days)

    order = ["file_path", "row_index"]
    sparse = 180  # line items: a few hundred rows a day, spread over years
    distinct = parsed().dropDuplicates(["time", "sampling_point_id"])
    unique_path = work_dir(spark, "unique")
    distinct.drop(*order).write.parquet(unique_path)
    unique = spark.read.parquet(unique_path)

    timed("parse", lambda: consume(parsed()))
    upserted = fresh(sparse)
    timed("parse_and_upsert", lambda: upserted.upsert(parsed(), order))
    copied = fresh(sparse)
    timed("bulk_copy", lambda: copied.copy(unique))
    timed("upsert_again", lambda: copied.upsert(unique, ["observation_id"]))
    timed("copy_text_export", lambda: consume(copy_text(unique)))
    january = unique.filter("time >= '1995-01-01' and time < '1995-03-01'")
    by_day = fresh(1)  # the default layout: one partition a day
    timed("bulk_copy_daily_chunks", lambda: by_day.copy(january))

    # whole loads, with their checks and ledgers
    listing = list_files(spark, raw_path, pattern="*.parquet")
    name = F.element_at(F.split("path", "/"), -1)
    urls = listing.select(F.concat(F.lit("https://host/"), name).alias("url"))
    urls = urls.withColumn("position", F.row_number().over(Window.orderBy("url")) - 1)
    timed("load_manifest", lambda: load_manifest(spark, fresh(sparse), urls, listing, "bench", upsert=True).count())
    arriving, checkpoint = file_stream(spark, raw_path), work_dir(spark, "stream")
    timed("stream_ingest", lambda: stream_ingest(arriving, fresh(sparse), checkpoint).awaitTermination())

    # the mapped events: dimensions as stored tables
    store = fresh(1)
    store.insert(fx.measurements)
    points_path = work_dir(spark, "points")
    fx.sampling_points.write.parquet(points_path)
    points = spark.read.parquet(points_path)
    facts = store.read()
    daily = DailyTable(spark, work_dir(spark, "daily"))
    timed("daily_measurements", lambda: consume(aggregates.daily_measurements(facts, points)))
    timed(
        "daily_measurements_large_dimension",
        lambda: consume(aggregates.daily_measurements(facts, points.hint("merge"))),
    )
    timed("refresh_daily_full", lambda: daily.refresh(store, points))
    window = (datetime(2024, 1, 10), datetime(2024, 1, 12))
    timed("refresh_daily_window", lambda: daily.refresh(store, points, *window))
    kept = PointDayTable(spark, work_dir(spark, "point-days"))
    timed("point_days_append", lambda: kept.append(facts, 0))
    span = {date(2024, 1, 10), date(2024, 1, 11)}
    timed("refresh_daily_from_points", lambda: daily.refresh_from(kept, points, span))
    timed("daily_status", lambda: aggregates.daily_status(daily.read()).collect())
    timed("data_quality", lambda: aggregates.data_quality(facts).collect())
    timed(
        "slice_measurements",
        lambda: consume(slices.slice_measurements(facts, points, "NB", 7, *window)),
    )
    timed("latest_by_sampling_point", lambda: consume(slices.latest_by_sampling_point(facts)))
    timed("latest_overall", lambda: store.latest().collect())
    timed(
        "fk_violations",
        lambda: consume(
            joins.fk_violations(
                facts, points, fx.stations, fx.countries, fx.pollutants, fx.validity_flags, fx.verification_status
            )
        ),
    )
    point = points.agg(F.min("sampling_point_id")).first()[0]
    timed(
        "delete_time_range",
        lambda: store.delete_time_range(point, datetime(2024, 1, 5), datetime(2024, 1, 8)),
    )
    timed(
        "extract",
        lambda: (
            consume(extract.stations_from_extract(fx.extract, fx.countries)),
            consume(extract.sampling_points_from_extract(fx.extract, fx.countries, fx.pollutants)),
            extract.extract_errors(fx.extract, fx.countries, fx.pollutants).collect(),
        ),
    )
    batches = ledger.batch_states(ledger.current_state(fx.ledger))
    timed("job_progress", lambda: consume(ledger.job_progress(batches)))
    timed(
        "compact",
        lambda: compact_old_partitions(
            store, work_dir(spark, "compaction"), datetime(2024, 3, 15)
        ),
    )


    rows = spark.read.parquet(raw_path).count()
    return {"parse": rows, "parse_and_upsert": rows, "bulk_copy": unique.count(), "upsert_again": unique.count()}


def main() -> None:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("aerolake-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    begin = time.perf_counter()
    spark = prepare(builder.getOrCreate())
    started = round(time.perf_counter() - begin, 3)
    spark.sparkContext.setLogLevel("ERROR")
    fx = Fixtures(spark, FOLDER)
    raw_path = work_dir(spark, "raw")
    raw_lineitem(fx).repartition(int(CPUS)).write.parquet(raw_path)
    rows = spark.read.parquet(raw_path).count()
    times: dict[str, float] = {}
    run_all(spark, fx, raw_path, {})
    handled = run_all(spark, fx, raw_path, times)
    rated = ["parse", "parse_and_upsert", "bulk_copy", "upsert_again"]
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "rows": rows,
                "rates": {name: round(handled[name] / times[name]) for name in rated},
                "session_start_sec": started,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
