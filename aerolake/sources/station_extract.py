"""The station extract: a CSV with a header, every field text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.sources.records import read_csv_text

# Extract header -> our column name.
EXTRACT_COLUMNS = {
    "Air Quality Station EoI Code": "eoi_code",
    "Air Quality Station Nat Code": "nat_code",
    "Air Quality Station Name": "station_name",
    "Air Quality Station Area": "area_type",
    "Air Quality Station Type": "station_type",
    "Air Quality Network": "network",
    "Air Quality Network Name": "network_name",
    "Timezone": "timezone",
    "Longitude": "longitude",
    "Latitude": "latitude",
    "Altitude": "altitude",
    "Municipality": "municipality",
    "Sampling Point Id": "sampling_point",
    "Air Pollutant": "pollutant_name",
    "Operational Activity Begin": "activity_begin",
    "Operational Activity End": "activity_end",
    "Sample Id": "sample_id",
    "Process Id": "process_id",
    "Measurement Type": "measurement_type",
    "Measurement Method": "measurement_method",
}


def read_station_extract(spark: SparkSession, path: str) -> DataFrame:
    """Extract rows under our column names, with ``row_num`` (the header is row 1).

    Absent columns read as empty text. Values may hold line breaks inside quotes; every file is
    split over tasks all the same (see ``records``).
    """
    if not path.rstrip("/").endswith(".csv"):
        raise ValueError("a station extract must be a .csv file")
    rows, headers = read_csv_text(spark, path)
    # of a repeated header the last column holds
    places = {header: f"c{i}" for i, header in enumerate(headers)}
    values = [
        (F.coalesce(places[header], F.lit("")) if header in places else F.lit("")).alias(name)
        for header, name in EXTRACT_COLUMNS.items()
    ]
    return rows.select(*values, (F.col("record") + 1).cast("bigint").alias("row_num"))
