"""Fixed warehouse schemas and the raw-file vocabulary."""

from __future__ import annotations

from pyspark.sql import types as T

COUNTRIES = T.StructType(
    [
        T.StructField("country_code", T.StringType(), False),
        T.StructField("country_name", T.StringType(), False),
        T.StructField("region", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

POLLUTANTS = T.StructType(
    [
        T.StructField("pollutant_code", T.IntegerType(), False),
        T.StructField("pollutant_name", T.StringType(), False),
        T.StructField("pollutant_label", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

VALIDITY_FLAGS = T.StructType(
    [
        T.StructField("validity_code", T.IntegerType(), False),
        T.StructField("validity_name", T.StringType(), False),
        T.StructField("description", T.StringType()),
    ]
)

VERIFICATION_STATUS = T.StructType(
    [
        T.StructField("verification_code", T.IntegerType(), False),
        T.StructField("verification_name", T.StringType(), False),
        T.StructField("description", T.StringType()),
    ]
)

STATIONS = T.StructType(
    [
        T.StructField("station_code", T.StringType(), False),
        T.StructField("country_code", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("station_type", T.StringType()),
        T.StructField("area_type", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("altitude", T.DoubleType()),
        T.StructField("municipality", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

SAMPLING_POINTS = T.StructType(
    [
        T.StructField("sampling_point_id", T.StringType(), False),
        T.StructField("station_code", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("instrument_type", T.StringType()),
        T.StructField("pollutant_code", T.IntegerType()),
        T.StructField("start_date", T.TimestampType()),
        T.StructField("end_date", T.TimestampType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# Column order is the order of the text export.
MEASUREMENTS = T.StructType(
    [
        T.StructField("time", T.TimestampType(), False),
        T.StructField("sampling_point_id", T.StringType(), False),
        T.StructField("pollutant_code", T.IntegerType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("aggregation_type", T.StringType()),
        T.StructField("validity", T.IntegerType()),
        T.StructField("verification", T.IntegerType()),
        T.StructField("data_capture", T.DoubleType()),
        T.StructField("result_time", T.TimestampType()),
        T.StructField("observation_id", T.StringType()),
    ]
)
MEASUREMENT_KEY = ["time", "sampling_point_id"]

DAILY = T.StructType(
    [
        T.StructField("day", T.DateType(), False),
        T.StructField("station_code", T.StringType()),
        T.StructField("pollutant_code", T.IntegerType(), False),
        T.StructField("avg_value", T.DoubleType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("stddev_value", T.DoubleType()),
        T.StructField("count", T.LongType(), False),
        T.StructField("first_measurement", T.TimestampType()),
        T.StructField("last_measurement", T.TimestampType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("job_id", T.StringType(), False),
        T.StructField("batch_no", T.IntegerType(), False),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("measurements", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("event_time", T.TimestampType(), False),
    ]
)

# Warehouse column -> raw file column names, oldest naming first.
# Where a file carries both names the first one wins.
MEASUREMENT_NAMES = {
    "time": ["DatetimeBegin", "Start"],
    "sampling_point_id": ["SamplingPoint", "Samplingpoint"],
    "pollutant_code": ["AirPollutantCode", "Pollutant"],
    "value": ["Concentration", "Value"],
    "unit": ["UnitOfMeasurement", "Unit"],
    "aggregation_type": ["AggregationType", "AggType"],
    "validity": ["Validity"],
    "verification": ["Verification"],
    "data_capture": ["DataCapture"],
    "result_time": ["ResultTime"],
    "observation_id": ["ObservationId", "FkObservationLog"],
}
STATION_NAMES = {
    "station_code": ["AirQualityStationEoICode"],
    "country_code": ["Countrycode"],
    "station_name": ["AirQualityStationName"],
    "station_type": ["AirQualityStationType"],
    "area_type": ["AirQualityStationArea"],
    "latitude": ["Latitude"],
    "longitude": ["Longitude"],
    "altitude": ["Altitude"],
    "municipality": ["Municipality"],
}
# Mapped names that no entity uses, but which a harmonised frame keeps.
OTHER_NAMES = {
    "start_date": ["AirQualityStationStartDate"],
    "end_date": ["AirQualityStationEndDate"],
    "sp_start_date": ["SamplingPointStartDate"],
    "sp_end_date": ["SamplingPointEndDate"],
    "datetime_end": ["DatetimeEnd", "End"],
}
RAW_NAMES = {**STATION_NAMES, **OTHER_NAMES, **MEASUREMENT_NAMES}
