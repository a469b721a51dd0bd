"""Station extract: CSV reading and the row-by-row rules as set operations."""

import csv
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerolake.operators.extract import (
    all_extract_errors,
    extract_errors,
    sampling_points_from_extract,
    stations_from_extract,
)
from aerolake.plans.dimension_tables import sampling_points_table, stations_table
from aerolake.plans.load import load_extract
from aerolake.sources.lookups import pollutant_seed
from aerolake.sources.station_extract import EXTRACT_COLUMNS, read_station_extract

HEADERS = ["Country", *EXTRACT_COLUMNS]
CODES = {"PM10": 1, "O3": 7, "NO2": 8}
COUNTRIES = {"IT", "ES"}


def write(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.DictWriter(handle, HEADERS, restval="")
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


def row(station, point, pollutant="NO2", **more):
    return {
        "Air Quality Station EoI Code": station,
        "Sampling Point Id": point,
        "Air Pollutant": pollutant,
    } | more


def countries(spark):
    return spark.createDataFrame([(c,) for c in COUNTRIES], "country_code string")


def test_row_numbers_and_text(spark, tmp_path):
    rows = [row("IT1", "a", Longitude=" 1.5 ", Municipality='Reggio, "nell"Emilia'), row("", ""), row("IT2", "007")]
    frame = read_station_extract(spark, write(tmp_path / "x.csv", rows))
    found = {r["row_num"]: r for r in frame.collect()}
    assert set(found) == {2, 3, 4}
    assert found[2]["longitude"] == " 1.5 " and found[2]["municipality"] == 'Reggio, "nell"Emilia'
    assert found[4]["sampling_point"] == "007" and found[3]["eoi_code"] == ""


def test_line_break_inside_quotes(spark, tmp_path):
    rows = [row("IT1", "a", Municipality="two\nlines"), row("IT2", "b")]
    path = write(tmp_path / "x.csv", rows)
    frame = read_station_extract(spark, path)
    found = {r["row_num"]: (r["eoi_code"], r["municipality"]) for r in frame.collect()}
    assert found == {2: ("IT1", "two\nlines"), 3: ("IT2", "")}


def test_row_numbers_over_many_splits(spark, tmp_path):
    rows = [row(f"IT{i}", f"p{i}") for i in range(5000)]
    path = write(tmp_path / "x.csv", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = read_station_extract(spark, path)
        assert frame.select(F.spark_partition_id()).distinct().count() > 1
        assert all(r["eoi_code"] == f"IT{r['row_num'] - 2}" for r in frame.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_only_csv_names(spark, tmp_path):
    with pytest.raises(ValueError):
        read_station_extract(spark, str(tmp_path / "x.txt"))


def sequential(rows):
    """The rules, one row after the other."""
    stations, points, errors = {}, {}, []
    for number, r in enumerate(rows, start=2):
        station, point = r["Air Quality Station EoI Code"].strip(), r["Sampling Point Id"].strip()
        if not station or not point:
            continue
        country = station[:2] if len(station) >= 2 else None
        if country not in COUNTRIES:
            errors.append((number, f"line {number}: station {station} left out, its country ({'none' if country is None else country}) is not registered"))
            continue
        stations.setdefault(station, (country, r.get("Air Quality Station Name", "").strip() or None))
        key = f"{country}/{point}"
        if key in points:
            continue
        name = r["Air Pollutant"].strip()
        if name in CODES:
            points[key] = (station, CODES[name])
        else:
            errors.append((number, f"line {number}: sampling point {key} left out, its pollutant ({name}) is not registered"))
    return stations, points, errors


def test_rules_equal_sequential_reading(spark, tmp_path):
    rows = [
        row(
            ["IT1", "IT2 ", "ES1", "FR1", "", "I", " IT3"][(i * 7) % 7 if i % 3 else i % 7],
            f" p{(i * i) % 11}" if i % 13 else " ",
            ["NO2", "XX", " O3 ", "", "PM10"][(i * 3 + i // 7) % 5],
            **{"Air Quality Station Name": f" n{i} " if i % 2 else " "},
        )
        for i in range(400)
    ]
    extract = read_station_extract(spark, write(tmp_path / "x.csv", rows)).repartition(5)
    stations, points, errors = sequential(rows)
    pollutants = pollutant_seed(spark)
    found = stations_from_extract(extract, countries(spark)).collect()
    assert {r["station_code"]: (r["country_code"], r["station_name"]) for r in found} == stations
    found = sampling_points_from_extract(extract, countries(spark), pollutants).collect()
    assert {r["sampling_point_id"]: (r["station_code"], r["pollutant_code"]) for r in found} == points
    args = (extract, countries(spark), pollutants)
    assert sorted(map(tuple, all_extract_errors(*args).collect())) == errors
    assert [tuple(r) for r in extract_errors(*args).collect()] == errors[:100]


def test_load_extract_twice(spark, tmp_path):
    rows = [row("IT1", "a"), row("IT1", "b", "XX"), row("FR1", "c"), row("ES1", "d", "O3")]
    path = write(tmp_path / "x.csv", rows)
    stations = stations_table(spark, str(tmp_path / "stations"))
    points = sampling_points_table(spark, str(tmp_path / "points"))

    def load():
        now = datetime(2024, 1, 1)
        return load_extract(spark, path, countries(spark), pollutant_seed(spark), stations, points, now)

    first, second = load(), load()
    assert (first["stations_created"], first["sampling_points_created"]) == (2, 2)
    assert (second["stations_updated"], second["stations_created"]) == (2, 0)
    assert [e[:7] for e in first["errors"]] == ["line 3:", "line 4:"] and first["errors"] == second["errors"]
    assert {r["sampling_point_id"] for r in points.read().collect()} == {"IT/a", "ES/d"}


def test_dates_numbers_and_metadata(spark, tmp_path):
    rows = [
        row(
            "IT1",
            "a",
            Latitude="45.5",
            Longitude="-999",
            Altitude="n/a",
            Timezone=" UTC ",
            **{"Operational Activity Begin": "01/02/2003 04:05:06", "Sample Id": "s1"},
        )
    ]
    extract = read_station_extract(spark, write(tmp_path / "x.csv", rows))
    station = stations_from_extract(extract, countries(spark)).first()
    assert (station["latitude"], station["longitude"], station["altitude"]) == (45.5, None, None)
    assert str(station["start_date"]) == "2003-02-01" and station["end_date"] is None
    assert station["metadata"] == {"nat_code": "", "network": "", "network_name": "", "timezone": "UTC"}
    point = sampling_points_from_extract(extract, countries(spark), pollutant_seed(spark)).first()
    assert point["start_date"] == datetime(2003, 2, 1, 4, 5, 6) and point["metadata"]["sample_id"] == "s1"
