"""Column functions against plain Python."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolake.functions import clean, codes, copytext, flags


def apply(spark, values, type_name, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {type_name}")
    return [r[1] for r in sorted(frame.select("i", expression(F.col("v"))).collect())]


few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def python_float(text):
    if not text or text.strip() == "" or text in ("-999.0", "-999"):
        return None
    try:
        return float(text)
    except ValueError:
        return None


@pytest.mark.parametrize(
    "text",
    ["1", " 2.5 ", "-999", "-999.0", " -999", "-999.00", "1e3", "1.5d", "1f", ".5", "5.", "+1", "", " \t", "n/a", "inf", "-Infinity", "1,5", "0x1A", None],
)
def test_sentinel_float(spark, text):
    assert apply(spark, [text], "string", clean.sentinel_float) == [python_float(text)]


@few
@given(st.lists(st.text(alphabet="0123456789.-+eE d\t", max_size=8), min_size=30, max_size=60))
def test_sentinel_float_random(spark, texts):
    assert apply(spark, texts, "string", clean.sentinel_float) == [python_float(t) for t in texts]


def python_date(text):
    if not text or text.strip() == "":
        return None
    try:
        return datetime.strptime(text, "%d/%m/%Y %H:%M:%S")
    except ValueError:
        return None


def test_extract_date(spark):
    texts = [
        "01/02/2020 03:04:05", "1/2/2020 3:4:5", "31/02/2020 00:00:00", "2020-02-01", " ", "", None,
        "01/02/2020", "01/02/2020 24:00:00", "001/02/2020 00:00:00", "01/02/20 00:00:00", "29/02/2024 23:59:59",
    ]
    found = apply(spark, texts, "string", lambda c: clean.extract_date(c).cast("timestamp_ntz"))
    assert found == [python_date(t) for t in texts]


def python_bytes(size):
    for unit in ["B", "KB", "MB", "GB", "TB"]:
        if size < 1024.0:
            return f"{size:.1f} {unit}"
        size /= 1024.0
    return f"{size:.1f} PB"


@few
@given(st.lists(st.integers(0, 2**55), min_size=30, max_size=60))
def test_format_bytes(spark, sizes):
    sizes = sizes + [0, 1023, 1024, 1280, 1792, 2**20 - 1, 2**20, 2**40, 2**50, 2**55]
    assert apply(spark, sizes, "bigint", clean.format_bytes) == [python_bytes(s) for s in sizes]


@few
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=30, max_size=60))
def test_copy_number(spark, numbers):
    numbers = numbers + [0.0, 1.0, 0.001, 0.00012, 1e-5, 12345678.5, 1e7, 123456789012345.6, 1e16, 1.5e20, 2.5e-7]
    found = apply(spark, numbers, "double", copytext._number)
    assert [float(text) for text in found] == numbers
    # the shortest text may differ in its last digit on older JVMs, never in its form
    short = [(t, repr(n)) for t, n in zip(found, numbers) if len(t) == len(repr(n))]
    assert all(t == r or float(t) == float(r) for t, r in short)


def test_copy_number_forms(spark):
    numbers = [25.5, 100.0, 0.0001, 0.00012, 1e-05, 12345678.5, 1e7, 1e16, 1.5e20, -0.0005, 1e100]
    assert apply(spark, numbers, "double", copytext._number) == [repr(n) for n in numbers]


def test_copy_line_escapes_and_nulls(spark):
    frame = spark.sql(
        r"""SELECT timestamp'2024-01-02 03:04:05.9' AS time, 'a\tb' AS sampling_point_id, 8 AS pollutant_code,
        CAST(NULL AS double) AS value, CAST(NULL AS string) AS unit, 'hour' AS aggregation_type, 1 AS validity,
        CAST(NULL AS int) AS verification, 75.0D AS data_capture, CAST(NULL AS timestamp) AS result_time, 'x' AS observation_id"""
    )
    line = frame.select(copytext.copy_line()).first()[0]
    assert line == "2024-01-02 03:04:05+00\ta\\tb\t8\t\\N\t\\N\thour\t1\t\\N\t75.0\t\\N\tx"


def test_codes(spark):
    ids = ["PT/SPO-PT02022_00008_100", "IT/SPO.IT0001_8_100", "x", "A/", "A/SPO-SPO-B_1/C", None]
    assert apply(spark, ids, "string", codes.station_of_sampling_point) == [
        "PT/PT02022", "IT/SPO.IT0001", None, "A/", "A/B", None
    ]
    assert apply(spark, ids, "string", codes.country_of_sampling_point) == ["PT", "IT", None, "A", "A", None]
    assert apply(spark, ["ES1047A", "E", "", "ES"], "string", codes.country_of_station) == ["ES", None, None, "ES"]
    urls = ["https://h/a/b.parquet", "https://h/a/b", "b"]
    assert apply(spark, urls, "string", codes.file_name_of_url) == ["b.parquet"] * 3


def test_three_meanings_of_valid(spark):
    values = [-99, -1, 0, 1, 2, 3, 4, None]
    assert apply(spark, values, "int", flags.at_least_valid) == [False, False, False, True, True, True, True, None]
    assert apply(spark, values, "int", flags.declared_valid)[3:] == [True, True, True, False, None]
    assert apply(spark, values, "int", flags.strictly_valid)[3:5] == [True, False]
    assert apply(spark, values, "int", lambda c: flags.text_of(c, flags.VALIDITY_TEXT))[3] == "Valid"
    assert apply(spark, [4, None], "int", lambda c: flags.text_of(c, flags.VALIDITY_TEXT)) == [None, None]


def test_iso_date(spark):
    texts = ["2020-02-01", "2020-02-01 10:00:00", "2020-02-01T10:00:00Z", "x", "", None]
    found = apply(spark, texts, "string", lambda c: clean.iso_date(c).cast("string"))
    assert found == ["2020-02-01"] * 3 + [None] * 3
