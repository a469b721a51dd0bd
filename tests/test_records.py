"""CSV records of split files against the csv module."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from aerolake.sources.records import read_csv_text, read_records
from aerolake.sources.station_extract import EXTRACT_COLUMNS, read_station_extract


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value(rng):
    kind = rng.randrange(7)
    word = "".join(rng.choices("abc é", k=rng.randrange(0, 6)))
    if kind < 3:
        return word
    if kind == 3:
        return f'{word or "x"}5" pipe'  # an ordinary quote
    inner = rng.choice(["a\nb", 'say ""yes""', ", ", "\n\n", '""', 'one\n""two"",\nthree', ""])
    return f'"{word}{inner}"'


def write(path, seed, n):
    rng = random.Random(seed)
    lines = ["one,two,three"]
    for i in range(n):
        lines.append(f"{i},{value(rng)},{value(rng)}")
        if rng.random() < 0.1:
            lines.append("")
    path.write_text("\n".join(lines) + rng.choice(["", "\n"]), encoding="utf-8")
    with open(path, newline="", encoding="utf-8") as handle:
        return [row for row in csv.reader(handle) if row][1:]


def found(frame):
    rows = frame.select("_file", "record", "c0", "c1", "c2").collect()
    out = {}
    for r in rows:
        name = r["_file"].rsplit("/", 1)[1]
        assert (name, r["record"]) not in out
        out[name, r["record"]] = [v or "" for v in r[2:]]
    return out


def test_records_equal_the_csv_module(spark, tmp_path, small_splits):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    want = {}
    for i in range(6):
        name = f"f{i}.csv"
        for number, row in enumerate(write(folder / name, i, (0, 1, 7, 60, 60, 120)[i]), 1):
            want[name, number] = row
    frame, names = read_csv_text(spark, str(folder))
    assert names == ["one", "two", "three"]
    assert found(frame) == want


def test_a_file_with_breaks_is_split(spark, tmp_path, small_splits):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    write(folder / "f.csv", 3, 200)
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
    records = read_records(spark, str(folder))
    whole = records.filter(~F.col("text").contains("\n"))
    assert whole.select(F.spark_partition_id()).distinct().count() > 5


def test_record_over_several_splits(spark, tmp_path, small_splits):
    path = tmp_path / "x.csv"
    long = "\n".join(f'line {i} ""q"", x' for i in range(60))
    path.write_text(f'a,b\n1,"{long}"\n2,"short"\n', encoding="utf-8")
    frame, _ = read_csv_text(spark, str(path))
    rows = {r["record"]: (r["c0"], r["c1"]) for r in frame.collect()}
    assert rows == {1: ("1", long.replace('""', '"')), 2: ("2", "short")}


def test_open_quotes_other_headers_and_nothing(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,"never closed\n2,x\n', encoding="utf-8")
    with pytest.raises(ValueError, match="left open"):
        read_csv_text(spark, str(path))
    path.write_text("", encoding="utf-8")
    with pytest.raises(ValueError, match="no header"):
        read_csv_text(spark, str(path))
    folder = tmp_path / "y.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    (folder / "2.csv").write_text("b,a\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="another header in .*2.csv"):
        read_csv_text(spark, str(folder))


def test_header_with_breaks_and_windows_line_ends(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes(b'\xef\xbb\xbf"a\r\nb",c\r\n1,"x\r\ny"\r\n\r\n2,\r\n')
    frame, names = read_csv_text(spark, str(path))
    assert names == ["a\nb", "c"]
    assert {r["record"]: (r["c0"], r["c1"] or "") for r in frame.collect()} == {1: ("1", "x\ny"), 2: ("2", "")}


def test_extract_with_breaks_keeps_row_numbers(spark, tmp_path, small_splits):
    headers = list(EXTRACT_COLUMNS)
    path = tmp_path / "x.csv"
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.DictWriter(handle, headers, restval="")
        writer.writeheader()
        for i in range(40):
            broken = f"two\nlines {i}" if i % 3 == 0 else f"one {i}"
            writer.writerow({headers[0]: f"IT{i}", "Municipality": broken})
    rows = {r["row_num"]: (r["eoi_code"], r["municipality"]) for r in read_station_extract(spark, str(path)).collect()}
    assert rows == {i + 2: (f"IT{i}", f"two\nlines {i}" if i % 3 == 0 else f"one {i}") for i in range(40)}
