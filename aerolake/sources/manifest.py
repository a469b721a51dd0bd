"""Lists of files to load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.clean import strip
from aerolake.functions.codes import file_name_of_url
from aerolake.sources.order import FILE_ORDER, number_rows, with_file_order


class EmptyManifestError(ValueError):
    """A manifest without a single URL."""


def read_url_manifest(spark: SparkSession, path: str, check_empty: bool = True) -> DataFrame:
    """One URL per line; blank lines and lines starting with ``#`` are skipped.

    Returns ``url`` and ``position`` (0-based, file order).
    """
    lines = with_file_order(spark.read.text(path)).withColumn("url", strip(F.col("value")))
    urls = lines.filter((F.col("url") != "") & ~F.col("url").startswith("#"))
    if check_empty and urls.isEmpty():
        raise EmptyManifestError(f"no URL in {path}")
    return number_rows(urls, FILE_ORDER[:2], FILE_ORDER[2:]).select("url", "position")


def read_url_list(spark: SparkSession, path: str, max_urls: int | None = None) -> DataFrame:
    """One URL per line below a header line; the first ``max_urls`` in file order."""
    lines = (
        spark.read.option("header", True)
        .option("sep", "\x01")  # never occurs: a line is one field
        .option("quote", "")
        .schema("url string")
        .csv(path, enforceSchema=True)
    )
    urls = with_file_order(lines).withColumn("url", strip(F.col("url"))).filter("url <> ''")
    if max_urls is None:
        return urls.select("url")
    return urls.orderBy(*FILE_ORDER).limit(max_urls).select("url")


def first_files(manifest: DataFrame, max_files: int | None) -> DataFrame:
    """The first ``max_files`` of a manifest in order; no limit gives all."""
    if not max_files:
        return manifest
    return manifest.filter(F.col("position") < max_files)


def local_copies(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Match manifest URLs to files already at hand, by file name.

    ``listing`` has ``path``. Returns ``url, path``; ``path`` is NULL where no copy exists.
    """
    urls = manifest.select("url").distinct()
    named = urls.select("url", file_name_of_url(F.col("url")).alias("file_name"))
    files = listing.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    return named.join(files, "file_name", "left").select("url", "path")
