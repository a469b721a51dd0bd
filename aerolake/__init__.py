"""Air-quality measurement engine built on Spark DataFrames.

Layers, from the inside out:

* ``functions``  column expressions: parsing, cleaning, flag predicates
* ``sources``    readers: raw Parquet files, station extracts, manifests, lookups
* ``operators``  DataFrame -> DataFrame transforms
* ``plans``      operations on stored tables: load, upsert, refresh, compact
* ``streaming``  Structured Streaming forms of ingest and daily aggregate
"""

from aerolake.session import build_session, prepare

__all__ = ["build_session", "prepare"]
