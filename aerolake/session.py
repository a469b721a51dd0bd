"""Session settings and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings every operator relies on. Days are UTC days; AQE coalesces small
# partitions, splits skewed joins and skewed rebalances, and swaps in broadcast
# joins once it has seen the real size of a side.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "aerolake", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="aerolake-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for staged tables.

    Lives under the shared folder of ``spark.checkpoint.dir``, so that every executor
    sees it. Without that setting only a local master may fall back to a temporary
    folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/aerolake/{label}-{uuid.uuid4().hex}"


@lru_cache(maxsize=8)
def _ship(application_id: str, context) -> None:
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="aerolake-ship-")
    archive = shutil.make_archive(
        f"{folder}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the executors, once for each application.

    Functions that run in tasks are then found from wherever the driver was started. The
    archive is handed out by the driver's file server, so its folder need not be shared.
    """
    context = spark.sparkContext
    _ship(context.applicationId, context)
