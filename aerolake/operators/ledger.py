"""Ingest ledger: append-only events, one per state change of a file, and its roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.operators.keys import keep_last
from aerolake.sources.order import number_rows

PENDING, RUNNING, COMPLETED, FAILED = "pending", "running", "completed", "failed"
MAX_DIRECT_URLS = 50
BATCH_SIZE = 50


def current_state(ledger: DataFrame) -> DataFrame:
    """The last event of each file of each job (events with the same time: by status order)."""
    stage = F.when(F.col("status") == PENDING, 0).when(F.col("status") == RUNNING, 1).otherwise(2)
    events = ledger.withColumn("_stage", stage)
    return keep_last(events, ["job_id", "batch_no", "url"], ["event_time", "_stage"]).drop("_stage")


def duration_seconds(started: Column, ended: Column) -> Column:
    return (F.unix_micros(ended) - F.unix_micros(started)) / F.lit(1000000.0)


def batch_states(files: DataFrame) -> DataFrame:
    """Roll current file states up to batches.

    A file event without a URL speaks for its whole batch, which then failed as such. A batch
    whose files have all ended is completed even if some of them failed.
    """
    is_file = F.col("url").isNotNull()
    done, lost = F.col("status") == COMPLETED, F.col("status") == FAILED
    ended = F.count_if(is_file & (done | lost)) == F.count_if(is_file)
    status = (
        F.when(F.count_if(~is_file & lost) > 0, FAILED)
        .when(ended, COMPLETED)
        .when(F.count_if(is_file & (F.col("status") != PENDING)) > 0, RUNNING)
        .otherwise(PENDING)
    )
    return files.groupBy("job_id", "batch_no").agg(
        status.alias("status"),
        F.count_if(is_file).alias("urls"),
        F.count_if(is_file & done).alias("succeeded"),
        F.count_if(is_file & lost).alias("failed"),
        F.min("created_at").alias("created_at"),
        F.min("started_at").alias("started_at"),
        F.when(status.isin(COMPLETED, FAILED), F.max("ended_at")).alias("ended_at"),
        F.max(F.when(~is_file, F.col("error"))).alias("error"),
    )


def batch_durations(batches: DataFrame) -> DataFrame:
    """Seconds from start to end; NULL for a batch that has not ended."""
    return batches.select(
        "job_id",
        "batch_no",
        duration_seconds(F.col("started_at"), F.col("ended_at")).alias("duration_seconds"),
    )


def _batches_in(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def job_progress(batches: DataFrame) -> DataFrame:
    """Per job: batches by state, files by outcome, completed batches in percent."""
    completed = _batches_in(COMPLETED)
    return batches.groupBy("job_id").agg(
        F.count("*").alias("total_batches"),
        completed.alias("batches_completed"),
        _batches_in(FAILED).alias("batches_failed"),
        _batches_in(RUNNING).alias("batches_running"),
        _batches_in(PENDING).alias("batches_pending"),
        F.sum("succeeded").alias("urls_succeeded"),
        F.sum("failed").alias("urls_failed"),
        F.round(completed / F.count("*") * 100.0, 2).alias("completion_pct"),
    )


def job_status(jobs: DataFrame, batches: DataFrame, strict: bool = False) -> DataFrame:
    """Overall status of each job; ``jobs`` has every ``job_id``, also those without batches.

    A finished mix of completed and failed batches still reads as running. ``strict`` is the
    rule for short URL lists: once all files have ended, any failed file fails the job.
    """
    total, completed, failed = F.count("status"), _batches_in(COMPLETED), _batches_in(FAILED)
    status = (
        F.when(total == 0, "created")
        .when(completed == total, COMPLETED)
        .when(failed == total, FAILED)
        .when(_batches_in(RUNNING) > 0, RUNNING)
        .when(completed + failed > 0, RUNNING)
        .otherwise(PENDING)
    )
    if strict:
        ended = (total > 0) & (completed + failed == total)
        any_failed = (failed > 0) | (F.sum("failed") > 0)
        status = F.when(ended & any_failed, FAILED).otherwise(status)
    return (
        jobs.select("job_id")
        .join(batches.select("job_id", "status", "failed"), "job_id", "left")
        .groupBy("job_id")
        .agg(status.alias("status"))
    )


def file_load_stats(files: DataFrame) -> DataFrame:
    """Per loaded file: measurements, seconds and measurements per second (0 if no time)."""
    seconds = duration_seconds(F.col("started_at"), F.col("ended_at"))
    rate = F.when(seconds > 0, F.col("measurements") / seconds).otherwise(F.lit(0.0))
    return files.filter(F.col("status") == COMPLETED).select(
        "job_id",
        "url",
        "measurements",
        seconds.alias("seconds"),
        rate.alias("throughput"),
    )


def batch_load_stats(files: DataFrame) -> DataFrame:
    """One row of totals over file results.

    Entity columns that the ledger does not carry count as 0, as in a run that loads
    measurements only.
    """
    is_file = F.col("url").isNotNull()
    done = is_file & (F.col("status") == COMPLETED)

    def total(name: str) -> Column:
        if name not in files.columns:
            return F.lit(0).cast("bigint")
        return F.coalesce(F.sum(F.when(done, F.col(name))), F.lit(0))

    return files.agg(
        F.count_if(done).alias("files_processed"),
        total("stations").alias("stations"),
        total("sampling_points").alias("sampling_points"),
        total("measurements").alias("measurements"),
        F.count_if(is_file & (F.col("status") == FAILED)).alias("errors"),
    )


def failed_files(manifest: DataFrame, loaded: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest URLs that did not load, with ``url: error`` (error of the ledger, if any)."""
    errors = files.filter(F.col("error").isNotNull()).groupBy("url").agg(F.max("error").alias("error"))
    return (
        manifest.select("url")
        .distinct()
        .join(loaded.select("url"), "url", "left_anti")
        .join(errors, "url", "left")
        .select(
            "url",
            F.concat("url", F.lit(": "), F.coalesce("error", F.lit("not loaded"))).alias("message"),
        )
    )


def recent_jobs(files: DataFrame, limit: int = 50) -> DataFrame:
    """Newest jobs first."""
    return (
        files.groupBy("job_id")
        .agg(F.min("created_at").alias("created_at"), F.count("url").alias("total_urls"))
        .orderBy(F.desc("created_at"), F.desc("job_id"))
        .limit(limit)
    )


def job_detail(batches: DataFrame, job_id: str) -> DataFrame:
    """The batch rows of one job, flat: a job may have any number of batches."""
    return batches.filter(F.col("job_id") == F.lit(job_id)).select(
        "*", duration_seconds(F.col("started_at"), F.col("ended_at")).alias("duration_seconds")
    )


def cut_batches(manifest: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Cut a numbered manifest (``url, position``) into batches of ``size``, order kept."""
    entries = F.array_sort(F.collect_list(F.struct("position", "url")))  # at most ``size`` each
    return (
        manifest.groupBy(F.floor(F.col("position") / size).cast("int").alias("batch_no"))
        .agg(entries.alias("entries"))
        .select(
            "batch_no",
            F.size("entries").alias("urls_count"),
            F.col("entries.url").alias("urls"),
        )
    )


def numbered(rows: DataFrame, order: str, span: int = 100_000) -> DataFrame:
    """Number rows by an integer column; buckets of ``span`` values are ranked in parallel."""
    bucketed = rows.withColumn("_bucket", F.floor(F.col(order) / span))
    return number_rows(bucketed, ["_bucket"], [order]).drop("_bucket")


def check_direct_batch(urls: list[str]) -> list[str]:
    """A directly submitted batch must have 1 to 50 URLs."""
    if not urls:
        raise ValueError("the URL list is empty")
    if len(urls) > MAX_DIRECT_URLS:
        raise ValueError(f"at most {MAX_DIRECT_URLS} URLs in one batch")
    return urls


def load_estimate(jobs: DataFrame, concurrent_batches: int = 3) -> DataFrame:
    """Minutes a job will take, from 2.4 minutes for each round of concurrent batches.

    ``jobs`` has ``total_urls``.
    """
    per_round = concurrent_batches * BATCH_SIZE
    minutes = F.col("total_urls") / F.lit(float(per_round)) * F.lit(2.4)
    return jobs.select("*", F.round(minutes, 1).alias("estimated_minutes"))
