"""Structured Streaming ingestion into an index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from glimmerdex import decisions as D
from glimmerdex.operators import upsert
from glimmerdex.sources.index_store import IndexStore


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1, format: str = "parquet") -> DataFrame:
    """A folder as a queue: every trigger takes the next files."""
    return spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def trigger_of(commit: str = "now") -> dict:
    """'now' drains what is queued and stops; 'within' looks again every few seconds."""
    options = {"now": {"availableNow": True}, "within": {"processingTime": f"{D.COMMIT_WITHIN_SECONDS} seconds"}}
    if commit not in options:
        raise ValueError(f"commit must be one of {sorted(options)}, got {commit!r}")
    return options[commit]


def ingest_batch(
    store: IndexStore, build: Callable[[DataFrame, Column], DataFrame], job: str, batch: DataFrame,
    id_col: str = "id", text_col: str = "text", order_col: str | None = None,
) -> None:
    """Validate, build and upsert one batch as one named segment and one job row.

    A replayed batch writes the same segment and the same job row again.
    """
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    store.record_job(job, "processing")
    checked = upsert.validate(batch.withColumn("_order", order), id_col, text_col, "_order")
    checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = checked.agg(F.count(F.lit(1)).alias("n"), F.count("reason").alias("bad")).first()
        accepted = checked.filter(F.col("reason").isNull())
        store.upsert(build(accepted, F.col("_order")), segment=job, at_most=counts["n"] - counts["bad"])
        store.record_job(job, "completed", counts["n"], counts["n"] - counts["bad"], counts["bad"])
    except Exception as error:
        store.record_job(job, "failed", error=str(error))
        raise
    finally:
        checked.unpersist()


def start_ingest(
    store: IndexStore, stream: DataFrame, build: Callable[[DataFrame, Column], DataFrame], checkpoint: str,
    name: str = "ingest", commit: str = "now", id_col: str = "id", text_col: str = "text", order_col: str | None = None,
) -> StreamingQuery:
    """Start ingesting; micro-batch n becomes segment and job `<name>-n`."""
    store.require(create_if_missing=True)

    def each(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(store, build, f"{name}-{batch_id:09d}", batch, id_col, text_col, order_col)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(commit))
        .start()
    )


def wait(query: StreamingQuery, timeout: int = D.INGEST_TIMEOUT_SECONDS) -> None:
    """Block until the query is done; failure and timeout are errors."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"still ingesting after {timeout} seconds")


def job_counts(jobs: DataFrame) -> DataFrame:
    """(state, jobs, processed, success, failed)."""
    return jobs.groupBy("state").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.sum("processed").alias("processed"),
        F.sum("success").alias("success"),
        F.sum("failed").alias("failed"),
    )
