"""Registration by content hash, and run lifecycles as append-only events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_hash(files: DataFrame, column: str = "content") -> DataFrame:
    """Add ``file_sha256`` of a binary or text column."""
    return files.withColumn("file_sha256", F.sha2(F.col(column).cast("binary"), 256))


def first_by_hash(batch: DataFrame, order: list[str]) -> DataFrame:
    """The first row of every file hash of a batch; copies meet in a map-side aggregate, so a hot hash sends few rows."""
    others = [c for c in batch.columns if c != "file_sha256"]
    first = batch.groupBy("file_sha256").agg(F.min_by(F.struct(*others), F.struct(*order)).alias("r"))
    return first.select("file_sha256", "r.*").select(*batch.columns)


def new_reports(batch: DataFrame, reports: DataFrame, order: list[str]) -> DataFrame:
    """Rows of a batch whose hash isn't registered; metadata of known hashes is ignored."""
    return first_by_hash(batch.join(reports.select("file_sha256"), "file_sha256", "left_anti"), order)


def report_ids(batch: DataFrame, reports: DataFrame) -> DataFrame:
    """Every row of a batch with the registered report_id of its hash."""
    return batch.join(reports.select("file_sha256", "report_id"), "file_sha256", "left")


def latest_status(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last event of every key, as a struct ``last``; runs are never updated in place."""
    return events.groupBy(key).agg(F.max_by(F.struct(*[c for c in events.columns if c != key]), F.struct(*order)).alias("last"), F.count("*").alias("n_events"))


def latest_runs(runs: DataFrame) -> DataFrame:
    """The latest extraction run of every report."""
    return runs.groupBy("report_id").agg(F.max_by("extraction_run_id", F.struct("run_started_at", "extraction_run_id")).alias("extraction_run_id"))


def run_events(runs: DataFrame) -> DataFrame:
    """Extraction runs by their latest event; at the same time an end comes after the beginning."""
    at = runs.withColumns({"event_at": F.coalesce("run_finished_at", "run_started_at"), "event_number": (F.col("status") != "running").cast("int")})
    return latest_status(at, "extraction_run_id", ["event_at", "event_number"]).select("extraction_run_id", "last.*").drop("event_at", "event_number")
