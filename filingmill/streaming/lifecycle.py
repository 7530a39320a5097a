"""Runs that never ended: a stream of run events with a timer for each run, which fails what is overdue."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from filingmill.operators.register import run_events
from filingmill.sources.schemas import SCHEMAS
from filingmill.sources.store import Lake

OVERDUE = "extraction_run_id string, run_started_at timestamp, run_finished_at timestamp"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Lifecycle(StatefulProcessor):
    """A run's state: when it began, when its timer rings, and whether it has ended.

    Events of a run may come in any order and more than once: an end counts also before its beginning. The state of an
    ended run goes when its timer rings, so state is held for the runs of the last ``limit`` alone.
    """

    def __init__(self, limit: timedelta) -> None:
        self.limit = int(limit.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "began bigint, due bigint, ended boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.run.get() if self.run.exists() else None
        began, due, ended = held if held else (None, None, False)
        for batch in rows:
            times = [int(t.timestamp() * 1000) for t in batch["event_at"]]
            starts = [t for t, s in zip(times, batch["status"]) if s == "running"]
            if starts:
                began = min(starts if began is None else [began, *starts])
            ended = ended or len(starts) < len(times)
            if due is None or began is not None:
                first = (min(times) if began is None else began) + self.limit
                if first != due:
                    if due is not None:
                        self.handle.deleteTimer(due)
                    due = first
                    self.handle.registerTimer(due)
        self.run.update((began, due, ended))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        began, due, ended = self.run.get() if self.run.exists() else (None, None, True)
        self.run.clear()
        if not ended and began is not None:
            at = [pd.Timestamp(t, unit="ms", tz="UTC") for t in (began, due)]
            yield pd.DataFrame({"extraction_run_id": [key[0]], "run_started_at": [at[0]], "run_finished_at": [at[1]]})

    def close(self) -> None:
        pass


def overdue_runs(events: DataFrame, limit: timedelta, delay: timedelta) -> DataFrame:
    """(extraction_run_id, run_started_at, run_finished_at) of runs without an end ``limit`` after their beginning.

    ``events`` is a stream of (extraction_run_id, event_at, status). Its time is that of the latest event less ``delay``: events that
    are late by no more are heeded, whatever their order; later ones are passed over. Rows with a null are left out.
    """
    kept = events.select("extraction_run_id", "event_at", "status").dropna().withWatermark("event_at", f"{int(delay.total_seconds())} seconds")
    return kept.groupBy("extraction_run_id").transformWithStateInPandas(Lifecycle(limit), OVERDUE, "append", "eventTime")


def fail_overdue(lake: Lake, overdue: DataFrame) -> None:
    """Append a failed event for runs that the lake still has as running; the others have ended meanwhile, or were never committed."""
    runs = run_events(lake.read("extraction_runs")).where("status = 'running'").drop("run_finished_at", "status", "error_message")
    due = overdue.groupBy("extraction_run_id").agg(F.min("run_finished_at").alias("run_finished_at"))
    rows = runs.join(due, "extraction_run_id").withColumns({"status": F.lit("failed"), "error_message": F.lit("overdue: the run never ended")})
    if not rows.isEmpty():
        lake.append("extraction_runs", rows)


def watch(lake: Lake, checkpoint: str, limit: timedelta, delay: timedelta):
    """Fail the overdue runs of a lake; the query ends when it has caught up, and goes on from ``checkpoint`` the next time.

    Compaction shows events again, and a batch may be repeated: both are harmless, as ends are kept and the lake is asked before
    anything is written.
    """
    spark = lake.spark
    folder = f"{lake._path('extraction_runs')}/rows"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    rows = spark.readStream.schema(SCHEMAS["extraction_runs"]).option("recursiveFileLookup", "true").parquet(folder)
    events = rows.withColumn("event_at", F.coalesce("run_finished_at", "run_started_at"))
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # timers need it; a query keeps the settings that it starts with
    try:
        stream = overdue_runs(events, limit, delay).writeStream.outputMode("append").foreachBatch(lambda batch, epoch: fail_overdue(lake, batch))
        return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before)
