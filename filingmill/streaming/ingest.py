"""Incremental registration of new report files as a stream that ends when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingmill.operators.register import content_hash, new_reports
from filingmill.sources.documents import reports_of
from filingmill.sources.store import Lake

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", pattern).load(path)
    return content_hash(files.select("path", "length", "content"))


def ingest(lake: Lake, path: str, checkpoint: str, market: str, pattern: str = "*.pdf", **metadata):
    """Register every new file below ``path``; a file whose content is known is passed over.

    Each micro-batch is held against the lake, which makes a replayed batch harmless.
    """

    def register(batch: DataFrame, epoch: int) -> None:
        rows = reports_of(batch, market, F.date_trunc("second", F.current_timestamp()), **metadata)
        lake.append("reports", new_reports(rows, lake.read("reports"), ["stored_pdf_path"]))

    return file_stream(lake.spark, path, pattern).writeStream.foreachBatch(register).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
