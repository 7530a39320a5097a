"""Report files and the extractors that read pages and tables from them."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from filingmill.functions.exprs import stable_id
from filingmill.operators.register import content_hash

CELL = "struct<row_index:int,column_index:int,raw_text:string,bbox:array<double>,page_number:int>"
PAGES = "report_id string, page_number int, width double, height double, text string, error string"
TABLES = f"report_id string, extractor_name string, page_number int, table_index_on_page int, bbox array<double>, quality map<string,string>, cells array<{CELL}>, error string"


def report_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Files with their content and hash: (path, length, content, file_sha256)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return content_hash(files.select("path", "length", "content"))


def reports_of(files: DataFrame, market: str, created_at: Column, **metadata) -> DataFrame:
    """Rows of reports for files; the report_id is derived from the content."""
    out = files.select(
        stable_id(F.lit("report"), "file_sha256").alias("report_id"), "file_sha256", F.substring_index("path", "/", -1).alias("original_filename"), F.col("path").alias("stored_pdf_path"),
        F.lit(market).alias("market"), *[F.lit(v).alias(k) for k, v in metadata.items()], F.lit("pdf").alias("source_type"), F.lit(True).alias("is_text_pdf"), created_at.alias("created_at"),
    )
    return out.dropDuplicates(["file_sha256"])


class TableExtractor(Protocol):
    """Turns a file's bytes into tables: dicts with the fields of ``TABLES`` from extractor_name on."""

    name: str

    def tables(self, content: bytes) -> Iterator[dict]: ...


def grid_tables(name: str, page_number: int, index: int, grid: list[list], bbox=None, boxes: list | None = None) -> dict:
    """A table from a grid of texts; empty cells are null, and boxes run row by row."""
    cells, width = [], None
    for r, row in enumerate(grid):
        for c, text in enumerate(row):
            at = r * len(row) + c
            box = boxes[at] if boxes and at < len(boxes) else None
            cells.append({"row_index": r, "column_index": c, "raw_text": None if text in (None, "") else str(text), "bbox": list(map(float, box)) if box else None, "page_number": page_number})
        width = max(width or 0, len(row))
    return {"extractor_name": name, "page_number": page_number, "table_index_on_page": index, "bbox": list(map(float, bbox)) if bbox else None, "quality": {"rows": str(len(grid)), "columns": str(width or 0)}, "cells": cells}


class PdfPlumber:
    """Tables by the pdfplumber library, where it is installed."""

    name = "pdfplumber"

    def tables(self, content: bytes) -> Iterator[dict]:
        import pdfplumber

        with pdfplumber.open(io.BytesIO(content)) as pdf:
            for number, page in enumerate(pdf.pages, 1):
                for index, table in enumerate(page.find_tables()):
                    yield grid_tables(self.name, number, index, table.extract(), table.bbox, list(table.cells))


class Camelot:
    """Registered as a second extractor; not implemented."""

    name = "camelot"

    def tables(self, content: bytes) -> Iterator[dict]:
        raise NotImplementedError("the camelot extractor isn't implemented")


EXTRACTORS: dict[str, TableExtractor] = {e.name: e for e in (PdfPlumber(), Camelot())}


def pdf_pages(content: bytes) -> Iterator[dict]:
    """Page texts and sizes by PyMuPDF, where it is installed."""
    import fitz

    with fitz.open(stream=content, filetype="pdf") as document:
        for number, page in enumerate(document, 1):
            yield {"page_number": number, "width": page.rect.width, "height": page.rect.height, "text": page.get_text("text")}


def _each_file(files: DataFrame, read: Callable[[bytes], Iterator[dict]], schema: str) -> DataFrame:
    """Map (report_id, content) rows through a reader; a file that fails gives one row with its error."""
    arrow = to_arrow_schema(T.DataType.fromDDL(schema))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for report_id, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    rows = [{"report_id": report_id, "error": None, **r} for r in read(content.as_py())]
                except Exception as e:  # noqa: BLE001  one broken file must not end the batch; its error is a row
                    rows = [{"report_id": report_id, "error": f"{type(e).__name__}: {e}"}]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files.select("report_id", "content").mapInArrow(made, schema)


def read_pages(files: DataFrame, reader: Callable[[bytes], Iterator[dict]] = pdf_pages) -> DataFrame:
    return _each_file(files, reader, PAGES)


def read_tables(files: DataFrame, extractor: TableExtractor) -> DataFrame:
    return _each_file(files, extractor.tables, TABLES)
