"""Raw tables and cells: grids as rows of (table, row, column, text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.functions.exprs import normalized_text, or_null, stable_id


def grid_cells(df: DataFrame, key: list[str], text: str, row_sep: str = "\n", column_sep: str = " | ") -> DataFrame:
    """(key, row_index, column_index, raw_text): the cells of a text grid; empty cells are null, none is stripped."""
    quoted = "".join("\\" + c if c in "|\\.[]()*+?^$" else c for c in column_sep)
    rows = df.select(*key, F.posexplode(F.split(text, row_sep)).alias("row_index", "__row"))
    cells = rows.select(*key, "row_index", F.posexplode(F.split("__row", quoted)).alias("column_index", "__cell"))
    return cells.select(*key, "row_index", "column_index", or_null(F.col("__cell")).alias("raw_text"))


def exploded_tables(tables: DataFrame) -> DataFrame:
    """One row per cell of ``tables`` (…, cells array<struct<row_index,column_index,raw_text,bbox>>); tables without cells go."""
    some = tables.where(F.size("cells") > 0)
    return some.select(*[c for c in tables.columns if c != "cells"], F.posexplode("cells").alias("emit_order", "cell")).select("*", "cell.*").drop("cell")


def raw_cell_columns(cells: DataFrame) -> DataFrame:
    """Add the derived columns of a raw cell; the raw text stays as it is."""
    return cells.withColumns(
        {"raw_cell_id": stable_id("raw_table_id", "row_index", "column_index"), "normalized_text": normalized_text("raw_text"), "is_header_candidate": F.col("row_index") == 0}
    )


def raw_table_id() -> Column:
    return stable_id("extraction_run_id", "page_number", "table_index_on_page", "extractor_name")


def grid_size(cells: DataFrame, key: list[str]) -> DataFrame:
    """(key, row_count, column_count): the greatest index of each axis, plus one."""
    return cells.groupBy(*key).agg((F.max("row_index") + 1).alias("row_count"), (F.max("column_index") + 1).alias("column_count"))


def last_cells(cells: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, row_index, column_index, raw_text, raw_cell_id, bbox): one cell for each place of a grid.

    Of repeated ones the last by ``emit_order`` counts, where cells have one, else that of the greatest text.
    """
    order = [c for c in ("emit_order", "raw_text") if c in cells.columns]
    last = F.max_by(F.struct("raw_text", "raw_cell_id", "bbox"), F.struct(*order)).alias("c")
    return cells.groupBy(*key, "row_index", "column_index").agg(last).select(*key, "row_index", "column_index", "c.*")


def _line(cells: Column) -> Column:
    """Cells (at, t) sorted by place, each behind as many tabs as its place and that of the one before it differ by."""
    before = F.concat(F.array(F.lit(0)), F.transform(cells, lambda x: x["at"]))
    return F.array_join(F.zip_with(cells, F.slice(before, 1, F.size(cells)), lambda x, b: F.concat(F.repeat(F.lit("\t"), x["at"] - b), F.coalesce(x["t"], F.lit("")))), "")


def table_text(cells: DataFrame, key: list[str], order: str = "emit_order") -> DataFrame:
    """(key, raw_table_text): the dense grid with tabs and line feeds; gaps are empty, of equal places the last counts.

    A row's cells are sorted and joined with as many tabs as their places differ by, then a table's rows
    with line feeds and empty rows: time and memory are linear in the text.
    """
    last = cells.groupBy(*key, "row_index", "column_index").agg(F.max_by("raw_text", order).alias("t"))
    by_row = last.groupBy(*key, "row_index").agg(F.array_sort(F.collect_list(F.struct(F.col("column_index").alias("at"), "t"))).alias("cells"), F.max("column_index").alias("w"))
    lines = by_row.select(*key, "row_index", "w", _line(F.col("cells")).alias("line"))
    whole = lines.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col("row_index").alias("at"), "line", "w"))).alias("rows"), F.max("w").alias("w"), F.max("row_index").alias("h"))
    empty = F.repeat(F.lit("\t"), F.col("w"))
    full = lambda x: F.concat(x["line"], F.repeat(F.lit("\t"), F.col("w") - x["w"]))
    # rows that have no cells are lines of tabs alone
    before = F.concat(F.array(F.lit(-1)), F.transform("rows", lambda x: x["at"]))
    laid = F.zip_with("rows", F.slice(before, 1, F.size("rows")), lambda x, b: F.concat(F.repeat(F.concat(empty, F.lit("\n")), x["at"] - b - 1), full(x)))
    return whole.select(*key, F.array_join(laid, "\n").alias("raw_table_text"))


def cell_lines(cells: DataFrame, key: list[str], text: str = "raw_text") -> DataFrame:
    """(key, cell_text): the non-null cell texts in order of row and column, a line each."""
    held = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct("row_index", "column_index", F.col(text).alias("t")))))
    return cells.groupBy(*key).agg(F.array_join(F.transform(held, lambda x: x["t"]), "\n").alias("cell_text"))
