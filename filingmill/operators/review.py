"""The review workbook's sheets as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sheets and columns of the workbook.
RAW_SHEETS = ("balance_sheet_raw", "income_statement_raw", "cash_flow_raw", "notes_revenue_raw")
SHEETS = ("summary", "validation_failures", *RAW_SHEETS, "corrections", "_metadata")
ROLE_SHEETS = {"statement.balance_sheet": "balance_sheet_raw", "statement.income_statement": "income_statement_raw", "statement.cash_flow": "cash_flow_raw", "note.revenue": "notes_revenue_raw"}
FAILURE_COLUMNS = "validation_result_id rule_id severity status message involved_fact_ids lhs_value rhs_value difference_value source_pages suggested_action".split()
RAW_COLUMNS = """fact_id raw_table_id raw_cell_id extractor_name page_number table_index_on_page row_index column_index cell_bbox_json table_role statement_scope period_basis period_start
period_end instant_date raw_label normalized_concept_id raw_value raw_unit currency scale_factor normalized_value validation_status review_hint""".split()
CORRECTION_COLUMNS = "fact_id correction_action corrected_value corrected_unit normalized_concept_id period_basis statement_scope table_role correction_reason".split()
METADATA_KEYS = "workbook_schema_version report_id extraction_run_id review_export_id rule_pack_version exported_at".split()
LAST_DISPLAY = 10_000
_HEADS = {"summary": ["field", "value"], "validation_failures": FAILURE_COLUMNS} | {s: RAW_COLUMNS for s in RAW_SHEETS} | {"corrections": CORRECTION_COLUMNS, "_metadata": ["key", "value"]}


def target_sheet(role: str | Column = "table_role", explicit: str | Column | None = None, prefixes: bool = False) -> Column:
    """The sheet of a raw row: an explicit one, else that of its role; null drops the row.

    With ``prefixes`` every role below note.revenue goes to the notes sheet.
    """
    role = F.col(role) if isinstance(role, str) else role
    out = F.lit(None).cast("string")
    for name, sheet in ROLE_SHEETS.items():
        out = F.when(role == name, sheet).otherwise(out)
    if prefixes:
        out = F.when(role.startswith("note.revenue"), "notes_revenue_raw").otherwise(out)
    if explicit is not None:
        own = F.col(explicit) if isinstance(explicit, str) else explicit
        out = F.coalesce(own, out)
    return F.when(out.isin(*RAW_SHEETS), out)


def as_cell(df: DataFrame, column: str) -> Column:
    """A column in the form of a workbook cell: collections as JSON, the rest as text."""
    kind = dict(df.dtypes)[column]
    return (F.to_json(column) if kind.startswith(("array", "map", "struct")) else F.col(column).cast("string")).alias(column)


def fitted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns as cells, missing ones null."""
    return df.select(*[as_cell(df, c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def failures(results: DataFrame) -> DataFrame:
    """The validation_failures sheet: results that aren't verified."""
    return fitted(results.where(~F.col("status").startswith("verified")), FAILURE_COLUMNS)


def display_columns(names: Sequence[str]) -> list[str]:
    """display_col_N names in numeric order, odd ones last."""

    def place(name: str) -> tuple[int, str]:
        tail = name.removeprefix("display_col_")
        return (int(tail) if tail.isdigit() else LAST_DISPLAY, name)

    return sorted({n for n in names if n.startswith("display_col_")}, key=place)


def display_cells(cells: DataFrame, key: Sequence[str], text: str = "raw_text") -> DataFrame:
    """(key, row_index, display): a row's cells that aren't null as a map from their column; one pass whatever the grids' widths.

    Of repeated cells the greatest text counts. The driver plans nothing by column, so one very wide grid costs its own row alone.
    """
    one = cells.groupBy(*key, "row_index", "column_index").agg(F.max(text).alias("t"))
    held = F.array_sort(F.collect_list(F.when(F.col("t").isNotNull(), F.struct("column_index", "t"))))
    return one.groupBy(*key, "row_index").agg(F.map_from_entries(held).alias("display"))


def with_display(cells: DataFrame, key: Sequence[str], width: int | None = None, text: str = "raw_text") -> DataFrame:
    """``display_cells`` as columns display_col_0 … up to the widest grid's last one, for one report's workbook.

    One aggregate finds the width; a stated ``width`` leaves out the cells beyond it.
    """
    shown = display_cells(cells, key, text)
    if width is None:
        width = (cells.agg(F.max("column_index").alias("m")).first()["m"] or 0) + 1
    return shown.select(*key, "row_index", *[F.try_element_at("display", F.lit(i)).alias(f"display_col_{i}") for i in range(width)])


def raw_rows(rows: DataFrame, prefixes: bool = False) -> DataFrame:
    """Raw rows with their sheet; rows of no sheet are dropped."""
    explicit = "target_sheet" if "target_sheet" in rows.columns else None
    routed = rows.withColumn("sheet", target_sheet("table_role", explicit, prefixes)).where("sheet is not null")
    return routed.select("sheet", *[as_cell(routed, c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in [*RAW_COLUMNS, *display_columns(rows.columns)]])


def key_values(one: DataFrame, names: tuple[str, str] = ("field", "value")) -> DataFrame:
    """A one-row frame as (field, value) rows: the summary and _metadata sheets."""
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), as_cell(one, c).alias("v")) for c in one.columns])
    return one.select(F.explode(pairs).alias("p")).select(F.col("p.k").alias(names[0]), F.col("p.v").alias(names[1]))


def read_corrections(sheet: DataFrame) -> DataFrame:
    """The nine columns of a corrections sheet, and ``row_number`` where it has one, without its empty rows; other columns are ignored."""
    if missing := [c for c in CORRECTION_COLUMNS if c not in sheet.columns]:
        raise ValueError("the corrections sheet lacks " + ", ".join(missing))
    numbered = ["row_number"] if "row_number" in sheet.columns else []
    return sheet.select(*numbered, *CORRECTION_COLUMNS).na.drop("all", subset=CORRECTION_COLUMNS)


def workbook_sheets(metadata: DataFrame, results: DataFrame, rows: DataFrame) -> dict[str, DataFrame]:
    """The eight sheets of a report's workbook."""
    place = [c for c in ("page_number", "table_index_on_page", "row_index", "column_index", "fact_id") if c in rows.columns]
    raw = raw_rows(rows.orderBy(*place))  # presentation order; a report's rows are few
    empty = metadata.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in CORRECTION_COLUMNS))
    sheets = {"summary": key_values(metadata), "validation_failures": failures(results)}
    sheets |= {s: raw.where(F.col("sheet") == s).drop("sheet") for s in RAW_SHEETS}
    return sheets | {"corrections": empty, "_metadata": key_values(metadata, ("key", "value"))}


def book_rows(metadata: DataFrame, results: DataFrame, rows: DataFrame, key: str = "extraction_run_id") -> DataFrame:
    """(key, sheet, row_number, cells): the sheets of ``workbook_sheets`` for every row of ``metadata`` at once.

    ``key`` tells the workbooks apart in all three; ``rows`` may carry ``display`` (``display_cells``). The first row of a sheet names its
    columns. A sheet's rows are numbered within it, so what one task sorts is one sheet. Rows of unknown keys are left out.
    """
    own = metadata.select(key)
    pairs = F.array(*[F.array(F.lit(c), as_cell(metadata, c)) for c in metadata.columns])
    meta = metadata.select(key, F.posexplode(pairs).alias("at", "cells"))
    meta = meta.select(key, F.explode(F.array(F.lit("summary"), F.lit("_metadata"))).alias("sheet"), (F.col("at") + 2).alias("row_number"), "cells")

    def cells(df: DataFrame, columns: Sequence[str]) -> Column:
        return F.array(*[as_cell(df, c) if c in df.columns else F.lit(None).cast("string") for c in columns])

    def numbered(df: DataFrame, order: Column) -> DataFrame:
        return df.select(key, "sheet", (F.row_number().over(Window.partitionBy(key, "sheet").orderBy(order)) + 1).alias("row_number"), "cells")

    failed = results.where(~F.col("status").startswith("verified")).join(own, key, "left_semi")
    failed = numbered(failed.withColumns({"sheet": F.lit("validation_failures"), "cells": cells(failed, FAILURE_COLUMNS)}), F.struct("rule_id", "validation_result_id"))
    explicit = "target_sheet" if "target_sheet" in rows.columns else None
    raw = rows.withColumn("sheet", target_sheet("table_role", explicit)).where("sheet is not null").join(own, key, "left_semi")
    shown = cells(raw, RAW_COLUMNS)
    last = F.lit(-1)
    if "display" in rows.columns:
        last = F.coalesce(F.array_max(F.map_keys("display")), F.lit(-1))
        shown = F.when(last >= 0, F.concat(shown, F.transform(F.sequence(F.lit(0), last), lambda i: F.try_element_at("display", i)))).otherwise(shown)
    raw = raw.withColumns({"cells": shown, "last": last})
    place = [c for c in ("page_number", "table_index_on_page", "row_index", "column_index", "fact_id") if c in rows.columns]
    wide = raw.groupBy(key, "sheet").agg(F.max("last").alias("last"))
    names = F.array(*[F.struct(F.lit(s).alias("sheet"), F.array(*[F.lit(c) for c in columns]).alias("cells")) for s, columns in _HEADS.items()])
    heads = own.select(key, F.explode(names).alias("h")).select(key, "h.*").join(wide, [key, "sheet"], "left")
    shown = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.concat(F.lit("display_col_"), i.cast("string")))
    heads = heads.select(key, "sheet", F.lit(1).alias("row_number"), F.when(F.col("last") >= 0, F.concat("cells", shown)).otherwise(F.col("cells")).alias("cells"))
    return heads.unionByName(meta).unionByName(failed).unionByName(numbered(raw, F.struct(*place)))


def workbook_path(root: str, report_id: str, run_id: str) -> str:
    """Where a run's workbook goes by default."""
    return f"{root}/{report_id}/{run_id}/review.xlsx"
