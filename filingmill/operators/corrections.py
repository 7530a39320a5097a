"""Corrections: checks, append-only history, and effective facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.functions.exprs import MONEY, stable_id
from filingmill.operators.review import CORRECTION_COLUMNS, METADATA_KEYS
from filingmill.sources.schemas import ALLOWED

# Fields that a correction may change, and the fact column each replaces.
FIELDS = {"corrected_value": "normalized_value", "corrected_unit": "raw_unit", "normalized_concept_id": "normalized_concept_id", "period_basis": "period_basis", "statement_scope": "statement_scope", "table_role": "table_role"}
REMAP_FIELDS = ("normalized_concept_id", "period_basis", "statement_scope", "table_role")
ERRORS = ("UNKNOWN_FACT_ID", "FACT_NOT_IN_EXTRACTION_RUN", "INVALID_ACTION", "MISSING_REASON", "MISSING_CORRECTED_VALUE", "INVALID_DECIMAL", "INVALID_UNIT", "IMMUTABLE_FIELD_MODIFIED", "DUPLICATE_CORRECTION_ROW")
UNITS = ("元", "千元", "万元", "百万元", "CNY", "HKD", "USD")


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def error_rows(rows: DataFrame, facts: DataFrame, run_id: str | Column | None = None, immutable: Sequence[str] = (), units: Sequence[str] = UNITS, book: Sequence[str] = ()) -> DataFrame:
    """(row_number, fact_id, error_code): every broken rule of every correction row.

    ``rows`` has row_number and the nine sheet columns; ``immutable`` names columns of both sides
    that a person must not change. With ``book``, columns that tell workbooks apart, many are judged at once: the result has
    these columns too, and a repeated row is one within its workbook.
    """
    known = facts.select(F.col("fact_id").alias("__id"), "extraction_run_id", *[F.col(c).cast("string").alias(f"__{c}") for c in immutable])
    at = rows.join(known, F.col("fact_id") == F.col("__id"), "left")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("fact_id", "correction_action")]
    same += [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in book]
    repeated = rows.groupBy(*[F.col(c).alias(f"__{c}") for c in (*book, "fact_id", "correction_action")]).agg(F.count("*").alias("__n")).where("__n > 1")
    at = at.join(repeated, same, "left")
    action, unknown = F.col("correction_action"), F.col("__id").isNull()
    changed = F.lit(False)
    for c in immutable:
        changed = changed | ~F.col(c).cast("string").eqNullSafe(F.col(f"__{c}"))
    nothing = F.lit(True)
    for c in REMAP_FIELDS:
        nothing = nothing & _blank(c)
    wrong_run = F.lit(False) if run_id is None else ~unknown & (F.col("extraction_run_id") != run_id)
    rules = {
        "UNKNOWN_FACT_ID": unknown,
        "FACT_NOT_IN_EXTRACTION_RUN": wrong_run,
        "INVALID_ACTION": ~F.coalesce(action.isin(*ALLOWED["correction_action"]), F.lit(False)),
        "MISSING_REASON": action.isin("correct", "remap", "ignore") & _blank("correction_reason"),
        "MISSING_CORRECTED_VALUE": ((action == "correct") & _blank("corrected_value") & _blank("corrected_unit")) | ((action == "remap") & nothing),
        "INVALID_DECIMAL": ~_blank("corrected_value") & F.trim("corrected_value").try_cast(MONEY).isNull(),
        "INVALID_UNIT": ~_blank("corrected_unit") & ~F.trim("corrected_unit").isin(*units),
        "IMMUTABLE_FIELD_MODIFIED": ~unknown & changed,
        "DUPLICATE_CORRECTION_ROW": F.col("__n").isNotNull(),
    }
    codes = F.array_compact(F.array(*[F.when(F.coalesce(rules[code], F.lit(False)), F.lit(code)) for code in ERRORS]))
    return at.select(*book, "row_number", "fact_id", F.explode(codes).alias("error_code"))


def history(rows: DataFrame, facts: DataFrame, batch_id: Column, created_at: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of ``corrections``: a row per changed field with its old and new value; nothing is overwritten.

    ``keep`` names further columns of ``rows``, which ``batch_id`` may use.
    """
    pairs = F.array_compact(F.array(*[F.when(~_blank(c), F.struct(F.lit(f).alias("field_name"), F.col(c).cast("string").alias("new_value"))) for c, f in FIELDS.items()]))
    action = F.struct(F.lit("correction_action").alias("field_name"), F.col("correction_action").alias("new_value"))
    long = rows.select(*keep, "fact_id", "correction_reason", F.explode(F.array_append(pairs, action)).alias("p")).select(*keep, "fact_id", "correction_reason", "p.*")
    old = facts.select("fact_id", F.map_from_arrays(F.array(*[F.lit(f) for f in FIELDS.values()]), F.array(*[F.col(f).cast("string") for f in FIELDS.values()])).alias("__old"))
    out = long.join(old, "fact_id", "left").withColumn("old_value", F.try_element_at("__old", F.col("field_name"))).drop("__old")
    out = out.withColumns({"correction_batch_id": batch_id, "created_at": created_at})
    return out.withColumn("correction_id", stable_id("correction_batch_id", "fact_id", "field_name"))


def latest(corrections: DataFrame, order: Sequence[str] = ("created_at", "correction_id")) -> DataFrame:
    """(fact_id, fields): a map of every field's latest new value."""
    last = corrections.groupBy("fact_id", "field_name").agg(F.max_by("new_value", F.struct(*order)).alias("v"))
    return last.groupBy("fact_id").agg(F.map_from_entries(F.collect_list(F.struct("field_name", "v"))).alias("fields"))


def effective(facts: DataFrame, corrections: DataFrame, order: Sequence[str] = ("created_at", "correction_id")) -> DataFrame:
    """Facts with their latest corrections laid over, and ``correction_action``; originals stay in the lake."""
    out = facts.join(latest(corrections, order), "fact_id", "left")
    for f in FIELDS.values():
        new = F.try_element_at("fields", F.lit(f))
        out = out.withColumn(f, F.coalesce(new.try_cast(MONEY) if f == "normalized_value" else new, F.col(f)))
    return out.withColumn("correction_action", F.try_element_at("fields", F.lit("correction_action"))).drop("fields")


def candidate_status(effective_facts: DataFrame, status: str = "validation_status") -> DataFrame:
    """Drop ignored facts; confirmed ones become manually_confirmed."""
    kept = effective_facts.where(~F.coalesce(F.col("correction_action") == "ignore", F.lit(False)))
    return kept.withColumn(status, F.when(F.col("correction_action") == "confirm", "manually_confirmed").otherwise(F.col(status)))


def importable(metadata: dict[str, str], exports: DataFrame, batches: DataFrame) -> DataFrame:
    """The review export that a workbook's metadata names, if it may be imported; empty otherwise.

    Report and run must match, the export must not be superseded, and no batch of it may be accepted.
    """
    own = exports.where((F.col("review_export_id") == metadata.get("review_export_id")) & (F.col("report_id") == metadata.get("report_id")) & (F.col("extraction_run_id") == metadata.get("extraction_run_id")) & (F.col("status") == "exported"))
    return own.join(batches.where("status = 'accepted'"), "review_export_id", "left_anti")


def books_of(rows: DataFrame) -> DataFrame:
    """(workbook, book_error, the keys of _metadata): one row for each workbook of ``books.read_books``.

    ``book_error`` says why a workbook can't be taken at all: it can't be read, or its sheet lacks columns.
    """
    head = (F.col("sheet") == "corrections") & (F.col("row_number") == 1)
    pair = (F.col("sheet") == "_metadata") & (F.col("row_number") > 1) & F.col("cells").isNotNull()
    value = lambda k: F.max(F.when(pair & (F.try_element_at("cells", F.lit(1)) == k), F.try_element_at("cells", F.lit(2)))).alias(k)
    seen = rows.groupBy("workbook").agg(F.min("error").alias("error"), F.max(F.when(head, F.col("cells"))).alias("head"), *[value(k) for k in METADATA_KEYS])
    lacking = F.array_except(F.array(*[F.lit(c) for c in CORRECTION_COLUMNS]), F.coalesce("head", F.array().cast("array<string>")))
    return seen.withColumn("book_error", F.coalesce("error", F.when(F.size(lacking) > 0, F.concat(F.lit("the corrections sheet lacks "), F.array_join(lacking, ", "))))).drop("error", "head")


def sheets_of(rows: DataFrame) -> DataFrame:
    """(workbook, row_number, the nine columns): the corrections of many workbooks, without empty rows.

    A column is found by its name in the workbook's own header; of a repeated name the first counts.
    """
    sheet = rows.where("sheet = 'corrections' and cells is not null")
    heads = sheet.where("row_number = 1").select("workbook", F.col("cells").alias("head"))
    body = sheet.where("row_number > 1").join(heads, "workbook")
    at = lambda c: F.array_position("head", c).cast("int")
    named = body.select("workbook", "row_number", *[F.when(at(c) > 0, F.try_element_at("cells", F.greatest(at(c), F.lit(1)))).alias(c) for c in CORRECTION_COLUMNS])
    return named.na.drop("all", subset=CORRECTION_COLUMNS)


def accepted_books(books: DataFrame, sheet: DataFrame, facts: DataFrame, exports: DataFrame, batches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Which of many workbooks are imported, and the broken rules of the rest.

    The first result has (workbook, review_export_id, report_id, extraction_run_id, correction_batch_id, status, error_message):
    accepted, rejected for broken rows, or refused, as the export is unknown, superseded or already imported, or the workbook
    can't be read. Of several workbooks of one export the first by name is taken. Broken rows reject their own workbook
    alone. The second is ``error_rows`` by workbook.
    """
    known = exports.where("status = 'exported'").select("review_export_id", "report_id", "extraction_run_id").distinct().withColumn("known", F.lit(True))
    done = batches.groupBy("review_export_id").agg(F.count("*").alias("n"), F.max(F.col("status") == "accepted").alias("done"))
    first = books.where("book_error is null").groupBy("review_export_id").agg(F.min("workbook").alias("first"))
    at = books.join(known, ["review_export_id", "report_id", "extraction_run_id"], "left").join(done, "review_export_id", "left").join(first, "review_export_id", "left")
    refused = F.coalesce(
        "book_error", F.when(F.col("known").isNull(), "unknown or superseded review export"), F.when(F.col("done"), "already imported"), F.when(F.col("workbook") != F.col("first"), "another workbook of this export is taken")
    )
    at = at.withColumn("refused", refused)
    open_rows = sheet.join(at.where("refused is null").select("workbook", F.col("extraction_run_id").alias("of_run")), "workbook")
    errors = error_rows(open_rows, facts, F.col("of_run"), book=["workbook"])
    at = at.join(errors.groupBy("workbook").agg(F.count("*").alias("n_errors")), "workbook", "left")
    status = F.when(F.col("refused").isNotNull(), "refused").when(F.col("n_errors") > 0, "rejected").otherwise("accepted")
    message = F.coalesce("refused", F.concat(F.col("n_errors").cast("string"), F.lit(" errors")))
    batch_id = F.concat(F.substring("review_export_id", 1, 12), F.lit("-"), (F.coalesce("n", F.lit(0)) + 1).cast("string"))
    return at.select("workbook", "review_export_id", "report_id", "extraction_run_id", batch_id.alias("correction_batch_id"), status.alias("status"), message.alias("error_message")), errors
