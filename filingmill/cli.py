"""Command line of the pipeline: one verb per stage over the lake."""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.operators import agreement, classify, corrections, facts, profile, publish, rawtables, realign, register, review, validate, views
from filingmill.sources import books, documents, rulepack, workbook
from filingmill.sources.schemas import ALLOWED, SCHEMAS
from filingmill.sources.store import Lake
from filingmill.streaming import lifecycle

VERSION = "0.1.0"


def now() -> Column:
    return F.lit(datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None))


def session() -> SparkSession:
    return SparkSession.builder.appName("filingmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _one(df, what: str, key: str):
    row = df.first()
    if row is None:
        raise ValueError(f"Unknown {what}: {key}")
    return row


def _files(lake: Lake, path: str):
    if not lake.exists(path):
        raise FileNotFoundError(path)
    return documents.report_files(lake.spark, path, "*")


def run_events(lake: Lake, of=None):
    """Extraction runs, all or some, by their latest event."""
    return register.run_events(lake.read("extraction_runs", of))


def init_db(lake: Lake, args) -> str:
    """Create the lake's tables and note the versions of the rule packs, each once."""
    lake.initialize()
    rows = rulepack.version_rows(lake.spark, rulepack.load_all(args.rules_root), args.rules_root, datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None))
    lake.append("rule_pack_versions", rows.join(lake.read("rule_pack_versions").select("rule_pack_version"), "rule_pack_version", "left_anti"))
    return f"{lake.root}/audit\n{lake.root}/analytics"


def import_pdf(lake: Lake, args) -> str:
    files = _files(lake, args.pdf_path)
    rows = documents.reports_of(files, args.market, now(), company_id=args.company_id, company_name=args.company_name, fiscal_year=args.fiscal_year, report_type=args.report_type)
    if args.stored_pdf_path:
        rows = rows.withColumn("stored_pdf_path", F.lit(args.stored_pdf_path))
    held = lake.read("reports")
    lake.append("reports", register.new_reports(rows, held, ["stored_pdf_path"]))
    found = register.report_ids(rows.select("file_sha256"), lake.read("reports").select("file_sha256", "report_id"))
    return "\n".join(r["report_id"] for r in found.toLocalIterator())


def profile_pdf(lake: Lake, args) -> str:
    report = lake.read("reports", [args.report_id])
    row = _one(report, "report", args.report_id)
    files = _files(lake, row["stored_pdf_path"]).withColumn("report_id", F.lit(args.report_id))
    pages = documents.read_pages(files)
    if bad := pages.where("error is not null").first():
        raise RuntimeError(bad["error"])
    pages = profile.page_profiles(pages.withColumn("market", F.lit(row["market"])))
    pages = pages.withColumn("page_id", F.sha2(F.concat_ws("/", "report_id", "page_number"), 256))
    lake.replace("pdf_pages", pages, report.select("report_id"))
    summary = profile.report_profiles(lake.read("pdf_pages", [args.report_id]))
    lake.replace("reports", profile.with_profile(report, summary), report.select("report_id"))
    s = summary.first()
    pages_n, text, keyword = (s["page_count"], s["is_text_pdf"], s["keyword_page_count"]) if s else (0, False, 0)
    return f"report_id={args.report_id} pages={pages_n} is_text_pdf={int(text)} keyword_pages={keyword}"


def extract_tables(lake: Lake, args) -> str:
    """A run is recorded as running first and as succeeded or failed after.

    That last event publishes tables and cells together: readers take rows of succeeded runs only, so a
    run that fails between the two writes shows none.
    """
    report = _one(lake.read("reports", [args.report_id]), "report", args.report_id)
    spark, started = lake.spark, datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)
    run_id = args.run_id or f"{args.report_id[:12]}-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
    pack = rulepack.load(report["market"], args.rules_root) if report["market"] in rulepack.MARKETS else None
    extractor = documents.EXTRACTORS[args.extractor]

    def event(status: str, error: str | None) -> None:
        finished = None if status == "running" else datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)
        row = (run_id, args.report_id, started, finished, status, VERSION, pack.version if pack else "none", {extractor.name: "unknown"}, error)
        lake.append("extraction_runs", spark.createDataFrame([row], "extraction_run_id string, report_id string, run_started_at timestamp, run_finished_at timestamp, status string, pipeline_version string, rule_pack_version string, extractor_versions map<string,string>, error_message string"))

    event("running", None)
    try:
        files = _files(lake, report["stored_pdf_path"]).withColumn("report_id", F.lit(args.report_id))
        found = documents.read_tables(files, extractor).withColumn("extraction_run_id", F.lit(run_id)).cache()
        if bad := found.where("error is not null").first():
            raise RuntimeError(bad["error"])
        tables = found.where(F.size("cells") > 0).withColumn("raw_table_id", rawtables.raw_table_id()).withColumn("created_at", F.lit(started))
        cells = rawtables.raw_cell_columns(rawtables.exploded_tables(tables.drop("page_number", "bbox")))
        sized = tables.join(rawtables.grid_size(cells, ["raw_table_id"]), "raw_table_id").join(rawtables.table_text(cells, ["raw_table_id"]), "raw_table_id")
        lake.append("raw_cells", cells)
        lake.append("raw_tables", sized)
    except Exception as e:
        event("failed", str(e)[:2000])
        raise
    event("succeeded", None)
    return f"extraction_run_id={run_id} tables={tables.count()} cells={cells.count()}"


def _context(lake: Lake, args):
    runs = run_events(lake, [args.extraction_run_id])
    report_id = _one(runs, "extraction run", args.extraction_run_id)["report_id"]
    return runs, lake.read("reports", [report_id]), rulepack.load_all(args.rules_root)


def raw(lake: Lake, table: str, runs, of=None):
    """Raw rows of the ``runs`` that have succeeded, from the files of the run ids ``of`` alone if they are given."""
    done = runs.where("status = 'succeeded'").select("extraction_run_id")
    return lake.read(table, of).join(done, "extraction_run_id", "left_semi")


def classify_tables(lake: Lake, args) -> str:
    runs, reports, packs = _context(lake, args)
    packs = rulepack.load_all(args.rules_root, extended=True) if args.notes else packs
    rows = classify.classify_runs(raw(lake, "raw_tables", runs, [args.extraction_run_id]), raw(lake, "raw_cells", runs, [args.extraction_run_id]), lake.read("pdf_pages", [r["report_id"] for r in reports.select("report_id").collect()]), runs, reports, packs, now(), args.notes, args.indexed)
    lake.replace("classified_tables", rows, runs)
    s = classify.summary(lake.read("classified_tables", [args.extraction_run_id])).first()
    return f"extraction_run_id={args.extraction_run_id} classified={s['classified_count']} review_required={s['review_required_count']}"


def extract_facts(lake: Lake, args) -> str:
    """Balance sheets by default; ``--all-statements`` takes every statement and every value column."""
    runs, reports, packs = _context(lake, args)
    packs = rulepack.load_all(args.rules_root, extended=True) if args.all_statements else packs
    more = {"roles": facts.STATEMENTS, "value_columns": "all", "unit_levels": True} if args.all_statements else {}
    rows = facts.extract_facts(
        lake.read("classified_tables", [args.extraction_run_id]), raw(lake, "raw_tables", runs, [args.extraction_run_id]), raw(lake, "raw_cells", runs, [args.extraction_run_id]), lake.read("pdf_pages", [r["report_id"] for r in reports.select("report_id").collect()]), runs, reports, packs, rulepack.alias_table(lake.spark, packs), now(), **more
    )
    lake.replace("extracted_facts", rows, runs)
    s = facts.summary(lake.read("extracted_facts", [args.extraction_run_id])).first()
    return f"extraction_run_id={args.extraction_run_id} facts={s['fact_count']} needs_review={s['needs_review_count']}"


def _judge(lake: Lake, runs, reports, packs, found) -> None:
    """Judge the facts ``found`` of ``runs``; their results replace earlier ones, and what was judged is noted by its digest."""
    rows = validate.validate_runs(found, runs, reports, packs, now())
    lake.replace("validation_results", rows, runs)
    ids = [r["extraction_run_id"] for r in runs.select("extraction_run_id").toLocalIterator()]
    judged = lake.read("validation_results", ids).select("validation_run_id", "extraction_run_id").distinct()
    noted = judged.join(runs.select("extraction_run_id", "rule_pack_version"), "extraction_run_id").join(validate.fact_digests(found), "extraction_run_id", "left")
    lake.append("validation_runs", noted.withColumns({"started_at": now(), "finished_at": now(), "status": F.lit("succeeded")}))


def _validated(lake: Lake, args, runs, reports, packs, found) -> str:
    _judge(lake, runs, reports, packs, found)
    s = validate.summary(lake.read("validation_results", [args.extraction_run_id]), ["validation_run_id"]).first()
    if s is None:
        raise ValueError(f"no rules for the market of {args.extraction_run_id}")
    return f"validation_run_id={s['validation_run_id']} extraction_run_id={args.extraction_run_id} results={s['result_count']} failed={s['failed_count']}"


def validate_changed(lake: Lake, args) -> str:
    """Judge again only the runs whose corrected facts, or whose rules, aren't those of their last validation."""
    packs = rulepack.load_all(args.rules_root)
    runs = run_events(lake).where("status = 'succeeded'")
    accepted = lake.read("correction_batches").where("status = 'accepted'").select("correction_batch_id")
    log = lake.read("corrections").join(accepted, "correction_batch_id", "left_semi")
    found = corrections.effective(lake.read("extracted_facts"), log).where(~F.coalesce(F.col("correction_action") == "ignore", F.lit(False)))
    digests = validate.fact_digests(found).join(runs.select("extraction_run_id", "rule_pack_version"), "extraction_run_id")
    ids = [r["extraction_run_id"] for r in validate.changed_runs(digests, lake.read("validation_runs")).toLocalIterator()]
    if ids:
        some = run_events(lake, ids)
        _judge(lake, some, lake.read("reports"), packs, found.where(F.col("extraction_run_id").isin(*ids)))
    return f"runs={runs.count()} validated={len(ids)}"


def validate_run(lake: Lake, args) -> str:
    runs, reports, packs = _context(lake, args)
    return _validated(lake, args, runs, reports, packs, lake.read("extracted_facts", [args.extraction_run_id]))


def _accepted(lake: Lake, args):
    """Corrections of a run's accepted batches."""
    accepted = lake.read("correction_batches", [args.extraction_run_id]).where("status = 'accepted'").select("correction_batch_id")
    return lake.read("corrections", [r["correction_batch_id"] for r in accepted.toLocalIterator()]).join(accepted, "correction_batch_id", "left_semi")


def publish_run(lake: Lake, args) -> str:
    """Publish a run's trusted facts as the active version of its report, statement or table.

    A fact's status is the worst verdict that involves it; a reviewer's confirmation counts instead, and what the
    reviewer ignores isn't published. With ``--agree-with`` facts need the other run's agreement, a sure unit and a sure mapping,
    unless a reviewer has confirmed them.
    """
    runs, reports, _ = _context(lake, args)
    log = _accepted(lake, args)
    found = corrections.effective(lake.read("extracted_facts", [args.extraction_run_id]), log)
    judged = corrections.candidate_status(views.debug_facts(found, lake.read("validation_results", [args.extraction_run_id]), log))
    if args.agree_with:
        both = found.unionByName(lake.read("extracted_facts", [args.agree_with]), allowMissingColumns=True)
        agreed = agreement.run_agreement(both, args.extraction_run_id, args.agree_with)
        confirmed = F.col("validation_status") == "manually_confirmed"
        judged = publish.auto_trust(judged, agreed, agreement.FACT_KEYS).where(F.col("auto_trusted") | F.coalesce(confirmed, F.lit(False)))
    version = publish.version_rows(runs, args.scope, args.scope_key, now(), args.published_by, args.notes)
    version_id = version.first()["trusted_version_id"]
    publish.publish(lake, judged, reports, version)
    n = lake.read("trusted_facts", [r["report_id"] for r in reports.collect()]).where(F.col("trusted_version_id") == version_id).count()
    return f"trusted_version_id={version_id} extraction_run_id={args.extraction_run_id} facts={n}"


#: What orders the rows of a shown view; other columns follow.
VIEW_ORDER = ("company_id", "fiscal_year", "report_type", "statement_type", "source_page", "fact_id")


def show_view(lake: Lake, args) -> str:
    """A view's rows as lines of JSON, in order. Only the debug mode has the view of unpublished facts."""
    if args.mode == "debug":
        views.register_debug(lake.read("extracted_facts"), lake.read("validation_results"), lake.read("corrections"))
    views.register(lake.spark, publish.published(lake))
    if not lake.spark.catalog.tableExists(args.view):
        raise ValueError(f"Unknown view in {args.mode} mode: {args.view}")
    rows = lake.spark.table(args.view)
    order = [c for c in VIEW_ORDER if c in rows.columns]
    return "\n".join(r["j"] for r in rows.orderBy(*order, *[c for c in rows.columns if c not in order and not isinstance(rows.schema[c].dataType, T.MapType)]).select(F.to_json(F.struct("*")).alias("j")).toLocalIterator())


def compact(lake: Lake, args) -> str:
    """Write a table's current rows anew without what is superseded; ``--vacuum`` also deletes the old files."""
    version = lake.compact(args.table)
    gone = lake.vacuum(args.table) if args.vacuum else 0
    return f"table={args.table} version={version} folders_deleted={gone}"


def export_review(lake: Lake, args) -> str:
    """The workbook of a run, its facts beside the cells of their rows; the export is recorded."""
    runs, reports, _ = _context(lake, args)
    found = lake.read("extracted_facts", [args.extraction_run_id])
    results = lake.read("validation_results", [args.extraction_run_id])
    cells = rawtables.last_cells(raw(lake, "raw_cells", runs, [args.extraction_run_id]).join(found.select("raw_table_id").distinct(), "raw_table_id", "left_semi"), ["raw_table_id"])
    shown = found.join(review.with_display(cells, ["raw_table_id"]), ["raw_table_id", "row_index"], "left")
    export_id = F.sha2(F.concat_ws("/", F.lit("review"), "extraction_run_id"), 256)
    meta = runs.select(F.lit("1").alias("workbook_schema_version"), "report_id", "extraction_run_id", export_id.alias("review_export_id"), "rule_pack_version", now().cast("string").alias("exported_at"))
    book = args.workbook or str(review.workbook_path(f"{lake.root}/review", _one(runs, "extraction run", args.extraction_run_id)["report_id"], args.extraction_run_id))
    workbook.write_workbook(book, review.workbook_sheets(meta, results, shown.withColumn("cell_bbox_json", F.to_json("cell_bbox"))))
    if args.html:
        workbook.html_summary(args.html, f"Review of {args.extraction_run_id}", {"summary": review.key_values(meta), "validation_failures": review.failures(results)})
    lake.append("review_exports", runs.select(export_id.alias("review_export_id"), "report_id", "extraction_run_id", F.lit(book).alias("workbook_path"), F.lit(args.html).cast("string").alias("html_summary_path"), F.lit("exported").alias("status"), now().alias("created_at")))
    return book


def import_corrections(lake: Lake, args) -> str:
    """Import a workbook's corrections, once, and validate the run again over the corrected facts.

    Broken rows reject the whole batch and are written to an error workbook; only the corrections and
    the metadata sheet are read.
    """
    meta = workbook.metadata_of(args.workbook)
    args.extraction_run_id = meta.get("extraction_run_id")
    runs, reports, packs = _context(lake, args)
    batches = lake.read("correction_batches")
    export = corrections.importable(meta, lake.read("review_exports").dropDuplicates(["review_export_id"]), batches)
    _one(export, "or already imported review export", meta.get("review_export_id"))
    found = lake.read("extracted_facts", [args.extraction_run_id])
    sheet = workbook.corrections_of(lake.spark, args.workbook)
    number = batches.where(F.col("review_export_id") == meta["review_export_id"]).count() + 1
    batch_id = f"{meta['review_export_id'][:12]}-{number}"
    errors = corrections.error_rows(sheet, lake.read("extracted_facts"), args.extraction_run_id)
    n_errors = errors.count()

    def batch(status: str, error: str | None) -> None:
        row = export.select("review_export_id", "report_id", "extraction_run_id").withColumns({"correction_batch_id": F.lit(batch_id), "imported_workbook_path": F.lit(str(args.workbook)), "imported_at": now(), "status": F.lit(status), "error_message": F.lit(error).cast("string")})
        lake.append("correction_batches", row.limit(1))

    if n_errors:
        report = f"{args.workbook}.errors.xlsx"
        workbook.write_sheets(report, {"errors": errors.orderBy("row_number", "error_code").select(*[F.col(c).cast("string") for c in errors.columns])})
        batch("rejected", f"{n_errors} errors, see {report}")
        raise ValueError(f"{n_errors} errors in the corrections, see {report}")
    log = corrections.history(sheet, found, F.lit(batch_id), now())
    lake.append("corrections", log)
    batch("accepted", None)
    corrected = corrections.effective(found, _accepted(lake, args))
    kept = corrected.where(~F.coalesce(F.col("correction_action") == "ignore", F.lit(False)))
    said = _validated(lake, args, runs, reports, packs, kept)
    return f"correction_batch_id={batch_id} corrections={sheet.count()} {said}"


def export_reviews(lake: Lake, args) -> str:
    """The workbooks of all succeeded runs with facts, or of those named, written in parallel below a folder; a failure leaves none."""
    folder = args.folder or f"{lake.root}/review"
    ids = args.run or None
    runs = run_events(lake, ids).where("status = 'succeeded'")
    found = lake.read("extracted_facts", ids)
    runs = runs.join(found.select("extraction_run_id").distinct(), "extraction_run_id", "left_semi")
    cells = rawtables.last_cells(raw(lake, "raw_cells", runs, ids).join(found.select("raw_table_id").distinct(), "raw_table_id", "left_semi"), ["extraction_run_id", "raw_table_id"])
    shown = found.join(review.display_cells(cells, ["extraction_run_id", "raw_table_id"]), ["extraction_run_id", "raw_table_id", "row_index"], "left")
    export_id = F.sha2(F.concat_ws("/", F.lit("review"), "extraction_run_id"), 256)
    meta = runs.select(F.lit("1").alias("workbook_schema_version"), "report_id", "extraction_run_id", export_id.alias("review_export_id"), "rule_pack_version", now().cast("string").alias("exported_at"))
    path = F.concat_ws("/", "report_id", "extraction_run_id", F.lit("review.xlsx"))
    rows = review.book_rows(meta, lake.read("validation_results", ids), shown.withColumn("cell_bbox_json", F.to_json("cell_bbox")))
    books.write_books(rows.join(runs.select("extraction_run_id", path.alias("workbook")), "extraction_run_id"), folder)
    exports = meta.select("review_export_id", "report_id", "extraction_run_id", F.concat_ws("/", F.lit(folder), path).alias("workbook_path"), F.lit("exported").alias("status"), now().alias("created_at"))
    lake.append("review_exports", exports)
    return f"folder={folder} workbooks={exports.count()}"


def import_reviews(lake: Lake, args) -> str:
    """Import the corrections of every workbook below a folder, each once, and validate again the runs that they change.

    A workbook with broken rows is rejected, one that can't be read or has no open export is refused; neither stops the others.
    The broken rows of all are written as one workbook of errors for each, below ``errors``.
    """
    rows = books.read_books(lake.spark, args.folder, "corrections", "_metadata").where(~F.col("workbook").startswith("errors/")).cache()
    seen, sheet = corrections.books_of(rows), corrections.sheets_of(rows)
    ids = [r["extraction_run_id"] for r in seen.where("extraction_run_id is not null").select("extraction_run_id").distinct().toLocalIterator()]
    found = lake.read("extracted_facts", ids)
    judged, errors = corrections.accepted_books(seen, sheet, found, lake.read("review_exports", ids), lake.read("correction_batches", ids))
    judged = judged.cache()
    taken = judged.where("status = 'accepted'").select("workbook", "correction_batch_id", "extraction_run_id")
    own = sheet.join(taken.select("workbook", F.col("correction_batch_id").alias("batch")), "workbook")
    log = corrections.history(own, found, F.col("batch"), now(), ["batch"])
    lake.append("corrections", log)
    # the batches make the corrections visible, so they come after them
    noted = judged.where("status in ('accepted', 'rejected')").withColumns({"imported_workbook_path": F.concat_ws("/", F.lit(args.folder), "workbook"), "imported_at": now()})
    lake.append("correction_batches", noted)
    n = {r["status"]: r["count"] for r in judged.groupBy("status").count().collect()}
    if n.get("rejected"):
        head = errors.select("workbook", F.lit(1).alias("row_number"), F.array(F.lit("row_number"), F.lit("fact_id"), F.lit("error_code")).alias("cells")).distinct()
        by = Window.partitionBy("workbook").orderBy("row_number", "error_code", "fact_id")
        body = errors.select("workbook", (F.row_number().over(by) + 1).alias("at"), F.array(F.col("row_number").cast("string"), "fact_id", "error_code").alias("cells"))
        books.write_books(head.union(body).withColumns({"sheet": F.lit("errors"), "workbook": F.concat(F.lit("errors/"), "workbook")}), args.folder)
    ids = [r["extraction_run_id"] for r in taken.select("extraction_run_id").distinct().toLocalIterator()]
    if ids:
        _judge_corrected(lake, ids, rulepack.load_all(args.rules_root))
    refused = "".join(f"\nrefused {r['workbook']}: {r['error_message']}" for r in judged.where("status = 'refused'").orderBy("workbook").toLocalIterator())
    return f"accepted={n.get('accepted', 0)} rejected={n.get('rejected', 0)} refused={n.get('refused', 0)}{refused}"


def carry_corrections(lake: Lake, args) -> str:
    """Take a run's accepted corrections over to another run of the same report, and validate that run again.

    Only decisions on cells whose text, concept and unit are the same in both runs are taken; the others are counted by
    their reason, to be reviewed anew. What was decided in the new run already stays.
    """
    old, new = args.from_run_id, args.extraction_run_id
    runs = run_events(lake, [old, new])
    report = {i: _one(runs.where(F.col("extraction_run_id") == i), "extraction run", i)["report_id"] for i in (old, new)}
    if report[old] != report[new]:
        raise ValueError(f"{old} and {new} are runs of different reports")

    def cells(run: str):
        last = rawtables.last_cells(raw(lake, "raw_cells", runs, [run]), ["report_id", "page_number", "raw_table_id"])
        return last.join(raw(lake, "raw_tables", runs, [run]).select("raw_table_id", "table_index_on_page"), "raw_table_id")

    batches = lake.read("correction_batches", [old]).where("status = 'accepted'")
    ids = [r["correction_batch_id"] for r in batches.select("correction_batch_id").toLocalIterator()]
    log = lake.read("corrections", ids)
    found = lake.read("extracted_facts", [old]).join(log.select("fact_id"), "fact_id", "left_semi")
    fresh = lake.read("extracted_facts", [new])
    outcomes = realign.outcomes(found, fresh, realign.aligned_cells(cells(old), cells(new))).cache()
    batch_id = f"carried-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
    args.extraction_run_id = new
    rows = realign.carried(log, outcomes, fresh, _accepted(lake, args), batch_id, now()).cache()
    n = {r["outcome"]: r["count"] for r in outcomes.groupBy("outcome").count().collect()}
    said = f"facts={sum(n.values())} " + " ".join(f"{k}={n[k]}" for k in sorted(n)) + f" corrections={rows.count()}"
    if rows.isEmpty():
        return said.strip()
    lake.append("corrections", rows)
    last = batches.agg(F.max_by(F.struct("review_export_id", "imported_workbook_path"), "imported_at").alias("b")).select("b.*")
    lake.append("correction_batches", last.withColumns({"correction_batch_id": F.lit(batch_id), "report_id": F.lit(report[new]), "extraction_run_id": F.lit(new), "imported_at": now(), "status": F.lit("accepted"), "operator": F.lit(f"carried from {old}")}))
    _judge_corrected(lake, [new], rulepack.load_all(args.rules_root))
    return said


def _judge_corrected(lake: Lake, ids: list[str], packs) -> None:
    """Judge the facts of some runs with their accepted corrections laid over."""
    accepted = lake.read("correction_batches", ids).where("status = 'accepted'").select("correction_batch_id")
    log = lake.read("corrections").join(accepted, "correction_batch_id", "left_semi")
    corrected = corrections.effective(lake.read("extracted_facts", ids), log)
    runs = run_events(lake, ids)
    reports = lake.read("reports").join(runs.select("report_id"), "report_id", "left_semi")
    _judge(lake, runs, reports, packs, corrected.where(~F.coalesce(F.col("correction_action") == "ignore", F.lit(False))))


def suggest_aliases(lake: Lake, args) -> str:
    """The labels of statements that no rule maps, most frequent first, each with the aliases near it, as lines of JSON."""
    ids = args.run or None
    runs, packs = run_events(lake, ids), rulepack.load_all(args.rules_root)
    rows = facts.unmatched_rows(lake.read("classified_tables", ids), raw(lake, "raw_cells", runs, ids), runs, lake.read("reports"))
    found = facts.suggestions(rows, rulepack.alias_table(lake.spark, packs), args.edits)
    return "\n".join(r["j"] for r in found.orderBy(F.desc("n_rows"), "market", "label").select(F.to_json(F.struct("market", "label", "n_rows", "candidates")).alias("j")).toLocalIterator())


def watch_runs(lake: Lake, args) -> str:
    """Fail the runs that have no end although later runs show that their time is over; goes on where it stopped."""
    watched = lifecycle.watch(lake, args.checkpoint or f"{lake.root}/checkpoints/watch-runs", timedelta(minutes=args.limit_minutes), timedelta(minutes=args.delay_minutes))
    watched.awaitTermination()
    n = {r["status"]: r["count"] for r in run_events(lake).groupBy("status").count().collect()}
    return f"running={n.get('running', 0)} succeeded={n.get('succeeded', 0)} failed={n.get('failed', 0)}"


VERBS = {"init-db": init_db, "import-pdf": import_pdf, "profile-pdf": profile_pdf, "extract-tables": extract_tables, "classify-tables": classify_tables, "extract-facts": extract_facts, "validate-run": validate_run, "export-review": export_review, "import-corrections": import_corrections, "publish-run": publish_run, "show-view": show_view, "compact": compact, "validate-changed": validate_changed, "export-reviews": export_reviews, "import-reviews": import_reviews, "carry-corrections": carry_corrections, "watch-runs": watch_runs, "suggest-aliases": suggest_aliases}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="filingmill")
    verbs = out.add_subparsers(dest="verb", required=True)
    for name in VERBS:
        p = verbs.add_parser(name)
        p.add_argument("--lake", required=True, help="root folder of the lake")
        p.add_argument("--rules-root", default=str(rulepack.RULES_ROOT))
        if name == "import-pdf":
            p.add_argument("pdf_path")
            p.add_argument("--stored-pdf-path")
            p.add_argument("--market", required=True)
            p.add_argument("--company-id")
            p.add_argument("--company-name")
            p.add_argument("--fiscal-year", type=int)
            p.add_argument("--report-type")
        elif name in ("profile-pdf", "extract-tables"):
            p.add_argument("report_id")
            if name == "extract-tables":
                p.add_argument("--extractor", default="pdfplumber", choices=sorted(documents.EXTRACTORS))
                p.add_argument("--run-id")
        elif name == "import-corrections":
            p.add_argument("workbook")
        elif name == "carry-corrections":
            p.add_argument("from_run_id")
            p.add_argument("extraction_run_id")
        elif name == "suggest-aliases":
            p.add_argument("--run", action="append", help="a run to look at; all by default")
            p.add_argument("--edits", type=int, default=2)
        elif name == "watch-runs":
            p.add_argument("--limit-minutes", type=float, default=360)
            p.add_argument("--delay-minutes", type=float, default=10)
            p.add_argument("--checkpoint")
        elif name == "import-reviews":
            p.add_argument("folder")
        elif name == "export-reviews":
            p.add_argument("folder", nargs="?")
            p.add_argument("--run", action="append", help="a run to export; all by default")
        elif name == "show-view":
            p.add_argument("view")
            p.add_argument("--mode", choices=("trusted", "debug"), default="trusted")
        elif name == "compact":
            p.add_argument("table", choices=sorted(SCHEMAS))
            p.add_argument("--vacuum", action="store_true")
        elif name not in ("init-db", "validate-changed"):
            p.add_argument("extraction_run_id")
            if name == "classify-tables":
                p.add_argument("--notes", action="store_true")
                p.add_argument("--indexed", action="store_true", help="look keywords up in an index, for packs of thousands")
            if name == "extract-facts":
                p.add_argument("--all-statements", action="store_true")
            if name == "publish-run":
                p.add_argument("--scope", choices=ALLOWED["trusted_scope"], default="report")
                p.add_argument("--scope-key")
                p.add_argument("--agree-with")
                p.add_argument("--published-by")
                p.add_argument("--notes")
            if name == "export-review":
                p.add_argument("workbook", nargs="?")
                p.add_argument("--html")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    args = parser().parse_args(argv)
    said = VERBS[args.verb](Lake(spark or session(), args.lake), args)
    print(said)
    return said


if __name__ == "__main__":
    main()
