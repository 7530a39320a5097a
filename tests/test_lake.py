"""Sources, lake, workbook, corrections, publishing and the command line."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from filingmill import cli
from filingmill.operators import agreement, corrections, publish, register, review, validate, views
from filingmill.sources import commits, documents, rulepack, schemas, store, workbook
from filingmill.sources.store import Lake
from filingmill.streaming import ingest

AT = datetime(2026, 1, 1)


class Fake:
    name = "fake"

    def tables(self, content):
        if content == b"bad":
            raise OSError("broken file")
        yield documents.grid_tables("fake", 1, 0, [["Consolidated Balance Sheets", "US$ in millions"], ["Total assets", "100"], ["Total liabilities", "40"], ["Total shareholders' equity", "60"]], (0, 0, 9, 9), [(1, 2, 3, 4)] * 7)
        yield documents.grid_tables("fake", 1, 1, [])


def fake_pages(content):
    yield {"page_number": 1, "width": 100.0, "height": 200.0, "text": "Consolidated Balance Sheets in millions"}
    yield {"page_number": 2, "width": 100.0, "height": 200.0, "text": content.decode()}


def test_grid_tables():
    t = documents.grid_tables("x", 3, 0, [["项目", "金额"], ["资产总计", ""]], None, [(0, 0, 1, 1)] * 3)
    assert [(c["row_index"], c["column_index"], c["raw_text"], c["bbox"] is None, c["page_number"]) for c in t["cells"]] == [(0, 0, "项目", False, 3), (0, 1, "金额", False, 3), (1, 0, "资产总计", False, 3), (1, 1, None, True, 3)]
    with pytest.raises(NotImplementedError):
        next(documents.Camelot().tables(b""))


def test_command_line_end_to_end(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setitem(documents.EXTRACTORS, "fake", Fake())
    monkeypatch.setattr(documents, "pdf_pages", fake_pages)
    monkeypatch.setattr(documents.read_pages, "__defaults__", (fake_pages,))
    pdf = tmp_path / "report.pdf"
    pdf.write_bytes(b"some file")
    lake = str(tmp_path / "lake")
    run = lambda *a: cli.main([a[0], "--lake", lake, *a[1:]], spark)
    run("init-db")
    run("init-db")
    report_id = run("import-pdf", str(pdf), "--market", "us", "--fiscal-year", "2026", "--company-id", "X")
    assert run("import-pdf", str(pdf), "--market", "hk") == report_id
    assert Lake(spark, lake).read("reports").select("market", "fiscal_year").collect() == [("us", 2026)]
    assert run("profile-pdf", report_id) == f"report_id={report_id} pages=2 is_text_pdf=1 keyword_pages=1"
    assert run("profile-pdf", report_id).endswith("keyword_pages=1") and Lake(spark, lake).read("pdf_pages").count() == 2
    assert run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run1") == "extraction_run_id=run1 tables=1 cells=8"
    assert run("classify-tables", "run1") == "extraction_run_id=run1 classified=1 review_required=0"
    assert run("extract-facts", "run1") == "extraction_run_id=run1 facts=3 needs_review=0"
    assert run("extract-facts", "run1").endswith("facts=3 needs_review=0")
    assert run("validate-run", "run1").endswith("results=1 failed=0")
    r = Lake(spark, lake).read("validation_results").first()
    assert (r["status"], r["lhs_value"]) == ("verified", 100_000_000)
    book = tmp_path / "out" / "review.xlsx"
    run("export-review", "run1", str(book))
    assert len(workbook.read_sheet(book, "balance_sheet_raw")) == 4
    assert workbook.metadata_of(book)["extraction_run_id"] == "run1"
    with pytest.raises(ValueError, match="Unknown extraction run"):
        run("validate-run", "nope")
    with pytest.raises(ValueError, match="Unknown report"):
        run("profile-pdf", "nope")
    pdf.write_bytes(b"bad")
    with pytest.raises(RuntimeError, match="broken file"):
        run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run2")
    states = {r["extraction_run_id"]: r["status"] for r in cli.run_events(Lake(spark, lake)).collect()}
    assert states == {"run1": "succeeded", "run2": "failed"}
    pdf.unlink()
    with pytest.raises(FileNotFoundError):
        run("profile-pdf", report_id)
    with pytest.raises(FileNotFoundError):
        run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run3")
    assert {r["extraction_run_id"]: r["status"] for r in cli.run_events(Lake(spark, lake)).collect()}["run3"] == "failed"


@pytest.fixture
def reviewed(spark, tmp_path, monkeypatch):
    """A lake with one run that has been validated, and its verbs."""
    monkeypatch.setitem(documents.EXTRACTORS, "fake", Fake())
    monkeypatch.setattr(documents.read_pages, "__defaults__", (fake_pages,))
    (tmp_path / "report.pdf").write_bytes(b"some file")
    lake = Lake(spark, str(tmp_path / "lake"))
    run = lambda *a: cli.main([a[0], "--lake", lake.root, *a[1:]], spark)
    run("init-db")
    report_id = run("import-pdf", str(tmp_path / "report.pdf"), "--market", "us")
    run("profile-pdf", report_id)
    run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run1")
    for verb in ("classify-tables", "extract-facts", "validate-run"):
        run(verb, "run1")
    return lake, run


def test_rows_of_a_failed_run_are_not_read(spark, reviewed, monkeypatch):
    lake, run = reviewed
    append = Lake.append

    def broken(self, table, rows, generation=0):
        if table == "raw_tables":
            raise OSError("the store is full")
        append(self, table, rows, generation)

    monkeypatch.setattr(Lake, "append", broken)
    report_id = lake.read("reports").first()["report_id"]
    with pytest.raises(OSError):
        run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run2")
    assert lake.read("raw_cells").where("extraction_run_id = 'run2'").count() == 8
    assert cli.raw(lake, "raw_cells", cli.run_events(lake)).where("extraction_run_id = 'run2'").count() == 0


def test_workbook_of_a_run_and_import_of_its_corrections(spark, reviewed, tmp_path):
    lake, run = reviewed
    book, page = tmp_path / "review.xlsx", tmp_path / "s.html"
    run("export-review", "run1", str(book), "--html", str(page))
    raw = workbook.read_sheet(book, "balance_sheet_raw")
    at = {c: i for i, c in enumerate(raw[0])}
    assert [(r[at["row_index"]], r[at["display_col_0"]], r[at["display_col_1"]]) for r in raw[1:]] == [("1", "Total assets", "100"), ("2", "Total liabilities", "40"), ("3", "Total shareholders' equity", "60")]
    assert "validation_failures" in page.read_text() and lake.read("review_exports").count() == 1
    ids = {r[at["normalized_concept_id"]]: r[0] for r in raw[1:]}

    def filled(path, *rows):
        names = [s for s in review.SHEETS if s not in ("corrections",)]
        sheets = {n: spark.createDataFrame([tuple([*r, *[None] * (len(h) - len(r))]) for r in body], ", ".join(f"`{c}` string" for c in h)) for n, (h, *body) in ((n, workbook.read_sheet(book, n)) for n in names)}
        sheets["corrections"] = spark.createDataFrame([(*r, *[None] * (9 - len(r))) for r in rows], ", ".join(f"{c} string" for c in review.CORRECTION_COLUMNS))
        workbook.write_workbook(path, sheets)

    equity = ids["total_equity"]
    bad, good = tmp_path / "bad.xlsx", tmp_path / "good.xlsx"
    filled(bad, (equity, "correct", "x", None, None, None, None, None, "why"), ("nobody", "confirm"))
    with pytest.raises(ValueError, match="2 errors"):
        run("import-corrections", str(bad))
    assert [r[2] for r in workbook.read_sheet(f"{bad}.errors.xlsx", "errors")[1:]] == ["INVALID_DECIMAL", "UNKNOWN_FACT_ID"]
    filled(good, (equity, "correct", "50000000", None, None, None, None, None, "a misprint"))
    said = run("import-corrections", str(good))
    assert "corrections=1" in said and said.endswith("results=1 failed=1")
    assert lake.read("corrections").select("field_name", "old_value", "new_value").where("field_name = 'normalized_value'").collect() == [("normalized_value", "60000000.000000", "50000000")]
    assert sorted(r["status"] for r in lake.read("correction_batches").collect()) == ["accepted", "rejected"]
    with pytest.raises(ValueError, match="already imported"):
        run("import-corrections", str(good))


def test_replacing_with_nothing_clears(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.initialize()
    page = lambda k, n: spark.createDataFrame([(f"{k}{i}", k, i, 0, False) for i in range(n)], "page_id string, report_id string, page_number int, text_char_count int, has_statement_keywords boolean")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "report_id string")
    lake.replace("pdf_pages", page("a", 2).union(page("b", 3)), keys("a", "b"))
    lake.replace("pdf_pages", page("a", 1), keys("a"))
    assert lake.read("pdf_pages").count() == 4
    lake.replace("pdf_pages", page("b", 0), keys("b"))
    assert [r["report_id"] for r in lake.read("pdf_pages").collect()] == ["a"]


def test_stream_registers_new_files_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.initialize()
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(b"1")
    (folder / "b.pdf").write_bytes(b"1")
    go = lambda: ingest.ingest(lake, str(folder), str(tmp_path / "cp"), "us").awaitTermination()
    go()
    (folder / "c.pdf").write_bytes(b"2")
    go()
    go()
    assert lake.read("reports").count() == 2


def test_known_file_after_its_profile(spark, reviewed, tmp_path):
    lake, run = reviewed
    ids = {r["report_id"] for r in lake.read("reports").collect()}
    assert run("import-pdf", str(tmp_path / "report.pdf"), "--market", "us") in ids and lake.read("reports").count() == 1


PAGE = "page_id string, report_id string, page_number int, text_char_count int, has_statement_keywords boolean"


def pages(spark, report, n, first=0):
    return spark.createDataFrame([(f"{report}{i}", report, i, 0, False) for i in range(first, first + n)], PAGE)


def keys(spark, *names):
    return spark.createDataFrame([(x,) for x in names], "report_id string")


def test_reads_of_some_keys_list_their_buckets_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.initialize(buckets=8)
    names = [f"r{i}" for i in range(40)]
    for name in names[:5]:
        lake.append("pdf_pages", pages(spark, name, 2))
    lake.replace("pdf_pages", pages(spark, "r1", 1), keys(spark, "r1"))
    one = lake.read("pdf_pages", ["r1"])
    assert {f.split("bucket=")[1].split("/")[0] for f in one.inputFiles()} == {str(store.bucket_of("r1", 8))}
    assert one.count() == 1 and lake.read("pdf_pages", ["r2", "none"]).count() == 2 and lake.read("pdf_pages").count() == 9


def test_compaction_beside_readers_and_writers(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.initialize(buckets=4)
    for k in range(3):
        lake.replace("pdf_pages", pages(spark, "a", 3 - k).union(pages(spark, "b", 2, k)), keys(spark, "a", "b"))
    before = lake.read("pdf_pages")
    log, seen = lake.commits("pdf_pages"), sorted(map(tuple, before.collect()))
    real, done = store.Lake._write, []

    def slow(self, *args):
        folder = real(self, *args)
        if not done:
            done.append(1)
            lake.append("pdf_pages", pages(spark, "c", 1))  # another writer commits during the work
        return folder

    store.Lake._write = slow
    try:
        lake.compact("pdf_pages")
    finally:
        store.Lake._write = real
    assert sorted(map(tuple, before.collect())) == seen
    after = lake.read("pdf_pages")
    assert sorted(map(tuple, after.where("report_id <> 'c'").collect())) == seen and after.count() == len(seen) + 1
    assert lake.read("pdf_pages", version=log.versions()[2]).count() == 4
    assert lake.vacuum("pdf_pages") == 6 and sorted(map(tuple, lake.read("pdf_pages").collect())) == sorted(map(tuple, after.collect()))
    lake.replace("pdf_pages", pages(spark, "a", 0), keys(spark, "a"))
    assert lake.read("pdf_pages", ["a"]).count() == 0
    assert lake.compact("pdf_pages") and lake.read("pdf_pages", ["a"]).count() == 0 and lake.read("pdf_pages").count() == 3


def test_a_writer_that_dies_leaves_nothing(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.initialize(buckets=2)
    lake.append("pdf_pages", pages(spark, "a", 2))
    monkeypatch.setattr(commits.Commits, "commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        lake.replace("pdf_pages", pages(spark, "a", 1), keys(spark, "a"))
    monkeypatch.undo()
    assert lake.read("pdf_pages").count() == 2


def test_a_version_is_made_once(spark, tmp_path):
    log = commits.Commits(spark, str(tmp_path / "log"))
    log.begin(4)
    log.begin(8)
    assert log.read().buckets == 4
    base = log.read()
    from dataclasses import replace

    assert log._create(replace(base, version=1)) and not log._create(replace(base, version=1))
    made = log.commit(lambda now: ([commits.Folder("x", "rows", (1,))], []))
    assert (made.version, made.folders[0].version) == (2, 2) and log.versions() == [0, 1, 2]


def test_two_publishers_leave_one_active_version(spark, reviewed):
    """Eight at once, and each sees the others' versions superseded."""
    from concurrent.futures import ThreadPoolExecutor

    lake, run = reviewed
    said = run("publish-run", "run1")
    assert said.endswith("facts=3")
    runs = cli.run_events(lake, ["run1"])
    found = lake.read("extracted_facts", ["run1"]).withColumn("validation_status", F.lit("verified"))
    one = lambda k: publish.publish(lake, found, lake.read("reports"), publish.version_rows(runs, "report", None, F.lit(datetime(2026, 5, 1 + k))))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, range(4)))
    held = lake.read("trusted_versions").collect()
    assert sorted(r["status"] for r in held) == ["active", *["superseded"] * 4]
    assert publish.published(lake).count() == 3 and schemas.active_conflicts(lake.read("trusted_versions")).count() == 0
    assert len(run("show-view", "trusted_statement_lines").splitlines()) == 3
    with pytest.raises(ValueError, match="Unknown view"):
        run("show-view", "debug_facts_view")
    assert '"validation_status":"verified"' in run("show-view", "debug_facts_view", "--mode", "debug")
    with pytest.raises(ValueError):
        publish.version_rows(runs, "table", None, F.lit(AT))
    assert run("compact", "trusted_versions", "--vacuum").startswith("table=trusted_versions")
    assert publish.published(lake).count() == 3


def test_only_changed_runs_are_validated_again(spark, reviewed):
    lake, run = reviewed
    report_id = lake.read("reports").first()["report_id"]
    run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run2")
    for verb in ("classify-tables", "extract-facts"):
        run(verb, "run2")
    assert run("validate-changed") == "runs=2 validated=1"  # run1 has been judged as it is
    assert run("validate-changed") == "runs=2 validated=0"
    fact = lake.read("extracted_facts", ["run1"]).where("normalized_concept_id = 'total_equity'").first()["fact_id"]
    lake.append("correction_batches", spark.createDataFrame([("b", "x", report_id, "run1", "p", AT, "accepted")], "correction_batch_id string, review_export_id string, report_id string, extraction_run_id string, imported_workbook_path string, imported_at timestamp, status string"))
    lake.append("corrections", spark.createDataFrame([("c", "b", fact, "normalized_value", "7", "r", AT)], "correction_id string, correction_batch_id string, fact_id string, field_name string, new_value string, correction_reason string, created_at timestamp"))
    before = lake.read("validation_results", ["run2"]).collect()
    assert run("validate-changed") == "runs=2 validated=1" and lake.read("validation_results", ["run2"]).collect() == before
    assert lake.read("validation_results", ["run1"]).first()["status"] == "failed"


def test_digests_know_no_order(spark):
    rows = [("r", "a", "1"), ("r", "b", None), ("r", "b", None), ("s", None, "1")]
    digest = lambda rows: {r[0]: r[1] for r in validate.fact_digests(spark.createDataFrame(rows, "extraction_run_id string, x string, y string"), columns=["x", "y"]).collect()}
    assert digest(rows) == digest(rows[::-1])
    assert digest(rows)["r"] != digest(rows[1:])["r"] != digest([*rows[:2], rows[3]])["r"]
    assert digest([("r", "a", None)]) != digest([("r", None, "a")])


def test_publishing_needs_the_other_run_to_agree(spark, reviewed):
    lake, run = reviewed
    report_id = lake.read("reports").first()["report_id"]
    run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run2")
    for verb in ("classify-tables", "extract-facts", "validate-run"):
        run(verb, "run2")
    assert run("publish-run", "run1", "--agree-with", "run2", "--scope", "statement", "--scope-key", "balance_sheet").endswith("facts=3")
    other = lake.read("extracted_facts", ["run2"]).withColumn("normalized_value", F.col("normalized_value") * 2)
    lake.replace("extracted_facts", other, spark.createDataFrame([("run2",)], "extraction_run_id string"))
    assert run("publish-run", "run1", "--agree-with", "run2").endswith("facts=0")


def test_checks(spark):
    v = spark.createDataFrame([("1", "r", "table", None, "active", AT), ("2", "r", "table", "", "active", AT), ("3", "r", "table", "t", "active", AT), ("4", "r", "table", None, "inactive", AT)], "trusted_version_id string, report_id string, scope string, scope_key string, status string, published_at timestamp")
    assert [tuple(r) for r in schemas.active_conflicts(v).collect()] == [("r", "table", "", 2)]
    assert schemas.active_conflicts(publish.activated(v)).count() == 0
    a = spark.createDataFrame([("x", 1), ("y", None), ("x", 3)], "k string, p int")
    assert [tuple(r) for r in schemas.repeated_keys(a, ["k"]).collect()] == [("x", 2)]
    assert schemas.orphans(a, "p", spark.createDataFrame([(1,)], "id int"), "id").collect() == [("x", 3)]
    assert schemas.not_allowed(spark.createDataFrame([("us",), ("xx",), (None,)], "m string"), "m", "market").count() == 2
    assert len(schemas.AUDIT_TABLES) == 14 and len(schemas.SCHEMAS["extracted_facts"]) == 36 + 3  # and the place of a fact in its table
    with pytest.raises(ValueError):
        schemas.conformed(a, "reports")


def test_rule_packs(tmp_path):
    packs = rulepack.load_all()
    assert {len(p.version) for p in packs.values()} == {64} and len({p.version for p in packs.values()}) == 3
    (tmp_path / "us").mkdir()
    (tmp_path / "us" / "note_roles.yml").write_text("")
    with pytest.raises(FileNotFoundError, match="table_titles.*validation_overrides"):
        rulepack.load("us", tmp_path)
    for f in rulepack.FILES:
        (tmp_path / "us" / f"{f}.yml").write_text("")
    assert rulepack.load("us", tmp_path).absolute_tolerance == 2
    (tmp_path / "us" / "note_roles.yml").write_text("- a")
    with pytest.raises(ValueError):
        rulepack.load("us", tmp_path)


def test_dedupe_and_latest(spark):
    batch = spark.createDataFrame([("h1", "a"), ("h1", "b"), ("h2", "c"), ("h3", "d")], "file_sha256 string, p string")
    held = spark.createDataFrame([("h3", "r3")], "file_sha256 string, report_id string")
    assert sorted(r["p"] for r in register.new_reports(batch, held, ["p"]).collect()) == ["a", "c"]
    runs = spark.createDataFrame([("r", "1", 5), ("r", "2", 5), ("q", "3", 1)], "report_id string, extraction_run_id string, run_started_at int")
    assert sorted(map(tuple, register.latest_runs(runs).collect())) == [("q", "3"), ("r", "2")]


FACTS = "fact_id string, extraction_run_id string, normalized_value decimal(38,6), raw_unit string, normalized_concept_id string, period_basis string, statement_scope string, table_role string, validation_status string"
SHEET = "row_number int, " + ", ".join(f"{c} string" for c in review.CORRECTION_COLUMNS)


@pytest.fixture(scope="module")
def held(spark):
    return spark.createDataFrame([(f"f{i}", "run", Decimal(i * 10), "元", "revenue", "p", "s", "t", "failed") for i in range(1, 5)], FACTS)


def row(n, fact, action, value=None, unit=None, concept=None, reason="r"):
    return (n, fact, action, value, unit, concept, None, None, None, reason)


def test_correction_errors(spark, held):
    rows = [row(1, "f1", "confirm", reason=None), row(2, "zz", "confirm"), row(3, "f2", "change"), row(4, "f2", "correct", reason=" "), row(5, "f3", "correct", "x1"), row(6, "f3", "remap"), row(7, "f4", "correct", "1.5", "pounds"), row(8, "f4", "ignore"), row(9, "f4", "ignore")]
    got = corrections.error_rows(spark.createDataFrame(rows, SHEET), held, "run").collect()
    assert sorted((r["row_number"], r["error_code"]) for r in got) == [(2, "UNKNOWN_FACT_ID"), (3, "INVALID_ACTION"), (4, "MISSING_CORRECTED_VALUE"), (4, "MISSING_REASON"), (5, "INVALID_DECIMAL"), (6, "MISSING_CORRECTED_VALUE"), (7, "INVALID_UNIT"), (8, "DUPLICATE_CORRECTION_ROW"), (9, "DUPLICATE_CORRECTION_ROW")]
    other = corrections.error_rows(spark.createDataFrame([row(1, "f1", "confirm")], SHEET), held, "other").collect()
    assert [r["error_code"] for r in other] == ["FACT_NOT_IN_EXTRACTION_RUN"]


def test_effective_facts_and_status(spark, held):
    rows = spark.createDataFrame([row(1, "f1", "correct", "101.25", "万元"), row(2, "f2", "remap", None, None, "net_profit"), row(3, "f3", "ignore"), row(4, "f4", "confirm")], SHEET)
    log = corrections.history(rows, held, F.lit("b1"), F.lit(AT))
    assert {(r["fact_id"], r["field_name"], r["old_value"], r["new_value"]) for r in log.collect()} >= {("f1", "normalized_value", "10.000000", "101.25"), ("f2", "normalized_concept_id", "revenue", "net_profit")}
    later = corrections.history(spark.createDataFrame([row(1, "f1", "correct", "7")], SHEET), held, F.lit("b2"), F.lit(datetime(2026, 2, 1)))
    now = corrections.effective(held, log.unionByName(later))
    got = {r["fact_id"]: (float(r["normalized_value"]), r["raw_unit"], r["normalized_concept_id"], r["validation_status"]) for r in corrections.candidate_status(now).collect()}
    assert got == {"f1": (7.0, "万元", "revenue", "failed"), "f2": (20.0, "元", "net_profit", "failed"), "f4": (40.0, "元", "revenue", "manually_confirmed")}


def test_workbook_round_trip(spark, tmp_path):
    meta = spark.createDataFrame([("1", "r", "run", "x", "v", "now")], ", ".join(f"{c} string" for c in review.METADATA_KEYS))
    results = spark.createDataFrame([("a", "failed", ["f1"], 1.0), ("b", "verified", ["f2"], 2.0)], "validation_result_id string, status string, involved_fact_ids array<string>, lhs_value double")
    rows = spark.createDataFrame([("f1", "statement.cash_flow", None, "x<&>\x01"), ("f2", "note.revenue_by_product", None, "n"), ("f3", "unknown", "balance_sheet_raw", "b"), ("f4", "note.revenue", "elsewhere", "y")], "fact_id string, table_role string, target_sheet string, display_col_10 string")
    sheets = review.workbook_sheets(meta, results, rows)
    assert tuple(sheets) == review.SHEETS
    book = tmp_path / "a" / "b.xlsx"
    workbook.write_workbook(book, sheets)
    assert workbook.read_sheet(book, "validation_failures")[1][:6] == ["a", None, None, "failed", None, '["f1"]']
    assert workbook.read_sheet(book, "cash_flow_raw")[1][-1] == "x<&>" and len(workbook.read_sheet(book, "notes_revenue_raw")) == 1
    assert workbook.read_sheet(book, "balance_sheet_raw")[1][0] == "f3"
    assert workbook.corrections_of(spark, book).count() == 0
    sheets["corrections"] = spark.createDataFrame([("f1", "correct", "1", None, None, None, None, None, "why"), (None,) * 9], ", ".join(f"{c} string" for c in review.CORRECTION_COLUMNS))
    workbook.write_workbook(book, sheets)
    assert [r["fact_id"] for r in workbook.corrections_of(spark, book).collect()] == ["f1"]
    with pytest.raises(ValueError, match="no sheet"):
        workbook.read_sheet(book, "zz")
    with pytest.raises(ValueError, match="lacks"):
        review.read_corrections(meta)
    assert review.display_columns(["display_col_10", "display_col_2", "display_col_x", "z"]) == ["display_col_2", "display_col_10", "display_col_x"]
    workbook.html_summary(tmp_path / "s.html", "T<", {"failures": sheets["validation_failures"]})
    assert "T&lt;" in (tmp_path / "s.html").read_text()


def test_importable(spark):
    exports = spark.createDataFrame([("x", "r", "run", "exported"), ("y", "r", "run", "superseded")], "review_export_id string, report_id string, extraction_run_id string, status string")
    batches = spark.createDataFrame([("x", "rejected")], "review_export_id string, status string")
    meta = {"review_export_id": "x", "report_id": "r", "extraction_run_id": "run"}
    assert corrections.importable(meta, exports, batches).count() == 1
    assert corrections.importable(meta | {"report_id": "q"}, exports, batches).count() == 0
    assert corrections.importable(meta | {"review_export_id": "y"}, exports, batches).count() == 0
    assert corrections.importable(meta, exports, spark.createDataFrame([("x", "accepted")], batches.schema)).count() == 0


def test_agreement_gate(spark):
    a = spark.createDataFrame([("x", None, "100"), ("y", "p", "5"), ("z", "p", "1")], "c string, p string, normalized_value string")
    b = spark.createDataFrame([("x", None, "101"), ("y", "p", "50"), ("w", "p", "1")], "c string, p string, normalized_value string")
    got = agreement.agreement(a, b, ["c", "p"])
    assert {(r["c"], r["agreement_status"]) for r in got.collect()} == {("x", "agreed"), ("y", agreement.CONFLICT), ("z", agreement.CONFLICT), ("w", agreement.CONFLICT)}
    many = lambda *v: spark.createDataFrame([("k", x) for x in v], "c string, normalized_value string")
    pairs = lambda a, b: sorted((int(r["value_a"]) if r["value_a"] is not None else -1, int(r["value_b"]) if r["value_b"] is not None else -1, r["agreement_status"] == "agreed") for r in agreement.agreement(many(*a), many(*b), ["c"]).collect())
    assert pairs(["5", "5"], ["5", "5"]) == [(5, 5, True)] * 2
    assert pairs(["1", "9", "100"], ["9", "101", None]) == [(1, -1, False), (9, 9, True), (100, 101, True)]
    assert pairs(["7", "7", "7"], ["8", "30"]) == [(7, -1, False), (7, 8, True), (7, 30, False)]
    assert pairs(["1000000"], ["1000090", "1000300"]) == [(-1, 1000300, False), (1000000, 1000090, True)]
    rows = spark.createDataFrame([("x", 0.99, 0.99, "verified"), ("x", 0.0, 0.99, "verified"), ("y", 0.99, 0.99, "verified")], "c string, unit_confidence double, mapping_confidence double, validation_status string")
    assert [r["auto_trusted"] for r in publish.auto_trust(rows, got, ["c"]).orderBy("c", F.desc("unit_confidence")).collect()] == [True, False, False]


@pytest.mark.parametrize(("status", "want"), [("verified", True), ("verified_with_rounding", True), ("manually_confirmed", True), ("failed", False), ("blocked_unit_unknown", False), ("blocked_extractor_conflict", False), ("requires_manual_review", False), ("normalized", False), ("", False)])
def test_trusted_statuses(spark, status, want):
    assert spark.range(1).select(publish.is_trusted(F.lit(status))).first()[0] is want


def test_views(spark):
    schema = schemas.SCHEMAS["trusted_facts"]
    base = {"trusted_version_id": "v", "report_id": "r", "company_id": "c", "market": "us", "fiscal_year": 2026, "report_type": "annual", "statement_scope": "consolidated", "period_basis": "point_in_time", "currency": "USD", "trusted_status": "verified"}
    one = lambda f, role, concept, v, page: {**{n: None for n in schema.names}, **base, "fact_id": f, "table_role": role, "statement_type": role.split(".")[1], "effective_concept_id": concept, "effective_value": Decimal(v), "source_page": page, "raw_label": f}
    rows = [one("a", "statement.balance_sheet", "total_assets", 1, 1), one("b", "statement.balance_sheet", "total_assets", 2, 9), one("c", "statement.balance_sheet", "odd", 3, 1), one("d", "note.revenue_by_product", "revenue", 4, 2)]
    trusted = spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)
    views.register(spark, trusted)
    assert spark.table("trusted_statement_lines").columns == views.LINE_COLUMNS and spark.table("trusted_statement_lines").count() == 3
    note = spark.table("trusted_note_facts").first()
    assert (note["dimension_name"], note["dimension_value"]) == ("product", "d")
    wide = spark.table("statement_wide_balance_sheet").collect()
    assert len(wide) == 1 and wide[0]["total_assets"] == 2 and "odd" not in wide[0].asDict()
    assert spark.table("company_period_summary").first()["fact_count"] == 4 and spark.table("ai_trusted_facts_view").count() == 4
