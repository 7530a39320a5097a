"""Many review workbooks at once."""

import os

import pytest
from pyspark.sql import functions as F
from test_lake import reviewed  # noqa: F401

from filingmill.operators import corrections, review
from filingmill.sources import books, workbook


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, books.ROWS)


def test_two_hundred_workbooks_round_trip(spark, tmp_path):
    names = spark.range(200).select(F.format_string("r%d/review.xlsx", "id").alias("workbook"), "id")
    sheets = names.select("*", F.explode(F.array(F.lit("corrections"), F.lit("summary"), F.lit("errors"))).alias("sheet"))
    cells = F.array(F.lit("a <&> b"), F.lit(None).cast("string"), F.format_string("%d-%d", "id", "row_number"))
    rows = sheets.withColumn("row_number", F.explode(F.sequence(F.lit(1), F.lit(3)))).select("workbook", "sheet", "row_number", cells.alias("cells"))
    books.write_books(rows, str(tmp_path))
    found = books.read_books(spark, str(tmp_path), "summary", "corrections", "errors")
    assert found.where("error is not null").count() == 0
    got = found.drop("error")
    assert got.count() == 1800 and got.exceptAll(rows).count() == 0
    assert not (tmp_path / books.STAGED).exists()
    assert workbook.read_sheet(tmp_path / "r7/review.xlsx", "summary")[2] == ["a <&> b", None, "7-3"]


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    rows = rows_of(spark, ("ok.xlsx", "summary", 1, ["a"]), ("fine/ok.xlsx", "summary", 1, ["a"]), ("../out.xlsx", "summary", 1, ["a"]))
    with pytest.raises(Exception, match="not a path below the folder"):
        books.write_books(rows, str(tmp_path / "books"))
    assert [f for _, _, files in os.walk(tmp_path) for f in files] == []


def test_broken_files_do_not_stop_others(spark, tmp_path):
    books.write_books(rows_of(spark, ("a.xlsx", "summary", 1, ["x", None, "z"]), ("a.xlsx", "summary", 2, None)), str(tmp_path))
    (tmp_path / "b.xlsx").write_bytes(b"no workbook")
    (tmp_path / "c.txt").write_bytes(b"")
    found = {(r["workbook"], r["sheet"]): r for r in books.read_books(spark, str(tmp_path), "summary", "corrections").collect() if r["row_number"] == 1}
    assert found["a.xlsx", "summary"]["cells"] == ["x", None, "z"] and "no sheet" in found["a.xlsx", "corrections"]["error"]
    assert found["b.xlsx", "summary"]["error"] and found["b.xlsx", "summary"]["cells"] is None and len(found) == 4


def test_empty_folder_and_no_rows(spark, tmp_path):
    books.write_books(rows_of(spark), str(tmp_path))
    assert books.read_books(spark, str(tmp_path)).count() == 0


def test_files_are_packed_by_size(tmp_path, monkeypatch):
    for n in range(10):
        (tmp_path / f"{n}.xlsx").write_bytes(b"x" * 100)
    monkeypatch.setattr(books, "TASK_BYTES", 350)
    monkeypatch.setattr(books, "OPEN_BYTES", 10)
    packs = books.Reader(str(tmp_path), ["summary"]).partitions()
    assert [len(p.names) for p in packs] == [3, 3, 3, 1]


def test_book_rows_equal_the_sheets_of_one_report(spark, reviewed, tmp_path):  # noqa: F811
    lake, run = reviewed
    run("export-review", "run1", str(tmp_path / "one.xlsx"))
    run("export-reviews", str(tmp_path / "many"))
    (path,) = (tmp_path / "many").rglob("*.xlsx")
    assert path.relative_to(tmp_path / "many").as_posix() == f"{lake.read('reports').first()['report_id']}/run1/review.xlsx"
    for sheet in review.SHEETS:
        one, many = (workbook.read_sheet(p, sheet) for p in (tmp_path / "one.xlsx", path))
        if sheet in ("summary", "_metadata"):
            one, many = ([r for r in rows if r[0] != "exported_at"] for rows in (one, many))
        wide = len(many[0])
        # a sheet without rows has no display columns here
        assert [(r + [None] * wide)[:wide] for r in one] == [(r + [None] * wide)[:wide] for r in many]


def with_corrections(spark, source, folder, name, *rows):
    """A copy of a workbook with other corrections."""
    held = [(name, s, n, r) for s in review.SHEETS if s != "corrections" for n, r in enumerate(workbook.read_sheet(source, s), 1)]
    filled = [review.CORRECTION_COLUMNS, *[[*r, *[None] * (9 - len(r))] for r in rows]]
    books.write_books(rows_of(spark, *held, *[(name, "corrections", n, r) for n, r in enumerate(filled, 1)]), str(folder))


def test_import_of_many_workbooks(spark, reviewed, tmp_path):  # noqa: F811
    lake, run = reviewed
    report_id = lake.read("reports").first()["report_id"]
    run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run2")
    for verb in ("classify-tables", "extract-facts", "validate-run"):
        run(verb, "run2")
    assert run("export-reviews", str(tmp_path / "out")).endswith("workbooks=2")
    fact = {(r["extraction_run_id"], r["normalized_concept_id"]): r["fact_id"] for r in lake.read("extracted_facts").collect()}
    done = tmp_path / "done"
    sources = {r: tmp_path / "out" / report_id / r / "review.xlsx" for r in ("run1", "run2")}
    why = (None, None, None, None, None, "a misprint")
    with_corrections(spark, sources["run1"], done, "a.xlsx", (fact["run1", "total_equity"], "correct", "50000000", *why))
    with_corrections(spark, sources["run1"], done, "copy.xlsx", (fact["run1", "total_equity"], "correct", "1", *why))
    with_corrections(spark, sources["run2"], done, "b.xlsx", (fact["run2", "total_equity"], "correct", "x", *why), (fact["run1", "total_equity"], "confirm"))
    (done / "broken.xlsx").write_bytes(b"?")
    said = run("import-reviews", str(done))
    assert said.startswith("accepted=1 rejected=1 refused=2") and "refused copy.xlsx: another workbook" in said
    assert [r[1:] for r in workbook.read_sheet(done / "errors" / "b.xlsx", "errors")[1:]] == [[fact["run2", "total_equity"], "INVALID_DECIMAL"], [fact["run1", "total_equity"], "FACT_NOT_IN_EXTRACTION_RUN"]]
    assert {(r["extraction_run_id"], r["status"]) for r in lake.read("correction_batches").collect()} == {("run1", "accepted"), ("run2", "rejected")}
    log = lake.read("corrections").where("field_name = 'normalized_value'").collect()
    assert [(r["fact_id"], r["new_value"]) for r in log] == [(fact["run1", "total_equity"], "50000000")]
    status = {r["extraction_run_id"]: r["status"] for r in lake.read("validation_results").collect()}
    assert status == {"run1": "failed", "run2": "verified"}
    again = run("import-reviews", str(done))
    assert again.startswith("accepted=0 rejected=1") and "refused a.xlsx: already imported" in again


def test_sheets_by_their_own_headers(spark):
    head = ["extra", *reversed(review.CORRECTION_COLUMNS), "fact_id"]
    rows = [("a", "corrections", 1, head, None), ("a", "corrections", 2, ["e", "why", *[None] * 7, "f1", "other"], None), ("a", "corrections", 3, [], None), ("b", "corrections", 1, ["fact_id"], None)]
    frame = spark.createDataFrame(rows, books.ROWS + ", error string")
    assert [(r["row_number"], r["fact_id"], r["correction_reason"]) for r in corrections.sheets_of(frame).collect()] == [(2, "f1", "why")]
    said = {r["workbook"]: r["book_error"] for r in corrections.books_of(frame).collect()}
    assert said["a"] is None and said["b"].startswith("the corrections sheet lacks correction_action")
