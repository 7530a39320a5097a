"""Alignment of two runs of a report, and the decisions that a new run keeps."""

import random
import time
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_lake import reviewed  # noqa: F401

from filingmill.operators import realign

CELLS = "report_id string, page_number int, table_index_on_page int, row_index int, column_index int, raw_text string, raw_cell_id string"


def longest(a, b):
    """The length of a longest common subsequence, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        row, up = [0], row
        for j, y in enumerate(b):
            row.append(up[j] + 1 if x == y else max(up[j + 1], row[j]))
    return row[-1]


@pytest.mark.parametrize("bits", [1 << 28, 16])
def test_common_equals_the_plain_table(monkeypatch, bits):
    monkeypatch.setattr(realign, "HELD_BITS", bits)
    draw = random.Random(bits)
    for _ in range(400):
        a, b = ("".join(draw.choices("abcd", k=draw.randrange(14))) for _ in range(2))
        pairs = realign.common(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == longest(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        for gaps in (False, True):
            both = realign.merged(a, b, gaps)
            assert [i for i, _ in both if i is not None] == list(range(len(a))) and [j for _, j in both if j is not None] == list(range(len(b)))


def test_long_pages_take_little_time():
    a = [f"row {i % 500}" for i in range(8000)]
    b = [x for i, x in enumerate(a) if i % 7] + ["more"] * 300
    start = time.monotonic()
    assert len(realign.common(a, b)) == sum(1 for i in range(8000) if i % 7)
    assert time.monotonic() - start < 20


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz"])
def test_groups_met_at_once_equal_groups_met_one_by_one(letters):
    draw = random.Random(letters)
    for _ in range(60):
        groups = []
        for _ in range(draw.randrange(12)):
            a = draw.choices(range(len(letters)), k=draw.randrange(7))
            groups.append((a, draw.choice([a, a[1:], [*a[::2], 1], draw.choices(range(len(letters)), k=draw.randrange(7))])))
        (left, a), (right, b) = (([g for g, pair in enumerate(groups) for _ in pair[k]], [x for pair in groups for x in pair[k]]) for k in (0, 1))
        got = realign._shared(*(np.array(x, np.int64) for x in (left, a, right, b)))
        beside = realign._beside(*(np.array(x, np.int64) for x in (left, a, right, b)))
        pairs, partners, s, t = [], [], 0, 0
        for x, y in groups:
            pairs += [(s + i, t + j) for i, j in realign.common(x, y)]
            partners += [-1 if j is None else t + j for i, j in realign.merged(x, y, True) if i is not None]
            s, t = s + len(x), t + len(y)
        assert list(zip(*(x.tolist() for x in got))) == pairs and beside.tolist() == partners


def cells(spark, run, *rows, report="r", page=1):
    """Cells of (table, row, texts)."""
    held = [(report, page, t, r, c, x, f"{run}/{t}/{r}/{c}") for t, r, texts in rows for c, x in enumerate(texts)]
    return spark.createDataFrame(held, CELLS)


def kinds(found):
    at = lambda x: None if x is None else (x["table_index_on_page"], x["row_index"], x["column_index"])
    return sorted(((at(r["old"]), at(r["new"]), r["kind"]) for r in found.collect()), key=str)


def test_cells_of_shifted_rows_columns_and_tables(spark):
    old = cells(spark, "old", (0, 0, ["Other", "5", "6"]), (0, 1, ["Total", "7", None]), (1, 0, ["Other", "9", "9"]), (1, 1, ["Lost", "1", "2"]))
    new = cells(spark, "new", (0, 0, ["Notes"]), (1, 0, [None, "Other", "5", "60"]), (1, 1, ["TOTAL", "7"]), (2, 0, ["Other", "9", "9"]))
    assert kinds(realign.aligned_cells(old, new)) == sorted(
        [
            (None, (0, 0, 0), "added"),
            ((0, 0, 0), (1, 0, 1), "moved"), ((0, 0, 1), (1, 0, 2), "moved"), ((0, 0, 2), (1, 0, 3), "changed"),
            ((0, 1, 0), (1, 1, 0), "changed"), ((0, 1, 1), (1, 1, 1), "moved"),
            ((1, 0, 0), (2, 0, 0), "moved"), ((1, 0, 1), (2, 0, 1), "moved"), ((1, 0, 2), (2, 0, 2), "moved"),
            ((1, 1, 0), None, "gone"), ((1, 1, 1), None, "gone"), ((1, 1, 2), None, "gone"),
        ],
        key=str,
    )


def test_pages_and_reports_do_not_mix_and_nothing_is_nothing(spark):
    old, new = cells(spark, "old", (0, 0, ["a", "1"])), cells(spark, "new", (0, 0, ["a", "1"]))
    assert [k for *_, k in kinds(realign.aligned_cells(old, new))] == ["kept", "kept"]
    for other in (cells(spark, "new", (0, 0, ["a", "1"]), page=2), cells(spark, "new", (0, 0, ["a", "1"]), report="s")):
        assert sorted(k for *_, k in kinds(realign.aligned_cells(old, other))) == ["added", "added", "gone", "gone"]
    none = old.where("false")
    assert kinds(realign.aligned_cells(none, none)) == [] and [k for *_, k in kinds(realign.aligned_cells(old, none))] == ["gone", "gone"]


def test_pages_are_dealt_once_and_may_span_batches(spark):
    draw, rows, wanted = random.Random(5), {"old": [], "new": []}, {}
    for page in range(60):
        for run in rows:
            rows[run] += [(None if page == 7 else "r", page, 0, r, c, draw.choice("ab cd" if page != 7 else "abcd"), f"{run}/{page}/{r}/{c}") for r in range(draw.randrange(page == 7, 5)) for c in range(draw.randrange(1, 4))]
    old, new = (spark.createDataFrame(rows[run], CELLS) for run in ("old", "new"))
    for size in ("1", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found = realign.aligned_cells(old, new)
            assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
            got = [(r["page_number"], r["kind"], *((x and x["raw_cell_id"]) for x in (r["old"], r["new"]))) for r in found.collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        for k, run in ((2, "old"), (3, "new")):
            assert sorted(g[k] for g in got if g[k]) == sorted(x[-1] for x in rows[run] if x[5].strip())
        assert {g[1] for g in got if g[0] == 7} == {"gone", "added"}
        assert wanted.setdefault("all", sorted(map(str, got))) == sorted(map(str, got))
    for page in range(60):
        lines = [[tuple(x[5] for x in rows[run] if x[1] == page and x[3] == r and x[5].strip()) for r in range(5)] for run in rows]
        kept = sum(1 for g in got if g[0] == page and g[1] in ("kept", "moved"))
        if page != 7 and lines[0] == lines[1]:
            assert kept == sum(map(len, lines[0]))


def test_decisions_go_to_the_same_cell_only(spark):
    at = datetime(2026, 1, 1)
    old = cells(spark, "old", (0, 0, ["Sales", "5"]), (0, 1, ["Costs", "4"]), (0, 2, ["Tax", "1"]), (0, 3, ["Rent", "2"]))
    new = cells(spark, "new", (0, 0, ["Title"]), (0, 1, ["Sales", "5"]), (0, 2, ["Costs", "40"]), (0, 3, ["Rent", "2"]))
    schema = "fact_id string, raw_cell_id string, normalized_concept_id string, raw_unit string, normalized_value decimal(38,6), period_basis string, statement_scope string, table_role string"
    fact = lambda run, i, cell, unit="USD", concept="c": (i, cell and f"{run}/{cell}", concept, unit, None, "year", "all", "role")
    olds = spark.createDataFrame([fact("old", "sales", "0/0/1"), fact("old", "costs", "0/1/1"), fact("old", "tax", "0/2/1"), fact("old", "rent", "0/3/1"), fact("old", "bare", None)], schema)
    news = spark.createDataFrame([fact("new", "sales2", "0/1/1"), fact("new", "costs2", "0/2/1"), fact("new", "rent2", "0/3/1", "HKD")], schema)
    found = realign.outcomes(olds, news, realign.aligned_cells(old, new))
    assert {r["fact_id"]: (r["outcome"], r["new_fact_id"]) for r in found.collect()} == {"sales": ("carried", "sales2"), "costs": ("changed", None), "tax": ("gone", None), "rent": ("unit", None), "bare": ("no_cell", None)}
    log_schema = "correction_id string, fact_id string, field_name string, new_value string, correction_reason string, created_at timestamp"
    log = spark.createDataFrame([("1", "sales", "period_basis", "month", "first", at), ("2", "sales", "period_basis", "quarter", "then", at), ("3", "sales", "correction_action", "remap", "then", at), ("4", "costs", "correction_action", "ignore", "no", at)], log_schema)
    rows = realign.carried(log, found, news, log.where("false"), "b", F.lit(at))
    assert sorted((r["fact_id"], r["field_name"], r["old_value"], r["new_value"], r["correction_reason"]) for r in rows.collect()) == [("sales2", "correction_action", None, "remap", "then"), ("sales2", "period_basis", "year", "quarter", "then")]
    own = spark.createDataFrame([("9", "sales2", "period_basis", "half", "newer", at)], log_schema)
    assert [r["field_name"] for r in realign.carried(log, found, news, own, "b", F.lit(at)).collect()] == ["correction_action"]


def test_outcomes_on_pages_equal_joined_ones_and_shuffle_once(spark):
    draw, texts, held = random.Random(3), {"old": [], "new": []}, {"old": [], "new": []}
    for page in range(40):
        for run in texts:
            if run == "old" or page % 2:
                shape = [(r, c, draw.choice(["C" if r else "c", "a", " d  e", " ", None])) for r in range(draw.randrange(5)) for c in range(draw.randrange(4))]
            own = [(None if page == 7 else "r", page, 0, r, c, x, f"{run}/{page}/{r}/{c}") for r, c, x in shape]
            texts[run] += own
            ids = [x[-1] for x in own] + [None, f"{run}/{page}/none"]
            held[run] += [(None if page == 7 else "r", page, f"{run}:{page}:{i}", draw.choice(ids), draw.choice(["x", "y", None]), draw.choice(["USD", "HKD", None])) for i in range(draw.randrange(30))]
    old, new = (spark.createDataFrame(texts[run], CELLS) for run in ("old", "new"))
    olds, news = (spark.createDataFrame(held[run], "report_id string, page_number int, fact_id string, raw_cell_id string, normalized_concept_id string, raw_unit string") for run in ("old", "new"))
    found = realign.outcomes_on_pages(realign.both_runs(olds, news), realign.both_runs(old, new))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = sorted(map(str, found.collect()))
    assert got == sorted(map(str, realign.outcomes(olds, news, realign.aligned_cells(old, new)).collect()))
    assert {k.split("outcome='")[1].split("'")[0] for k in got} == {"no_cell", "gone", "changed", "no_fact", "unit", "carried"}
    none = realign.outcomes_on_pages(realign.both_runs(olds, news.where("false")), realign.both_runs(old.where("false"), new.where("false")))
    assert {r["outcome"] for r in none.collect()} == {"no_cell"}


def test_a_new_run_keeps_the_corrections_of_the_old(spark, reviewed, tmp_path):  # noqa: F811
    lake, run = reviewed
    report_id = lake.read("reports").first()["report_id"]
    run("extract-tables", report_id, "--extractor", "fake", "--run-id", "run2")
    for verb in ("classify-tables", "extract-facts", "validate-run"):
        run(verb, "run2")
    fact = {(r["extraction_run_id"], r["normalized_concept_id"]): r["fact_id"] for r in lake.read("extracted_facts").collect()}
    at = datetime(2026, 1, 1)
    log = [(f"c{i}", "b1", fact["run1", "total_equity"], *x, "a misprint", at) for i, x in enumerate([("normalized_value", "60000000", "50000000"), ("correction_action", None, "correct")])]
    lake.append("corrections", spark.createDataFrame(log, "correction_id string, correction_batch_id string, fact_id string, field_name string, old_value string, new_value string, correction_reason string, created_at timestamp"))
    lake.append("correction_batches", spark.createDataFrame([("b1", "e1", report_id, "run1", "book.xlsx", at, "accepted")], "correction_batch_id string, review_export_id string, report_id string, extraction_run_id string, imported_workbook_path string, imported_at timestamp, status string"))
    assert run("carry-corrections", "run1", "run2") == "facts=1 carried=1 corrections=2"
    rows = lake.read("corrections").where("correction_batch_id <> 'b1' and field_name = 'normalized_value'").collect()
    assert [(r["fact_id"], r["old_value"], r["new_value"], r["correction_reason"]) for r in rows] == [(fact["run2", "total_equity"], "60000000.000000", "50000000", "a misprint")]
    assert {r["extraction_run_id"]: r["status"] for r in lake.read("validation_results").collect()} == {"run1": "verified", "run2": "failed"}
    assert run("carry-corrections", "run1", "run2") == "facts=1 carried=1 corrections=0"
    with pytest.raises(ValueError, match="Unknown extraction run"):
        run("carry-corrections", "run1", "run9")
    assert '"label":"total' not in run("suggest-aliases", "--run", "run1")
