"""The stages on rows, as the extractors would give them."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from filingmill.operators import classify, facts, profile, rawtables, validate
from filingmill.sources import rulepack
from filingmill.sources.schemas import conformed

PACKS = rulepack.load_all()
WHEN = datetime(2026, 1, 1)
CELLS = "extraction_run_id string, report_id string, extractor_name string, page_number int, table_index_on_page int, cells array<struct<row_index:int,column_index:int,raw_text:string,bbox:array<double>>>"


def grid(*rows):
    return [(r, c, x, [10.0, float(r), 20.0, r + 1.0]) for r, row in enumerate(rows) for c, x in enumerate(row)]


@pytest.fixture(scope="module")
def stages(spark):
    """Two reports: one with a full balance sheet, one without equity."""
    reports = spark.createDataFrame([("r1", "us", "LARCH", "Larch Mills", 2026, "annual", "pdf"), ("r2", "us", "OTHER", None, 2026, "annual", "pdf")], "report_id string, market string, company_id string, company_name string, fiscal_year int, report_type string, source_type string")
    runs = spark.createDataFrame([("run1", "r1"), ("run2", "r2")], "extraction_run_id string, report_id string")
    text = "Consolidated Balance Sheets\nUSD thousands"
    pages = spark.createDataFrame([("r1", 1, text), ("r2", 1, text)], "report_id string, page_number int, page_text_sample string")
    head = ["Caption", "Figures"]
    full = grid(head, ["Total assets", "731"], ["Total liabilities", "512"], ["Total stockholders' equity", "219"], ["Looms in use", "8"], [None, "5"])
    part = grid(head, ["TOTAL   assets", "n/a"], ["total liabilities", "(40)"])
    tables = spark.createDataFrame([("run1", "r1", "fake", 1, 0, full), ("run2", "r2", "fake", 1, 0, part), ("run2", "r2", "fake", 1, 1, [])], CELLS)
    held = tables.withColumn("raw_table_id", rawtables.raw_table_id())
    cells = rawtables.raw_cell_columns(rawtables.exploded_tables(held))
    sized = held.join(rawtables.grid_size(cells, ["raw_table_id"]), "raw_table_id").join(rawtables.table_text(cells, ["raw_table_id"]), "raw_table_id")
    marked = classify.classify_runs(sized, cells, pages, runs, reports, PACKS, F.lit(WHEN))
    found = facts.extract_facts(marked, sized, cells, pages, runs, reports, PACKS, rulepack.alias_table(spark, PACKS), F.lit(WHEN))
    return {"reports": reports, "runs": runs, "tables": sized, "cells": cells, "classified": marked, "facts": found}


def test_raw_tables(stages):
    assert stages["tables"].count() == 2
    r = stages["tables"].where("report_id = 'r1'").first()
    assert (r["row_count"], r["column_count"]) == (6, 2)
    assert r["raw_table_text"] == "Caption\tFigures\nTotal assets\t731\nTotal liabilities\t512\nTotal stockholders' equity\t219\nLooms in use\t8\n\t5"


def test_classified(stages):
    rows = conformed(stages["classified"], "classified_tables").collect()
    assert {(r["table_role"], r["statement_scope"], r["classification_confidence"], r["requires_review"]) for r in rows} == {("statement.balance_sheet", "consolidated", 0.95, False)}


def test_facts_have_full_rows(stages):
    got = {r["normalized_concept_id"]: r for r in conformed(stages["facts"], "extracted_facts").where("report_id = 'r1'").collect()}
    assert set(got) == {"total_assets", "total_equity", "total_liabilities"}
    r = got["total_assets"]
    assert (r["raw_value"], r["parsed_decimal"], r["normalized_value"], r["raw_unit"], r["currency"], r["scale_factor"]) == ("731", 731, 731000, "USD thousands", "USD", 1000)
    assert (r["statement_scope"], r["statement_type"], r["table_role"], r["period_basis"], r["column_label"], r["page_number"], r["fact_status"]) == ("consolidated", "balance_sheet", "statement.balance_sheet", "point_in_time", "Figures", 1, "normalized")
    assert r["cell_bbox"] == [10.0, 1.0, 20.0, 2.0] and r["mapping_confidence"] == 0.99 and r["mapping_rule_id"] == "concept_aliases.total_assets"
    other = {r["normalized_concept_id"]: (r["parsed_decimal"], r["fact_status"]) for r in stages["facts"].where("report_id = 'r2'").collect()}
    assert other == {"total_assets": (None, "needs_review"), "total_liabilities": (Decimal(-40), "normalized")}


def test_verdict(stages):
    rows = validate.validate_runs(stages["facts"], stages["runs"], stages["reports"], PACKS, F.lit(WHEN))
    got = {r["extraction_run_id"]: r for r in conformed(rows, "validation_results").collect()}
    r = got["run1"]
    ids = {x["normalized_concept_id"]: x["fact_id"] for x in stages["facts"].where("report_id = 'r1'").collect()}
    assert (r["rule_id"], r["status"], r["lhs_value"], r["rhs_value"], r["difference_value"], r["severity"]) == ("balance_sheet.assets_equal_liabilities_plus_equity", "verified", 731000, 731000, 0, "error")
    assert r["involved_fact_ids"] == [ids["total_assets"], ids["total_liabilities"], ids["total_equity"]]
    assert got["run2"]["status"] == "requires_manual_review" and len(got["run2"]["involved_fact_ids"]) == 2
    s = validate.summary(rows).first()
    assert (s["result_count"], s["failed_count"]) == (2, 0)


CHECKS = [("100", "60", "40", True, "verified", 0), ("100", "59", "40", True, "verified_with_rounding", 1), ("100", "50", "40", True, "failed", 10), ("100", "60", "40", False, "blocked_unit_unknown", None), ("100", "60", None, True, "requires_manual_review", None), ("100", "NULL", "40", True, "requires_manual_review", None), ("0", "3", "0", True, "failed", -3), ("10000000", "9998996", "0", True, "failed", 1004)]


@pytest.mark.parametrize(("a", "li", "e", "unit", "status", "diff"), CHECKS)
def test_identity_cases(spark, a, li, e, unit, status, diff):
    def fact(name, v, known=True):
        if v is None:
            return F.lit(None).cast("struct<id:string,value:decimal(38,6),scale:decimal(38,6),sure:double>").alias(name)
        value = F.lit(None if v == "NULL" else v).cast("decimal(38,6)")
        return F.struct(F.lit(name).alias("id"), value.alias("value"), F.lit(1 if known else None).cast("decimal(38,6)").alias("scale"), F.lit(0.99).alias("sure")).alias(name)

    row = spark.range(1).select(fact("total_assets", a), fact("total_liabilities", li, unit), fact("total_equity", e))
    got = validate.check(row, validate.BALANCE, Decimal(2), Decimal("0.0001")).first()
    assert (got["status"], got["difference_value"]) == (status, None if diff is None else Decimal(diff))
    if e is None:
        assert got["involved_fact_ids"] == ["total_assets", "total_liabilities"]


TITLES = [
    ("a_share", "合并资产负债表", "statement.balance_sheet", "consolidated", 0.95, "table_titles.statement.balance_sheet.prefer", False),
    ("a_share", "合并利润表", "statement.income_statement", "consolidated", 0.95, "table_titles.statement.income_statement.prefer", False),
    ("a_share", "合并现金流量表", "statement.cash_flow", "consolidated", 0.95, "table_titles.statement.cash_flow.prefer", False),
    ("a_share", "母公司资产负债表", "unknown", "parent", 0.0, None, True),
    ("a_share", "资产负债表", "statement.balance_sheet", "unknown", 0.85, "table_titles.statement.balance_sheet.include", True),
    ("us", "Consolidated Balance Sheets\nCaption\nFigures", "statement.balance_sheet", "consolidated", 0.95, "table_titles.statement.balance_sheet.prefer", False),
    ("hk", "Consolidated statement of financial position", "statement.balance_sheet", "consolidated", 0.95, "table_titles.statement.balance_sheet.prefer", False),
    ("hk", "consolidated statement of financial position of the Company", "statement.balance_sheet", "parent", 0.95, "table_titles.statement.balance_sheet.prefer", True),
    ("us", "consolidated balance sheets and consolidated statements of cash flows", "statement.balance_sheet", "consolidated", 0.95, "table_titles.statement.balance_sheet.prefer", False),
    ("unknown", "Consolidated Balance Sheets", "unknown", "unknown", 0.0, None, True),
    ("us", None, "unknown", "unknown", 0.0, None, True),
]


def test_titles(spark):
    df = spark.createDataFrame([(i, m, t) for i, (m, t, *_) in enumerate(TITLES)], "i int, market string, t string")
    for r in classify.classified(df, PACKS, F.col("t")).collect():
        assert (r["table_role"], r["statement_scope"], r["classification_confidence"], r["classification_rule_id"], r["requires_review"]) == TITLES[r["i"]][2:], TITLES[r["i"]]


def test_profiles(spark):
    rows = [("a", 1, "目录\n公司简介", "a_share", 100.0, 200.0), ("a", 2, "合并资产负债表\n资产总计", "a_share", 100.0, 200.0), ("b", 1, "  ", "us", None, 5.0), ("b", 2, "", "us", 0.0, 5.0), ("b", 3, None, "xx", 1.0, 1.0)]
    pages = profile.page_profiles(spark.createDataFrame(rows, "report_id string, page_number int, text string, market string, width double, height double"))
    got = {(r["report_id"], r["page_number"]): r for r in pages.collect()}
    assert [(got["a", n]["text_char_count"], got["a", n]["text_density"], got["a", n]["has_statement_keywords"]) for n in (1, 2)] == [(7, 7 / 20000, False), (12, 12 / 20000, True)]
    assert got["b", 1]["page_text_sample"] is None and got["b", 2]["text_density"] is None
    by = {r["report_id"]: tuple(r)[1:] for r in profile.report_profiles(pages).collect()}
    assert by == {"a": (2, 1, True, None), "b": (3, 0, False, "no_text_layer")}


def test_notes_periods_and_all_columns(spark):
    df = spark.createDataFrame([("us", "Revenue by product line"), ("us", "none")], "market string, t string")
    assert [r["note_role"] for r in classify.note_roles(df, PACKS, F.col("t")).collect()] == ["note.revenue_by_product", "unknown"]
    heads = spark.createDataFrame([("us", "Year ended 2025"), ("us", "As of 2025"), ("us", None), ("a_share", "上年同期")], "market string, h string")
    assert [r[0] for r in heads.select(facts.period_basis(F.col("h"), PACKS)).collect()] == ["cumulative", "point_in_time", "unknown", "comparative"]
    cells = spark.createDataFrame([(1, r, c, t, f"{r}{c}", None) for r, row in enumerate([["x", "2025", "2024"], ["Total assets", "1", "2"], ["No values"]]) for c, t in enumerate(row)], "k int, row_index int, column_index int, raw_text string, raw_cell_id string, bbox array<double>")
    got = facts.label_values(cells, ["k"], "all").orderBy("row_index", "column_index").collect()
    assert [(r["raw_label"], r["raw_value"], r["column_label"]) for r in got] == [("Total assets", "1", "2025"), ("Total assets", "2", "2024"), ("No values", None, "2025")]


def test_sparse_grids(spark):
    rows = [(1, 0, 0, "a", 0), (1, 2, 2, "z", 1), (1, 2, 2, "last", 2), (1, 1, 1, None, 3)]
    cells = spark.createDataFrame(rows, "k int, row_index int, column_index int, raw_text string, emit_order int")
    assert rawtables.table_text(cells, ["k"]).first()["raw_table_text"] == "a\t\t\n\t\t\n\t\tlast"
    assert rawtables.cell_lines(cells, ["k"]).first()["cell_text"].split("\n")[0] == "a"


def test_overrides_and_subtotals(stages):
    pack = PACKS["us"]
    off = rulepack.RulePack(**{**pack.__dict__, "rules": {"balance_sheet.assets_equal_liabilities_plus_equity": {"enabled": False}, "cash_flow.ending_cash_reconciliation": {"severity": "warning"}}})
    rows = validate.validate_runs(stages["facts"], stages["runs"], stages["reports"], {"us": off}, F.lit(WHEN), (validate.BALANCE, *validate.SUBTOTALS), overrides=True).collect()
    assert len(rows) == 2 * len(validate.SUBTOTALS) and {r["status"] for r in rows} == {"requires_manual_review"}
    assert {r["severity"] for r in rows if r["rule_id"] == "cash_flow.ending_cash_reconciliation"} == {"warning"}


def grid_cells(spark, *cells):
    return spark.createDataFrame([(1, r, c, t, f"{r}-{c}-{n}", None, n) for n, (r, c, t) in enumerate(cells)], "k int, row_index int, column_index int, raw_text string, raw_cell_id string, bbox array<double>, emit_order int")


@pytest.mark.parametrize("columns", ["first", "all"])
def test_the_last_of_repeated_cells_counts(spark, columns):
    cells = grid_cells(spark, (0, 0, "x"), (0, 1, "old head"), (0, 1, "head"), (1, 0, "Total assets"), (1, 1, "1"), (1, 1, "2"), (2, 0, "no value"), (3, 1, "no label"))
    got = facts.label_values(cells, ["k"], columns).orderBy("row_index").collect()
    assert [(r["raw_label"], r["raw_value"], r["raw_cell_id"], r["column_index"], r["column_label"]) for r in got] == [("Total assets", "2", "1-1-5", 1, "head"), ("no value", None, None, 1, "head")]


def test_numbers_too_long_need_review(spark):
    rows = spark.createDataFrame([("9" * 25, 0.99), ("9" * 40, 0.99), ("7", 0.99)], "raw_value string, unit_confidence double").withColumn("scale_factor", F.lit(1000).cast("decimal(38,6)"))
    got = facts.values(rows).collect()
    assert [(r["parsed_decimal"] is None, r["normalized_value"], r["fact_status"]) for r in got] == [(False, None, "needs_review"), (True, None, "needs_review"), (False, Decimal(7000), "normalized")]


def test_the_last_fact_is_that_of_the_last_table_and_row(spark):
    fact = lambda run, table, row, value: (run, f"{run}/{table}/{row}", "total_equity", Decimal(value), Decimal(1), 0.99, 1, table, row, 1)
    rows = [fact(f"run{i}", t, r, 10 * t + r) for i in range(6) for t in (0, 1, 2) for r in (1, 2)]
    df = spark.createDataFrame(rows, "extraction_run_id string, fact_id string, normalized_concept_id string, normalized_value decimal(38,6), scale_factor decimal(38,6), unit_confidence double, page_number int, table_index_on_page int, row_index int, column_index int")
    wide = validate.pivoted(df.repartition(7), ["extraction_run_id"], ["total_equity"]).collect()
    assert {r["total_equity"]["value"] for r in wide} == {22}
    beside = validate.beside(df, ["extraction_run_id"], ["total_equity"]).collect()
    assert len(beside) == 36 and {r["total_equity"]["id"][-4:] for r in beside} == {"/2/2"}


def test_aliases_of_several_concepts_and_units_that_disagree_need_review(spark):
    torn = rulepack.RulePack(**{**PACKS["us"].__dict__, "aliases": ((0, "total_assets", "total", 0.99), (1, "total_equity", "Total", 0.99), (2, "revenue", "revenue", 0.99))})
    rows = spark.createDataFrame([("total", "5"), ("Revenue", "6")], "raw_label string, raw_value string").withColumns({"market": F.lit("us"), "scale_factor": F.lit(1).cast("decimal(38,6)"), "unit_confidence": F.lit(0.99)})
    got = facts.values(facts.concepts(rows, rulepack.alias_table(spark, {"us": torn}))).collect()
    assert {r["raw_label"]: r["fact_status"] for r in got} == {"total": "needs_review", "Revenue": "normalized"}
    texts = spark.createDataFrame([("us", "in millions USD", "USD thousands", None), ("us", None, "USD thousands", "USD thousands"), ("us", None, "in thousands", "USD")], "market string, cell string, t string, page string")
    found = facts.with_unit_by_level(texts, PACKS, {c: F.col(c) for c in ("cell", "t", "page")}, True).collect()
    assert [(str(r["scale_factor"]), r["unit_conflict"]) for r in found] == [("1000000.000000", True), ("1000.000000", False), ("1000.000000", False)]


def test_products_of_concepts(spark):
    rule = next(r for r in validate.SUBTOTALS if r.product)
    fact = lambda c, v: F.struct(F.lit(c).alias("id"), F.lit(v).cast("decimal(38,6)").alias("value"), F.lit(1).cast("decimal(38,6)").alias("scale"), F.lit(0.99).alias("sure")).alias(c)
    for shares, status in (("400", "verified"), ("401", "verified_with_rounding"), ("450", "failed")):
        row = spark.range(1).select(fact("net_profit_attributable_to_parent", "1000"), fact("basic_eps", "2.5"), fact("weighted_average_shares", shares))
        assert validate.check(row, rule, "3", "0.0001").first()["status"] == status


def test_extended_packs_have_every_concept_and_note_role():
    from filingmill.operators.views import WIDE

    for market in rulepack.MARKETS:
        own, more = rulepack.load(market), rulepack.load(market, extended=True)
        assert len({a[1] for a in own.aliases}) == 7 and len(own.notes) == 3 and len(more.notes) == 8
        assert {c for names in WIDE.values() for c in names} <= {a[1] for a in more.aliases}


def test_debug_view_is_registered_when_asked(spark, stages):
    from filingmill.operators import views

    results = validate.validate_runs(stages["facts"], stages["runs"], stages["reports"], PACKS, F.lit(WHEN))
    views.register_debug(stages["facts"], results, stages["facts"].where("report_id = 'r2'").select("fact_id"))
    got = {(r["report_id"], r["validation_status"], r["correction_count"]) for r in spark.table("debug_facts_view").collect()}
    assert got == {("r1", "verified", 0), ("r2", "requires_manual_review", 1)}


def test_tables_of_no_statement_take_note_roles(spark, stages):
    tables = spark.createDataFrame([("n1", "run1", "r1", 7, "Revenue by product line"), ("n2", "run1", "r1", 8, "ageing analysis of receivables"), ("n3", "run1", "r1", 9, "other")], "raw_table_id string, extraction_run_id string, report_id string, page_number int, raw_table_text string")
    cells = stages["cells"].limit(0)
    pages = spark.createDataFrame([], "report_id string, page_number int, page_text_sample string")
    for packs, want in ((PACKS, ["note.revenue_by_product", "unknown", "unknown"]), (rulepack.load_all(extended=True), ["note.revenue_by_product", "note.receivables_aging", "unknown"])):
        rows = classify.classify_runs(tables, cells, pages, stages["runs"], stages["reports"], packs, F.lit(WHEN), notes=True)
        assert [r["table_role"] for r in conformed(rows, "classified_tables").orderBy("raw_table_id").collect()] == want
