"""Analysis views over trusted facts, and the debug view over everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The concepts of the wide views, and the columns of the long ones.
WIDE = {
    "balance_sheet": "cash_and_cash_equivalents total_current_assets total_non_current_assets total_assets total_current_liabilities total_non_current_liabilities total_liabilities total_equity total_liabilities_and_equity".split(),
    "income_statement": "revenue cost_of_revenue gross_profit selling_expenses administrative_expenses research_and_development_expenses finance_expenses investment_income operating_profit profit_before_tax income_tax_expense net_profit net_profit_attributable_to_parent".split(),
    "cash_flow": "cash_received_from_sales subtotal_cash_inflows_from_operating subtotal_cash_outflows_from_operating net_cash_flow_from_operating net_cash_flow_from_investing net_cash_flow_from_financing net_increase_in_cash_and_cash_equivalents cash_and_cash_equivalents_beginning cash_and_cash_equivalents_ending".split(),
}
LINE_COLUMNS = "company_id company_name market fiscal_year report_type statement_scope statement_type period_basis period_end concept_id raw_label effective_value currency source_page trusted_status".split()
NOTE_COLUMNS = "company_id market fiscal_year report_type table_role dimension_name dimension_value concept_id raw_label effective_value currency period_basis period_end source_page trusted_status".split()
WIDE_KEYS = "company_id market fiscal_year report_type statement_scope period_basis period_end currency".split()


def statement_lines(trusted: DataFrame) -> DataFrame:
    rows = trusted.where(F.col("table_role").startswith("statement.")).withColumn("concept_id", F.col("effective_concept_id"))
    return rows.select(*LINE_COLUMNS)


def note_facts(trusted: DataFrame) -> DataFrame:
    """Note facts; the dimension is the role's last part after ``by_`` and its value the row label."""
    rows = trusted.where(F.col("table_role").startswith("note.")).withColumn("concept_id", F.col("effective_concept_id"))
    by = F.regexp_extract("table_role", r"_by_(.+)$", 1)
    return rows.withColumn("dimension_name", F.nullif(by, F.lit(""))).withColumn("dimension_value", F.when(F.col("dimension_name").isNotNull(), F.col("raw_label"))).select(*NOTE_COLUMNS)


def wide(lines: DataFrame, statement: str, concepts: Sequence[str] | None = None, keys: Sequence[str] = WIDE_KEYS, order: Sequence[str] = ("source_page", "raw_label")) -> DataFrame:
    """A row per key with a column per stated concept; of repeated ones the last by page counts."""
    named = concepts or WIDE[statement]
    rows = lines.where((F.col("statement_type") == statement) & F.col("concept_id").isin(*named))
    return rows.groupBy(*keys).agg(*[F.max_by("effective_value", F.when(F.col("concept_id") == c, F.struct(*order))).alias(c) for c in named])


#: The keys of a summary from the widest level to the narrowest.
SUMMARY_KEYS = ("company_id", "fiscal_year", "report_type")
#: Distinct counts of a summary and what they count.
SUMMARY_SETS = {"concept_count": "effective_concept_id", "report_count": "report_id"}


def rollups(trusted: DataFrame, levels: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """(level, company_id, fiscal_year, report_type, fact_count, concept_count, report_count, latest_period_end) by level.

    Level 3 has all keys, 2 lacks the report type, 1 is of companies, 0 of everything; keys that a level lacks are null.
    Facts become one row for each concept and one for each report of a key, with their number and latest period. A
    level's rows are those of the level below it without a key, deduplicated again, so every level starts from what
    the one below has left and distinct counts are plain counts of rows.
    """
    pair = lambda name: F.struct(F.lit(name).alias("set"), F.col(SUMMARY_SETS[name]).cast("string").alias("value"), F.lit(int(name == first)).cast("bigint").alias("n"))
    first = next(iter(SUMMARY_SETS))  # every fact is counted in this one's rows
    held = trusted.select(*SUMMARY_KEYS, "period_end", F.explode(F.array(*[pair(c) for c in SUMMARY_SETS])).alias("x")).select(*SUMMARY_KEYS, "x.*", F.col("period_end").alias("latest"))
    out = None
    for level in range(len(SUMMARY_KEYS), -1, -1):
        own = SUMMARY_KEYS[:level]
        held = held.groupBy(*own, "set", "value").agg(F.sum("n").alias("n"), F.max("latest").alias("latest"))
        if level in levels:
            counts = [F.count_if((F.col("set") == c) & F.col("value").isNotNull()).alias(c) for c in SUMMARY_SETS]
            part = held.groupBy(*own).agg(F.sum("n").alias("fact_count"), *counts, F.max("latest").alias("latest_period_end")).where("fact_count > 0")
            lacking = [F.lit(None).cast(trusted.schema[k].dataType).alias(k) for k in SUMMARY_KEYS[level:]]
            part = part.select(F.lit(level).alias("level"), *own, *lacking, "fact_count", *SUMMARY_SETS, "latest_period_end")
            out = part if out is None else out.unionByName(part)
    return out


def period_summary(trusted: DataFrame) -> DataFrame:
    """Our own definition: facts, concepts, reports and the latest period by company, year and report type."""
    return rollups(trusted, levels=(len(SUMMARY_KEYS),)).drop("level")


def ai_facts(trusted: DataFrame) -> DataFrame:
    """Trusted rows only, with what is needed to find their source."""
    return trusted.select("report_id", "source_page", "raw_label", "trusted_status", "company_id", "market", "fiscal_year", "report_type", "statement_scope", "period_basis", "effective_concept_id", "effective_value", "effective_unit", "currency")


def debug_facts(facts: DataFrame, results: DataFrame, corrections: DataFrame) -> DataFrame:
    """Every raw fact with the worst result that involves it, and the number of its corrections."""
    involved = results.select(F.explode("involved_fact_ids").alias("fact_id"), "status")
    rank = F.when(F.col("status").isin("failed", "blocked_unit_unknown"), 2).when(F.col("status") == "requires_manual_review", 1).otherwise(0)
    worst = involved.groupBy("fact_id").agg(F.max_by("status", F.struct(rank, "status")).alias("validation_status"))
    counts = corrections.groupBy("fact_id").agg(F.count("*").alias("correction_count"))
    out = facts.join(worst, "fact_id", "left").join(counts, "fact_id", "left")
    return out.withColumn("correction_count", F.coalesce("correction_count", F.lit(0)))


def debug_beside(judged: DataFrame, corrections: DataFrame) -> DataFrame:
    """``debug_facts`` for facts that have one rule's ``status`` and ``involved_fact_ids`` beside them already."""
    involved = F.when(F.array_contains("involved_fact_ids", F.col("fact_id")), F.col("status"))
    counts = corrections.groupBy("fact_id").agg(F.count("*").alias("correction_count"))
    out = judged.withColumn("validation_status", involved).join(counts, "fact_id", "left")
    return out.withColumn("correction_count", F.coalesce("correction_count", F.lit(0)))


def register_debug(facts: DataFrame, results: DataFrame, corrections: DataFrame) -> None:
    """The debug mode's temporary view; nothing registers it unasked."""
    debug_facts(facts, results, corrections).createOrReplaceTempView("debug_facts_view")


def register(spark: SparkSession, trusted: DataFrame) -> None:
    """Temporary views of the trusted mode; the debug view is asked for by name."""
    lines = statement_lines(trusted)
    lines.createOrReplaceTempView("trusted_statement_lines")
    note_facts(trusted).createOrReplaceTempView("trusted_note_facts")
    period_summary(trusted).createOrReplaceTempView("company_period_summary")
    ai_facts(trusted).createOrReplaceTempView("ai_trusted_facts_view")
    for statement in WIDE:
        wide(lines, statement).createOrReplaceTempView(f"statement_wide_{statement}")
