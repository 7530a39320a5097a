"""Accounting identities within explicit tolerances."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingmill.functions.exprs import MONEY, stable_id
from filingmill.sources.rulepack import RulePack

SURE_UNIT = 0.95
FAILED = ("failed", "blocked_unit_unknown")
#: The place of a fact, by which the last of several counts.
PLACE = ("page_number", "table_index_on_page", "row_index", "column_index", "fact_id")
#: Messages of results that compare no values.
MISSING_MESSAGE = "a required concept is missing"
UNIT_MESSAGE = "a unit is unknown"
VALUE_MESSAGE = "a value is missing"


@dataclass(frozen=True)
class Identity:
    """The left concept equals the sum of coefficient times concept, or with ``product`` the product of the concepts."""

    rule_id: str
    name: str
    left: str
    right: tuple[tuple[int, str], ...]
    severity: str = "error"
    product: bool = False

    @property
    def concepts(self) -> tuple[str, ...]:
        return (self.left, *(c for _, c in self.right))


BALANCE = Identity("balance_sheet.assets_equal_liabilities_plus_equity", "assets = liabilities + equity", "total_assets", ((1, "total_liabilities"), (1, "total_equity")))
SUBTOTALS = (
    Identity("balance_sheet.assets_subtotals", "assets = current + non-current", "total_assets", ((1, "total_current_assets"), (1, "total_non_current_assets"))),
    Identity("balance_sheet.liabilities_subtotals", "liabilities = current + non-current", "total_liabilities", ((1, "total_current_liabilities"), (1, "total_non_current_liabilities"))),
    Identity("income_statement.gross_profit", "gross profit = revenue - cost", "gross_profit", ((1, "revenue"), (-1, "cost_of_revenue"))),
    Identity("income_statement.net_profit", "net profit = profit before tax - tax", "net_profit", ((1, "profit_before_tax"), (-1, "income_tax_expense"))),
    Identity("cash_flow.operating", "net operating = inflows - outflows", "net_cash_flow_from_operating", ((1, "subtotal_cash_inflows_from_operating"), (-1, "subtotal_cash_outflows_from_operating"))),
    Identity("cash_flow.net_increase", "increase = operating + investing + financing", "net_increase_in_cash_and_cash_equivalents", ((1, "net_cash_flow_from_operating"), (1, "net_cash_flow_from_investing"), (1, "net_cash_flow_from_financing"))),
    Identity("cash_flow.ending_cash_reconciliation", "ending = beginning + increase", "cash_and_cash_equivalents_ending", ((1, "cash_and_cash_equivalents_beginning"), (1, "net_increase_in_cash_and_cash_equivalents")), "warning"),
    Identity("income_statement.basic_eps", "attributable profit = basic earnings a share x weighted shares", "net_profit_attributable_to_parent", ((1, "basic_eps"), (1, "weighted_average_shares")), "warning", product=True),
)


def _fact() -> Column:
    return F.struct(F.col("fact_id").alias("id"), F.col("normalized_value").cast(MONEY).alias("value"), F.col("scale_factor").cast(MONEY).alias("scale"), F.col("unit_confidence").alias("sure"))


def pivoted(facts: DataFrame, keys: Sequence[str], concepts: Sequence[str], order: Sequence[str] = PLACE) -> DataFrame:
    """One row per key with a struct (id, value, scale, sure) per concept; of repeated concepts the last counts.

    The last fact, by page, table, row and column, is an aggregate, so map-side combining bounds what a
    hot key sends.
    """
    at = F.struct(*order)
    return facts.groupBy(*keys).agg(*[F.max_by(_fact(), F.when(F.col("normalized_concept_id") == c, at)).alias(c) for c in concepts])


def beside(facts: DataFrame, keys: Sequence[str], concepts: Sequence[str], order: Sequence[str] = PLACE) -> DataFrame:
    """``facts`` with the columns of ``pivoted`` for their key: facts are dealt once, and nothing is joined back."""
    at, group = F.struct(*order), Window.partitionBy(*keys)
    return facts.withColumns({c: F.max_by(_fact(), F.when(F.col("normalized_concept_id") == c, at)).over(group) for c in concepts})


def _rule(rule: Identity, severity: str, absolute: Decimal | str, relative: Decimal | str) -> Column:
    """A rule over pivoted rows as a struct, the left fact first and its factor 0."""
    factors = [0, *(k for k, _ in rule.right)]
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.name).alias("rule_name"), F.lit(severity).alias("severity"), F.lit(rule.left).alias("left"), F.lit(rule.product).alias("product"),
        F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("fact")) for k, c in zip(factors, rule.concepts)]).alias("terms"),
        F.lit(str(absolute)).cast(MONEY).alias("absolute_tolerance"), F.lit(str(relative)).cast("decimal(9,8)").alias("relative_tolerance"),
    )


def _judged(rows: DataFrame) -> DataFrame:
    """Rows with a ``rule`` of ``_rule``, with its verdict.

    A missing concept comes before an unknown unit, and that before a missing value.
    """
    terms = F.col("rule.terms")
    missing = F.exists(terms, lambda t: t["fact"].isNull())
    unsure = F.exists(terms, lambda t: t["fact"]["scale"].isNull() | F.coalesce(t["fact"]["sure"] < SURE_UNIT, F.lit(True)))
    empty = F.exists(terms, lambda t: t["fact"]["value"].isNull())
    right = F.slice(terms, 2, 100)
    added = F.aggregate(right, F.lit(0).cast(MONEY), lambda out, t: F.try_add(out, (t["fact"]["value"] * t["k"]).try_cast(MONEY)).cast(MONEY))
    times = F.aggregate(right, F.lit(1).cast(MONEY), lambda out, t: F.try_multiply(out, t["fact"]["value"]).try_cast(MONEY))
    rows = rows.withColumns({"__missing": missing, "__unsure": unsure, "__empty": empty})
    usable = ~F.col("__missing") & ~F.col("__unsure") & ~F.col("__empty")
    rows = rows.withColumns({"lhs_value": F.when(usable, F.get(terms, F.lit(0))["fact"]["value"]), "rhs_value": F.when(usable, F.when(F.col("rule.product"), times).otherwise(added))})
    rows = rows.withColumn("difference_value", F.try_subtract(F.col("lhs_value"), F.col("rhs_value")).cast(MONEY))
    d, lhs = F.col("difference_value"), F.col("lhs_value")
    allowed = F.abs(lhs).try_cast("decimal(28,6)") * F.col("rule.relative_tolerance")
    near = (F.abs(d) <= F.col("rule.absolute_tolerance")) | F.coalesce((lhs != 0) & (F.abs(d) <= allowed), F.lit(False))
    status = F.when(F.col("__missing"), "requires_manual_review").when(F.col("__unsure"), "blocked_unit_unknown").when(F.col("__empty") | d.isNull(), "requires_manual_review")
    status = status.when(d == 0, "verified").when(near, "verified_with_rounding").otherwise("failed")
    said = F.concat_ws(" ", F.col("rule.left"), lhs.cast("string"), F.lit("against"), F.col("rhs_value").cast("string"), F.lit("differs by"), d.cast("string"))
    message = F.when(F.col("__missing"), MISSING_MESSAGE).when(F.col("__unsure"), UNIT_MESSAGE).when(F.col("__empty"), VALUE_MESSAGE).otherwise(said)
    ids = F.transform(F.filter(terms, lambda t: t["fact"].isNotNull()), lambda t: t["fact"]["id"])
    return rows.withColumns({"status": status, "involved_fact_ids": ids, "message": message}).drop("__missing", "__unsure", "__empty")


def check(rows: DataFrame, rule: Identity, absolute: Decimal | str, relative: Decimal | str) -> DataFrame:
    """Add lhs_value, rhs_value, difference_value, status, involved_fact_ids and message to pivoted rows."""
    return _judged(rows.withColumn("rule", _rule(rule, rule.severity, absolute, relative))).drop("rule")


def validate_runs(facts: DataFrame, runs: DataFrame, reports: DataFrame, packs: dict[str, RulePack], created_at: Column, rules: Sequence[Identity] = (BALANCE,), overrides: bool = False) -> DataFrame:
    """Rows of validation_results: every rule over every run, runs without facts included, in one pass over the facts.

    With ``overrides`` the packs switch rules off and set severities; by default, all run as errors.
    Of a concept's facts the last by page, table, row and column counts.
    """
    held = runs.select("extraction_run_id", "report_id").join(reports.select("report_id", "market"), "report_id")
    concepts = sorted({c for r in rules for c in r.concepts})
    wide = held.join(pivoted(facts.where(F.col("normalized_concept_id").isin(*concepts)), ["extraction_run_id"], concepts), "extraction_run_id", "left")
    chosen = None
    for m, pack in packs.items():
        own = [(r, pack.rules.get(r.rule_id, {}) if overrides else {}) for r in rules]
        own = [_rule(r, o.get("severity", "error"), pack.absolute_tolerance, pack.relative_tolerance) for r, o in own if o.get("enabled", True)]
        if own:
            chosen = F.when(F.col("market") == m, F.array(*own)) if chosen is None else chosen.when(F.col("market") == m, F.array(*own))
    if chosen is None:
        raise ValueError("the rule packs switch every rule off")
    found = _judged(wide.select("extraction_run_id", F.explode(chosen).alias("rule")))
    return found.select(
        "extraction_run_id", "rule.rule_id", "rule.rule_name", "rule.severity", "status", "lhs_value", "rhs_value", "difference_value", "rule.absolute_tolerance", F.col("rule.relative_tolerance").cast(MONEY).alias("relative_tolerance"), "involved_fact_ids", "message",
        stable_id(F.lit("validation"), "extraction_run_id").alias("validation_run_id"), stable_id("extraction_run_id", "rule.rule_id").alias("validation_result_id"), created_at.alias("created_at"),
    )


def summary(results: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of results and of failures; results left to a person aren't failures."""
    return results.groupBy(*keys).agg(F.count("*").alias("result_count"), F.count_if(F.col("status").isin(*FAILED)).alias("failed_count"))


#: What a rule's verdict depends on, and the fact that it names.
JUDGED = ("fact_id", "normalized_concept_id", "normalized_value", "unit_confidence", "statement_scope", "period_basis", "period_end", "instant_date", "page_number", "table_index_on_page", "row_index", "column_index")


def fact_digests(facts: DataFrame, run: str = "extraction_run_id", columns: Sequence[str] = JUDGED) -> DataFrame:
    """(run, facts_digest): a digest of a run's facts whatever their order; repeated facts count as often as they come.

    Sums of two independent hashes and the number of rows, so partial digests add up before the shuffle.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    wide = lambda salt: F.sum(F.xxhash64(F.lit(salt), *fields).cast("decimal(20,0)"))
    sums = facts.groupBy(run).agg(F.count("*").alias("n"), wide(1).alias("a"), wide(2).alias("b"))
    return sums.select(run, F.concat_ws("/", "n", "a", "b").alias("facts_digest"))


def changed_runs(digests: DataFrame, validations: DataFrame) -> DataFrame:
    """Rows of ``digests`` (extraction_run_id, rule_pack_version, facts_digest) that their run's last validation didn't judge.

    ``validations`` has rows of validation_runs; a run without one has changed, as has one under other rules.
    """
    last = validations.groupBy("extraction_run_id").agg(F.max_by(F.struct("rule_pack_version", "facts_digest"), F.struct("finished_at", "validation_run_id")).alias("__last"))
    known = last.select("extraction_run_id", F.col("__last.rule_pack_version").alias("rule_pack_version"), F.col("__last.facts_digest").alias("facts_digest")).where("facts_digest is not null")
    return digests.join(known, ["extraction_run_id", "rule_pack_version", "facts_digest"], "left_anti")
