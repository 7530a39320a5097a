"""Table roles and scopes by keyword rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.functions.exprs import contains_any, or_null, stable_id
from filingmill.operators import keywords
from filingmill.sources.rulepack import Role, RulePack

PREFER, INCLUDE, REVIEW_BELOW = 0.95, 0.85, 0.95


def evidence(page_sample: str = "page_text_sample", table_text: str = "raw_table_text", cell_text: str = "cell_text") -> Column:
    """The non-empty texts that a table is judged by, a line feed between them."""
    return F.concat_ws("\n", *[or_null(F.col(c)) for c in (page_sample, table_text, cell_text)])


def role_match(lowered: Column, roles: Sequence[Role], prefix: str = "table_titles") -> Column:
    """struct(role, confidence, rule_id) of the best role.

    An exclude keyword rules a role out. A prefer keyword gives more confidence than an include
    keyword, and the first role in file order wins a tie, so all prefers are tried in order, then all
    includes.
    """

    def found(name: str, confidence: float, rule: str | None) -> Column:
        return F.struct(F.lit(name).alias("role"), F.lit(confidence).alias("confidence"), F.lit(rule).cast("string").alias("rule_id"))

    out = found("unknown", 0.0, None)
    for confidence, kind in ((INCLUDE, "include"), (PREFER, "prefer")):
        for r in reversed(roles):
            hit = contains_any(lowered, getattr(r, kind)) & ~contains_any(lowered, r.exclude)
            out = F.when(hit, found(r.name, confidence, f"{prefix}.{r.name}.{kind}")).otherwise(out)
    return out


def scope(lowered: Column, scopes: dict[str, Sequence[str]]) -> Column:
    """Parent keywords come before consolidated ones."""
    parent, whole = contains_any(lowered, scopes.get("parent", ())), contains_any(lowered, scopes.get("consolidated", ()))
    return F.when(parent, "parent").when(whole, "consolidated").otherwise("unknown")


def classified(tables: DataFrame, packs: dict[str, RulePack], text: Column | None = None, market: str = "market", indexed: Sequence[str] | None = None) -> DataFrame:
    """Add table_role, statement_scope, classification_confidence, classification_rule_id and requires_review.

    Every row stays; a table of an unknown market, or without a match, has the role ``unknown``. With
    ``indexed``, columns that name a table, roles come from an index of the keywords, as packs of thousands need; the market's column
    is then ``market``. The roles are the same.
    """
    rows = tables.withColumn("__text", F.lower(F.coalesce(evidence() if text is None else text, F.lit(""))))
    within = F.lit("unknown")
    for m, pack in packs.items():
        within = F.when(F.col(market) == m, scope(F.col("__text"), pack.scopes)).otherwise(within)
    if indexed:
        rows = keywords.with_roles(rows, packs, "__text", "table_titles", (PREFER, INCLUDE))
    else:
        role = role_match(F.col("__text"), ())
        for m, pack in packs.items():
            role = F.when(F.col(market) == m, role_match(F.col("__text"), pack.roles)).otherwise(role)
        rows = rows.withColumn("__role", role)
    rows = rows.withColumn("statement_scope", within)
    rows = rows.withColumns({"table_role": F.col("__role.role"), "classification_confidence": F.col("__role.confidence"), "classification_rule_id": F.col("__role.rule_id")})
    review = (F.col("classification_confidence") < REVIEW_BELOW) | (F.col("statement_scope") != "consolidated")
    return rows.withColumn("requires_review", review).drop("__text", "__role")


def note_roles(tables: DataFrame, packs: dict[str, RulePack], text: Column, market: str = "market") -> DataFrame:
    """Add note_role, note_confidence and note_rule_id by the packs' note rules."""
    rows = tables.withColumn("__text", F.lower(F.coalesce(text, F.lit(""))))
    role = role_match(F.col("__text"), ())
    for m, pack in packs.items():
        role = F.when(F.col(market) == m, role_match(F.col("__text"), pack.notes, "note_roles")).otherwise(role)
    rows = rows.withColumn("__role", role)
    return rows.withColumns({"note_role": F.col("__role.role"), "note_confidence": F.col("__role.confidence"), "note_rule_id": F.col("__role.rule_id")}).drop("__text", "__role")


def summary(classified_tables: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of classified tables and of those to review."""
    return classified_tables.groupBy(*keys).agg(F.count("*").alias("classified_count"), F.count_if("requires_review").alias("review_required_count"))


def classify_runs(raw_tables: DataFrame, raw_cells: DataFrame, pages: DataFrame, runs: DataFrame, reports: DataFrame, packs: dict[str, RulePack], created_at: Column, notes: bool = False, indexed: bool = False) -> DataFrame:
    """Rows of classified_tables for every raw table of the given runs.

    With ``notes`` tables of no statement take the role of the packs' note rules; with ``indexed`` roles come from an index of the keywords.
    """
    from filingmill.operators.rawtables import cell_lines

    market = runs.select("extraction_run_id", "report_id").join(reports.select("report_id", "market"), "report_id").select("extraction_run_id", "market")
    rows = raw_tables.join(market, "extraction_run_id").join(cell_lines(raw_cells, ["raw_table_id"]), "raw_table_id", "left")
    rows = rows.join(pages.select("report_id", "page_number", "page_text_sample"), ["report_id", "page_number"], "left")
    out = classified(rows, packs, indexed=["raw_table_id"] if indexed else None)
    if notes:
        out = note_roles(out, packs, evidence())
        noted = (F.col("table_role") == "unknown") & (F.col("note_role") != "unknown")
        own = {"table_role": "note_role", "classification_confidence": "note_confidence", "classification_rule_id": "note_rule_id"}
        out = out.withColumn("__noted", noted).withColumns({c: F.when(F.col("__noted"), F.col(n)).otherwise(F.col(c)) for c, n in own.items()}).drop("__noted", *own.values())
    return out.withColumns({"classified_table_id": stable_id("extraction_run_id", "raw_table_id"), "created_at": created_at})
