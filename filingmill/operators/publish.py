"""Trusted versions and the facts they publish."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.functions.exprs import stable_id
from filingmill.operators.facts import AUTO_CONFIDENCE
from filingmill.sources.commits import Conflict
from filingmill.sources.schemas import ALLOWED, conformed
from filingmill.sources.store import Lake


def is_trusted(status: str | Column) -> Column:
    return (F.col(status) if isinstance(status, str) else status).isin(*ALLOWED["trusted_status"])


def activated(versions: DataFrame) -> DataFrame:
    """Versions with all but the latest active one of a report, scope and key superseded."""
    active = versions.where("status = 'active'").select("report_id", "scope", F.coalesce("scope_key", F.lit("")).alias("k"), "published_at", "trusted_version_id")
    latest = active.groupBy("report_id", "scope", "k").agg(F.max(F.struct("published_at", "trusted_version_id"))["trusted_version_id"].alias("__latest"))
    out = versions.join(latest.select(F.col("__latest").alias("__id")), F.col("trusted_version_id") == F.col("__id"), "left")
    superseded = (F.col("status") == "active") & F.col("__id").isNull()
    return out.withColumn("status", F.when(superseded, "superseded").otherwise(F.col("status"))).drop("__id")


def trusted_facts(effective_facts: DataFrame, versions: DataFrame, reports: DataFrame, status: str = "validation_status") -> DataFrame:
    """Rows of trusted_facts: trusted facts of the runs that active versions point at, within their scope."""
    active = versions.where("status = 'active'").select("trusted_version_id", "report_id", "extraction_run_id", "scope", "scope_key")
    rows = effective_facts.where(is_trusted(status)).join(active, ["report_id", "extraction_run_id"])
    rows = rows.where((F.col("scope") == "report") | ((F.col("scope") == "statement") & (F.col("statement_type") == F.col("scope_key"))) | ((F.col("scope") == "table") & (F.col("raw_table_id") == F.col("scope_key"))))
    names = reports.select("report_id", "company_name")
    rows = rows.join(names, "report_id", "left").withColumns(
        {"effective_concept_id": F.col("normalized_concept_id"), "effective_value": F.col("normalized_value"), "effective_unit": F.col("raw_unit"), "source_page": F.col("page_number"), "trusted_status": F.col(status)}
    )
    return conformed(rows, "trusted_facts")


def auto_trust(facts: DataFrame, agreement: DataFrame, keys: Sequence[str], status: str = "validation_status") -> DataFrame:
    """Add ``auto_trusted``: extractors agree on a fact of its null-safe keys, the unit is known, the mapping is sure and the rule holds."""
    agreed = agreement.where("agreement_status = 'agreed'").select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct().withColumn("__agreed", F.lit(True))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    out = facts.join(agreed, same, "left").drop(*[f"__{k}" for k in keys])
    sure = F.col("__agreed").isNotNull() & (F.col("unit_confidence") >= AUTO_CONFIDENCE) & (F.col("mapping_confidence") >= AUTO_CONFIDENCE) & F.col(status).isin("verified", "verified_with_rounding")
    return out.withColumn("auto_trusted", F.coalesce(sure, F.lit(False))).drop("__agreed")


def publish(lake: Lake, facts: DataFrame, reports: DataFrame, versions: DataFrame, tries: int = 20, status: str = "validation_status") -> None:
    """Make ``versions`` (rows of trusted_versions) active and write their trusted facts; versions of the same scope are superseded.

    The facts are written first and are read only through an active version. The versions of the reports are then
    replaced on the condition that nobody has changed them meanwhile, or else judged again, so two publishers
    at once leave one active version of a report, scope and key.
    """
    lake.append("trusted_facts", trusted_facts(facts, versions.where("status = 'active'"), reports, status))
    ids = [r["report_id"] for r in versions.select("report_id").distinct().toLocalIterator()]
    for _ in range(tries):
        base = lake.version("trusted_versions")
        held = lake.read("trusted_versions", of=ids, version=base)
        try:
            return lake.replace("trusted_versions", activated(held.unionByName(conformed(versions, "trusted_versions"))), versions.select("report_id"), base=base)
        except Conflict:
            continue
    raise Conflict(f"{tries} other publishers were faster")


def version_rows(runs: DataFrame, scope: str, scope_key: str | None, at: Column, by: str | None = None, notes: str | None = None) -> DataFrame:
    """New active versions, one for each run of ``runs`` (report_id, extraction_run_id)."""
    if scope not in ALLOWED["trusted_scope"] or (scope == "report") != (scope_key is None):
        raise ValueError("a scope is report, or statement or table with a key")
    key = F.lit(scope_key).cast("string")
    rows = runs.select("report_id", "extraction_run_id", F.lit(scope).alias("scope"), key.alias("scope_key"), F.lit("active").alias("status"), at.alias("published_at"), F.lit(by).cast("string").alias("published_by"), F.lit(notes).cast("string").alias("notes"))
    return rows.withColumn("trusted_version_id", stable_id("report_id", "extraction_run_id", "scope", "scope_key", "published_at"))


def published(lake: Lake, version: int | None = None) -> DataFrame:
    """The rows of trusted_facts of active versions; ``version`` is a version of the table of trusted versions."""
    active = lake.read("trusted_versions", version=version).where("status = 'active'").select("trusted_version_id")
    return lake.read("trusted_facts").join(active, "trusted_version_id", "left_semi").dropDuplicates(["trusted_version_id", "fact_id"])
