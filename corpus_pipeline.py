"""From raw documents to token-id archives: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet
in the shared folder and hands the next stage what it reads there.

In every stage doc_id is an integer, null texts count as empty ones, texts of any length are taken
whole, rows without a doc_id are rows like others, columns that a stage doesn't name are passed on
whatever they are called, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingmill.llm import decontaminate, mixing, near_text, quality, token_file
from filingmill.llm.queries import BYTE_BPE, family, table, target_weight
from filingmill.llm.shared import staged

#: The mixture's token budget as a share of what reaches that stage.
MIX_SHARE = 0.95


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below the threshold go; repeated rows go or stay together."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least doc_id, and one of equal rows.

    SimHash candidates at 11 or fewer differing bits are linked at a Jaccard similarity of 0.8 or more
    of their five-word shingles.
    """
    return near_text.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go; ties and repeated rows are each judged alone."""
    return decontaminate.without_hits(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Families, languages and sources of stated weights fill a budget of most tokens, none repeated: few sources are cut.

    Rows equal in doc_id and text are taken or left together.
    """
    return mixing.mixed(docs, family(F.col("source")), target_weight, total=MIX_SHARE)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id archives of what is left, read back as (doc_id, start, n_tokens, ids_crc32)."""
    return token_file.token_table(docs, BYTE_BPE)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_ids", token_ids),
]

#: Classifier, fingerprints and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
