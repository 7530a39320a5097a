"""Connected components of a link table by alternating large-star and small-star steps.

Every step is one aggregation and one join of written tables; the labels never leave the cluster.
A hub with very many links is a hot join key between two scans, which adaptive execution splits.
One aggregation tells that the links are stars, so no step is taken that would change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm.shared import drop_dirs, staged


def _least(sym: DataFrame) -> DataFrame:
    return sym.groupBy("u").agg(F.min("v").alias("m"))


def _step(links: DataFrame, large: bool, scratch: list[str]) -> DataFrame:
    """One star step over links (a, b) with a < b; returns links of the same form."""
    up = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        sym = up.unionByName(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        least = staged(_least(sym).select("u", F.least("m", "u").alias("m")), "star", scratch)
        moved = sym.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        least = staged(_least(up), "star", scratch)
        moved = up.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        moved = moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return moved.where(F.col("a") < F.col("b")).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node of links (a, b) with a < b has one link up, or none: then each is linked to its root. An empty table is so."""
    ends = F.array(F.struct(F.col("b").alias("node"), F.lit(1).alias("up")), F.struct(F.col("a").alias("node"), F.lit(0).alias("up")))
    nodes = links.select(F.explode(ends).alias("x")).groupBy("x.node").agg(F.sum("x.up").alias("up"), F.count("*").alias("n"))
    return not nodes.agg(F.count_if(F.expr("up > 0 and n > 1")).alias("open")).first()["open"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a bigint, b bigint); root is the least node reachable.

    Self links are ignored, repeated links and either direction count once, nulls are dropped. An
    empty table gives an empty result. Nodes without a link are not listed. Tables of earlier steps are
    deleted as soon as the next is written; the last one holds the result.
    """
    used: list[str] = []
    now = staged(
        links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links", used
    )
    while not _stars(now):
        last: list[str] = []
        now = staged(_step(staged(_step(now, True, used), "links", used), False, used), "links", last)
        drop_dirs(links.sparkSession, used)
        used = last
    roots = now.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
