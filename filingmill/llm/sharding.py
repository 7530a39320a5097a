"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

At every level each child draws a straw from the row's key and the child's name, scaled by the
child's weight, and the row goes to the child with the longest. Straws of children whose weight is
unchanged are unchanged, so a change moves rows only into the subtrees that gained weight and out
of those that lost it. ``grown_tree`` adds shards as regions of their own, which makes every added
shard take rows only into itself, at any number of shards from its base on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows numbered by one task.
SLOT_ROWS = 100_000


@dataclass(frozen=True)
class Node:
    """A subtree: a shard number, or children; its weight is its own or its children's sum."""

    name: str
    shard: int | None = None
    own_weight: float = 1.0
    children: tuple[Node, ...] = ()

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def grown_tree(shards: int, base: int = 8, racks: int = 2, per_rack: int = 2) -> Node:
    """The first ``base`` shards in regions of ``racks`` racks of ``per_rack`` shards, each later one a region of its own.

    ``base`` is settled when a store is set up and stays as it grows; fewer shards than that are an error.
    """
    if not 0 < base <= shards:
        raise ValueError("base is between 1 and the number of shards")
    regions = []
    for r, at in enumerate(range(0, base, racks * per_rack)):
        kids = []
        for k, lo in enumerate(range(at, min(at + racks * per_rack, base), per_rack)):
            kids.append(Node(f"r{r}/k{k}", children=tuple(Node(f"r{r}/k{k}/s{s}", s) for s in range(lo, min(lo + per_rack, base)))))
        regions.append(Node(f"r{r}", children=tuple(kids)))
    regions += [Node(f"own{s}", children=(Node(f"own{s}/k", children=(Node(f"own{s}/k/s{s}", s),)),)) for s in range(base, shards)]
    return Node("root", children=tuple(regions))


def straw(key: Column, child: Node) -> Column:
    """The child's draw for a key: ln(u) / weight with u uniform in (0, 1]; the greatest wins."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11) + 1).cast("double") / float(1 << 53)
    return F.log(u) / F.lit(float(child.weight))


def descend(key: Column, node: Node) -> Column:
    """The shard of a key below ``node``; children of no weight are never drawn."""
    if node.shard is not None:
        return F.lit(node.shard)
    kids = [c for c in node.children if c.weight > 0]
    if len(kids) == 1:
        return descend(key, kids[0])
    straws = [straw(key, c) for c in kids]
    most = F.greatest(*straws)
    out = descend(key, kids[-1])
    for child, drawn in reversed(list(zip(kids[:-1], straws[:-1]))):
        out = F.when(drawn == most, descend(key, child)).otherwise(out)
    return out


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 within each ``shard``, to rows that are dealt and ordered by all their columns.

    Equal rows are counted before the shuffle and get consecutive slots. The rest of a shard's rows are
    dealt by hash into buckets of about ``SLOT_ROWS``, numbered there, and offset by the sizes of the
    buckets before; no task holds a whole shard.
    """
    own = rows.columns
    buckets = max(8, rows.count() // SLOT_ROWS)
    dealt = rows.groupBy(*own).agg(F.count("*").alias("__n")).withColumn("__bucket", F.pmod(F.xxhash64(*own), F.lit(buckets)))
    sizes = rows.withColumn("__bucket", F.pmod(F.xxhash64(*own), F.lit(buckets))).groupBy("shard", "__bucket").agg(F.count("*").alias("__rows"))
    before = F.sum("__rows").over(Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", "__bucket", F.coalesce(before, F.lit(0)).alias("__start"))
    inside = F.sum("__n").over(Window.partitionBy("shard", "__bucket").orderBy(*[c for c in own if c != "shard"]).rowsBetween(Window.unboundedPreceding, -1))
    numbered = dealt.withColumn("__first", F.coalesce(inside, F.lit(0))).join(starts, ["shard", "__bucket"])
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1))
    return numbered.select(*own, (F.col("__start") + F.col("__first")).alias("__first"), each.alias("__own")).select(*own, (F.col("__first") + F.col("__own")).alias("slot"))


def sharded(docs: DataFrame, shards: int = 8, base: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs`` (doc_id, text).

    Law ``key``: the doc_id and the tree alone decide the shard, and ``grown_shard`` is that of one
    more shard. ``base`` is that of ``grown_tree``, by default all shards but 8 at most. doc_id is an integer. Null
    texts have size 1 and the checksum of no bytes; a null doc_id is a key of its own; repeated rows
    share a shard and have slots of their own; very long texts are checked whole; an empty table
    gives an empty result; other columns are ignored.
    """
    base = min(8, shards) if base is None else base
    tree, grown = grown_tree(shards, base), grown_tree(shards + 1, base)
    key = F.col("doc_id").cast("bigint")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    ).select("*", F.lit("key").alias("law"), descend(key, tree).alias("shard"), descend(key, grown).alias("grown_shard"))
    return with_slots(rows).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
