"""Mixing sources to target weights: budgets down a domain-language-source tree, prefixes of seeded epochs.

The token budget is split from the root by the children's weights. A child whose subtree can't
supply its share, at ``max_epochs`` passes over every leaf, takes what it can, and the rest goes to
its siblings by their weights before any of it goes back to the level above. Each leaf then takes
the prefix of its documents, in an order drawn anew for every epoch, that fills its budget.
Tokens are those of a vocabulary file, counted once and written; words are an option.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingmill.llm.shared import small_batches, staged
from filingmill.llm.token_count import counter

#: The vocabulary of the token ids that the pipeline and op8 write.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Cut of an epoch that takes a whole leaf.
LAST = (1 << 63) - 1
#: Documents ordered by one task.
BUCKET_ROWS = 1_024
LEVELS = ("domain", "lang", "source")
NAMES = [f"__{name}" for name in LEVELS]

Weight = Callable[[tuple[str, ...]], float]


def shares(children: DataFrame, parents: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``children`` (keys, name, supply, weight) with ``budget``: each parent's, split by weights, no more than each supply.

    What a child can't supply goes to its siblings by their weights; what none can stays unassigned.
    In order of supply to weight, a child is full if it has no more than its share of what those
    before it leave; the rest share by weight, in whole tokens by largest remainders. Children of no
    weight or supply get nothing and aren't listed. A parent's children are one sorted, spilling window.
    """
    group = Window.partitionBy(*keys)
    ranked = group.orderBy(F.col("supply") / F.col("weight"), name)
    own = children.where("weight > 0 and supply > 0").join(parents.select(*keys, F.col("budget").alias("__total")), keys)
    own = own.withColumn("__before", F.coalesce(F.sum("supply").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = own.withColumn("__rest", F.sum("weight").over(ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    own = own.withColumn("__full", F.col("supply") <= (F.col("__total") - F.col("__before")) * F.col("weight") / F.col("__rest"))
    own = own.withColumn("__left", F.col("__total") - F.sum(F.when(F.col("__full"), F.col("supply")).otherwise(F.lit(0))).over(group))
    own = own.withColumn("__open", F.sum(F.when(F.col("__full"), F.lit(0.0)).otherwise(F.col("weight"))).over(group))
    exact = F.when(F.col("__full") | (F.col("__left") <= 0), F.lit(0.0)).otherwise(F.col("__left") * F.col("weight") / F.col("__open"))
    own = own.withColumn("__exact", exact).withColumn("__whole", F.floor("__exact"))
    own = own.withColumn("__spare", F.col("__left") - F.sum("__whole").over(group))
    own = own.withColumn("__place", F.row_number().over(group.orderBy("__full", F.col("__whole") - F.col("__exact"), name)))
    given = F.when(F.col("__full"), F.col("supply")).otherwise(F.least("supply", F.col("__whole") + (F.col("__place") <= F.col("__spare")).cast("bigint")))
    return own.withColumn("budget", given).select(*children.columns, "budget")


def budgets(leaves: DataFrame, total: int, weight: Weight, max_epochs: int) -> DataFrame:
    """``leaves`` (leaf columns, tokens) with the ``budget`` of each out of a total, by domain, then language, then source.

    A subtree supplies ``max_epochs`` times its tokens. The split of a parent's budget is its children's
    alone, so a shortage goes to siblings, and to the level above only as what a whole subtree can't supply.
    """

    @F.pandas_udf("double")
    def weighted(paths: pd.DataFrame) -> pd.Series:
        return pd.Series([float(weight(tuple(path))) for path in paths.itertuples(index=False)], dtype=float)

    parents = leaves.sparkSession.createDataFrame([(0, total)], "__root int, budget bigint")
    for depth, name in enumerate(NAMES, 1):
        nodes = leaves.groupBy(*NAMES[:depth]).agg((F.sum("tokens") * max_epochs).alias("supply")).withColumn("__root", F.lit(0))
        nodes = nodes.withColumn("weight", weighted(F.struct(*NAMES[:depth])))
        parents = shares(nodes, parents, ["__root", *NAMES[: depth - 1]], name).select("__root", *NAMES[:depth], "budget")
    return leaves.join(parents.drop("__root"), NAMES)


def tokens_of(text: str = "text", path: str = VOCABULARY) -> Column:
    """Tokens of a text for mixing: its ids in the vocabulary file, which every executor has, and one for the end."""

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        count = counter(path)
        return pa.array([(count(t) if t else 0) + 1 for t in texts.to_pylist()], pa.int64())

    return counted(F.col(text))


def words_of(text: str = "text") -> Column:
    """Words of a text between white space, and one for the end: a cheaper weight than tokens, wrong for scripts without spaces."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[ \t\n\r\x0B\f]+"), lambda w: w != "")).cast("bigint") + 1


def leaf_columns(domain: Column) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit("")).alias(f"__{name}") for name, c in zip(LEVELS, (domain, F.col("lang"), F.col("source")))]


def _draw(seed: int, text_hash: Column | None = None) -> Column:
    """A document's place in its leaf's order of an epoch, from 0 below 2 ** 63."""
    own = F.xxhash64("text") if text_hash is None else text_hash
    return F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("bigint"), own, F.col("epoch"), F.lit(seed)), 1)


def weighed(docs: DataFrame, domain: Column, count: Callable[[], Column] = tokens_of) -> DataFrame:
    """(doc_id, text_hash, leaf columns, tokens) per row of ``docs``, written once so that texts are counted once."""
    small_batches(docs.sparkSession)
    return staged(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), *leaf_columns(domain), count().alias("tokens")), "weighed")


def cutoffs(rows: DataFrame, weight: Weight, total: int | float | None = None, max_epochs: int = 1, seed: int = 11) -> DataFrame:
    """(leaf columns, epoch, cut): in that epoch a leaf's documents of draws up to ``cut`` are taken; a written table.

    ``rows`` is the table of ``weighed``. One row for each leaf and epoch that takes any.
    """
    leaves = staged(rows.groupBy(*NAMES).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "leaves")
    found = leaves.agg(F.sum("tokens").alias("tokens"), F.max("n").alias("n")).first()
    whole, most = found["tokens"] or 0, found["n"] or 0
    target = whole if total is None else int(total * whole) if isinstance(total, float) else total
    rooms = budgets(leaves, target, weight, max_epochs).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    rooms = rooms.withColumn("room", F.least("tokens", F.col("budget") - F.col("epoch") * F.col("tokens"))).where("room > 0")
    rooms = staged(rooms.select(*NAMES, "epoch", "room", (F.col("room") == F.col("tokens")).alias("all")), "rooms")
    keys = [*NAMES, "epoch"]
    bits = max(0, most // BUCKET_ROWS).bit_length()
    drawn = rows.join(rooms.where("not all"), NAMES).select(*keys, "room", "tokens", _draw(seed, F.col("text_hash")).alias("draw"))
    drawn = staged(drawn.groupBy(*keys, "room", "draw").agg(F.sum("tokens").alias("tokens")).withColumn("bucket", F.shiftright("draw", 63 - bits)), "draws")
    sums = drawn.groupBy(*keys, "room", "bucket").agg(F.sum("tokens").alias("t"))
    before = F.sum("t").over(Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    edge = sums.withColumn("before", F.coalesce(before, F.lit(0))).where((F.col("before") < F.col("room")) & (F.col("before") + F.col("t") >= F.col("room")))
    inside = F.sum("tokens").over(Window.partitionBy(*keys, "bucket").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1))
    near = drawn.join(staged(edge.select(*keys, "bucket", "before"), "edges"), [*keys, "bucket"]).withColumn("inside", F.coalesce(inside, F.lit(0)))
    cut = near.where(F.col("before") + F.col("inside") < F.col("room")).groupBy(*keys).agg(F.max("draw").alias("cut"))
    return staged(rooms.where("all").select(*keys, F.lit(LAST).cast("bigint").alias("cut")).unionByName(cut), "cuts")


def selected(docs: DataFrame, domain: Column, weight: Weight, total: int | float | None = None, max_epochs: int = 1, seed: int = 11, count: Callable[[], Column] = tokens_of) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, epoch) of every selected document and epoch.

    ``domain`` derives a document's domain from its columns; ``weight`` gives the weight of a path
    among its siblings. ``total`` is the token budget: a number of tokens, a share (float) of the
    table's, or by default all of them; doc_id is an integer, ``count`` is ``tokens_of`` or ``words_of``. A document is
    taken if the tokens before it, in its leaf and epoch, leave room for at least one of its own, so
    a leaf may overrun its budget by part of one document. Null lang or source is the name "", null
    texts count one token, very long texts are counted whole, rows equal in doc_id and text are taken or left together, and an empty
    table gives none.
    """
    rows = weighed(docs.select("doc_id", "text", "lang", "source"), domain, count)
    taken = rows.join(cutoffs(rows, weight, total, max_epochs, seed), NAMES).where(_draw(seed, F.col("text_hash")) <= F.col("cut"))
    return taken.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(f"__{n}").alias(n) for n in LEVELS], "tokens", "epoch")


def mixed(docs: DataFrame, domain: Column, weight: Weight, total: int | float | None = None, max_epochs: int = 1, seed: int = 11, count: Callable[[], Column] = tokens_of) -> DataFrame:
    """The selected rows of ``docs`` with its own columns, once for every epoch that takes them; edges are those of ``selected``."""
    own = docs.columns
    held = docs.select(*[F.col(c).alias(f"__own_{c}") for c in own], "doc_id", "text", *leaf_columns(domain))
    cuts = cutoffs(weighed(docs, domain, count), weight, total, max_epochs, seed)
    taken = held.join(cuts, NAMES).where(_draw(seed) <= F.col("cut"))
    return taken.select(*[F.col(f"__own_{c}").alias(c) for c in own])
