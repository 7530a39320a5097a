"""Near duplicates of whole texts: SimHash candidates, verified on their word shingles.

Candidates are texts whose fingerprints differ in at most ``tau`` bits, found by the generalised
pigeonhole search of ``simhash``. A candidate becomes a link if the Jaccard similarity of the texts'
sets of five-word shingles is 0.8 or more, counted on the whole sets; sizes and parities rule out
most others before that. Shingles are compared by their XXH64.

Fingerprints of three-word shingles lie closer than those of five words at the same similarity, so
these are searched. Of the pairs at 0.8 or more in test corpora, about 99 in 100 are within
``TAU`` bits; the rest are lost unless another text joins them.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.llm import bpe
from filingmill.llm.components import components
from filingmill.llm.shared import drop_dirs, never_sent, possibly_in, small_batches, staged, text_bytes
from filingmill.llm.simhash import ODD, close_pairs, fingerprint, hub_ties, plan, shingle_hashes

#: Differing bits of 64 within which texts are candidates.
TAU = 11
#: Words of a shingle of the fingerprints that are searched.
PROBE_WIDTH = 3


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    return np.unique(shingle_hashes(text, width))


def set_hash(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes())


def parities(shingles: np.ndarray) -> np.ndarray:
    """Signed integers of 64 bits each: whether an odd number of shingles falls on a bit."""
    bits = 64 * len(ODD)
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _row_hash() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text_hash"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), text_bytes("text").alias("b"))


def with_sets(docs: DataFrame, width: int, probe_width: int) -> DataFrame:
    """(doc_id, text_hash, node, code, size, ODD): node is a hash of the shingle set, equal for equal sets."""
    small_batches(docs.sparkSession)
    names = ("doc_id", "text_hash", "node", "code", "size", *ODD)
    schema = pa.schema([(n, pa.int64()) for n in names])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe.release()
        for batch in batches:
            nodes, codes, sizes, odd = [], [], [], []
            for t in batch.column(2).to_pylist():
                own = shingle_set(t, width)
                nodes.append(set_hash(own))
                codes.append(fingerprint(t, probe_width))
                sizes.append(len(own))
                odd.append(parities(own))
            as_signed = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (nodes, codes)]
            odd = np.array(odd, dtype=np.int64).reshape(-1, len(ODD))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *as_signed, pa.array(sizes, pa.int64()), *[pa.array(c) for c in odd.T.copy()]], schema=schema)

    return _keyed(docs).mapInArrow(made, ", ".join(f"{n} bigint" for n in names))


def _sets(docs: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of ``reps`` (node, rep_id, rep_hash), one row each."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(t, width).view(np.int64) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int64()))], schema=schema)

    asked = reps.select(F.xxhash64("rep_id", "rep_hash").alias("h"))
    rows = possibly_in(_keyed(docs), _row_hash(), asked).where("__hit").select("doc_id", "text_hash", "b")
    rows = rows.mapInArrow(made, "doc_id bigint, text_hash bigint, shingles array<bigint>")
    found = rows.join(reps, rows["doc_id"].eqNullSafe(reps["rep_id"]) & (rows["text_hash"] == reps["rep_hash"]))
    return found.select("node", "shingles")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, least: Fraction, scratch: list[str]) -> DataFrame:
    """The pairs (a, b) whose sets are of the similarity asked for; only their sets are made again."""
    if pairs.isEmpty():
        return pairs
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    reps = staged(nodes.select("node", "rep_id", "rep_hash").join(ends, "node", "left_semi"), "reps", scratch)
    sets = staged(_sets(docs, reps, width), "sets", scratch)
    of = lambda c, s: never_sent(sets.select(F.col("node").alias(c), F.col("shingles").alias(s)))
    both = pairs.join(of("a", "s"), "a").join(of("b", "t"), "b")
    common = F.size(F.array_intersect("s", "t")).cast("bigint")
    up, down = least.numerator, least.denominator
    return staged(both.where(common * (up + down) >= (F.size("s") + F.size("t")) * F.lit(up)).select("a", "b").distinct(), "verified", scratch)


def classes(docs: DataFrame, width: int = 5, least: Fraction = Fraction(4, 5), tau: int = TAU, probe_width: int = PROBE_WIDTH) -> DataFrame:
    """(doc_id, text_hash, root) per row of ``docs`` (doc_id, text): root is equal for linked texts, a written table."""
    scratch: list[str] = []
    rows = staged(with_sets(docs, width, probe_width), "shingle-sets", scratch)
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r")
    nodes = rows.groupBy("node").agg(rep, *[F.min(c).alias(c) for c in ("code", "size", *ODD)])
    nodes = staged(nodes.select("node", "code", "size", *ODD, F.col("r.doc_id").alias("rep_id"), F.col("r.text_hash").alias("rep_hash")), "nodes", scratch)
    probed = plan(nodes, tau, least)
    met = staged(hub_ties(nodes, probed, tau, least, scratch), "met", scratch)
    first = staged(components(verified(met.where("allowed").select("a", "b"), docs, nodes, width, least, scratch)), "first", scratch)
    dense = met.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("dense", F.lit(True))
    apart = nodes.join(first, "node", "left").join(dense, "node", "left")
    odd = [F.when(F.col("dense"), F.col(c)).alias(c) for c in ODD]  # many rows of each node: zeros of most pack well
    apart = staged(apart.select("node", "code", "size", "root", *odd), "apart", scratch)
    pairs = staged(close_pairs(apart, probed, tau, least), "pairs", scratch)
    links = verified(pairs, docs, nodes, width, least, scratch)
    of = lambda c: first.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    links = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    second = components(links).select(F.col("node").alias("held"), F.col("root").alias("last"))
    rooted = rows.select("doc_id", "text_hash", "node").join(first, "node", "left").withColumn("held", F.coalesce("root", "node"))
    near = staged(rooted.join(second, "held", "left").select("doc_id", "text_hash", F.coalesce("last", "held").alias("root")), "near")
    drop_dirs(docs.sparkSession, scratch)
    return near


def one_per_group(docs: DataFrame, width: int = 5, least: Fraction = Fraction(4, 5), tau: int = TAU, probe_width: int = PROBE_WIDTH) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group of linked texts.

    Texts link at a Jaccard similarity of ``least`` or more over the sets of their ``width``-word
    shingles, if their fingerprints differ in at most ``tau`` bits; texts of fewer words are one
    shingle, null, empty and blank texts are alike. The row with the least doc_id stays (nulls
    last), among equal ids that with the least text hash; of rows equal in both, one. Very long
    texts are taken whole. An empty table gives an empty result.
    """
    found = classes(docs, width, least, tau, probe_width)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    groups = found.groupBy("root").agg(F.min(order).alias("k"), F.count("*").alias("n")).where("n > 1")
    groups = staged(groups.select("root", F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash")), "kept")
    own = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    grouped = staged(found.join(groups, "root").select("doc_id", "text_hash", own.alias("stays")).distinct(), "grouped")
    return _without(docs, grouped)


def _without(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """``docs`` without the rows of ``grouped`` (doc_id, text_hash, stays) that don't stay, and one of equal rows that do."""
    row_id, row_hash = F.col("doc_id").cast("bigint"), F.xxhash64("text")
    marked = possibly_in(docs, F.xxhash64(row_id, row_hash), grouped.select(_row_hash().alias("h")))
    alone = marked.where(~F.col("__hit")).drop("__hit")
    left = marked.where("__hit").drop("__hit").withColumns({"__id": row_id, "__hash": row_hash})
    held = grouped.select(F.col("doc_id").alias("__id2"), F.col("text_hash").alias("__hash2"), F.col("stays").alias("__stays"))
    left = left.join(held, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__hash") == F.col("__hash2")), "left")
    once = left.where("__stays").dropDuplicates(["__id", "__hash"]).unionByName(left.where("__stays is null"))
    return alone.unionByName(once.select(*docs.columns))
