"""Near duplicates of whole texts by HyperMinHash registers in bands.

Every shingle's hash is dealt to buckets; a bucket keeps its least value as a register of 16 bits: the
count of leading zeros and the ten bits after the first one. Bands of seven registers are looked up as
they are, the Jaccard similarity of texts that share a band is estimated from all registers, less the
collisions that two sets of such sizes have by chance, and what may be similar enough is verified on
the whole shingle sets.

Texts at the threshold of 0.85 share none of 36 bands of seven registers with a probability below one in a
million; sets of fewer than six shingles link at that similarity only if they are equal, and equal sets
are one node. In a band's bucket of many nodes those of its hubs are compared first, the hubs being the
nodes that meet most others; then only nodes that no links join are paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm import bpe
from filingmill.llm.components import components
from filingmill.llm.near_text import parities, set_hash, shingle_set
from filingmill.llm.shared import broadcast_value, drop_dirs, possibly_in, small_batches, staged, text_bytes
from filingmill.llm.simhash import HUBS, ODD

#: Buckets, as a power of two, and how often each shingle is dealt to them: small sets leave fewer empty.
BUCKET_BITS, DEALS = 8, 8
BUCKETS = 1 << BUCKET_BITS
#: Bits after the first one in a register.
MANTISSA = 10
#: Registers of a band; as many bands as there are buckets for.
BAND = 7
EMPTY = 0xFFFF
#: Standard errors below the threshold at which an estimate rules a pair out.
ERRORS = 5.0
_VALUE_BITS = 52
_CHUNK = 4096


def registers(shingles: np.ndarray) -> np.ndarray:
    """The registers (uint16) of a set of 64-bit shingle hashes; empty buckets hold ``EMPTY``."""
    least = np.full(BUCKETS, np.iinfo(np.uint64).max, dtype=np.uint64)
    deals = (np.arange(1, DEALS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    for at in range(0, len(shingles), _CHUNK):
        x = shingles[None, at : at + _CHUNK].astype(np.uint64) + deals
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        value = x << np.uint64(BUCKET_BITS) >> np.uint64(64 - _VALUE_BITS)
        np.minimum.at(least, (x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64).ravel(), value.ravel())
    held = least < np.uint64(1 << _VALUE_BITS)
    part, power = np.frexp(least.astype(np.float64))
    mantissa = np.maximum((2 * part - 1) * (1 << MANTISSA), 0).astype(np.int64)
    return np.where(held, (_VALUE_BITS - power) << MANTISSA | mantissa, EMPTY).astype("<u2")


def chance_table(steps: int = 80) -> np.ndarray:
    """Odds that a register of two sets without common shingles is equal, by sizes of 2 ** (i / 2) and 2 ** (j / 2)."""
    zeros = np.arange(_VALUE_BITS + 1, dtype=np.float64)[:, None]
    inner = np.arange((1 << MANTISSA) + 1, dtype=np.float64)[None, :] / (1 << MANTISSA)
    edges = 2.0 ** -(zeros + 1) * (1 + inner)  # values in units of the range, by register
    sizes = 2.0 ** (np.arange(steps) / 2) * DEALS / BUCKETS
    above = np.exp(-sizes[:, None, None] * edges[None])  # no value below an edge, as a bucket's number of values is near Poisson
    odds = (above[:, :, :-1] - above[:, :, 1:]).reshape(steps, -1)
    return odds @ odds.T


def estimates(left: np.ndarray, right: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarities of pairs of registers, less what collides by chance, and the numbers of buckets they rest on."""
    filled = (left != EMPTY) | (right != EMPTY)
    used = np.maximum(filled.sum(1), 1)
    step = lambda n: np.clip(np.rint(2 * np.log2(np.maximum(n, 1))).astype(np.int64), 0, len(chance) - 1)
    by_chance = chance[step(sizes[0]), step(sizes[1])] * used
    return np.maximum((filled & (left == right)).sum(1) - by_chance, 0) / np.maximum(used - by_chance, 1), used


def with_registers(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, node, size, ODD, registers): node is a hash of the shingle set, equal for equal sets."""
    small_batches(docs.sparkSession)
    numbers = ("doc_id", "text_hash", "node", "size", *ODD)
    schema = pa.schema([*[(n, pa.int64()) for n in numbers], ("registers", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe.release()
        for batch in batches:
            nodes, sizes, odd, held = [], [], [], []
            for t in batch.column(2):
                own = shingle_set(t.as_py(), width)
                nodes.append(set_hash(own))
                sizes.append(len(own))
                odd.append(parities(own))
                held.append(registers(own).tobytes())
            odd = np.array(odd, dtype=np.int64).reshape(-1, len(ODD))
            node = pa.array(np.array(nodes, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), node, pa.array(sizes, pa.int64()), *[pa.array(c) for c in odd.T.copy()], pa.array(held, pa.binary())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), text_bytes("text").alias("b"))
    return rows.mapInArrow(made, ", ".join(f"{n} bigint" for n in numbers) + ", registers binary")


def band_rows(nodes: DataFrame) -> DataFrame:
    """(key, node) for every band of ``nodes`` (node, registers) that isn't empty throughout."""
    width = 2 * BAND
    band = lambda i: F.col("registers").substr(i * width + 1, F.lit(width))
    keys = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS // BAND - 1)), lambda i: F.struct(i.alias("i"), band(i).alias("b")))
    rows = nodes.select("node", F.explode(keys).alias("x")).where(F.col("x.b") != F.lit(b"\xff" * width))
    return rows.select(F.xxhash64("x.i", "x.b").alias("key"), "node")


def _near(x: str, y: str, least: Fraction):
    """Whether sizes and parities let two nodes link; true for every pair at ``least`` or more."""
    up, down = least.numerator, least.denominator
    a, b = F.col(f"{x}.size"), F.col(f"{y}.size")
    apart = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in ODD[1:]), F.bit_count(F.col(f"{x}.{ODD[0]}").bitwiseXOR(F.col(f"{y}.{ODD[0]}"))))
    return (F.least(a, b) * down >= F.greatest(a, b) * up) & (apart * (up + down) <= (a + b) * (down - up))


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def hub_pairs(met: DataFrame, least: Fraction, scratch: list[str]) -> DataFrame:
    """Pairs (a, b) of the nodes of every bucket with its hubs: of each of eight parts that which meets most others."""
    rank = F.struct("degree", "node", "size", *ODD)
    hubs = met.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(HUBS)).alias("part")).agg(F.max(rank).alias("hub"))
    x, y = staged(hubs.select("key", "hub.*"), "hubs", scratch).alias("x"), met.alias("y")
    return _pairs(x.join(y, F.col("x.key") == F.col("y.key")).where((F.col("x.node") != F.col("y.node")) & _near("x", "y", least)))


def other_pairs(met: DataFrame, least: Fraction) -> DataFrame:
    """Pairs (a, b) of nodes of a bucket that have no common root yet."""
    x, y = met.alias("x"), met.alias("y")
    return _pairs(x.join(y, F.col("x.key") == F.col("y.key")).where((F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & _near("x", "y", least)))


def estimated(pairs: DataFrame, nodes: DataFrame, least: Fraction) -> DataFrame:
    """The pairs (a, b) whose registers don't rule out a similarity of ``least``."""
    held = broadcast_value(pairs.sparkSession, chance_table())
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, BUCKETS) for k in (2, 3))
            found, used = estimates(left, right, (batch.column(4).to_numpy(), batch.column(5).to_numpy()), held.value)
            may = found >= float(least) - ERRORS * np.sqrt(float(least * (1 - least)) / used)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(may)) for k in (0, 1)], schema=schema)

    of = lambda c: nodes.select(F.col("node").alias(c), F.col("registers").alias(f"r{c}"), F.col("size").alias(f"n{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(made, "a bigint, b bigint")


def shingle_sets(docs: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of ``reps`` (node, rep_id, rep_hash), one row each."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(t.as_py(), width).view(np.int64) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int64()))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), text_bytes("text").alias("b"))
    asked = reps.select(F.xxhash64("rep_id", "rep_hash").alias("h"))
    rows = possibly_in(rows, F.xxhash64("doc_id", "text_hash"), asked).where("__hit").select("doc_id", "text_hash", "b")
    rows = rows.mapInArrow(made, "doc_id bigint, text_hash bigint, shingles array<bigint>")
    found = rows.join(reps, rows["doc_id"].eqNullSafe(reps["rep_id"]) & (rows["text_hash"] == reps["rep_hash"]))
    return found.select("node", "shingles").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets are of the similarity ``least`` or more."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    common = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    up, down = least.numerator, least.denominator
    return pairs.join(of("a"), "a").join(of("b"), "b").where(common * (up + down) >= (F.size("sa") + F.size("sb")) * F.lit(up)).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 5, least: Fraction = Fraction(17, 20)) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text; other columns are ignored).

    Texts link if the Jaccard similarity of their sets of ``width``-word shingles, lower-cased, is ``least`` or
    more; a text of fewer words has one shingle. ``component_id`` is the least doc_id reachable over links, the row itself
    included, and ``kept`` says whether it is the row's own. Null, empty and blank texts have no shingles and
    no links: their component is their own doc_id. Rows without a doc_id take their component's id and
    aren't kept; repeated rows stay, each with the same answer; texts of any length are taken whole; an empty table gives an empty result.
    """
    scratch: list[str] = []
    spark = docs.sparkSession
    rows = staged(with_registers(docs, width), "registers", scratch)
    filled = rows.where("size > 0")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r")
    nodes = filled.groupBy("node").agg(rep, *[F.min(c).alias(c) for c in ("size", *ODD)], F.min("registers").alias("registers"))
    nodes = staged(nodes.select("node", "size", *ODD, "registers", F.col("r.doc_id").alias("rep_id"), F.col("r.text_hash").alias("rep_hash")), "nodes", scratch)
    # with `least` as it is, smaller sets link only if they are equal
    floor = max(1, -(-least.numerator // (least.denominator - least.numerator)))
    bands = staged(band_rows(nodes.where(F.col("size") >= floor)), "bands", scratch)
    shared = bands.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    shared = staged(bands.join(shared, "key"), "shared", scratch)
    degree = shared.groupBy("node").agg(F.sum("k").alias("degree"))
    members = staged(nodes.select("node", "size", *ODD, "registers", "rep_id", "rep_hash").join(degree, "node"), "members", scratch)
    met = staged(shared.join(members.select("node", "size", "degree", *ODD), "node"), "met", scratch)
    sets = staged(shingle_sets(docs, members.select("node", "rep_id", "rep_hash"), width), "sets", scratch)
    judged = lambda pairs, tag: staged(verified(estimated(pairs, members, least), sets, least), tag, scratch)
    ties = judged(hub_pairs(met, least, scratch), "ties")
    first = staged(components(ties), "first", scratch)
    rooted = met.join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = rooted.groupBy("key").agg(F.min("root").alias("__a"), F.max("root").alias("__b")).where(F.col("__a") != F.col("__b"))
    rooted = staged(rooted.join(apart.select("key"), "key", "left_semi"), "apart", scratch)
    rest = judged(other_pairs(rooted, least), "rest")
    roots = components(ties.unionByName(rest))
    classed = nodes.select("node", "rep_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classed = staged(classed, "classed", scratch)
    ids = staged(classed.groupBy("root").agg(F.min("rep_id").alias("component_id")), "ids", scratch)
    named = staged(classed.select("node", "root").join(ids, "root").select("node", "component_id"), "named", scratch)
    kept = lambda c: F.coalesce(F.col("doc_id") == c, F.lit(False)).alias("kept")
    found = filled.select("doc_id", "size", "node").join(named, "node").select("doc_id", F.col("size").alias("n_shingles"), "component_id", kept(F.col("component_id")))
    blank = rows.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"), kept(F.col("doc_id")))
    out = staged(found.unionByName(blank), "near")
    drop_dirs(spark, scratch)
    return out
