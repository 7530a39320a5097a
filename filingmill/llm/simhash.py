"""SimHash near-duplicates: generalised pigeonhole search with thresholds dealt by dynamic programming.

A fingerprint of 64 bits is cut into parts of correlated bits. If two fingerprints differ in at
most ``tau`` bits and the parts' thresholds add up to ``tau - parts + 1``, then at least one part
differs in no more bits than its own threshold (-1: the part isn't probed). Thresholds are chosen
so that index rows, probes and expected candidates together cost least; the expectation comes from
counts over all fingerprints. Any such choice finds every link: it sets cost, never results.

Equal fingerprints are one node. In a bucket of many nodes those near one of its few hubs are tied
to it first, and only nodes that no ties join are paired, so a group of near copies costs as its
members do and not as their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.llm.components import components
from filingmill.llm.shared import never_sent, small_batches, staged, text_bytes

BITS = 64
#: Bytes A-Z to a-z; other bytes of UTF-8 stay.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Buckets of this many nodes have hubs, and so many of them at most.
HUB_FROM = 32
HUBS = 8
#: Cost of a compared candidate against that of a shuffled row.
CANDIDATE_COST = 0.05


def shingle_hashes(text: bytes, width: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of one text in order; none without words."""
    words = text.translate(LOWER).split()  # splits at the six ASCII white-space bytes
    if not words:
        return np.zeros(0, dtype="<u8")
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, stops)], dtype="<u8")


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of one text: bit i is set if it is in over half the shingles' XXH64. No words: 0."""
    hashes = shingle_hashes(text, width, seed)
    if not len(hashes):
        return 0
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _OCTET_BITS for k in range(8)])
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


_OCTET_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def with_fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_hash, code): code is the fingerprint's 64 bits as a signed bigint, null text as empty."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("code", pa.int64())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t, width, seed) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(codes, dtype=np.uint64).view(np.int64))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), text_bytes("text").alias("b"))
    return rows.mapInArrow(made, "doc_id bigint, text_hash bigint, code bigint")


def bit_statistics(codes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of codes and the 64 x 64 matrix of how many have both bits, over all of them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            v = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(v, axis=1, bitorder="little").astype(np.float64)
            total += np.rint(x.T @ x).astype(np.int64)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "n"])

    both = np.zeros((BITS, BITS), dtype=np.int64)
    for r in codes.select("code").mapInArrow(partial, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"]
    return codes.count(), both


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into equal parts, each grown greedily by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    phi = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(phi, 0)
    left, out = set(range(BITS)), []
    sizes = [BITS // parts + (k < BITS % parts) for k in range(parts)]
    for size in sizes:
        rest = sorted(left)
        first = rest[int(np.argmax(phi[np.ix_(rest, rest)].sum(1)))]
        part = [first]
        left.remove(first)
        while len(part) < size:
            rest = sorted(left)
            best = rest[int(np.argmax(phi[np.ix_(rest, part)].mean(1)))]
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def signed(mask: int) -> int:
    """A 64-bit pattern as Spark's bigint."""
    return mask - (1 << 64) if mask >> 63 else mask


def mask_of(bits) -> int:
    return sum(1 << b for b in bits)


def deal_thresholds(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds from -1 up, one per part, that add up to ``total`` at the least cost.

    ``costs[i][t + 1]`` is the cost of threshold t at part i.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for at, (c, dealt) in best.items():
            for t in range(-1, len(cost) - 1):
                if (at + t) not in after or c + cost[t + 1] < after[at + t][0]:
                    after[at + t] = (c + cost[t + 1], [*dealt, t])
        best = after
    return best[total][1]


def ball(width: int, threshold: int) -> int:
    """Rows of a part of ``width`` bits in a search within ``threshold``: each side flips half of the bits that differ."""
    return sum(comb(width, d) for d in range((threshold + 1) // 2 + 1)) if threshold >= 0 else 0


def plan(codes: DataFrame, tau: int, least: Fraction | None = None) -> list[tuple[list[int], int]]:
    """The parts to probe, with their thresholds, from counts over all nodes of ``codes`` (code, size)."""
    n, both = bit_statistics(codes)
    most = 2  # a part's threshold; numbers of parts that would need more aren't weighed
    counts = range(max(2, -(-(tau + 1) // (most + 1))), min(tau + 1, max(6, -(-(tau + 1) // (most + 1)))) + 1)
    cuts = {m: correlated_parts(n, both, m) for m in counts} if tau else {1: [list(range(BITS))]}
    flat = [(m, k, part) for m, parts in cuts.items() for k, part in enumerate(parts)]
    keys = F.array(*[F.struct(F.lit(i).alias("c"), F.col("code").bitwiseAND(F.lit(signed(mask_of(part)))).alias("key")) for i, (_, _, part) in enumerate(flat)])
    buckets = codes.select(_size_class("size", least).alias("cls"), F.explode(keys).alias("x"))
    sizes = buckets.groupBy("x.c", "cls", "x.key").agg(F.count("*").alias("k")).groupBy("c").agg(F.sum(F.col("k") * (F.col("k") - 1) / 2).alias("pairs"))
    pairs = {r["c"]: float(r["pairs"]) for r in sizes.collect()}
    p = np.diag(both) / max(n, 1)
    odds = np.clip(2 * p * (1 - p), 1e-6, 0.5)
    odds = odds / (1 - odds)
    chosen: tuple[float, list] = (float("inf"), [])
    for m, parts in cuts.items():
        costs = []
        for k, part in enumerate(parts):
            base, e1 = pairs.get(flat.index((m, k, part)), 0.0), odds[part].sum()
            grow = [1.0, 1 + e1, 1 + e1 + (e1**2 - (odds[part] ** 2).sum()) / 2]
            costs.append([0.0, *(n * ball(len(part), t) + CANDIDATE_COST * base * grow[t] for t in range(min(most, tau) + 1))])
        dealt = deal_thresholds(costs, tau - m + 1)
        cost = sum(c[t + 1] for c, t in zip(costs, dealt))
        if cost < chosen[0]:
            chosen = (cost, [(part, t) for part, t in zip(parts, dealt) if t >= 0])
    return chosen[1]


def _size_class(size: str | Column, least: Fraction | None) -> Column:
    """Sizes by powers of four; without a similarity of sizes all are alike."""
    bits = F.length(F.bin(F.greatest(F.col(size) if isinstance(size, str) else size, F.lit(1))))
    return F.shiftright(bits - 1, 1) if least else F.lit(0)


def _flipped(own: Column, part: int, flips: int):
    return lambda mask: F.struct(F.lit(part).alias("part"), F.lit(flips).alias("flips"), own.bitwiseXOR(mask).alias("bits"))


def _keys(probed: list[tuple[list[int], int]], balls: bool) -> Column:
    """An array of (part, flips, bits) of a code: the parts' own bits, and with ``balls`` those with half a threshold flipped."""
    out = []
    for i, (part, t) in enumerate(probed):
        own = F.col("code").bitwiseAND(F.lit(signed(mask_of(part))))
        for d in range((t + 1) // 2 + 1 if balls else 1):
            masks = F.array(*[F.lit(signed(mask_of(c))) for c in combinations(part, d)])
            out.append(F.transform(masks, _flipped(own, i, d)))
    return F.flatten(F.array(*out))


#: Bit fields of 64 parities each, see ``_parity_allows``.
ODD = ("odd1", "odd2", "odd3", "odd4")


def _held(least: Fraction | None) -> list[str]:
    return ["node", "code", *(ODD if least else ())]


def _near(x: str, y: str, sizes: tuple[Column, Column], tau: int, least: Fraction | None) -> Column:
    """Whether bits, and with ``least`` sizes, let two nodes link."""
    ok = F.bit_count(F.col(f"{x}.code").bitwiseXOR(F.col(f"{y}.code"))) <= tau
    return ok & (F.least(*sizes) * least.denominator >= F.greatest(*sizes) * least.numerator) if least else ok


def _parity_allows(x: str, y: str, sizes: tuple[Column, Column], least: Fraction | None) -> Column:
    """False only if the similarity is below ``least`` for certain.

    ``ODD`` holds for each of 256 bits whether an odd number of a set's shingles falls on it, so two
    sets differ in at least as many shingles as in bits; null says nothing.
    """
    if not least:
        return F.lit(True)
    up, down = least.numerator, least.denominator
    apart = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in ODD[1:]), F.bit_count(F.col(f"{x}.{ODD[0]}").bitwiseXOR(F.col(f"{y}.{ODD[0]}"))))
    return F.coalesce(apart * (up + down) <= (sizes[0] + sizes[1]) * (down - up), F.lit(True))


def hub_ties(nodes: DataFrame, probed: list[tuple[list[int], int]], tau: int, least: Fraction | None = None, scratch: list[str] | None = None) -> DataFrame:
    """(a, b, allowed) of the nodes in buckets of ``HUB_FROM`` or more near their buckets' hubs: may parities let them link?

    A bucket has at most ``HUBS`` hubs, one for each part of a deal by hash, so ties grow as the nodes do.
    """
    rows = nodes.select(*_held(least), "size", F.explode(_keys(probed, False)).alias("k"))
    rows = rows.select(F.xxhash64("k.part", _size_class("size", least), "k.bits").alias("key"), *_held(least), "size")
    hub = F.min(F.struct(F.xxhash64("node", "key").alias("draw"), *_held(least), "size")).alias("hub")
    dealt = rows.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(HUBS)).alias("deal")).agg(F.count("*").alias("k"), hub)
    hubs = dealt.groupBy("key").agg(F.sum("k").alias("k"), F.collect_list("hub").alias("hubs")).where(F.col("k") >= HUB_FROM)
    hubs = staged(hubs.select("key", F.explode("hubs").alias("h")).select("key", "h.*"), "hubs", scratch)
    x, y = hubs.alias("x"), rows.alias("y")
    sizes = (F.col("x.size"), F.col("y.size"))
    met = x.join(never_sent(y), F.col("x.key") == F.col("y.key")).where((F.col("x.node") != F.col("y.node")) & _near("x", "y", sizes, tau, least))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"), _parity_allows("x", "y", sizes, least).alias("allowed")).distinct()


def close_pairs(nodes: DataFrame, probed: list[tuple[list[int], int]], tau: int, least: Fraction | None = None) -> DataFrame:
    """Candidate links (a, b) of ``nodes`` (node, code, size, root) that no common root joins yet.

    Of two nodes that differ within a part's threshold each flips half of the bits that differ there,
    so both rows have the same key; sizes near a class's end are in the next class too. Both sides of
    the join are the same rows, shuffled once.
    """
    held = [*_held(least), "root"]
    own = _size_class("size", least)
    classes = F.array_distinct(F.array(own, _size_class(F.ceil(F.col("size") * least.denominator / least.numerator), least))) if least else F.array(own)
    rows = nodes.select(*held, "size", F.explode(classes).alias("cls"))
    rows = rows.select(*held, "size", "cls", F.explode(_keys(probed, True)).alias("k"))
    most = F.element_at(F.array(*[F.lit(t) for _, t in probed]), F.col("k.part") + 1)
    tag = F.shiftleft("size", 16) + F.shiftleft(most, 8) + F.shiftleft("k.flips", 1) + (F.col("cls") != own).cast("int")
    rows = rows.select(F.xxhash64("k.part", "cls", "k.bits").alias("key"), *held, tag.cast("bigint").alias("tag"))
    x, y = rows.alias("x"), rows.alias("y")
    sizes = tuple(F.shiftright(F.col(f"{s}.tag"), 16) for s in "xy")
    flips = [F.shiftright(F.col(f"{s}.tag"), 1).bitwiseAND(F.lit(127)) for s in "xy"]
    most = F.shiftright(F.col("x.tag"), 8).bitwiseAND(F.lit(255))
    ok = _near("x", "y", sizes, tau, least) & _parity_allows("x", "y", sizes, least)
    ok &= (sizes[0] < sizes[1]) | ((sizes[0] == sizes[1]) & (F.col("x.node") < F.col("y.node")))
    ok &= (flips[1] - flips[0]).between(0, 1) & (flips[0] + flips[1] <= most)
    ok &= F.col("x.tag").bitwiseAND(F.col("y.tag")).bitwiseAND(F.lit(1)) == 0
    ok &= F.coalesce(F.col("x.root") != F.col("y.root"), F.lit(True))
    met = x.join(never_sent(y), (F.col("x.key") == F.col("y.key")) & ok)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def code_links(codes: DataFrame, tau: int = 3) -> DataFrame:
    """Links (a, b) of a graph with the same components as all pairs of codes (code) at ``tau`` or fewer differing bits.

    Ties to hubs come first; only codes that these leave apart are paired.
    """
    nodes = codes.select(F.col("code").alias("node"), "code", F.lit(1).cast("bigint").alias("size"))
    probed = plan(nodes, tau)
    ties = staged(hub_ties(nodes, probed, tau).drop("allowed"), "ties")
    if not ties.isEmpty():
        nodes = staged(nodes.join(components(ties), "node", "left"), "tied")
    else:
        nodes = nodes.withColumn("root", F.lit(None).cast("bigint"))
    return ties.unionByName(close_pairs(nodes, probed, tau))


def near_duplicates(docs: DataFrame, tau: int = 3, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_hash, code, component_id, root) per row of ``docs`` (doc_id, text; other columns are ignored).

    ``component_id`` is the least doc_id reachable over links of ``tau`` or fewer differing bits,
    the row itself included; ``root`` is the component's least code. Null and empty texts have
    fingerprint 0 and link like any other; rows without a doc_id keep a null one and take the
    component's id; repeated rows stay; an empty table gives an empty result.
    """
    rows = staged(with_fingerprints(docs, width, seed), "fingerprints")
    codes = staged(rows.groupBy("code").agg(F.min("doc_id").alias("rep")), "codes")
    found = components(code_links(codes, tau)).withColumnRenamed("node", "code")
    rooted = codes.join(found, "code", "left").select("code", "rep", F.coalesce("root", "code").alias("root"))
    rooted = staged(rooted, "roots")
    ids = staged(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "components")
    classes = staged(rooted.select("code", "root").join(ids, "root"), "classes")
    return rows.join(classes, "code")


def fingerprint_hex(code: Column) -> Column:
    """The 16 lower-case hex digits of a code."""
    return F.lower(F.lpad(F.hex(code), 16, "0"))
