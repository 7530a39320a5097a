"""Phrase collocations from suffix arrays over word ids, one array for each shard.

A shard's words become ids; prefix doubling sorts its suffixes by their first words, and runs of
neighbours that share n words (LCP intervals) are the shard's n-grams with their counts, which are
then merged by key over all shards.

Two passes keep the merge small. The first merges counts of words and pairs by 64-bit keys alone; what
is counted often enough sets bits of a filter of fixed size. The second gives the phrases themselves,
but only those all of whose words and pairs the filter lets pass: a phrase is never more frequent than
its parts, so none that counts is lost, and false hits of the filter fall to the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingmill.llm import bpe
from filingmill.llm.shared import broadcast_value, drop_dirs, small_batches, staged, text_bytes

#: Words and marks of a shard, which bounds the memory of a task.
SHARD_WORDS = 2_000_000
#: Bits of the filter between the passes, as a power of two; more frequent pairs make more false hits.
FILTER_BITS = 27
#: Tasks that first rank a language's candidates, so that the last has at most so many times the rows asked for.
RANK_PARTS = 64

#: A-Z to a-z, and the marks that end a piece to one of them; other bytes of UTF-8 stay.
PIECES = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\x0d", bytes(range(97, 123)) + b"\n" * 9)
#: Stands for the end of a piece among the words; no text in UTF-8 has this byte.
END = b"\xff"
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Ids(dict):
    """Words to ids in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = made = len(self)
        return made


def words_and_ends(text: bytes) -> list[bytes]:
    """The lower-cased words of a text, ``END`` between its pieces."""
    return text.translate(PIECES).replace(b"\n", b" \xff ").split()


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes in the order of their first ``depth`` ids or more, by prefix doubling."""
    rank, known, order = ids.astype(np.int64), 1, np.argsort(ids, kind="stable")
    while known < depth:
        after = np.zeros_like(rank)
        after[:-known] = rank[known:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty_like(key)
        rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
        known *= 2
    return order


def intervals(ids: np.ndarray, longest: int, whole: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, counts) for n up to ``longest``: one place of every distinct n-gram without a 0, and its count.

    ``whole`` says of every place whether the pair that begins there may be part of a phrase.
    """
    order = suffix_array(ids, longest)
    padded = np.concatenate((ids, np.zeros(longest, dtype=ids.dtype)))
    if whole is not None:
        whole = np.concatenate((whole, np.zeros(longest, dtype=bool)))
    shares = np.ones(max(len(order) - 1, 0), dtype=bool)  # whether neighbours have the first n ids in common
    inside = np.ones(len(order), dtype=bool)
    for n in range(1, longest + 1):
        own = padded[order + n - 1]
        inside &= own > 0
        if n > 1 and whole is not None:
            inside &= whole[order + n - 2]
        shares &= own[1:] == own[:-1]
        starts = np.flatnonzero(np.concatenate((np.ones(min(len(order), 1), dtype=bool), ~shares)))
        counts = np.diff(np.concatenate((starts, [len(order)])))
        kept = inside[starts]
        yield n, order[starts][kept], counts[kept]


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of words from the words' own."""
    key = (first * _ODD) ^ (second + np.uint64(0x632BE59BD9B4E019))
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(32))


class Shard:
    """The word ids of a part of one language's texts."""

    def __init__(self, lang: str) -> None:
        self.lang = lang
        self.ids = _Ids({END: 0})
        self.codes: list[int] = []

    def add(self, text: bytes) -> int:
        """Add a text; returns how many words and ends it has."""
        found = words_and_ends(text)
        self.codes += map(self.ids.__getitem__, found)
        self.codes.append(0)
        return len(found) + 1

    def arrays(self) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Codes, the words by code, and the words' keys; keys of equal words differ between languages."""
        held = list(self.ids)
        seed = xxhash.xxh64_intdigest(self.lang.encode())
        digest = xxhash.xxh64_intdigest
        return np.array(self.codes, dtype=np.int64), held, np.array([digest(w, seed) for w in held], dtype=np.uint64)


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Shard]:
    """The shards of a task, of ``most`` words together; one longer text makes a larger one."""
    bpe.release()
    held: dict[str, Shard] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if lang not in held:
                held[lang] = Shard(lang)
            size += held[lang].add(text.as_py())
            if size >= most:
                yield from held.values()
                held, size = {}, 0
    yield from held.values()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_bytes("text").alias("b"))


def key_counts(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(key, n): counts of words and pairs by key, one row for each shard that has them."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, shard_words):
            codes, _, keys = shard.arrays()
            for n, places, counts in intervals(codes, 2):
                own = keys[codes[places]]
                found = own if n == 1 else pair_keys(own, keys[codes[places + 1]])
                for at in range(0, len(found), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(found[at : at + (1 << 16)].view(np.int64)), pa.array(counts[at : at + (1 << 16)].astype(np.int64))], schema=schema)

    return _texts(docs).mapInArrow(made, "key bigint, n bigint")


def frequent_filter(counts: DataFrame, least: int, bits: int = FILTER_BITS) -> np.ndarray:
    """A table of 2 ** ``bits`` bits, packed, set for the keys counted ``least`` times or more; of one size whatever their number."""
    kept = counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    place = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    word = kept.select(F.shiftright(place, 6).cast("int").alias("at"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit"))
    table = np.zeros(1 << bits - 6, dtype=np.uint64)
    found = word.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter has the keys' bits."""
    place = keys & np.uint64(len(table) * 64 - 1)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (keys & np.uint64(63)) & np.uint64(1)).astype(bool)


def phrase_counts(docs: DataFrame, table: np.ndarray, longest: int = 3, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, words, phrase, n): counts of phrases that the filter lets pass, and of all words as phrase null, by shard."""
    held = broadcast_value(docs.sparkSession, table)
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])

    def rows(lang: str, n: int, phrases: list, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), pa.array([n] * len(phrases), pa.int32()), pa.array(phrases, pa.string()), pa.array(counts.astype(np.int64))], schema=schema)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, shard_words):
            codes, words, keys = shard.arrays()
            yield rows(shard.lang, 0, [None], np.array([np.count_nonzero(codes)]))
            frequent = passes(held.value, keys)
            frequent[0] = False
            own = np.where(frequent[codes], codes, 0)
            pair = np.zeros(len(own), dtype=bool)
            both = np.flatnonzero((own[:-1] > 0) & (own[1:] > 0))
            pair[both] = passes(held.value, pair_keys(keys[own[both]], keys[own[both + 1]]))
            for n, places, counts in intervals(own, longest, pair):
                for at in range(0, len(places), 1 << 15):
                    some = places[at : at + (1 << 15)]
                    parts = [[words[c] for c in own[some + k].tolist()] for k in range(n)]
                    yield rows(shard.lang, n, [b" ".join(p).decode() for p in zip(*parts)], counts[at : at + (1 << 15)])

    return _texts(docs).mapInArrow(made, "lang string, words int, phrase string, n bigint")


def _score(a: str | Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly: counts up to ten million millions."""
    wide = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(13,0)")
    square = (wide(a) * wide(a)) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square, wide(left) * wide(right))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, cover: int = 50, top: int = 2000, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language of ``docs`` (text, lang).

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends, and pieces into words at
    spaces and tabs. Candidates are phrases of 2 to ``longest`` (3 at most) words counted ``least`` times
    or more within pieces. Of their cuts into two parts, counted l and r times, that of the lowest score
    floor(1000000 a a / (l r)) counts, of ties the first. A candidate whose words lie in a longer candidate that is
    counted at least ``cover`` in a hundred times as often is dropped. n is the number of the language's words.

    Null texts are empty, a null lang is ``und``, repeated rows count again, texts of any length are
    taken whole, other columns are ignored, and an empty table gives an empty result. Equal scores and
    counts are ranked by the phrase's bytes.
    """
    if not 2 <= longest <= 3:
        raise ValueError("phrases have two or three words")
    spark = docs.sparkSession
    small_batches(spark)
    scratch: list[str] = []
    table = frequent_filter(key_counts(docs, shard_words), least)
    merged = phrase_counts(docs, table, longest, shard_words).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    counted = staged(merged.where((F.col("n") >= least) | F.col("phrase").isNull()), "phrases", scratch)
    found = staged(_scored(counted), "scored", scratch)
    longer = found.where("words = 3").select("lang", "a", F.split("phrase", " ").alias("w"))
    inner = longer.select("lang", "a", F.explode(F.array(F.concat_ws(" ", F.slice("w", 1, 2)), F.concat_ws(" ", F.slice("w", 2, 2)))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = found.join(inner, ["lang", "phrase"], "left").where(F.col("within").isNull() | (F.col("within") * 100 < F.col("a") * cover))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = kept.withColumn("part", part).withColumn("k", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("k") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    sizes = counted.where("phrase is null").select("lang", F.col("n").alias("n"))
    out = staged(ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "ranked")
    drop_dirs(spark, scratch)
    return out


def _scored(counted: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of the candidates, each by its lowest cut."""
    cands = counted.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cands.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.select("lang", "words", "phrase", "a", "cut", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("cut"))).alias("first"), F.concat_ws(" ", F.slice("w", F.col("cut") + 1, F.col("words") - F.col("cut"))).alias("rest"))
    parts = counted.where("phrase is not null")
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", _score("a", F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    return lowest.select("lang", "words", "phrase", "a", "m.l", "m.r", "m.score")
