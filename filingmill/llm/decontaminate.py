"""Benchmark decontamination: word windows of held-out items, looked up in whole training texts.

The items' words go to numbers and their windows to hashes; both tables are broadcast in blocks of
bounded size. A document's words are mapped to the block's numbers, stretches without unknown words
are hashed by rolling sums, and every hash that is met is verified word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm import bpe
from filingmill.llm.shared import broadcast_value, drop_dirs, possibly_in, small_batches, staged

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Bytes of item text in one broadcast block, about a window for every six; more items are scanned in more blocks.
BLOCK_BYTES = 4 << 20
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text; null has none."""
    return WORD.findall(text.encode().translate(LOWER)) if text else []


class WindowSet:
    """The windows of a block of items, by length, hash and exact words."""

    def __init__(self, items: list[tuple[object, str | None]], width: int) -> None:
        self.width, self.numbers, self.items = width, {}, []
        self.exact: dict[int, dict[bytes, list[int]]] = {}
        for item, text in items:
            own = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)], dtype=np.int64)
            if not len(own):
                continue
            k, n = len(self.items), min(width, len(own))
            self.items.append(str(item))
            at = self.exact.setdefault(n, {})
            for i in range(len(own) - n + 1):
                found = at.setdefault(own[i : i + n].tobytes(), [])
                if not found or found[-1] != k:
                    found.append(k)
        self.hashes = {n: np.unique(np.array([_window_hashes(np.frombuffer(w, np.int64), n)[0] for w in at], dtype=np.uint64)) for n, at in self.exact.items()}

    def scan(self, document: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Marks of the document's words inside windows, and the items that have occurring windows."""
        hit, met = np.zeros(len(document), dtype=bool), set()
        if not self.numbers or not document:
            return hit, met
        get = self.numbers.get
        own = np.array([get(w, 0) for w in document], dtype=np.int64)
        known = own > 0
        if not known.any():
            return hit, met
        run = np.concatenate(([0], np.cumsum(known)))
        for n, at in self.exact.items():
            if len(own) < n:
                continue
            starts = np.flatnonzero(run[n:] - run[:-n] == n)
            if not len(starts):
                continue
            starts = starts[np.isin(_window_hashes(own, n, starts), self.hashes[n])]
            for i in starts.tolist():
                items = at.get(own[i : i + n].tobytes())
                if items is not None:
                    hit[i : i + n] = True
                    met.update(items)
        return hit, met


def _window_hashes(own: np.ndarray, n: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the windows of n numbers that begin at ``starts`` (all by default)."""
    starts = np.arange(len(own) - n + 1) if starts is None else starts
    values, total, factor = own.astype(np.uint64), np.zeros(len(starts), dtype=np.uint64), 1
    for i in range(n):
        total += values[starts + i] * np.uint64(factor)
        factor = factor * _ODD & _MASK
    return total


def item_parts(item: object, text: str | None, width: int, most: int) -> Iterator[tuple[object, str | None]]:
    """An item whole or, beyond ``most`` bytes, in parts that overlap by a window less a word, so each of its windows is in one."""
    if not text or len(text) <= most:
        yield item, text
        return
    own = words(text)
    step = max(1, most // 8)
    for at in range(0, max(1, len(own) - width + 1), step):
        yield item, b" ".join(own[at : at + step + width - 1]).decode()


def item_blocks(items: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of about ``block_bytes`` bytes of text, long ones in parts; one block at a time is on the driver."""
    block, held = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        for part in item_parts(r["item_id"], r["text"], width, block_bytes):
            block.append(part)
            held += len((part[1] or "").encode())
            if held >= block_bytes:
                yield block
                block, held = [], 0
    yield block


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


_FOUND = "doc_id bigint, text_hash bigint, n_words bigint, n_hit bigint, items array<string>, marks binary"


def _scanned(rows: DataFrame, held, all_rows: bool) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, items, marks) of keyed rows under one block; only of those with hits unless ``all_rows``."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("marks", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe.release()
        windows = held.value
        for batch in batches:
            out = []
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = words(text.as_py())
                hit, met = windows.scan(own)
                if all_rows or met:
                    out.append((doc_id, text_hash, len(own), int(hit.sum()), sorted({windows.items[k] for k in met}), np.packbits(hit).tobytes() if met else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return rows.mapInArrow(made, _FOUND)


def _merged(found: DataFrame) -> DataFrame:
    """One row per key from the rows of several blocks: marks and items together."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("marks", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, items, marks = [], [], []
            for parts in batch.column(2).to_pylist():
                both = np.bitwise_or.reduce([np.frombuffer(p["marks"], np.uint8) for p in parts])
                hits.append(int(np.unpackbits(both).sum()))
                items.append(sorted({x for p in parts for x in p["items"]}))
                marks.append(both.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(marks, pa.binary())], schema=schema)

    # a block sends equal rows once, so a key has no more parts than there are blocks
    once = found.groupBy("doc_id", "text_hash", "block").agg(F.first(F.struct("items", "marks")).alias("p"))
    return once.groupBy("doc_id", "text_hash").agg(F.collect_list("p").alias("p")).mapInArrow(made, "doc_id bigint, text_hash bigint, n_hit bigint, items array<string>, marks binary")


def _by_blocks(docs: DataFrame, blocks: Iterator, width: int, scratch: list[str], all_rows: bool) -> tuple[DataFrame, DataFrame | None]:
    """The first block's rows and, if there are more blocks, the merged marks of all; a block is gone before the next comes.

    Only keys, marks and items are written, never texts.
    """
    rows = _keyed(docs)
    block = next(blocks)
    first = found = None
    for n, after in enumerate(blocks):
        held = broadcast_value(docs.sparkSession, WindowSet(block, width))
        own = staged(_scanned(rows, held, all_rows and n == 0), "hits", scratch)
        held.destroy()
        first = own if n == 0 else first
        hit = own.where("n_hit > 0").select("doc_id", "text_hash", "items", "marks", F.lit(n).alias("block"))
        found = hit if found is None else found.unionByName(hit)
        block = after
    held = broadcast_value(docs.sparkSession, WindowSet(block, width))
    if first is None:
        return _scanned(rows, held, all_rows), None
    own = staged(_scanned(rows, held, False), "hits", scratch)
    held.destroy()
    found = found.unionByName(own.select("doc_id", "text_hash", "items", "marks", F.lit(-1).alias("block")))
    return first, staged(_merged(found), "marks", scratch)


def hits(docs: DataFrame, items: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items) per row of ``docs`` (doc_id, text).

    ``items`` has (item_id, text). doc_id is an integer; texts of any length are scanned whole. Null and empty texts have no words and no hits; repeated rows and
    null ids are kept one to one; repeated items count once by item_id, and items without an id have
    the name "None"; an empty table of items leaves every document clean; other columns are ignored.
    More items than one block take one more pass over the texts for each block, which writes the marks of the
    rows with hits; these tables are deleted.
    """
    small_batches(docs.sparkSession)
    scratch: list[str] = []
    rows, merged = _by_blocks(docs, item_blocks(items, width, block_bytes), width, scratch, True)
    if merged is not None:
        rows = _beside(rows.select("doc_id", "text_hash", "n_words"), merged)
        rows = rows.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    found = rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items"
    )
    if merged is not None:
        found = staged(found, "judged")
        drop_dirs(docs.sparkSession, scratch)
    return found


def _beside(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_hash, …) with the merged columns of their key, null without hits."""
    held = merged.withColumnsRenamed({"doc_id": "__doc", "text_hash": "__text"})
    return rows.join(held, rows["doc_id"].eqNullSafe(held["__doc"]) & (rows["text_hash"] == held["__text"]), "left").drop("__doc", "__text")


def without_hits(docs: DataFrame, items: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES, remove: str = "documents") -> DataFrame:
    """``docs``, all columns, without contaminated documents, or with the hit spans cut from their texts.

    A span reaches from the first to the last hit word of a stretch of hits; the texts around it are
    joined by one space. The hits of all items are gathered before anything is cut, so spans don't
    depend on the blocks. Clean texts, null ones included, stay as they are, as do repeated rows. One block
    is looked up in place; with more, a worker holds one at a time, and a table of the marked rows' keys and marks stays for the result.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    small_batches(docs.sparkSession)
    blocks = item_blocks(items, width, block_bytes)
    block = next(blocks)
    after = next(blocks, None)
    if after is None:
        held = broadcast_value(docs.sparkSession, WindowSet(block, width))
        if remove == "documents":
            return docs.where(_clean_udf(held)("text"))
        return docs.withColumn("text", _cut_udf()("text", _marks_udf(held)("text")))
    scratch: list[str] = []
    _, merged = _by_blocks(docs, chain([block, after], blocks), width, scratch, False)
    drop_dirs(docs.sparkSession, scratch[:-1])
    own, row = docs.columns, F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64("text"))
    marked = possibly_in(docs, row, merged.select(F.xxhash64("doc_id", "text_hash").alias("h")))
    clean = marked.where(~F.col("__hit")).select(*own)
    held = merged.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), F.col("marks").alias("__marks"))
    left = marked.where("__hit").withColumns({"__id": F.col("doc_id").cast("bigint"), "__hash": F.xxhash64("text")})
    left = left.join(held, F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__text")), "left")
    left = left.where("__marks is null") if remove == "documents" else left.withColumn("text", _cut_udf()("text", "__marks"))
    return clean.unionByName(left.select(*own))


def _clean_udf(held):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        bpe.release()
        return pd.Series([not held.value.scan(words(t))[1] for t in texts], dtype=bool)

    return clean


def _marks_udf(held):
    @F.pandas_udf("binary")
    def marked(texts: pd.Series) -> pd.Series:
        found = [held.value.scan(words(t))[0] for t in texts]
        return pd.Series([np.packbits(hit).tobytes() if hit.any() else None for hit in found], dtype=object)

    return marked


def _cut_udf():
    @F.pandas_udf("string")
    def cut(texts: pd.Series, marks: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, m) for t, m in zip(texts, marks)], dtype=object)

    return cut


def _cut(text: str | None, marks: bytes | None) -> str | None:
    if not text or marks is None:
        return text
    raw = text.encode()
    spans = [m.span() for m in WORD.finditer(raw.translate(LOWER))]
    hit = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(spans)).astype(np.int8)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0]))))
    out, at = [], 0
    for first, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out.append(raw[at : spans[first][0]].decode().rstrip())
        at = spans[end - 1][1]
    out.append(raw[at:].decode().lstrip())
    return " ".join(x for x in out if x)
