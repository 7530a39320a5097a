"""Cross-tokenizer alignment by a dangling-suffix transducer.

Two tokenizations of one text are read side by side. The state says which side leads and the bytes of its
last token that the other side hasn't reached: the dangling suffix. Every token that the lagging side adds
overlaps the leader's last one, which is a link; an empty suffix closes a group. Transitions depend on
the state and the next token alone, so they are memoised.

A text is cut where a space or line feed follows another character that isn't white space: no token of
either vocabulary reaches over such a place, which is proven on the vocabularies, so groups close there
and chunks are aligned once each. Texts with other white space, and all texts if the proof fails, are one chunk.

Corpus-wide counts of linked ids go back to the documents by block: a task's documents with the chunks
that they are made of, so only a block's distinct id pairs are shuffled and no table of counts is broadcast.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm import bpe
from filingmill.llm.shared import drop_dirs, small_batches, staged

#: Distinct chunks and chunks in all of a block.
BLOCK_CHUNKS, BLOCK_WORDS = 300_000, 6_000_000
#: Chunks whose alignment a worker keeps, and the longest ones that it keeps.
KEPT_CHUNKS, LONGEST_KEPT = 200_000, 64
#: States and transitions that a transducer keeps before it begins anew.
KEPT_STEPS = 1_000_000
#: A pair of ids is one number: the first side's times this and the second's.
SIDE = 1 << 20

_CUT = re.compile(r"[ \n]*[^ \n]+|[ \n]+\Z")
#: White space that either library treats in a way of its own.
_WHOLE = re.compile("[\\t\\r\\v\\f\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u2060\\u3000\\ufeff]")
#: The piece model's mark for a space.
_SPACE = "\u2581"


class Transducer:
    """Aligns ids of two vocabularies, given as their tokens' bytes by id."""

    def __init__(self, left: Sequence[bytes], right: Sequence[bytes]) -> None:
        self.left, self.right = left, right
        self._begin()

    def _begin(self) -> None:
        self.states: dict[tuple[bool, bytes], int] = {}
        self.held: list[bytes] = [b""]
        self.steps: dict[int, int] = {}

    def _state(self, leads: bool, rest: bytes) -> int:
        """The number of a state: even if the left side leads, odd if the right one does; nothing left is 0, balance."""
        if not rest:
            return 0
        found = self.states.get((leads, rest))
        if found is None:
            found = self.states[leads, rest] = 2 * len(self.held) + (not leads)
            self.held.append(rest)
        return found

    def _step(self, state: int, token: int) -> int:
        """The state after the lagging side's next token (the left side's in balance); -1 if the bytes differ."""
        leads, rest = not state & 1, self.held[state >> 1]
        if state == 0:
            after = self._state(True, self.left[token])
        else:
            own = self.right[token] if leads else self.left[token]
            if rest.startswith(own):
                after = self._state(leads, rest[len(own) :])
            elif own.startswith(rest):
                after = self._state(not leads, own[len(rest) :])
            else:
                after = -1
        self.steps[state * SIDE + token] = after
        return after

    def align(self, a: Sequence[int], b: Sequence[int]) -> tuple[list[int], list[tuple[int, int]]] | None:
        """(links, ends) of two tokenizations, None if their bytes differ.

        A link is a pair of ids as one number; an end says how many tokens of each side precede the end of a group.
        """
        if len(self.steps) > KEPT_STEPS:
            self._begin()
        links, ends, i, j, n, m, get = [], [], 0, 0, len(a), len(b), self.steps.get
        while i < n:
            x = a[i]
            i += 1
            state = get(x)
            if state is None:
                state = self._step(0, x)
            while state:
                if state & 1:
                    if i == n:
                        return None
                    token = x = a[i]
                    i += 1
                else:
                    if j == m:
                        return None
                    token = y = b[j]
                    j += 1
                links.append(x * SIDE + y)
                after = get(state * SIDE + token)
                state = self._step(state, token) if after is None else after
                if state < 0:
                    return None
            ends.append((i, j))
        return (links, ends) if j == m else None


class Aligner:
    """Chunks of texts under a byte-level BPE file and a sentencepiece model, both on a text with a space before it."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import sentencepiece

        self.bytes = bpe.PretokenEncoder(byte_path, tuple, lambda parts: sum(parts, ()))
        self.bytes.library.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        with open(byte_path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        back = {c: b for b, c in enumerate(bpe._byte_chars())}
        left = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            if all(c in back for c in token):
                left[k] = bytes(back[c] for c in token)
        model = self.pieces
        names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        right = [bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace(_SPACE, " ").encode() for k, p in enumerate(names)]
        plain = [p for k, p in enumerate(names) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))]
        #: Whether no piece has a line feed or reaches over a space that follows something else, nor changes a text's white space.
        self.cuts = not any("\n" in p or _SPACE in p.lstrip(_SPACE) for p in plain) and model.encode("a  b ", out_type=str)[-1] == _SPACE
        self.machine = Transducer(left, right)
        self.names = [str(k) for k in range(max(len(left), len(right)))]
        self.kept: dict[str, tuple | None] = {}

    def chunks(self, text: str) -> list[str]:
        """A space and the text, cut where no token of either side reaches over."""
        whole = " " + text
        return [whole] if not self.cuts or _WHOLE.search(text) else _CUT.findall(whole)

    def _right(self, chunks: list[str]) -> list[list[int]]:
        """The second side's ids of chunks; the model adds a space of its own, which a chunk has or which is dropped."""
        found = self.pieces.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        alone = self.pieces.piece_to_id(_SPACE)  # the model adds nothing to an empty text
        return [([alone] if c == " " else ids) if c[0] == " " else ids[1:] for c, ids in zip(chunks, found)]

    def _left(self, chunk: str) -> tuple[int, ...]:
        """The first side's ids of a chunk. ASCII letters after one space or none are one pre-token, a mark after them another."""
        own, word = self.bytes, chunk[1:] if chunk[0] == " " else chunk
        if word.isascii():
            if word.isalpha():
                return own.cache.get(chunk) or own._merged(chunk)
            if word[-1:] in own.marks and word[:-1].isalpha():
                return (own.cache.get(chunk[:-1]) or own._merged(chunk[:-1])) + own.marks[word[-1]]
        return own.add(own._split(chunk))

    def _made(self, chunk: str, b: list[int]) -> tuple | None:
        a = self._left(chunk)
        found = self.machine.align(a, b) if _SPACE not in chunk else None
        if found is None:
            return None
        links, ends = found
        if len(ends) == len(a) == len(b):
            text = [f"{x}|{y}" for x, y in zip(a, b)]
        else:
            text, p, q, name = [], 0, 0, self.names.__getitem__
            for i, j in ends:
                text.append(f"{a[p] if i == p + 1 else ','.join(map(name, a[p:i]))}|{b[q] if j == q + 1 else ','.join(map(name, b[q:j]))}")
                p, q = i, j
        return len(a), len(b), len(ends), links, ";".join(text)

    def aligned(self, chunks: list[str]) -> list[tuple[int, int, int, list[int], str] | None]:
        """(n_a, n_b, n_groups, links, groups) of each chunk; None if the two sides' bytes differ from it."""
        out = list(map(self.kept.get, chunks))
        new = [k for k, c in enumerate(chunks) if out[k] is None and c not in self.kept]
        for k, b in zip(new, self._right([chunks[k] for k in new])):
            out[k] = self._made(chunks[k], b)
            if len(chunks[k]) <= LONGEST_KEPT:
                if len(self.kept) >= KEPT_CHUNKS:
                    self.kept.clear()
                self.kept[chunks[k]] = out[k]
        return out


_ALIGNER: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """The aligner of this process for two files."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (byte_path, piece_path) not in _ALIGNER:
        bpe.release()
        _ALIGNER[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _ALIGNER[byte_path, piece_path]


_DOC = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("chunks", pa.binary())])
_BLOCK = pa.schema([("links", pa.binary()), ("sizes", pa.binary()), ("pairs", pa.list_(pa.int64())), ("seen", pa.list_(pa.int64()))])
_BOTH = pa.schema([*_DOC, *_BLOCK])


def _packed(numbers: np.ndarray) -> bytes:
    """Non-negative 32-bit numbers, their four bytes apart, under zstandard."""
    return zstandard.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(held: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(held), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


class _Block:
    """Documents of one task, and the distinct chunks that they are made of."""

    def __init__(self, number: int) -> None:
        self.number, self.codes, self.words = number, {}, 0
        self.links = array("q")
        self.sizes = array("q")
        self.counts = (array("q"), array("q"), array("q"))
        self.groups: list[str] = []
        self.seen: list[np.ndarray] = []

    def add(self, tool: Aligner, text: str | None) -> tuple:
        """A document's columns from n_a on; a text whose bytes the two sides don't give back has none of either."""
        parts = tool.chunks(text) if text else []
        own = list(map(self.codes.get, parts))
        if None in own:
            new = list(dict.fromkeys(p for p, code in zip(parts, own) if code is None))
            found = tool.aligned(new)
            if None in found:
                parts = []
            else:
                self.codes.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
                *counts, links, groups = zip(*found)
                for held, n in zip(self.counts, counts):
                    held.extend(n)
                self.groups += groups
                self.links.extend(chain.from_iterable(links))
                self.sizes.extend(map(len, links))
                own = list(map(self.codes.__getitem__, parts))
        if not parts:
            return 0, 0, 0, 0, "", _packed(np.zeros(0))
        codes = np.array(own, dtype=np.uint32)
        n_a, n_b, n_groups = (int(np.frombuffer(held, np.int64)[codes].sum()) for held in self.counts)
        digest = hashlib.sha256(";".join(map(self.groups.__getitem__, own)).encode()).hexdigest()
        self.words += len(own)
        self.seen.append(codes)
        return n_a, n_b, n_groups, n_a + n_b - n_groups, digest, _packed(codes)

    def full(self, most: int) -> bool:
        return len(self.codes) >= most or self.words >= BLOCK_WORDS

    def row(self) -> pa.RecordBatch:
        """The block's own row: links by chunk as places among its distinct pairs, the pairs, and how often it has each."""
        links, sizes = np.frombuffer(self.links, np.int64), np.frombuffer(self.sizes, np.int64)
        pairs, at = np.unique(links, return_inverse=True)
        times = np.bincount(np.concatenate(self.seen), minlength=len(sizes))
        seen = np.bincount(at, weights=np.repeat(times, sizes).astype(np.float64), minlength=len(pairs)).astype(np.int64)
        none = [pa.nulls(1, f.type) for f in list(_DOC)[1:]]
        return pa.RecordBatch.from_arrays([pa.array([self.number], pa.int64()), *none, pa.array([_packed(at)]), pa.array([_packed(sizes)]), pa.array([pairs], pa.list_(pa.int64())), pa.array([seen], pa.list_(pa.int64()))], schema=_BOTH)


def coded(docs: DataFrame, byte_path: str, piece_path: str, block_chunks: int = BLOCK_CHUNKS) -> DataFrame:
    """Rows of documents (with ``chunks``) and of blocks (with ``pairs``), which share their block's number."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_path, piece_path)
        part = TaskContext.get().partitionId() << 32
        block = _Block(part)
        collects = gc.isenabled()
        gc.disable()  # many tuples are kept and none is in a cycle
        try:
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1)
                rows = []
                for doc_id, text in zip(ids, texts):
                    rows.append((block.number, doc_id, *block.add(tool, text.as_py())))
                    if block.full(block_chunks):
                        yield block.row()
                        part += 1
                        block = _Block(part)
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _DOC)] if rows else [pa.array([], f.type) for f in _DOC]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(rows), f.type) for f in _BLOCK]], schema=_BOTH)
            if block.seen:
                yield block.row()
        finally:
            if collects:
                gc.enable()

    schema = "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, chunks binary, links binary, sizes binary, pairs array<bigint>, seen array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(made, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best) of all linked ids of ``blocks`` (pairs, seen); best: no first id has more links with the second."""
    own = blocks.select(F.explode(F.arrays_zip("pairs", "seen")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.seen").alias("count"))
    own = own.withColumn("b", F.col("pair") % SIDE)
    # one row for each id of the second vocabulary
    most = own.groupBy("b").agg(F.max("count").alias("most"))
    return own.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, byte_path: str, piece_path: str, block_chunks: int = BLOCK_CHUNKS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs`` (doc_id, text).

    A space and the text are encoded by the byte-level BPE file (A), the text by the sentencepiece model,
    which adds the space itself (B), with the strings of special tokens as plain text. Groups end where
    tokens of both end; links are pairs of tokens whose bytes overlap; ``n_best`` counts the links whose
    pair of ids is linked most often in all documents among those of its B id, ties included, and
    ``count_sum`` sums the pairs' counts over the links. Texts that are null or empty, or whose bytes a
    side doesn't give back, have no tokens: zeros and the empty string. Rows, repeated ones and null
    ids included, are kept one to one; texts of any length are taken whole; other columns are ignored;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch: list[str] = []
    rows = staged(coded(docs, byte_path, piece_path, block_chunks), "coded", scratch)
    blocks = spark.read.schema(rows.schema).parquet(scratch[0]).where("pairs is not null")
    counts = staged(pair_counts(blocks), "counts", scratch)
    places = blocks.select("block", F.posexplode("pairs").alias("place", "pair")).join(counts, "pair").select("block", "place", "count", "best", F.lit(None).cast("binary").alias("links"), F.lit(None).cast("binary").alias("sizes"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("place", "int"), ("count", "bigint"), ("best", "boolean"))]
    looked_up = places.unionByName(blocks.select("block", *none, "links", "sizes"))
    own = rows.where("chunks is not null").select(*[f.name for f in _DOC])
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        best = total = None
        if right.num_rows:
            body = right.filter(pc.is_valid(right["links"]))
            found = right.filter(pc.is_valid(right["place"]))
            order = np.argsort(found["place"].to_numpy())
            of, sizes = _unpacked(body["links"][0].as_py()), _unpacked(body["sizes"][0].as_py())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            best, total = (np.bincount(owner, weights=found[c].to_numpy()[order][of].astype(np.float64), minlength=len(sizes)) for c in ("best", "count"))
            if total.max(initial=0) >= 1 << 53:  # past exact floats
                total = np.zeros(len(sizes), dtype=np.int64)
                np.add.at(total, owner, found["count"].to_numpy()[order][of])
        n_best, sums = [], []
        for packed in left["chunks"].to_pylist():
            codes = _unpacked(packed)
            n_best.append(int(best[codes].sum()) if len(codes) else 0)
            sums.append(int(total[codes].astype(np.int64).sum()) if len(codes) else 0)
        made = {c: left[c] for c in names if c in left.column_names} | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        return pa.table({c: made[c] for c in names})

    grouped = own.groupBy("block").cogroup(looked_up.groupBy("block"))
    found = grouped.applyInArrow(summed, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in names))
    out = staged(found, "aligned")
    drop_dirs(spark, scratch)
    return out
