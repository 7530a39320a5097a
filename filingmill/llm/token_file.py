"""Token-id archives: independent zstandard frames with a trailing seek table.

A file follows the public seekable zstandard layout. Each frame holds some whole documents: a
header of (documents, their ids, their token counts) and the token ids as little-endian unsigned
32-bit integers. A skippable frame lists the documents of every frame, and the last skippable frame
is the seek table, with the compressed and plain size and the low 32 bits of the XXH64 of every
frame's plain bytes. A reader needs the tail of the file and the frames of the documents asked for.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingmill.llm import bpe
from filingmill.llm.shared import broadcast_value, fresh_dir, opened, small_batches, spread, staged, whole_file

# Fixed values of the zstandard formats.
SKIPPABLE = 0x184D2A5E
SKIPPABLE_DOCS = 0x184D2A50
SEEKABLE = 0x8F92EAB1
#: Plain bytes after which a frame ends; a longer document has a frame of its own.
FRAME_BYTES = 1 << 20
NO_ID = -(1 << 63)


class TokenFileWriter:
    """Appends documents in order to an output stream."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3) -> None:
        self.out, self.limit, self.zstd = out, frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.docs: list[int] = []
        self.counts: list[int] = []
        self.ids: list[bytes] = []
        self.held = 0
        self.frames: list[tuple[int, int, int]] = []
        self.listing: list[bytes] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(NO_ID if doc_id is None else doc_id)
        self.counts.append(len(ids) // 4)
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= self.limit:
            self._flush()

    def _flush(self) -> None:
        if not self.docs:
            return
        listing = struct.pack("<I", len(self.docs)) + np.array(self.docs, "<i8").tobytes() + np.array(self.counts, "<u8").tobytes()
        plain = listing + b"".join(self.ids)
        packed = self.zstd.compress(plain)
        self.out.write(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.listing.append(listing)
        self.docs, self.counts, self.ids, self.held = [], [], [], 0

    def close(self) -> None:
        """Write the document listing and the seek table."""
        self._flush()
        listing = self.zstd.compress(b"".join(self.listing))
        self.out.write(struct.pack("<II", SKIPPABLE_DOCS, len(listing)) + listing)
        entries = b"".join(struct.pack("<III", *f) for f in [*self.frames, (len(listing) + 8, 0, 0)])
        n = len(self.frames) + 1
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", n, 0x80, SEEKABLE))


class TokenFileReader:
    """Random access to the documents of an archive."""

    def __init__(self, uri: str) -> None:
        store, path = opened(uri)
        self.file, size = store.open_input_file(path), store.get_file_info(path).size
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError(f"{uri} has no seek table with checksums")
        table = self._at(size - 9 - 12 * n, 12 * n)
        self.frames, at = [], 0
        for k in range(n):
            packed, plain, check = struct.unpack_from("<III", table, 12 * k)
            self.frames.append((at, packed, plain, check))
            at += packed
        start, packed, _, _ = self.frames.pop()
        listing = zstandard.ZstdDecompressor().decompress(self._at(start + 8, packed - 8), max_output_size=0) if packed > 8 else b""
        self.docs: list[tuple[np.ndarray, np.ndarray]] = []
        at = 0
        while at < len(listing):
            ids, counts, at = _listed(listing, at)
            self.docs.append((ids, counts))

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def frame(self, k: int) -> list[tuple[int | None, memoryview]]:
        """The documents of a frame with the bytes of their ids, checked."""
        start, packed, size, check = self.frames[k]
        plain = zstandard.ZstdDecompressor().decompress(self._at(start, packed), max_output_size=size)
        if len(plain) != size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} fails its checksum")
        ids, counts, at = _listed(plain, 0)
        out, view = [], memoryview(plain)
        for d, c in zip(ids.tolist(), counts.tolist()):
            out.append((None if d == NO_ID else d, view[at : at + 4 * c]))
            at += 4 * c
        return out

    def find(self, doc_ids: set[int]) -> Iterator[tuple[int, np.ndarray]]:
        """(doc_id, ids) of the documents asked for; only their frames are read."""
        for k, (ids, _) in enumerate(self.docs):
            if not doc_ids.isdisjoint(ids.tolist()):
                yield from ((d, np.frombuffer(b, "<u4")) for d, b in self.frame(k) if d in doc_ids)

    def close(self) -> None:
        self.file.close()


def _listed(raw: bytes, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    (n,) = struct.unpack_from("<I", raw, at)
    ids = np.frombuffer(raw, "<i8", n, at + 4)
    return ids, np.frombuffer(raw, "<u8", n, at + 4 + 8 * n), at + 4 + 16 * n


def write_token_files(docs: DataFrame, vocabulary: str, directory: str, end_id: int = 0, partitions: int | None = None) -> DataFrame:
    """Write the documents' ids below ``directory`` in ascending doc_id order; one row per file.

    Returns (part, uri, n_docs, n_tokens), the files in order of ``part``. doc_id is an integer; texts of
    any length are encoded whole. Each document's ids end with ``end_id``. Null texts have that id alone; rows without a doc_id come first; of equal ids
    the order is that of the texts' hashes; an empty table writes nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    schema = pa.schema([("part", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
    end = struct.pack("<I", end_id)
    proven = broadcast_value(spark, bpe.whole_tokens(vocabulary))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        bpe.take(vocabulary, proven.value)
        part = TaskContext.get().partitionId()
        uri = f"{directory}/ids-{part:08d}.zst"
        n_docs = n_tokens = 0
        with whole_file(uri) as out:
            writer = TokenFileWriter(out)
            while batch is not None:
                for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = (bpe.id_bytes(vocabulary, t) if t else b"") + end
                    writer.add(d, ids)
                    n_docs, n_tokens = n_docs + 1, n_tokens + len(ids) // 4
                batch = next((b for b in batches if b.num_rows), None)
            writer.close()
        yield pa.RecordBatch.from_pylist([{"part": part, "uri": uri, "n_docs": n_docs, "n_tokens": n_tokens}], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ranged = rows.repartitionByRange(partitions, "doc_id", "h") if partitions else rows.repartitionByRange("doc_id", "h")
    ordered = ranged.sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return staged(ordered.mapInArrow(made, "part int, uri string, n_docs bigint, n_tokens bigint"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """(part, pos, doc_id, n_tokens, ids_crc32, start) of every document in the archives, frame by frame.

    ``files`` has (part, uri, before), ``before`` being the number of ids in the files before, see
    ``with_starts``. ``pos`` numbers the documents of a file; ``start`` is the number of ids before one.
    """
    schema = pa.schema([("part", pa.int32()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("start", pa.int64())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, uri, start in zip(*[c.to_pylist() for c in batch.columns]):
                reader, pos = TokenFileReader(uri), 0
                for k in range(len(reader.frames)):
                    rows = []
                    for d, b in reader.frame(k):
                        rows.append({"part": part, "pos": pos, "doc_id": d, "n_tokens": len(b) // 4, "ids_crc32": zlib.crc32(b), "start": start})
                        pos, start = pos + 1, start + len(b) // 4
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                reader.close()

    return spread(files.select("part", "uri", "before"), "part").mapInArrow(made, "part int, pos bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint, start bigint")


def with_starts(files: DataFrame) -> DataFrame:
    """Add ``before``, the ids of all files before each; one row per file goes to one task."""
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("before", F.coalesce(before, F.lit(0)))


def token_table(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, read back from archives written for ``docs``.

    Order, nulls and ties are those of ``write_token_files``; other columns are ignored.
    """
    directory = fresh_dir(docs.sparkSession, "token-ids")
    files = write_token_files(docs, vocabulary, directory, end_id)
    return read_token_files(with_starts(files)).select("doc_id", "start", "n_tokens", "ids_crc32")
