"""WARC archives: writing, normalising whole-file gzip streams, and reading by offset index.

A monolithic archive is one gzip stream over all its records, so no record can be reached without
inflating everything before it. The normaliser inflates such a stream once, in pieces, rewrites
every record as a gzip member of its own and writes a sidecar index of the members' offsets. It
takes archives that have members already, and any mixture.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm.shared import fresh_dir, opened, small_batches, spread, staged, whole_file

PIECE = 1 << 18
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Date of the records written here, a parameter so that archives are the same in every run.
DATE = "2026-01-01T00:00:00Z"


class Inflated:
    """The plain bytes of a gzip file of any number of members, read forward once."""

    def __init__(self, file) -> None:
        self.file, self.zip, self.held, self.at, self.packed = file, zlib.decompressobj(31), bytearray(), 0, b""
        self.begun = False

    def _more(self) -> bool:
        """Get another piece; False at the end."""
        if not self.packed:
            self.packed = self.file.read(PIECE)
            if not self.packed:
                if self.begun and not self.zip.eof:
                    raise ValueError("the gzip stream ends early")
                return False
        if self.zip.eof:
            self.zip, self.begun = zlib.decompressobj(31), False
        self.begun = True
        if self.at > PIECE:
            del self.held[: self.at]
            self.at = 0
        self.held += self.zip.decompress(self.packed, PIECE)
        self.packed = self.zip.unused_data.lstrip(b"\0") if self.zip.eof else self.zip.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end."""
        seen = self.at
        while True:
            found = self.held.find(mark, seen)
            if found >= 0:
                out = bytes(self.held[self.at : found + len(mark)])
                self.at = found + len(mark)
                return out
            left = len(self.held) - self.at
            if not self._more():
                if self.held[self.at :].strip():
                    raise ValueError("the archive ends inside a record's header")
                return None
            seen = max(self.at, self.at + left - len(mark))

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces."""
        while n:
            if self.at == len(self.held) and not self._more():
                raise ValueError("the archive ends inside a record")
            out = bytes(self.held[self.at : self.at + n])
            self.at += len(out)
            n -= len(out)
            if out:
                yield out


def header_fields(head: bytes) -> dict[str, str]:
    """The named fields of a record header; names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def normalise_stream(source, sink) -> Iterator[dict]:
    """Rewrite the records of ``source`` as members of ``sink``; yields an index entry for each.

    Header and block bytes are kept as they are. Memory is bounded by a header and a piece.
    """
    stream, offset = Inflated(source), 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        if not head:
            continue
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = header_fields(head)
        member = zlib.compressobj(6, zlib.DEFLATED, 31)
        n = sink.write(out) if (out := member.compress(head)) else 0
        for piece in stream.pieces(int(fields["content-length"])):
            if out := member.compress(piece):
                n += sink.write(out)
        n += sink.write(member.compress(b"\r\n\r\n") + member.flush())
        yield {"offset": offset, "length": n, "record_id": fields.get("warc-record-id"), "type": fields.get("warc-type"), "uri": fields.get("warc-target-uri")}
        offset += n


def normalised(archives: DataFrame, directory: str) -> DataFrame:
    """(archive, index, records) of the normalised form of every archive (column ``archive``).

    Each archive is one task's stream; its new form and sidecar (JSON lines of offset, length,
    record_id, type, uri) appear below ``directory`` whole or not at all. An archive without records
    gives an empty one; a broken one raises.
    """
    schema = pa.schema([("archive", pa.string()), ("index", pa.string()), ("records", pa.int64())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                name = f"{directory}/{hashlib.sha1(uri.encode()).hexdigest()[:12]}-{uri.rsplit('/', 1)[-1]}"
                store, path = opened(uri)
                n = 0
                with whole_file(f"{name}.idx") as index, whole_file(name) as sink, store.open_input_stream(path, compression=None) as source:
                    for entry in normalise_stream(source, sink):
                        index.write(json.dumps(entry).encode() + b"\n")
                        n += 1
                yield pa.RecordBatch.from_pylist([{"archive": name, "index": f"{name}.idx", "records": n}], schema=schema)

    return staged(spread(archives.select("archive"), "archive").mapInArrow(made, "archive string, index string, records bigint"), "warc-files")


def record_at(file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """The fields and block of the member at an offset."""
    file.seek(offset)
    plain = zlib.decompress(file.read(length), 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = header_fields(head)
    return fields, rest[: int(fields["content-length"])]


def _clean(value: str) -> str:
    return "".join(c for c in value if c >= " ")


def page_urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """A response record, or a revisit of the page ``refers_to`` without its payload."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {page_urn(page_id)}", f"WARC-Date: {date}"]
    head.append(f"WARC-Target-URI: {_clean(url) if url else page_urn(page_id)[1:-1]}")
    head.append(f"WARC-Payload-Digest: {digest}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {page_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``page_id, url, payload, refers_to, revisit`` per row of ``pages`` (page_id, url, html).

    Among rows of equal payloads of at least ``least`` bytes one with the largest page_id is the
    response. Copies are found by digest from counts of the table, and only digests that occur more
    than once are joined; shorter payloads, all empty ones among them, have keys that spread and match none.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    long_ones = rows.where(F.octet_length("payload") >= least)
    copies = long_ones.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    keyed = rows.withColumn("digest", F.when(F.octet_length("payload") >= least, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id"), F.lit(0)).cast("string"))))
    joined = keyed.join(staged(copies, "copies"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), F.coalesce(revisit, F.lit(False)).alias("revisit"))


def write_monolithic(records: DataFrame, directory: str) -> DataFrame:
    """Write one whole-file gzip archive for each partition of ``revisits``; returns (archive)."""
    small_batches(records.sparkSession)
    schema = pa.schema([("archive", pa.string())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        uri = f"{directory}/pages-{TaskContext.get().partitionId():08d}.warc.gz"
        with whole_file(uri) as sink:
            stream = zlib.compressobj(3, zlib.DEFLATED, 31)
            info = b"software: filingmill\r\n"
            sink.write(stream.compress(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-info:{uri.rsplit('/', 1)[-1]}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n"))
            while batch is not None:
                for row in zip(*[c.to_pylist() for c in batch.columns]):
                    sink.write(stream.compress(page_record(*row)))
                batch = next((b for b in batches if b.num_rows), None)
            sink.write(stream.flush())
        yield pa.RecordBatch.from_arrays([pa.array([uri])], schema=schema)

    return staged(records.select("page_id", "url", "payload", "refers_to", "revisit").mapInArrow(made, "archive string"), "warc-files")


def _page_of(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").rpartition(":")[2]
    return None if name in ("", "none") else int(name)


def read_pages(files: DataFrame) -> DataFrame:
    """Page records of normalised archives, each read at its offset and checked against its digest.

    (page_id, url, payload_bytes, payload_digest, record_type, refers_to, archive, offset, length);
    bytes and digest are those of the full payload, also for revisits.
    """
    fields = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, archive string, offset bigint, length bigint"
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in fields.split(", ")])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = opened(archive)
                index_store, index_path = opened(index)
                with store.open_input_file(path) as file, index_store.open_input_stream(index_path) as lines:
                    rows = []
                    for entry in map(json.loads, lines.read().splitlines()):
                        if entry["type"] not in ("response", "revisit"):
                            continue
                        head, block = record_at(file, entry["offset"], entry["length"])
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
                        size = int(header_fields(http)["content-length"])
                        if entry["type"] == "response" and (hashlib.sha1(payload).digest() != digest or len(payload) != size):
                            raise ValueError(f"{head['warc-record-id']} in {archive} fails its digest")
                        rows.append(
                            {"page_id": _page_of(head["warc-record-id"]), "url": head.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest.hex(), "record_type": entry["type"]}
                            | {"refers_to": _page_of(head.get("warc-refers-to")), "archive": archive, "offset": entry["offset"], "length": entry["length"]}
                        )
                        if len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return spread(files.select("archive", "index"), "archive").mapInArrow(made, fields)


def archived(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write ``pages`` to whole-file archives, normalise these, and read the pages back.

    Null html is an empty payload, a null url is the page's own urn, a null page_id has none; rows
    with equal ids and payloads are all responses of that id; other columns are ignored; an empty
    table writes nothing.
    """
    spark = pages.sparkSession
    archives = write_monolithic(revisits(pages, least), fresh_dir(spark, "warc-whole"))
    return read_pages(normalised(archives, fresh_dir(spark, "warc")))
