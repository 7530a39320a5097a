import gzip
import hashlib
import json
import random

import pytest

from filingmill.llm import warc
from filingmill.llm.shared import fresh_dir

BIG = "<p>" + "ä word " * 300 + "</p>"
PAGES = [(1, "http://a/", BIG, "x"), (2, "http://b/\r\nX: y", BIG, None), (3, None, None, "x"), (4, "http://d/", "", "x"), (5, "u", "short", "x"), (6, "u", "short", "x"), (7, "v", BIG + "é", "x"), (None, "w", "WARC/1.1\r\n\r\n" * 200, "x"), (9, "r", BIG, "x"), (9, "r", BIG, "x"), (10, "l", "long " * 400_000, "x")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string, digest string")


def test_round_trip(pages):
    got = warc.archived(pages).collect()
    want = []
    for page_id, _, page, _ in PAGES:
        raw = (page or "").encode()
        same = [p[0] for p in PAGES if (p[2] or "").encode() == raw]
        revisit = len(raw) >= 1000 and len(same) > 1 and page_id != max(same)
        want.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=str) == sorted(want, key=str)
    assert warc.archived(pages.where("false")).count() == 0


def whole(records, members):
    random.seed(members)
    if members:
        return b"".join(gzip.compress(r) for r in records)
    return gzip.compress(b"".join(records))


@pytest.mark.parametrize("members", [0, 1])
def test_normaliser_keeps_records_and_indexes_them(spark, tmp_path, members):
    records = [warc.page_record(i, f"http://x/{i}", bytes([i]) * (i * 5000), None, False) for i in range(40)]
    source = tmp_path / "in.warc.gz"
    source.write_bytes(whole(records, members))
    out = warc.normalised(spark.createDataFrame([(str(source),)], "archive string"), fresh_dir(spark, "norm")).first()
    assert out["records"] == 40
    name = out["archive"].replace("file:", "")
    raw = open(name, "rb").read()
    entries = [json.loads(x) for x in open(name + ".idx")]
    assert [gzip.decompress(raw[e["offset"] : e["offset"] + e["length"]]) for e in entries] == records
    assert gzip.decompress(raw) == b"".join(records) and entries[-1]["offset"] + entries[-1]["length"] == len(raw)


def test_broken_archives_raise(tmp_path):
    import io

    record = warc.page_record(1, "u", b"x" * 9000, None, False)
    for raw in (gzip.compress(record)[:-40], gzip.compress(record[:-500]), gzip.compress(b"GET / HTTP/1.1\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.normalise_stream(io.BytesIO(raw), io.BytesIO()))
    assert list(warc.normalise_stream(io.BytesIO(gzip.compress(b"")), io.BytesIO())) == []
