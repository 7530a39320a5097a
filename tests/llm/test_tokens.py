import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from filingmill.llm import bpe, token_count, token_file
from filingmill.llm.shared import fresh_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sre.,!é ’aZ09-"), st.characters(codec="utf-8")), max_size=30))
def test_ids_equal_the_library(text):
    assert bpe.id_bytes(PATH, text) == np.array(ids(text), "<u4").tobytes()
    assert bpe.id_count(PATH, text) == len(ids(text))


def test_counts(edge_docs, no_docs):
    got = token_count.token_counts(edge_docs, PATH).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(ids(r["text"])), len(ids(r["text"])) > 1024) for r in edge_docs.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_count.token_counts(no_docs, PATH).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_are_counted_by_their_library(edge_docs, name):
    path = public_tokenizers.path(name)
    if name.endswith("model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        own = Tokenizer.from_file(path)
        own.no_truncation()
        own.no_padding()
        count = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    small = edge_docs.where("doc_id <> 7 or doc_id is null")
    got = token_count.token_counts(small, path).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(r["doc_id"]), count(r["text"] or "")) for r in small.collect())


def test_archives_round_trip_in_order(edge_docs, no_docs):
    got = token_file.token_table(edge_docs, PATH).collect()
    rows = edge_docs.collect()
    assert len(got) == len(rows)
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in by_start:
        assert r["start"] == at
        at += r["n_tokens"]
    want = sorted((str(r["doc_id"]), len(e := np.array([*ids(r["text"]), 0], "<u4")), zlib.crc32(e.tobytes())) for r in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert token_file.token_table(no_docs, PATH).count() == 0


def test_reader_opens_only_the_frames_asked_for_and_checks_them(spark, tmp_path):
    uri = str(tmp_path / "x.zst")
    texts = [np.arange(n, dtype="<u4") for n in (0, 5, 3000, 1, 70_000, 2)]
    with open(uri, "wb") as out:
        writer = token_file.TokenFileWriter(out, frame_bytes=4000)
        for d, t in enumerate(texts):
            writer.add(d if d else None, t.tobytes())
        writer.close()
    reader = token_file.TokenFileReader(uri)
    assert len(reader.frames) == 3
    opened = []
    frame = reader.frame
    reader.frame = lambda k: opened.append(k) or frame(k)
    (found,) = list(reader.find({4}))
    assert opened == [1] and found[0] == 4 and (found[1] == texts[4]).all()
    raw = bytearray(open(uri, "rb").read())
    import zstandard

    assert zstandard.ZstdDecompressor().decompress(bytes(raw[reader.frames[2][0] :][: reader.frames[2][1]]), max_output_size=1 << 20)
    raw[reader.frames[0][0] + reader.frames[0][1] // 2] ^= 0xFF
    open(uri, "wb").write(bytes(raw))
    with pytest.raises(Exception):
        token_file.TokenFileReader(uri).frame(0)


def test_attempts_leave_one_whole_file(spark, edge_docs):
    directory = fresh_dir(spark, "twice")
    first = sorted(map(tuple, token_file.write_token_files(edge_docs, PATH, directory, partitions=3).collect()))
    assert sorted(map(tuple, token_file.write_token_files(edge_docs, PATH, directory, partitions=3).collect())) == first


def test_reading_back_joins_nothing(edge_docs):
    plan = token_file.token_table(edge_docs, PATH)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Broadcast" not in plan
