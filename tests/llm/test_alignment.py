import brute
import pytest

from filingmill.llm import alignment
from filingmill.llm.queries import BYTE_BPE, PIECE_BPE

ODD = [
    "  two  spaces ", "tab\tand\r\nline;\r\n x", "<|endoftext|> <s> a", "\n\nlead\n", "a\u2581b", "nbsp\u00a0x \u3000y", "", None, " ", "\n", "   \n \n  ",
    "\u6f22\u5b57 text \u00e9 \U0001f600 \x00z", "x" * 3000 + " y", "a \u200bz ", "trail \n ", "\ufeffbom x", "\x85 q", "1234567 12.5 don't I'll\n\nWe've", "e\u0301 x", "a\x1cb \x1f c",
    "The cat; the dog.", "The cat; the dog.", "unbelievable internationalization of the tokenizers",
]


def rows_of(df):
    return sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("parts, chunks", [(1, alignment.BLOCK_CHUNKS), (3, 4)])
def test_equals_byte_offsets(spark, parts, chunks):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id int, text string").repartition(parts)
    want = sorted(((i, *x) for i, x in enumerate(brute.aligned(ODD))), key=str)
    assert rows_of(alignment.alignments(df, BYTE_BPE, PIECE_BPE, block_chunks=chunks)) == want


def test_edges(edge_docs, no_docs):
    docs = edge_docs.where("doc_id is null or doc_id <> 7")
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], *x) for r, x in zip(rows, brute.aligned([r["text"] for r in rows]))), key=str)
    assert rows_of(alignment.alignments(docs, BYTE_BPE, PIECE_BPE)) == want
    assert rows_of(alignment.alignments(no_docs, BYTE_BPE, PIECE_BPE)) == []
    long = edge_docs.where("doc_id = 7")
    found = alignment.alignments(long, BYTE_BPE, PIECE_BPE).first()
    assert found["n_links"] == found["n_a"] + found["n_b"] - found["n_groups"] and found["n_groups"] >= 120_000


def test_transducer_closes_groups_and_finds_differences():
    machine = alignment.Transducer([b"ab", b"c", b"abc", b"x"], [b"a", b"bc", b"abc", b"ab"])
    at = alignment.SIDE
    assert machine.align([0, 1], [0, 1]) == ([0 * at + 0, 0 * at + 1, 1 * at + 1], [(2, 2)])
    assert machine.align([0, 1, 2], [3, 0, 1]) is None
    assert machine.align([2, 2], [2, 0, 1]) == ([2 * at + 2, 2 * at + 0, 2 * at + 1], [(1, 1), (2, 3)])
    assert machine.align([0], [0]) is None and machine.align([3], [0]) is None and machine.align([], [0]) is None
    assert machine.align([], []) == ([], [])


def test_words_and_marks_are_not_split(monkeypatch):
    """Ids of chunks of letters and a mark come without the pattern, and equal the library's."""
    tool = alignment.Aligner(BYTE_BPE, PIECE_BPE)
    whole = lambda c: tuple(tool.bytes.library.encode(c, add_special_tokens=False).ids)
    plain = [" word", " Internationalizationalism;", " a.", "word", "x!", " zorgleplexing,"]
    odd = [" don't", " 12.", " x..", "  two", "\nfeed", " café,", " 漢.", " ", "\n", ".", " .", " a-b?"]
    for chunk in plain + odd:
        assert tuple(tool._left(chunk)) == whole(chunk), chunk
    monkeypatch.setattr(tool.bytes, "_split", None)
    assert None not in tool.aligned([c for c in plain if c[0] == " "])
