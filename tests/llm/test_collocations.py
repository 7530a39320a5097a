import brute
import numpy as np
import pytest

from filingmill.llm import collocations


def got(docs, **how):
    return sorted(tuple(r) for r in collocations.collocations(docs, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_edges(edge_docs, no_docs):
    rows = [(r["text"], r["lang"]) for r in edge_docs.select("text", "lang").collect()]
    assert got(edge_docs) == sorted(brute.phrases(rows))
    assert got(no_docs) == []


@pytest.mark.parametrize("shard, top", [(50, 2000), (2_000_000, 7)])
def test_equals_plain_counts(spark, shard, top):
    draw = np.random.default_rng(1)
    words = ["a", "b", "c", "D", "e\u0301", "\u00a0", "\x00", "x\x1cy"]
    ends = [" ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", "!"]
    rows = [("".join(words[int(draw.integers(len(words)))] + ends[int(draw.integers(len(ends)))] for _ in range(90)), [None, "en", "de"][i % 3]) for i in range(40)]
    rows += [("new york city hall", "en")] * 30 + [("york times", "en")] * 12 + [("", "en"), (None, "fr")]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert got(df, shard_words=shard, top=top) == sorted(brute.phrases(rows, top=top))


def test_suffixes_are_in_order():
    draw = np.random.default_rng(2)
    for n in (0, 1, 2, 40):
        ids = draw.integers(0, 4, n)
        order = collocations.suffix_array(ids, 4).tolist()
        assert sorted(order) == list(range(n))
        heads = [ids[i : i + 4].tolist() for i in order]
        assert heads == sorted(heads)


def test_scores_are_exact(spark):
    """Products beyond 64 bits, floored."""
    a, left, right = 9_876_543_210_123, 9_999_999_999_999, 9_999_999_999_998
    df = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    score = df.select(collocations._score("a", df["l"], df["r"]).alias("s")).first()["s"]
    assert score == 1_000_000 * a * a // (left * right)
