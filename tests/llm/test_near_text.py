import random
from fractions import Fraction

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from filingmill.llm import near_text, simhash


def near_rows():
    """Texts with a shared opening, and copies with 0 to 12 words changed, on both sides of 0.8."""
    r = random.Random(3)
    word = lambda: "w" + str(r.randrange(5000))
    opening = [word() for _ in range(30)]
    texts = []
    for base in range(12):
        own = opening + [word() for _ in range(r.choice([20, 120, 300]))]
        for changes in (0, 0, 1, 2, 3, 4, 6, 8, 12):
            copy = list(own)
            for _ in range(changes):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += ["", None, "  ", "one two", "One  two", "three"]
    r.shuffle(texts)
    return list(enumerate(texts))


def test_groups_equal_brute_force(spark, edge_docs, no_docs):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    first = brute.near_texts([t for _, t in rows])
    assert sorted(r["doc_id"] for r in near_text.one_per_group(docs).collect()) == [i for i, _ in rows if first[i] == i]
    kept = near_text.one_per_group(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 10, 11, 3, 6, 7, None]
    assert near_text.one_per_group(no_docs).count() == 0


def test_a_dense_group_is_whole_and_pairs_few(spark, monkeypatch):
    """Copies near a common text, most of them too far from each other: hubs tie, parities rule out the rest."""
    r = random.Random(5)
    base = [f"w{r.randrange(3000)}" for _ in range(150)]
    texts = [" ".join(base)]
    for k in range(120):
        copy = list(base)
        for at in r.sample(range(150), 1 + k % 5):
            copy[at] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    paired = []

    def counted(*a):
        found = simhash.close_pairs(*a)
        paired.append(found.count())
        return found

    monkeypatch.setattr(near_text, "close_pairs", counted)
    first = brute.near_texts(texts)
    assert sorted(r["doc_id"] for r in near_text.one_per_group(docs).collect()) == sorted(set(first))
    assert paired[0] < 120 * 119 / 8


@pytest.mark.parametrize("changed", [3, 4])
def test_stage_drops_edited_copies(spark, changed):
    own = [f"w{i}" for i in range(200)]
    copy = list(own)
    for k in range(changed):
        copy[20 + 40 * k] = f"x{k}"
    docs = spark.createDataFrame([(1, " ".join(own)), (2, " ".join(copy)), (3, "other text of few words here")], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]


@pytest.mark.parametrize("least", [None, Fraction(4, 5)])
def test_exploded_rows_are_never_sent(spark, least):
    """However small the file of nodes is, its exploded rows don't pass through the driver."""
    nodes = spark.range(40).select(F.col("id").alias("node"), F.col("id").alias("code"), F.lit(100).cast("bigint").alias("size"), F.lit(None).cast("bigint").alias("root"), *[F.lit(None).cast("bigint").alias(c) for c in simhash.ODD])
    probed = [(list(range(k, k + 16)), 2) for k in (0, 16, 32, 48)]
    for found in (simhash.close_pairs(nodes, probed, 11, least), simhash.hub_ties(nodes, probed, 11, least)):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count()
