import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import brute
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from filingmill.llm import mixing, sharding


def test_shards(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 100)
    more = spark.range(100, 4100).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    both = edge_docs.select("doc_id", "text").unionByName(more)
    got = sharding.sharded(both, 8).collect()
    assert len(got) == 4012
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
    assert sorted(slots) == list(range(8)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(0.7 < len(v) / (4012 / 8) < 1.3 for v in slots.values())
    assert 0.07 < sum(r["grown_shard"] == 8 for r in got) / 4012 < 0.16
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in both.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    assert sharding.sharded(no_docs, 8).count() == 0


@pytest.mark.parametrize(("n", "base"), [(1, 1), (4, 4), (5, 4), (7, 4), (7, 7), (8, 4), (8, 8), (11, 8)])
def test_one_more_shard_takes_rows_only_into_itself(spark, n, base):
    ids = spark.range(2000).select(F.col("id").alias("doc_id"))
    a, b = sharding.grown_tree(n, base), sharding.grown_tree(n + 1, base)
    got = ids.select(sharding.descend(F.col("doc_id"), a).alias("a"), sharding.descend(F.col("doc_id"), b).alias("b")).collect()
    assert all(r["a"] == r["b"] or r["b"] == n for r in got) and any(r["b"] == n for r in got)


def test_a_tree_below_its_base_is_an_error():
    with pytest.raises(ValueError):
        sharding.grown_tree(7, 8)


def brute_shard(key, node):
    """The shard by plain descent: the child of the greatest ln(u) / weight, with Spark's XXH64 of bigint and name."""
    while node.shard is None:
        straws = []
        for c in (c for c in node.children if c.weight > 0):
            h = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
            h = xxhash.xxh64_intdigest(c.name.encode(), h)
            straws.append((math.log(((h >> 11) + 1) / (1 << 53)) / c.weight, c))
        node = max(straws, key=lambda s: s[0])[1]
    return node.shard


def test_shards_equal_plain_descent(spark):
    ids = [0, 1, -5, 2**62, *range(10, 600)]
    rows = spark.createDataFrame([(i, f"t{i % 7}") for i in ids] + [(3, "same")] * 40, "doc_id bigint, text string")
    got = sharding.sharded(rows, 8).collect()
    for r in got:
        assert r["shard"] == brute_shard(r["doc_id"], sharding.grown_tree(8))
        assert r["grown_shard"] == brute_shard(r["doc_id"], sharding.grown_tree(9))
    assert len({r["slot"] for r in got if r["doc_id"] == 3 and r["size"] == 5}) == 40


def test_movement_stays_in_the_changed_subtree(spark):
    leaf = lambda s, w=1.0: sharding.Node(f"s{s}", s, w)
    tree = lambda w: sharding.Node("root", children=(sharding.Node("a", children=(leaf(0, w), leaf(1, 2 - w))), sharding.Node("b", children=(leaf(2), leaf(3)))))
    ids = spark.range(3000).select(F.col("id").alias("doc_id"))
    got = ids.select(sharding.descend(F.col("doc_id"), tree(1.0)).alias("x"), sharding.descend(F.col("doc_id"), tree(0.5)).alias("y")).collect()
    moved = [(r["x"], r["y"]) for r in got if r["x"] != r["y"]]
    assert moved and set(moved) == {(0, 1)}


def as_leaves(spark, leaves):
    return spark.createDataFrame([(*path, t) for path, t in leaves.items()], "__domain string, __lang string, __source string, tokens bigint")


def given_budgets(spark, leaves, total, weight, epochs):
    got = mixing.budgets(as_leaves(spark, leaves), total, weight, epochs).collect()
    return {tuple(r[n] for n in mixing.NAMES): r["budget"] for r in got}


def test_shortage_goes_to_siblings_first(spark):
    leaves = {("d0", "en", "a"): 10, ("d0", "en", "b"): 500, ("d1", "en", "c"): 500}
    even = lambda path: 1.0
    assert given_budgets(spark, leaves, 400, even, 1) == {("d0", "en", "a"): 10, ("d0", "en", "b"): 190, ("d1", "en", "c"): 200}
    assert given_budgets(spark, {**leaves, ("d0", "en", "b"): 50}, 400, even, 1) == {("d0", "en", "a"): 10, ("d0", "en", "b"): 50, ("d1", "en", "c"): 340}


@pytest.mark.parametrize("seed", range(6))
def test_budgets_equal_brute_force(spark, seed):
    r = random.Random(seed)
    leaves = {(f"d{r.randrange(3)}", f"l{r.randrange(3)}", f"s{k}"): r.choice([0, 1, 7, 100, 5000, r.randrange(10**6)]) for k in range(40)}
    weight = lambda path: {0: 0.0, 1: 1.0, 2: 2.5, 3: 10.0}[zlib.crc32("/".join(path).encode()) % 4]
    total = r.choice([0, 5, 1000, sum(leaves.values()) // 2, sum(leaves.values()), 10 * sum(leaves.values())])
    epochs = 1 + seed % 3
    assert {k: v for k, v in given_budgets(spark, leaves, total, weight, epochs).items() if v} == {k: v for k, v in brute.budgets(leaves, total, weight, epochs).items() if v}


@pytest.mark.parametrize(("share", "epochs", "bucket_rows"), [(1.0, 2, 4), (0.5, 1, 4), (0.3, 1, 8192), (1.0, 1, 8192)])
def test_prefixes_equal_brute_force(spark, edge_docs, no_docs, monkeypatch, share, epochs, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    more = spark.range(100, 160).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("src"), (F.col("id") % 3).cast("string")).alias("source"))
    docs = edge_docs.select("doc_id", "text", "lang", "source").unionByName(more)
    rows = [(r["doc_id"], r["text"], "d", r["lang"], r["source"]) for r in docs.collect()]
    tokens = [len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows]
    weight = lambda path: {"en": 3.0, "src1": 0.5}.get(path[-1], 1.0)
    got = mixing.selected(docs, F.lit("d"), weight, share, epochs).collect()
    want = [(rows[i][0], tokens[i], e) for i, e in brute.mixed(rows, int(share * sum(tokens)), weight, epochs, tokens)]
    assert sorted(((r["doc_id"], r["tokens"], r["epoch"]) for r in got), key=str) == sorted(want, key=str)
    kept = mixing.mixed(edge_docs, F.lit("d"), weight, share, epochs)
    assert kept.columns == edge_docs.columns
    assert mixing.selected(no_docs, F.lit("d"), weight).count() == 0


def test_own_columns_of_the_operators_names_stay(spark):
    rows = [(i, f"text {i}", "en", "s", f"x{i}", "y", 1) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, __domain string, __source string, cut int")
    assert sorted(map(tuple, mixing.mixed(docs, F.lit("d"), lambda p: 1.0).collect())) == rows


def test_tokens_are_those_of_the_vocabulary(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["some plain words of it", "漢字仮名交じり文" * 20, "x" * 500, "", None]
    want = [(len(library.encode(t, add_special_tokens=False).ids) if t else 0) + 1 for t in texts]
    docs = spark.createDataFrame([(i, t, "en", f"s{i}") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string")
    got = mixing.selected(docs, F.lit("d"), lambda p: 1.0).collect()
    assert [r["tokens"] for r in sorted(got, key=lambda r: r["doc_id"])] == want
    words = mixing.selected(docs, F.lit("d"), lambda p: 1.0, count=mixing.words_of).collect()
    assert [r["tokens"] for r in sorted(words, key=lambda r: r["doc_id"])] == [6, 2, 2, 1, 1]


def test_text_without_spaces_is_cut_by_its_tokens(spark):
    rows = [(i, "漢字仮名交じり文" * 20, "ja", "a") for i in range(20)] + [(100 + i, "word " * 100, "en", "b") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = mixing.selected(docs, F.lit("d"), lambda p: 1.0, 3000).collect()
    taken = [sum(r["tokens"] for r in got if r["lang"] == lang) for lang in ("ja", "en")]
    most = max(r["tokens"] for r in got)
    assert all(1500 <= t < 1500 + most for t in taken)
