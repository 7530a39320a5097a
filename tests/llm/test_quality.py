import math
import zlib

import numpy as np
from conftest import doc, prose

from filingmill.llm import quality


def junk(n, seed):
    return " ".join(w + "###$$$"[seed % 4 : seed % 4 + 3] for w in prose(n, seed).split())


def corpus(spark, n=240):
    rows = [doc(i, prose(30 + i % 50, i) + ".") if i % 4 else doc(i, junk(30 + i % 50, i)) for i in range(n)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, code bigint, n bigint, tokens bigint, bucket int, epoch int, cut bigint, part string, score double, shard int, h bigint, copy boolean, items string, marks string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark, edge_docs):
    docs, labels = corpus(spark)
    got = quality.scored(docs.unionByName(edge_docs.withColumn("doc_id", edge_docs["doc_id"] + 10_000)), labels).collect()
    assert len(got) == 240 + 12
    truth = {i: int(i % 4 != 0) for i in range(240)}
    for r in got:
        want = True if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == want and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in got if r["predicted"] and r["doc_id"] in truth}


def test_labels_of_one_kind_or_none_accept_all(spark, edge_docs, no_docs):
    docs, labels = corpus(spark, 20)
    for own in (labels.where("quality = 1"), labels.where("false"), labels.selectExpr("doc_id", "cast(null as int) as quality", "toxic")):
        assert {r["predicted"] for r in quality.scored(docs, own).collect()} == {1}
    assert quality.scored(no_docs, labels).count() == 0


def test_pairs_learn_the_order():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 5))
    y = (x[:, 0] - 2 * x[:, 3] + draw.normal(size=400) * 0.1 > 0).astype(int)
    m = quality.fit(x, y)
    assert ((m.scores(x) >= 0.3) == y).mean() > 0.97


def plain_loss(w, x, y):
    """Mean logistic loss of all (better, worse) pairs, by the definition."""
    strength = [sum(a * b for a, b in zip(w, row)) for row in x]
    pairs = [(i, j) for i in range(len(y)) for j in range(len(y)) if y[i] > y[j]]
    return sum(math.log1p(math.exp(strength[j] - strength[i])) for i, j in pairs) / len(pairs)


def test_fit_is_near_the_least_loss_of_all_pairs():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(60, 3))
    y = (x[:, 0] - x[:, 1] + draw.normal(size=60) > 0.3).astype(int)
    m = quality.fit(x, y, penalty=0.0, steps=2000)
    rows = ((x - x.mean(0)) / (x.std(0) + 1e-3)).tolist()
    w = [0.0, 0.0, 0.0]
    best = plain_loss(w, rows, y)
    step = 1.0
    while step > 1e-3:  # coordinate descent
        for k in range(3):
            for d in (step, -step):
                tried = [*w]
                tried[k] += d
                if (loss := plain_loss(tried, rows, y)) < best:
                    w, best = tried, loss
                    break
            else:
                continue
            break
        else:
            step /= 2
    own = (m.weights * (x.std(0) + 1e-3)).tolist()
    assert plain_loss(own, rows, y) < best + 0.01


def test_the_cut_is_the_stated_quantile():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(500, 4))
    y = (x[:, 0] + draw.normal(size=500) > 0).astype(int)
    for level in (None, 0.1, 0.5, 0.9):
        below = (quality.fit(x, y, level=level).scores(x) < 0.3).sum()
        assert below == round(500 * (level if level is not None else (y == 0).mean()))
    assert quality.quantile_cut(np.array([1.0, 2.0, 4.0, 8.0]), 0.5) == 3.0


def test_repeated_and_disagreeing_labels_count_once(spark):
    docs, labels = corpus(spark, 80)
    once = quality.train(docs, labels)
    again = quality.train(docs.unionByName(docs).unionByName(docs), labels.unionByName(labels))
    assert np.array_equal(once.weights, again.weights) and once.cut == again.cut
    torn = labels.unionByName(labels.selectExpr("doc_id", "1 - quality as quality", "toxic"))
    assert {r["predicted"] for r in quality.scored(docs, torn).collect()} == {1}
