from itertools import combinations

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from filingmill.llm import components as module, simhash
from filingmill.llm.components import components


def test_fingerprint_equals_definition():
    for t in ("", "a", "a b", "A b c", "x y z x y z", "Über ÄÖ äö test\x0bwords", "word " * 50):
        assert simhash.fingerprint(t.encode()) == brute.simhash(t)


def test_edges(edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs).select("doc_id", simhash.fingerprint_hex(F.col("code")).alias("f"), "component_id").collect()
    rows = edge_docs.select("doc_id", "text").collect()
    codes = [brute.simhash(r["text"]) for r in rows]
    first = brute.classes(codes)
    ids = {}
    for r, c in zip(rows, first):
        ids[c] = min(x for x in (ids.get(c), r["doc_id"]) if x is not None) if (ids.get(c), r["doc_id"]) != (None, None) else None
    want = sorted(((r["doc_id"], f"{k:016x}", ids[c]) for r, k, c in zip(rows, codes, first)), key=str)
    assert sorted(((r["doc_id"], r["f"], r["component_id"]) for r in got), key=str) == want
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("tau", [1, 2, 3, 4])
def test_links_are_whole_for_any_plan(spark, tau, monkeypatch):
    draw = np.random.default_rng(tau)
    base = draw.integers(0, 1 << 63, 40, dtype=np.int64)
    codes = {int(b) for b in base}
    for b in base:
        for d in range(1, tau + 3):
            codes.add(int(b) ^ sum(1 << int(k) for k in draw.choice(63, d, replace=False)))
    codes = sorted(codes)
    df = spark.createDataFrame([(c, 1) for c in codes], "code bigint, n bigint")
    want = brute.classes([c & (1 << 64) - 1 for c in codes], tau)

    def check():
        found = {r["node"]: r["root"] for r in components(simhash.code_links(df, tau)).collect()}
        roots = [found.get(c, c) for c in codes]
        assert roots == [codes[i] for i in want]

    check()
    monkeypatch.setattr(simhash, "HUB_FROM", 2)
    check()
    parts = [list(range(32)), list(range(32, 64))]
    half = (tau - 1) // 2
    monkeypatch.setattr(simhash, "plan", lambda codes, tau: [(parts[0], half), (parts[1], tau - 1 - half)])
    check()


def test_thresholds_add_up_and_cost_least():
    costs = [[0, 5, 9, 30], [0, 1, 2, 3], [0, 8, 9, 10]]
    dealt = simhash.deal_thresholds(costs, 1)
    assert sum(dealt) == 1
    cost = lambda d: sum(c[t + 1] for c, t in zip(costs, d))
    assert cost(dealt) == min(cost(d) for d in [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3)] if sum(d) == 1)


def test_correlated_bits_share_a_part():
    both = np.zeros((64, 64), dtype=np.int64)
    np.fill_diagonal(both, 500)
    both[np.where(~np.eye(64, dtype=bool))] = 250
    for a, b in combinations((3, 30, 60), 2):
        both[a, b] = both[b, a] = 480
    assert any({3, 30, 60} <= set(p) for p in simhash.correlated_parts(1000, both, 4))


def test_components_of_a_chain_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 300), (201, 200), (200, 201), (None, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 201: 200}


def test_components_take_no_step_over_stars(spark, monkeypatch):
    taken, step = [], module._step
    monkeypatch.setattr(module, "_step", lambda *args: taken.append(1) or step(*args))
    found = lambda links: {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found([(3, 1), (1, 4), (4, 1), (5, 5), (7, 6)]) == {1: 1, 3: 1, 4: 1, 6: 6, 7: 6} and not taken
    assert found([]) == {} and not taken
    assert found([(1, 3), (2, 3)]) == {1: 1, 2: 1, 3: 1} and len(taken) == 2
    assert found([(1, 2), (2, 3)]) == {1: 1, 2: 1, 3: 1} and len(taken) == 4
