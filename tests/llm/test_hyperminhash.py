import brute
import numpy as np
from conftest import prose

from filingmill.llm import hyperminhash
from filingmill.llm.near_text import shingle_set


def by_brute(rows):
    root, sizes = brute.linked([r["text"] for r in rows])
    ids = {}
    for r, c in zip(rows, root):
        ids[c] = min((x for x in (ids.get(c), r["doc_id"]) if x is not None), default=None)
    return sorted(((r["doc_id"], n, ids[c], r["doc_id"] is not None and r["doc_id"] == ids[c]) for r, c, n in zip(rows, root, sizes)), key=str)


def got(docs):
    return sorted((tuple(r) for r in hyperminhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_edges(edge_docs, no_docs):
    assert got(edge_docs) == by_brute(edge_docs.select("doc_id", "text").collect())
    assert got(no_docs) == []


def edited(words, at, draw):
    """A text with words changed at some places."""
    out = list(words)
    for i in at:
        out[i] = f"w{draw.integers(1 << 30)}"
    return " ".join(out)


def test_no_link_is_lost_around_the_threshold(spark):
    draw = np.random.default_rng(5)
    texts = []
    for size in (8, 12, 30, 70, 150, 400):
        for _ in range(6):
            base = [f"w{x}" for x in draw.integers(0, 5000, size)]
            texts.append(" ".join(base))
            texts += [edited(base, draw.choice(size, k, replace=False), draw) for k in (1, max(1, size // 60), max(1, size // 45))]
            texts += [" ".join(base[k:]) for k in (1, 2, size // 8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = by_brute([{"doc_id": i, "text": t} for i, t in enumerate(texts)])
    assert got(df) == want
    assert 0 < sum(not kept for *_, kept in want) < len(texts)


def test_groups_around_a_base_and_a_shared_passage(spark):
    """Copies that link through their base alone, and many texts with one long passage that don't link."""
    draw = np.random.default_rng(7)
    base = [f"b{i}" for i in range(300)]
    copies = [edited(base, draw.choice(300, 6, replace=False), draw) for _ in range(60)]
    passage = [f"p{i}" for i in range(60)]
    others = [" ".join([*passage, *(f"o{k}x{i}" for i in range(int(draw.integers(20, 60))))]) for k in range(80)]
    texts = [*copies, " ".join(base), *others]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert got(df) == by_brute([{"doc_id": i, "text": t} for i, t in enumerate(texts)])


def test_estimates_are_near_the_similarity():
    draw = np.random.default_rng(3)
    chance = hyperminhash.chance_table()
    for common, own in ((900, 50), (500, 500), (100, 900), (0, 1000), (17, 3)):
        errors = []
        for _ in range(30):
            x = draw.integers(0, 1 << 63, common + 2 * own, dtype=np.uint64)
            a, b = np.sort(x[: common + own]), np.sort(np.concatenate((x[:common], x[common + own :])))
            found, _ = hyperminhash.estimates(hyperminhash.registers(a)[None], hyperminhash.registers(b)[None], (np.array([len(a)]), np.array([len(b)])), chance)
            errors.append(float(found[0]) - common / (common + 2 * own))
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 5 / 16


def test_chance_table_equals_counts():
    draw = np.random.default_rng(9)
    equal = used = 0
    for _ in range(400):
        a, b = (hyperminhash.registers(draw.integers(0, 1 << 63, 512, dtype=np.uint64)) for _ in range(2))
        equal += int(((a == b) & (a != hyperminhash.EMPTY)).sum())
        used += len(a)
    want = hyperminhash.chance_table()[18, 18] * used
    assert abs(equal - want) < 5 * np.sqrt(want) + 1


def test_registers_of_parts_merge_by_their_order():
    """A register is the larger the smaller its least value, so a union's sketch is the least of leading-zero order."""
    a, b = (shingle_set(prose(300, k).encode(), 5) for k in (1, 2))
    both = hyperminhash.registers(np.union1d(a, b))
    parts = np.stack([hyperminhash.registers(a), hyperminhash.registers(b)])
    assert all(c in p for c, p in zip(both.tolist(), parts.T.tolist()))
