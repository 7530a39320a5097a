import brute
import pytest
from conftest import doc, prose

from filingmill.llm import decontaminate

ITEMS = [(1, prose(40, 1)), (2, "One, TWO"), (3, None), (4, ""), (5, prose(12, 77)), (5, prose(12, 77)), (None, "short item here")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_hits_equal_brute_force(spark, edge_docs, no_docs, items, block_bytes):
    more = edge_docs.unionByName(spark.createDataFrame([doc(20, "x " + prose(12, 77) + " y " + prose(12, 77)), doc(21, "zwei one two drei")], edge_docs.schema))
    got = decontaminate.hits(more, items, block_bytes=block_bytes)
    rows = [tuple(r)[:6] for r in got.collect()]
    small = [(r["doc_id"], *brute.hits(r["text"], ITEMS)) for r in more.collect()]
    assert sorted(rows, key=str) == sorted(small, key=str)
    assert decontaminate.hits(no_docs, items).count() == 0
    none = decontaminate.hits(edge_docs, items.where("false")).collect()
    assert all(r["n_hit"] == 0 and not r["contaminated"] for r in none) and len(none) == 12


def test_filter_keeps_clean_rows_and_columns(edge_docs, items):
    kept = decontaminate.without_hits(edge_docs, items)
    want = [str(r["doc_id"]) for r in edge_docs.collect() if not brute.hits(r["text"], ITEMS)[1]]
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(want)


def test_spans_are_cut(spark, items):
    held = spark.createDataFrame([(1, f"Before, {prose(40, 1)}. After"), (2, "clean  text\n"), (3, None), (4, prose(12, 77))], "doc_id bigint, text string")
    got = dict(map(tuple, decontaminate.without_hits(held, items, remove="spans").collect()))
    assert got == {1: "Before, . After", 2: "clean  text\n", 3: None, 4: ""}
    with pytest.raises(ValueError):
        decontaminate.without_hits(held, items, remove="x")


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_spans_of_overlapping_items_do_not_depend_on_blocks(spark, block_bytes):
    names = [f"w{i}" for i in range(30)]
    overlapping = spark.createDataFrame([(1, " ".join(names[:15])), (2, " ".join(names[8:21]))], "item_id bigint, text string")
    held = spark.createDataFrame([(1, " ".join(names)), (1, " ".join(names))], "doc_id bigint, text string")
    got = decontaminate.without_hits(held, overlapping, block_bytes=block_bytes, remove="spans")
    assert [r["text"] for r in got.collect()] == [" ".join(names[21:])] * 2


def test_any_number_of_blocks_gives_the_same_and_leaves_nothing(spark, tmp_path, monkeypatch):
    import os

    from filingmill.llm import shared

    monkeypatch.setattr(shared, "shared_root", lambda _: f"file://{tmp_path}")
    texts = [prose(400, k) for k in range(6)] + [None, "", prose(400, 2)]
    docs = spark.createDataFrame([(k % 8, t, "x") for k, t in enumerate(texts)], "doc_id int, text string, marks string")
    items = [("a", prose(300, 1)), ("b", " ".join(prose(400, 2).split()[50:75])), ("c", "rho sigma"), (None, prose(2000, 3)), ("d", "nowhere to be found")]
    held = spark.createDataFrame(items, "item_id string, text string")
    want = sorted(((k % 8, *brute.hits(t, items)) for k, t in enumerate(texts)), key=str)
    for size in (1 << 22, 600, 40):
        got = decontaminate.hits(docs, held, block_bytes=size).drop("items")
        assert sorted(map(tuple, got.collect()), key=str) == want
        assert all(x.startswith("judged") for x in os.listdir(tmp_path))
    whole = {how: sorted(map(tuple, decontaminate.without_hits(docs, held, remove=how).collect()), key=str) for how in ("documents", "spans")}
    for how, rows in whole.items():
        assert sorted(map(tuple, decontaminate.without_hits(docs, held, block_bytes=200, remove=how).collect()), key=str) == rows
    assert len(whole["documents"]) == sum(not w[-1] for w in want)
