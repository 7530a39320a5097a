import zlib

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from filingmill.llm import quality
from filingmill.llm.queries import QUERIES, table, target_weight

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = quality.train(docs, table(spark, SF, "labels"))
    rows = [r for r in docs.orderBy("doc_id").collect() if model.scores(quality.features(r["text"])[None])[0] >= quality.THRESHOLD]
    first = brute.near_texts([r["text"] for r in rows])
    rows = [r for i, r in enumerate(rows) if first[i] == i]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    rows = [r for r in rows if not brute.hits(r["text"], items)[1]]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(r["doc_id"], r["text"], f"family{zlib.crc32((r['source'] or '').encode()) % 4}", r["lang"], r["source"]) for r in rows]
    tokens = [len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows]
    kept = [rows[i] for i, _ in brute.mixed(rows, int(corpus_pipeline.MIX_SHARE * sum(tokens)), target_weight, 1, tokens)]
    want, at = [], 0
    for r in sorted(kept):
        ids = np.array([*library.encode(r[1], add_special_tokens=False).ids, 0], "<u4")
        want.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want
    assert 0 < len(want) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_every_operator_has_a_query():
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 11))


def as_tables(spark, path, docs, labels=((1, 1, 0), (2, 1, 0), (6, 0, 0)), items=((1, "one two"), (None, None))):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_run_on_nulls_empty_and_long_texts_repeats_and_clashing_names(spark, tmp_path, edge_docs):
    """Every stage by its rule on rows with nulls everywhere, long and blank texts, repeated rows and columns named as the stages' own."""
    none = spark.createDataFrame([(None,) * len(edge_docs.columns)] * 2, edge_docs.schema)
    sf_dir = as_tables(spark, tmp_path / "edges", edge_docs.unionByName(none))
    docs = table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, sf_dir)
        after = docs.collect()
        assert docs.columns == edge_docs.columns and set(after) <= set(before)
        if name == "near_dedup":
            first = brute.near_texts([r["text"] for r in before])
            assert len(after) == len(set(first))
        if name == "decontamination":
            assert sorted(map(str, after)) == sorted(str(r) for r in before if not brute.hits(r["text"], [(1, "one two")])[1])
    want = sorted((r["doc_id"] for r in after), key=str)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == want
    assert sorted(r["start"] for r in got)[0] == 0


def test_run_on_an_empty_table(spark, tmp_path, no_docs):
    sf_dir = as_tables(spark, tmp_path / "none", no_docs)
    assert corpus_pipeline.run(spark, sf_dir).count() == 0
